import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import common, ppm
from tessera.llm.common import read_table

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
DDL = "doc_id long, text string, block string, held int"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Plain:
    """PPM with escape method D and exclusion, one byte at a time, by dictionaries."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            for ctx, s in self.steps(t):
                for k in range(order + 1):
                    self.seen[ctx[order - k:]][s] += 1

    def steps(self, t):
        b = b"\xff" * self.order + (t or "").encode().translate(LOW) + b"\xff"
        return [(b[i - self.order:i], b[i]) for i in range(self.order, len(b))]

    def p(self, ctx, s):
        left, out = set(), 1.0
        for k in range(self.order, -1, -1):
            counts = self.seen.get(ctx[self.order - k:])
            if not counts:
                continue
            fresh = {x: n for x, n in counts.items() if x not in left}
            total = sum(fresh.values())
            if s in fresh:
                return out * (2 * fresh[s] - 1) / (2 * total)
            if fresh:
                out *= len(fresh) / (2 * total)
            left |= set(counts)
        return out / (256 - len(left))

    def score(self, t):
        return sum(math.log10(self.p(*x)) for x in self.steps(t))


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOW))


def plain(rows, order):
    model = Plain([t for i, t in rows if not held(i)], order)
    c, ends = Counter(), sum(not held(i) for i, _ in rows)
    for i, t in rows:
        if not held(i):
            c.update(words(t))
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    out = []
    for i, t in rows:
        ws = words(t)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        out.append((i, held(i), len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), n, base, model.score(t)))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[6], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [2, 4, 6])
def test_matches_the_plain_model(spark, order):
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The dog sat on the log", None, "", " \t\n ", "a" * 300,
                                          "ÄÖ ü ß the 猫 sat", "abracadabra " * 9, "x", "zebra quiz", "the cat sat on the mat",
                                          "unknown_word_of_more_than_sixteen_bytes unknown_word_of_more_than_sixteen_bytes",
                                          "sixteen_bytes_ab sixteen_bytes_a seventeen_bytes_a", "nul\x00 nul", "7 77 777"])]
    rows += [(None, "the cat"), (None, None)] + [(3, "the cat sat")] * 5
    assert any(held(i) for i, _ in rows)
    got = ppm.score(spark.createDataFrame([(*r, "clash", 1) for r in rows], DDL), order=order).collect()
    same(got, plain(rows, order))


def test_blocks_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join("".join(chr(97 + c) for c in rng.integers(0, 6, rng.integers(1, 9))) for _ in range(rng.integers(0, 60)))) for i in range(150)]
    rows += [(1000, "long " + "bcde " * 60_000)] + [(2000 + i, "the same text again and again") for i in range(80)]
    monkeypatch.setattr(ppm, "LEAST_BLOCK", 700)
    monkeypatch.setattr(ppm, "slices", lambda t: common.slices(t, 300))
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 700)
    got = ppm.score(spark.createDataFrame([(*r, "clash", 1) for r in rows], DDL).repartition(3)).collect()
    same(got, plain(rows, 5))


def test_no_training_texts_and_no_rows(spark):
    only = [i for i in range(60) if held(i)]
    got = ppm.score(spark.createDataFrame([(i, "ab c", "", 0) for i in only], DDL)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in got} == {(0, 0, 0.0)}
    assert all(r.score == pytest.approx(5 * math.log10(1 / 256)) for r in got)
    assert ppm.score(spark.createDataFrame([], DDL)).count() == 0


def test_probabilities_sum_to_one():
    texts = ["abab abc", "abd", "xyz"]
    order, model = 3, Plain(texts, 3)
    pairs = sorted({step for t in texts for step in model.steps(t)})
    for ctx in {c for c, _ in pairs} | {b"zzz", b"\xffab"}:
        learned = Counter(step for t in texts for step in model.steps(t))
        ask = {c + bytes([s]) for c, s in pairs} | {ctx + bytes([s]) for s in range(256)}
        g = np.array([int.from_bytes(x, "big") for x in sorted(ask)])
        n = np.array([learned[(x[:-1], x[-1])] for x in sorted(ask)])
        outer = np.zeros((256, 256), np.int64)
        for (c, s), k in learned.items():
            outer[c[-1], s] += k
        p = 10 ** ppm.log_probabilities(g, n, outer, order)
        mine = np.array([x[:-1] == ctx for x in sorted(ask)])
        assert p[mine].sum() == pytest.approx(1)


def test_whole_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = ppm.score(docs).collect()
    want = plain(rows, 5)
    same(got, want)


def test_unseen_texts_score_better_with_more_training(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").where("crc32(cast(doc_id as string)) % 7 = 2")
    rest = read_table(spark, "/root/testdata/sf0.01", "documents").where("crc32(cast(doc_id as string)) % 7 <> 2")
    least = {r.doc_id: r.score for r in ppm.score(docs.union(rest.where("doc_id % 20 = 0"))).where("held_out").collect()}
    most = {r.doc_id: r.score for r in ppm.score(docs.union(rest)).where("held_out").collect()}
    assert sum(most.values()) > 0.95 * sum(least.values())
    assert np.mean([most[i] >= least[i] for i in most]) > 0.95
