"""Near duplicates against brute force over all pairs of full shingle sets."""
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tessera.llm import minhash_dedup as M
from tessera.llm.common import slices, text_bytes, words_of
from tessera.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(docs, percent=80):
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, j in {p for v in where.values() for p in combinations(v, 2)}:
        if root(i) != root(j):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(j)] = root(i)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(docs)]


def check(rows, docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)
    assert got == sorted(brute(docs), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def chains():
    """Copies of copies: neighbours are alike, far members are not."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    docs, n = [], 0
    for g in range(6):
        text = [rng.choice(words) for _ in range(120)]
        for _ in range(30):
            docs.append((n, " ".join(text)))
            n += 1
            if rng.random() < 0.7:
                text = list(text)
                for _ in range(rng.randint(1, 4)):
                    text[rng.randrange(len(text))] = rng.choice(words)
    docs += [(n + i, docs[i % 5][1].upper()) for i in range(50)]
    return docs + [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "One  TWO"), (9005, "one"), (None, "one two"),
                   (None, "nothing like it anywhere here"), (9006, "x" * 300_000), (9007, "a b c d " * 50_000)]


def test_chains_and_odd_rows(spark):
    docs = chains()
    schema = T.StructType.fromDDL("doc_id long, text string, n int, sig string, key long, component_id long")
    df = spark.createDataFrame([(d, t, 1, "s", 2, 3) for d, t in docs], schema).repartition(7)
    check(M.near_duplicates(df).collect(), docs)
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_other_leaders_find_what_the_first_misses(spark, monkeypatch):
    docs = chains()[:180]
    monkeypatch.setattr(M, "MISS", 1e-9)
    check(M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_posterior_bounds():
    steps = M.least_agreements(0.8)
    assert [n for n, _ in steps] == [32, 64, 96, 128, 160]
    assert all(0 < m < 0.8 * n for n, m in steps) and [m for _, m in steps] == sorted(m for _, m in steps)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    x, y = np.unique(a[:2000]), np.unique(a[500:2500])
    sig = M.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.12


@pytest.mark.parametrize("texts", [["", "a", " A b\nc ", "é\x0bx", "a b"], [""], ["  "]])
def test_words(texts):
    for part in slices(pa.array(texts), 2):
        raw, at = text_bytes(part)
        _, start, end, first = words_of(raw, at)
        low = raw.tobytes().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
        for i, t in enumerate(part.to_pylist()):
            assert [low[s:e].decode() for s, e in zip(start[first[i]:first[i + 1]], end[first[i]:first[i + 1]])] == \
                re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_by_brute_force(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op10_near_duplicates"](spark, sf_dir).collect()
    check(rows, docs)


def test_only_rows_that_may_be_dropped_are_joined(spark):
    docs = spark.createDataFrame([(i, f"t{i}", i, i) for i in range(3000)] + [(None, "x", 1, 1), (7, "again", 1, 1)],
                                 "doc_id long, text string, w int, b long")
    ids = spark.createDataFrame([(i,) for i in range(0, 3000, 100)] + [(7,), (9999,)], "of long")
    sure, rest = M.parted(docs, ids, "doc_id")
    assert sure.columns == rest.columns == docs.columns
    wanted = {r.of for r in ids.collect()}
    assert not wanted & {r.doc_id for r in sure.collect()}
    assert sorted(map(tuple, sure.union(rest).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert 32 <= rest.count() < 40
    sure, rest = M.parted(docs, ids.limit(0), "doc_id")
    assert (sure.count(), rest.count()) == (3002, 0)


def test_full_sets_are_sent_only_for_pairs_the_signatures_leave(spark):
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    sets = [base, base[:-10], *(np.unique(rng.integers(0, 2**63, 400).astype(np.uint64)) for _ in range(5))]
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    sig = M.signatures(np.concatenate(sets), at)
    key = next(int(k) for k, other in zip(M.band_keys(sig)[0].view(np.int64), M.band_keys(sig)[1].view(np.int64)) if k == other)
    nodes = spark.createDataFrame([(i, len(s), bytearray(sig[i].tobytes())) for i, s in enumerate(sets)], "node long, n long, sig binary")
    members = spark.createDataFrame([(key, i, i, len(sets)) for i in range(len(sets))], "key long, node long, label long, size long")
    left = M.hopeful(M.tiled(members, nodes), 80)
    assert sorted(r.node for r in left.collect()) == [0, 1]
    full = spark.createDataFrame([(i, [int(x) for x in s.view(np.int64)]) for i, s in enumerate(sets)], "node long, shingles array<long>")
    assert [tuple(r) for r in M.across(left, full, 80).collect()] == [(0, 1)]
