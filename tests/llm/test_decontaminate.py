"""Latent retrieval against exact containment and a plain longest common
subsequence over whole documents."""
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from tessera.llm import decontaminate as D
from tessera.llm.queries import QUERIES


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), min_size=1, max_size=20))
def test_lcs(a, b):
    assert D.lcs(D.masks_of(b), a, len(b)) == plain_lcs(a, b)


def test_answers():
    assert D.answer_at("What is the colour of the sky? It is blue today.") == 7
    assert D.answer_at("one two three four five six seven eight nine ten") == 2
    assert D.answer_at("short one") == 0


def test_terms_are_found():
    rng = np.random.default_rng(3)
    some = rng.integers(0, 2**63, 5000).astype(np.uint64)
    terms = D.Terms(some[:1000])
    found = terms.find(some)
    assert (found[:1000] >= 0).all() and (terms.hashes[found[:1000]] == some[:1000]).all() and (found[1000:] == -1).all()


def made():
    rng = random.Random(8)
    words = ["".join(rng.choice(["ba", "do", "ki", "lu", "me", "no", "pra", "sti"]) for _ in range(rng.randint(1, 4))) for _ in range(4000)]
    def text(n):
        return [words[rng.randrange(20)] if rng.random() < 0.4 else rng.choice(words) for _ in range(n)]
    items = [(i, text(rng.choice([12, 25, 40, 60, 150]))) for i in range(30)]
    docs, truth = [], set()
    for d in range(300):
        t = text(rng.choice([5, 30, 200, 900]))
        if d % 6 == 0:
            i, w = rng.choice(items)
            if d % 12 == 0 and len(w) > 12:  # a paraphrase: every ninth word changed, one dropped
                w = [x if k % 9 else "other" for k, x in enumerate(w[:-1] + w[-1:]) if k != len(w) // 2]
            at = rng.randrange(len(t))
            t = t[:at] + w + t[at:]
            truth.add((d, i))
        docs.append((d, " ".join(t)))
    items = [(i, " ".join(w)) for i, w in items]
    return docs, [*items, (98, None), (99, "")], truth


def test_made_leaks(spark):
    docs, items, truth = made()
    docs += [(1000, None), (1001, ""), (None, items[0][1]), (0, docs[0][1])]
    schema = T.StructType.fromDDL("doc_id long, text string, item int, t string, k0 long")
    df = spark.createDataFrame([(*x, 7, "t", 8) for x in docs], schema).repartition(6)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, id string")
    rows = D.contaminated(df, bench).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert (None, 0) in got and {p for p in got if p[0] is not None} == truth
    text = dict(docs)
    for r in rows:
        if r.doc_id is not None:
            w = D.item_words(dict(items)[r.item_id])
            assert 0.6 <= r.lcs_share <= plain_lcs(D.item_words(text[r.doc_id]), w) / len(w)
    kept = D.without_contaminated(df, bench)
    assert kept.columns == df.columns
    bad = {d for d, _ in truth} | {None}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)
    assert D.contaminated(df.limit(0), bench).count() == 0 and D.contaminated(df, bench.limit(0)).count() == 0
    assert D.without_contaminated(df, bench.limit(0)).count() == len(docs)


def test_blocks_of_items(spark, monkeypatch):
    docs, items, truth = made()
    monkeypatch.setattr(D, "ITEM_BLOCK", 11)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == truth


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_finds_every_copy(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    docs = {r.doc_id: D.item_words(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: D.item_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    rows = QUERIES["op7_decontamination"](spark, sf_dir).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert len(got) == len(rows)
    joined = {d: " " + " ".join(w) + " " for d, w in docs.items()}
    copies = {(d, i) for i, w in items.items() for d, t in joined.items() if " " + " ".join(w) + " " in t}
    assert copies and copies <= got
    for d, i in got - copies:
        assert plain_lcs(docs[d], items[i]) >= 0.6 * len(items[i])


def test_rare_words_replaced_and_passages_of_long_items(spark):
    """20-word items of 14 common words and 6 rare ones, 3 or 4 of these replaced
    (0.8 or more of the words stay in order); one passage of a long item."""
    rng = random.Random(12)
    common = [f"c{i}" for i in range(60)]
    def text(n):
        return [rng.choice(common) if rng.random() < 0.7 else f"r{rng.randrange(3000)}" for _ in range(n)]
    items, docs, truth = [], [(d, " ".join(text(150))) for d in range(600)], set()
    for i in range(20):
        rare = rng.sample(range(20), 6)
        w = [f"q{i}x{k}" if k in rare else rng.choice(common) for k in range(20)]
        items.append((i, " ".join(w)))
        near = [f"z{i}x{k}" if k in rare[:3 + i % 2] else x for k, x in enumerate(w)]
        docs += [(1000 + i, " ".join(text(60) + near + text(50))), (2000 + i, " ".join(text(60) + w + text(50)))]
        truth |= {(1000 + i, i), (2000 + i, i)}
    long = [f"l{k}" for k in range(300)]
    items.append((50, " ".join(long)))
    docs.append((3000, " ".join(text(40) + long[96:176] + text(40))))
    rows = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert (3000, 50) in got and {p for p in truth if p[0] >= 2000} <= got
    assert len(truth & got) >= 0.9 * len(truth)
