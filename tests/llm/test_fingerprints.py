"""Sketches against full shingle sets, and the order of documents by hand."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import fingerprints as P
from tessera.llm.queries import QUERIES


def shingles(text):
    w = re.sub(r"[ \t\n\x0b\f\r]+", " ", (text or "").lower()).strip(" ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(docs):
    docs = [(d, t or "") for d, t in docs]
    order = sorted(docs, key=lambda x: (x[0] is None, -(x[0] or 0)))
    out = {}
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        cut = len(t) // 3
        out[d] = (t, t[:len(t) - cut] + after[:cut], after)
    return out


def check(rows, docs, tolerance):
    want = expected(docs)
    assert len(rows) == len(docs)
    off = []
    for r in rows:
        t, edited, after = want[r.doc_id]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = map(shingles, (t, edited, after))
        for got, other in ((r.near_edited, b), (r.near_next, c)):
            assert 0 <= got <= 1
            exact = len(a) < P.K and len(other) < P.K
            assert got == pytest.approx(likeness(a, other), abs=1e-9 if exact else 0.25)
            off.append(abs(got - likeness(a, other)))
        assert r.n_shingles_est == pytest.approx(len(a), rel=1e-9 if len(a) < P.K else 0.5)
        assert len(r.fingerprint) == 16 * min(P.K, len(a))
    assert sum(off) / len(off) < tolerance


def test_order_blocks_and_odd_rows(spark):
    rng = random.Random(3)
    docs = [(i * i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(0, 400)))) for i in range(120)]
    docs += [(-5, None), (-6, ""), (-7, " \n "), (None, "Only three words"), (10**15, "Ünï cödé \U0001f600 letters everywhere here"), (77, "w " * 60_000)]
    schema = T.StructType.fromDDL("doc_id long, text string, t int, h int, block int, copy string")
    df = spark.createDataFrame([(d, t, 1, 2, 3, "c") for d, t in docs], schema)
    check(P.report(df.repartition(6)).collect(), docs, 0.02)
    one = P.report(df.where("doc_id = 16")).collect()
    check(one, [x for x in docs if x[0] == 16], 0.05)
    assert P.report(df.limit(0)).count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words are here too now"), (2, "x")], "doc_id long, text string")
    rows = P.report(df).collect()
    assert len(rows) == 4 and len({r.fingerprint for r in rows if r.n_chars == 11}) == 1


def test_merge_equals_whole(spark):
    rng = random.Random(4)
    texts = [(i % 3, " ".join(str(rng.randrange(10**6)) for _ in range(200))) for i in range(40)]
    df = spark.createDataFrame(texts, "g int, text string").select("g", P.word_hashes(F.col("text")).alias("w"))
    df = df.select("g", P.shingle_hashes(F.col("w")).alias("s"))
    parts = {r.g: r.sketch for r in P.merged(df.select("g", P.bottom(F.col("s")).alias("sketch")), ["g"]).collect()}
    for r in df.select("g", F.explode("s").alias("h")).groupBy("g").agg(F.sort_array(F.collect_set("h")).alias("all")).collect():
        assert parts[r.g] == r["all"][:P.K]


def test_query_has_no_python_and_is_right(spark, sf_dir):
    df = QUERIES["op5_fingerprints"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(df.collect(), docs, 0.03)
