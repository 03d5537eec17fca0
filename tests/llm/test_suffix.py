"""Substring removal against brute force over all windows, and suffix sorting
against Python's own sort."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from tessera.llm import suffix_dedup as S
from tessera.llm.queries import QUERIES


def brute(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r) + 1)
        last = 0
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                for k in range(max(i, last), i + length):
                    gone[k] = 1
                last = i + length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(r)))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def check(rows, docs, length=400):
    want = sorted(((d, *x) for (d, _), x in zip(docs, brute([t for _, t in docs], length))), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str) == want


def made():
    rng = random.Random(9)
    def text(n):
        return "".join(rng.choice("abcdé \n") for _ in range(n))
    docs, shared = [], [text(n) for n in (300, 395, 399, 400, 401, 420, 900, 2500)]
    for i in range(60):
        parts = [text(rng.randrange(0, 700))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(shared), text(rng.randrange(0, 500))]
        docs.append((i, "".join(parts)))
    near = text(3000)
    for i in range(25):
        at = rng.randrange(3000)
        docs.append((100 + i, near[:at] + "#" * (i % 3) + near[at:]))
    docs += [(200, None), (201, ""), (202, "short"), (203, "a" * 399), (204, "b" * 400), (205, "c" * 401), (206, "c" * 5000), (207, "xy" * 1500),
             (208, docs[3][1]), (209, docs[3][1]), (None, text(800)), (210, "short")]
    return docs + [docs[70], docs[70]]


def test_made_texts(spark):
    docs = made()
    df = spark.createDataFrame([(d, t, "s", 1, 2) for d, t in docs], T.StructType.fromDDL("doc_id long, text string, sha string, node int, n int"))
    check(S.report(df.repartition(5)).collect(), docs)
    assert S.report(df.limit(0)).count() == 0


def test_groups_end_anywhere(spark):
    """Shared stretches of every length round the limit, against different surroundings."""
    rng = random.Random(2)
    docs = []
    for k in range(390, 432, 3):
        core = "".join(rng.choice("abcdefgh") for _ in range(k))
        docs += [(len(docs) + j, "".join(rng.choice("abcdefgh") for _ in range(j * 37)) + core + "".join(rng.choice("abcdefgh") for _ in range(200 - j * 40)))
                 for j in range(3)]
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    check(S.report(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=30), min_size=1, max_size=12))
def test_suffix_order(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    start = np.arange(len(raw))
    end = at[np.searchsorted(at, start, "right")]
    order = S.suffix_order(raw, S.Prefixes(raw), start, end)
    data = raw.tobytes()
    assert [data[start[i]:end[i]] for i in order] == sorted(data[s:e] for s, e in zip(start, end))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_by_brute_force(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op6_suffix_dedup"](spark, sf_dir).collect(), docs)


def test_a_hot_seed_is_joined_under_its_salts(spark):
    from pyspark.sql import functions as F

    from tessera.llm import suffix_dedup as sd
    spots = spark.range(1000).select(F.col("id").alias("node"), F.lit(0).alias("place"),
                                     F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("seed"),
                                     F.pmod("id", F.lit(sd.SALTS)).alias("salt"))
    spots = spots.union(spots.where("node = 1"))  # twice in one text, under one salt
    got = {(r.seed, r.salt) for r in sd.repeated_seeds(spots).collect()}
    assert got == {(7, k) for k in range(sd.SALTS)} | {(101, 1)}
    kept = spots.join(sd.repeated_seeds(spots), ["seed", "salt"])
    assert kept.count() == 334 + 2
