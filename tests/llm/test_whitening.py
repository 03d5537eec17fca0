import math

import numpy as np
import pytest

from tessera.llm import whitening
from tessera.llm.common import read_table


def plain(rows):
    """The contract on one machine: {vec_id: (n, deviation)}, x by id, eigen pairs of the fit list."""
    kept = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(kept.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    x = np.array(fit, float) - np.array([s / n for s in sums])
    e, vectors = np.linalg.eigh(x.T @ x / n)
    return kept, fit, n, sums, e[::-1], vectors[:, ::-1]


def check(spark, rows, ddl="vec_id long, embedding array<float>, whitened string, x int", extra=("clash", 1)):
    frame = spark.createDataFrame([(*r, *extra) for r in rows], ddl)
    stored = [(r[0], r[1]) for r in frame.collect()]  # floats as they are stored
    kept, fit, n, sums, e, vectors = plain(stored)
    out = whitening.report(frame).collect()
    count = min(16, int((e > 1e-12 * e[0]).sum()))
    assert len(out) == len(kept) * count
    for r in out:
        x = kept[r.vec_id]
        k = r.component - 1
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        want = (np.array(x) - np.array([s / n for s in sums])) @ vectors[:, k] / math.sqrt(e[k])
        assert abs(abs(r.whitened) - abs(want)) < 1e-6
        assert r.explained == pytest.approx(e[k] / e.sum(), rel=1e-6) and r.identity_error < 1e-8
    return out


def test_nulls_ties_and_repeated_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [9, 7, 5, 3, 1]]) for i in range(120)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(100)]  # almost half of the rows
    rows += [(2000, None), (2001, [1.0, None, 3.0, 4.0, 5.0]), (2002, [math.nan] * 5), (2003, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    rows += [(5, rows[5][1]), (5, rows[5][1])]
    frame = [(i, v) for i, v in rows if i not in (5,)]
    out = check(spark, frame)
    same = {(r.component, r.whitened) for r in out if 1000 <= r.vec_id < 1100}
    assert len(same) == 5  # one value a component for all copies
    repeated = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.report(repeated).where("vec_id = 5").count() == 3 * 5


def test_other_lengths_null_ids_and_wide_values(spark):
    rows = [(None, [1e5, 2.0]), (2, [3.0, -1e5]), (3, [5.5, 2.25]), (4, [1.0]), (5, []), (6, [1.0, 2.0, 3.0])]
    out = whitening.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted({r.vec_id for r in out}, key=str) == [2, 3, None]
    kept, fit, n, sums, e, _ = plain([r for r in rows if r[1] and len(r[1]) == 2])
    assert {(r.vec_id, r.deviation) for r in out} == {(i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))) for i, x in kept.items()}


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e13, 0.0]), (2, [-1e13, 1.0]), (3, [0.0, 5.0])]
    out = whitening.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in out if r.vec_id in (1, 2)} == {None}


def test_one_vector_no_vector_no_rows(spark):
    ddl = "vec_id long, embedding array<float>"
    assert whitening.report(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], ddl)).count() == 0
    assert whitening.report(spark.createDataFrame([(1, None)], ddl)).count() == 0
    assert whitening.report(spark.createDataFrame([], ddl)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_counts_as_weights(spark):
    rows = [(1, [0.0, 1.0])] * 6 + [(2, [4.0, 0.0])] * 3 + [(3, [1.0, 7.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), weights="count").collect()
    x = np.array([[math.floor(64 * c) for c in v] for _, v in rows], float)
    x -= x.mean(axis=0)
    e = np.linalg.eigvalsh(x.T @ x / len(x))[::-1]
    assert out[0].n == 10 and out[0].explained == pytest.approx(e / e.sum()) and out[0].identity_error < 1e-9


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    out = whitening.report(read_table(spark, sf_dir, "embeddings")).collect()
    kept, fit, n, sums, e, vectors = plain(rows)
    assert len(out) == 16 * len(kept)
    by = {(r.vec_id, r.component): r for r in out}
    for i, x in kept.items():
        assert by[i, 1].deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
    assert all(by[rows[0][0], k + 1].explained == pytest.approx(e[k] / e.sum(), rel=1e-9) for k in range(16))
    assert out[0].identity_error < 1e-9
