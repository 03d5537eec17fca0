"""Isolation forest as ranges of values, and the vote of three."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import outliers as ol


def frame(spark, values, group="g"):
    return spark.createDataFrame([(i, group, float(v)) for i, v in enumerate(values)], "id long, g string, t double")


def test_merged_trees_equal_a_walk_through_each_tree():
    rng = np.random.default_rng(3)
    psi, leaves = 64, []
    for t in range(7):
        pdf = pd.DataFrame({"_g": "a", "_tree": t, "_v": rng.normal(size=psi), "_h": rng.permutation(psi)})
        leaves.append(ol._build_tree(pdf, psi, 1))
    pdf = pd.concat(leaves).assign(_psi=psi)
    got = ol._merge_trees(pdf)
    ends, scores = got["_ends"][0], got["_scores"][0]
    for v in [-1e9, 1e9, *rng.normal(size=200), *ends[:-1][::17]]:
        path = np.mean([tr[(tr.lo <= v) & (v < tr.hi)].path.iloc[0] for tr in leaves])
        assert scores[np.searchsorted(ends, v, side="right")] == pytest.approx(2.0 ** (-path / ol._c(psi)))


def test_cut_is_the_quantile_of_the_rows_scores():
    rng = np.random.default_rng(5)
    ends = np.append(np.sort(rng.normal(size=40)), np.inf)
    scores = rng.random(41).round(1)  # ties
    place = rng.integers(0, 41, 500)
    counts = pd.Series(place).value_counts().rename_axis("_i").reset_index(name="_rows")
    forest = pd.DataFrame({"_g": ["a"], "_ends": [ends], "_scores": [scores]})
    for c in (0.0, 0.02, 0.3):
        ranges = ol._outlier_ranges(forest, counts, c)["_ranges"][0]
        cut = np.quantile(scores[place], 1 - c)
        starts = np.append(-np.inf, ends[:-1])
        for lo, s in zip(starts, scores):
            assert any(r["lo"] <= lo < r["hi"] for r in ranges) == (s > cut + 1e-12)


def test_every_row_stays_and_gets_a_defined_flag(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "a" if i % 3 else "b", float(v)) for i, v in enumerate(rng.normal(100, 10, 600))]
    rows += [(1000, "a", None), (1001, "a", math.nan), (1002, "a", math.inf), (1003, "a", -math.inf), (1004, None, 100.0),
             (1005, "only nulls", None), (1006, "a", 1e12), (7, "a", rows[7][2]), (7, "a", rows[7][2])]
    df = spark.createDataFrame(rows, "id long, g string, t double").withColumn("_n", F.lit(1)).withColumn("lo", F.lit("x"))
    out = ol.isolation_forest_inliers(df, "t", 0.03, "g", n_trees=20, id_cols=["id"])
    assert out.count() == len(rows) and out.columns == [*df.columns, "is_inlier_iso"]
    flag = {r.id: r.is_inlier_iso for r in out.collect()}
    assert all(flag[i] for i in (1000, 1001, 1002, 1003, 1005)) and not flag[1004] and not flag[1006]
    assert 0 < sum(not f for f in flag.values()) <= 0.03 * len(rows) + 3
    assert ol.isolation_forest_inliers(df.limit(0), "t", 0.03, "g").count() == 0


def test_one_far_value_and_a_hot_value_do_not_change_the_work(spark, monkeypatch):
    """Values are dealt by hash into parts of bounded size whatever their spacing."""
    monkeypatch.setattr(ol, "PART", 50)
    values = [*np.linspace(0, 1e-6, 400), *[5e-7] * 800, 1e300]
    got = ol.isolation_forest_inliers(frame(spark, values), "t", 0.01, "g", n_trees=20, id_cols=["id"])
    monkeypatch.setattr(ol, "PART", 10 ** 9)
    whole = ol.isolation_forest_inliers(frame(spark, values).repartition(7), "t", 0.01, "g", n_trees=20, id_cols=["id"])
    a, b = ({r.id: r.is_inlier_iso for r in d.collect()} for d in (got, whole))
    assert a == b and not a[1200]


@pytest.mark.parametrize("fallback", ["skip", "global"])
def test_vote_of_three(spark, fallback):
    rng = np.random.default_rng(2)
    rows = [(i, "big", float(v)) for i, v in enumerate(rng.normal(0, 1, 300))]
    rows += [(400, "big", 50.0), (500, "small", 50.0), (501, "small", 0.0), (502, None, 0.0)]
    df = spark.createDataFrame(rows, "id long, g string, t double")
    out = {r.id: r for r in ol.ensemble_inliers(df, "t", "g", 30, fallback, n_trees=30, id_cols=["id"]).collect()}
    assert len(out) == len(rows)
    for r in out.values():
        assert r.is_inlier == (r.in_iqr + r.in_z + r.in_iso >= 2)
    assert not out[400].is_inlier and not out[502].is_inlier and out[501].is_inlier
    assert out[500].is_inlier == (fallback == "skip")
