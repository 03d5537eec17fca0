"""Normality statistics and p-values against plain computations."""
import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import eda


def plain(x):
    x = np.sort(np.asarray(x, float))
    n, nd = len(x), NormalDist()
    z = (x - x.mean()) / x.std(ddof=1)
    lo, hi = (np.array([nd.cdf(s * v) for v in z]) for s in (1, -1))
    i = np.arange(1, n + 1)
    ks = max((i / n - lo).max(), (lo - (i - 1) / n).max())
    ad = -n - np.sum((2 * i - 1) * (np.log(lo) + np.log(hi[::-1]))) / n
    c = x - x.mean()
    skew, kurt = (c ** 3).mean() / c.std() ** 3, (c ** 4).mean() / c.std() ** 4 - 3
    return ks, ad, n / 6 * (skew ** 2 + kurt ** 2 / 4)


def test_statistics_by_group_with_ties_and_gaps(spark):
    rng = np.random.default_rng(0)
    groups = {"normal": rng.normal(5, 2, 400), "ties": np.round(rng.normal(0, 1, 500), 1), "skewed": rng.exponential(1, 300)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    rows += [("normal", None), ("normal", math.nan), ("flat", 1.0), ("flat", 1.0), ("single", 2.0), ("void", None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("n", F.lit(3))
    got = {r.g: r for r in eda.normality_report(df, "v", ["g"]).collect()}
    assert set(got) == {"normal", "ties", "skewed", "flat", "single"}
    for g, vs in groups.items():
        ks, ad, jb = plain(vs)
        assert (got[g].ks_stat, got[g].anderson_darling, got[g].jarque_bera) == pytest.approx((ks, ad, jb), rel=1e-4, abs=1e-5)
        assert got[g].jb_p == pytest.approx(math.exp(-jb / 2), rel=1e-3, abs=1e-12)
        assert got[g].score == pytest.approx(abs(got[g].skew) + abs(got[g].kurtosis) + 1 - got[g].jb_p)
    assert got["normal"].ks_normal and got["normal"].jb_normal and got["normal"].ad_normal
    assert not got["skewed"].ks_normal and not got["skewed"].jb_normal and not got["skewed"].ad_normal
    assert got["flat"].ks_stat is None and got["single"].ad_p is None and got["flat"].jb_normal is None


def test_pvalues_at_published_points(spark):
    # critical values for a fitted normal: 10 %, 5 %, 2.5 %, 1 %; Kolmogorov's distribution: 10 %, 5 %, 1 %
    ad = spark.createDataFrame([(0.631, 0.10), (0.752, 0.05), (0.873, 0.025), (1.035, 0.01)], "a double, p double")
    for r in ad.select("p", eda.anderson_pvalue(F.col("a"), F.lit(1e9)).alias("got")).collect():
        assert r.got == pytest.approx(r.p, rel=0.05)
    ks = spark.createDataFrame([(1.2238, 0.10), (1.3581, 0.05), (1.6276, 0.01), (0.1, 1.0), (50.0, 0.0)], "l double, p double")
    n = 1e12
    for r in ks.select("p", eda.kolmogorov_pvalue(F.col("l") / math.sqrt(n), F.lit(n)).alias("got")).collect():
        assert r.got == pytest.approx(r.p, rel=1e-3, abs=1e-9)
    grid = spark.range(1, 1500).select(eda.anderson_pvalue(F.col("id") / 100, F.lit(1e9)).alias("p")).collect()
    assert all(0 <= r.p <= 1 for r in grid)
