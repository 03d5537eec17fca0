"""Residual diagnostics, prediction intervals and drift.

Drift works on a long form ``(feature, split, value)`` produced by one
``unpivot``, so PSI and KS for all features are a handful of jobs, not one
job per column.  The KS statistic needs running sums over sorted values;
they are computed with range partitioning (see :func:`running_sums`) so one
feature with many distinct values is spread over many tasks.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .lookup import attach, fit_table
from .quantiles import column_quantiles, grouped_quantiles, with_quantiles

PSI_ALERT, PSI_HIGH = 0.15, 0.25
KS_ALERT, KS_HIGH = 0.05, 0.01


# -- A18, A19, W7 --------------------------------------------------------------
def residual_summary(df: DataFrame, y: str = "y_true", p: str = "y_pred", by: list[str] = ()) -> DataFrame:
    """mean, population std, median, quartiles, min, max, population skewness
    and excess kurtosis of ``y - p`` (A18)."""
    r = F.col(y) - F.col(p)
    agg = df.groupBy(*by).agg(
        F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"),
        F.min(r).alias("min"), F.max(r).alias("max"), F.skewness(r).alias("skew"),
        F.kurtosis(r).alias("kurtosis"))
    return with_quantiles(agg, df.withColumn("_r", r), list(by), "_r", [0.25, 0.5, 0.75],
                          ["q25", "median", "q75"])


def residuals_by_group(df: DataFrame, group_col: str, y: str = "y_true", p: str = "y_pred",
                       by: list[str] = ()) -> DataFrame:
    """Per group: mean, sample std, median of the residual and the count."""
    r = F.col(y) - F.col(p)
    d = df.where(F.col(group_col).isNotNull())
    agg = d.groupBy(*by, group_col).agg(
        F.avg(r).alias("residual_mean"), F.stddev_samp(r).alias("residual_std"),
        F.count(F.lit(1)).alias("count"))
    return with_quantiles(agg, d.withColumn("_r", r), [*by, group_col], "_r", [0.5], ["residual_median"])


def residuals_by_quartile(df: DataFrame, y: str = "y_true", p: str = "y_pred", by: list[str] = (), names=("Q1", "Q2", "Q3", "Q4")) -> DataFrame:
    """Residual statistics per quartile of the truth (A19), quartiles taken
    within ``by``: right-closed bands between exact edges, the least value
    included.  Rows with a NULL or NaN truth or prediction take no part; groups
    whose edges coincide have no four bands and give no rows."""
    by = list(by)
    ok = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in (y, p)]
    rows = df.where(ok[0] & ok[1])
    steps = range(len(names) + 1)
    edges = [f"_qe{i}" for i in steps]
    # NULL is a group like any other: the edges meet the rows by a key that is never NULL
    keyed = rows.withColumn("_qk", F.to_json(F.struct(F.lit(0).alias("_"), *by)))
    fitted = fit_table(grouped_quantiles(keyed, ["_qk"], y, [i / len(names) for i in steps], edges), ["_qk"])
    distinct = F.size(F.array_distinct(F.array(*edges))) == len(edges)
    banded = attach(keyed, fitted).where(distinct)
    band = F.lit(names[-1])
    for i in range(len(names) - 2, -1, -1):
        band = F.when(F.col(y) <= F.col(edges[i + 1]), names[i]).otherwise(band)
    out = residuals_by_group(banded.withColumn("quartile", band), "quartile", y, p, ["_qk"])
    if not by:
        return out.drop("_qk")
    values = rows.select(*by).distinct().withColumn("_qk", F.to_json(F.struct(F.lit(0).alias("_"), *by)))
    return out.join(values, "_qk").select(*by, *[c for c in out.columns if c != "_qk"])


def worst_predictions(df: DataFrame, keys: list[str], n: int = 10, y: str = "y_true",
                      p: str = "y_pred") -> DataFrame:
    """Top-n rows by absolute residual, with the error in % of the truth.
    ``orderBy().limit()`` plans as a bounded top-k per task + merge."""
    r = F.col(y) - F.col(p)
    return (df.select(*keys, y, p, r.alias("residual"), F.abs(r).alias("abs_residual"),
                      (100 * F.abs(r) / F.abs(F.col(y))).alias("pct_error"))
            .orderBy(F.col("abs_residual").desc(), *keys).limit(n))


# -- L8 -------------------------------------------------------------------------
def residual_intervals(train_preds: DataFrame, preds: DataFrame, levels=(0.8, 0.9),
                       y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Prediction intervals from the empirical residual distribution of the
    training rows: ``[p + q(a/2), p + q(1-a/2)]`` (L8).

    This is the limit of the residual bootstrap (resampling residuals and
    taking percentiles of ``p + r*``) without its Monte-Carlo noise; the
    quantiles are one aggregation and the transform is a map, so no
    residual array is ever broadcast.  All on the original scale.
    """
    qs = []
    for lv in levels:
        a = 1 - lv
        qs += [a / 2, 1 - a / 2]
    row = column_quantiles(train_preds.select((F.col(y) - F.col(p)).alias("_r")), ["_r"], qs)["_r"]
    out = preds
    for i, lv in enumerate(levels):
        tag = int(round(lv * 100))
        out = out.withColumn(f"lo_{tag}", F.col(p) + F.lit(row[2 * i])) \
                 .withColumn(f"hi_{tag}", F.col(p) + F.lit(row[2 * i + 1]))
    return out


#: modulus of the arithmetic draw (fixed value: the Mersenne prime 2^31 - 1)
DRAW_MOD = 2_147_483_647


def draw_rank(key, draw, n: int, seed: int = 42):
    """Rank 0 .. n - 1 that draw number ``draw`` of the row with integer ``key``
    takes: products and squares modulo a prime, all below 2^63, so SQL can
    repeat it.  Beyond 2^31 residuals the ranks are 2^31 even steps apart."""
    m = F.pmod(key.cast("long"), F.lit(DRAW_MOD))
    a = F.pmod(m * 48271 + (draw.cast("long") + 1) * 69621 + F.lit(seed), F.lit(DRAW_MOD))
    b = F.pmod(a * a + 12345, F.lit(DRAW_MOD))
    c = F.pmod(b * 48271 + m, F.lit(DRAW_MOD))
    d = F.pmod(c * c + a, F.lit(DRAW_MOD))
    return F.least(F.floor(d / F.lit(float(DRAW_MOD)) * F.lit(float(n))).cast("long"), F.lit(max(n - 1, 0)))


def bootstrap_intervals(train_preds: DataFrame, preds: DataFrame, row_key: str, order_cols: list[str], levels=(0.8, 0.9),
                        draws: int = 100, seed: int = 42, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Residual bootstrap (L8): every row draws ``draws`` training residuals with
    replacement and takes ``lo_<level>`` / ``hi_<level>`` from the percentiles of
    prediction + residual.

    Residuals are numbered in their order, so the percentile of a row's draws is
    found among its drawn *ranks*: a row looks up the few ranks its levels need,
    not its draws, by an equi-join whose keys are spread evenly over the
    residuals.  ``row_key``: integer column; rows with one key draw alike, a NULL
    key gives NULL bounds.  ``order_cols`` break ties between equal residuals.
    NULL residuals are left out; without any, bounds are NULL."""
    from .ranking import global_positions
    residuals = train_preds.select((F.col(y) - F.col(p)).cast("double").alias("_res"), *order_cols).where(F.col("_res").isNotNull())
    numbered = global_positions(residuals, ["_res", *order_cols], "_rank").select("_rank", "_res")
    n = numbered.count()
    tags = [(f"{side}_{round(lv * 100)}", share) for lv in levels for side, share in (("lo", (1 - lv) / 2), ("hi", (1 + lv) / 2))]
    at = {name: share * (draws - 1) for name, share in tags}
    places = sorted({i for pos in at.values() for i in (math.floor(pos), math.ceil(pos))})
    drawn = F.sort_array(F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), lambda b: draw_rank(F.col("_key"), b, n, seed)))
    wanted = (preds.select(F.col(row_key).alias("_key")).where(F.col("_key").isNotNull()).distinct().withColumn("_drawn", drawn)
              .select("_key", F.inline(F.array(*[F.struct(F.lit(i).alias("_place"), F.col("_drawn")[i].alias("_rank")) for i in places]))))
    found = (wanted.join(numbered, "_rank").groupBy("_key")
             .agg(*[F.max(F.when(F.col("_place") == i, F.col("_res"))).alias(f"_at{i}") for i in places]))
    bounds = {}
    for name, pos in at.items():
        low, high = F.col(f"_at{math.floor(pos)}"), F.col(f"_at{math.ceil(pos)}")
        bounds[name] = low + (high - low) * F.lit(pos - math.floor(pos))
    offsets = found.select("_key", *[e.alias(f"_off_{name}") for name, e in bounds.items()])
    out = preds.join(offsets, F.col(row_key) == F.col("_key"), "left").drop("_key")
    return out.withColumns({name: F.col(p) + F.col(f"_off_{name}") for name in bounds}).drop(*[f"_off_{name}" for name in bounds])


# -- A20, A21, A22 ----------------------------------------------------------------
def to_long(df: DataFrame, features: list[str], split_col: str = "split") -> DataFrame:
    """(feature, split, value) rows for the numeric features, NULLs dropped."""
    return (df.select(split_col, *[F.col(c).cast("double").alias(c) for c in features])
            .unpivot([split_col], features, "feature", "value")
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def psi(long: DataFrame, baseline: str = "train", actual: str = "test", bins: int = 10,
        split_col: str = "split") -> DataFrame:
    """Population stability index per feature.

    Edges are the baseline's deciles (duplicates removed); the last bin is
    closed; actual values outside the baseline range fall in no bin but still
    count in the denominator; empty shares become 1e-4."""
    qs = [i / bins for i in range(bins + 1)]
    names = [f"_e{i}" for i in range(len(qs))]
    edges = grouped_quantiles(long.where(F.col(split_col) == baseline), ["feature"], "value", qs, names) \
        .select("feature", F.array_distinct(F.array_sort(F.array(*names))).alias("_edges"))
    edges = fit_table(edges, ["feature"])
    e = F.col("_edges")
    k = F.size(e) - 1
    idx = F.size(F.filter(e, lambda x: x <= F.col("value"))) - 1
    bin_ = (F.when((F.col("value") < F.element_at(e, 1)) | (F.col("value") > F.element_at(e, -1)), F.lit(None))
            .otherwise(F.least(idx, k - 1)))
    # one aggregation: per bin, values outside all bins (also of a feature without a baseline) under NULL
    rows = long.where(F.col(split_col).isin(baseline, actual)).join(edges.joinable(), "feature", "left")
    counts = rows.groupBy("feature", bin_.alias("_bin")).agg(
        F.count_if(F.col(split_col) == baseline).alias("_ce"), F.count_if(F.col(split_col) == actual).alias("_ca"))
    per = counts.groupBy("feature").agg(
        F.sum("_ce").alias("_ne"), F.sum("_ca").alias("_na"),
        F.map_from_entries(F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct("_bin", F.struct("_ce", "_ca"))))).alias("_m"))
    per = per.join(edges.joinable(), "feature", "left")
    bins_ = F.sequence(F.lit(0), F.greatest(F.size("_edges") - 2, F.lit(0)))

    def term(i):
        c = F.try_element_at("_m", i)
        ce, ca = F.coalesce(c["_ce"], F.lit(0)) / F.col("_ne"), F.coalesce(c["_ca"], F.lit(0)) / F.col("_na")
        es, as_ = F.when(ce == 0, F.lit(1e-4)).otherwise(ce), F.when(ca == 0, F.lit(1e-4)).otherwise(ca)
        return (as_ - es) * F.log(as_ / es)

    total = F.abs(F.aggregate(F.transform(bins_, term), F.lit(0.0), lambda s, x: s + x))
    # without a baseline, or without actual values, there is nothing to compare: NULL, but reported
    known = F.col("_edges").isNotNull() & (F.col("_ne") > 0) & (F.col("_na") > 0)
    return per.select("feature", F.when(known, total).alias("psi"))


def running_sums(df: DataFrame, key_cols: list[str], order_col: str, sum_cols: list[str],
                 num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` per key in ``order_col`` order.

    Range partitioning on (key, order) spreads a big key over many tasks;
    each task sums locally, and a small table of per-(partition, key) totals
    gives each partition its starting offset."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *key_cols, order_col)
         .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    w = Window.partitionBy("_pid", *key_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    local = s.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in sum_cols])
    tot = s.groupBy("_pid", *key_cols).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    w2 = Window.partitionBy(*key_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_pid", *key_cols, *[F.coalesce(F.sum(f"_tot_{c}").over(w2), F.lit(0)).alias(f"_off_{c}")
                                          for c in sum_cols])
    off = fit_table(off, ["_pid", *key_cols])
    out = local.join(off.joinable(), ["_pid", *key_cols])
    return out.select(*df.columns, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}")
                                     for c in sum_cols])


def _ks_pvalue(d: float, n1: int, n2: int) -> float:
    """Asymptotic two-sided p-value (Kolmogorov series with the Stephens
    small-sample correction)."""
    if not n1 or not n2 or d is None:
        return float("nan")
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s, sign = 0.0, 1.0
    for k in range(1, 101):
        term = sign * math.exp(-2.0 * k * k * lam * lam)
        s += term
        sign = -sign
        if abs(term) < 1e-12:
            break
    return max(0.0, min(1.0, 2.0 * s))


def ks_pvalue_col(d: str, n1: str, n2: str):
    """Column form of :func:`_ks_pvalue` (100-term series, JVM-side)."""
    en = F.sqrt(F.col(n1) * F.col(n2) / (F.col(n1) + F.col(n2)))
    lam = (en + 0.12 + 0.11 / en) * F.col(d)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
                         * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 1e-3, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def ks_statistic(long: DataFrame, a: str = "train", b: str = "test", split_col: str = "split") -> DataFrame:
    """Two-sample KS statistic per feature: max |F_a(x) - F_b(x)| over the
    distinct values (A21)."""
    counts = long.where(F.col(split_col).isin(a, b)).groupBy("feature", "value").agg(
        F.count_if(F.col(split_col) == a).alias("ca"), F.count_if(F.col(split_col) == b).alias("cb"))
    tot = counts.groupBy("feature").agg(F.sum("ca").alias("na"), F.sum("cb").alias("nb"))
    cum = running_sums(counts, ["feature"], "value", ["ca", "cb"])
    d = cum.join(tot, "feature").groupBy("feature", "na", "nb").agg(
        F.max(F.abs(F.col("cum_ca") / F.col("na") - F.col("cum_cb") / F.col("nb"))).alias("ks_stat"))
    return d


def drift_report(df: DataFrame, features: list[str], split_col: str = "split", baseline: str = "train",
                 actual: str = "test", bins: int = 10) -> DataFrame:
    """PSI + KS per common numeric feature with alert levels."""
    long = to_long(df, features, split_col).cache()
    p = psi(long, baseline, actual, bins, split_col)
    k = ks_statistic(long, baseline, actual, split_col)
    out = p.join(k, "feature", "full_outer").withColumn("ks_pvalue", ks_pvalue_col("ks_stat", "na", "nb"))
    return (out.withColumn("psi_alert", F.col("psi") > PSI_ALERT)
            .withColumn("ks_alert", F.col("ks_pvalue") < KS_ALERT)
            .withColumn("severity", F.when((F.col("psi") > PSI_HIGH) | (F.col("ks_pvalue") < KS_HIGH), "high")
                        .when(F.col("psi_alert") | F.col("ks_alert"), "medium").otherwise("none")))
