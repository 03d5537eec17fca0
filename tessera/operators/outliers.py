"""Outlier detection on a numeric target, globally or per group.

Statistics per group are one ``groupBy`` (partial aggregation) plus one
global row; each row then picks its group's fences when the group is large
enough, else the global fences (``fallback='global'``) or keeps the row
(``fallback='skip'``).  Rows with a NULL group are removed, as the mask of
the reference starts False and its group loop never visits them.

The isolation forest (O3) is distributed: rows are replicated only into the
trees whose hash-sample they belong to, each (group, tree) builds a small
1-D tree in ``applyInPandas`` (bounded input: about 4x the subsample size),
the trees of a group are merged into one sorted array of elementary intervals
with their scores, the group's values are counted in them by binary search, and
what is left of a fit is the ranges of values above the contamination cut.
"""
from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import StatsTable, fit_table, keep_cached
from .quantiles import column_quantiles, grouped_quantiles

_ALL = "__all__"
#: distinct values of a group that one task looks up
PART = 500_000


def _inlier_expr(v: Column, method: str, iqr_factor: float, z_thresh: float) -> Column:
    q1, q3 = F.col("_q")[0], F.col("_q")[2]
    iqr = q3 - q1
    iqr_ok = (v >= q1 - iqr_factor * iqr) & (v <= q3 + iqr_factor * iqr)
    iqr_in = F.when(iqr.isNull() | F.isnan(iqr) | (iqr == 0), F.lit(True)).otherwise(F.coalesce(iqr_ok, F.lit(False)))
    std = F.col("_std")
    z_ok = F.abs((v - F.col("_mean")) / std) <= z_thresh
    z_in = F.when(std.isNull() | (std == 0), F.lit(True)).otherwise(F.coalesce(z_ok, F.lit(False)))
    if method == "iqr":
        return iqr_in
    if method == "zscore":
        return z_in
    raise ValueError(method)


def _global_stats(df: DataFrame, target: str, exact: bool, need_q: bool = True) -> dict:
    """Global fences as driver-side scalars (one aggregate row + one exact
    quantile ranking)."""
    r = df.agg(F.count(F.lit(1)).alias("_n"), F.avg(target).alias("_mean"),
               F.stddev_pop(target).alias("_std")).first()
    if not need_q:
        q = [None, None, None]
    elif exact:
        q = column_quantiles(df, [target], [0.25, 0.5, 0.75])[target]
    else:
        q = df.agg(F.percentile_approx(target, [0.25, 0.5, 0.75], 10000)).first()[0]
    return {"_n": r["_n"], "_q": q, "_mean": r["_mean"], "_std": r["_std"]}


def _group_stats(df: DataFrame, group_col: str, target: str, exact: bool, need_q: bool = True) -> DataFrame:
    base = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_n"), F.avg(target).alias("_mean"),
                                     F.stddev_pop(target).alias("_std"))
    if not need_q:
        # z-scores need no quantiles: skip the ranking pass
        return base.withColumn("_q", F.array(*[F.lit(None).cast("double")] * 3))
    if not exact:
        q = df.groupBy(group_col).agg(F.percentile_approx(target, [0.25, 0.5, 0.75], 10000).alias("_q"))
        return base.join(q, group_col, "left")
    q = grouped_quantiles(df.where(F.col(group_col).isNotNull()), [group_col], target, [0.25, 0.5, 0.75],
                          ["_qa", "_qb", "_qc"])
    return base.join(q, group_col, "left").withColumn("_q", F.array("_qa", "_qb", "_qc")).drop("_qa", "_qb", "_qc")


def _lit_stats(st: dict) -> dict:
    q = st["_q"] or [None, None, None]
    return {"_n": F.lit(st["_n"]),
            "_q": F.array(*[F.lit(x).cast("double") for x in q]),
            "_mean": F.lit(st["_mean"]).cast("double"), "_std": F.lit(st["_std"]).cast("double")}


def flag_inliers(df: DataFrame, target: str, method: str = "iqr", group_col: str | None = None,
                 min_group_size: int = 30, fallback: str = "skip", iqr_factor: float = 1.5,
                 z_thresh: float = 4.0, out_col: str = "is_inlier", exact: bool = True) -> DataFrame:
    """Add a boolean inlier column (IQR fence or z-score, O1/O2/O5)."""
    fit = fit_fences(df, target, method, group_col, min_group_size, fallback, iqr_factor, z_thresh, exact)
    return apply_fences(df, fit, out_col)


@dataclass
class Fences:
    """Fitted fences: the settings, the statistics of all rows and of each group."""

    target: str
    method: str = "iqr"
    group_col: str | None = None
    min_group_size: int = 30
    fallback: str = "skip"
    iqr_factor: float = 1.5
    z_thresh: float = 4.0
    overall: dict | None = None
    groups: StatsTable | None = None


def fit_fences(df: DataFrame, target: str, method: str = "iqr", group_col: str | None = None, min_group_size: int = 30,
               fallback: str = "skip", iqr_factor: float = 1.5, z_thresh: float = 4.0, exact: bool = True) -> Fences:
    need_q = method == "iqr"
    fit = Fences(target, method, group_col, min_group_size, fallback, iqr_factor, z_thresh)
    if group_col:
        fit.groups = fit_table(_group_stats(df, group_col, target, exact, need_q), [group_col])
    if not group_col or fallback == "global":
        fit.overall = _global_stats(df, target, exact, need_q)
    return fit


def apply_fences(df: DataFrame, fit: Fences, out_col: str = "is_inlier") -> DataFrame:
    v = F.col(fit.target).cast("double")
    tmp = ("_n", "_q", "_mean", "_std")
    if not fit.group_col:
        out = df.withColumns(_lit_stats(fit.overall))
        return out.withColumn(out_col, _inlier_expr(v, fit.method, fit.iqr_factor, fit.z_thresh)).drop(*tmp)
    out = df.join(fit.groups.joinable(), fit.group_col, "left")
    small = F.col("_n") < fit.min_group_size
    if fit.fallback == "global":
        glob = _lit_stats(fit.overall)
        for c in ("_q", "_mean", "_std"):
            out = out.withColumn(c, F.when(small, glob[c]).otherwise(F.col(c)))
        flag = _inlier_expr(v, fit.method, fit.iqr_factor, fit.z_thresh)
    else:
        flag = F.when(small, F.lit(True)).otherwise(_inlier_expr(v, fit.method, fit.iqr_factor, fit.z_thresh))
    flag = F.when(F.col(fit.group_col).isNull(), F.lit(False)).otherwise(flag)
    return out.withColumn(out_col, flag).drop(*tmp)


def modified_zscore_inliers(df: DataFrame, target: str, thresh: float = 3.5,
                            out_col: str = "is_inlier_mz") -> DataFrame:
    """``0.6745 (y - median) / (MAD + 1e-8)``, |.| <= 3.5 is an inlier.
    Two passes: the median, then the median absolute deviation."""
    med = column_quantiles(df, [target], [0.5])[target][0]
    if med is None:
        return df.withColumn(out_col, F.lit(False))
    mad = column_quantiles(df.select(F.abs(F.col(target) - F.lit(med)).alias("_ad")), ["_ad"], [0.5])["_ad"][0]
    if mad is None:
        return df.withColumn(out_col, F.lit(False))
    mz = F.lit(0.6745) * (F.col(target) - F.lit(med)) / (F.lit(mad) + 1e-8)
    return df.withColumn(out_col, F.coalesce(F.abs(mz) <= thresh, F.lit(False)))


def vote(flags: list[str], mode: str = "majority") -> Column:
    """O4 majority of inlier votes (>= 2 of 3) or O7 union of outlier flags."""
    if mode == "majority":
        return sum(F.col(f).cast("int") for f in flags) >= 2
    if mode == "union":
        out = F.lit(True)
        for f in flags:
            out = out & F.col(f)
        return out
    raise ValueError(mode)


# ---------------------------------------------------------------------------
# O3: isolation forest
# ---------------------------------------------------------------------------

def _c(n: float) -> float:
    """Average unsuccessful-search path length in a BST of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _build_tree(pdf: pd.DataFrame, psi: int, seed: int) -> pd.DataFrame:
    """One 1-D isolation tree on the ``psi`` rows with the smallest sample
    hash; returns its leaves as intervals with their path lengths."""
    g, t = pdf["_g"].iloc[0], int(pdf["_tree"].iloc[0])
    vals = pdf.sort_values("_h")["_v"].to_numpy(dtype=float)[:psi]
    rng = np.random.default_rng([seed, t, zlib.crc32(str(g).encode())])
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    leaves = []

    def grow(x, lo, hi, depth):
        if depth >= max_depth or len(x) <= 1 or x.min() == x.max():
            leaves.append((lo, hi, depth + _c(len(x))))
            return
        s = rng.uniform(x.min(), x.max())
        grow(x[x < s], lo, s, depth + 1)
        grow(x[x >= s], s, hi, depth + 1)
    grow(vals, -np.inf, np.inf, 0)
    out = pd.DataFrame(leaves, columns=["lo", "hi", "path"])
    out.insert(0, "_tree", t)
    out.insert(0, "_g", g)
    return out


def _merge_trees(pdf: pd.DataFrame) -> pd.DataFrame:
    """The forest of a group as one row: the sorted upper ends of its elementary
    intervals (the last one is infinite) and the anomaly score on each."""
    g, psi = pdf["_g"].iloc[0], int(pdf["_psi"].iloc[0])
    cuts = np.unique(np.concatenate([pdf["lo"].to_numpy(), pdf["hi"].to_numpy()]))
    cuts = cuts[np.isfinite(cuts)]
    starts, ends = np.append(-np.inf, cuts), np.append(cuts, np.inf)
    total, n_trees = np.zeros(len(ends)), 0
    for _, tree in pdf.groupby("_tree"):
        tree = tree.sort_values("lo")
        total += tree["path"].to_numpy()[np.searchsorted(tree["lo"].to_numpy(), starts, side="right") - 1]
        n_trees += 1
    score = np.power(2.0, -(total / n_trees) / max(_c(psi), 1e-12))
    return pd.DataFrame({"_g": [g], "_ends": [ends], "_scores": [score]})


def _count_places(values: pa.Table, forest: pa.Table) -> pa.Table:
    """Rows of a part of a group in each elementary interval of its forest."""
    if not values.num_rows or not forest.num_rows:
        return pa.table({"_g": pa.array([], pa.string()), "_i": pa.array([], pa.int32()), "_rows": pa.array([], pa.int64())})
    ends = np.asarray(forest["_ends"][0].values)
    place = np.searchsorted(ends, values["_v"].to_numpy(), side="right")
    rows = np.zeros(len(ends), np.int64)
    np.add.at(rows, place, values["_times"].to_numpy())
    held = np.flatnonzero(rows)
    return pa.table({"_g": pa.array([values["_g"][0].as_py()] * len(held), pa.string()),
                     "_i": pa.array(held.astype(np.int32)), "_rows": pa.array(rows[held])})


def _outlier_ranges(forest: pd.DataFrame, counts: pd.DataFrame, contamination: float) -> pd.DataFrame:
    """Ranges of values scored above the (1 - contamination) quantile of the
    scores of the group's rows (interpolated between neighbours)."""
    g = forest["_g"].iloc[0]
    ends, scores = np.asarray(forest["_ends"].iloc[0]), np.asarray(forest["_scores"].iloc[0])
    held = counts.groupby("_i")["_rows"].sum()
    by_score = pd.Series(held.to_numpy(), index=scores[held.index.to_numpy()]).groupby(level=0).sum()
    upto = by_score.cumsum().to_numpy()
    place = (1 - contamination) * (upto[-1] - 1)
    low, high = by_score.index.to_numpy()[np.searchsorted(upto, [math.floor(place), math.ceil(place)], side="right")]
    out = scores > low + (high - low) * (place - math.floor(place))
    edge = np.diff(np.concatenate([[False], out, [False]]).astype(np.int8))
    starts = np.append(-np.inf, ends[:-1])
    ranges = [{"lo": float(starts[i]), "hi": float(ends[j - 1])} for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    return pd.DataFrame({"_g": [g], "_ranges": [ranges]})


def _usable(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def fit_forest(df: DataFrame, target: str, contamination: float = 0.02, group_col: str | None = None, n_trees: int = 100,
               max_samples: int = 256, seed: int = 42, id_cols: list[str] | None = None) -> StatsTable:
    """1-D isolation forests by group (O3): one row a group with the ranges of
    values that are outliers.

    Sampling is by ``xxhash64(seed, tree, row id)``, so the result does not
    depend on partitioning.  The forest of a group is one sorted array (at most
    ``n_trees * max_samples`` ends); the group's distinct values are dealt into
    parts of about ``PART`` and find their interval by binary search, whatever
    their spacing.  A NULL group has no forest; NULL, NaN and infinite targets
    take no part."""
    gcol = F.col(group_col).cast("string") if group_col else F.lit(_ALL)
    rows = df.select(gcol.alias("_g"), F.col(target).cast("double").alias("_v"),
                     F.xxhash64(*[F.col(c) for c in (id_cols or df.columns)]).alias("_rid"))
    rows = rows.where(F.col("_g").isNotNull() & _usable(F.col("_v")))
    sizes = fit_table(rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_gn")), ["_g"])
    sized = rows.join(sizes.joinable(), "_g")
    # a row is in a tree with probability about 4 * psi / n: the input of a tree is bounded
    p = F.least(F.lit(1.0), F.lit(4.0 * max_samples) / F.col("_gn"))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                     lambda t: F.xxhash64(F.lit(seed), t, F.col("_rid")) / F.lit(2.0 ** 64) + 0.5 < p)
    sampled = (sized.select("_g", "_v", "_rid", F.explode(trees).alias("_tree"))
               .select("_g", "_tree", "_v", F.xxhash64(F.lit(seed + 1), F.col("_tree"), F.col("_rid")).alias("_h")))
    leaves = sampled.groupBy("_g", "_tree").applyInPandas(
        lambda pdf: _build_tree(pdf, max_samples, seed), "_g string, _tree int, lo double, hi double, path double")
    psi = sizes.joinable().select("_g", F.least(F.col("_gn"), F.lit(max_samples)).alias("_psi"))
    forest = keep_cached(leaves.join(psi, "_g").groupBy("_g").applyInPandas(
        _merge_trees, "_g string, _ends array<double>, _scores array<double>"))
    parts = F.ceil(F.col("_gn") / PART).cast("int")
    values = (rows.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_times")).join(sizes.joinable(), "_g")
              .select("_g", F.pmod(F.xxhash64("_v"), parts).cast("int").alias("_part"), "_v", "_times"))
    copies = (forest.join(sizes.joinable(), "_g")
              .select("_g", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"), "_ends"))
    counts = (values.groupBy("_g", "_part").cogroup(copies.groupBy("_g", "_part"))
              .applyInArrow(_count_places, "_g string, _i int, _rows long")
              .groupBy("_g", "_i").agg(F.sum("_rows").alias("_rows")))
    ranges = forest.groupBy("_g").cogroup(counts.groupBy("_g")).applyInPandas(
        lambda f, c: _outlier_ranges(f, c, contamination), "_g string, _ranges array<struct<lo: double, hi: double>>")
    return fit_table(ranges, ["_g"])


def apply_forest(df: DataFrame, target: str, fit: StatsTable, group_col: str | None = None, out_col: str = "is_inlier_iso") -> DataFrame:
    """Inlier flag from fitted ranges; every row of ``df`` stays.  Targets that
    are NULL, NaN or infinite, rows of groups without a forest: inliers; rows of
    a NULL group: not, as for the fences."""
    v = F.col(target).cast("double")
    key = F.col(group_col).cast("string") if group_col else F.lit(_ALL)
    out = df.withColumn("_g", key).join(fit.joinable(), "_g", "left")
    hit = F.exists(F.col("_ranges"), lambda r: (v >= r["lo"]) & (v < r["hi"]))
    flag = F.when(F.col("_g").isNull(), F.lit(False)).otherwise(~F.coalesce(_usable(v) & hit, F.lit(False)))
    return out.withColumn(out_col, flag).drop("_g", "_ranges")


def isolation_forest_inliers(df: DataFrame, target: str, contamination: float = 0.02,
                             group_col: str | None = None, n_trees: int = 100,
                             max_samples: int = 256, seed: int = 42, id_cols: list[str] | None = None,
                             out_col: str = "is_inlier_iso") -> DataFrame:
    """Inlier flag from a distributed 1-D isolation forest (O3), fitted on the same rows."""
    fit = fit_forest(df, target, contamination, group_col, n_trees, max_samples, seed, id_cols)
    return apply_forest(df, target, fit, group_col, out_col)


def ensemble_inliers(df: DataFrame, target: str, group_col: str | None = None, min_group_size: int = 30,
                     fallback: str = "skip", iqr_factor: float = 1.5, z_thresh: float = 4.0, contamination: float = 0.02,
                     n_trees: int = 100, seed: int = 42, id_cols: list[str] | None = None, out_col: str = "is_inlier") -> DataFrame:
    """Inlier when two of the IQR fence, the z-score and the isolation forest
    say so; the three votes stay as ``in_iqr``, ``in_z``, ``in_iso``.

    Groups under ``min_group_size`` keep their rows (``skip``) or are judged by
    the statistics and the forest of all rows (``global``)."""
    forest = {"contamination": contamination, "n_trees": n_trees, "seed": seed, "id_cols": id_cols}
    iqr = fit_fences(df, target, "iqr", group_col, min_group_size, fallback, iqr_factor, z_thresh)
    z = fit_fences(df, target, "zscore", group_col, min_group_size, fallback, iqr_factor, z_thresh)
    own = fit_forest(df, target, group_col=group_col, **forest)
    out = apply_forest(apply_fences(apply_fences(df, iqr, "in_iqr"), z, "in_z"), target, own, group_col, "in_iso")
    if group_col:
        out = out.join(iqr.groups.joinable().select(group_col, F.col("_n").alias("_size")), group_col, "left")
        small = F.coalesce(F.col("_size") < min_group_size, F.lit(False))
        if fallback == "global":
            out = apply_forest(out, target, fit_forest(df, target, **forest), None, "_all_iso")
            out = out.withColumn("in_iso", F.when(small, F.col("_all_iso")).otherwise(F.col("in_iso"))).drop("_all_iso")
        else:
            out = out.withColumn("in_iso", small | F.col("in_iso"))
        out = out.drop("_size")
    return out.withColumn(out_col, vote(["in_iqr", "in_z", "in_iso"]))
