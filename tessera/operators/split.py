"""Temporal splits.

The result is one DataFrame with a ``split`` column ("train" / "val" /
"test") instead of three copies of the data.

Fraction mode orders rows by period and then by a unique tie-break (the
reference's sort is unstable; we make it deterministic).  Only the periods
that contain a cut need row positions: every other period is labelled as a
whole from a per-period count table (one row per period).  The boundary
periods are ranked with :func:`global_positions`, which range-partitions
rows, so even a period holding a third of the data is spread over tasks.
"""
from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import period_key
from .ranking import global_positions

TRAIN, VAL, TEST = "train", "val", "test"


def _period_counts(df: DataFrame, key: str) -> list[tuple[int, int]]:
    # One row per period: metadata-sized, like a partitioner's sample.
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key).collect()
    return [(r[0], r[1]) for r in rows]


def _label_by_position(df: DataFrame, key: str, order_cols: list,
                       cuts, labels: list[str], counts=None) -> DataFrame:
    """Label rows by their position in (key, order_cols) order.

    ``cuts`` are increasing positions; rows before cuts[0] get labels[0],
    rows in [cuts[i-1], cuts[i]) get labels[i], the rest labels[-1].
    """
    spark = df.sparkSession
    counts = counts if counts is not None else _period_counts(df, key)
    if callable(cuts):
        cuts = cuts(sum(n for _, n in counts))
    start, spans = 0, []
    for p, n in counts:
        spans.append((p, start, start + n))
        start += n

    def label_of(pos: int) -> str:
        for c, lab in zip(cuts, labels):
            if pos < c:
                return lab
        return labels[-1]

    whole, boundary, bstart = [], [], 0
    for p, s, e in spans:
        if e == s:
            continue
        first, last = label_of(s), label_of(e - 1)
        if first == last:
            whole.append((p, first))
        else:
            # position within the boundary subset -> global position
            boundary.append((p, s - bstart))
            bstart += e - s
    key_type = df.schema[key].dataType.simpleString()
    out = None
    if whole:
        wmap = spark.createDataFrame(whole, f"{key} {key_type}, split string")
        out = df.join(F.broadcast(wmap), key, "inner")
    if boundary:
        bmap = spark.createDataFrame(boundary, f"{key} {key_type}, _delta long")
        brows = df.join(F.broadcast(bmap), key, "inner")
        brows = global_positions(brows, [key] + list(order_cols), "_bpos")
        pos = F.col("_bpos") + F.col("_delta")
        lab = F.lit(labels[-1])
        for c, lb in reversed(list(zip(cuts, labels))):
            lab = F.when(pos < c, F.lit(lb)).otherwise(lab)
        brows = brows.withColumn("split", lab).drop("_bpos", "_delta")
        out = brows if out is None else out.unionByName(brows)
    if out is None:
        out = df.withColumn("split", F.lit(None).cast("string")).limit(0)
    return out


def temporal_split(df: DataFrame, year_col: str, month_col: str,
                   order_cols: list, train_fraction: float = 0.8,
                   valid_fraction: float = 0.0, mode: str = "fraction",
                   test_start: tuple[int, int] | None = None,
                   key_col: str = "_period", persist: bool = True) -> DataFrame:
    """Split rows into train / (val) / test by time.

    * ``fraction``: first floor(f*n) rows in period order are train; with a
      validation share the counts are clamped to leave at least one row in
      each part.
    * ``date``: rows before ``test_start`` (year, month) are train; with a
      validation share the last floor(v*n) pre-threshold rows (at least 1,
      at most n-1) become validation.
    """
    keyed = df.withColumn(key_col, period_key(year_col, month_col))
    if persist and not df.is_cached:
        # read up to three times (period counts, boundary ranking, labelling):
        # keep it once instead of recomputing its lineage (often a join chain)
        keyed = keyed.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "fraction":
        # n comes from the per-period counts: no separate count job
        if valid_fraction <= 0:
            out = _label_by_position(keyed, key_col, order_cols,
                                     lambda n: [int(math.floor(train_fraction * n))], [TRAIN, TEST])
        else:
            def cuts(n):
                n_train = int(math.floor(train_fraction * n))
                n_val = int(math.floor(valid_fraction * n))
                n_train = max(1, min(n - 2, n_train))
                n_val = max(1, min(n - n_train - 1, n_val))
                return [n_train, n_train + n_val]
            out = _label_by_position(keyed, key_col, order_cols, cuts, [TRAIN, VAL, TEST])
    elif mode == "date":
        if test_start is None:
            raise ValueError("date mode needs test_start=(year, month)")
        threshold = test_start[0] * 100 + test_start[1]
        pre = keyed.where(F.col(key_col) < threshold)
        post = keyed.where(F.col(key_col) >= threshold).withColumn("split", F.lit(TEST))
        if valid_fraction <= 0:
            out = pre.withColumn("split", F.lit(TRAIN)).unionByName(post)
        else:
            counts = _period_counts(pre, key_col)
            n = sum(c for _, c in counts)
            if n == 0:
                out = post
            else:
                n_val = max(1, min(n - 1, int(math.floor(valid_fraction * n))))
                labelled = _label_by_position(pre, key_col, order_cols, [n - n_val], [TRAIN, VAL], counts)
                out = labelled.unionByName(post)
    else:
        raise ValueError(f"unknown split mode {mode!r}")
    return out


def split_overlap(df: DataFrame, key_col: str = "_period") -> DataFrame:
    """Per split: rows and period range, and whether the split reaches into the
    first test period (W4).  One row a split, so the last step is tiny."""
    per = df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                  F.min(key_col).alias("min_period"),
                                  F.max(key_col).alias("max_period"))
    test = per.where(F.col("split") == "test").select(F.col("min_period").alias("_test_from"))
    return (per.join(F.broadcast(test), F.lit(True), "left")
            .withColumn("overlaps_test", (F.col("split") != "test") & F.coalesce(F.col("max_period") >= F.col("_test_from"), F.lit(False)))
            .drop("_test_from"))


def chronological_holdout(df: DataFrame, order_cols: list, fraction: float,
                          label_col: str = "is_holdout") -> DataFrame:
    """First ``fraction`` of rows (by order) fit, the rest validate."""
    n = df.count()
    cut = int(math.floor(fraction * n))
    ranked = global_positions(df, order_cols, "_hpos")
    return ranked.withColumn(label_col, F.col("_hpos") >= cut).drop("_hpos")


def fold_ids(df: DataFrame, k: int, mode: str = "expanding", order_cols=None,
             seed: int = 42, id_cols=None, fold_col: str = "fold") -> DataFrame:
    """Fold column for cross-validation.

    * ``expanding``: the ordered rows are cut into k+1 equal blocks; block i
      (i >= 1) is the validation fold i-1 of a time-series CV; block 0 only
      trains.  Fold value = block index - 1 (-1 = always train).
    * ``kfold``: ``pmod(xxhash64(seed, ids), k)``, independent of partitioning.
    """
    if mode == "kfold":
        ids = [F.col(c) for c in (id_cols or df.columns)]
        return df.withColumn(fold_col, F.pmod(F.xxhash64(F.lit(seed), *ids), F.lit(k)).cast("int"))
    n = df.count()
    ranked = global_positions(df, order_cols, "_fpos")
    block = F.floor(F.col("_fpos") * (k + 1) / F.lit(max(n, 1)))
    return ranked.withColumn(fold_col, (block - 1).cast("int")).drop("_fpos")
