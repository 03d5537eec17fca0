"""Row filters.

Range and list predicates are plain ``where`` clauses, so Catalyst pushes
them into the parquet scan.  A value of 0/None means "filter off", as in the
configuration files of the reference.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_table
from .quantiles import column_quantiles


def range_filter(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """``{column: (min, max)}``; a falsy bound is ignored; NULLs drop out."""
    for c, (lo, hi) in ranges.items():
        if c not in df.columns:
            continue
        if lo:
            df = df.where(F.col(c) >= F.lit(lo))
        if hi:
            df = df.where(F.col(c) <= F.lit(hi))
    return df


def include_filter(df: DataFrame, column: str, values: list | None) -> DataFrame:
    if values and column in df.columns:
        df = df.where(F.col(column).cast("string").isin([str(v) for v in values]))
    return df


def exclude_filter(df: DataFrame, column: str, values: list | None) -> DataFrame:
    """Drop listed values; rows with a NULL value are kept (list semantics,
    not SQL three-valued ``NOT IN``).  Compared as text."""
    if values and column in df.columns:
        hit = F.coalesce(F.col(column).cast("string").isin([str(v) for v in values]), F.lit(False))
        df = df.where(~hit)
    return df


def missing_ratio(cols: list[str]) -> Column:
    """Share of NULL cells in a row over ``cols``."""
    n = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in cols])
    return n / F.lit(len(cols))


def max_missing_filter(df: DataFrame, threshold: float | None) -> DataFrame:
    if threshold:
        df = df.where(missing_ratio(df.columns) <= threshold)
    return df


def iqr_bounds(df: DataFrame, column: str, factor: float = 1.5, exact: bool = True) -> tuple[float, float]:
    """Global fences ``[q1 - f*iqr, q3 + f*iqr]`` from one aggregation."""
    if exact:
        q1, q3 = column_quantiles(df, [column], [0.25, 0.75])[column]
    else:
        q1, q3 = df.agg(F.percentile_approx(column, [0.25, 0.75], 10000).alias("q")).first()["q"]
    if q1 is None or q3 is None:
        return None, None
    iqr = q3 - q1
    return q1 - factor * iqr, q3 + factor * iqr


def iqr_filter(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    lo, hi = iqr_bounds(df, column, factor)
    if lo is None:  # no value to fence
        return df.where(F.lit(False))
    return df.where((F.col(column) >= lo) & (F.col(column) <= hi))


def apply_data_filters(df: DataFrame, cfg: dict) -> DataFrame:
    """F1-F4 in the reference's order: ranges, include/exclude lists,
    missing-ratio, then a global IQR fence on the target.  The fence takes several
    passes: the rows that the other filters leave are written once for them."""
    df = range_filter(df, cfg.get("ranges", {}))
    for c, vals in cfg.get("include", {}).items():
        df = include_filter(df, c, vals)
    for c, vals in cfg.get("exclude", {}).items():
        df = exclude_filter(df, c, vals)
    df = max_missing_filter(df, cfg.get("max_missing_ratio"))
    if cfg.get("iqr_column"):
        df = iqr_filter(cut_table(df, "filtered")[0], cfg["iqr_column"], cfg.get("iqr_factor", 1.5))
    return df


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    """rows with NULL truth, prediction or group are not scored."""
    return df.dropna(subset=cols)
