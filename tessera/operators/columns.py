"""Column-level cleaning, pruning, coercion and profiling.

Every per-column statistic is computed in one (chunked) aggregation over the
frame; the driver only sees one row of O(columns) numbers.
"""
from __future__ import annotations

import fnmatch
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import numeric_columns, string_columns

MISSING = "__MISSING__"   # fixed value: categorical fill sentinel
CHUNK = 200               # aggregate expressions per job (codegen limits)


def q(c: str):
    return F.col(f"`{c}`")


def wide_agg(df: DataFrame, exprs: list) -> dict:
    """Evaluate many aggregate expressions, ``CHUNK`` per job."""
    out = {}
    for i in range(0, len(exprs), CHUNK):
        out.update(df.agg(*exprs[i:i + CHUNK]).first().asDict())
    return out


def distinct_counts(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, int]:
    """Distinct non-null values per column.

    Many ``count(DISTINCT c)`` in one aggregate make Spark expand every row
    once per column; instead the columns are unpivoted to (column, value)
    text pairs and counted with one grouped aggregation (the pairs are
    de-duplicated map-side).  ``exact=False`` uses HyperLogLog per column.
    """
    if not cols:
        return {}
    if not exact:
        row = wide_agg(df, [F.approx_count_distinct(q(c)).alias(f"d{i}") for i, c in enumerate(cols)])
        return {c: row[f"d{i}"] for i, c in enumerate(cols)}
    long = df.select(*[q(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], cols, "_col", "_val").where(F.col("_val").isNotNull())
    got = {r["_col"]: r["n"] for r in long.groupBy("_col").agg(F.countDistinct("_val").alias("n")).collect()}
    return {c: int(got.get(c, 0)) for c in cols}


# P5 -------------------------------------------------------------------------
def datetimes_to_iso(df: DataFrame) -> DataFrame:
    """Timestamps -> ``yyyy-MM-dd'T'HH:mm:ss``; dates -> ``yyyy-MM-dd``."""
    new = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            new[f.name] = F.date_format(q(f.name), "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            new[f.name] = F.date_format(q(f.name), "yyyy-MM-dd")
    return df.withColumns(new) if new else df


# P6, P13, P17 ---------------------------------------------------------------
def column_null_stats(df: DataFrame, cols: list[str] | None = None) -> dict:
    cols = cols or df.columns
    exprs = [F.count(q(c)).alias(f"nn{i}") for i, c in enumerate(cols)]
    exprs.append(F.count(F.lit(1)).alias("_rows"))
    row = wide_agg(df, exprs)
    nd = distinct_counts(df, cols)
    n = row["_rows"]
    return {c: {"non_null": row[f"nn{i}"], "distinct": nd[c], "rows": n}
            for i, c in enumerate(cols)}


def all_null_columns(df: DataFrame) -> list[str]:
    row = wide_agg(df, [F.count(q(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"] == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


def drop_configured(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop listed columns that exist; absent names are ignored."""
    return df.drop(*[c for c in names if c in df.columns])


def non_descriptive_columns(train: DataFrame, na_threshold: float = 0.98,
                            cols: list[str] | None = None) -> list[str]:
    """Constant columns (NULL counts as a value) or NULL share > threshold.

    Fitted on train; the caller drops the same columns from every split.
    """
    cols = cols or train.columns
    # a least value that is not the greatest one settles it; the others' values are counted
    plain = (T.NumericType, T.StringType, T.DateType, T.BooleanType)
    exprs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        exprs.append(F.count(q(c)).alias(f"nn{i}"))
        if isinstance(train.schema[c].dataType, plain):
            exprs.append((F.min(q(c)) != F.max(q(c))).alias(f"several{i}"))
    row = wide_agg(train, exprs)
    few = distinct_counts(train, [c for i, c in enumerate(cols) if not row.get(f"several{i}")])
    n = row["_rows"]
    drop = []
    for i, c in enumerate(cols):
        n_unique = few[c] + (1 if row[f"nn{i}"] < n else 0) if c in few else 2
        na_frac = 1 - row[f"nn{i}"] / n if n else 0.0
        if n_unique <= 1 or na_frac > na_threshold:
            drop.append(c)
    return drop


# P17 ------------------------------------------------------------------------
def extreme_cardinality_columns(train: DataFrame, max_distinct: int = 500, exact: bool = True) -> list[str]:
    cols = string_columns(train)
    nd = distinct_counts(train, cols, exact)
    return [c for c in cols if nd[c] > max_distinct]


# P8 -------------------------------------------------------------------------
def leading_number(c: str):
    """First run of digits as a double (house number ``12B`` -> 12)."""
    return F.nullif(F.regexp_extract(q(c), r"(\d+)", 1), F.lit("")).try_cast("double")


# P10 ------------------------------------------------------------------------
def choose_target(df: DataFrame, candidates: list[str]) -> str:
    for c in candidates:
        if c in df.columns:
            return c
    hints = [c for c in df.columns if any(k.lower() in c.lower() for k in ("prezzo", "price", "target"))]
    raise ValueError(f"no target column among {candidates}; similar columns: {hints}")


# P11 ------------------------------------------------------------------------
def missing_pattern_flags(df: DataFrame, prefixes: list[str], template: str = "has_{prefix}") -> DataFrame:
    """1 when ANY column with the prefix is non-NULL in the row, else 0."""
    new = {}
    for p in prefixes:
        cols = [c for c in df.columns if c.startswith(p)]
        if not cols:
            continue
        any_val = F.coalesce(*[q(c).cast("string") for c in cols]).isNotNull()
        new[template.format(prefix=p.rstrip("_"))] = any_val.cast("int")
    return df.withColumns(new) if new else df


# P14, P15 -------------------------------------------------------------------
def _shifted(m: tuple, delta: np.ndarray) -> tuple:
    """Pairwise moments after every value of column i grew by delta[i]."""
    n, s, q2, p = m
    d = delta[:, None]
    return (n, s + n * d, q2 + 2 * d * s + n * d * d, p + d.T * s + d * s.T + n * d * d.T)


def _merged(parts: list[tuple[np.ndarray, tuple]]) -> tuple[np.ndarray, tuple] | None:
    """Moments about one shift from moments about several."""
    out = None
    for shift, m in parts:
        if out is None:
            out = (shift, m)
        else:
            out = (out[0], tuple(a + b for a, b in zip(out[1], _shifted(m, shift - out[0]), strict=True)))
    return out


def pair_moments(df: DataFrame, cols: list[str], buckets: int = 64) -> tuple[np.ndarray, ...]:
    """(n, sum x, sum x^2, sum xy) over the rows where both columns have a value,
    for all pairs of columns in one scan; entry [i, j] is of column i.

    Every task adds up d x d matrices under presence masks, about means of its
    own first rows; parts meet by bucket and then in one task, so what reaches
    the driver depends on the number of columns only.  NaN counts as missing.
    """
    d = len(cols)
    ddl = "bucket int, part binary"

    def pack(shift: np.ndarray, m: tuple) -> bytes:
        return np.concatenate((shift, *[x.ravel() for x in m])).tobytes()

    def unpack(raw: bytes) -> tuple[np.ndarray, tuple]:
        flat = np.frombuffer(raw)
        return flat[:d], tuple(flat[d:].reshape(4, d, d))

    def moments(batches):
        import pandas as pd
        from pyspark import TaskContext
        shift, total = None, None
        for pdf in batches:
            x = pdf.to_numpy(dtype=float, na_value=np.nan)
            here = ~np.isnan(x)
            if shift is None:
                shift = np.divide(np.where(here, x, 0.0).sum(axis=0), np.maximum(here.sum(axis=0), 1))
            x = np.where(here, x - shift, 0.0)
            m = here.astype(float)
            part = (m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x)
            total = part if total is None else tuple(a + b for a, b in zip(total, part, strict=True))
        if total is not None:
            yield pd.DataFrame({"bucket": [TaskContext.get().partitionId() % buckets], "part": [pack(shift, total)]})

    def add(pdf):
        out = pdf.iloc[:1].copy()
        out["part"] = [pack(*_merged([unpack(p) for p in pdf["part"]]))]
        return out

    plain = df.select(*[q(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = plain.mapInPandas(moments, ddl).groupBy("bucket").applyInPandas(add, ddl)
    found = parts.withColumn("bucket", F.lit(0)).groupBy("bucket").applyInPandas(add, ddl).first()
    return unpack(found["part"])[1] if found else tuple(np.zeros((4, d, d)))


def correlation_matrix(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pairwise-complete Pearson correlations; NaN where a column is constant
    or fewer than two rows have both values."""
    n, s, q2, p = pair_moments(df, cols)
    with np.errstate(all="ignore"):
        cov = n * p - s * s.T
        var = n * q2 - s * s
        var = np.where(var > 1e-12 * n * q2, var, np.nan)
        return np.clip(cov / np.sqrt(var * var.T), -1.0, 1.0)


def correlation_pairs(df: DataFrame, cols: list[str]) -> dict[tuple[str, str], float | None]:
    """Pairwise-complete Pearson correlation of every pair, from one scan."""
    if len(cols) < 2:
        return {}
    r = correlation_matrix(df, cols)
    return {(a, b): None if np.isnan(r[i, j]) else float(r[i, j])
            for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j}


def correlated_to_drop(df: DataFrame, threshold: float = 0.98, cols: list[str] | None = None,
                       exempt: tuple = ()) -> list[str]:
    """Column j is dropped when any earlier column i has |r| > threshold
    (an earlier column counts even if it is itself dropped)."""
    cols = [c for c in (cols or numeric_columns(df)) if c not in exempt]
    r = correlation_pairs(df, cols)
    drop = []
    for j, b in enumerate(cols):
        for a in cols[:j]:
            v = r.get((a, b))
            if v is not None and v == v and abs(v) > threshold:
                drop.append(b)
                break
    return drop


# P16, T7 --------------------------------------------------------------------
def blacklisted(name: str, globs: list[str]) -> bool:
    up = name.upper()
    return any(fnmatch.fnmatch(up, g.upper()) for g in globs)


def numeric_like(c: str):
    # a failed cast costs an exception: only text that begins like a number, inf or nan is tried
    like = q(c).rlike(r"(?i)^[\x00-\x20]*[+-]?(inf|nan|[0-9.,])")
    return F.nanvl(F.when(like, F.translate(q(c), ",", ".").try_cast("double")), F.lit(None).cast("double"))


def coercible_columns(train: DataFrame, threshold: float = 0.95, blacklist: list[str] = ()) -> list[str]:
    """String columns whose values parse as numbers on >= threshold of ALL
    train rows (NULLs count as failures)."""
    cols = [c for c in string_columns(train) if not blacklisted(c, list(blacklist))]
    if not cols:
        return []
    row = wide_agg(train, [F.avg(numeric_like(c).isNotNull().cast("double")).alias(f"p{i}")
                           for i, c in enumerate(cols)])
    return [c for i, c in enumerate(cols) if (row[f"p{i}"] or 0) >= threshold]


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: numeric_like(c) for c in cols}) if cols else df


# P18, P19, P22 --------------------------------------------------------------
def final_fill(df: DataFrame, numeric_value=0, text_value: str = MISSING) -> DataFrame:
    nums, strs = numeric_columns(df), string_columns(df)
    if nums:
        df = df.na.fill(numeric_value, nums)
    if strs:
        df = df.na.fill(text_value, strs)
    return df


def align_columns(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Select ``columns`` in order; missing ones are created with ``fill``."""
    return df.select(*[q(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def numeric_projection(df: DataFrame, keep: tuple = ()) -> DataFrame:
    cols = numeric_columns(df)
    out = df.select(*[q(c) for c in cols], *[q(c) for c in keep if c not in cols])
    return out.na.fill(0, cols)


# P20 ------------------------------------------------------------------------
def downcast_plan(df: DataFrame) -> dict[str, str]:
    """Smallest integer type that holds each integer column's [min, max];
    doubles whose values are all whole numbers in int range become int."""
    cols = numeric_columns(df)
    exprs = []
    for i, c in enumerate(cols):
        exprs += [F.min(q(c)).alias(f"a{i}"), F.max(q(c)).alias(f"b{i}")]
        if not isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            exprs.append(F.max((q(c) != F.floor(q(c))).cast("int")).alias(f"f{i}"))
    row = wide_agg(df, exprs)
    plan = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"a{i}"], row[f"b{i}"]
        if lo is None:
            continue
        is_int = isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        if not is_int and row.get(f"f{i}"):
            plan[c] = "double"
            continue
        for name, (mn, mx) in (("tinyint", (-128, 127)), ("smallint", (-32768, 32767)),
                               ("int", (-2**31, 2**31 - 1))):
            if mn <= lo and hi <= mx:
                plan[c] = name
                break
        else:
            plan[c] = "bigint"
    return plan


def apply_downcast(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    return df.withColumns({c: q(c).cast(t) for c, t in plan.items()})


# P21, A25, A29 --------------------------------------------------------------
def dataset_summary(df: DataFrame) -> DataFrame:
    """One row for the table (A29): rows, columns by kind, missing values (NULL
    or NaN) and their share of all cells in %, NULL for an empty table.  One
    aggregation with a sum per column; the types come from the schema."""
    kinds = [f.dataType for f in df.schema.fields]
    numeric = sum(isinstance(t, T.NumericType) for t in kinds)
    text = sum(isinstance(t, T.StringType) for t in kinds)
    dated = sum(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in kinds)
    missing = F.lit(0).cast("long")
    for f in df.schema.fields:
        absent = q(f.name).isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            absent = absent | F.isnan(q(f.name))
        missing = missing + F.count_if(absent)
    return (df.agg(F.count(F.lit(1)).alias("n_rows"), missing.alias("total_missing"))
            .select("n_rows", F.lit(len(kinds)).cast("long").alias("n_columns"), F.lit(numeric).cast("long").alias("n_numeric"),
                    F.lit(text).cast("long").alias("n_categorical"), F.lit(dated).cast("long").alias("n_datetime"), "total_missing",
                    F.try_divide(F.col("total_missing") * 100.0, F.col("n_rows") * F.lit(len(kinds))).alias("missing_pct")))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null count, NULL %, distinct count and
    the first non-null value (as text).  One aggregation, then unpivot."""
    spark = df.sparkSession
    cols = df.columns
    exprs = [F.count(F.lit(1)).alias("_rows")]
    nd = distinct_counts(df, cols)
    for i, c in enumerate(cols):
        exprs += [F.count(q(c)).alias(f"nn{i}"), F.lit(nd[c]).cast("long").alias(f"nd{i}"),
                  F.first(q(c).cast("string"), ignorenulls=True).alias(f"fs{i}")]
    # The aggregated row stays on the executors: build the long form with a
    # stack over the single-row result.
    agg = df.agg(*exprs)
    stack_args = []
    for i, c in enumerate(cols):
        stack_args += [F.lit(c), F.lit(df.schema[c].dataType.simpleString()),
                       F.col(f"nn{i}"), F.col(f"nd{i}"), F.col(f"fs{i}")]
    n = len(cols)
    long = agg.select(F.col("_rows"), F.inline(F.array(*[
        F.struct(stack_args[5 * i].alias("column"), stack_args[5 * i + 1].alias("dtype"),
                 stack_args[5 * i + 2].alias("non_null"), stack_args[5 * i + 3].alias("n_distinct"),
                 stack_args[5 * i + 4].alias("sample")) for i in range(n)])))
    del spark
    return long.select("column", "dtype", "non_null",
                       (F.col("_rows") - F.col("non_null")).alias("n_missing"),
                       F.round(F.try_divide((F.col("_rows") - F.col("non_null")) * 100.0, F.col("_rows")), 4)
                       .alias("missing_pct"),
                       "n_distinct", "sample")


# T8 -------------------------------------------------------------------------
_ALLOWED = re.compile(r"^[\w\s\-.%€²³()/°]+$", re.UNICODE)
_BANNED = ("--", ";", "/*", "*/", "\n", "\r", "\x00")


def check_column_name(name: str) -> bool:
    """Accept letters (any script), digits, spaces and a few symbols; reject
    statement separators, comment markers and control characters."""
    if not name or any(b in name for b in _BANNED):
        return False
    return bool(_ALLOWED.match(name))


def safe_alias(name: str) -> str:
    return re.sub(r"[^\w]", "_", name)
