"""Sources and sinks (IO1-IO9).

Reads are plain ``spark.read`` calls so Catalyst can prune columns and push
filters into the parquet scan.  Writers are thin wrappers that only validate
arguments; the work is Spark's.
"""
from __future__ import annotations

import json
import os
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_runtime_conf, short_methods

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (IO2: the whole directory/file, not a sample).

    How far a scan is split is the session's business
    (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``)."""
    ensure_runtime_conf(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str,
                   names: Iterable[str] = TABLES) -> None:
    """Expose the tables to ``spark.sql`` under their own names (IO1)."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def read_jdbc_query(spark: SparkSession, url: str, query: str,
                    properties: dict | None = None,
                    partition_column: str | None = None,
                    lower: int | None = None, upper: int | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Read the result of a SQL query from an RDBMS (IO1).

    With ``partition_column`` the read is split into ``num_partitions``
    parallel range queries instead of one connection pulling everything.
    """
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) q")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower))
                  .option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions or 8)))
    else:
        reader = reader.option("query", query)
    return reader.load()


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Load one split of a profile written by :func:`write_profile` (IO3).

    The filter on the partition column prunes whole directories.
    """
    return spark.read.parquet(path).where(F.col("split") == split)


_FORMATS = {"parquet", "csv"}
_COMPRESSION = {"parquet": {"snappy", "gzip", "zstd", "lz4", "none", "uncompressed"},
                "csv": {"gzip", "bzip2", "deflate", "none", "uncompressed"}}


def save_table(df: DataFrame, path: str, fmt: str = "parquet",
               compression: str = "snappy", mode: str = "overwrite",
               partition_by: list[str] | None = None) -> None:
    """Write a table as parquet or CSV; other formats are rejected (IO4, IO9)."""
    if fmt not in _FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; use one of {sorted(_FORMATS)}")
    if compression not in _COMPRESSION[fmt]:
        raise ValueError(f"unsupported compression {compression!r} for {fmt}")
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("header", "true").csv(path)


def write_profile(df: DataFrame, path: str, mode: str = "overwrite", meta: dict | None = None) -> None:
    """Write features, target, original-scale target and group columns of the
    splits in ``df`` in one pass, partitioned by ``split`` (IO5).

    Only the splits that ``df`` holds are replaced (dynamic partition
    overwrite); the others stay as they are.  ``meta`` is written beside them,
    where readers of the table don't look for data."""
    if "split" not in df.columns:
        raise ValueError("profile frame needs a 'split' column")
    with short_methods(df.sparkSession):
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("split").parquet(path)
    if meta is not None:
        write_metadata(df.sparkSession, meta, f"{path}/_meta")


def read_profile(spark: SparkSession, path: str, split: str) -> tuple[DataFrame, dict]:
    """One split of a profile and the metadata written with it (IO3, IO6)."""
    return read_split(spark, path, split), read_metadata(spark, f"{path}/_meta")


def write_metadata(spark: SparkSession, meta: dict, path: str) -> None:
    """Small run metadata (target, transform parameters, feature lists) as a
    one-row JSON table (IO6)."""
    payload = json.dumps(meta, sort_keys=True, default=str)
    spark.createDataFrame([(payload,)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    row = spark.read.text(path).first()
    return json.loads(row[0]) if row else {}


# --------------------------------------------------------------------------
# IO7: catalog extraction
# --------------------------------------------------------------------------

def normalize_type(dtype: T.DataType) -> str:
    """Map a Spark type to the catalog's normalised type names."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.BinaryType):
        return "binary"
    if isinstance(dtype, T.StringType):
        return "nvarchar"
    return "unknown"


def table_alias(name: str) -> str:
    """Alias rule: first letter of each ``_`` part when there are several
    parts, upper-cased; else the first letter."""
    parts = [p for p in name.split("_") if p]
    if len(parts) > 1:
        return "".join(p[0] for p in parts).upper()
    return name[:1].upper()


def extract_catalog(spark: SparkSession, frames: dict[str, DataFrame],
                    kinds: dict[str, str] | None = None,
                    aliases: dict[str, str] | None = None) -> DataFrame:
    """Catalog table ``(table, alias, kind, column, type, retrieve)`` built
    from schemas only -- no data is read."""
    rows = []
    for name, df in frames.items():
        alias = (aliases or {}).get(name) or table_alias(name)
        kind = (kinds or {}).get(name, "table")
        for f in df.schema.fields:
            rows.append((name, alias, kind, f.name, normalize_type(f.dataType), True))
    schema = "table string, alias string, kind string, column string, type string, retrieve boolean"
    return spark.createDataFrame(rows, schema)


def catalog_figures(frames: dict[str, DataFrame]) -> DataFrame:
    """``(table, column, rows, nulls, distinct)`` of every column, by Spark
    aggregates over whole tables; values are told apart by their text (binary
    ones in hex), NULL is no value."""
    out = None
    for name, df in frames.items():
        if not df.columns:
            continue
        # columns are told by number: names may differ in case only
        plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        texts = [(F.hex(f.name) if isinstance(f.dataType, T.BinaryType) else F.to_json(F.struct(f.name))
                  if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name).cast("string"))
                 for f in plain.schema.fields]
        pairs = [F.struct(F.lit(c).alias("column"), F.when(F.col(f.name).isNotNull(), t).alias("v"))
                 for c, f, t in zip(df.columns, plain.schema.fields, texts, strict=True)]
        counted = (plain.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
                   .groupBy("column", "v").agg(F.count("*").alias("n")))
        figures = counted.groupBy("column").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("v").alias("distinct")).select(F.lit(name).alias("table"), "*")
        out = figures if out is None else out.union(figures)
    return out
