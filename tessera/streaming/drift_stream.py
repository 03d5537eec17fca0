"""Structured Streaming drift monitor.

The ``events`` table is read as a file stream; every event is binned on the
deciles of a *batch* baseline (the first ``baseline_days`` days, exact
quantiles from :mod:`tessera.operators.quantiles`), and a 1-day tumbling
window counts events per bin.  Each micro-batch (``foreachBatch``) turns the
window/bin counts into a population stability index per day and writes the
result table to the shared checkpoint folder.  State is the per-(day, bin)
count only, so it grows with days x bins, not with events; the output mode is
``complete``, so the counts of all days stay in it and every batch rewrites the
whole result.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import column_quantiles
from ..session import checkpoint_dir, scratch_path
from ..sources.tables import table


def _bin(edges: list[float]):
    k = len(edges) - 1
    e = F.array(*[F.lit(x) for x in edges])
    idx = F.size(F.filter(e, lambda x: x <= F.col("value"))) - 1
    return F.when((F.col("value") < edges[0]) | (F.col("value") > edges[-1]),
                  F.lit(None)).otherwise(F.least(idx, F.lit(k - 1))).cast("int")


def baseline(spark: SparkSession, sf_dir: str, baseline_days: int = 7, bins: int = 10):
    """Decile edges of ``value`` over the first days (exact, de-duplicated)
    and the baseline share of each bin (k numbers)."""
    ev = table(spark, sf_dir, "events")
    start = ev.agg(F.min("ts")).first()[0]
    base = ev.where(F.col("ts") < F.lit(start) + F.expr(f"INTERVAL {baseline_days} DAYS")) \
        .where(F.col("value").isNotNull())
    qs = [i / bins for i in range(bins + 1)]
    edges = sorted(set(column_quantiles(base, ["value"], qs)["value"]))
    k = len(edges) - 1
    counts = {r["bin"]: r["n"] for r in base.withColumn("bin", _bin(edges)).groupBy("bin")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    return edges, [counts.get(i, 0) / n for i in range(k)]


def _psi_per_day(counts: DataFrame, shares: list[float]) -> DataFrame:
    """counts: (day, bin, n) for in-range events plus (day, -1, n) for all
    events of the day.  Every (day, bin) pair is generated with a sequence,
    empty shares count as 1e-4."""
    k = len(shares)
    tot = counts.where(F.col("bin") == -1).select("day", F.col("n").alias("n_day"))
    per = counts.where(F.col("bin") >= 0)
    allbins = tot.select("day", "n_day", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("bin"))
    j = allbins.join(per, ["day", "bin"], "left").na.fill(0, ["n"])
    act = F.col("n") / F.col("n_day")
    act = F.when(act == 0, F.lit(1e-4)).otherwise(act)
    exp = F.element_at(F.array(*[F.lit(x if x > 0 else 1e-4) for x in shares]), F.col("bin") + 1)
    return j.groupBy("day").agg(F.first("n_day").alias("n_events"),
                                F.abs(F.sum((act - exp) * F.log(act / exp))).alias("psi"))


def run_daily_drift(spark: SparkSession, sf_dir: str, baseline_days: int = 7,
                    watermark: str = "2 days") -> DataFrame:
    """Run the stream over all available files (``availableNow``) and return
    the per-day PSI table that the sink wrote."""
    edges, shares = baseline(spark, sf_dir, baseline_days)
    schema = table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir))
    # event time must be a (zoned) timestamp for the watermark; day windows are
    # UTC days, so the zone-free clock is read as UTC whatever the session's zone
    binned = stream.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())).withColumn("bin", _bin(edges))
    # one row per event for the day total (bin -1) and one for its bin
    exploded = binned.withColumn("bin", F.explode(F.array(F.lit(-1), F.col("bin")))).where(F.col("bin").isNotNull())
    counts = (exploded.withWatermark("ts", watermark)
              .groupBy(F.window("ts", "1 day").alias("w"), "bin")
              .agg(F.count(F.lit(1)).alias("n")))
    out_path = scratch_path(spark, f"stream-drift-{uuid.uuid4().hex}")

    def sink(batch: DataFrame, _epoch: int) -> None:
        flat = batch.select(F.date_format(F.to_utc_timestamp("w.start", F.current_timezone()), "yyyy-MM-dd").alias("day"), "bin", "n")
        _psi_per_day(flat, shares).write.mode("overwrite").parquet(out_path)

    q = (counts.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
