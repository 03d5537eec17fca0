"""Leak-free contextual statistics (X1 = A2-A7 + J11/J12 + M9-M11).

``fit_contextual`` aggregates the *train* rows only; ``transform_contextual``
attaches the statistics to any split with left lookups, so unseen groups keep
their rows and get NULL statistics.  No target-derived per-row feature (price
per m2, price vs zone mean, ...) is produced.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import EPS, months_between_periods, period_key, quarter
from .lookup import StatsTable, attach, fit_table
from .quantiles import group_key, long_quantiles
from .ranking import global_positions


def _q(c: str, p: float, exact: bool):
    return F.percentile(c, p) if exact else F.percentile_approx(c, p, 10000)


def _median(c: str, exact: bool):
    return F.median(c) if exact else F.percentile_approx(c, 0.5, 10000)


@dataclass
class ContextualStats:
    tables: dict = field(default_factory=dict)
    min_period: int | None = None
    cols: dict = field(default_factory=dict)


def fit_contextual(train: DataFrame, target: str, zone: str, type_: str,
                   surface: str | None = None, year: str | None = None,
                   month: str | None = None, category: str | None = None,
                   exact: bool = True) -> ContextualStats:
    """Fit all statistic tables on the training rows in ONE aggregation.

    ``GROUPING SETS`` over (zone), (type, zone), (type), (period) and
    (category) scans the training rows once (Expand + partial aggregation);
    the small result is cached and split into the per-key tables.
    """
    st = ContextualStats(cols=dict(target=target, zone=zone, type=type_, surface=surface,
                                   year=year, month=month, category=category))
    t = target
    keyed = train
    keys = [zone, type_]
    sets = [[zone], [type_, zone], [type_]]
    if year and month:
        keyed = keyed.withColumn("year_month", period_key(year, month))
        keys.append("year_month")
        sets.append(["year_month"])
    if category and surface:
        keyed = keyed.withColumn("_cat", F.col(category).cast("string"))
        keys.append("_cat")
        sets.append(["_cat"])
    aggs = [F.avg(t).alias("_mean"), F.stddev_samp(t).alias("_std"),
            F.min(t).alias("_min"), F.max(t).alias("_max"), F.count(t).alias("_count")]
    if surface:
        aggs.append(F.avg(surface).alias("_smean"))
    aggs += [F.grouping(k).alias(f"_g_{i}") for i, k in enumerate(keys)]
    if not exact:
        aggs += [_median(t, False).alias("_median"), _q(t, 0.25, False).alias("_q25"),
                 _q(t, 0.75, False).alias("_q75")]
        if surface:
            aggs.append(_median(surface, False).alias("_smedian"))
    combined = fit_table(keyed.groupingSets(sets, *keys).agg(*aggs), [], drop_null_keys=False)
    cdf = combined.df
    if exact:
        # exact quantiles of every grouping set in one range-partitioned ranking
        specs = [(g, t) for g in sets if g != ["_cat"]]
        if surface:
            specs.append(([zone], surface))
        qs = long_quantiles(keyed, specs, [0.25, 0.5, 0.75], ["_q25", "_median", "_q75"])
        qs = fit_table(qs, ["_spec", "_key"])
        qdf = qs.df
    else:
        qdf = None

    def part(grouped: list[str], cols: dict) -> StatsTable:
        cond = None
        for i, k in enumerate(keys):
            c = F.col(f"_g_{i}") == (0 if k in grouped else 1)
            cond = c if cond is None else cond & c
        for k in grouped:
            cond = cond & F.col(k).isNotNull()
        df = cdf.where(cond)
        if qdf is not None and grouped != ["_cat"]:
            spec = specs.index((grouped, t))
            q = qdf.where(F.col("_spec") == spec).select("_key", "_q25", "_median", "_q75")
            df = df.withColumn("_key", group_key(grouped)).join(q, "_key", "left")
            if grouped == [zone] and surface:
                sq = qdf.where(F.col("_spec") == len(specs) - 1).select(
                    "_key", F.col("_median").alias("_smedian"))
                df = df.join(sq, "_key", "left")
        df = df.select(*grouped, *[F.col(src).alias(dst) for dst, src in cols.items()]).cache()
        return StatsTable(df, df.count(), tuple(grouped))

    zcols = {"zone_price_mean": "_mean", "zone_price_median": "_median", "zone_price_std": "_std",
             "zone_price_min": "_min", "zone_price_max": "_max", "zone_price_q25": "_q25",
             "zone_price_q75": "_q75", "zone_count": "_count"}
    if surface:
        zcols.update({"zone_surface_mean": "_smean", "zone_surface_median": "_smedian"})
    st.tables["zone"] = part([zone], zcols)
    tz = {"type_zone_price_mean": "_mean", "type_zone_price_median": "_median",
          "type_zone_price_std": "_std", "type_zone_count": "_count"}
    if surface:
        tz["type_zone_surface_mean"] = "_smean"
    st.tables["type_zone"] = part([type_, zone], tz)
    st.tables["type"] = part([type_], {"type_price_mean": "_mean", "type_price_median": "_median"})
    if year and month:
        st.tables["period"] = part(["year_month"], {"temporal_price_mean": "_mean",
                                                    "temporal_price_median": "_median",
                                                    "temporal_count": "_count"})
        st.min_period = st.tables["period"].df.agg(F.min("year_month")).first()[0]
    if category and surface:
        cats = part(["_cat"], {}).df
        codes = global_positions(cats, ["_cat"], "_cat_code").withColumn("_cat_code", F.col("_cat_code").cast("int"))
        st.tables["category"] = StatsTable(codes, cats.count(), ("_cat",))
    return st


def transform_contextual(df: DataFrame, st: ContextualStats) -> DataFrame:
    c = st.cols
    surface = c.get("surface")
    out = attach(df, st.tables["zone"])
    if surface:
        out = out.withColumn("surface_vs_zone_mean",
                             F.col(surface) / (F.col("zone_surface_mean") + EPS))
    out = attach(out, st.tables["type_zone"])
    out = out.withColumn("type_zone_rarity", 1.0 / (F.col("type_zone_count") + 1))
    out = attach(out, st.tables["type"])
    if surface:
        out = out.withColumn("surface_vs_type_zone_mean",
                             F.col(surface) / (F.col("type_zone_surface_mean") + EPS))
        out = out.withColumn("log_surface", F.log1p(surface))
    if "category" in st.tables:
        out = (out.withColumn("_cat", F.col(c["category"]).cast("string"))
               .join(st.tables["category"].joinable(), "_cat", "left")
               .withColumn("surface_x_category", F.col(surface) * F.col("_cat_code"))
               .drop("_cat", "_cat_code"))
    if "period" in st.tables:
        out = out.withColumn("year_month", period_key(c["year"], c["month"]))
        out = attach(out, st.tables["period"])
        out = out.withColumn("quarter", quarter(c["month"]))
        out = out.withColumn("months_from_start",
                             months_between_periods("year_month", F.lit(st.min_period)))
    return out


def fit_transform_contextual(df: DataFrame, split_col: str = "split", persist: bool = False,
                             **kw) -> tuple[DataFrame, ContextualStats]:
    """Fit on ``split == 'train'`` and transform every split.

    The input is read twice (fit, transform); with ``persist`` it is kept
    once (memory, spilling to disk) instead of recomputing its lineage --
    typically a multi-way join.  A lost block is recomputed from lineage.
    """
    if persist and not df.is_cached:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    st = fit_contextual(df.where(F.col(split_col) == "train"), **kw)
    return transform_contextual(df, st), st
