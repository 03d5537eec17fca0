"""Queries: filters, column cleaning, text/WKT/JSON features, target
transforms, outliers, imputation, encoders, scaling, pruning.

Fit-on-train operators use the date split ``year < 2000`` as the training
rows and apply the fitted state to every row.  NULLs are injected with
fixed key rules where an operator's NULL handling is the point.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import wkt
from ..functions.exprs import period_key, rnd
from ..operators import columns as cl
from ..operators import encode as en
from ..operators import filters as fl
from ..operators import outliers as ol
from ..operators import scale as sc
from ..operators.impute import fit_imputer, transform_imputer
from ..operators.target import TargetTransform, fit_target_transform
from ..sources.tables import table
from .base import KEY_OUT, ORDER_KEY, cut, sales, with_sales
from .registry import register

KEYS_SQL = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
TRAIN_PRED = "year < 2000"


def prep(spark, sf_dir):
    """Sales rows with deterministic NULLs in a number, a text and a group."""
    s = sales(spark, sf_dir)
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return s.select(
        *KEY_OUT, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        "year", "month", "zone", "ptype", "segment", "brand", "s_name", "p_name", "l_returnflag",
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("surface_n"),
        F.when(F.pmod(F.col("l_orderkey"), F.lit(17)) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("segment")).alias("segment_n"),
        F.when(F.pmod(F.col("l_orderkey"), F.lit(23)) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("zone")).alias("zone_n"),
        F.when(F.pmod(k, F.lit(29)) == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice")).alias("price_n"))


PREP_CTE = """, prep AS (
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_shipdate, year, month, zone, ptype, segment, brand, s_name, p_name, l_returnflag,
       CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN NULL ELSE l_quantity END AS surface_n,
       CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE segment END AS segment_n,
       CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE zone END AS zone_n,
       CASE WHEN (l_orderkey + l_linenumber) % 29 = 0 THEN NULL ELSE l_extendedprice END AS price_n
FROM sales)"""


def prep_sql(body: str) -> str:
    return with_sales(PREP_CTE + "\n" + body)


def _train(df):
    return df.where(F.expr(TRAIN_PRED))


# -- filters ------------------------------------------------------------------
FILTER_CFG = {"ranges": {"year": (1996, 2000), "month": (2, 11), "surface_n": (5, 45)},
              "include": {"zone": [f"NATION_{i}" for i in range(0, 25, 2)]},
              "exclude": {"segment_n": ["BUILDING"]},
              "max_missing_ratio": 0.05, "iqr_column": "price_n", "iqr_factor": 1.5}
_FILTER_COLS = ["l_orderkey", "year", "month", "zone", "segment_n", "surface_n", "price_n"]


@register("data_filters", prep_sql("""
, f1 AS (SELECT l_orderkey, year, month, zone, segment_n, surface_n, price_n FROM prep
         WHERE year >= 1996 AND year <= 2000 AND month >= 2 AND month <= 11
           AND surface_n >= 5 AND surface_n <= 45
           AND zone IN ('NATION_0','NATION_2','NATION_4','NATION_6','NATION_8','NATION_10','NATION_12','NATION_14','NATION_16','NATION_18','NATION_20','NATION_22','NATION_24')
           AND NOT coalesce(segment_n IN ('BUILDING'), false)),
f2 AS (SELECT * FROM f1 WHERE ((CASE WHEN segment_n IS NULL THEN 1 ELSE 0 END)
                               + (CASE WHEN price_n IS NULL THEN 1 ELSE 0 END)) / 7.0 <= 0.05),
b AS (SELECT quantile_cont(price_n, 0.25) AS q1, quantile_cont(price_n, 0.75) AS q3 FROM f2)
SELECT zone, count(*) AS n_rows, CAST(round(sum(price_n), 2) AS DOUBLE) AS sum_price
FROM f2, b WHERE price_n >= q1 - 1.5 * (q3 - q1) AND price_n <= q3 + 1.5 * (q3 - q1)
GROUP BY zone"""))
def q_data_filters(spark, sf_dir):
    """Ranges, include/exclude lists (NULLs kept on exclusion),
    row missing-ratio, then a global IQR fence."""
    df = prep(spark, sf_dir).select(*_FILTER_COLS)
    out = fl.apply_data_filters(df, FILTER_CFG)
    return out.groupBy("zone").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.round(F.sum("price_n"), 2).alias("sum_price"))


# -- column cleaning ------------------------------------------------------------
@register("column_cleaning", prep_sql(f"""
SELECT {KEYS_SQL}, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS l_shipdate,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS flag_txt,
       TRY_CAST(nullif(regexp_extract(CAST(l_partkey % 200 AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN 'B' ELSE '' END, '(\\d+)', 1), '') AS DOUBLE) AS house_number,
       CAST(coalesce(year, 0) * 100 + coalesce(month, 1) AS BIGINT) AS period,
       CASE WHEN surface_n IS NOT NULL OR segment_n IS NOT NULL THEN 1 ELSE 0 END AS has_opt
FROM prep"""))
def q_column_cleaning(spark, sf_dir):
    """P4 empty text -> NULL, P5 timestamps -> ISO text, P8 house number,
    P9 period key, P11 missing-pattern flag over a column prefix."""
    df = prep(spark, sf_dir)
    df = df.select(*KEY_OUT, "l_shipdate", "year", "month",
                   F.when(F.col("l_linenumber") == 3, F.lit("")).otherwise(F.col("l_returnflag")).alias("flag_txt"),
                   F.concat(F.pmod(F.col("l_partkey"), F.lit(200)).cast("string"),
                            F.when(F.pmod(F.col("l_linenumber"), F.lit(2)) == 0, F.lit("B")).otherwise(F.lit("")))
                   .alias("house_txt"),
                   F.col("surface_n").alias("opt_surface"), F.col("segment_n").alias("opt_segment"))
    from ..operators.assembly import empty_strings_to_null
    df = empty_strings_to_null(cl.datetimes_to_iso(df))
    df = df.withColumn("house_number", cl.leading_number("house_txt")) \
           .withColumn("period", period_key("year", "month"))
    df = cl.missing_pattern_flags(df, ["opt_"])
    return df.select(*KEY_OUT, "l_shipdate", "flag_txt", "house_number", "period", "has_opt")


# -- pruning decisions ------------------------------------------------------------
def _prune_frame(spark, sf_dir):
    df = prep(spark, sf_dir)
    return df.select("l_quantity", "l_discount", "surface_n", "segment_n", "zone", "year",
                     F.lit("same").alias("const_txt"),
                     F.lit(None).cast("double").alias("all_null"),
                     F.when(F.col("l_linenumber") == 1, F.col("l_tax")).alias("mostly_null"))


@register("prune_decisions", prep_sql("""
, pf AS (SELECT l_quantity, l_discount, surface_n, segment_n, zone, year, 'same' AS const_txt,
                CAST(NULL AS DOUBLE) AS all_null, CASE WHEN l_linenumber = 1 THEN l_tax END AS mostly_null
         FROM prep WHERE year < 2000),
st AS (
  SELECT 'l_quantity' AS column_name, count(DISTINCT l_quantity) + max(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END) AS nu, avg(CASE WHEN l_quantity IS NULL THEN 1.0 ELSE 0.0 END) AS na FROM pf
  UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) + max(CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN l_discount IS NULL THEN 1.0 ELSE 0.0 END) FROM pf
  UNION ALL SELECT 'surface_n', count(DISTINCT surface_n) + max(CASE WHEN surface_n IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN surface_n IS NULL THEN 1.0 ELSE 0.0 END) FROM pf
  UNION ALL SELECT 'segment_n', count(DISTINCT segment_n) + max(CASE WHEN segment_n IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN segment_n IS NULL THEN 1.0 ELSE 0.0 END) FROM pf
  UNION ALL SELECT 'zone', count(DISTINCT zone) + max(CASE WHEN zone IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN zone IS NULL THEN 1.0 ELSE 0.0 END) FROM pf
  UNION ALL SELECT 'year', count(DISTINCT year) + max(CASE WHEN year IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN year IS NULL THEN 1.0 ELSE 0.0 END) FROM pf
  UNION ALL SELECT 'const_txt', count(DISTINCT const_txt) + max(CASE WHEN const_txt IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN const_txt IS NULL THEN 1.0 ELSE 0.0 END) FROM pf
  UNION ALL SELECT 'all_null', count(DISTINCT all_null) + max(CASE WHEN all_null IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN all_null IS NULL THEN 1.0 ELSE 0.0 END) FROM pf
  UNION ALL SELECT 'mostly_null', count(DISTINCT mostly_null) + max(CASE WHEN mostly_null IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN mostly_null IS NULL THEN 1.0 ELSE 0.0 END) FROM pf)
SELECT column_name, CASE WHEN nu <= 1 OR na > 0.7 THEN 1 ELSE 0 END AS dropped,
       CASE WHEN na = 1.0 THEN 1 ELSE 0 END AS all_null FROM st"""))
def q_prune_decisions(spark, sf_dir):
    """P6 all-NULL columns and P13 non-descriptive columns (constant, NULL
    counted as a value, or NULL share > 0.7), fitted on train."""
    train = _train(_prune_frame(spark, sf_dir))
    drop = set(cl.non_descriptive_columns(train, na_threshold=0.7))
    alln = set(cl.all_null_columns(train))
    rows = [(c, int(c in drop), int(c in alln)) for c in train.columns]
    return spark.createDataFrame(rows, "column_name string, dropped int, all_null int")


# -- numeric coercion ---------------------------------------------------------------
@register("numeric_coercion", prep_sql("""
, t AS (SELECT replace(CAST(l_discount AS VARCHAR), '.', ',') AS disc_txt,
               CASE WHEN l_linenumber <= 2 THEN 'n/a' ELSE CAST(l_tax AS VARCHAR) END AS tax_txt,
               l_returnflag AS flag_txt, CAST(l_linenumber AS VARCHAR) AS code_txt
        FROM prep WHERE year < 2000),
sh AS (SELECT 'disc_txt' AS column_name, avg(CASE WHEN TRY_CAST(replace(disc_txt, ',', '.') AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END) AS parse_share FROM t
       UNION ALL SELECT 'tax_txt', avg(CASE WHEN TRY_CAST(replace(tax_txt, ',', '.') AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END) FROM t
       UNION ALL SELECT 'flag_txt', avg(CASE WHEN TRY_CAST(replace(flag_txt, ',', '.') AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END) FROM t)
SELECT column_name, round(parse_share, 6) AS parse_share, CASE WHEN parse_share >= 0.95 THEN 1 ELSE 0 END AS coerced
FROM sh"""))
def q_numeric_coercion(spark, sf_dir):
    """P16 + T7: convert text columns that parse as numbers (comma decimal
    accepted) on >= 95 % of train rows; ``*CODE*`` names are blacklisted."""
    df = _train(prep(spark, sf_dir)).select(
        F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(",")).alias("disc_txt"),
        F.when(F.col("l_linenumber") <= 2, F.lit("n/a")).otherwise(F.col("l_tax").cast("string")).alias("tax_txt"),
        F.col("l_returnflag").alias("flag_txt"), F.col("l_linenumber").cast("string").alias("code_txt"))
    chosen = set(cl.coercible_columns(df, 0.95, blacklist=["*CODE*"]))
    cols = [c for c in df.columns if not cl.blacklisted(c, ["*CODE*"])]
    shares = df.agg(*[F.avg(cl.numeric_like(c).isNotNull().cast("double")).alias(c) for c in cols])
    return shares.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.round(F.col(c), 6).alias("parse_share"),
                 F.lit(int(c in chosen)).alias("coerced")) for c in cols])))


# -- text features ---------------------------------------------------------------
FLOOR_TEXTS = ["P1", "PT", "S1-T", "1-3", "PIANO 2", "RIAL", "T-P2", "S2,S1", "AMMEZZ", "P12",
               "ST", "NULL", "3 - 5", "p3 piano 4"]


def floor_frame(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    idx = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(FLOOR_TEXTS))) + 1
    return li.select(*KEY_OUT, F.element_at(F.array(*[F.lit(t) for t in FLOOR_TEXTS]), idx.cast("int"))
                     .alias("floor_txt"))


@register("floor_features")
def q_floor_features(spark, sf_dir):
    """Eleven floor features from free floor descriptions (checked
    against hand-computed values in tests/test_text.py)."""
    df = floor_frame(spark, sf_dir)
    return df.select(*KEY_OUT, "floor_txt", *[e.alias(k) for k, e in tx.floor_features("floor_txt").items()])


def wkt_frame(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    x = F.col("embedding")[0].cast("double")
    y = F.col("embedding")[1].cast("double")
    bad = F.pmod(F.col("vec_id"), F.lit(9)) == 0
    point = F.when(bad, F.concat(F.lit("POINT (abc "), y.cast("string"), F.lit(")"))) \
        .otherwise(F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")))
    poly = wkt.rectangle_wkt(x, y, x + F.lit(1.0), y + F.lit(1.0))
    mpoly = F.concat(F.lit("MULTIPOLYGON ("), F.regexp_replace(poly, "^POLYGON ", ""), F.lit(", "),
                     F.regexp_replace(wkt.rectangle_wkt(x, y, x + F.lit(2.0), y + F.lit(2.0)), "^POLYGON ", ""),
                     F.lit(")"))
    return e.select("vec_id", point.alias("geom_point"), poly.alias("geom_poly"), mpoly.alias("geom_multi"))


@register("wkt_features", """
SELECT vec_id,
       CASE WHEN vec_id % 9 = 0 THEN NULL ELSE CAST(embedding[1] AS DOUBLE) END AS geom_point_x,
       CASE WHEN vec_id % 9 = 0 THEN NULL ELSE CAST(embedding[2] AS DOUBLE) END AS geom_point_y,
       CAST(5 AS BIGINT) AS geom_poly_vertex_count,
       CAST(2 AS BIGINT) AS geom_multi__wkt_mpoly_count,
       CAST(10 AS BIGINT) AS geom_multi__wkt_mpoly_vertices,
       5.0 AS geom_multi__wkt_mpoly_outer_vertices_avg
FROM embeddings""")
def q_wkt_features(spark, sf_dir):
    """Detect WKT columns from the first 200 rows, replace them by
    point x/y, polygon vertex count and multipolygon statistics."""
    return wkt.extract_geometry_features(wkt_frame(spark, sf_dir))


@register("json_features", "SELECT event_id, json_extract_string(props, '$.k') AS props__k FROM events")
def q_json_features(spark, sf_dir):
    """JSON-object text column -> one column per frequent first-level key."""
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return tx.extract_json_features(ev, ["props"])


def geojson_frame(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    x0 = F.pmod(k * 37, F.lit(71)) / F.lit(100.0)
    y0 = F.pmod(k * 53, F.lit(67)) / F.lit(100.0)
    x1, y1 = x0 + F.lit(0.5), y0 + F.lit(0.25)

    def pt(a, b):
        return F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit("]"))
    ring = F.concat_ws(",", pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))
    feat = F.concat(F.lit('{"type":"Feature","properties":{"areaMq":'), F.col("s_acctbal").cast("string"),
                    F.lit(',"foglio":"'), F.col("n_name"),
                    F.lit('"},"geometry":{"type":"Polygon","coordinates":[['), ring, F.lit("]]}}"))
    coll = F.concat(F.lit('{"type":"FeatureCollection","features":['), feat, F.lit("]}"))
    gj = F.when(F.pmod(k, F.lit(2)) == 0, feat).otherwise(coll)
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", gj.alias("parcel_geojson"))


@register("geojson_features", """
SELECT s_suppkey, s_acctbal AS areaMq, n_name AS foglio,
       (s_suppkey * 37) % 71 / 100.0::DOUBLE AS minx, (s_suppkey * 53) % 67 / 100.0::DOUBLE AS miny,
       (s_suppkey * 37) % 71 / 100.0::DOUBLE + 0.5::DOUBLE AS maxx,
       (s_suppkey * 53) % 67 / 100.0::DOUBLE + 0.25::DOUBLE AS maxy
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def q_geojson_features(spark, sf_dir):
    """First feature's properties + bounding box from GeoJSON text
    (Feature and FeatureCollection)."""
    df = geojson_frame(spark, sf_dir)
    f = tx.geojson_features("parcel_geojson", prefix="")
    return df.select("s_suppkey", f["areaMq"].cast("double").alias("areaMq"), f["foglio"].alias("foglio"),
                     f["minx"].alias("minx"), f["miny"].alias("miny"), f["maxx"].alias("maxx"),
                     f["maxy"].alias("maxy"))


# -- target transforms ---------------------------------------------------------
_TT = {"t_log": TargetTransform("log"), "t_log10": TargetTransform("log10", {"log10_offset": 1.0}),
       "t_sqrt": TargetTransform("sqrt"), "t_boxcox": TargetTransform("boxcox", {"lambda": 0.25, "shift": 0.0}),
       "t_yj": TargetTransform("yeojohnson", {"lambda": 0.5})}


@register("target_transforms", prep_sql(f"""
, t AS (SELECT {KEYS_SQL}, l_extendedprice AS y, (l_extendedprice - 30000) / 1000.0::DOUBLE AS yc FROM prep)
SELECT {KEYS_SQL},
       round(ln(1 + y), 8) AS t_log, round(log10(y + 1.0), 8) AS t_log10, round(sqrt(greatest(y, 0)), 6) AS t_sqrt,
       round((pow(y, 0.25) - 1) / 0.25, 6) AS t_boxcox,
       round(CASE WHEN yc >= 0 THEN (pow(yc + 1, 0.5) - 1) / 0.5
                  ELSE -(pow(1 - yc, 1.5) - 1) / 1.5 END, 6) AS t_yj,
       round(y, 4) AS back_log, round(y, 4) AS back_boxcox, round(yc, 6) AS back_yj
FROM t"""))
def q_target_transforms(spark, sf_dir):
    """M1, M2, M4 forward maps with given parameters; M6 inverses round-trip."""
    df = prep(spark, sf_dir).select(*KEY_OUT, F.col("l_extendedprice").alias("y"),
                                    ((F.col("l_extendedprice") - 30000) / F.lit(1000.0)).alias("yc"))
    out = df.select(*KEY_OUT, "y", "yc",
                    *[(_TT[k].forward("yc" if k == "t_yj" else "y")).alias(k) for k in _TT])
    return out.select(*KEY_OUT, rnd("t_log", 8).alias("t_log"), rnd("t_log10", 8).alias("t_log10"),
                      rnd("t_sqrt", 6).alias("t_sqrt"), rnd("t_boxcox", 6).alias("t_boxcox"),
                      rnd("t_yj", 6).alias("t_yj"),
                      rnd(_TT["t_log"].inverse("t_log"), 4).alias("back_log"),
                      rnd(_TT["t_boxcox"].inverse("t_boxcox"), 4).alias("back_boxcox"),
                      rnd(_TT["t_yj"].inverse("t_yj"), 6).alias("back_yj"))


@register("target_transform_fit")
def q_target_transform_fit(spark, sf_dir):
    """M3, M5, M7: Box-Cox / Yeo-Johnson lambda fitted by likelihood on train,
    applied to all rows with the train parameters; summary per split."""
    df = cut(prep(spark, sf_dir), "l_extendedprice", "year")
    tr = _train(df)
    bc = fit_target_transform(tr, "l_extendedprice", "boxcox")
    yj = fit_target_transform(tr, "l_extendedprice", "yeojohnson")
    out = df.withColumn("split", F.when(F.expr(TRAIN_PRED), "train").otherwise("test")) \
            .withColumn("z_bc", bc.forward("l_extendedprice")).withColumn("z_yj", yj.forward("l_extendedprice"))
    return out.groupBy("split").agg(
        F.lit(round(bc.params["lambda"], 4)).alias("lambda_boxcox"),
        F.lit(round(yj.params["lambda"], 4)).alias("lambda_yeojohnson"),
        F.round(F.skewness("l_extendedprice"), 4).alias("skew_raw"),
        F.round(F.skewness("z_bc"), 4).alias("skew_boxcox"),
        F.round(F.skewness("z_yj"), 4).alias("skew_yeojohnson"))


# -- outliers -------------------------------------------------------------------
def _outlier_sql():
    return prep_sql(f"""
, g AS (SELECT zone_n, count(*) AS n, quantile_cont(price_n, 0.25) AS q1, quantile_cont(price_n, 0.75) AS q3,
               avg(price_n) AS mu, stddev_pop(price_n) AS sd FROM prep WHERE zone_n IS NOT NULL GROUP BY zone_n),
gl AS (SELECT median(price_n) AS med FROM prep),
mad AS (SELECT median(abs(price_n - gl.med)) AS mad, gl.med FROM prep, gl GROUP BY gl.med),
r AS (SELECT p.*, g.n, g.q1, g.q3, g.mu, g.sd, mad.med, mad.mad FROM prep p LEFT JOIN g USING (zone_n), mad),
f AS (SELECT {KEYS_SQL},
  CASE WHEN zone_n IS NULL THEN FALSE WHEN n < 400 THEN TRUE
       WHEN q3 - q1 IS NULL OR q3 - q1 = 0 THEN TRUE
       ELSE coalesce(price_n >= q1 - 1.5 * (q3 - q1) AND price_n <= q3 + 1.5 * (q3 - q1), FALSE) END AS iqr_in,
  CASE WHEN zone_n IS NULL THEN FALSE WHEN n < 400 THEN TRUE
       WHEN sd IS NULL OR sd = 0 THEN TRUE
       ELSE coalesce(abs((price_n - mu) / sd) <= 2.5, FALSE) END AS z_in,
  coalesce(abs(0.6745 * (price_n - med) / (mad + 1e-8)) <= 3.5, FALSE) AS mz_in
FROM r)
SELECT {KEYS_SQL}, CAST(iqr_in AS INTEGER) AS iqr_in, CAST(z_in AS INTEGER) AS z_in, CAST(mz_in AS INTEGER) AS mz_in,
       CAST((CAST(iqr_in AS INTEGER) + CAST(z_in AS INTEGER) + CAST(mz_in AS INTEGER)) >= 2 AS INTEGER) AS majority_in,
       CAST(iqr_in AND z_in AND mz_in AS INTEGER) AS union_in
FROM f""")


@register("outliers_grouped", _outlier_sql())
def q_outliers_grouped(spark, sf_dir):
    """O1 IQR and O2 z-score per zone with O5 small-group handling and NULL
    groups removed, O6 modified z-score, O4 majority vote and O7 union."""
    df = cut(prep(spark, sf_dir), *KEY_OUT, "zone_n", "price_n")
    df = ol.flag_inliers(df, "price_n", "iqr", "zone_n", min_group_size=400, fallback="skip",
                         out_col="iqr_in")
    df = ol.flag_inliers(df, "price_n", "zscore", "zone_n", min_group_size=400, fallback="skip",
                         z_thresh=2.5, out_col="z_in")
    df = ol.modified_zscore_inliers(df, "price_n", out_col="mz_in")
    df = df.withColumn("majority_in", ol.vote(["iqr_in", "z_in", "mz_in"], "majority")) \
           .withColumn("union_in", ol.vote(["iqr_in", "z_in", "mz_in"], "union"))
    return df.select(*KEY_OUT, *[F.col(c).cast("int").alias(c)
                                 for c in ("iqr_in", "z_in", "mz_in", "majority_in", "union_in")])


@register("outliers_global_fallback", prep_sql("""
, g AS (SELECT zone_n, count(*) AS n, quantile_cont(price_n, 0.25) AS q1, quantile_cont(price_n, 0.75) AS q3
        FROM prep WHERE zone_n IS NOT NULL GROUP BY zone_n),
gl AS (SELECT quantile_cont(price_n, 0.25) AS gq1, quantile_cont(price_n, 0.75) AS gq3 FROM prep),
r AS (SELECT p.*, CASE WHEN g.n < 2500 THEN gl.gq1 ELSE g.q1 END AS a, CASE WHEN g.n < 2500 THEN gl.gq3 ELSE g.q3 END AS b
      FROM prep p LEFT JOIN g USING (zone_n), gl)
SELECT zone_n, count(*) AS n_rows,
       CAST(sum(CASE WHEN zone_n IS NULL THEN 0
                WHEN coalesce(price_n >= a - 1.5 * (b - a) AND price_n <= b + 1.5 * (b - a), FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS n_inliers
FROM r GROUP BY zone_n"""))
def q_outliers_global_fallback(spark, sf_dir):
    """O5 with ``fallback='global'``: zones under the minimum size use the
    global IQR fence."""
    df = ol.flag_inliers(cut(prep(spark, sf_dir), "zone_n", "price_n"), "price_n", "iqr", "zone_n", min_group_size=2500,
                         fallback="global")
    return df.groupBy("zone_n").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.sum(F.col("is_inlier").cast("long")).alias("n_inliers"))


@register("isolation_forest")
def q_isolation_forest(spark, sf_dir):
    """O3: distributed 1-D isolation forest per ptype, contamination 0.02;
    rows flagged per group (share near 2 %, stable under repartitioning)."""
    df = prep(spark, sf_dir).select(*KEY_OUT, "ptype", "l_extendedprice")
    out = ol.isolation_forest_inliers(df, "l_extendedprice", 0.02, group_col="ptype", id_cols=ORDER_KEY[:4],
                                      n_trees=50)
    return out.groupBy("ptype").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.sum((~F.col("is_inlier_iso")).cast("long")).alias("n_outliers"))


# -- imputation ---------------------------------------------------------------------
@register("imputation_grouped", prep_sql(f"""
, tr AS (SELECT * FROM prep WHERE year < 2000),
gm AS (SELECT zone_n, coalesce(median(surface_n), avg(surface_n)) AS gsurf FROM tr WHERE zone_n IS NOT NULL GROUP BY zone_n),
cnt AS (SELECT zone_n, segment_n, count(*) AS c FROM tr WHERE zone_n IS NOT NULL AND segment_n IS NOT NULL GROUP BY ALL),
gmode AS (SELECT zone_n, segment_n AS gseg FROM (
            SELECT *, row_number() OVER (PARTITION BY zone_n ORDER BY c DESC, segment_n) AS rn FROM cnt) WHERE rn = 1),
gsm AS (SELECT median(surface_n) AS msurf FROM tr),
gcnt AS (SELECT segment_n, count(*) AS c FROM tr WHERE segment_n IS NOT NULL GROUP BY 1),
gseg AS (SELECT segment_n AS mseg FROM gcnt ORDER BY c DESC, segment_n LIMIT 1)
SELECT {KEYS_SQL}, coalesce(p.surface_n, gm.gsurf, gsm.msurf) AS surface_n,
       coalesce(p.segment_n, gmode.gseg, gseg.mseg) AS segment_n
FROM prep p LEFT JOIN gm ON p.zone_n = gm.zone_n LEFT JOIN gmode ON p.zone_n = gmode.zone_n, gsm, gseg"""))
def q_imputation_grouped(spark, sf_dir):
    """A8 + I1: per-zone median / mode fitted on train, per-row fallback to
    the global value for NULL or unseen zones (I2)."""
    df = cut(prep(spark, sf_dir), *KEY_OUT, "year", "zone_n", "surface_n", "segment_n")
    fit = fit_imputer(_train(df), "median", group_col="zone_n", numeric_cols=["surface_n"],
                      categorical_cols=["segment_n"])
    return transform_imputer(df, fit).select(*KEY_OUT, "surface_n", "segment_n")


# -- encoders ------------------------------------------------------------------------
_CARD_COLS = ["zone", "ptype", "segment", "brand", "s_name", "p_name", "l_returnflag", "segment_n"]


@register("encoding_plan", prep_sql("""
, tr AS (SELECT * FROM prep WHERE year < 2000),
c AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM tr"
                                for c in _CARD_COLS) + """)
SELECT column_name, n_distinct,
       CASE WHEN n_distinct <= 8 THEN 'one_hot' WHEN n_distinct <= 20 THEN 'target'
            WHEN n_distinct <= 100 THEN 'frequency' WHEN n_distinct <= 200 THEN 'ordinal' ELSE 'drop' END AS strategy
FROM c"""))
def q_encoding_plan(spark, sf_dir):
    """A9 + E1 + A37: distinct counts on train and the encoding chosen by
    the cardinality thresholds."""
    tr = _train(prep(spark, sf_dir))
    plan = en.plan_encodings(tr, _CARD_COLS)
    strat = {}
    for name in ("one_hot", "target", "frequency", "ordinal", "drop"):
        for c in getattr(plan, name):
            strat[c] = name
    # the counts were computed by Spark in one aggregation; this is a
    # one-row-per-column report of them
    rows = [(c, int(plan.cardinality[c]), strat[c]) for c in _CARD_COLS]
    return spark.createDataFrame(rows, "column_name string, n_distinct long, strategy string")


@register("one_hot_encoding", prep_sql(f"""
SELECT {KEYS_SQL},
""" + ",\n".join([f"CASE WHEN ptype = '{v}' THEN 1.0 ELSE 0.0 END AS ptype_{v}"
                  for v in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]]
                 + [f"CASE WHEN segment_n = '{v}' THEN 1.0 ELSE 0.0 END AS segment_n_{v}"
                    for v in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]]
                 + ["CASE WHEN segment_n IS NULL THEN 1.0 ELSE 0.0 END AS segment_n_nan"]) + "\nFROM prep"))
def q_one_hot_encoding(spark, sf_dir):
    """One column per train category, NULL is a category, unseen -> 0."""
    df = prep(spark, sf_dir)
    fit = en.fit_one_hot(_train(df), ["ptype", "segment_n"])
    out = df.select(*KEY_OUT, "ptype", "segment_n")
    for c, vals in fit.items():
        out = out.withColumns(en.one_hot_columns(c, vals)).drop(c)
    return out


@register("target_encoding", prep_sql(f"""
, tr AS (SELECT * FROM prep WHERE year < 2000),
pr AS (SELECT avg(l_extendedprice) AS prior FROM tr),
st AS (SELECT brand, count(l_extendedprice) AS n, avg(l_extendedprice) AS m FROM tr GROUP BY brand),
enc AS (SELECT brand, pr.prior * (1 - 1 / (1 + exp(-(n - 5) / 10.0::DOUBLE))) + m * (1 / (1 + exp(-(n - 5) / 10.0::DOUBLE))) AS e FROM st, pr)
SELECT {KEYS_SQL}, round(coalesce(enc.e, pr.prior), 4) AS brand__target
FROM prep LEFT JOIN enc USING (brand), pr"""))
def q_target_encoding(spark, sf_dir):
    """Smoothed target mean per brand fitted on train; unknown -> prior."""
    df = prep(spark, sf_dir)
    st, prior = en.fit_target_encoder(_train(df), "brand", "l_extendedprice", 10.0, 5)
    out = en._lookup(df.select(*KEY_OUT, "brand"), "brand", st, "brand__target", prior)
    return out.select(*KEY_OUT, rnd("brand__target", 4).alias("brand__target"))


@register("frequency_encoding", prep_sql(f"""
, tr AS (SELECT * FROM prep WHERE year < 2000 AND s_name IS NOT NULL),
fq AS (SELECT s_name, count(*) / (SELECT count(*) FROM tr) AS f FROM tr GROUP BY s_name)
SELECT {KEYS_SQL}, round(coalesce(fq.f, 0.0), 8) AS s_name__freq FROM prep LEFT JOIN fq USING (s_name)"""))
def q_frequency_encoding(spark, sf_dir):
    """Share of each supplier name among train rows; unseen -> 0."""
    df = prep(spark, sf_dir)
    st = en.fit_frequency_encoder(_train(df), "s_name")
    out = en._lookup(df.select(*KEY_OUT, "s_name"), "s_name", st, "s_name__freq", 0.0)
    return out.select(*KEY_OUT, rnd("s_name__freq", 8).alias("s_name__freq"))


@register("ordinal_encoding", prep_sql(f"""
, tr AS (SELECT *, row_number() OVER (ORDER BY {", ".join(ORDER_KEY)}) AS rn FROM prep WHERE year < 1997),
fa AS (SELECT p_name, min(rn) AS first_rn FROM tr GROUP BY p_name),
codes AS (SELECT p_name, CAST(row_number() OVER (ORDER BY first_rn) AS DOUBLE) AS code FROM fa)
SELECT {KEYS_SQL}, coalesce(codes.code, -1.0) AS p_name__ord FROM prep LEFT JOIN codes USING (p_name)"""))
def q_ordinal_encoding(spark, sf_dir):
    """E5: codes 1..k by first appearance in train order; unseen -> -1."""
    df = prep(spark, sf_dir)
    st = en.fit_ordinal_encoder(df.where(F.col("year") < 1997), "p_name", ORDER_KEY)
    return en._lookup(df.select(*KEY_OUT, "p_name"), "p_name", st, "p_name__ord", -1.0) \
        .select(*KEY_OUT, "p_name__ord")


# -- scaling ----------------------------------------------------------------------------
@register("winsor_scale", prep_sql(f"""
, tr AS (SELECT * FROM prep WHERE year < 2000),
w AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi,
             avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
             quantile_cont(l_discount, 0.25) AS d1, median(l_discount) AS dm, quantile_cont(l_discount, 0.75) AS d3 FROM tr)
SELECT {KEYS_SQL}, round(greatest(least(l_extendedprice, hi), lo), 4) AS price_w,
       round((l_quantity - mq) / sq, 6) AS qty_std, round((l_discount - dm) / (d3 - d1), 6) AS disc_robust
FROM prep, w"""))
def q_winsor_scale(spark, sf_dir):
    """A12 + K1 winsorising at train 1 %/99 %, K2 standard scaling with the
    population std, K3 robust scaling (median, IQR)."""
    df = cut(prep(spark, sf_dir), *KEY_OUT, "year", "l_extendedprice", "l_quantity", "l_discount")
    tr = _train(df)
    bounds = sc.fit_winsor(tr, ["l_extendedprice"], 0.01, 0.99)
    std = sc.fit_scaler(tr, ["l_quantity"], "standard")
    rob = sc.fit_scaler(tr, ["l_discount"], "robust")
    out = sc.apply_scaler(sc.apply_scaler(sc.apply_winsor(df, bounds), std), rob)
    return out.select(*KEY_OUT, rnd("l_extendedprice", 4).alias("price_w"),
                      rnd("l_quantity", 6).alias("qty_std"), rnd("l_discount", 6).alias("disc_robust"))


@register("pca_projection")
def q_pca_projection(spark, sf_dir):
    """K4: PCA on standard-scaled numeric columns keeping 95 % variance."""
    df = prep(spark, sf_dir)
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    tr = _train(df)
    s = sc.fit_scaler(tr, cols, "standard")
    model = sc.fit_pca(sc.apply_scaler(tr, s), cols, 0.95)
    return sc.apply_pca(sc.apply_scaler(df, s), model, keep=KEY_OUT)


# -- correlation pruning ------------------------------------------------------------
_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "year", "month", "price_n", "surface_n"]


def _corr_sql():
    pairs = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]
    sel = " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM prep"
                             for a, b in pairs)
    return prep_sql(f"""
, pr AS ({sel}),
pos AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {i})" for i, c in enumerate(_CORR_COLS))}) t(c, i)),
d AS (SELECT pr.col_b FROM pr GROUP BY pr.col_b HAVING max(abs(pr.r)) > 0.9)
SELECT col_a, col_b, round(r, 6) AS r, CASE WHEN col_b IN (SELECT col_b FROM d) THEN 1 ELSE 0 END AS b_dropped
FROM pr""")


@register("correlation_prune", _corr_sql())
def q_correlation_prune(spark, sf_dir):
    """P14 + A28: pairwise Pearson correlations (one chunked aggregation);
    a column is dropped when an earlier column has |r| > 0.9."""
    df = prep(spark, sf_dir).select(*_CORR_COLS)
    r = cl.correlation_pairs(df, _CORR_COLS)
    drop = set(cl.correlated_to_drop(df, 0.9, _CORR_COLS))
    rows = [(a, b, None if v is None else round(v, 6), int(b in drop)) for (a, b), v in r.items()]
    return spark.createDataFrame(rows, "col_a string, col_b string, r double, b_dropped int")


# -- profile, downcast ----------------------------------------------------------------
def _profile_sql():
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS non_null, count(*) - count({c}) AS n_missing, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS missing_pct, count(DISTINCT {c}) AS n_distinct FROM orders"
        for c in cols)
    return parts


@register("column_profile", _profile_sql())
def q_column_profile(spark, sf_dir):
    """P21 + A25 + A29 + N3: per-column non-null, missing, missing %, distinct
    (one aggregation, then a wide-to-long reshape)."""
    prof = cl.column_profile(table(spark, sf_dir, "orders"))
    return prof.select("column", "non_null", "n_missing", "missing_pct", "n_distinct")


_SUMMARY = {"documents": ["doc_id", "text", "lang", "source", "n_chars"], "labels": ["doc_id", "quality", "toxic"],
            "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]}


def _summary_sql():
    def kind(name, types):
        return (f"(SELECT count(*) FROM (DESCRIBE {name}) WHERE regexp_matches(column_type, '^({types})')) ")

    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_columns, "
        f"{kind(t, 'TINYINT|SMALLINT|INTEGER|BIGINT|FLOAT|DOUBLE|DECIMAL')} AS n_numeric, {kind(t, 'VARCHAR')} AS n_categorical, "
        f"{kind(t, 'DATE|TIMESTAMP')} AS n_datetime, CAST({' + '.join(f'(count(*) - count({c}))' for c in cols)} AS BIGINT) AS total_missing, "
        f"round(({' + '.join(f'(count(*) - count({c}))' for c in cols)}) * 100.0::DOUBLE / (count(*) * {len(cols)}), 6) AS missing_pct FROM {t}"
        for t, cols in _SUMMARY.items())


@register("dataset_summary", _summary_sql())
def q_dataset_summary(spark, sf_dir):
    """Rows, columns by kind and missing cells of whole tables, one scan each."""
    out = None
    for name in _SUMMARY:
        one = cl.dataset_summary(table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("missing_pct", F.round("missing_pct", 6))


@register("downcast_plan", """
WITH m AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, min({c}) AS lo, max({c}) AS hi, max(CASE WHEN {c} <> floor({c}) THEN 1 ELSE 0 END) AS frac FROM lineitem"
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax"]) + """)
SELECT column_name, CASE WHEN frac = 1 THEN 'double' WHEN lo >= -128 AND hi <= 127 THEN 'tinyint'
                         WHEN lo >= -32768 AND hi <= 32767 THEN 'smallint'
                         WHEN lo >= -2147483648 AND hi <= 2147483647 THEN 'int' ELSE 'bigint' END AS target_type
FROM m""")
def q_downcast_plan(spark, sf_dir):
    """P20: smallest integer type holding each numeric column's range."""
    plan = cl.downcast_plan(table(spark, sf_dir, "lineitem"))
    return spark.createDataFrame(sorted(plan.items()), "column_name string, target_type string")
