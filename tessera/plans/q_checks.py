"""Queries: time-ordered folds and hold-outs, split overlap, JSON keys that come
late, polygons with holes and parts, and the column steps before a model."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import columns as cl
from ..operators import split as sp
from ..operators.spatial import points_in_polygons
from ..sources.tables import table
from .base import ORDER_KEY, sales, with_sales
from .registry import register

ORDER_SQL = "year * 100 + month, " + ", ".join(ORDER_KEY)


def _periods(spark, sf_dir):
    return sales(spark, sf_dir).select(*ORDER_KEY, "year", (F.col("year") * 100 + F.col("month")).alias("_period"))


@register("expanding_folds", with_sales(f"""
, o AS (SELECT year * 100 + month AS p, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS pos, count(*) OVER () AS n FROM sales),
b AS (SELECT p, pos, CAST(floor(pos * 4 / n) AS INTEGER) - 1 AS fold FROM o),
f AS (SELECT unnest([0, 1, 2]) AS fold)
SELECT f.fold, count(*) FILTER (WHERE b.fold < f.fold) AS train_rows, max(p) FILTER (WHERE b.fold < f.fold) AS train_to,
       count(*) FILTER (WHERE b.fold = f.fold) AS valid_rows, min(p) FILTER (WHERE b.fold = f.fold) AS valid_from,
       max(p) FILTER (WHERE b.fold = f.fold) AS valid_to
FROM b, f GROUP BY f.fold"""))
def q_expanding_folds(spark, sf_dir):
    """Rows and periods each fold of the tuner trains and validates on."""
    d = sp.fold_ids(_periods(spark, sf_dir), 3, "expanding", order_cols=["_period", *ORDER_KEY])
    folds = F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("f")
    per = d.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("_period").alias("lo"), F.max("_period").alias("hi"))
    past, now = F.col("fold") < F.col("f"), F.col("fold") == F.col("f")
    return (per.select("*", folds).groupBy(F.col("f").alias("fold")).agg(
        F.sum(F.when(past, F.col("n"))).alias("train_rows"), F.max(F.when(past, F.col("hi"))).alias("train_to"),
        F.sum(F.when(now, F.col("n"))).alias("valid_rows"), F.min(F.when(now, F.col("lo"))).alias("valid_from"),
        F.max(F.when(now, F.col("hi"))).alias("valid_to")))


@register("chronological_holdout", with_sales(f"""
, o AS (SELECT year * 100 + month AS p, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS pos, count(*) OVER () AS n FROM sales)
SELECT pos >= floor(0.8 * n) AS is_holdout, count(*) AS rows, min(p) AS min_period, max(p) AS max_period FROM o GROUP BY 1"""))
def q_chronological_holdout(spark, sf_dir):
    """The last fifth of the rows in time order is held out."""
    d = sp.chronological_holdout(_periods(spark, sf_dir), ["_period", *ORDER_KEY], 0.8)
    return d.groupBy("is_holdout").agg(F.count(F.lit(1)).alias("rows"), F.min("_period").alias("min_period"),
                                       F.max("_period").alias("max_period"))


@register("split_overlap", with_sales("""
, s AS (SELECT CASE WHEN l_quantity < 10 AND year < 1998 THEN 'val' WHEN year < 1997 THEN 'train' ELSE 'test' END AS split,
               year * 100 + month AS p FROM sales),
r AS (SELECT split, count(*) AS rows, min(p) AS min_period, max(p) AS max_period FROM s GROUP BY split)
SELECT r.*, split <> 'test' AND max_period >= (SELECT min_period FROM r WHERE split = 'test') AS overlaps_test FROM r"""))
def q_split_overlap(spark, sf_dir):
    """Period ranges of the splits and which of them reach into the test's."""
    s = sales(spark, sf_dir)
    split = (F.when((F.col("l_quantity") < 10) & (F.col("year") < 1998), "val").when(F.col("year") < 1997, "train").otherwise("test"))
    return sp.split_overlap(s.select(split.alias("split"), (F.col("year") * 100 + F.col("month")).alias("_period")))


@register("json_late_keys", """
SELECT o_orderkey, o_totalprice, CAST(o_custkey AS VARCHAR) AS info__cust,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS "info__late.key"
FROM orders""")
def q_json_late_keys(spark, sf_dir):
    """Keys are counted over all rows (a key of every third row, with a dot
    in its name), nested objects and rare keys are no columns."""
    o = table(spark, sf_dir, "orders")
    late = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(', "late.key": "'), F.col("o_orderstatus"), F.lit('"'))).otherwise("")
    rare = F.when(F.col("o_orderkey") % 101 == 0, F.lit(', "rare": 1')).otherwise("")
    info = F.concat(F.lit('{"cust": '), F.col("o_custkey").cast("string"), late, rare, F.lit(', "nested": {"a": 1}}'))
    return tx.extract_json_features(o.select("o_orderkey", "o_totalprice", info.alias("info")), ["info"])


@register("polygons_with_holes", """
WITH pts AS (SELECT l_orderkey % 100 + 0.5 AS x, l_partkey % 100 + 0.25 AS y FROM lineitem),
z AS (SELECT r_regionkey AS zone, 10.0 * r_regionkey AS x0 FROM region)
SELECT zone, count(x) AS points FROM z LEFT JOIN pts
  ON (x > x0 AND x < x0 + 30 AND y > 0 AND y < 30 AND NOT (x > x0 + 10 AND x < x0 + 20 AND y > 10 AND y < 20))
  OR (x > x0 AND x < x0 + 5 AND y > 60 AND y < 90)
GROUP BY zone""")
def q_polygons_with_holes(spark, sf_dir):
    """Points in multipolygons of a square with a hole and a second part."""
    pts = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 100 + 0.5).alias("x"), (F.col("l_partkey") % 100 + 0.25).alias("y"))
    a = F.col("r_regionkey") * 10

    def ring(x0, y0, x1, y1):
        return F.format_string(f"(%d {y0}, %d {y0}, %d {y1}, %d {y1}, %d {y0})", *[(a + v).cast("int") for v in (x0, x1, x1, x0, x0)])

    wkt = F.concat(F.lit("MULTIPOLYGON (("), ring(0, 0, 30, 30), F.lit(", "), ring(10, 10, 20, 20), F.lit("), ("), ring(0, 60, 5, 90), F.lit("))"))
    zones = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("zone"), wkt.alias("wkt"))
    hits = points_in_polygons(pts, "x", "y", zones, "wkt").groupBy("zone").agg(F.count(F.lit(1)).alias("points"))
    return zones.select("zone").join(hits, "zone", "left").na.fill(0, ["points"])


@register("model_columns", """
SELECT o_custkey, o_totalprice, 0 AS absent, coalesce(o_orderstatus, 'MISSING') AS o_orderstatus FROM orders""")
def q_model_columns(spark, sf_dir):
    """Configured columns dropped, NULLs filled, columns aligned."""
    o = cl.drop_configured(table(spark, sf_dir, "orders"), ["o_comment", "o_clerk", "not_there"])
    return cl.align_columns(cl.final_fill(o), ["o_custkey", "o_totalprice", "absent", "o_orderstatus"])
