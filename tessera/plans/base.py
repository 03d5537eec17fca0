"""The analytic base table used by the registered queries.

Mapping of the valuation data model onto the driver tables:

* deed            -> ``orders`` (price ``o_totalprice``)
* property row    -> ``lineitem`` (surface ``l_quantity``, target ``l_extendedprice``)
* zone / region   -> supplier nation ``n_name`` / ``r_name``
* building type   -> ``p_type``; category -> ``c_mktsegment``; brand -> ``p_brand``
* year, month     -> calendar fields of ``o_orderdate``

``ORDER_KEY`` lists the seven lineitem columns that are unique per row; it is
the deterministic tie-break wherever the reference relied on row position.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_table
from ..sources.tables import table

ORDER_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
             "l_quantity", "l_extendedprice", "l_shipdate"]
KEY_OUT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x supplier x nation x region x part x customer."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    p = table(spark, sf_dir, "part")
    c = table(spark, sf_dir, "customer")
    df = (li.join(o, li.l_orderkey == o.o_orderkey)
          .join(s, li.l_suppkey == s.s_suppkey)
          .join(n, s.s_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey)
          .join(p, li.l_partkey == p.p_partkey)
          .join(c, o.o_custkey == c.c_custkey))
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity"), F.col("l_extendedprice"), "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
        "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.col("n_name").alias("zone"), F.col("r_name").alias("region"),
        F.col("p_type").alias("ptype"), F.col("p_brand").alias("brand"),
        "p_size", "p_retailprice", "p_name",
        F.col("c_mktsegment").alias("segment"), "c_acctbal", "s_name", "s_acctbal")


def cut(df: DataFrame, *cols: str, deal: tuple = ()) -> DataFrame:
    """The columns of ``df`` that a query's passes read (all without names),
    written once: each pass over the join chain itself would shuffle the sales
    rows again.  ``deal`` names key columns to spread the rows by, for queries
    whose work a row outweighs a shuffle."""
    rows = df.select(*dict.fromkeys(cols)) if cols else df
    return cut_table(rows.repartition(*deal) if deal else rows, "sales")[0]


SALES_SQL = """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
       l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
       l.l_returnflag, l.l_linestatus, l.l_shipdate,
       o.o_custkey, o.o_totalprice, o.o_orderstatus, o.o_orderpriority,
       CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
       n.n_name AS zone, r.r_name AS region, p.p_type AS ptype, p.p_brand AS brand,
       p.p_size, p.p_retailprice, p.p_name, c.c_mktsegment AS segment, c.c_acctbal,
       s.s_name, s.s_acctbal
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
"""


def with_sales(sql_body: str) -> str:
    """Prefix an oracle query with the ``sales`` CTE."""
    return f"WITH sales AS ({SALES_SQL})\n{sql_body}"
