"""Queries of several passes compute each sales row once; rows that cost much are dealt to the cores."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.plans import base, q_eda, q_features, q_metrics, q_models

N = 60


@pytest.fixture
def counted_sales(spark):
    """Rows as ``sales`` gives them, and a count of how often a price was computed."""
    rows = [(k, k % 7, k % 5, 1 + k % 3, float(1 + k % 50), 1000.0 + 37.0 * (k * k % 101), 0.01 * (k % 9), 0.02 * (k % 4), "A", "O",
             dt.datetime(1998, 1, 1), k, 5.0, "F", "1-URGENT", 1996 + k % 6, 1 + k % 12, f"Z{k % 3}", "R", f"T{k % 2}", f"B{k % 4}",
             k % 50, 900.0 + k, f"part {k}", f"S{k % 2}", 1.5 * k, f"sup {k % 5}", 3.0) for k in range(N)]
    df = spark.createDataFrame(rows, """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp,
        o_custkey long, o_totalprice double, o_orderstatus string, o_orderpriority string, year int, month int, zone string,
        region string, ptype string, brand string, p_size int, p_retailprice double, p_name string, segment string,
        c_acctbal double, s_name string, s_acctbal double""")
    seen = spark.sparkContext.accumulator(0)

    def price(v):
        seen.add(1)
        return v

    return df.withColumn("l_extendedprice", F.udf(price, "double").asNondeterministic()("l_extendedprice")), seen


@pytest.mark.parametrize("module, query", [
    (q_eda, "q_raw_vs_filtered"), (q_features, "q_target_transform_fit"), (q_features, "q_winsor_scale"),
    (q_metrics, "q_price_band_metrics"), (q_models, "q_train_val_refit")])
def test_each_sales_row_is_computed_once(monkeypatch, spark, counted_sales, module, query):
    df, seen = counted_sales
    monkeypatch.setattr(module, "sales", lambda *_: df)
    assert getattr(module, query)(spark, "unused").collect()
    assert seen.value == N


def test_cut_keeps_rows_and_deals_them(spark):
    df = spark.range(0, 400_000, 1, 1).select("id", F.xxhash64("id").alias("x"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("y"))
    plain, dealt = base.cut(df, "id", "y", "id"), base.cut(df, deal=("id",))
    assert plain.columns == ["id", "y"] and dealt.columns == df.columns
    assert plain.rdd.getNumPartitions() == 1 < dealt.rdd.getNumPartitions()
    assert dealt.exceptAll(df).isEmpty() and dealt.count() == 400_000
