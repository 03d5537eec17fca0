"""Queries of several passes over joined rows compute each row once."""
import pytest
from pyspark.sql import functions as F

from tessera.plans import q_assembly, q_eda, q_features, q_metrics

N = 40


@pytest.fixture
def counted(spark):
    """Sales rows with the columns asked for here, and a count of how often a price was computed."""
    rows = [(k, k, k, 1 + k % 3, float(6 + k % 30), 1000.0 + 37.0 * (k * k % 101), 0.01 * (k % 9), 0.02 * (k % 4), 1996 + k % 6, 2 + k % 9,
             f"NATION_{2 * (k % 3)}", "FURNITURE", 1.5 * k) for k in range(1, N + 1)]
    df = spark.createDataFrame(rows, """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, year int, month int, zone string, segment string, c_acctbal double""")
    df = df.withColumns({c: F.lit("x") for c in ("ptype", "brand", "s_name", "p_name", "l_returnflag", "l_shipdate")})
    seen = spark.sparkContext.accumulator(0)

    def price(v):
        seen.add(1)
        return v

    return df.withColumn("l_extendedprice", F.udf(price, "double").asNondeterministic()("l_extendedprice")), seen


@pytest.mark.parametrize("module, query", [(q_eda, "q_normality_tests"), (q_eda, "q_quantile_normal"), (q_metrics, "q_psi_drift"),
                                           (q_features, "q_data_filters")])
def test_each_row_is_computed_once(monkeypatch, spark, counted, module, query):
    df, seen = counted
    monkeypatch.setattr(module, "sales", lambda *_: df)
    assert getattr(module, query)(spark, "unused").collect()
    assert seen.value == N


def test_the_wide_table_is_joined_once(monkeypatch, spark):
    rows = [(k // 2, 2, 100.0 + k // 2, 1.0 + k % 5, 3.0 + k % 7, None if k % 11 == 0 else 2.0) for k in range(N)] + [(N, 3, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "A_o_orderkey long, A_declared_rows long, A_o_totalprice double, OV_vmin_normal double, OV_vmax_normal double, "
                                     "AI_surface double")
    seen = spark.sparkContext.accumulator(0)

    def least(v):
        seen.add(1)
        return v

    monkeypatch.setattr(q_assembly, "wide_table", lambda *_: df.withColumn("OV_vmin_normal", F.udf(least, "double").asNondeterministic()("OV_vmin_normal")))
    out = q_assembly.q_redistribution_stats(spark, "unused").collect()
    total = {}
    for key, _, price, low, high, surface in rows[:-1]:
        total[key] = total.get(key, 0.0) + ((low + high) / 2 * surface if surface else 0.0)
    coef = sorted((100.0 + k) / v if v > 0 else 1.0 for k, v in total.items())
    assert out[0]["n_groups"] == N // 2 and out[0]["coef_median"] == pytest.approx((coef[N // 4 - 1] + coef[N // 4]) / 2, abs=1e-6)
    assert seen.value == N + 1
