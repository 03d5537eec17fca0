"""Nothing is decided on a prefix, dropped or clamped; small reproductions."""
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import wkt
from tessera.operators import assembly as asm
from tessera.operators import diagnostics as dg
from tessera.operators import encode as en
from tessera.operators import filters as fl
from tessera.operators import metrics as mt
from tessera.operators import models as md
from tessera.operators import target as tg
from tessera.operators.eda import cramers_v
from tessera.operators.quantiles import grouped_quantiles
from tessera.operators.spatial import points_in_polygons


def test_tuner_trains_on_the_past_only(spark, monkeypatch):
    rows = spark.range(400).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"), (F.floor(F.col("id") / 100) - 1).cast("int").alias("fold"))
    seen = []
    est = md.regressor("ridge")
    fit = type(est).fitMultiple

    def watch(self, data, grid):
        seen.append((data.agg(F.max("_fold")).first()[0], data.count()))
        return fit(self, data, grid)

    monkeypatch.setattr(type(est), "fitMultiple", watch)
    md.random_search(rows, ["x"], "y", est, {"regParam": ("float", 0.0, 1.0)}, n_trials=2, fold_col="fold")
    assert seen == [(-1, 100), (0, 200), (1, 300)]


def test_json_keys_of_late_rows(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 20, F.lit('{"a": 1}')).otherwise(F.lit('{"b.c": 2, "o": {"p": 1}}')).alias("c"))
    out = tx.extract_json_features(df, ["c"])
    assert out.columns == ["c__b.c"] and out.where("`c__b.c` = '2'").count() == 1980


def test_geometry_by_share(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 200, "POINT (1 2)").otherwise("some text").alias("t"), F.lit("POINT (1 2)").alias("p"))
    assert wkt.detect_geometry_columns(df) == {"p": "POINT"}


def test_holes_and_parts(spark):
    z = spark.createDataFrame([(1, "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"),
                               (2, "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((2000 0, 2001 0, 2001 1, 2000 1, 2000 0)))"), (3, None), (4, "POINT (1 1)")],
                              "zone int, w string")
    pts = spark.createDataFrame([(5.0, 5.0), (1.5, 1.5), (0.5, 0.5), (2000.5, 0.5), (4.0, 5.0), (1000.0, 0.5)], "x double, y double")
    got = {(r.zone, r.x, r.y) for r in points_in_polygons(pts, "x", "y", z, "w").collect()}
    assert got == {(1, 1.5, 1.5), (1, 0.5, 0.5), (2, 0.5, 0.5), (2, 2000.5, 0.5)}


def test_lambda_outside_the_first_bracket(spark):
    df = spark.range(1, 3000).select(F.pow(F.lit(5.0) + (F.col("id") % 97) / 97.0 + F.sin("id") / 5, F.lit(1 / 4.5)).alias("y"))
    lam = tg.fit_lambda(df, "y", "boxcox")
    near = tg._llf_grid(df, "y", "boxcox", [lam - 0.05, lam, lam + 0.05], 0.0)
    assert near[1] >= max(near[0], near[2])


def test_price_pivot_keeps_repeated_rows(spark):
    df = spark.createDataFrame([("k", "A", 1.0), ("k", "A", 2.0), ("k", "B", None), ("m", "B", 5.0)], "k string, s string, v double")
    got = sorted(map(str, asm.pivot_states(df, ["k"], "s", ["A", "B"], ["v"]).select("k", "v_a", "v_b", "has_a", "has_b").collect()))
    assert got == sorted(["Row(k='k', v_a=1.0, v_b=None, has_a=True, has_b=True)", "Row(k='k', v_a=2.0, v_b=None, has_a=True, has_b=True)",
                          "Row(k='m', v_a=None, v_b=5.0, has_a=False, has_b=True)"])


def test_not_in(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    keys = spark.createDataFrame([(1,), (None,)], "b int")
    assert asm.not_in(df, "a", keys, "b").count() == 0
    assert [r.a for r in asm.not_in(df, "a", keys.where("b = 1"), "b").collect()] == [2]
    assert asm.not_in(df, "a", keys.limit(0), "b").count() == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asm.not_in(df, "a", keys.where("b = 1"), "b")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan


def test_psi_reports_features_without_baseline(spark):
    rows = [("f0", s, float(i)) for s in ("train", "test") for i in range(50)] + [("f1", "test", 1.0)]
    out = {r.feature: r.psi for r in dg.psi(spark.createDataFrame(rows, "feature string, split string, value double")).collect()}
    assert out["f0"] == pytest.approx(0.0, abs=1e-9) and "f1" in out and out["f1"] is None


def test_voting_skips_missing_members(spark):
    df = spark.createDataFrame([(1, "a", 10.0, 10.0), (1, "b", 10.0, None)], "k int, model string, y_true double, y_pred double")
    assert mt.voting_ensemble(df, ["b", "a"], ["k"]).first().y_pred == 10.0


def test_yates_with_an_empty_cell(spark):
    rows = [("a", "x")] * 6 + [("b", "y")] * 3 + [("a", "y")] * 1
    n, cells = 10, {("a", "x"): 6, ("a", "y"): 1, ("b", "x"): 0, ("b", "y"): 3}
    e = {(p, q): sum(v for (s, _), v in cells.items() if s == p) * sum(v for (_, t), v in cells.items() if t == q) / n for p, q in cells}
    want = sum((abs(o - e[c]) - min(0.5, abs(o - e[c]))) ** 2 / e[c] for c, o in cells.items())
    assert cramers_v(spark.createDataFrame(rows, "x string, y string"), "x", "y").first().chi2 == pytest.approx(want)


def test_empty_frame_has_no_fence(spark):
    assert fl.iqr_filter(spark.createDataFrame([], "v double"), "v").count() == 0


def test_new_text_columns_are_dropped(spark):
    train = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 2.0)] * 5, "c string, y double")
    fit = en.fit_encoders(train, "y")
    out = en.transform_encoders(train.withColumn("late", F.lit("z")).withColumn("key", F.lit("k")), fit, keep=["key"])
    assert "late" not in out.columns and "key" in out.columns


def test_quantiles_with_a_hot_value(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    values = np.concatenate([np.full(5000, 3.0), rng.normal(3, 5, 7000), [math.pi]])
    df = spark.createDataFrame([(int(i % 3 == 0), float(v)) for i, v in enumerate(values)] + [(7, 1.5), (8, None)], "g int, v double").repartition(5)
    probs = [0.0, 0.05, 0.25, 0.5, 0.777, 0.99, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    got = {r.g: [r[n] for n in names] for r in grouped_quantiles(df, ["g"], "v", probs, names).collect()}
    for g in (0, 1):
        assert got[g] == pytest.approx(np.quantile([v for i, v in enumerate(values) if int(i % 3 == 0) == g], probs).tolist())
    assert got[7] == [1.5] * 7 and 8 not in got


def test_quantiles_narrow_a_hot_group(spark, monkeypatch):
    import numpy as np

    from tessera.operators import quantiles as qt
    monkeypatch.setattr(qt, "EXACT", 500)
    monkeypatch.setattr(qt, "BINS", 32)
    n = 200_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise("far").alias("g"),
        F.when(F.col("id") % 3 == 2, F.pow(F.lit(10.0), (F.col("id") % 600).cast("double") - 300)).otherwise(
            F.when(F.col("id") % 10 < 4, F.lit(7.0)).otherwise((F.col("id") * 7919 % n) / 3.0)).alias("v"))
    df = df.union(spark.createDataFrame([("inf", float("inf")), ("inf", 1.0), ("inf", float("-inf")), ("nan", float("nan")), ("one", 2.5)], "g string, v double"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.937, 1.0]
    seen = {r[0]: list(r)[1:] for r in qt.grouped_quantiles(df, ["g"], "v", probs).collect()}
    pdf = df.toPandas()
    for g in (None, "hot", "far", "one"):
        v = pdf["v"][pdf["g"].isna() if g is None else pdf["g"] == g]
        assert np.allclose(seen[g], np.quantile(v, probs), rtol=1e-12), g
    assert seen["inf"][0] == -math.inf and seen["inf"][3] == 1.0 and seen["inf"][5] == math.inf and "nan" not in seen


def test_quantile_tasks_stay_bounded(spark, monkeypatch):
    from tessera.operators import quantiles as qt
    widest = []
    narrowed = qt._narrowed
    monkeypatch.setattr(qt, "_narrowed", lambda d, k, wide, first: widest.append(wide.agg(F.max("_bq_c")).first()[0]) or narrowed(d, k, wide, first))
    df = spark.range(1_000_000).select(F.lit("g").alias("g"), F.sqrt(F.col("id") * 1.5).alias("v"))
    q = qt.grouped_quantiles(df, ["g"], "v", [0.5], ["m"])
    assert widest == [1_000_000]  # one round: a bin of the million distinct values is under EXACT
    assert q.first()["m"] == pytest.approx((math.sqrt(499_999 * 1.5) + math.sqrt(500_000 * 1.5)) / 2)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("InMemoryTableScan")[0]
