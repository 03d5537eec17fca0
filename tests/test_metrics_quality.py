import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import diagnostics as dg
from tessera.operators import metrics as mt
from tessera.operators import outliers as ol
from tessera.operators.columns import check_column_name
from tessera.operators.validate import ValidationConfig, Validator


def preds(spark, yt, yp):
    return spark.createDataFrame([("m", "test", float(a), float(b)) for a, b in zip(yt, yp)],
                                 "model string, split string, y_true double, y_pred double")


def test_metrics_identical_and_close(spark):
    m = mt.regression_metrics(preds(spark, [100, 200, 300], [100, 200, 300])).first()
    assert m.r2 == 1.0 and m.rmse == 0.0 and m.mae == 0.0 and m.mape == 0.0
    m = mt.regression_metrics(preds(spark, [100, 200, 300, 400], [110, 190, 310, 390])).first()
    assert 0.8 < m.r2 < 1.0 and m.rmse == pytest.approx(10.0) and m.medae == 10.0
    m = mt.regression_metrics(preds(spark, [0, 100], [1, 100])).first()
    assert np.isfinite(m.mape)


def test_overfit_gap(spark):
    df = spark.createDataFrame([("m", "train", 0.99, 0.1, 0.1, 0.1, 0.1, 0.99, 0.1),
                                ("m", "test", 0.5, 2.0, 4.0, 2.0, 0.2, 0.5, 2.0)],
                               "model string, split string, r2 double, rmse double, mse double, mae double, "
                               "mape double, explained_variance double, medae double")
    d = mt.overfit_diagnostics(df).first()
    assert d.gap_r2 == pytest.approx(0.49) and d.ratio_rmse == pytest.approx(20.0)


def test_grouped_metrics_min_size(spark):
    rows = [("m", "test", float(y), float(y + 5), "A" if y < 40 else "B") for y in range(50)]
    df = spark.createDataFrame(rows, "model string, split string, y_true double, y_pred double, g string")
    out = {r.group: r["count"] for r in mt.grouped_metrics(df, "g", min_group_size=20).collect()}
    assert out == {"A": 40}


def test_residual_summary_population_moments(spark):
    df = preds(spark, [100, 200, 300], [110, 190, 310])
    r = dg.residual_summary(df).first()
    assert r.mean == pytest.approx(-10 / 3) and r.std == pytest.approx(np.std([-10, 10, -10]))


def test_psi_no_drift_vs_drift(spark):
    rnd = np.random.default_rng(0)
    a = rnd.normal(0, 1, 1000)
    rows = [("train", float(v)) for v in a] + [("test", float(v)) for v in rnd.normal(0, 1, 1000)]
    df = spark.createDataFrame(rows, "split string, f double")
    assert dg.psi(dg.to_long(df, ["f"])).first().psi < 0.15
    rows2 = [("train", float(v)) for v in a] + [("test", float(v)) for v in rnd.normal(2, 1.5, 1000)]
    assert dg.psi(dg.to_long(spark.createDataFrame(rows2, "split string, f double"), ["f"])).first().psi > 0.15


def test_ks_statistic_matches_brute_force(spark):
    rnd = np.random.default_rng(2)
    a, b = np.round(rnd.normal(0, 1, 300), 1), np.round(rnd.normal(0.3, 1, 200), 1)
    df = spark.createDataFrame([("train", float(v)) for v in a] + [("test", float(v)) for v in b],
                               "split string, f double")
    d = dg.ks_statistic(dg.to_long(df, ["f"])).first().ks_stat
    xs = np.union1d(a, b)
    exp = max(abs((a <= x).mean() - (b <= x).mean()) for x in xs)
    assert d == pytest.approx(exp)


def test_intervals_cover(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(0, 1, 400)
    y = 2 * x + rnd.normal(0, 1, 400)
    df = preds(spark, y, 2 * x)
    iv = dg.residual_intervals(df, df)
    q = mt.interval_quality(iv, "lo_80", "hi_80").first()
    q9 = mt.interval_quality(iv, "lo_90", "hi_90").first()
    assert 0.6 < q.coverage < 1.0 and q9.mean_width > q.mean_width


def test_iqr_zscore_and_null_group(spark):
    vals = [100.0 + i % 7 for i in range(95)] + [200.0, 300.0, 400.0, -50.0, -100.0]
    df = spark.createDataFrame([(v, "g" if i % 10 else None) for i, v in enumerate(vals)], "t double, g string")
    glob = ol.flag_inliers(df, "t", "iqr")
    assert glob.where(~F.col("is_inlier")).count() == 5
    grp = ol.flag_inliers(df, "t", "iqr", group_col="g", min_group_size=10)
    assert grp.where(F.col("g").isNull() & F.col("is_inlier")).count() == 0


def test_isolation_forest_deterministic(spark):
    rnd = np.random.default_rng(42)
    vals = list(rnd.normal(100, 10, 95)) + [200, 300, 400, -50, -100]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id int, target double")
    a = ol.isolation_forest_inliers(df, "target", 0.05, id_cols=["id"], n_trees=30)
    b = ol.isolation_forest_inliers(df.repartition(3), "target", 0.05, id_cols=["id"], n_trees=30)
    fa = {r.id: r.is_inlier_iso for r in a.collect()}
    fb = {r.id: r.is_inlier_iso for r in b.collect()}
    assert fa == fb
    out = [i for i, v in fa.items() if not v]
    assert {96, 97, 98, 99} <= set(out) and len(out) <= 8


def test_column_names():
    assert check_column_name("AI_Superficie_m²") and check_column_name("Valore medio €")
    for bad in ["price; DROP TABLE users", "col--comment", "a\nb"]:
        assert not check_column_name(bad)


def test_validator_uniqueness_and_fk(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (3, "b", 7), (4, "a", 99)], "id int, k string, v int")
    parent = spark.createDataFrame([(5,), (6,)], "v int")
    cfg = ValidationConfig(unique=[["k"]], foreign_keys={"v": (parent, "v")}, ranges={"v": (0, 50)})
    rep = {(r.check, r.column): (r.n_violations, r.sample_ids)
           for r in Validator(spark, "id", cfg).validate(df, "t").collect()}
    assert rep[("uniqueness", "k")] == (2, "2,4")
    assert rep[("referential_integrity", "v")] == (2, "3,4")
    assert rep[("ranges", "v")] == (1, "4")
