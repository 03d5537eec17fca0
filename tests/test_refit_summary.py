"""Refit on train and validation, quartile residuals, floors and table summaries."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import columns as cl
from tessera.operators import diagnostics as dg
from tessera.operators import metrics as mt
from tessera.operators import models as md


def _line(spark, n, shift=0.0):
    return spark.range(n).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                 ((F.col("id") % 17) * 3.0 + (F.col("id") % 5) + shift).alias("y"))


def test_refit_chooses_on_validation_and_fits_on_both(spark):
    train, val = _line(spark, 200), _line(spark, 100, shift=6.0)
    candidates = {"weak": (["b"], md.regressor("linear")), "strong": (["a"], md.regressor("linear"))}
    chosen, scores, model = md.tune_refit(train, val, "y", candidates)
    assert chosen == "strong" and scores["strong"] < scores["weak"]
    both = train.unionByName(val).toPandas()
    slope, intercept = np.polyfit(both.a, both.y, 1)
    assert model.stages[-1].coefficients[0] == pytest.approx(slope)
    assert model.stages[-1].intercept == pytest.approx(intercept)


def test_refit_without_validation_rows(spark):
    train, none = _line(spark, 50), _line(spark, 0)
    chosen, scores, model = md.tune_refit(train, none, "y", {"only": (["a", "b"], md.regressor("linear"))})
    assert (chosen, scores) == ("only", {"only": None})
    assert model.stages[-1].coefficients.toArray() == pytest.approx([3.0, 1.0])
    with pytest.raises(ValueError, match="validation"):
        md.tune_refit(train, none, "y", {"p": (["a"], md.regressor("linear")), "q": (["b"], md.regressor("linear"))})


def test_refit_leaves_out_rows_without_a_label(spark):
    train = _line(spark, 60).union(spark.createDataFrame([(1e6, 0.0, None)], "a double, b double, y double"))
    _, _, model = md.tune_refit(train, _line(spark, 30), "y", {"m": (["a", "b"], md.regressor("linear"))})
    assert model.stages[-1].coefficients.toArray() == pytest.approx([3.0, 1.0])


def test_random_search_needs_time_blocks_or_a_statement(spark):
    with pytest.raises(ValueError, match="fold_col"):
        md.random_search(_line(spark, 20), ["a"], "y", md.regressor("linear"), {"regParam": ("float", 0.0, 1.0)}, n_trials=1)
    best, scores, _ = md.random_search(_line(spark, 60), ["a"], "y", md.regressor("ridge"), {"regParam": ("float", 0.0, 1.0)},
                                       n_trials=2, random_split=True)
    assert set(best) == {"regParam"} and len(scores) == 2


def test_quartile_residuals_equal_qcut(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": np.where(np.arange(400) % 2 == 0, "u", None), "y_true": rng.normal(50, 9, 400).round(1)})
    pdf["y_pred"] = pdf.y_true + rng.normal(0, 1, 400)
    df = spark.createDataFrame([(g, float(y), float(p)) for g, y, p in pdf.itertuples(index=False)] + [("u", None, 1.0), ("u", 3.0, math.nan), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0)],
                               "g string, y_true double, y_pred double")
    got = {(r.g, r.quartile): r for r in dg.residuals_by_quartile(df, by=["g"]).collect()}
    assert {k[0] for k in got} == {"u", None}
    for g, part in (("u", pdf[pdf.g == "u"]), (None, pdf[pdf.g.isna()])):
        quarter = pd.qcut(part.y_true, 4, labels=["Q1", "Q2", "Q3", "Q4"])
        for name, r in (part.y_true - part.y_pred).groupby(quarter, observed=True):
            mine = got[g, name]
            assert mine["count"] == len(r)
            assert [mine.residual_mean, mine.residual_std, mine.residual_median] == pytest.approx([r.mean(), r.std(), r.median()])


def test_summary_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, math.nan), (3, "c", 2.0)], "n int, `t.x` string, d double").withColumn("day", F.current_date())
    row = cl.dataset_summary(df).first()
    assert (row.n_rows, row.n_columns, row.n_numeric, row.n_categorical, row.n_datetime, row.total_missing) == (3, 4, 2, 1, 1, 4)
    assert row.missing_pct == pytest.approx(100 * 4 / 12)
    empty = cl.dataset_summary(df.where("false")).first()
    assert (empty.n_rows, empty.total_missing, empty.missing_pct) == (0, 0, None)


def test_floor_of_the_percentage_error(spark):
    df = spark.createDataFrame([(10.0, 15.0), (200.0, 150.0), (-10.0, -15.0)], "y_true double, y_pred double")
    got = df.agg(*mt.metric_aggs(mape_floor=100.0, exact=False)).first().mape
    assert got == pytest.approx((5 / 100 + 50 / 200 + 5 / 100) / 3)
