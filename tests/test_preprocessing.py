import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.operators import columns as cl
from tessera.preprocessing import chain, state
from tessera.sources import tables as io

KEEP = ["id"]


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(400).select(
        "id", F.when(i < 280, "train").when(i < 340, "val").otherwise("test").alias("split"),
        F.when(i % 9 != 0, (i % 13).cast("double")).alias("a"), ((i % 13) * 2 + 1).cast("double").alias("a_copy"),
        F.concat((i % 50).cast("string"), F.lit(",25")).alias("number_text"), F.concat(F.lit("g"), (i % 3).cast("string")).alias("g"),
        F.when(i >= 280, "unseen").otherwise(F.concat(F.lit("c"), (i % 2).cast("string"))).alias("binary"),
        F.concat(F.lit("o"), (i % 150).cast("string")).alias("many"), F.concat(F.lit("u"), i.cast("string")).alias("unique"),
        F.lit("k").alias("same"), F.to_date(F.lit("2020-01-05")).alias("day"), F.when(i >= 280, 1.0).alias("late"),
        (F.when(i == 5, 1e6).otherwise(100 + i % 7)).cast("double").alias("y"))


def fitted(rows, profile, **kw):
    steps = [*chain.base_steps("y", KEEP, outliers={"group_col": "g"}, impute={"group_col": "g"}),
             *chain.profile_steps(profile, "y", KEEP, encode={"order_cols": ["id"]}, max_distinct=200, **kw)]
    return chain.fit_profile(rows, steps)


def test_tree_profile_saved_and_loaded(spark, rows):
    folder = tempfile.mkdtemp(prefix="tessera-chain-")
    model = fitted(rows, "tree")
    model.write().save(f"{folder}/m")
    loaded = PipelineModel.load(f"{folder}/m")
    assert [type(s) for s in loaded.stages] == [state.StepModel] * len(model.stages)
    out = loaded.transform(rows)
    assert sorted(map(str, out.collect())) == sorted(map(str, model.transform(rows).collect()))
    got = {r.id: r for r in out.collect()}
    # the outlier left the training rows; other splits keep all of theirs
    assert 5 not in got and len([i for i in got if i >= 280]) == 120
    # a one-hot column opposite to an earlier one stays, a correlated number goes
    assert {"binary_c0", "binary_c1"} <= set(out.columns) and "a" in out.columns and "a_copy" in out.columns
    assert "same_k" not in out.columns and "late" not in out.columns and "unique" not in out.columns
    assert got[300].binary_c0 == 0.0 and got[300].binary_c1 == 0.0  # unseen category
    assert {r.many__ord for r in got.values()} == {float(k) for k in range(1, 151)}
    assert got[7].number_text == 7.25 and got[0].y == pytest.approx(math.log1p(got[0].y_orig))
    train = [r for r in rows.collect() if r.split == "train" and r.id != 5]
    assert got[0].a == np.median([r.a for r in train if r.g == "g0" and r.a is not None])


def test_categorical_profile(spark, rows):
    out = fitted(rows, "categorical", correlation=0.9).transform(rows)
    assert "unique" not in out.columns and {"binary", "many"} <= set(out.columns)  # over 200 values goes, text stays
    assert "same" not in out.columns
    meta = chain.profile_meta(fitted(rows, "categorical"), "y", "categorical", out, KEEP)
    assert meta["transform"] == {"kind": "log"} and "binary" in meta["categorical"] and "y" not in meta["features"]


def test_fill_and_projection(spark):
    df = spark.createDataFrame([("train", None, None, None, 1.0), ("test", 2.0, 3.0, "t", None)], "split string, c__ord double, n double, s string, m double")
    fill = state.make("fill", keep=["split"]).fit(df)
    assert [tuple(r) for r in fill.transform(df).orderBy("n").collect()] == [("train", -1.0, 0.0, cl.MISSING, 1.0), ("test", 2.0, 3.0, "t", 0.0)]
    numeric = state.make("numeric", keep=["split"]).fit(df)
    assert numeric.transform(df.drop("m")).columns == ["split", "c__ord", "n", "m"]
    assert numeric.transform(df.drop("m")).where("m = 0").count() == 2
    with pytest.raises(ValueError):
        state.make("unknown")


def test_one_split_is_rewritten(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-sink-"), "p")
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "x int, split string")
    io.write_profile(df, path, meta={"target": "y"})
    io.write_profile(spark.createDataFrame([(20, "val"), (21, "val")], "x int, split string"), path)
    val, meta = io.read_profile(spark, path, "val")
    assert sorted(r.x for r in val.collect()) == [20, 21] and meta == {"target": "y"}
    assert {r.x for r in spark.read.parquet(path).collect()} == {1, 3, 20, 21}
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_correlations_in_one_scan(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6)) * [1, 1e3, 1e-4, 1, 1, 1] + [0, 1e6, 5, 0, 0, 3]
    x[:, 3] = 0.999 * x[:, 0] + 0.001 * x[:, 3]
    x[:, 5] = 3.0
    holes = rng.random(x.shape) < 0.3
    rows = [tuple(None if h else float(v) for v, h in zip(r, hs, strict=True)) for r, hs in zip(x, holes, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"`c.{i}` double" for i in range(6))).repartition(5)
    names = df.columns
    got = cl.correlation_matrix(df, names)
    want = df.toPandas().corr().to_numpy()
    assert np.allclose(got[:5, :5], want[:5, :5], atol=1e-9) and np.isnan(got[5]).all()
    assert cl.correlated_to_drop(df, 0.98) == ["c.3"] and cl.correlated_to_drop(df, 0.98, exempt=("c.3",)) == []
    wide = spark.range(200).select(*[F.hash(F.col("id"), F.lit(k)).cast("double").alias(f"w{k}") for k in range(464)])
    assert cl.correlation_matrix(wide, wide.columns).shape == (464, 464)
    assert cl.correlation_pairs(spark.createDataFrame([], "a double, b double"), ["a", "b"]) == {("a", "b"): None}
