import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.validate import quick_validate, template_config
from tessera.sources import tables as io


def test_writers_and_split_pruning(spark):
    d = tempfile.mkdtemp(prefix="tessera-io-")
    df = spark.createDataFrame([(1, 2.0, "train"), (2, 3.0, "test"), (3, 4.0, "train")],
                               "row_id int, y double, split string")
    io.write_profile(df, os.path.join(d, "profile"))
    tr = io.read_split(spark, os.path.join(d, "profile"), "train")
    assert sorted(r.row_id for r in tr.collect()) == [1, 3]
    assert "PartitionFilters: [isnotnull(split" in tr._jdf.queryExecution().executedPlan().toString()
    io.save_table(df, os.path.join(d, "t_csv"), fmt="csv", compression="gzip")
    assert spark.read.option("header", "true").csv(os.path.join(d, "t_csv")).count() == 3
    with pytest.raises(ValueError):
        io.save_table(df, os.path.join(d, "bad"), fmt="orc")
    io.write_metadata(spark, {"target": "y", "lambda": 0.2}, os.path.join(d, "meta"))
    assert io.read_metadata(spark, os.path.join(d, "meta")) == {"target": "y", "lambda": 0.2}


def test_catalog_and_alias(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "Id long, Nome string, Prezzo double")
    cat = io.extract_catalog(spark, {"atti_immobili": df, "atti": df}, kinds={"atti": "view"})
    rows = {(r.table, r.column): (r.alias, r.kind, r.type) for r in cat.collect()}
    assert rows[("atti_immobili", "Id")] == ("AI", "table", "integer")
    assert rows[("atti", "Prezzo")] == ("A", "view", "float")


def test_catalog_figures(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, None), (2, "", None)], "Id long, Nome string, V array<int>")
    got = {(r.table, r.column): (r.rows, r.nulls, r.distinct) for r in io.catalog_figures({"t": df, "u": df.limit(1)}).collect()}
    assert got[("t", "Id")] == (3, 0, 2) and got[("t", "Nome")] == (3, 1, 2) and got[("t", "V")] == (3, 3, 0)
    assert got[("u", "Id")] == (1, 0, 1)


def test_quick_validate_template(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "id int, v string")
    cfg = template_config(df, "id")
    assert cfg.required_columns == ["id", "v"] and cfg.dtypes == {"id": "numeric", "v": "string"}
    rep = {r.check for r in quick_validate(spark, df, "id").collect()}
    assert {"uniqueness", "missing_values"} <= rep
