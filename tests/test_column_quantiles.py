"""Quantiles of many columns and groupings on whole batches; constant columns told by their ends."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import columns as cl
from tessera.operators import quantiles as qt
from tessera.operators.impute import fit_imputer

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def frame(spark, n=3000):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, n), np.exp(rng.normal(0, 30, n)) * rng.choice([-1, 1], n)
    rows = [(None if i % 50 == 7 else f"g{i % 3}", f"h{i % 700}", None if i % 9 == 0 else float(a[i]), float("nan") if i % 11 == 0 else float(b[i]),
             int(i % 4), float("inf") if i % 5 == 0 else float("-inf") if i % 7 == 0 else float(a[i]), None) for i in range(n)]
    return spark.createDataFrame(rows, "g string, h string, a double, b double, k int, far double, nothing double").repartition(3), rows


def plain(rows, at, by):
    groups = {}
    for r in rows:
        key = tuple(r[i] for i in by)
        if r[at] is not None and r[at] == r[at] and None not in key:
            groups.setdefault(key, []).append(float(r[at]))
    with np.errstate(all="ignore"):
        return {k: [v[int(p * (len(v) - 1))] if p * (len(v) - 1) == int(p * (len(v) - 1)) or v[int(p * (len(v) - 1))] == v[int(p * (len(v) - 1)) + 1]
                    else v[int(p * (len(v) - 1))] + (p * (len(v) - 1) - int(p * (len(v) - 1))) * (v[int(p * (len(v) - 1)) + 1] - v[int(p * (len(v) - 1))])
                    for p in PROBS] for k, v in ((k, sorted(v)) for k, v in groups.items())}


@pytest.mark.parametrize("exact, cells, chunk, told", [(100_000, 1 << 17, 1 << 16, 50_000), (20, 1 << 17, 500, 50_000), (20, 64, 1000, 50_000), (20, 4096, 700, 3)])
def test_columns_give_the_quantiles_of_rows(spark, monkeypatch, exact, cells, chunk, told):
    for k, v in (("EXACT", exact), ("CELLS", cells), ("CHUNK", chunk), ("TOLD", told)):
        monkeypatch.setattr(qt, k, v)
    df, rows = frame(spark)
    names = df.columns
    specs = [([], c) for c in ("a", "b", "k", "far", "nothing")] + [(["g"], c) for c in ("a", "far")] + [(["h"], "b"), (["g", "k"], "a")]
    got = {(r["_spec"], r["_key"]): r["q"] for r in qt.long_quantiles(df, specs, PROBS, as_list="q").collect()}
    want = {}
    for s, (by, c) in enumerate(specs):
        for key, v in plain(rows, names.index(c), [names.index(x) for x in by]).items():
            parts = ",".join(f'"{n}":' + (f'"{x}"' if isinstance(x, str) else str(x)) for n, x in zip(by, key, strict=True))
            want[s, "{" + parts + "}"] = v
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert np.allclose(got[k], v, rtol=1e-12, atol=0, equal_nan=True), k


def test_many_columns_make_no_row_of_a_value(spark):
    df, _ = frame(spark, 300)
    plan = qt.long_quantiles(df, [([], "a"), ([], "b"), (["g"], "a")], [0.5])._jdf.queryExecution().toString()
    assert "Generate inline" not in plan


def test_medians_of_groups_and_of_all_rows(spark):
    df, rows = frame(spark)
    fit = fit_imputer(df, "median", "g", ["a", "k", "nothing"], [])
    assert fit.numeric["nothing"] is None and fit.numeric["a"] == pytest.approx(np.median([r[2] for r in rows if r[2] is not None]), rel=1e-12)
    got = {r["g"]: (r["_gn0"], r["_gn1"], r["_gn2"]) for r in fit.groups.df.collect()}
    assert got.keys() == {"g0", "g1", "g2"}
    for g, (a, k, nothing) in got.items():
        assert a == pytest.approx(np.median([r[2] for r in rows if r[0] == g and r[2] is not None]), rel=1e-12)
        assert k == np.median([r[4] for r in rows if r[0] == g]) and nothing is None


def test_only_columns_without_two_ends_are_counted(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0.0, "x", None, float("nan"), 5), (2, -0.0, "x", None, float("nan"), None), (3, 0.0, "x", "y", float("nan"), 5)],
                               "a int, zero double, same string, rare string, no double, five int")
    counted = []
    real = cl.distinct_counts
    monkeypatch.setattr(cl, "distinct_counts", lambda d, cols, exact=True: counted.extend(cols) or real(d, cols, exact))
    assert cl.non_descriptive_columns(df, 0.5) == ["same", "rare", "no"]  # a NULL beside a value makes two, zero has two signs
    assert "a" not in counted


def test_only_text_like_a_number_is_cast(spark):
    texts = ["1,5", " 2 ", "-.5", "+3e2", "1d", "2F", "0x1p3", "inf", "-Infinity", "+INF", "NaN", "nan", "NATION_3", "information", "b12", "", " ", "-", ".", "1.2.3",
             "e5", "\t7\n", "\u00a08", "--1", None, "٣", "1_000", "infinity ", "Inf1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cast = F.regexp_replace("t", ",", ".").try_cast("double")
    got = df.select("t", cl.numeric_like("t").alias("now"), F.when(~F.isnan(cast), cast).alias("plain"))
    assert [r for r in got.collect() if r.now != r.plain] == []
    assert "RLIKE" in got._jdf.queryExecution().toString()
