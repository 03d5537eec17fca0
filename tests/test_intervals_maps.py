"""Residual bootstrap, quantile map, normal quantile, permutation importance, assembly on demand."""
import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.exprs import normal_quantile
from tessera.functions.wkt import rectangle_wkt
from tessera.operators import assembly as asm
from tessera.operators import diagnostics as dg
from tessera.operators import models as md
from tessera.operators import scale
from tessera.operators.quantiles import column_quantiles


def ranks_by_hand(key, draws, n, seed=42):
    p, out = dg.DRAW_MOD, []
    for b in range(draws):
        m = key % p
        a = (m * 48271 + (b + 1) * 69621 + seed) % p
        c = ((a * a + 12345) % p * 48271 + m) % p
        out.append(min(math.floor((c * c + a) % p / p * n), n - 1))
    return out


def test_bootstrap_equals_drawn_residuals(spark):
    rng = np.random.default_rng(0)
    res = np.round(rng.normal(0, 10, 700), 1)  # ties
    train = spark.createDataFrame([(i, float(r), 0.0) for i, r in enumerate(res)] + [(9000, None, 1.0)], "id long, y_true double, y_pred double")
    keys = [0, 1, 5, 2 ** 40 + 3, -7]
    test = spark.createDataFrame([(k, 1.0, 100.0 + i) for i, k in enumerate(keys)] + [(5, 1.0, 7.0), (None, 1.0, 1.0)],
                                 "id long, y_true double, y_pred double").withColumn("_place", F.lit("x"))
    got = dg.bootstrap_intervals(train, test, "id", ["id"])
    assert got.columns == [*test.columns, "lo_80", "hi_80", "lo_90", "hi_90"] and got.count() == 7
    sorted_res = np.sort(res)
    for r in got.collect():
        if r.id is None:
            assert r.lo_80 is None and r.hi_90 is None
            continue
        drawn = sorted_res[ranks_by_hand(r.id, 100, 700)]
        want = np.quantile(drawn, [0.1, 0.9, 0.05, 0.95]) + r.y_pred
        assert np.allclose([r.lo_80, r.hi_80, r.lo_90, r.hi_90], want)


def test_bootstrap_without_residuals_and_without_rows(spark):
    none = spark.createDataFrame([], "id long, y_true double, y_pred double")
    some = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 2.0)], "id long, y_true double, y_pred double")
    assert [r.lo_90 for r in dg.bootstrap_intervals(none, some, "id", ["id"]).collect()] == [None, None]
    assert dg.bootstrap_intervals(some, none, "id", ["id"]).count() == 0


def test_bootstrap_coverage_is_near_that_of_the_limit(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, float(v), 0.0) for i, v in enumerate(rng.standard_t(3, 6000))], "id long, y_true double, y_pred double")
    train, test = df.where("id < 3000"), df.where("id >= 3000")
    boot, limit = dg.bootstrap_intervals(train, test, "id", ["id"]), dg.residual_intervals(train, test)
    for lv in (80, 90):
        inside = F.avg(F.col("y_true").between(F.col(f"lo_{lv}"), F.col(f"hi_{lv}")).cast("double"))
        a, b = boot.agg(inside).first()[0], limit.agg(inside).first()[0]
        assert abs(a - b) < 0.02 and abs(a - lv / 100) < 0.03


def test_draws_are_even(spark):
    n = 50
    got = spark.range(4000).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(24)), lambda b: dg.draw_rank(F.col("id"), b, n))).alias("r"))
    counts = {r.r: r["count"] for r in got.groupBy("r").count().collect()}
    assert set(counts) == set(range(n)) and all(abs(c - 2000) < 250 for c in counts.values())


def test_normal_quantile(spark):
    ps = [1e-300, 1e-12, 1e-7, 0.001, 0.0749, 0.075, 0.3, 0.5, 0.7, 0.925, 0.9251, 0.999, 1 - 1e-12]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", normal_quantile("p").alias("z")).collect()
    for r in rows:
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-12)
    out = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (None,)], "p double").select(normal_quantile("p").alias("z")).collect()
    assert all(r.z is None for r in out)


def plain_map(train, x, n=1000):
    """Mean of the two interpolations from both ends, ends fixed."""
    refs = np.linspace(0, 1, min(n, len(train)))
    q = np.quantile(train, refs)
    out = 0.5 * (np.interp(x, q, refs) - np.interp(-x, -q[::-1], -refs[::-1]))
    return np.where(x <= q[0], 0.0, np.where(x >= q[-1], 1.0, out))


def test_quantile_map(spark):
    rng = np.random.default_rng(8)
    train = np.concatenate([rng.exponential(5, 1500), np.full(700, 3.0), np.zeros(40)])  # two heaps of ties
    x = np.concatenate([rng.exponential(6, 300), [3.0, 0.0, -1.0, 1e9]])
    tdf = spark.createDataFrame([(float(v),) for v in train] + [(None,), (math.nan,), (math.inf,)], "v double")
    fit = scale.fit_quantile_map(tdf, "v")
    xs = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(900, None), (901, math.nan), (902, -math.inf)], "id long, v double")
    got = {r.id: r.u for r in scale.apply_quantile_map(xs, fit, "u").collect()}
    assert np.allclose([got[i] for i in range(len(x))], plain_map(train, x))
    assert got[900] is None and got[901] is None and got[902] == 0.0
    z = scale.apply_quantile_map(xs, fit, "z", "normal")
    assert z.columns == ["id", "v", "z"]
    for r in z.where("id < 300").collect():
        u = min(max(got[r.id], scale.EDGE), 1 - scale.EDGE)
        assert NormalDist().cdf(r.z) == pytest.approx(u, abs=1e-9)
    moments = scale.apply_quantile_map(spark.createDataFrame([(float(v),) for v in rng.exponential(5, 3000)], "v double"),
                                       scale.fit_quantile_map(tdf.where("v <> 3 and v > 0"), "v"), "z", "normal").agg(F.avg("z"), F.stddev("z")).first()
    assert abs(moments[0]) < 0.1 and abs(moments[1] - 1) < 0.1


def test_quantile_map_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "v double")
    one = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert scale.apply_quantile_map(one, scale.fit_quantile_map(empty, "v"), "u").first().u is None
    assert scale.apply_quantile_map(empty, scale.fit_quantile_map(one, "v"), "u").count() == 0
    assert {r.u for r in scale.apply_quantile_map(one, scale.fit_quantile_map(one, "v"), "u").collect()} == {0.0}
    with pytest.raises(ValueError):
        scale.apply_quantile_map(one, scale.fit_quantile_map(one, "v"), "u", "cauchy")


def test_many_quantiles_in_one_list(spark):
    v = np.random.default_rng(1).normal(size=501)
    probs = [i / 999 for i in range(1000)]
    got = column_quantiles(spark.createDataFrame([(float(x), None) for x in v], "a double, b double"), ["a", "b"], probs)
    assert np.allclose(got["a"], np.quantile(v, probs)) and got["b"] == [None] * 1000


def test_permutation_importance_in_one_pairing(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(a), float(b), 5 * float(a) + 0.01 * float(b)) for i, (a, b) in enumerate(rng.normal(size=(800, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    model = md.fit(df, ["a", "b"], "y", md.regressor("linear"))
    one = md.permutation_importance(model, df, ["a", "b"], "y", ["id"])
    got = {r.feature: r.rmse_increase for r in one.collect()}
    assert got["a"] == pytest.approx(5 * math.sqrt(2), rel=0.1) and abs(got["b"]) < 0.05
    again = {r.feature: r.rmse_increase for r in md.permutation_importance(model, df.repartition(5), ["a", "b"], "y", ["id"]).collect()}
    assert all(again[f] == pytest.approx(got[f]) for f in got)


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """Base rows, parcels, places and zones as files, so that a plan tells what it reads."""
    root = tmp_path_factory.mktemp("sides")
    square = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0)], "pid long, cx double, cy double")
    square = square.withColumn("wkt", rectangle_wkt(F.col("cx") - 1, F.col("cy") - 1, F.col("cx") + 1, F.col("cy") + 1))
    frames = {"base": spark.createDataFrame([(1, 10), (1, 11), (2, 12), (3, 13), (None, 14)], "pid long, row int"),
              "parcels": square,
              "places": spark.createDataFrame([(0.1, 0.1, "a-b"), (0.2, 0.2, "a-b"), (5.1, 5.1, "c"), (9.0, 9.0, "c"), (None, 0.0, "c")],
                                              "x double, y double, kind string"),
              "zones": spark.createDataFrame([(1,)], "z int").select(rectangle_wkt(F.lit(4.0), F.lit(4.0), F.lit(6.0), F.lit(6.0)).alias("w"))}
    for name, f in frames.items():
        f.coalesce(1).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in frames}


@pytest.mark.parametrize("places", [False, True])
@pytest.mark.parametrize("zones", [False, True])
def test_assembly_reads_only_what_is_asked_for(sides, places, zones):
    out = asm.assemble(sides["base"], "pid", sides["parcels"], "pid", "wkt", ("cx", "cy"),
                       asm.Places(sides["places"], "x", "y", "kind", ("a-b", "c")) if places else None,
                       asm.Zones(sides["zones"], "w") if zones else None)
    read = {f.split("/")[-2] for f in out.inputFiles()}
    assert read == {"base"} | ({"parcels"} if places or zones else set()) | ({"places"} if places else set()) | ({"zones"} if zones else set())
    rows = {r.row: r.asDict() for r in out.collect()}
    assert sorted(rows) == [10, 11, 12, 13, 14]
    counts = {10: (2, 0), 11: (2, 0), 12: (0, 1), 13: (0, 0), 14: (0, 0)}
    for i, r in rows.items():
        if places:
            assert (r["POI_a_b_count"], r["POI_c_count"]) == counts[i]
        if zones:
            assert r["in_restricted_zone"] == (1 if i == 12 else 0)
        assert ("no_poi" in r) == (zones and not places)


def test_assembly_without_categories(sides):
    out = asm.assemble(sides["base"], "pid", sides["parcels"], "pid", "wkt", ("cx", "cy"), asm.Places(sides["places"], "x", "y", "kind"))
    assert out.count() == 5 and {r.no_poi for r in out.collect()} == {0}
