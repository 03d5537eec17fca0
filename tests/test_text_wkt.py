import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import wkt
from tessera.operators.spatial import contains_rings, count_points_by_category


def floor_row(spark, s):
    df = spark.createDataFrame([(s,)], "f string")
    return df.select(*[e.alias(k) for k, e in tx.floor_features("f").items()]).first().asDict()


def test_floor_single_level(spark):
    r = floor_row(spark, "P1")
    assert (r["min_floor"], r["max_floor"], r["n_floors"], r["floor_span"]) == (1.0, 1.0, 1.0, 0.0)
    assert (r["has_basement"], r["has_ground"], r["has_upper"]) == (0.0, 0.0, 1.0)
    assert r["floor_numeric_weighted"] == pytest.approx(1.0)


def test_floor_basement_and_ground(spark):
    r = floor_row(spark, "S1-T")
    assert (r["min_floor"], r["max_floor"], r["n_floors"], r["floor_span"]) == (-1.0, 0.0, 2.0, 1.0)
    assert (r["has_basement"], r["has_ground"], r["has_upper"]) == (1.0, 1.0, 0.0)
    assert r["contains_range"] == 0.0
    assert r["floor_numeric_weighted"] == pytest.approx(-0.4)


def test_floor_range(spark):
    r = floor_row(spark, "1-3")
    assert r["n_floors"] == 3.0 and r["contains_range"] == 1.0 and r["n_upper_levels"] == 3.0
    assert r["floor_numeric_weighted"] == pytest.approx(32 / 15)


def test_floor_word_and_empty(spark):
    assert floor_row(spark, "PIANO 2")["min_floor"] == 2.0
    r = floor_row(spark, "NULL")
    assert r["n_floors"] == 0.0 and r["min_floor"] is None and r["floor_numeric_weighted"] is None
    assert floor_row(spark, None)["n_floors"] == 0.0


def test_point_xy(spark):
    rows = [("POINT (12.4924 41.8902)",), ("POINT (-122.4194 37.7749)",), ("POINT (1e10 -1e10)",),
            ("INVALID WKT",), ("POINT (not_a_number 41.8902)",), (None,), ("",)]
    df = spark.createDataFrame(rows, "p string")
    x, y = wkt.point_xy("p")
    got = [(r[0], r[1]) for r in df.select(x, y).collect()]
    assert got[:3] == [(12.4924, 41.8902), (-122.4194, 37.7749), (1e10, -1e10)]
    assert all(v == (None, None) for v in got[3:])


def test_polygon_and_multipolygon(spark):
    df = spark.createDataFrame([("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))",), ("POLYGON ((0 0, 2 0, 1 1, 0 0))",),
                                ("POLYGON (())",), ("nope",)], "g string")
    assert [r[0] for r in df.select(wkt.polygon_vertex_count("g")).collect()] == [5, 4, None, None]
    m = spark.createDataFrame([("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((2 2, 3 2, 3 3, 2 3, 2 2)))",),
                               ("MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)))",)], "g string")
    n, v, a = wkt.multipolygon_stats("g")
    assert [tuple(r) for r in m.select(n, v, a).collect()] == [(2, 10, 5.0), (1, 4, 4.0)]


def test_geometry_detection_replaces_columns(spark):
    df = spark.createDataFrame([("POINT (1 2)", "POLYGON ((0 0, 1 0, 1 1, 0 0))", "x")], "a string, b string, c string")
    out = wkt.extract_geometry_features(df)
    assert set(out.columns) == {"a_x", "a_y", "b_vertex_count", "c"}


def test_contains_strict_excludes_boundary(spark):
    sq = "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (0.0, 0.0), (3.0, 1.0), (1.999, 0.001)], "x double, y double")
    ring = wkt.ring_points(F.lit(sq))
    got = [r[0] for r in df.select(contains_rings(F.array(ring), F.col("x"), F.col("y"))).collect()]
    assert got == [True, False, False, False, True]


def test_point_counts_match_brute_force(spark):
    import random
    rnd = random.Random(3)
    polys = [(i, f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + w}, {x} {y + w}, {x} {y}))")
             for i, (x, y, w) in enumerate((rnd.uniform(0, 8), rnd.uniform(0, 8), rnd.uniform(0.5, 3)) for _ in range(20))]
    pts = [(j, rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.choice(["a", "b"])) for j in range(400)]
    pdf = spark.createDataFrame(polys, "pid int, wkt string")
    ptdf = spark.createDataFrame(pts, "id int, x double, y double, cat string")
    out = {r["pid"]: (r["POI_a_count"], r["POI_b_count"])
           for r in count_points_by_category(pdf, "pid", "wkt", ptdf, "x", "y", "cat", ["a", "b"], cell_size=0.7).collect()}
    for pid, w in polys:
        nums = [float(t) for t in w.replace("POLYGON ((", "").replace("))", "").replace(",", " ").split()]
        x0, y0, x1, y1 = nums[0], nums[1], nums[2], nums[5]
        exp = [sum(1 for _, px, py, c in pts if c == k and x0 < px < x1 and y0 < py < y1) for k in "ab"]
        assert out[pid] == tuple(exp)


def test_json_keys_and_geojson(spark):
    df = spark.createDataFrame([('{"key1":"value1","numeric_key":42}', 1),
                                ('{"key1":"value2","numeric_key":24,"extra":true}', 2),
                                ('{"different_key":"value"}', 3)], "json_col string, regular_col int")
    out = tx.extract_json_features(df, ["json_col"])
    assert "json_col" not in out.columns and {"json_col__key1", "json_col__numeric_key"} <= set(out.columns)
    plain = spark.createDataFrame([("not json",)], "c string")
    assert tx.extract_json_features(plain, ["c"]).columns == ["c"]
    g = spark.createDataFrame([('{"type":"Feature","properties":{"areaMq":120.5},'
                                '"geometry":{"type":"Polygon","coordinates":[[[1,2],[3,2],[3,5],[1,2]]]}}',)], "g string")
    f = tx.geojson_features("g")
    r = g.select(*[e.alias(k) for k, e in f.items()]).first().asDict()
    assert r["g__areaMq"] == "120.5" and (r["g__minx"], r["g__maxx"], r["g__miny"], r["g__maxy"]) == (1, 3, 2, 5)


@pytest.mark.parametrize("few", [0, 200_000])
def test_polygons_of_one_file_are_dealt_and_read_once(spark, monkeypatch, tmp_path, few):
    from tessera.operators import spatial as sp
    monkeypatch.setattr(sp, "FEW", few)
    polys = spark.range(0, 60, 1, 1).select("id", wkt.rectangle_wkt(F.col("id") * 0.1, F.lit(0.0), F.col("id") * 0.1 + 1 + F.pmod("id", F.lit(3)), F.lit(1.0)).alias("w"))
    polys.write.parquet(f"{tmp_path}/polys")
    pts = spark.createDataFrame([(i / 7, 0.5, "ab"[i % 2]) for i in range(40)] + [(None, 0.5, "a"), (0.0, 0.5, "a"), (1.0, 0.5, "b")], "x double, y double, k string")
    seen = spark.sparkContext.accumulator(0)

    def text(v):
        seen.add(1)
        return v

    read = spark.read.parquet(f"{tmp_path}/polys").withColumn("w", F.udf(text, "string").asNondeterministic()("w"))
    pairs = sp.points_in_polygons(pts, "x", "y", read, "w")
    got = {(r.id, r.x, r.k) for r in pairs.collect()}
    assert seen.value == 2 * 60  # the boxes, the pairs
    assert sp._with_bbox(read, "w").rdd.getNumPartitions() > 1
    assert got == {(i, r.x, r.k) for i in range(60) for r in pts.collect() if r.x is not None and i * 0.1 < r.x < i * 0.1 + 1 + i % 3}
