"""Free-text and JSON feature extraction as column expressions.

The floor parser tokenises with ``split`` and maps tokens with a literal map
and regexes inside ``transform``/``filter``; ranges come from
``regexp_extract_all`` + ``sequence``.  No Python per row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exprs import col

# fixed values: floor-token codes
FLOOR_CODES = {"S2": -2.0, "S1": -1.0, "S": -1.0, "SEMI": -1.0,
               "ST": -0.5, "PT": 0.0, "T": 0.0, "RIAL": 0.5, "AMMEZZ": 0.5}
# fixed values: word removed before tokenising; markers of an empty value
FLOOR_WORD = "PIANO"
EMPTY_MARKERS = ("", "NONE", "NULL", "NAN")


def _floor_values(c) -> Column:
    """Sorted distinct floor levels of a floor description."""
    s = F.regexp_replace(F.upper(F.coalesce(col(c).cast("string"), F.lit("NONE"))), r"\s+", "")
    s = F.replace(s, F.lit(FLOOR_WORD), F.lit(""))
    code_map = F.create_map(*[x for k, v in FLOOR_CODES.items() for x in (F.lit(k), F.lit(v))])

    def token_value(t):
        return (F.when(t.rlike(r"^P[0-9]{1,2}$"), F.substring(t, 2, 2).cast("double"))
                .when(F.element_at(code_map, t).isNotNull(), F.element_at(code_map, t))
                .when(t.rlike(r"^[0-9]{1,2}$") & (t.cast("int") >= 1) & (t.cast("int") <= 20),
                      t.cast("double")))

    tokens = F.filter(F.split(s, r"[^A-Z0-9]+"), lambda t: t != "")
    singles = F.filter(F.transform(tokens, token_value), lambda v: v.isNotNull())
    pairs = F.regexp_extract_all(s, F.lit(r"(\d{1,2})-(\d{1,2})"), 0)

    def expand(p):
        a = F.split(p, "-")[0].cast("int")
        b = F.split(p, "-")[1].cast("int")
        lo, hi = F.least(a, b), F.greatest(a, b)
        return F.filter(F.transform(F.sequence(lo, hi), lambda x: x.cast("double")),
                        lambda x: (x >= 1) & (x <= 20))
    ranged = F.flatten(F.transform(pairs, expand))
    vals = F.array_sort(F.array_distinct(F.concat(singles, ranged)))
    return F.when(s.isin(list(EMPTY_MARKERS)), F.array().cast("array<double>")).otherwise(vals)


def floor_features(c, prefix: str = "") -> dict[str, Column]:
    """Eleven numeric features of a floor description."""
    v = _floor_values(c)
    n = F.size(v)
    s = F.regexp_replace(F.upper(F.coalesce(col(c).cast("string"), F.lit("NONE"))), r"\s+", "")
    s = F.replace(s, F.lit(FLOOR_WORD), F.lit(""))
    some = n > 0
    wsum = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * (x + 3))
    wtot = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x + 3))
    feats = {
        "min_floor": F.when(some, F.array_min(v)),
        "max_floor": F.when(some, F.array_max(v)),
        "n_floors": n.cast("double"),
        "floor_span": F.when(some, F.array_max(v) - F.array_min(v)).otherwise(0.0),
        "has_basement": F.exists(v, lambda x: x < 0).cast("double"),
        "has_ground": F.exists(v, lambda x: (x >= -0.5) & (x <= 0.5)).cast("double"),
        "has_upper": F.exists(v, lambda x: x >= 1).cast("double"),
        "n_upper_levels": F.size(F.filter(v, lambda x: x >= 1)).cast("double"),
        "n_basement_levels": F.size(F.filter(v, lambda x: x < 0)).cast("double"),
        "contains_range": s.rlike(r"\d+\s*-\s*\d+").cast("double"),
        "floor_numeric_weighted": F.when(some & (wtot != 0), wsum / wtot),
    }
    return {prefix + k: e for k, e in feats.items()}


# N1 -------------------------------------------------------------------------
def detect_json_keys(df: DataFrame, c: str, min_share: float = 0.2) -> list[str]:
    """First-level keys of primitive values in >= ``min_share`` of the non-null
    values of the column; [] when no value is a JSON object.

    All rows count: keys are exploded and summed (partial aggregation), and
    only keys that reach the share come to the driver, at most
    ``1 / min_share`` times the keys of one object."""
    rows = df.where(col(c).isNotNull()).select(col(c).alias("j"))
    objects = F.json_object_keys("j")
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count(objects).alias("o")).first()
    if not n["o"]:
        return []
    parsed = F.from_json("j", "map<string,string>", {"mode": "PERMISSIVE"})
    pairs = rows.where(objects.isNotNull()).select(F.explode(F.map_entries(parsed)).alias("e"))
    plain = ~F.coalesce(F.col("e.value").rlike(r"^\s*[\[{]"), F.lit(False))  # nested values stay in the source
    need = max(1, int(min_share * n["n"]))
    keys = pairs.groupBy(F.col("e.key").alias("key")).agg(F.count(F.lit(1)).alias("k"), F.count_if(plain).alias("p"))
    return sorted(r["key"] for r in keys.where((F.col("k") >= need) & (F.col("p") == F.col("k"))).select("key").collect())


def json_key_columns(c: str, keys: list[str]) -> dict[str, Column]:
    """One column per key; keys are quoted, so dots in them are no paths."""
    return {f"{c}__{k}": F.get_json_object(col(c), "$['" + k.replace("'", "\\'") + "']") for k in keys}


def extract_json_features(df: DataFrame, columns: list[str] | None = None, **kw) -> DataFrame:
    """Replace JSON-object columns with one column per frequent key.
    Values are JSON text; numbers become numbers via P16 coercion later."""
    from .exprs import string_columns
    for c in columns or string_columns(df):
        keys = detect_json_keys(df, c, **kw)
        if keys:
            df = df.withColumns(json_key_columns(c, keys)).drop(c)
    return df


# N2 -------------------------------------------------------------------------
# fixed values: GeoJSON properties read from the first feature
GEOJSON_PROPS = ("areaMq", "perimetroM", "codiceCatastale", "foglio", "sezione", "particella")


def geojson_features(c, prefix: str | None = None, props=GEOJSON_PROPS) -> dict[str, Column]:
    """First feature's properties + bounding box of all coordinates.

    Works for a Feature or a FeatureCollection; the bbox is taken from every
    number in ``geometry.coordinates`` (x = even positions, y = odd)."""
    j = col(c)
    prefix = prefix if prefix is not None else f"{c}__"
    out = {}
    for p in props:
        out[f"{prefix}{p}"] = F.coalesce(F.get_json_object(j, f"$.properties.{p}"),
                                         F.get_json_object(j, f"$.features[0].properties.{p}"))
    coords = F.coalesce(F.get_json_object(j, "$.geometry.coordinates"),
                        F.get_json_object(j, "$.features[0].geometry.coordinates"))
    nums = F.transform(F.regexp_extract_all(coords, F.lit(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"), 0),
                       lambda t: t.cast("double"))
    xs = F.filter(nums, lambda x, i: i % 2 == 0)
    ys = F.filter(nums, lambda x, i: i % 2 == 1)
    has = F.size(nums) >= 2
    out[f"{prefix}minx"] = F.when(has, F.array_min(xs))
    out[f"{prefix}miny"] = F.when(has, F.array_min(ys))
    out[f"{prefix}maxx"] = F.when(has, F.array_max(xs))
    out[f"{prefix}maxy"] = F.when(has, F.array_max(ys))
    return out
