"""Queries: metrics, bands, ensembles, intervals, residual diagnostics, drift.

Predictions come from three simple train-fitted models over the sales rows
(train = ``year < 2000``):

* ``brand_rate``: quantity x mean unit price of the brand,
* ``zone_mean``: mean price of the zone,
* ``retail``: quantity x part retail price (no fit).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..operators import diagnostics as dg
from ..operators import metrics as mt
from ..operators.lookup import attach, fit_table
from .base import ORDER_KEY as KEY_OUT
from .base import cut, sales, with_sales
from .registry import register

KEYS_SQL = ", ".join(KEY_OUT)
_GROUPS = ("zone", "ptype", "segment")

# rounding per reported statistic (digits; negative = tens/hundreds)
RND = {"mse": -2, "rmse": 2, "mae": 2, "mape": 8, "medae": 4, "r2": 8, "explained_variance": 8}


def predictions(spark, sf_dir, keep=(*KEY_OUT, *_GROUPS)):
    """``keep``: the key and group columns that the query reads; the sales rows
    are written once with those and what the models need."""
    s = cut(sales(spark, sf_dir).withColumn("split", F.when(F.col("year") < 2000, "train").otherwise("test")),
            *keep, "split", "l_extendedprice", "l_quantity", "p_retailprice", "brand", "zone")
    tr = s.where(F.col("split") == "train")
    rate = fit_table(tr.groupBy("brand").agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("_rate")),
                     ["brand"])
    zmean = fit_table(tr.groupBy("zone").agg(F.avg("l_extendedprice").alias("_zmean")), ["zone"])
    base = attach(attach(s, rate), zmean)
    # the join chain runs once; every row then unpacks into one row a model
    models = F.array(*[F.struct(F.lit(m).alias("model"), e.cast("double").alias("y_pred")) for m, e in (
        ("brand_rate", F.col("l_quantity") * F.col("_rate")), ("zone_mean", F.col("_zmean")),
        ("retail", F.col("l_quantity") * F.col("p_retailprice")))])
    keys, groups = [c for c in KEY_OUT if c in keep], [c for c in _GROUPS if c in keep]
    return (base.select(*keys, "split", *groups, F.col("l_extendedprice").alias("y_true"), F.inline(models))
            .select("model", *keys, "split", "y_true", *groups, "y_pred"))


PRED_CTE = f""", sp AS (SELECT *, CASE WHEN year < 2000 THEN 'train' ELSE 'test' END AS split FROM sales),
rate AS (SELECT brand, avg(l_extendedprice / l_quantity) AS r FROM sp WHERE split = 'train' GROUP BY brand),
zm AS (SELECT zone, avg(l_extendedprice) AS m FROM sp WHERE split = 'train' GROUP BY zone),
preds AS (
  SELECT 'brand_rate' AS model, {KEYS_SQL}, split, l_extendedprice AS y_true, zone, ptype, segment,
         l_quantity * rate.r AS y_pred FROM sp LEFT JOIN rate USING (brand)
  UNION ALL
  SELECT 'zone_mean', {KEYS_SQL}, split, l_extendedprice, zone, ptype, segment, zm.m FROM sp LEFT JOIN zm USING (zone)
  UNION ALL
  SELECT 'retail', {KEYS_SQL}, split, l_extendedprice, zone, ptype, segment, l_quantity * p_retailprice FROM sp)"""


def pred_sql(body: str) -> str:
    return with_sales(PRED_CTE + "\n" + body)


def _metric_sql(extra_group: str = "") -> str:
    return f"""count(*) AS count,
       round(avg((y_true - y_pred) * (y_true - y_pred)), -2) AS mse,
       round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 2) AS rmse,
       round(avg(abs(y_true - y_pred)), 2) AS mae,
       round(avg(abs(y_true - y_pred) / CASE WHEN abs(y_true) < 1e-8 THEN 1e-8 ELSE abs(y_true) END), 8) AS mape,
       round(median(abs(y_true - y_pred)), 4) AS medae,
       round(CASE WHEN var_pop(y_true) > 0 THEN 1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true)
                  WHEN avg((y_true - y_pred) * (y_true - y_pred)) = 0 THEN 1.0 ELSE 0.0 END, 8) AS r2,
       round(CASE WHEN var_pop(y_true) > 0 THEN 1 - var_pop(y_true - y_pred) / var_pop(y_true)
                  WHEN var_pop(y_true - y_pred) = 0 THEN 1.0 ELSE 0.0 END, 8) AS explained_variance"""


def _rounded(df, keep):
    return df.select(*keep, "count", *[F.round(c, d).alias(c) for c, d in RND.items()])


@register("regression_metrics", pred_sql(f"""
SELECT model, split, {_metric_sql()} FROM preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL
GROUP BY model, split"""))
def q_regression_metrics(spark, sf_dir):
    """A13 + A14 + F9: seven metrics per model and split."""
    return _rounded(mt.regression_metrics(predictions(spark, sf_dir, ())), ["model", "split"])


@register("grouped_metrics", pred_sql(f"""
, long AS (SELECT model, split, y_true, y_pred, 'zone' AS group_by, zone AS grp FROM preds
           UNION ALL SELECT model, split, y_true, y_pred, 'ptype', ptype FROM preds
           UNION ALL SELECT model, split, y_true, y_pred, 'segment', segment FROM preds)
SELECT model, split, group_by, grp AS "group", {_metric_sql()}
FROM long WHERE y_true IS NOT NULL AND y_pred IS NOT NULL AND grp IS NOT NULL
GROUP BY model, split, group_by, grp HAVING count(*) >= 30"""))
def q_grouped_metrics(spark, sf_dir):
    """A15 + L12: metrics per zone, type and segment for every model in one
    aggregation over the unpivoted group columns; groups < 30 rows omitted."""
    preds = predictions(spark, sf_dir, _GROUPS)
    out = mt.grouped_metrics_long(preds, ["zone", "ptype", "segment"], min_group_size=30)
    return _rounded(out, ["model", "split", "group_by", "group"])


@register("overfit_diagnostics", pred_sql("""
, m AS (SELECT model, split, avg((y_true - y_pred) * (y_true - y_pred)) AS mse, avg(abs(y_true - y_pred)) AS mae,
               1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true) AS r2
        FROM preds WHERE y_pred IS NOT NULL GROUP BY model, split)
SELECT tr.model, round(tr.r2 - te.r2, 8) AS gap_r2, round(te.mae / tr.mae, 8) AS ratio_mae,
       round(te.mae - tr.mae, 2) AS delta_mae, round(sqrt(te.mse) / sqrt(tr.mse), 8) AS ratio_rmse,
       CASE WHEN tr.r2 - te.r2 < 0.05 THEN 'good' WHEN tr.r2 - te.r2 <= 0.1 THEN 'moderate' ELSE 'overfit' END AS fit_label
FROM m tr JOIN m te ON tr.model = te.model AND tr.split = 'train' AND te.split = 'test'"""))
def q_overfit_diagnostics(spark, sf_dir):
    """A16 + L11: train/test gaps and ratios with a calibration label."""
    m = mt.regression_metrics(predictions(spark, sf_dir, ()))
    d = mt.overfit_diagnostics(m)
    return d.select("model", F.round("gap_r2", 8).alias("gap_r2"), F.round("ratio_mae", 8).alias("ratio_mae"),
                    F.round("delta_mae", 2).alias("delta_mae"), F.round("ratio_rmse", 8).alias("ratio_rmse"),
                    mt.fit_label(F.col("gap_r2")).alias("fit_label"))


@register("model_ranking", pred_sql("""
, m AS (SELECT model, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
               1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true) AS r2
        FROM preds WHERE split = 'test' AND y_pred IS NOT NULL GROUP BY model)
SELECT model, round(rmse, 2) AS rmse, round(r2, 8) AS r2, round(-rmse, 2) AS primary_value,
       CAST(row_number() OVER (ORDER BY rmse ASC, r2 DESC) AS INTEGER) AS rank FROM m"""))
def q_model_ranking(spark, sf_dir):
    """A17 + S2 + L13: test metrics per model, primary value (larger is
    better) and rank by (rmse asc, r2 desc)."""
    from pyspark.sql import Window
    m = mt.regression_metrics(predictions(spark, sf_dir, ())).where(F.col("split") == "test")
    pv = mt.primary_value(m, "neg_root_mean_squared_error")
    # one row per model: the window runs over a handful of rows
    w = Window.orderBy(F.col("rmse").asc(), F.col("r2").desc())
    return m.select("model", F.round("rmse", 2).alias("rmse"), F.round("r2", 8).alias("r2"),
                    F.round(pv, 2).alias("primary_value"), F.row_number().over(w).cast("int").alias("rank"))


@register("residual_summary", pred_sql("""
, r AS (SELECT model, split, y_true - y_pred AS e FROM preds WHERE y_pred IS NOT NULL)
SELECT model, split, round(avg(e), 4) AS mean, round(stddev_pop(e), 3) AS std, round(median(e), 4) AS median,
       round(quantile_cont(e, 0.25), 4) AS q25, round(quantile_cont(e, 0.75), 4) AS q75,
       round(min(e), 4) AS min, round(max(e), 4) AS max,
       round(avg(power(e - m.mu, 3)) / power(var_pop(e), 1.5), 6) AS skew,
       round(kurtosis_pop(e), 6) AS kurtosis
FROM r JOIN (SELECT model AS mm, split AS ss, avg(e) AS mu FROM r GROUP BY 1, 2) m ON r.model = m.mm AND r.split = m.ss
GROUP BY model, split"""))
def q_residual_summary(spark, sf_dir):
    """Residual moments and quantiles per model and split."""
    out = dg.residual_summary(predictions(spark, sf_dir, ()).dropna(subset=["y_pred"]), by=["model", "split"])
    digits = {"mean": 4, "std": 3, "median": 4, "q25": 4, "q75": 4, "min": 4, "max": 4, "skew": 6, "kurtosis": 6}
    return out.select("model", "split", *[F.round(c, d).alias(c) for c, d in digits.items()])


@register("residuals_by_group", pred_sql("""
SELECT model, split, zone, round(avg(y_true - y_pred), 4) AS residual_mean,
       round(stddev_samp(y_true - y_pred), 3) AS residual_std, round(median(y_true - y_pred), 4) AS residual_median,
       count(*) AS count
FROM preds WHERE y_pred IS NOT NULL AND zone IS NOT NULL GROUP BY model, split, zone"""))
def q_residuals_by_group(spark, sf_dir):
    """Residual mean, sample std, median and count per zone."""
    out = dg.residuals_by_group(predictions(spark, sf_dir, ("zone",)).dropna(subset=["y_pred"]), "zone", by=["model", "split"])
    return out.select("model", "split", "zone", rnd("residual_mean", 4).alias("residual_mean"),
                      rnd("residual_std", 3).alias("residual_std"),
                      rnd("residual_median", 4).alias("residual_median"), "count")


@register("residuals_by_price_quartile", pred_sql("""
, ok AS (SELECT * FROM preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL),
edges AS (SELECT model, split, quantile_cont(y_true, 0.25) AS e1, quantile_cont(y_true, 0.5) AS e2, quantile_cont(y_true, 0.75) AS e3
          FROM ok GROUP BY model, split)
SELECT ok.model, ok.split, CASE WHEN y_true <= e1 THEN 'Q1' WHEN y_true <= e2 THEN 'Q2' WHEN y_true <= e3 THEN 'Q3' ELSE 'Q4' END AS quartile,
       round(avg(y_true - y_pred), 4) AS residual_mean, round(stddev_samp(y_true - y_pred), 3) AS residual_std,
       round(median(y_true - y_pred), 4) AS residual_median, count(*) AS count
FROM ok JOIN edges ON ok.model = edges.model AND ok.split = edges.split GROUP BY ok.model, ok.split, quartile"""))
def q_residuals_by_price_quartile(spark, sf_dir):
    """Residual statistics per quartile of the price, model and split."""
    out = dg.residuals_by_quartile(predictions(spark, sf_dir, ()), by=["model", "split"])
    return out.select("model", "split", "quartile", rnd("residual_mean", 4).alias("residual_mean"),
                      rnd("residual_std", 3).alias("residual_std"), rnd("residual_median", 4).alias("residual_median"), "count")


@register("floored_mape", pred_sql("""
SELECT model, split, round(avg(abs(y_true - y_pred) / greatest(abs(y_true), 20000)), 8) AS mape, count(*) AS count
FROM preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY model, split"""))
def q_floored_mape(spark, sf_dir):
    """Percentage error with prices under 20,000 counted as 20,000."""
    p = predictions(spark, sf_dir, ()).dropna(subset=["y_true", "y_pred"])
    out = p.groupBy("model", "split").agg(*mt.metric_aggs(mape_floor=20_000, exact=False))
    return out.select("model", "split", rnd("mape", 8).alias("mape"), "count")


@register("worst_predictions", pred_sql(f"""
SELECT {KEYS_SQL}, y_true, round(y_pred, 4) AS y_pred, round(y_true - y_pred, 4) AS residual,
       round(100 * abs(y_true - y_pred) / abs(y_true), 6) AS pct_error
FROM preds WHERE model = 'brand_rate' AND split = 'test'
ORDER BY abs(y_true - y_pred) DESC, {KEYS_SQL} LIMIT 10"""))
def q_worst_predictions(spark, sf_dir):
    """W7 + S5: the 10 largest absolute residuals (a top-k report)."""
    p = predictions(spark, sf_dir).where((F.col("model") == "brand_rate") & (F.col("split") == "test"))
    out = dg.worst_predictions(p, KEY_OUT, 10)
    return out.select(*KEY_OUT, "y_true", rnd("y_pred", 4).alias("y_pred"), rnd("residual", 4).alias("residual"),
                      rnd("pct_error", 6).alias("pct_error"))


@register("price_band_metrics", pred_sql("""
, t AS (SELECT * FROM preds WHERE model = 'brand_rate' AND split = 'test'),
e AS (SELECT quantile_cont(y_true, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM t),
b AS (SELECT t.*, CASE WHEN y_true >= q[1] AND y_true <= q[2] THEN 'PREZZO_01'
                       WHEN y_true > q[2] AND y_true <= q[3] THEN 'PREZZO_02'
                       WHEN y_true > q[3] AND y_true <= q[4] THEN 'PREZZO_03'
                       WHEN y_true > q[4] AND y_true <= q[5] THEN 'PREZZO_04'
                       WHEN y_true > q[5] AND y_true <= q[6] THEN 'PREZZO_05' END AS band FROM t, e)
SELECT band, count(*) AS count, round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 2) AS rmse,
       round(avg(abs(y_true - y_pred)), 2) AS mae FROM b GROUP BY band"""))
def q_price_band_metrics(spark, sf_dir):
    """Quintile price bands (right-closed, lowest edge included) and
    metrics per band."""
    p = predictions(spark, sf_dir, ()).where((F.col("model") == "brand_rate") & (F.col("split") == "test"))
    edges = mt.band_edges(p, "y_true", "quantile")
    b = p.withColumn("band", mt.band_label("y_true", edges))
    out = mt.regression_metrics(b, by=["band"])
    return out.select("band", "count", F.round("rmse", 2).alias("rmse"), F.round("mae", 2).alias("mae"))


@register("voting_ensemble", pred_sql(f"""
, m AS (SELECT model, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse FROM preds
        WHERE split = 'test' GROUP BY model),
r AS (SELECT model, 4 - row_number() OVER (ORDER BY rmse) AS w FROM m)
SELECT {KEYS_SQL}, split, round(sum(w * y_pred) / sum(w) FILTER (WHERE y_pred IS NOT NULL), 4) AS y_pred
FROM preds JOIN r USING (model) GROUP BY {KEYS_SQL}, split"""))
def q_voting_ensemble(spark, sf_dir):
    """Members ranked by test RMSE, weights 3, 2, 1, weighted mean per row."""
    preds = predictions(spark, sf_dir)
    m = mt.regression_metrics(preds).where(F.col("split") == "test").select("model", "rmse")
    ranking = [r["model"] for r in m.orderBy("rmse").collect()]   # one row per model
    out = mt.voting_ensemble(preds, ranking, [*KEY_OUT, "split"])
    return out.select(*KEY_OUT, "split", rnd("y_pred", 4).alias("y_pred"))


@register("prediction_intervals", pred_sql("""
, t AS (SELECT * FROM preds WHERE model = 'brand_rate'),
q AS (SELECT quantile_cont(y_true - y_pred, [0.1, 0.9, 0.05, 0.95]) AS q FROM t WHERE split = 'train'),
iv AS (SELECT t.*, y_pred + q[1] AS lo_80, y_pred + q[2] AS hi_80, y_pred + q[3] AS lo_90, y_pred + q[4] AS hi_90
       FROM t, q WHERE split = 'test')
SELECT round(avg(CASE WHEN y_true >= lo_80 AND y_true <= hi_80 THEN 1.0 ELSE 0.0 END), 8) AS coverage_80,
       round(avg(hi_80 - lo_80), 4) AS width_80,
       round(avg(CASE WHEN y_true >= lo_90 AND y_true <= hi_90 THEN 1.0 ELSE 0.0 END), 8) AS coverage_90,
       round(avg(hi_90 - lo_90), 4) AS width_90,
       round(avg(100 * (hi_90 - lo_90) / (y_pred + 1e-8)), 6) AS width_pct_90
FROM iv"""))
def q_prediction_intervals(spark, sf_dir):
    """L8 + A24: residual-quantile intervals (80 %, 90 %) fitted on train,
    coverage and width on test."""
    p = predictions(spark, sf_dir, ()).where(F.col("model") == "brand_rate")
    iv = dg.residual_intervals(p.where(F.col("split") == "train"), p.where(F.col("split") == "test"))
    q80 = mt.interval_quality(iv, "lo_80", "hi_80")
    q90 = mt.interval_quality(iv, "lo_90", "hi_90")
    a = q80.select(F.round("coverage", 8).alias("coverage_80"), F.round("mean_width", 4).alias("width_80"),
                   F.lit(1).alias("_k"))
    b = q90.select(F.round("coverage", 8).alias("coverage_90"), F.round("mean_width", 4).alias("width_90"),
                   F.round("mean_width_pct", 6).alias("width_pct_90"), F.lit(1).alias("_k"))
    return a.join(b, "_k").drop("_k")


_M = dg.DRAW_MOD
_BOOT_CTE = f"""
, t AS (SELECT *, l_orderkey * 8 + l_linenumber AS rid FROM preds WHERE model = 'brand_rate'),
res AS (SELECT y_true - y_pred AS r, row_number() OVER (ORDER BY y_true - y_pred) - 1 AS rank
        FROM t WHERE split = 'train' AND y_true - y_pred IS NOT NULL),
nn AS (SELECT count(*) AS n FROM res),
d0 AS (SELECT rid, rid % {_M} AS m, b FROM (SELECT DISTINCT rid FROM t WHERE split = 'test'), range(100) g(b)),
d1 AS (SELECT *, (m * 48271 + (b + 1) * 69621 + 42) % {_M} AS a FROM d0),
d2 AS (SELECT *, (((a * a + 12345) % {_M}) * 48271 + m) % {_M} AS c FROM d1),
d3 AS (SELECT rid, CAST(floor(((c * c + a) % {_M}) / {_M}.0::DOUBLE * n::DOUBLE) AS BIGINT) AS rank FROM d2, nn),
off AS (SELECT rid, quantile_cont(r, [0.1, 0.9, 0.05, 0.95]) AS q FROM d3 JOIN res USING (rank) GROUP BY rid),
iv AS (SELECT t.*, y_pred + q[1] AS lo_80, y_pred + q[2] AS hi_80, y_pred + q[3] AS lo_90, y_pred + q[4] AS hi_90
       FROM t LEFT JOIN off USING (rid) WHERE split = 'test')"""


def _bootstrapped(spark, sf_dir):
    p = (predictions(spark, sf_dir).where(F.col("model") == "brand_rate")
         .withColumn("rid", F.col("l_orderkey") * 8 + F.col("l_linenumber")))
    return dg.bootstrap_intervals(p.where(F.col("split") == "train"), p.where(F.col("split") == "test"), "rid", KEY_OUT)


@register("bootstrap_intervals", pred_sql(_BOOT_CTE + f"""
SELECT {KEYS_SQL}, round(lo_80, 2) AS lo_80, round(hi_80, 2) AS hi_80, round(lo_90, 2) AS lo_90, round(hi_90, 2) AS hi_90 FROM iv"""))
def q_bootstrap_intervals(spark, sf_dir):
    """80 % and 90 % intervals of every test row from 100 drawn training residuals."""
    return _bootstrapped(spark, sf_dir).select(*KEY_OUT, *[rnd(c, 2).alias(c) for c in ("lo_80", "hi_80", "lo_90", "hi_90")])


@register("bootstrap_coverage", pred_sql(_BOOT_CTE + """
, l AS (SELECT 80 AS level, y_true, y_pred, lo_80 AS lo, hi_80 AS hi FROM iv UNION ALL SELECT 90, y_true, y_pred, lo_90, hi_90 FROM iv)
SELECT level, round(avg(CASE WHEN y_true >= lo AND y_true <= hi THEN 1.0 ELSE 0.0 END), 8) AS coverage,
       round(avg(hi - lo), 2) AS width, round(avg(100 * (hi - lo) / (y_pred + 1e-8)), 4) AS width_pct FROM l GROUP BY level"""))
def q_bootstrap_coverage(spark, sf_dir):
    """L8 + A24: coverage and width of the bootstrap intervals by level."""
    iv = _bootstrapped(spark, sf_dir)
    levels = F.array(*[F.struct(F.lit(lv).alias("level"), F.col(f"lo_{lv}").alias("lo"), F.col(f"hi_{lv}").alias("hi")) for lv in (80, 90)])
    out = mt.interval_quality(iv.select("y_true", "y_pred", F.inline(levels)), "lo", "hi", by=["level"])
    return out.select("level", F.round("coverage", 8).alias("coverage"), F.round("mean_width", 2).alias("width"),
                      F.round("mean_width_pct", 4).alias("width_pct"))


@register("smearing_factor", pred_sql("""
SELECT model, round(avg(exp(ln(1 + y_true) - ln(1 + y_pred))), 8) AS smearing
FROM preds WHERE split = 'train' AND y_pred IS NOT NULL GROUP BY model"""))
def q_smearing_factor(spark, sf_dir):
    """Duan smearing factor on the log1p scale per model."""
    p = predictions(spark, sf_dir, ()).where(F.col("split") == "train").dropna(subset=["y_pred"])
    return p.groupBy("model").agg(
        F.round(F.avg(F.exp(F.log1p("y_true") - F.log1p("y_pred"))), 8).alias("smearing"))


_DRIFT_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "c_acctbal"]


def _drift_frame(spark, sf_dir):
    return sales(spark, sf_dir).withColumn("split", F.when(F.col("year") < 2000, "train").otherwise("test"))


DRIFT_LONG = """, sp AS (SELECT *, CASE WHEN year < 2000 THEN 'train' ELSE 'test' END AS split FROM sales),
long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, split, CAST({c} AS DOUBLE) AS value FROM sp WHERE {c} IS NOT NULL"
    for c in _DRIFT_FEATURES) + ")"


@register("psi_drift", with_sales(DRIFT_LONG + """,
ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]))) AS e
       FROM long WHERE split = 'train' GROUP BY feature),
nb AS (SELECT feature, count(*) FILTER (WHERE split = 'train') AS ne, count(*) FILTER (WHERE split = 'test') AS na
       FROM long GROUP BY feature),
bins AS (SELECT feature, unnest(range(0, len(e) - 1)) AS b FROM ed),
lb AS (SELECT l.feature, l.split,
              CASE WHEN l.value < ed.e[1] OR l.value > ed.e[len(ed.e)] THEN NULL
                   ELSE least(len(list_filter(ed.e, lambda x: x <= l.value)) - 1, len(ed.e) - 2) END AS b
       FROM long l JOIN ed USING (feature)),
c AS (SELECT feature, b, count(*) FILTER (WHERE split = 'train') AS ce, count(*) FILTER (WHERE split = 'test') AS ca
      FROM lb WHERE b IS NOT NULL GROUP BY feature, b),
s AS (SELECT bins.feature, coalesce(c.ce, 0) / nb.ne AS es, coalesce(c.ca, 0) / nb.na AS as_
      FROM bins LEFT JOIN c ON bins.feature = c.feature AND bins.b = c.b JOIN nb ON bins.feature = nb.feature),
s2 AS (SELECT feature, CASE WHEN es = 0 THEN 1e-4 ELSE es END AS es, CASE WHEN as_ = 0 THEN 1e-4 ELSE as_ END AS as_ FROM s)
SELECT feature, round(abs(sum((as_ - es) * ln(as_ / es))), 8) AS psi FROM s2 GROUP BY feature"""))
def q_psi_drift(spark, sf_dir):
    """Population stability index train -> test for five features."""
    long = dg.to_long(cut(_drift_frame(spark, sf_dir), "split", *_DRIFT_FEATURES), _DRIFT_FEATURES)
    return dg.psi(long).select("feature", F.round("psi", 8).alias("psi"))


@register("ks_drift", with_sales(DRIFT_LONG + """,
c AS (SELECT feature, value, count(*) FILTER (WHERE split = 'train') AS ca, count(*) FILTER (WHERE split = 'test') AS cb
      FROM long GROUP BY feature, value),
cum AS (SELECT feature, sum(ca) OVER w AS sa, sum(cb) OVER w AS sb, sum(ca) OVER (PARTITION BY feature) AS na,
               sum(cb) OVER (PARTITION BY feature) AS nb
        FROM c WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT feature, round(max(abs(sa / na - sb / nb)), 10) AS ks_stat, CAST(max(na) AS BIGINT) AS na, CAST(max(nb) AS BIGINT) AS nb
FROM cum GROUP BY feature"""))
def q_ks_drift(spark, sf_dir):
    """Two-sample Kolmogorov-Smirnov statistic per feature, running
    sums computed with range partitioning."""
    long = dg.to_long(_drift_frame(spark, sf_dir), _DRIFT_FEATURES)
    return dg.ks_statistic(long).select("feature", F.round("ks_stat", 10).alias("ks_stat"), "na", "nb")


@register("drift_report")
def q_drift_report(spark, sf_dir):
    """PSI + KS (with asymptotic p-value) per feature, alert levels."""
    return dg.drift_report(_drift_frame(spark, sf_dir), _DRIFT_FEATURES)
