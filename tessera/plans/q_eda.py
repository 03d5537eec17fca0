"""Queries: profiling statistics over the sales rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import eda
from ..operators import outliers as ol
from ..operators import scale
from ..operators.quantiles import with_quantiles
from .base import KEY_OUT, ORDER_KEY, cut, sales, with_sales
from .registry import register

KEYS_SQL = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@register("target_describe", with_sales("""
SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(median(l_extendedprice), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS q75, max(l_extendedprice) AS max FROM sales"""))
def q_target_describe(spark, sf_dir):
    """describe() of the target."""
    d = eda.describe(sales(spark, sf_dir), "l_extendedprice")
    return d.select("count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 4).alias(c) for c in ("q25", "median", "q75")], "max")


_NUM = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "c_acctbal", "s_acctbal", "o_totalprice"]


@register("target_correlations", with_sales("""
, r AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS r FROM sales" for c in _NUM) + """)
SELECT feature, round(r, 8) AS r, round(abs(r), 8) AS abs_r FROM r ORDER BY abs(r) DESC LIMIT 5"""))
def q_target_correlations(spark, sf_dir):
    """A27 + S4: correlation of each numeric column with the target, top 5 by |r|."""
    c = eda.target_correlations(sales(spark, sf_dir), "l_extendedprice", _NUM)
    return c.orderBy(F.col("abs_r").desc()).limit(5).select("feature", F.round("r", 8).alias("r"),
                                                             F.round("abs_r", 8).alias("abs_r"))


@register("cramers_v", with_sales("""
, cells AS (SELECT zone, segment, count(*) AS o FROM sales GROUP BY ALL),
rx AS (SELECT zone, sum(o) AS nx FROM cells GROUP BY zone), ry AS (SELECT segment, sum(o) AS ny FROM cells GROUP BY segment),
t AS (SELECT sum(o) AS n, count(DISTINCT zone) AS r, count(DISTINCT segment) AS k FROM cells),
chi AS (SELECT sum(o * o / (nx * ny / t.n)) - t.n AS chi2 FROM cells JOIN rx USING (zone) JOIN ry USING (segment), t GROUP BY t.n),
v AS (SELECT chi2, n, greatest(0, chi2 / n - (k - 1) * (r - 1) / (n - 1)) AS phi2c,
             r - (r - 1) * (r - 1) / (n - 1) AS rc, k - (k - 1) * (k - 1) / (n - 1) AS kc FROM chi, t)
SELECT 'zone' AS x, 'segment' AS y, round(chi2, 6) AS chi2, CAST(n AS BIGINT) AS n, round(sqrt(phi2c / least(kc - 1, rc - 1)), 8) AS cramers_v FROM v"""))
def q_cramers_v(spark, sf_dir):
    """Bias-corrected Cramér's V between zone and customer segment."""
    v = eda.cramers_v(sales(spark, sf_dir), "zone", "segment")
    return v.select("x", "y", F.round("chi2", 6).alias("chi2"), "n", F.round("cramers_v", 8).alias("cramers_v"))


@register("correlation_ratio", with_sales("""
, m AS (SELECT avg(l_extendedprice) AS mu FROM sales),
g AS (SELECT ptype, count(*) AS n, avg(l_extendedprice) AS mg FROM sales GROUP BY ptype),
b AS (SELECT sum(n * (mg - mu) * (mg - mu)) AS b FROM g, m),
t AS (SELECT sum((l_extendedprice - mu) * (l_extendedprice - mu)) AS t FROM sales, m)
SELECT 'ptype' AS category, 'l_extendedprice' AS numeric, round(b / t, 10) AS eta2, round(sqrt(b / t), 10) AS eta FROM b, t"""))
def q_correlation_ratio(spark, sf_dir):
    """Correlation ratio eta (and eta^2) of price by building type."""
    r = eda.correlation_ratio(sales(spark, sf_dir), "ptype", "l_extendedprice")
    return r.select("category", "numeric", F.round("eta2", 10).alias("eta2"), F.round("eta", 10).alias("eta"))


@register("zone_stats_cv", with_sales("""
SELECT zone, count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
       round(median(l_extendedprice), 4) AS median, round(stddev_samp(l_extendedprice), 4) AS std,
       round(stddev_samp(l_extendedprice) / avg(l_extendedprice) * 100, 6) AS cv_pct FROM sales GROUP BY zone"""))
def q_zone_stats_cv(spark, sf_dir):
    """Per-zone price statistics with coefficient of variation."""
    g = eda.group_stats_cv(sales(spark, sf_dir), "zone", "l_extendedprice")
    return g.select("zone", "count", *[F.round(c, 4).alias(c) for c in ("mean", "median", "std")],
                    F.round("cv_pct", 6).alias("cv_pct"))


@register("year_share", with_sales("""
SELECT year, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM sales), 8) AS pct
FROM sales GROUP BY year"""))
def q_year_share(spark, sf_dir):
    """Rows and % share per year."""
    return eda.frequency_share(sales(spark, sf_dir), "year").withColumn("pct", F.round("pct", 8))


_FILTERED = "year >= 1996 AND l_quantity >= 5 AND l_quantity <= 45"


@register("raw_vs_filtered", with_sales(f"""
, f AS (SELECT * FROM sales WHERE {_FILTERED}),
s AS (SELECT 'raw' AS tag, count(l_extendedprice) AS count, avg(l_extendedprice) AS mean, median(l_extendedprice) AS median,
             stddev_samp(l_extendedprice) AS std, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
             skewness(l_extendedprice) AS skew, kurtosis(l_extendedprice) AS kurtosis FROM sales
      UNION ALL
      SELECT 'filtered', count(l_extendedprice), avg(l_extendedprice), median(l_extendedprice), stddev_samp(l_extendedprice),
             min(l_extendedprice), max(l_extendedprice), skewness(l_extendedprice), kurtosis(l_extendedprice) FROM f),
l AS (UNPIVOT s ON count, mean, median, std, min, max, skew, kurtosis INTO NAME statistic VALUE v),
p AS (SELECT statistic, max(v) FILTER (WHERE tag = 'raw') AS raw, max(v) FILTER (WHERE tag = 'filtered') AS filtered
      FROM (SELECT tag, statistic, CAST(v AS DOUBLE) AS v FROM l) GROUP BY statistic)
SELECT statistic, round(raw, 6) AS raw, round(filtered, 6) AS filtered, round(filtered - raw, 6) AS delta,
       round((filtered - raw) * 100 / abs(raw), 6) AS delta_pct FROM p"""))
def q_raw_vs_filtered(spark, sf_dir):
    """Eight statistics of the price before/after a filter, with deltas
    (sample-corrected skewness and kurtosis)."""
    s = cut(sales(spark, sf_dir), "l_extendedprice", "year", "l_quantity")
    c = eda.compare_stats(s, s.where(F.expr(_FILTERED)), "l_extendedprice")
    return c.select("statistic", *[F.round(x, 6).alias(x) for x in ("raw", "filtered", "delta", "delta_pct")])


@register("yearly_price", with_sales("""
SELECT year, round(avg(l_extendedprice), 4) AS mean_price, round(median(l_extendedprice), 4) AS median_price
FROM sales GROUP BY year"""))
def q_yearly_price(spark, sf_dir):
    """Mean and median price per year."""
    s = sales(spark, sf_dir)
    agg = s.groupBy("year").agg(F.round(F.avg("l_extendedprice"), 4).alias("mean_price"))
    out = with_quantiles(agg, s, ["year"], "l_extendedprice", [0.5], ["median_price"])
    return out.withColumn("median_price", F.round("median_price", 4))


@register("normality_by_transform", with_sales("""
, t AS (SELECT 'raw' AS transform, l_extendedprice AS v FROM sales
        UNION ALL SELECT 'log1p', ln(1 + l_extendedprice) FROM sales
        UNION ALL SELECT 'sqrt', sqrt(l_extendedprice) FROM sales),
m AS (SELECT transform, avg(v) AS mu FROM t GROUP BY transform),
s AS (SELECT transform, count(*) AS n, avg(power(v - mu, 3)) / power(avg(power(v - mu, 2)), 1.5) AS skew,
             avg(power(v - mu, 4)) / power(avg(power(v - mu, 2)), 2) - 3 AS kurtosis FROM t JOIN m USING (transform)
      GROUP BY transform)
SELECT transform, n, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis,
       round(n / 6.0 * (skew * skew + kurtosis * kurtosis / 4), 4) AS jarque_bera,
       round(abs(skew) + abs(kurtosis), 6) AS score FROM s"""))
def q_normality_by_transform(spark, sf_dir):
    """Skewness, kurtosis, Jarque-Bera and ranking score of the price
    under three transforms (one unpivot + grouped moments)."""
    s = sales(spark, sf_dir).select(F.col("l_extendedprice").alias("raw"),
                                    F.log1p("l_extendedprice").alias("log1p"),
                                    F.sqrt("l_extendedprice").alias("sqrt"))
    long = s.unpivot([], ["raw", "log1p", "sqrt"], "transform", "v")
    out = eda.normality(long, "v", ["transform"])
    return out.select("transform", "n", F.round("skew", 6).alias("skew"), F.round("kurtosis", 6).alias("kurtosis"),
                      F.round("jarque_bera", 4).alias("jarque_bera"), F.round("score", 6).alias("score"))


@register("normality_tests")
def q_normality_tests(spark, sf_dir):
    """One-sample KS (Spark ML) and Anderson-Darling against a fitted
    normal, for the raw and log1p price."""
    s = cut(sales(spark, sf_dir), "l_extendedprice").withColumn("log_price", F.log1p("l_extendedprice"))
    rows = []
    for c in ("l_extendedprice", "log_price"):
        ad = eda.anderson_darling_normal(s, c).first()
        rows.append((c, eda.ks_vs_normal(s, c), ad["anderson_darling"]))
    return spark.createDataFrame(rows, "column string, ks_stat double, anderson_darling double")


def _outlier_flags(spark, sf_dir):
    s = cut(sales(spark, sf_dir), "l_extendedprice")
    s = ol.flag_inliers(s, "l_extendedprice", "iqr", out_col="iqr_in")
    s = ol.flag_inliers(s, "l_extendedprice", "zscore", z_thresh=3.0, out_col="z_in")
    s = ol.modified_zscore_inliers(s, "l_extendedprice", out_col="mz_in")
    return s


_FLAG_SQL = """
, st AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3,
                avg(l_extendedprice) AS mu, stddev_pop(l_extendedprice) AS sd, median(l_extendedprice) AS med FROM sales),
md AS (SELECT median(abs(l_extendedprice - st.med)) AS mad FROM sales, st),
fl AS (SELECT l_extendedprice AS y,
              NOT (l_extendedprice >= q1 - 1.5 * (q3 - q1) AND l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS iqr_out,
              NOT (abs((l_extendedprice - mu) / sd) <= 3.0) AS z_out,
              NOT (abs(0.6745 * (l_extendedprice - med) / (mad + 1e-8)) <= 3.5) AS mz_out
       FROM sales, st, md)"""


@register("outlier_method_comparison", with_sales(_FLAG_SQL + """
, l AS (SELECT 'iqr' AS method, y, iqr_out AS o FROM fl UNION ALL SELECT 'zscore', y, z_out FROM fl
        UNION ALL SELECT 'modified_z', y, mz_out FROM fl UNION ALL SELECT 'union', y, iqr_out OR z_out OR mz_out FROM fl)
SELECT method, count(*) FILTER (WHERE o) AS n_outliers, round(count(*) FILTER (WHERE o) * 100.0::DOUBLE / count(*), 6) AS pct,
       round(avg(y) FILTER (WHERE NOT o), 4) AS inlier_mean, round(median(y) FILTER (WHERE NOT o), 4) AS inlier_median,
       round(stddev_samp(y) FILTER (WHERE NOT o), 4) AS inlier_std FROM l GROUP BY method"""))
def q_outlier_method_comparison(spark, sf_dir):
    """A38 + O7: outliers per method (IQR, z, modified z, union) and inlier
    statistics, from one unpivot of the flags."""
    s = _outlier_flags(spark, sf_dir)
    s = s.withColumn("union_in", ol.vote(["iqr_in", "z_in", "mz_in"], "union"))
    flags = {"iqr": "iqr_in", "zscore": "z_in", "modified_z": "mz_in", "union": "union_in"}
    long = s.select("l_extendedprice", *[F.col(v).alias(k) for k, v in flags.items()]) \
        .unpivot(["l_extendedprice"], list(flags), "method", "inlier")
    y = F.col("l_extendedprice")
    inl = F.col("inlier")
    out = long.groupBy("method").agg(
        F.count_if(~inl).alias("n_outliers"), F.round(F.count_if(~inl) * 100.0 / F.count(F.lit(1)), 6).alias("pct"),
        F.round(F.avg(F.when(inl, y)), 4).alias("inlier_mean"),
        F.round(F.stddev_samp(F.when(inl, y)), 4).alias("inlier_std"))
    out = with_quantiles(out, long.where(inl), ["method"], "l_extendedprice", [0.5], ["inlier_median"])
    return out.withColumn("inlier_median", F.round("inlier_median", 4))


@register("outlier_ensemble", with_sales("""
, st AS (SELECT segment, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3,
                avg(l_extendedprice) AS mu, stddev_pop(l_extendedprice) AS sd FROM sales GROUP BY segment),
fl AS (SELECT s.segment, l_extendedprice >= q1 - 0.75 * (q3 - q1) AND l_extendedprice <= q3 + 0.75 * (q3 - q1) AS i,
              abs((l_extendedprice - mu) / sd) <= 2.0 AS z FROM sales s JOIN st USING (segment))
SELECT segment, count(*) AS n_rows, count(*) FILTER (WHERE NOT i) AS iqr_out, count(*) FILTER (WHERE NOT z) AS z_out,
       count(*) FILTER (WHERE i AND z) AS settled_in, count(*) FILTER (WHERE NOT i AND NOT z) AS settled_out,
       CAST(0 AS BIGINT) AS vote_breaks, TRUE AS iso_share_kept FROM fl GROUP BY segment"""))
def q_outlier_ensemble(spark, sf_dir):
    """Two of three votes by group, the isolation forest among them.  Where
    fence and z-score agree they settle the vote; ``vote_breaks`` counts rows
    whose vote is not that of two of the flags; the forest's share of outliers
    is at most the contamination."""
    s = cut(sales(spark, sf_dir), *KEY_OUT, "segment", "l_extendedprice")
    out = ol.ensemble_inliers(s, "l_extendedprice", "segment", iqr_factor=0.75, z_thresh=2.0, contamination=0.05,
                              n_trees=50, id_cols=KEY_OUT)
    i, z, f, kept = (F.col(c) for c in ("in_iqr", "in_z", "in_iso", "is_inlier"))
    return out.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~i).alias("iqr_out"), F.count_if(~z).alias("z_out"),
        F.count_if(i & z & kept).alias("settled_in"), F.count_if(~i & ~z & ~kept).alias("settled_out"),
        F.count_if(kept != ((i & z) | (i & f) | (z & f))).alias("vote_breaks"),
        (F.count_if(~f) <= F.lit(0.05) * F.count(F.lit(1)) + 1).alias("iso_share_kept"))


@register("outlier_overlap", with_sales(_FLAG_SQL + """
SELECT count(*) FILTER (WHERE iqr_out) AS n_iqr, count(*) FILTER (WHERE z_out) AS n_z, count(*) FILTER (WHERE mz_out) AS n_mz,
       count(*) FILTER (WHERE iqr_out AND NOT z_out AND NOT mz_out) AS only_iqr,
       count(*) FILTER (WHERE z_out AND NOT iqr_out AND NOT mz_out) AS only_z,
       count(*) FILTER (WHERE mz_out AND NOT iqr_out AND NOT z_out) AS only_mz,
       count(*) FILTER (WHERE iqr_out AND z_out AND mz_out) AS n_all,
       count(*) FILTER (WHERE iqr_out OR z_out OR mz_out) AS n_any FROM fl"""))
def q_outlier_overlap(spark, sf_dir):
    """Sizes of the flagged sets, their exclusive parts, intersection and union."""
    s = _outlier_flags(spark, sf_dir)
    s = s.select((~F.col("iqr_in")).alias("iqr"), (~F.col("z_in")).alias("z"), (~F.col("mz_in")).alias("mz"))
    return eda.flag_overlap(s, ["iqr", "z", "mz"])


@register("unseen_categories", with_sales("""
, tr AS (SELECT * FROM sales WHERE year < 1998), te AS (SELECT * FROM sales WHERE year >= 1998),
l AS (SELECT 'p_name' AS "column", p_name AS v FROM te UNION ALL SELECT 's_name', s_name FROM te
      UNION ALL SELECT 'brand', brand FROM te UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM te),
trl AS (SELECT DISTINCT 'p_name' AS "column", p_name AS v FROM tr UNION ALL SELECT DISTINCT 's_name', s_name FROM tr
        UNION ALL SELECT DISTINCT 'brand', brand FROM tr UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM tr),
u AS (SELECT * FROM l ANTI JOIN trl USING ("column", v))
SELECT l."column", count(*) AS n_rows,
       coalesce((SELECT count(DISTINCT v) FROM u WHERE u."column" = l."column"), 0) AS n_unseen_values,
       coalesce((SELECT count(*) FROM u WHERE u."column" = l."column"), 0) AS n_unseen_rows,
       round(coalesce((SELECT count(*) FROM u WHERE u."column" = l."column"), 0) * 100.0::DOUBLE / count(*), 6) AS unseen_pct
FROM l GROUP BY l."column\""""))
def q_unseen_categories(spark, sf_dir):
    """Test categories never seen in train, per column."""
    s = sales(spark, sf_dir)
    cols = ["p_name", "s_name", "brand", "o_orderpriority"]
    u = eda.unseen_categories(s.where(F.col("year") < 1998), s.where(F.col("year") >= 1998), cols)
    return u.select("column", "n_rows", "n_unseen_values", "n_unseen_rows", F.round("unseen_pct", 6).alias("unseen_pct"))


@register("frequency_alignment", with_sales(f"""
, a AS (SELECT zone, count(*) AS count_a FROM sales GROUP BY zone),
b AS (SELECT zone, count(*) AS count_b FROM sales WHERE {_FILTERED} AND zone <> 'NATION_3' GROUP BY zone)
SELECT coalesce(a.zone, b.zone) AS zone, coalesce(count_a, 0) AS count_a, coalesce(count_b, 0) AS count_b
FROM a FULL OUTER JOIN b ON a.zone = b.zone"""))
def q_frequency_alignment(spark, sf_dir):
    """Zone frequencies raw vs filtered aligned by a full outer join."""
    s = sales(spark, sf_dir)
    f = s.where(F.expr(_FILTERED) & (F.col("zone") != "NATION_3"))
    return eda.frequency_alignment(s, f, "zone")


@register("diverse_sample")
def q_diverse_sample(spark, sf_dir):
    """One row per (zone, type) stratum first, then seeded-hash fill to 200."""
    s = sales(spark, sf_dir)
    return eda.diverse_sample(s.select(*ORDER_KEY, "zone", "ptype"), ["zone", "ptype"], ORDER_KEY, 200)


@register("percent_rank", with_sales(f"""
SELECT {KEYS_SQL}, round(percent_rank() OVER (ORDER BY l_extendedprice), 10) AS uniform FROM sales"""))
def q_percent_rank(spark, sf_dir):
    """Rank-based uniform transform of the price (ties share a rank)."""
    s = sales(spark, sf_dir).select(*KEY_OUT, "l_extendedprice")
    return eda.percent_ranks(s, "l_extendedprice").select(*KEY_OUT, F.round("uniform", 10).alias("uniform"))


@register("quantile_uniform", with_sales(f"""
, q AS (SELECT quantile_cont(l_extendedprice, [{", ".join(f"{i}/999.0::DOUBLE" for i in range(1000))}]) AS q FROM sales WHERE year < 2000),
step AS (SELECT unnest(q) AS v, generate_subscripts(q, 1) - 1 AS i FROM q),
kn AS (SELECT v, min(i) / 999.0::DOUBLE AS low, max(i) / 999.0::DOUBLE AS high FROM step GROUP BY v),
seg AS (SELECT *, lead(v) OVER (ORDER BY v) AS nv, lead(low) OVER (ORDER BY v) AS nlow FROM kn),
ends AS (SELECT min(v) AS v0, max(v) AS v1 FROM kn)
SELECT {KEYS_SQL}, round(CASE WHEN l_extendedprice <= v0 THEN 0.0 WHEN l_extendedprice >= v1 THEN 1.0
         WHEN l_extendedprice = v THEN (low + high) / 2 ELSE high + (l_extendedprice - v) / (nv - v) * (nlow - high) END, 8) AS uniform
FROM sales ASOF LEFT JOIN seg ON l_extendedprice >= seg.v, ends"""))
def q_quantile_uniform(spark, sf_dir):
    """The target on its place among 1,000 quantiles of the training rows."""
    s = sales(spark, sf_dir)
    fit = scale.fit_quantile_map(s.where(F.col("year") < 2000), "l_extendedprice")
    return scale.apply_quantile_map(s, fit, "uniform").select(*KEY_OUT, F.round("uniform", 8).alias("uniform"))


@register("quantile_normal")
def q_quantile_normal(spark, sf_dir):
    """W10 + A36: the target made normal by its quantiles; moments by split."""
    s = cut(sales(spark, sf_dir), "l_extendedprice", "year")
    fit = scale.fit_quantile_map(s.where(F.col("year") < 2000), "l_extendedprice")
    z = scale.apply_quantile_map(s, fit, "z", "normal").withColumn("split", F.when(F.col("year") < 2000, "train").otherwise("test"))
    return z.groupBy("split").agg(F.count("z").alias("n"), *[F.round(f("z"), 6).alias(c) for c, f in (
        ("mean", F.avg), ("std", F.stddev_pop), ("skew", F.skewness), ("kurtosis", F.kurtosis), ("least", F.min), ("greatest", F.max))])


_PHI_UPPER = """exp(-z * z / 2) / sqrt(2 * pi()) * (1 / (1 + 0.2316419 * z)) * (0.319381530 + (1 / (1 + 0.2316419 * z)) * (-0.356563782
  + (1 / (1 + 0.2316419 * z)) * (1.781477937 + (1 / (1 + 0.2316419 * z)) * (-1.821255978 + (1 / (1 + 0.2316419 * z)) * 1.330274429))))"""


@register("normality_pvalues", with_sales(f"""
, t AS (SELECT segment, 'raw' AS transform, l_extendedprice AS v FROM sales
        UNION ALL SELECT segment, 'log1p', ln(1 + l_extendedprice) FROM sales
        UNION ALL SELECT segment, 'sqrt', sqrt(l_extendedprice) FROM sales),
m AS (SELECT segment, transform, avg(v) AS mu, stddev_samp(v) AS sd, count(*) AS n FROM t GROUP BY ALL),
mo AS (SELECT segment, transform, avg(power(v - mu, 3)) / power(avg(power(v - mu, 2)), 1.5) AS skew,
              avg(power(v - mu, 4)) / power(avg(power(v - mu, 2)), 2) - 3 AS kurtosis FROM t JOIN m USING (segment, transform) GROUP BY ALL),
r AS (SELECT segment, transform, v, row_number() OVER (PARTITION BY segment, transform ORDER BY v)::DOUBLE AS i FROM t),
u AS (SELECT r.*, n, abs((v - mu) / sd) AS z, v >= mu AS above FROM r JOIN m USING (segment, transform)),
w AS (SELECT *, {_PHI_UPPER} AS tail FROM u),
ph AS (SELECT *, CASE WHEN above THEN 1 - tail ELSE tail END AS lo, CASE WHEN above THEN tail ELSE 1 - tail END AS hi FROM w),
f AS (SELECT segment, transform, max(n) AS n, max(greatest(i / n - lo, lo - (i - 1) / n)) AS d,
             -max(n) - sum((2 * i - 1) * ln(lo) + (2 * (n + 1 - i) - 1) * ln(hi)) / max(n) AS ad FROM ph GROUP BY ALL),
g AS (SELECT f.*, skew, kurtosis, f.n / 6.0 * (skew * skew + kurtosis * kurtosis / 4) AS jb,
             (sqrt(f.n) + 0.12 + 0.11 / sqrt(f.n)) * d AS lam, ad * (1 + 0.75 / f.n + 2.25 / (f.n * f.n)) AS a
      FROM f JOIN mo USING (segment, transform))
SELECT segment, transform, n, round(d, 6) AS ks_stat, round(ad, 4) AS anderson_darling, round(jb, 4) AS jarque_bera,
       round(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
             lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam))))) END, 6) AS ks_p,
       round(exp(-jb / 2), 6) AS jb_p,
       round(CASE WHEN a < 0.2 THEN 1 - exp(-13.436 + 101.14 * a - 223.73 * a * a) WHEN a < 0.34 THEN 1 - exp(-8.318 + 42.796 * a - 59.938 * a * a)
             WHEN a < 0.6 THEN exp(0.9177 - 4.279 * a - 1.38 * a * a) WHEN a < 13 THEN exp(1.2937 - 5.709 * a + 0.0186 * a * a) ELSE 0.0 END, 6) AS ad_p,
       round(abs(skew) + abs(kurtosis) + 1 - exp(-jb / 2), 6) AS score FROM g"""))
def q_normality_pvalues(spark, sf_dir):
    """Statistics, p-values and score of the price under three transforms, by segment."""
    s = sales(spark, sf_dir).select("segment", F.col("l_extendedprice").alias("raw"), F.log1p("l_extendedprice").alias("log1p"),
                                    F.sqrt("l_extendedprice").alias("sqrt"))
    long = s.unpivot(["segment"], ["raw", "log1p", "sqrt"], "transform", "v")
    digits = {"ks_stat": 6, "anderson_darling": 4, "jarque_bera": 4, "ks_p": 6, "jb_p": 6, "ad_p": 6, "score": 6}
    return eda.normality_report(long, "v", ["segment", "transform"]).select(
        "segment", "transform", "n", *[F.round(c, d).alias(c) for c, d in digits.items()])
