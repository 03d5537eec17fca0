"""Profiling statistics.

All are aggregations over the whole table; results are small (one row per
column, group or category pair).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import normal_cdf
from .lookup import attach, fit_table
from .quantiles import with_quantiles


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample std, min, quartiles, max."""
    c = F.col(col)
    agg = df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).alias("min"), F.max(c).alias("max"))
    return with_quantiles(agg, df, [], col, [0.25, 0.5, 0.75], ["q25", "median", "q75"]) \
        .select("count", "mean", "std", "min", "q25", "median", "q75", "max")


def sample_moments(c: Column) -> tuple[Column, Column, Column]:
    """n, sample-corrected skewness and excess kurtosis (pandas' ``skew`` and
    ``kurt``) from Spark's population moments."""
    n = F.count(c)
    g1, g2 = F.skewness(c), F.kurtosis(c)
    skew = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
    return n, skew, kurt


def target_correlations(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Pearson r of every column with the target over complete rows, sorted
    by |r| (A27, S4).  One aggregation, then a wide-to-long reshape."""
    complete = df.dropna(subset=[target, *cols])
    agg = complete.agg(*[F.corr(F.col(c).cast("double"), F.col(target)).alias(c) for c in cols])
    long = agg.unpivot([], cols, "feature", "r").where(F.col("r").isNotNull() & ~F.isnan("r"))
    return long.withColumn("abs_r", F.abs("r"))


def cramers_v(df: DataFrame, x: str, y: str) -> DataFrame:
    """Bias-corrected Cramér's V of two categoricals.

    chi2 = sum(O^2/E) - n over the observed cells only (empty cells add
    nothing to sum(O^2/E)); Yates' correction when the table is 2x2."""
    cells = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count(F.lit(1)).alias("o"))
    rx = fit_table(cells.groupBy(x).agg(F.sum("o").alias("nx")), [x])
    ry = fit_table(cells.groupBy(y).agg(F.sum("o").alias("ny")), [y])
    j = attach(attach(cells, rx, "inner"), ry, "inner")
    tot = cells.agg(F.sum("o").alias("n"), F.countDistinct(x).alias("r"), F.countDistinct(y).alias("k")).first()
    n, r, k = tot["n"], tot["r"], tot["k"]
    e = F.col("nx") * F.col("ny") / F.lit(n)
    if r == 2 and k == 2:
        # Yates over all four cells: a cell without rows counts as well, with O = 0
        grid = rx.df.select(F.col(x), "nx").join(F.broadcast(ry.df.select(F.col(y), "ny")), F.lit(True)).join(cells, [x, y], "left")
        off = F.abs(F.coalesce(F.col("o"), F.lit(0)) - e)
        term = F.pow(off - F.least(F.lit(0.5), off), 2) / e
        chi2 = grid.agg(F.sum(term)).first()[0]
    else:
        chi2 = j.agg(F.sum(F.col("o") * F.col("o") / e)).first()[0] - n
    phi2 = chi2 / n
    phi2c = max(0.0, phi2 - (k - 1) * (r - 1) / (n - 1))
    rc = r - (r - 1) ** 2 / (n - 1)
    kc = k - (k - 1) ** 2 / (n - 1)
    denom = min(kc - 1, rc - 1)
    v = (phi2c / denom) ** 0.5 if denom > 0 else 0.0
    spark = df.sparkSession
    return spark.createDataFrame([(x, y, float(chi2), int(n), float(v))],
                                 "x string, y string, chi2 double, n long, cramers_v double")


def correlation_ratio(df: DataFrame, cat: str, num: str) -> DataFrame:
    """eta and eta^2 of a numeric column explained by a categorical."""
    d = df.where(F.col(cat).isNotNull() & F.col(num).isNotNull())
    mean = d.agg(F.avg(num)).first()[0]
    g = d.groupBy(cat).agg(F.count(F.lit(1)).alias("n"), F.avg(num).alias("m"))
    between = g.agg(F.sum(F.col("n") * F.pow(F.col("m") - F.lit(mean), 2)).alias("b"))
    total = d.agg(F.sum(F.pow(F.col(num) - F.lit(mean), 2)).alias("t"))
    b, t = between.first()["b"], total.first()["t"]
    eta2 = b / t if t else 0.0
    return df.sparkSession.createDataFrame([(cat, num, float(eta2), float(eta2) ** 0.5)],
                                           "category string, numeric string, eta2 double, eta double")


def group_stats_cv(df: DataFrame, group: str, col: str) -> DataFrame:
    """count, mean, median, sample std and coefficient of variation %."""
    agg = df.groupBy(group).agg(F.count(col).alias("count"), F.avg(col).alias("mean"),
                                F.stddev_samp(col).alias("std"))
    return with_quantiles(agg, df.where(F.col(group).isNotNull()), [group], col, [0.5], ["median"]) \
        .withColumn("cv_pct", F.col("std") / F.col("mean") * 100)


def frequency_share(df: DataFrame, col: str) -> DataFrame:
    """Count and % share per value (A33).  The total comes from a second
    small aggregation, not a window over all rows."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = df.count()
    return counts.withColumn("pct", F.col("count") * 100.0 / F.lit(total))


def compare_stats(raw: DataFrame, filtered: DataFrame, col: str) -> DataFrame:
    """Eight statistics of a column before/after filtering with delta and
    delta % (A34); skewness/kurtosis are the sample-corrected forms."""
    def stats(d, tag):
        c = F.col(col)
        n, sk, ku = sample_moments(c)
        a = d.agg(n.alias("count"), F.avg(c).alias("mean"),
                  F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
                  sk.alias("skew"), ku.alias("kurtosis"))
        a = with_quantiles(a, d, [], col, [0.5], ["median"])
        names = ["count", "mean", "median", "std", "min", "max", "skew", "kurtosis"]
        return a.select(*[F.col(x).cast("double").alias(x) for x in names]) \
            .unpivot([], names, "statistic", tag)
    j = stats(raw, "raw").join(stats(filtered, "filtered"), "statistic")
    return (j.withColumn("delta", F.col("filtered") - F.col("raw"))
            .withColumn("delta_pct", F.try_divide(F.col("delta") * 100, F.abs(F.col("raw")))))


def normality(df: DataFrame, col: str, by: list[str] = ()) -> DataFrame:
    """Skewness, excess kurtosis (population), Jarque-Bera statistic and a
    ranking score |skew| + |kurtosis| (A36)."""
    c = F.col(col)
    out = df.groupBy(*by).agg(F.count(c).alias("n"), F.skewness(c).alias("skew"), F.kurtosis(c).alias("kurtosis"))
    return (out.withColumn("jarque_bera", F.col("n") / 6 * (F.pow("skew", 2) + F.pow("kurtosis", 2) / 4))
            .withColumn("score", F.abs("skew") + F.abs("kurtosis")))


def kolmogorov_pvalue(d: Column, n: Column) -> Column:
    """Asymptotic p-value of a one-sample Kolmogorov statistic (Stephens' correction)."""
    root = F.sqrt(n)
    lam = (root + 0.12 + 0.11 / root) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
                         * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


# fixed values: D'Agostino and Stephens, Goodness-of-Fit Techniques (1986), table 4.9, case 3;
# (below, whether of the complement, constant, linear, quadratic)
_AD_PIECES = [(0.2, True, -13.436, 101.14, -223.73), (0.34, True, -8.318, 42.796, -59.938),
              (0.6, False, 0.9177, -4.279, -1.38), (13.0, False, 1.2937, -5.709, 0.0186)]


def anderson_pvalue(a2: Column, n: Column) -> Column:
    """p-value of the Anderson-Darling statistic against a fitted normal; 0 from 13 on (below 1e-23)."""
    a = a2 * (1 + 0.75 / n + 2.25 / (n * n))
    out = F.when(a2.isNull(), None)
    for below, complement, c0, c1, c2 in _AD_PIECES:
        e = F.exp(c0 + c1 * a + c2 * a * a)
        out = out.when(a < below, 1 - e if complement else e)
    return out.otherwise(0.0)


def normality_report(df: DataFrame, value: str, by: list[str], alpha: float = 0.05) -> DataFrame:
    """Per group: moments, Jarque-Bera, one-sample Kolmogorov and Anderson-Darling
    statistics against a normal with the group's mean and sample deviation,
    their p-values, verdicts at ``alpha`` and the score |skew| + |kurtosis| + 1 - p
    with Jarque-Bera's p (A36).

    Both distribution statistics come from running counts over the distinct
    values, one range-partitioned pass for all groups: a value held c times with
    k rows below stands for the ranks k + 1 to k + c.  NULL and NaN values are
    left out; a group without spread has NULL statistics and no verdicts."""
    from .diagnostics import running_sums
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    v = F.col("_v")
    stats = fit_table(rows.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("_m"), F.stddev_samp(v).alias("_s"),
                                            F.skewness(v).alias("skew"), F.kurtosis(v).alias("kurtosis")), by)
    spread = stats.df.where(F.col("_s") > 0)
    counts = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")).join(spread.select(*by), by, "left_semi")
    placed = running_sums(counts, by, "_v", ["_c"]).join(stats.joinable().select(*by, "n", "_m", "_s"), by)
    z, n = (v - F.col("_m")) / F.col("_s"), F.col("n").cast("double")
    upto, c = F.col("cum__c").cast("double"), F.col("_c").cast("double")
    below = upto - c
    # columns of their own, both tails from the small side
    placed = placed.withColumn("_lo", F.greatest(normal_cdf(z), F.lit(1e-300))).withColumn("_hi", F.greatest(normal_cdf(-z), F.lit(1e-300)))
    gap = F.greatest(upto / n - F.col("_lo"), F.col("_lo") - below / n)
    term = (upto * upto - below * below) * F.log("_lo") + ((n - below) * (n - below) - (n - upto) * (n - upto)) * F.log("_hi")
    fit = placed.groupBy(*by).agg(F.max(gap).alias("ks_stat"), (-F.max(n) - F.sum(term) / F.max(n)).alias("anderson_darling"))
    out = stats.df.drop("_m", "_s").join(fit, by, "left")
    jb = F.when(F.col("ks_stat").isNotNull(), F.col("n") / 6 * (F.pow("skew", 2) + F.pow("kurtosis", 2) / 4))
    out = out.withColumn("jarque_bera", jb).withColumns({
        "jb_p": F.exp(-F.col("jarque_bera") / 2),  # upper tail of chi-squared with two degrees of freedom
        "ks_p": kolmogorov_pvalue(F.col("ks_stat"), n), "ad_p": anderson_pvalue(F.col("anderson_darling"), n)})
    return out.withColumns({f"{t}_normal": F.col(f"{t}_p") > alpha for t in ("jb", "ks", "ad")} |
                           {"score": F.abs("skew") + F.abs("kurtosis") + 1 - F.col("jb_p")})


def ks_vs_normal(df: DataFrame, col: str) -> float:
    """One-sample KS statistic against a normal with the sample mean/std
    (Spark ML, A36)."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    st = df.agg(F.avg(col), F.stddev_samp(col)).first()
    res = KolmogorovSmirnovTest.test(df.select(F.col(col).cast("double")), col, "norm", st[0], st[1]).first()
    return float(res.statistic)


def anderson_darling_normal(df: DataFrame, col: str) -> DataFrame:
    """Anderson-Darling A^2 against a fitted normal (A36).  Needs each
    value's rank i and n+1-i: ranks come from the range-partitioned
    :func:`global_positions`, Phi from a polynomial column expression."""
    from .ranking import global_positions
    st = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"), F.count(col).alias("n")).first()
    n = st["n"]
    d = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    ranked = global_positions(d, ["x"], "_i")               # 0-based rank i-1
    z = (F.col("x") - F.lit(st["m"])) / F.lit(st["s"])
    phi = F.least(F.greatest(normal_cdf(z), F.lit(1e-300)), F.lit(1 - 1e-16))
    # sum over i of (2i-1) [ln Phi(z_i) + ln(1 - Phi(z_{n+1-i}))]: the second
    # term pairs rank i with rank n+1-i, so emit each value's contribution to
    # both roles: as i (ln Phi) and as n+1-i (ln(1-Phi)).
    i1 = F.col("_i") + 1
    term = (2 * i1 - 1) * F.log(phi) + (2 * (F.lit(n) + 1 - i1) - 1) * F.log(1 - phi)
    s = ranked.agg(F.sum(term)).first()[0]
    a2 = -n - s / n
    return df.sparkSession.createDataFrame([(col, int(n), float(a2))], "column string, n long, anderson_darling double")


def unseen_categories(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: distinct test values absent from train and their share of
    test rows (U2).  Long form (column, value) + one left anti join."""
    def long(d):
        return d.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value") \
            .where(F.col("value").isNotNull())
    tr = long(train).distinct()
    te = long(test)
    unseen = te.join(tr, ["column", "value"], "left_anti")
    per = unseen.groupBy("column").agg(F.countDistinct("value").alias("n_unseen_values"),
                                       F.count(F.lit(1)).alias("n_unseen_rows"))
    tot = te.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"))
    return (tot.join(per, "column", "left").na.fill(0, ["n_unseen_values", "n_unseen_rows"])
            .withColumn("unseen_pct", F.col("n_unseen_rows") * 100.0 / F.col("n_rows")))


def flag_overlap(df: DataFrame, flags: list[str]) -> DataFrame:
    """Counts of flagged-row combinations in one pass (U3): each flag alone,
    only-that-flag, all flags, any flag."""
    f = [F.col(x) for x in flags]
    aggs = [F.count_if(c).alias(f"n_{x}") for x, c in zip(flags, f)]
    for i, (x, c) in enumerate(zip(flags, f)):
        others = [o for j, o in enumerate(f) if j != i]
        only = c
        for o in others:
            only = only & ~o
        aggs.append(F.count_if(only).alias(f"only_{x}"))
    all_ = f[0]
    any_ = f[0]
    for c in f[1:]:
        all_ = all_ & c
        any_ = any_ | c
    aggs += [F.count_if(all_).alias("n_all"), F.count_if(any_).alias("n_any")]
    return df.agg(*aggs)


def frequency_alignment(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Value counts of two frames side by side, missing values filled with 0
    (J16: full outer join)."""
    ca = a.groupBy(col).agg(F.count(F.lit(1)).alias("count_a"))
    cb = b.groupBy(col).agg(F.count(F.lit(1)).alias("count_b"))
    return ca.join(cb, col, "full_outer").na.fill(0, ["count_a", "count_b"])


def diverse_sample(df: DataFrame, strata: list[str], order_cols: list[str], n: int, seed: int = 42) -> DataFrame:
    """First row (by ``order_cols``) of every stratum, then the other rows in
    a seeded hash order, limited to ``n`` (W6).

    The first row per stratum is a ``min(struct)`` aggregation (partial
    aggregation, no per-stratum sort); the final ``orderBy().limit(n)`` is a
    bounded top-k."""
    firsts = df.groupBy(*strata).agg(F.min(F.struct(*order_cols)).alias("_f")) \
        .select(*[F.col(f"_f.{c}").alias(c) for c in order_cols]).withColumn("_first", F.lit(1))
    marked = df.join(firsts, order_cols, "left").withColumn("_first", F.coalesce("_first", F.lit(0)))
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in order_cols])
    return marked.orderBy(F.col("_first").desc(), h, *order_cols).limit(n).drop("_first")


def percent_ranks(df: DataFrame, col: str) -> DataFrame:
    """Rank-based uniform transform ``(rank-1)/(n-1)`` with ties sharing the
    lowest rank (W10), from skew-proof running counts of distinct values."""
    from .diagnostics import running_sums
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("c")) \
        .withColumn("_k", F.lit(1))
    cum = running_sums(counts, ["_k"], col, ["c"])
    n = df.where(F.col(col).isNotNull()).count()
    tab = cum.select(col, ((F.col("cum_c") - F.col("c")) / F.lit(max(n - 1, 1))).alias("uniform"))
    return df.join(tab, col, "left")
