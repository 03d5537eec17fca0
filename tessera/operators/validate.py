"""Data-quality validation producing an issues DataFrame.

Each rule becomes a boolean "violation" expression.  All violation counts of
a dataset are computed in ONE aggregation; only rules with violations then
fetch their first 10 offending ids with ``orderBy(id).limit(10)`` (a bounded
per-task top-k).  Grouped rules (uniqueness, IQR share, foreign keys) are
aggregations/joins of their own.  The report is a DataFrame:

``(dataset, check, severity, column, n_violations, sample_ids, message)``
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import numeric_columns, string_columns
from .columns import q
from .quantiles import with_quantiles

CRITICAL, ERROR, WARNING, INFO = "CRITICAL", "ERROR", "WARNING", "INFO"
ISSUE_SCHEMA = ("dataset string, check string, severity string, column string, n_violations long, "
                "sample_ids string, message string")


@dataclass
class Rule:
    check: str
    severity: str
    column: str | None
    violation: Column
    message: str


@dataclass
class ValidationConfig:
    required_columns: list = field(default_factory=list)
    strict_columns: bool = False
    dtypes: dict = field(default_factory=dict)           # column -> "numeric" | "string" | "datetime"
    max_missing_share: float = 0.5
    not_null: list = field(default_factory=list)
    integer_columns: list = field(default_factory=list)
    ranges: dict = field(default_factory=dict)           # column -> (min, max)
    unique: list = field(default_factory=list)           # list of column lists
    patterns: dict = field(default_factory=dict)         # column -> regex (anchored at start)
    consistency: list = field(default_factory=list)      # (name, SQL condition)
    skew_limit: float | None = None
    kurtosis_limit: float | None = None
    iqr_share_limit: float = 0.05
    date_columns: list = field(default_factory=list)
    foreign_keys: dict = field(default_factory=dict)     # column -> (parent DataFrame, parent column)
    disabled: set = field(default_factory=set)


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                       T.DecimalType)):
        return "numeric"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dt, T.StringType):
        return "string"
    return dt.simpleString()


class Validator:
    def __init__(self, spark: SparkSession, id_col: str, cfg: ValidationConfig):
        self.spark, self.id_col, self.cfg = spark, id_col, cfg

    # -- V1 -------------------------------------------------------------------
    def schema_issues(self, df: DataFrame, name: str) -> list[tuple]:
        out = []
        missing = [c for c in self.cfg.required_columns if c not in df.columns]
        if missing:
            out.append((name, "schema", CRITICAL, None, len(missing), None,
                        f"Missing required columns: {sorted(missing)}"))
        if self.cfg.strict_columns and self.cfg.required_columns:
            extra = [c for c in df.columns if c not in self.cfg.required_columns and c != self.id_col]
            if extra:
                out.append((name, "schema", WARNING, None, len(extra), None, f"Unexpected columns: {sorted(extra)}"))
        for c, want in self.cfg.dtypes.items():
            if c in df.columns and _kind(df.schema[c].dataType) != want:
                out.append((name, "data_types", ERROR, c, 1, None,
                            f"expected {want}, found {df.schema[c].dataType.simpleString()}"))
        return out

    # -- row rules (V2-V4, V6, V7, V10) -----------------------------------------------
    def row_rules(self, df: DataFrame) -> list[Rule]:
        cfg, rules = self.cfg, []
        for c in cfg.not_null:
            if c in df.columns:
                rules.append(Rule("missing_values", ERROR, c, q(c).isNull(), "NULL in a no-null column"))
        for c in cfg.integer_columns:
            if c in df.columns:
                rules.append(Rule("data_types", WARNING, c, q(c).isNotNull() & (q(c) != F.floor(q(c))),
                                  "non-integer value"))
        for c, (lo, hi) in cfg.ranges.items():
            if c in df.columns:
                v = F.lit(False)
                if lo is not None:
                    v = v | (q(c) < F.lit(lo))
                if hi is not None:
                    v = v | (q(c) > F.lit(hi))
                rules.append(Rule("ranges", ERROR, c, F.coalesce(v, F.lit(False)), f"outside [{lo}, {hi}]"))
        for c, pat in cfg.patterns.items():
            if c in df.columns:
                rules.append(Rule("patterns", WARNING, c, q(c).isNotNull() & ~q(c).rlike(f"^(?:{pat})"),
                                  f"does not match {pat}"))
        for nm, cond in cfg.consistency:
            rules.append(Rule("consistency", ERROR, nm, ~F.coalesce(F.expr(cond), F.lit(False)),
                              f"violates {cond}"))
        for c in cfg.date_columns:
            if c not in df.columns:
                continue
            if isinstance(df.schema[c].dataType, T.StringType):
                ts = F.try_to_timestamp(q(c))
                rules.append(Rule("temporal", ERROR, c, q(c).isNotNull() & ts.isNull(), "unparseable date"))
            else:
                ts = q(c).cast("timestamp")
            late = F.add_months(F.current_date(), 120)
            rules.append(Rule("temporal", WARNING, c,
                              F.coalesce((ts < F.lit("1900-01-01").cast("timestamp")) | (ts > late), F.lit(False)),
                              "date before 1900 or more than 10 years ahead"))
        return [r for r in rules if r.check not in cfg.disabled]

    def _samples(self, df: DataFrame, cond: Column) -> str:
        ids = [str(r[0]) for r in df.where(cond).select(self.id_col).orderBy(self.id_col).limit(10).collect()]
        return ",".join(ids)

    # -- column rules in one aggregation (V2, V3, V8) ----------------------------------
    def column_issues(self, df: DataFrame, name: str) -> list[tuple]:
        cfg, out = self.cfg, []
        cols = [c for c in df.columns if c != self.id_col]
        strs = string_columns(df, (self.id_col,))
        nums = numeric_columns(df, (self.id_col,))
        exprs = [F.count(F.lit(1)).alias("_n")]
        exprs += [F.count_if(q(c).isNull()).alias(f"null_{i}") for i, c in enumerate(cols)]
        for i, c in enumerate(strs):
            num = q(c).try_cast("double").isNotNull()
            exprs += [F.count_if(q(c).isNotNull() & num).alias(f"sn_{i}"),
                      F.count_if(q(c).isNotNull() & ~num).alias(f"st_{i}")]
        for i, c in enumerate(nums):
            exprs += [F.skewness(q(c)).alias(f"sk_{i}"), F.kurtosis(q(c)).alias(f"ku_{i}"),
                      F.count(q(c)).alias(f"nn_{i}")]
        row = df.agg(*exprs).first()
        n = row["_n"] or 0
        if "missing_values" not in cfg.disabled:
            for i, c in enumerate(cols):
                share = row[f"null_{i}"] / n if n else 0.0
                if share > cfg.max_missing_share:
                    out.append((name, "missing_values", WARNING, c, row[f"null_{i}"], None,
                                f"missing share {share:.4f} > {cfg.max_missing_share}"))
        if "data_types" not in cfg.disabled:
            for i, c in enumerate(strs):
                if row[f"sn_{i}"] and row[f"st_{i}"]:
                    out.append((name, "data_types", WARNING, c, min(row[f"sn_{i}"], row[f"st_{i}"]), None,
                                "mixed numeric and text values"))
        if "distributions" not in cfg.disabled and (cfg.skew_limit or cfg.kurtosis_limit):
            for i, c in enumerate(nums):
                m = row[f"nn_{i}"]
                g1, g2 = row[f"sk_{i}"], row[f"ku_{i}"]
                if m is None or m < 4 or g1 is None or g2 is None:
                    continue
                skew = g1 * (m * (m - 1)) ** 0.5 / (m - 2)            # sample-corrected
                kurt = ((m + 1) * g2 + 6) * (m - 1) / ((m - 2) * (m - 3))
                if cfg.skew_limit and abs(skew) > cfg.skew_limit:
                    out.append((name, "distributions", INFO, c, 1, None, f"skewness {skew:.4f}"))
                if cfg.kurtosis_limit and abs(kurt) > cfg.kurtosis_limit:
                    out.append((name, "distributions", INFO, c, 1, None, f"kurtosis {kurt:.4f}"))
        return out

    # -- V5 ---------------------------------------------------------------------------
    def uniqueness_issues(self, df: DataFrame, name: str) -> list[tuple]:
        out = []
        for keys in self.cfg.unique:
            keys = [keys] if isinstance(keys, str) else list(keys)
            g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.min(self.id_col).alias("_first"))
            dups = g.where(F.col("_c") > 1)
            n = dups.agg(F.sum(F.col("_c") - 1)).first()[0] or 0
            if n:
                if self.id_col in keys:
                    # the id itself repeats: report the repeated values
                    sample = dups.select(self.id_col).orderBy(self.id_col).limit(10)
                else:
                    # ids of the 2nd+ occurrences of each duplicated key
                    same = dups.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
                    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
                    sample = df.join(same, on).where(F.col(self.id_col) > F.col("_first")) \
                        .select(self.id_col).orderBy(self.id_col).limit(10)
                ids = ",".join(str(r[0]) for r in sample.collect())
                out.append((name, "uniqueness", ERROR, "+".join(keys), int(n), ids, "duplicate key"))
        return out

    # -- V9 ---------------------------------------------------------------------------
    def outlier_issues(self, df: DataFrame, name: str) -> list[tuple]:
        nums = numeric_columns(df, (self.id_col,))
        if not nums or "outliers" in self.cfg.disabled:
            return []
        long = df.select(*[q(c).cast("double").alias(c) for c in nums]).unpivot([], nums, "feature", "v") \
            .where(F.col("v").isNotNull())
        st = long.groupBy("feature").agg(F.count(F.lit(1)).alias("_n"))
        st = with_quantiles(st, long, ["feature"], "v", [0.25, 0.75], ["_qa", "_qb"]) \
            .withColumn("_q", F.array("_qa", "_qb")).drop("_qa", "_qb")
        j = long.join(F.broadcast(st), "feature")   # one row per numeric column
        lo = F.col("_q")[0] - 1.5 * (F.col("_q")[1] - F.col("_q")[0])
        hi = F.col("_q")[1] + 1.5 * (F.col("_q")[1] - F.col("_q")[0])
        res = j.groupBy("feature", "_n").agg(F.count_if((F.col("v") < lo) | (F.col("v") > hi)).alias("_o")).collect()
        out = []
        for r in res:
            if r["_n"] >= 10 and r["_o"] / r["_n"] > self.cfg.iqr_share_limit:
                out.append((name, "outliers", WARNING, r["feature"], r["_o"], None,
                            f"IQR outlier share {r['_o'] / r['_n']:.4f}"))
        return out

    # -- V11 --------------------------------------------------------------------------
    def fk_issues(self, df: DataFrame, name: str) -> list[tuple]:
        out = []
        for c, (parent, pc) in self.cfg.foreign_keys.items():
            orphans = df.where(q(c).isNotNull()).join(parent.select(F.col(pc).alias(c)).distinct(), c, "left_anti")
            n = orphans.count()
            if n:
                ids = ",".join(str(r[0]) for r in orphans.select(self.id_col).orderBy(self.id_col).limit(10).collect())
                out.append((name, "referential_integrity", ERROR, c, n, ids, "value missing in parent"))
        return out

    def rule_issues(self, df: DataFrame, name: str, rules: list) -> list[tuple]:
        """Violations of all row rules in one aggregation; when that fails, rule by
        rule, so that a rule that can't be evaluated becomes an issue of its own."""
        if not rules:
            return []
        counted = [F.count_if(r.violation).alias(f"r{i}") for i, r in enumerate(rules)]
        broken = {}
        try:
            row = df.agg(*counted).first().asDict()
        except Exception:  # noqa: BLE001
            row = {}
            for i, c in enumerate(counted):
                try:
                    row[f"r{i}"] = df.agg(c).first()[0]
                except Exception as e:  # noqa: BLE001
                    broken[i] = str(e).split("\n")[0]
        out = []
        for i, r in enumerate(rules):
            if i in broken:
                out.append((name, r.check, ERROR, r.column, 1, None, f"validator failed: {broken[i]}"))
            elif row[f"r{i}"]:
                out.append((name, r.check, r.severity, r.column, row[f"r{i}"], self._samples(df, r.violation), r.message))
        return out

    def validate(self, df: DataFrame, name: str, custom: list = ()) -> DataFrame:
        """All validators; a failing validator becomes an ERROR issue."""
        issues: list[tuple] = []
        steps = [self.schema_issues, self.column_issues, self.uniqueness_issues,
                 self.outlier_issues, self.fk_issues]
        for step in steps:
            try:
                issues += step(df, name)
            except Exception as e:  # noqa: BLE001
                issues.append((name, step.__name__, ERROR, None, 1, None, f"validator failed: {e}"))
        try:
            issues += self.rule_issues(df, name, self.row_rules(df))
        except Exception as e:  # noqa: BLE001
            issues.append((name, "row_rules", ERROR, None, 1, None, f"validator failed: {e}"))
        report = self.spark.createDataFrame(issues, ISSUE_SCHEMA)
        for fn in custom:
            try:
                report = report.unionByName(fn(df))
            except Exception as e:  # noqa: BLE001
                report = report.unionByName(self.spark.createDataFrame(
                    [(name, "custom", ERROR, None, 1, None, f"custom validator failed: {e}")], ISSUE_SCHEMA))
        return report


def template_config(df: DataFrame, id_col: str | None = None, max_missing_share: float = 0.5) -> ValidationConfig:
    """A starting configuration derived from the schema alone (V13): every
    current column required, its type class expected, the id column unique
    and not NULL."""
    cfg = ValidationConfig(required_columns=list(df.columns),
                           dtypes={f.name: _kind(f.dataType) for f in df.schema.fields},
                           max_missing_share=max_missing_share)
    if id_col:
        cfg.unique = [[id_col]]
        cfg.not_null = [id_col]
    return cfg


def quick_validate(spark: SparkSession, df: DataFrame, id_col: str, name: str = "dataset") -> DataFrame:
    """Validate with :func:`template_config`."""
    return Validator(spark, id_col, template_config(df, id_col)).validate(df, name)


def summary(report: DataFrame) -> DataFrame:
    """Issue counts by severity."""
    return report.groupBy("severity").agg(F.count(F.lit(1)).alias("n_issues"),
                                          F.sum("n_violations").alias("n_violations"))

