"""Queries: data-quality reports over the text tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.validate import ValidationConfig, Validator, summary
from ..sources.tables import table
from .registry import register

REPORT_COLS = ["dataset", "check_name", "severity", "column", "n_violations", "sample_ids"]


def _report(df):
    return df.withColumnRenamed("check", "check_name").select(*REPORT_COLS)


def conversations_report(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").withColumn("row_id", F.col("conv_id") * 1000 + F.col("turn"))
    cfg = ValidationConfig(required_columns=["conv_id", "turn", "role", "text", "speaker"],
                           dtypes={"turn": "numeric", "role": "string"},
                           ranges={"turn": (0, 5)}, unique=[["conv_id", "turn"], ["conv_id", "role"]],
                           patterns={"role": "user|assistant"}, max_missing_share=0.5)
    return Validator(spark, "row_id", cfg).validate(conv, "conversations")


_SAMPLE = "(SELECT string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) FROM (SELECT row_id FROM c WHERE {cond} ORDER BY row_id LIMIT 10))"

CONV_SQL = f"""
WITH c AS (SELECT conv_id * 1000 + turn AS row_id, * FROM conversations),
d AS (SELECT conv_id, role, min(row_id) AS first_id FROM c GROUP BY conv_id, role HAVING count(*) > 1),
later AS (SELECT c.row_id FROM c JOIN d USING (conv_id, role) WHERE c.row_id > d.first_id)
SELECT 'conversations' AS dataset, 'schema' AS check_name, 'CRITICAL' AS severity, NULL AS "column",
       CAST(1 AS BIGINT) AS n_violations, NULL AS sample_ids
UNION ALL
SELECT 'conversations', 'ranges', 'ERROR', 'turn', count(*), {_SAMPLE.format(cond="turn < 0 OR turn > 5")}
FROM c WHERE turn < 0 OR turn > 5 HAVING count(*) > 0
UNION ALL
SELECT 'conversations', 'patterns', 'WARNING', 'role', count(*),
       {_SAMPLE.format(cond="role IS NOT NULL AND NOT regexp_matches(role, '^(?:user|assistant)')")}
FROM c WHERE role IS NOT NULL AND NOT regexp_matches(role, '^(?:user|assistant)') HAVING count(*) > 0
UNION ALL
SELECT 'conversations', 'uniqueness', 'ERROR', 'conv_id+role', count(*),
       (SELECT string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) FROM (SELECT row_id FROM later ORDER BY row_id LIMIT 10))
FROM later HAVING count(*) > 0
"""


@register("validate_conversations", CONV_SQL)
def q_validate_conversations(spark, sf_dir):
    """V1 schema (missing column = CRITICAL), V4 ranges, V5 composite-key
    uniqueness (ids of 2nd+ occurrences), V6 patterns; first 10 ids (S6)."""
    return _report(conversations_report(spark, sf_dir))


def documents_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cfg = ValidationConfig(patterns={"lang": "en|fr|de"}, ranges={"n_chars": (10, 30000)},
                           consistency=[("n_chars_matches_text", "n_chars = length(text)"),
                                        ("short_document", "n_chars < 20000")],
                           integer_columns=["n_chars"], iqr_share_limit=0.05)
    return Validator(spark, "doc_id", cfg).validate(docs, "documents")


_DS = "(SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FROM (SELECT doc_id FROM documents WHERE {cond} ORDER BY doc_id LIMIT 10))"

DOCS_SQL = f"""
WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3, count(*) AS n FROM documents),
o AS (SELECT count(*) AS k FROM documents, q WHERE n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1))
SELECT 'documents' AS dataset, 'outliers' AS check_name, 'WARNING' AS severity, 'n_chars' AS "column",
       o.k AS n_violations, NULL AS sample_ids FROM o, q WHERE q.n >= 10 AND o.k / q.n > 0.05
UNION ALL
SELECT 'documents', 'ranges', 'ERROR', 'n_chars', count(*), {_DS.format(cond="n_chars < 10 OR n_chars > 30000")}
FROM documents WHERE n_chars < 10 OR n_chars > 30000 HAVING count(*) > 0
UNION ALL
SELECT 'documents', 'patterns', 'WARNING', 'lang', count(*),
       {_DS.format(cond="lang IS NOT NULL AND NOT regexp_matches(lang, '^(?:en|fr|de)')")}
FROM documents WHERE lang IS NOT NULL AND NOT regexp_matches(lang, '^(?:en|fr|de)') HAVING count(*) > 0
UNION ALL
SELECT 'documents', 'consistency', 'ERROR', 'n_chars_matches_text', count(*),
       {_DS.format(cond="NOT coalesce(n_chars = length(text), false)")}
FROM documents WHERE NOT coalesce(n_chars = length(text), false) HAVING count(*) > 0
UNION ALL
SELECT 'documents', 'consistency', 'ERROR', 'short_document', count(*),
       {_DS.format(cond="NOT coalesce(n_chars < 20000, false)")}
FROM documents WHERE NOT coalesce(n_chars < 20000, false) HAVING count(*) > 0
"""


@register("validate_documents", DOCS_SQL)
def q_validate_documents(spark, sf_dir):
    """V3 integer check, V4 ranges, V6 patterns, V7 row consistency, V9 IQR
    outlier share over numeric columns (one unpivot + grouped percentile)."""
    return _report(documents_report(spark, sf_dir))


@register("validate_labels_fk", """
SELECT 'labels' AS dataset, 'referential_integrity' AS check_name, 'ERROR' AS severity, 'doc_id' AS "column",
       count(*) AS n_violations,
       (SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FROM (
          SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'en')
          ORDER BY doc_id LIMIT 10)) AS sample_ids
FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'en') HAVING count(*) > 0
UNION ALL
SELECT 'labels', 'ranges', 'ERROR', 'quality', count(*), NULL FROM labels WHERE quality < 0 OR quality > 1
HAVING count(*) > 0
UNION ALL
SELECT 'labels', 'outliers', 'WARNING', f, k, NULL FROM (
  SELECT 'quality' AS f, count(*) FILTER (WHERE quality < q1 - 1.5 * (q3 - q1) OR quality > q3 + 1.5 * (q3 - q1)) AS k, count(*) AS n
  FROM labels, (SELECT quantile_cont(quality, 0.25) AS q1, quantile_cont(quality, 0.75) AS q3 FROM labels)
  UNION ALL
  SELECT 'toxic', count(*) FILTER (WHERE toxic < q1 - 1.5 * (q3 - q1) OR toxic > q3 + 1.5 * (q3 - q1)), count(*)
  FROM labels, (SELECT quantile_cont(toxic, 0.25) AS q1, quantile_cont(toxic, 0.75) AS q3 FROM labels))
WHERE n >= 10 AND k / n > 0.05""")
def q_validate_labels_fk(spark, sf_dir):
    """V11 foreign keys: labels must point at non-English documents (a parent
    table given as a DataFrame, checked with a left anti join)."""
    labels = table(spark, sf_dir, "labels")
    parent = table(spark, sf_dir, "documents").where(F.col("lang") != "en")
    cfg = ValidationConfig(foreign_keys={"doc_id": (parent, "doc_id")}, ranges={"quality": (0, 1)})
    rep = Validator(spark, "doc_id", cfg).validate(labels, "labels")
    return _report(rep)


@register("validation_summary")
def q_validation_summary(spark, sf_dir):
    """Issue counts by severity over all reports (V14: a custom
    validator -- empty texts -- joins the documents report)."""
    docs = table(spark, sf_dir, "documents")

    def empty_texts(df):
        n = df.where(F.length("text") == 0).count()
        return spark.createDataFrame([("documents", "custom_empty_text", "WARNING", "text", n, None, "empty texts")]
                                     if n else [], "dataset string, check string, severity string, column string, "
                                     "n_violations long, sample_ids string, message string")
    cfg = ValidationConfig(patterns={"lang": "en|fr|de"})
    rep = Validator(spark, "doc_id", cfg).validate(docs, "documents", custom=[empty_texts])
    rep = rep.unionByName(conversations_report(spark, sf_dir))
    return summary(rep)
