"""Queries: the streaming drift monitor (extension)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.drift_stream import run_daily_drift
from .registry import register

_Q = ", ".join(str(i / 10) for i in range(11))


@register("stream_daily_drift", f"""
WITH s AS (SELECT min(ts) AS t0 FROM events),
base AS (SELECT value FROM events, s WHERE ts < t0 + INTERVAL 7 DAY AND value IS NOT NULL),
ed AS (SELECT list_sort(list_distinct(quantile_cont(value, [{_Q}]))) AS e FROM base),
binned AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
                  CASE WHEN value < e[1] OR value > e[len(e)] THEN NULL
                       ELSE least(len(list_filter(e, lambda x: x <= value)) - 1, len(e) - 2) END AS b
           FROM events, ed),
bb AS (SELECT CASE WHEN value < e[1] OR value > e[len(e)] THEN NULL
                   ELSE least(len(list_filter(e, lambda x: x <= value)) - 1, len(e) - 2) END AS b
       FROM base, ed),
bshare AS (SELECT b, count(*) / (SELECT count(*) FROM bb) AS es FROM bb WHERE b IS NOT NULL GROUP BY b),
days AS (SELECT day, count(*) AS n_day FROM binned GROUP BY day),
grid AS (SELECT day, n_day, unnest(range(0, (SELECT len(e) - 1 FROM ed))) AS b FROM days),
c AS (SELECT day, b, count(*) AS n FROM binned WHERE b IS NOT NULL GROUP BY day, b),
j AS (SELECT g.day, g.n_day, coalesce(c.n, 0) / g.n_day AS a, coalesce(bs.es, 0) AS es
      FROM grid g LEFT JOIN c ON g.day = c.day AND g.b = c.b LEFT JOIN bshare bs ON g.b = bs.b)
SELECT day, CAST(max(n_day) AS BIGINT) AS n_events,
       round(abs(sum((CASE WHEN a = 0 THEN 1e-4 ELSE a END - CASE WHEN es = 0 THEN 1e-4 ELSE es END)
                 * ln(CASE WHEN a = 0 THEN 1e-4 ELSE a END / CASE WHEN es = 0 THEN 1e-4 ELSE es END))), 8) AS psi
FROM j GROUP BY day""")
def q_stream_daily_drift(spark, sf_dir):
    """Extension: ``events`` as a file stream, 1-day tumbling windows with a
    watermark, PSI of ``value`` per day against a batch baseline (first 7
    days), written by ``foreachBatch``."""
    out = run_daily_drift(spark, sf_dir)
    return out.select("day", "n_events", F.round("psi", 8).alias("psi"))
