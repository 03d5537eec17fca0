"""Fitted statistics tables and the joins that attach them.

A fit produces a small DataFrame (one row per group).  It is cached and
counted once, so its size is *known* before we decide how to join it: when
both its row count and its materialised bytes are under the bounds it is broadcast, otherwise the join is left to
a shuffle join (and AQE may still convert it at runtime from the real
materialised size).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20

_CACHED: list[DataFrame] = []


def keep_cached(df: DataFrame) -> DataFrame:
    """Cache a statistics frame until :func:`release_caches`."""
    df = df.cache()
    _CACHED.append(df)
    return df


def release_caches() -> int:
    """Unpersist every statistics frame cached so far; how many there were.

    Call it when the results built on them are written: frames that are still
    used are computed again, nothing breaks."""
    n = len(_CACHED)
    while _CACHED:
        _CACHED.pop().unpersist()
    return n


@dataclass
class StatsTable:
    """A materialised statistics table with a known row count."""

    df: DataFrame
    rows: int
    keys: tuple

    def est_bytes(self) -> int:
        """Size of the cached table as Spark measured it when it was filled."""
        return int(str(self.df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    def is_small(self, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
        return self.rows <= max_rows and self.est_bytes() <= MAX_BROADCAST_BYTES

    def joinable(self, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
        return F.broadcast(self.df) if self.is_small(max_rows) else self.df


def fit_table(df: DataFrame, keys, drop_null_keys: bool = True) -> StatsTable:
    """Cache and count a fitted statistics frame.

    Rows whose group key is NULL are removed (a NULL group never matches in
    an equi-join, so it would only take space).
    """
    keys = tuple([keys] if isinstance(keys, str) else keys)
    if drop_null_keys and keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    df = keep_cached(df)
    return StatsTable(df, df.count(), keys)


def attach(df: DataFrame, stats: StatsTable, how: str = "left",
           max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left-join fitted statistics onto rows by the table's keys."""
    return df.join(stats.joinable(max_rows), list(stats.keys), how)
