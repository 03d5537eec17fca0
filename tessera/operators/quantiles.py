"""Exact grouped quantiles by narrowing, not by sort and not by value maps.

Spark's exact ``percentile`` keeps a map of every distinct value per group and
merges it in one reducer task per group.  Here a group starts with its count,
least and greatest value.  While the bracket that holds a wanted rank has more
than ``EXACT`` rows, its rows are counted in ``BINS`` equal bins (combined
map-side, so a group with a third of the data costs its bins in the shuffle);
the bin that holds the rank is the next bracket, from its least to its greatest
value.  Bins nest, so a row is in one bracket of its group at most and is counted
once for all quantiles.  What is left of a bracket, ``EXACT`` rows at most, is
put in order inside one row.  Nothing is sorted as a whole, and no window or
task sees more than the bins of a bracket or ``EXACT`` values.

Several columns or groupings (:func:`long_quantiles`) are counted on whole Arrow
batches, column by column, so a value costs no row of its own and a group no
aggregate buffer (:class:`_Columns`); the rounds and the result are the same.

The result is the linear interpolation of ranks ``floor(p(n-1))`` and
``ceil(p(n-1))``: the definition of numpy, Spark ``percentile`` and DuckDB
``quantile_cont``.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, StatsTable, fit_table, keep_cached

#: bins of a round; rows of a bracket that are ordered in one row
BINS, EXACT = 4096, 100_000
#: rows looked at together, bins a task counts in at once, and brackets that are told to every task
CHUNK, CELLS, TOLD = 1 << 16, 1 << 17, 50_000


def _in_bracket(keys: list[str]) -> Column:
    on = (F.col("_bq_v") >= F.col("_bq_lo")) & (F.col("_bq_v") <= F.col("_bq_hi"))
    for i, c in enumerate(keys):
        on = on & F.col(c).eqNullSafe(F.col(f"_bq_k{i}"))
    return on


def _magnitude(v: Column) -> Column:
    """A scale of all doubles, zero in the middle, on which ratios are equal steps."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log(F.abs(v)) + 750.0))  # log of the least double: -744.4


def _bin(first: bool) -> Column:
    """Place of a value among the bins of its bracket, never falling as the
    value grows: by value in the first round; then by magnitude while the
    bracket's ends differ by a factor of 16 or in sign, else by value, so a
    handful of rounds ends for any values.  The ends have bins of their own:
    every round splits a bracket, also one with an infinite end."""
    v, lo, hi = F.col("_bq_v"), F.col("_bq_lo"), F.col("_bq_hi")
    near = F.lit(True) if first else (F.signum(lo) == F.signum(hi)) & (F.greatest(F.abs(lo), F.abs(hi)) / 16 <= F.least(F.abs(lo), F.abs(hi)))
    share = F.when(near, F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)).otherwise(
        F.try_divide(_magnitude(v) - _magnitude(lo), _magnitude(hi) - _magnitude(lo)))
    inner = F.greatest(F.lit(0), F.least(F.lit(BINS - 3), F.coalesce(F.floor(share * (BINS - 2)), F.lit(0)))) + 1
    return F.when(v == lo, 0).when(v == hi, BINS - 1).otherwise(inner)


def _wide() -> Column:
    return (F.col("_bq_c") > EXACT) & (F.col("_bq_lo") < F.col("_bq_hi"))


def _settle(brackets: DataFrame) -> tuple[StatsTable, bool]:
    """Fill the cache of ``brackets``; its measured table, and whether some are still wide."""
    brackets = keep_cached(brackets)
    total, wide = brackets.agg(F.count(F.lit(1)), F.count_if(_wide())).first()
    return StatsTable(brackets, total, ()), wide > 0


def _narrowed(rows: _Rows | _Columns, keys: list[str], wide: DataFrame, first: bool) -> DataFrame:
    """The brackets inside ``wide`` that hold its ranks."""
    counted = rows.counted(wide, first)
    group = [f"_bq_k{i}" for i in range(len(keys))]
    same = F.col("c._bq_lo") == F.col("w._bq_lo")
    for g in group:
        same = same & F.col(f"c.{g}").eqNullSafe(F.col(f"w.{g}"))
    counted = counted.alias("c").join(wide.alias("w"), same).select("c.*", "w._bq_n", "w._bq_below", "w._bq_ranks")
    before = F.sum("_bq_c").over(Window.partitionBy(*group, "_bq_lo").orderBy("_bq_b")) - F.col("_bq_c")  # over at most BINS rows
    placed = counted.withColumn("_bq_below", F.col("_bq_below") + before)
    ranks = F.filter("_bq_ranks", lambda r: (r >= F.col("_bq_below")) & (r < F.col("_bq_below") + F.col("_bq_c")))
    return (placed.withColumn("_bq_ranks", ranks).where(F.size("_bq_ranks") > 0)
            .select(*group, "_bq_n", F.col("_bq_mn").alias("_bq_lo"), F.col("_bq_mx").alias("_bq_hi"), "_bq_c", "_bq_below", "_bq_ranks"))


class _Rows:
    """Values in rows (keys, ``_bq_v``): what a round asks of them."""

    def __init__(self, d: DataFrame, keys: list[str]):
        self.d, self.keys = d, keys
        self.group = [f"_bq_k{i}" for i in range(len(keys))]

    def ends(self) -> DataFrame:
        """Count, least and greatest value of each group."""
        return (self.d.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_bq_n"), F.min("_bq_v").alias("_bq_lo"), F.max("_bq_v").alias("_bq_hi"))
                .select(*[F.col(c).alias(g) for c, g in zip(self.keys, self.group, strict=True)], "_bq_n", "_bq_lo", "_bq_hi"))

    def counted(self, wide: DataFrame, first: bool) -> DataFrame:
        """Count, least and greatest value of the bins of wide brackets."""
        # the list of ranks joins after the count: an array among the sums would make Spark sort the rows
        plain = wide.drop("_bq_ranks", "_bq_n", "_bq_below", "_bq_c")
        return (self.d.join(plain, _in_bracket(self.keys)).groupBy(*self.group, "_bq_lo", _bin(first).alias("_bq_b"))
                .agg(F.count(F.lit(1)).alias("_bq_c"), F.min("_bq_v").alias("_bq_mn"), F.max("_bq_v").alias("_bq_mx")))

    def ordered(self, several: DataFrame, small: bool) -> DataFrame:
        """The values of each bracket in order, beside what the bracket says."""
        return (self.d.join(F.broadcast(several) if small else several, _in_bracket(self.keys)).groupBy(*self.group, "_bq_n", "_bq_lo")
                .agg(F.sort_array(F.collect_list("_bq_v")).alias("_bq_x"), F.first("_bq_below").alias("_bq_below"),
                     F.first("_bq_ranks").alias("_bq_ranks")))


def _np_magnitude(v: np.ndarray) -> np.ndarray:
    return np.where(v == 0, 0.0, np.sign(v) * (np.log(np.abs(v)) + 750.0))


def _np_bin(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: bool, bins: int) -> np.ndarray:
    """:func:`_bin` on arrays."""
    with np.errstate(all="ignore"):
        share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
        if not first:
            a, b = np.abs(lo), np.abs(hi)
            far = ~((np.sign(lo) == np.sign(hi)) & (np.maximum(a, b) / 16 <= np.minimum(a, b)))
            if far.any():
                x, y, z = (_np_magnitude(w[far]) for w in (v, lo, hi))
                share[far] = (x - y) / (z - y)
        inner = np.clip(np.nan_to_num(np.floor(share * (bins - 2)), nan=0.0), 0, bins - 3).astype(np.int64) + 1
    return np.where(v == lo, 0, np.where(v == hi, bins - 1, inner))


class _Told:
    """Brackets by spec and key, as every task knows them: (key, lo, hi), a bracket's number is its place."""

    def __init__(self, rows: list):
        self.lo, self.hi = np.array([r[2] for r in rows], float), np.array([r[3] for r in rows], float)
        self.spec, self.key = [r[0] for r in rows], [r[1] for r in rows]
        self.by: dict[int, dict[str, list[int]]] = {}
        for i in np.argsort(self.lo, kind="stable").tolist():
            self.by.setdefault(self.spec[i], {}).setdefault(self.key[i], []).append(i)

    def hits(self, spec: int, v: np.ndarray, code: np.ndarray, names: list):
        """(places in v, numbers of their brackets); ``code`` gives a value's group, ``names`` the keys of the groups."""
        keys = self.by.get(spec)
        if not keys:
            return
        if len(names) == 1:  # brackets of a group do not overlap
            of = np.array(keys.get(names[0], ()), np.int64)
            if len(of):
                number = of[np.maximum(np.searchsorted(self.lo[of], v, "right") - 1, 0)]
                at = np.flatnonzero((v >= self.lo[number]) & (v <= self.hi[number]) & (code == 0))
                yield at, number[at]
            return
        held = [keys.get(n, ()) for n in names]
        for turn in range(max(map(len, held), default=0)):
            number = np.array([h[turn] if turn < len(h) else -1 for h in held] + [-1], np.int64)[code]
            at = np.flatnonzero(number >= 0)
            number, x = number[at], v[at]
            met = (x >= self.lo[number]) & (x <= self.hi[number])
            yield at[met], number[met]


class _Columns:
    """The same as :class:`_Rows` for specs (grouping columns, value column), keyed by
    ``_spec`` and ``_key``, on Arrow batches."""

    keys, group = ["_spec", "_key"], ["_bq_k0", "_bq_k1"]

    def __init__(self, df: DataFrame, specs: list[tuple[list[str], str]]):
        self.df, self.specs = df, specs
        groupings = list(dict.fromkeys(tuple(cols) for cols, _ in specs if cols))
        values = list(dict.fromkeys(v for _, v in specs))
        whole = []
        for cols in groupings:
            known = F.lit(True)
            for c in cols:
                known = known & F.col(c).isNotNull()
            whole.append(F.when(known, group_key(list(cols))).alias(f"g{len(whole)}"))
        self.plain = df.select(*[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)], *whole)
        #: place of a spec's values and of its groups among the columns; no place: one group of all rows
        self.places = [(values.index(v), len(values) + groupings.index(tuple(cols)) if cols else None) for cols, v in specs]

    def _run(self, make, ddl: str) -> DataFrame:
        """``make()`` gives (seen(spec, values, group of each value or -1, names of the groups), last()), both
        of which give lists of columns to be sent on, or None."""
        places = self.places
        from pyspark.sql.types import StructType
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(StructType.fromDDL(ddl))

        def run(batches):
            seen, last = make()

            def sent(cols):
                return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)],
                                                  schema=schema)

            def look(held):
                table = pa.Table.from_batches(held)
                groups = {None: (np.zeros(table.num_rows, np.int64), ["{}"])}
                for spec, (at, by) in enumerate(places):
                    if by not in groups:
                        coded = pc.dictionary_encode(table.column(by).combine_chunks())
                        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
                        groups[by] = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
                    v = table.column(at).to_numpy()
                    out = seen(spec, v, *groups[by])
                    if out is not None:
                        yield sent(out)

            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows >= CHUNK:
                    yield from look(held)
                    held, rows = [], 0
            if rows:
                yield from look(held)
            out = last()
            if out is not None:
                yield sent(out)

        return self.plain.mapInArrow(run, ddl)

    def ends(self) -> DataFrame:
        def seen(spec, v, code, names):
            if not names:
                return None
            if len(names) == 1 and not (code < 0).any():
                x, starts = v, np.zeros(1, np.int64)
                here = [0]
            else:
                order = np.argsort(code, kind="stable")
                order = order[np.searchsorted(code[order], 0):]
                x, c = v[order], code[order]
                starts = np.flatnonzero(np.append(True, c[1:] != c[:-1]))[:len(c)]
                here = c[starts].tolist()
            if not len(x):
                return None
            n = np.add.reduceat((~np.isnan(x)).astype(np.int64), starts)
            lo, hi = np.fmin.reduceat(x, starts), np.fmax.reduceat(x, starts)
            some = n > 0
            keys = [names[i] for i, s in zip(here, some, strict=True) if s]
            return [spec] * len(keys), keys, n[some], lo[some], hi[some]

        parts = self._run(lambda: (seen, lambda: None), "_bq_k0 int, _bq_k1 string, n long, lo double, hi double")
        return parts.groupBy(*self.group).agg(F.sum("n").alias("_bq_n"), F.min("lo").alias("_bq_lo"), F.max("hi").alias("_bq_hi"))

    def _told(self, brackets: DataFrame) -> _Told:
        return _Told([tuple(r) for r in brackets.select(*self.group, "_bq_lo", "_bq_hi").collect()])

    def counted(self, wide: DataFrame, first: bool) -> DataFrame:
        told = self._told(wide)  # a bracket that is wide holds over EXACT rows
        bins = max(16, min(BINS, CELLS // max(len(told.lo), 1)))

        def make():
            size = len(told.lo) * bins
            n, least, most = np.zeros(size, np.int64), np.full(size, np.inf), np.full(size, -np.inf)

            def seen(spec, v, code, names):
                for at, number in told.hits(spec, v, code, names):
                    x = v[at]
                    cell = number * bins + _np_bin(x, told.lo[number], told.hi[number], first, bins)
                    np.add.at(n, cell, 1)
                    np.minimum.at(least, cell, x)
                    np.maximum.at(most, cell, x)

            def last():
                at = np.flatnonzero(n)
                number = (at // bins).tolist()
                return ([told.spec[i] for i in number], [told.key[i] for i in number], told.lo[at // bins], at % bins, n[at], least[at], most[at])

            return seen, last

        parts = self._run(make, "_bq_k0 int, _bq_k1 string, _bq_lo double, _bq_b long, c long, mn double, mx double")
        return parts.groupBy(*self.group, "_bq_lo", "_bq_b").agg(F.sum("c").alias("_bq_c"), F.min("mn").alias("_bq_mn"), F.max("mx").alias("_bq_mx"))

    def ordered(self, several: DataFrame, small: bool) -> DataFrame:
        if not small or several.count() > TOLD:  # groups beyond number: rows meet them by a join
            return _Rows(_stacked(self.df, self.specs), self.keys).ordered(several, small)
        told = self._told(several)

        def seen(spec, v, code, names):
            found = list(told.hits(spec, v, code, names))
            number = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
            if not len(number):
                return None
            x = v[np.concatenate([f[0] for f in found])]
            order = np.argsort(number, kind="stable")
            number, x = number[order], x[order]
            starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            mine = number[starts]
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(x)).astype(np.int32)), pa.array(x))
            return [spec] * len(mine), [told.key[i] for i in mine.tolist()], told.lo[mine], lists

        parts = self._run(lambda: (seen, lambda: None), "_bq_k0 int, _bq_k1 string, _bq_lo double, x array<double>")
        whole = parts.groupBy(*self.group, "_bq_lo").agg(F.sort_array(F.flatten(F.collect_list("x"))).alias("_bq_x"))
        return whole.join(F.broadcast(several.select(*self.group, "_bq_n", "_bq_lo", "_bq_below", "_bq_ranks")), [*self.group, "_bq_lo"])


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                      names: list[str] | None = None, as_list: str | None = None) -> DataFrame:
    """One row per group (NULL and NaN values ignored) with one column per
    quantile, or with all of them in the array column ``as_list`` (for many)."""
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    if not keys:
        return grouped_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probs, names, as_list).drop("_all")
    d = df.select(*keys, F.col(value).cast("double").alias("_bq_v")).where(F.col("_bq_v").isNotNull() & ~F.isnan("_bq_v"))
    return _quantiles(_Rows(d, keys), probs, names, as_list)


def _quantiles(rows: _Rows | _Columns, probs: list[float], names: list[str], as_list: str | None) -> DataFrame:
    keys, group = rows.keys, rows.group
    places = F.transform(F.lit([float(p) for p in probs]), lambda p: p * (F.col("_bq_n") - 1))
    ranks = F.array_distinct(F.flatten(F.transform(places, lambda x: F.array(F.floor(x), F.ceil(x)))))
    table, more = _settle(rows.ends().withColumns({"_bq_c": F.col("_bq_n"), "_bq_below": F.lit(0).cast("long"), "_bq_ranks": ranks}))
    tables = [table]
    while more:  # rows meet brackets of a measured size: a broadcast below the bounds, else a shuffled join
        wide = table.df.where(_wide())
        table, more = _settle(_narrowed(rows, keys, F.broadcast(wide) if table.is_small() else wide, len(tables) == 1))
        tables.append(table)
    brackets = tables[0].df.where(~_wide())
    for t in tables[1:]:
        brackets = brackets.unionByName(t.df.where(~_wide()))
    small = sum(t.rows for t in tables) <= MAX_BROADCAST_ROWS and sum(t.est_bytes() for t in tables) <= MAX_BROADCAST_BYTES
    single = F.col("_bq_lo") == F.col("_bq_hi")
    ordered = rows.ordered(brackets.where(~single), small)
    pick = F.transform("_bq_ranks", lambda r: F.struct(r, F.element_at("_bq_x", (r - F.col("_bq_below") + 1).cast("int"))))
    same = F.transform("_bq_ranks", lambda r: F.struct(r, F.col("_bq_lo")))
    found = (ordered.select(*group, "_bq_n", pick.alias("_bq_at")).union(brackets.where(single).select(*group, "_bq_n", same.alias("_bq_at")))
             .groupBy(*group, "_bq_n").agg(F.map_from_entries(F.flatten(F.collect_list("_bq_at"))).alias("_bq_m")))

    def at(x: Column) -> Column:
        a, z = F.col("_bq_m")[F.floor(x)], F.col("_bq_m")[F.ceil(x)]
        return F.when(a == z, a).otherwise(a + (x - F.floor(x)) * (z - a))

    out = [F.col(g).alias(c) for c, g in zip(keys, group, strict=True)]
    if as_list:
        return found.select(*out, F.transform(places, at).alias(as_list))
    return found.select(*out, *[at(F.lit(float(p)) * (F.col("_bq_n") - 1)).alias(n) for p, n in zip(probs, names, strict=True)])


def group_key(cols: list[str]):
    """Text key of a group (JSON of the key columns), equal on both sides of
    a join when built with the same columns."""
    return F.to_json(F.struct(*[F.col(c) for c in cols])) if cols else F.lit("{}")


def _stacked(df: DataFrame, specs: list[tuple[list[str], str]]) -> DataFrame:
    """Rows (spec id, group key text, value), in one scan."""
    stacked = []
    for s_id, (cols, value) in enumerate(specs):
        whole = F.lit(True)
        for c in cols:
            whole = whole & F.col(c).isNotNull()
        stacked.append(F.struct(F.lit(s_id).alias("_spec"), group_key(cols).alias("_key"),
                                F.when(whole, F.col(value).cast("double")).alias("_bq_v")))
    long = df.select(F.inline(F.array(*stacked)))
    return long.where(F.col("_bq_v").isNotNull() & ~F.isnan("_bq_v"))


def long_quantiles(df: DataFrame, specs: list[tuple[list[str], str]], probs: list[float],
                   names: list[str] | None = None, as_list: str | None = None) -> DataFrame:
    """Quantiles for several (grouping columns, value column) specs in the same
    passes, one scan a pass; the result has ``_spec``, ``_key`` (group key text)
    and one column per quantile (or ``as_list``)."""
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    rows = _Columns(df, specs) if len(specs) > 1 else _Rows(_stacked(df, specs), ["_spec", "_key"])
    return _quantiles(rows, probs, names, as_list)


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Global exact quantiles of several columns in one ranking pass; the
    driver receives one small row per column."""
    if not cols:
        return {}
    rows = long_quantiles(df, [([], c) for c in cols], probs, as_list="_list").collect()
    got = {r["_spec"]: list(r["_list"]) for r in rows}
    return {c: got.get(i, [None] * len(probs)) for i, c in enumerate(cols)}


def attach_group_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                           names: list[str], source: DataFrame | None = None) -> DataFrame:
    """Join exact per-group quantiles of ``value`` (computed on ``source``,
    default ``df``) onto the rows of ``df``."""
    q = fit_table(grouped_quantiles(source if source is not None else df, keys, value, probs, names), keys)
    return df.join(q.joinable(), keys, "left")


def with_quantiles(agg_df: DataFrame, source: DataFrame, by: list[str], value: str, probs: list[float],
                   names: list[str]) -> DataFrame:
    """Add exact quantiles of ``source[value]`` per ``by`` group to an
    aggregate keyed by ``by`` (global literals when ``by`` is empty)."""
    by = list(by)
    if by:
        return agg_df.join(grouped_quantiles(source, by, value, probs, names), by, "left")
    vals = column_quantiles(source, [value], probs)[value]
    return agg_df.withColumns({n: F.lit(v).cast("double") for n, v in zip(names, vals)})
