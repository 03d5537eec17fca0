"""Quality scores: ridge regression on random Fourier features.

Every document becomes ``len(FEATURES)`` statistics of its whole text (shares
of letter classes, word and line lengths, repetition).  Standardised, they are
mapped to ``DIMENSIONS`` random Fourier features, whose inner products
approximate a Gaussian kernel.  Each task sums the normal equations of its
rows; the sums meet by matrix block, first within buckets of tasks, then once
more, and only the finished matrix (fixed size) reaches the driver.  Scores of
labelled rows that took no part in the fit, counted in ``BINS`` bins, give the
isotonic calibration.

All labelled rows take part (no sample).  Defined cases: NULL or empty text
has all statistics 0 and is scored like any other; several labels of one id
count as their mean; NULL labels count as none; without any usable label every
score is 0.5; repeated rows give one row each; NULL ids are kept and are never
held out; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _SPACE, arrow_schema, as_batch, cut, map_batches, one, slices, text_bytes, text_of, words_of

DIMENSIONS = 256
BANDWIDTH = 1.0  # of the kernel, in units of sqrt(number of features)
RIDGE = 1e-3  # per training row
BINS = 1000
LOW, HIGH = -0.5, 1.5  # range of the bins; scores beyond fall in the outer ones
SEED = 20240
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 4
BLOCKS, BUCKETS = 8, 64

FEATURES = ("log_bytes", "log_words", "upper", "digit", "symbol", "stop_mark", "comma", "bang", "other_byte", "newline",
            "word_len", "word_len_sd", "short_words", "long_words", "caps_words", "symbol_words", "title_words",
            "distinct_words", "top_word", "repeat_pairs", "words_per_line", "repeat_lines", "short_lines", "words_per_stop")

_CLASS = np.full(256, 8, np.int8)  # other bytes of UTF-8
_CLASS[:128] = 4
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[ord(c) for c in ".?"]] = 5
_CLASS[[ord(c) for c in ",;:'-\""]] = 6
_CLASS[ord("!")] = 7
_CLASS[_SPACE] = 3
_CLASS[10] = 9


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over [at[i], at[i+1])."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[at[1:]] - total[at[:-1]]


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text: distinct keys, and the count of the most frequent one."""
    distinct, top = np.zeros(n), np.zeros(n)
    if len(keys):
        order = np.lexsort((keys, owner))
        k, o = keys[order], owner[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(k)))
        np.add.at(distinct, o[begin], 1)
        np.maximum.at(top, o[begin], size)
    return distinct, top


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    raw, at = text_bytes(texts)
    n = len(at) - 1
    if not len(raw):
        return np.zeros((n, len(FEATURES)))
    kind = _CLASS[raw]
    size = np.diff(at).astype(float)
    count = {c: _per_text(kind == c, at) for c in (1, 2, 4, 5, 6, 7, 8, 9)}
    hashes, start, end, first = words_of(raw, at, lower=False)
    words = np.diff(first).astype(float)
    owner = np.repeat(np.arange(n), np.diff(first))
    length = (end - start).astype(float)
    total = np.concatenate(([0], np.cumsum((kind == 1) | (kind == 2))))
    upper = (total[end] - total[start]) / np.maximum(length, 1)
    total = np.concatenate(([0], np.cumsum((kind == 4) | (kind == 7))))
    symbols = total[end] - total[start]

    def share(flag):
        return _per_text(flag, first) / np.maximum(words, 1)

    mean = _per_text(length, first) / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(_per_text(length ** 2, first) / np.maximum(words, 1) - mean ** 2, 0))
    distinct, top = _repeats(hashes, owner, n)
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:]
    inside = owner[:-1] == owner[1:]
    pair_kinds, _ = _repeats(pairs[inside], owner[:-1][inside], n)
    # lines: runs of words between newlines, as sums of their words' hashes
    breaks = np.concatenate(([0], np.cumsum(kind == 9)))
    line = breaks[start] + owner  # texts follow one another without a newline
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    begin = np.flatnonzero(new)
    line_owner = owner[begin]
    line_words = np.diff(np.append(begin, len(line)))
    position = np.arange(len(line)) - np.repeat(begin, line_words)
    line_key = np.add.reduceat(hashes * (position.astype(np.uint64) * np.uint64(2) + np.uint64(1)), begin) if len(begin) else hashes[:0]
    lines = np.bincount(line_owner, minlength=n).astype(float)
    line_kinds, _ = _repeats(line_key, line_owner, n)
    short = np.bincount(line_owner, weights=line_words <= 3, minlength=n)
    per = np.maximum(size, 1)
    some, at_least = np.maximum(words, 1), np.maximum(lines, 1)
    columns = [np.log1p(size), np.log1p(words), count[1] / per, count[2] / per, count[4] / per, count[5] / some, count[6] / some,
               count[7] / some, count[8] / per, count[9] / some, np.minimum(mean, 40), np.minimum(spread, 40), share(length <= 3),
               share(length >= 15), share((upper > 0.6) & (length > 1)), share(symbols > 0), share((upper > 0) & (upper <= 0.6)),
               distinct / some, top / some, np.where(words > 1, 1 - pair_kinds / np.maximum(words - 1, 1), 0),
               np.log1p(words / at_least), np.where(lines > 0, 1 - line_kinds / at_least, 0), short / at_least,
               np.log1p(words / (count[5] + 1))]
    return np.nan_to_num(np.stack(columns, 1))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None  # of the random features and a constant
    edges: np.ndarray  # calibration: raw scores ...
    levels: np.ndarray  # ... and calibrated ones between which it interpolates

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.edges, self.levels), 0, 1)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(size=(x.shape[1], DIMENSIONS)) / (BANDWIDTH * np.sqrt(x.shape[1]))
    b = rng.uniform(0, 2 * np.pi, DIMENSIONS)
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.cos(z @ w + b) * np.sqrt(2 / DIMENSIONS), np.ones((len(x), 1))])


def isotonic(at: np.ndarray, weight: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and levels of the blocks."""
    blocks: list[list[float]] = []
    for a, w, g in zip(at, weight, good, strict=True):
        blocks.append([a * w, w, g])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([(b[2] + 0.5) / (b[1] + 1) for b in blocks])


def remainder(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats array<double>) per row, written once to the shared folder."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    id_type = rows.schema["id"].dataType.simpleString()

    def make():
        def fn(batch):
            x = np.concatenate([statistics(part) for part in slices(batch.column(1))])
            flat = pa.array(x.ravel())
            return {"id": one(batch.column(0)), "stats": pa.ListArray.from_arrays(
                pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), flat)}
        return fn

    return cut(map_batches(rows, f"id {id_type}, stats array<double>", make), "quality-stats")


def matrix(column) -> np.ndarray:
    return np.asarray(one(column).flatten()).reshape(-1, len(FEATURES))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fit on labelled rows that are not held out."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).where("y is not null")
             .groupBy("id").agg(F.avg("y").alias("y")))
    train = cut(stats.join(marks, "id").withColumn("fold", remainder("id"))
                .where(F.col("fold") != HELD_OUT).select("fold", "y", "stats"), "quality-train")
    d = len(FEATURES)
    row = train.agg(F.count("*").alias("n"), *[f(F.col("stats")[i]).alias(f"{k}{i}") for i in range(d)
                                                for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    zero = np.zeros(1)
    if not row.n:
        return Model(zero, zero, None, zero, zero)
    mean, scale = (np.array([row[f"{k}{i}"] for i in range(d)]) for k in "ms")
    scale = np.where(scale > 1e-9, scale, 1)
    size = DIMENSIONS + 1
    ddl = "block int, bucket int, part binary"
    schema = arrow_schema(ddl)

    def sums(batches):
        from pyspark import TaskContext
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z, y = fourier(matrix(batch.column(1)), mean, scale), np.asarray(one(batch.column(0)))
                total += z.T @ np.hstack([z, y[:, None]])
        bucket = TaskContext.get().partitionId() % BUCKETS
        yield as_batch({"block": list(range(BLOCKS)), "bucket": [bucket] * BLOCKS,
                        "part": [p.tobytes() for p in np.array_split(total, BLOCKS)]}, schema)

    def add(pdf):
        out = pdf.iloc[:1].copy()
        out["part"] = [sum(np.frombuffer(p) for p in pdf["part"]).tobytes()]
        return out

    def solve(rows: DataFrame) -> np.ndarray:
        parts = rows.select("y", "stats").mapInArrow(sums, ddl).groupBy("block", "bucket").applyInPandas(add, ddl)
        parts = {r.block: np.frombuffer(r.part) for r in parts.groupBy("block").applyInPandas(add, ddl).collect()}
        total = np.concatenate([parts[i] for i in range(BLOCKS)]).reshape(size, size + 1)
        penalty = np.eye(size) * RIDGE * max(total[-1, size - 1], 1)
        penalty[-1, -1] = 1e-9
        return np.linalg.solve(total[:, :size] + penalty, total[:, size])

    def binned(model: Model) -> list:
        def make():
            def fn(batch):
                raw = model.raw(matrix(batch.column(1)))
                return {"bin": np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32), "y": one(batch.column(0))}
            return fn
        scored = map_batches(train.where(F.col("fold") == CALIBRATE).select("y", "stats"), "bin int, y double", make)
        return scored.groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("good")).orderBy("bin").collect()

    first = Model(mean, scale, solve(train.where(F.col("fold") != CALIBRATE)), zero, zero)
    bins = binned(first)
    if not bins:  # no row to calibrate on: the raw score, clipped
        return Model(mean, scale, solve(train), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    at = np.array([(r.bin + 0.5) / BINS * (HIGH - LOW) + LOW for r in bins])
    edges, levels = isotonic(at, np.array([r.n for r in bins], float), np.array([r.good for r in bins], float))
    return Model(mean, scale, first.weights, edges, levels)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    stats = features(docs, id_col, text_col)
    model = fit(stats, labels, id_col, label_col)
    id_type = stats.schema["id"].dataType.simpleString()

    def make():
        def fn(batch):
            return {"id": one(batch.column(0)), "score": model.score(matrix(batch.column(1)))}
        return fn

    scored = map_batches(stats, f"id {id_type}, score double", make)
    return scored.select(F.col("id").alias(id_col), F.coalesce(remainder("id") == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold.

    The model is fixed size, so the second pass over the texts scores and
    filters in place: no shuffle.
    """
    model = fit(features(docs, id_col, text_col), labels, id_col, label_col)
    cols = docs.columns
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)], text_of(text_col).alias("t"))
    ddl = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(cols)))

    def make():
        def fn(batch):
            x = np.concatenate([statistics(part) for part in slices(batch.column(len(cols)))])
            take = pa.array(np.flatnonzero(model.score(x) >= threshold))
            return {f"k{i}": one(batch.column(i)).take(take) for i in range(len(cols))}
        return fn

    return map_batches(rows, ddl, make).toDF(*cols)
