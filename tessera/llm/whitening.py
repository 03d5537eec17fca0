"""Whitening of embeddings with every distinct vector handled once.

Rows are grouped by their integer vector x; each distinct vector carries its
multiplicity.  The fit weighs a vector by its count or by one, multiplies
centred blocks of vectors with themselves inside tasks and adds the products;
the eigenvectors of the sum whiten every distinct vector once, and rows get
their vector's result by a join.

Memory and shuffles: a task holds a block of BLOCK vectors and one d x d sum;
only those sums, of a size that d fixes, reach the driver.  A vector that holds
a third of all rows is counted map-side.  In the join back, vectors with over
1/HOT_SHARE of the rows - fewer than HOT_SHARE by definition - are broadcast,
all others are joined by shuffle.

Defined results: NULL vectors and vectors with a NULL, NaN or infinite entry
are left out, and so are vectors whose length is not the most frequent one (the
longer on a tie; vectors without entries never count).  Entries beyond
+-2^52 / SCALE count as that bound.  NULL ids are kept; repeated rows give
repeated results; equal vectors get equal results.  Components whose eigenvalue
is zero to rounding (RANK of the largest) have no whitened coordinate and give
no rows, so a fit list of one vector gives none.  ``deviation`` is exact; it is
NULL where it does not fit a long.  An empty table gives no rows.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_parts, arrow_schema, as_batch, cut, map_batches, one

#: fixed by the contract: x = floor(64 c) + 1000000, components returned
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: vectors multiplied at a time
BLOCK = 4096
#: a vector with over 1/HOT_SHARE of the rows is joined by broadcast
HOT_SHARE = 512
#: tasks meet in so many buckets before their sums meet
BUCKETS = 64
#: an eigenvalue counts as zero below this share of the largest
RANK = 1e-12


# ------------------------------------------------------------------ vectors
def pack(x: np.ndarray) -> list[bytes]:
    """int64 rows as bytes: four a value where the whole row fits, else eight."""
    small = (np.abs(x) < 2**31).all(axis=1)
    narrow = x.astype("<i4") if small.any() else x
    return [(b"\4" + narrow[i].tobytes()) if small[i] else (b"\x08" + x[i].astype("<i8").tobytes()) for i in range(len(x))]


def unpack(keys: list[bytes], d: int) -> np.ndarray:
    out = np.empty((len(keys), d), np.int64)
    for i, k in enumerate(keys):
        out[i] = np.frombuffer(k, "<i4" if k[0] == 4 else "<i8", offset=1)
    return out


def integer_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dims, x) of the rows whose vector is whole and finite; x as bytes."""
    kind = rows.schema[key].dataType.simpleString()
    ddl = f"id {kind}, dims int, x binary"
    bound = 2.0**52

    def make():
        def run(batch: pa.RecordBatch) -> dict | None:
            ids, vectors = one(batch.column(0)), one(batch.column(1))
            sizes = vectors.value_lengths().fill_null(0).to_numpy()
            flat = vectors.flatten().cast(pa.float64())
            values = flat.fill_null(math.nan).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            keep = (sizes > 0) & (bad[ends] == bad[ends - sizes])
            places, keys, dims = [], [], []
            for d in np.unique(sizes[keep]):
                at = np.flatnonzero(keep & (sizes == d))
                c = values[(ends[at] - d)[:, None] + np.arange(d)]
                x = np.floor(np.clip(SCALE * c, -bound, bound)).astype(np.int64) + SHIFT
                places.append(at)
                keys += pack(x)
                dims += [int(d)] * len(at)
            if not places:
                return None
            return {"id": ids.take(pa.array(np.concatenate(places))), "dims": pa.array(dims, pa.int32()), "x": pa.array(keys, pa.binary())}
        return run

    # list entries in one buffer: an Arrow list array of doubles, NULL entries kept as NULL
    return map_batches(rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")), ddl, make)


# --------------------------------------------------------------------- sums
def exact_sums(distinct: DataFrame, d: int, by_count: bool) -> tuple[int, list[int]]:
    """Weight and per-dimension sums over the fit list as Python integers.

    Values are split into high and low halves, so that partial sums of 2^31
    vectors still fit 64 bits; parts of tasks are added on the way.
    """
    ddl = "dim int, total decimal(38,0)"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = [0] * d, [0] * d, 0
        for batch in batches:
            x = unpack(batch.column(0).to_pylist(), d)
            w = np.asarray(batch.column(1).to_numpy() if by_count else np.ones(len(x), np.int64), np.int64)
            n += int(w.sum())
            for lo in range(0, len(x), BLOCK):
                part, weight = x[lo:lo + BLOCK], w[lo:lo + BLOCK].astype(object)
                if by_count:
                    sums = [int(s) for s in (part.astype(object) * weight[:, None]).sum(axis=0)]
                    low = [a + s for a, s in zip(low, sums, strict=True)]
                else:
                    high = [a + int(s) for a, s in zip(high, (part >> 26).sum(axis=0), strict=True)]
                    low = [a + int(s) for a, s in zip(low, (part & (2**26 - 1)).sum(axis=0), strict=True)]
        totals = [n, *[(h << 26) + v for h, v in zip(high, low, strict=True)]]
        yield as_batch({"dim": list(range(d + 1)), "total": [Decimal(t) for t in totals]}, schema)

    parts = distinct.select("x", "copies").mapInArrow(run, ddl)
    sums = {r.dim: int(r.total) for r in parts.groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    return sums.get(0, 0), [sums.get(i + 1, 0) for i in range(d)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n: the whole part of the mean is taken off as integers."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of (n x - S)^2 of every row; None beyond a long."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    y = x - whole
    size = float(np.abs(y).max(initial=0) + 1) * n
    if size < 3e9 and size * size * x.shape[1] < 9e18:
        return ((n * y - rest) ** 2).sum(axis=1).tolist()
    exact = ((y.astype(object) * n - rest.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


def products(rows: DataFrame, columns: list[str], values: Callable, d: int) -> np.ndarray:
    """The sum over all rows of w v v^T, in blocks, added task by task; ``values`` gives (v, w) of a batch."""
    schema = arrow_schema("block int, bucket int, part binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.zeros((d, d))
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                v, w = values(batch.slice(lo, BLOCK))
                total += (v * w[:, None]).T @ v
        yield as_batch({"block": [0], "bucket": [TaskContext.get().partitionId() % BUCKETS], "part": [total.tobytes()]}, schema)

    found = add_parts(rows.select(*columns).mapInArrow(run, "block int, bucket int, part binary"), 1)
    return found.reshape(d, d) if len(found) else np.zeros((d, d))


# -------------------------------------------------------------------- whiten
def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           weights: str = "one") -> DataFrame:
    """(key, n, deviation, whitened array, explained array, identity_error) of every row.

    ``weights``: ``one`` (each distinct vector once) or ``count`` (as often as
    it occurs) as fit weights.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights is 'one' or 'count'")
    by_count = weights == "count"
    spark, kind = rows.sparkSession, rows.schema[key].dataType.simpleString()
    vectors = cut(integer_vectors(rows, key, vector), "whiten-rows")
    # how often each length occurs: one row a length
    modal = vectors.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    out = f"{key} {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if modal is None:
        return spark.createDataFrame([], out)
    d, total = modal["dims"], modal["count"]
    vectors = vectors.where(F.col("dims") == d).select("id", "x")
    distinct = cut(vectors.groupBy("x").agg(F.count("*").alias("copies")), "whiten-distinct")

    n, sums = exact_sums(distinct, d, by_count)

    def centred_block(batch):
        x = unpack(batch.column(0).to_pylist(), d)
        w = batch.column(1).to_numpy().astype(float) if by_count else np.ones(len(x))
        return centred(x, n, sums), w

    covariance = products(distinct, ["x", "copies"], centred_block, d) / n
    e, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-e, kind="stable")
    trace = float(np.trace(covariance))
    used = [int(i) for i in order[:components] if e[i] > RANK * e[order[0]] and e[i] > 0]
    if not used:
        return spark.createDataFrame([], out)
    scaled = directions[:, used] / np.sqrt(e[used])
    explained = [float(v) / trace for v in e[used]]

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            x = unpack(batch.column(0).to_pylist(), d)
            return {"x": batch.column(0), "copies": batch.column(1), "deviation": pa.array(deviations(x, n, sums), pa.int64()),
                    "whitened": pa.array(list(centred(x, n, sums) @ scaled), pa.list_(pa.float64()))}
        return run

    once = cut(map_batches(distinct, "x binary, copies long, deviation long, whitened array<double>", make), "whiten-once")

    def whitened_block(batch):
        w = one(batch.column(0)).flatten().to_numpy().reshape(batch.num_rows, len(used))
        return w, batch.column(1).to_numpy().astype(float) if by_count else np.ones(len(w))

    # the mean of the whitened vectors is zero but for rounding: centred before, as V was
    identity = products(once, ["whitened", "copies"], whitened_block, len(used)) / n
    error = float(np.abs(identity - np.eye(len(used))).max())

    hot = once.where(F.col("copies") * HOT_SHARE > F.lit(total)).select("x", "deviation", "whitened")
    near = vectors.join(F.broadcast(hot), "x").select("id", "deviation", "whitened")  # fewer than HOT_SHARE rows
    rest = (vectors.join(F.broadcast(hot.select("x")), "x", "left_anti")
            .join(once.where(F.col("copies") * HOT_SHARE <= F.lit(total)).select("x", "deviation", "whitened"), "x")
            .select("id", "deviation", "whitened"))
    return near.union(rest).select(F.col("id").alias(key), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                                   F.array(*[F.lit(v) for v in explained]).alias("explained"), F.lit(error).alias("identity_error"))


def report(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each vector and component (``op12_embedding_whitening``)."""
    done = whiten(rows, key, vector)
    pairs = done.select(key, "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return pairs.select(key, (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                        F.col("explained")[F.col("at")].alias("explained"), "identity_error")
