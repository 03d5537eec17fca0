"""Near-duplicate documents: MinHash bands, sequential Bayesian verification.

1. A document is the set of its distinct word shingles.  Documents with equal
   sets are one node.  A node has a MinHash signature of ``BANDS * ROWS``.
2. Nodes that share a band of the signature are candidates.  In a bucket every
   node is paired with one leader only, so a bucket of m nodes gives m - 1
   pairs, not m * m.
3. Candidate signatures are compared batch by batch.  After n hashes with m
   agreements the similarity is Beta(m + 1, n - m + 1); a pair is dropped once
   its probability of reaching the threshold is below ``MISS``.  Survivors are
   verified exactly on their full shingle sets.
4. Verified links make components.  Buckets whose nodes are in several
   components are tried again with other leaders.  At last nodes of different
   components are tested inside the tasks, tile by tile, first on signatures;
   full sets are sent and verified only for nodes of pairs that this leaves, and
   only links are emitted: no link inside a bucket is left untested unless it
   would join what is joined already.

Two documents at the threshold 0.8 share no band with probability 3e-6.
Nothing is capped; buckets, links and components stay distributed.

Defined cases: NULL or empty text, or text without words, has no shingles, is
linked with nothing and is kept; a text with fewer words than a shingle is one
shingle; rows with NULL ids take part, a component's id is the least id in it
(NULL if there is none, then each row is kept); repeated rows give one row
each; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, as_batch, cut, map_batches, mix64, one, shingles_of, slices, text_bytes, text_of, words_of
from .components import components

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32  # hashes compared before the posterior is looked at again
MISS = 1e-6
BITMAP_BITS = 22
TILE = 512  # nodes of a bucket compared together at the end

_A = mix64(np.arange(HASHES, dtype=np.uint64), 11) | np.uint64(1)
_C = mix64(np.arange(HASHES, dtype=np.uint64), 12)


def distinct_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and where texts begin."""
    raw, at = text_bytes(texts)
    hashes, _, _, first = words_of(raw, at)
    shingles, begin = shingles_of(hashes, first, size)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(begin))
    order = np.lexsort((shingles, owner))
    shingles = shingles[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    count = np.bincount(owner[new], minlength=len(at) - 1)
    return shingles[new], np.concatenate(([0], np.cumsum(count)))


def set_keys(shingles: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set, as two int64."""
    out = []
    for seed in (21, 22):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(shingles, seed))))
        out.append(mix64(total[begin[1:]] - total[begin[:-1]] + np.diff(begin).astype(np.uint64), seed).view(np.int64))
    return out[0], out[1]


def signatures(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MinHash signatures (uint32) of the non-empty sets; empty ones get zeros."""
    n = len(begin) - 1
    out = np.zeros((n, HASHES), np.uint32)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        at = begin[:-1][some]
        for k in range(HASHES):
            out[some, k] = np.minimum.reduceat(((shingles ^ _C[k]) * _A[k]) >> np.uint64(32), at)
    return out


def least_agreements(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, least agreements with which a pair goes on)."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        least = n
        for m in range(n, -1, -1):
            density = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(density - density.max())
            if density[grid >= threshold].sum() / density.sum() < miss:
                break
            least = m
        out.append((n, least))
    return out


def _binary(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1] * matrix.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix))]
                                                ).cast(pa.binary())


def _matrix(column, dtype) -> np.ndarray:
    column = one(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(len(column), -1).copy().view(dtype)


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, n, hi, lo, sig) for every row, written once."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))

    def make():
        def fn(batch):
            n, hi, lo, sig = [], [], [], []
            for part in slices(batch.column(1)):
                shingles, begin = distinct_sets(part, size)
                n.append(np.diff(begin))
                a, b = set_keys(shingles, begin)
                hi.append(a)
                lo.append(b)
                sig.append(_binary(signatures(shingles, begin)))
            return {"id": one(batch.column(0)), "n": np.concatenate(n), "hi": np.concatenate(hi), "lo": np.concatenate(lo),
                    "sig": pa.concat_arrays(sig)}
        return fn

    id_type = rows.schema["id"].dataType.simpleString()
    return cut(map_batches(rows, f"id {id_type}, n long, hi long, lo long, sig binary", make), "minhash-rows")


def band_keys(sig: np.ndarray) -> np.ndarray:
    sig = sig.astype(np.uint64)
    key = np.zeros((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        for r in range(ROWS):
            key[:, b] = mix64(key[:, b] ^ sig[:, b * ROWS + r], b + 31)
    return key


def banded(nodes: DataFrame) -> DataFrame:
    """(key, node): a row for each band of each node."""
    def make():
        def fn(batch):
            key = band_keys(_matrix(batch.column(1), np.uint32))
            return {"key": key.ravel().view(np.int64), "node": np.repeat(np.asarray(one(batch.column(0))), BANDS)}
        return fn
    return map_batches(nodes.select("node", "sig"), "key long, node long", make)


def prune(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that the sequential test on signatures leaves."""
    sigs = nodes.select("node", "sig", "n")
    joined = (pairs.join(sigs.toDF("a", "sa", "na"), "a").join(sigs.toDF("b", "sb", "nb"), "b")
              # sets whose sizes differ too much can't reach the threshold
              .where(F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")))
    steps = least_agreements(threshold)

    def make():
        def fn(batch):
            x, y = _matrix(batch.column(2), np.uint32), _matrix(batch.column(3), np.uint32)
            alive, agree, done = np.arange(len(x)), np.zeros(len(x), np.int64), 0
            for upto, least in steps:
                agree[alive] += (x[alive, done:upto] == y[alive, done:upto]).sum(1)
                alive = alive[agree[alive] >= least]
                done = upto
            return {"a": np.asarray(one(batch.column(0)))[alive], "b": np.asarray(one(batch.column(1)))[alive]}
        return fn

    return map_batches(joined.select("a", "b", "sa", "sb"), "a long, b long", make)


def tiled(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``members`` (key, node, label, size), dealt by bucket, with
    what the test on signatures needs.

    A bucket of more than ``TILE`` nodes is cut into tiles; every pair of tiles
    (i, j) is a group of its own, so no task holds more than two tiles.
    """
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("node", "key"), F.col("tiles")).cast("int")
    rows = members.withColumn("tiles", tiles).withColumn("tile", mine)
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("key", F.least("tile", "o").alias("i"), F.greatest("tile", "o").alias("j"), "node", "label", "tile")
    return rows.join(nodes.select("node", "n", "sig"), "node").select("key", "i", "j", "node", "label", "tile", "n", "sig")


def by_group(rows: DataFrame, ddl: str, sets: bool, make: Callable[[], Callable]) -> DataFrame:
    """Groups (key, i, j) of tiled rows, one after the other, through a function
    that ``make`` builds once a task; it returns a dict of columns or ``None``."""
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    schema = arrow_schema(ddl)

    def columns(batch):
        out = [np.asarray(one(batch.column(k))) for k in range(7)] + [_matrix(batch.column(7), np.uint32)]
        if sets:
            full = np.empty(batch.num_rows, object)
            full[:] = [v.values.to_numpy(zero_copy_only=False) for v in one(batch.column(8))]
            out.append(full)
        return out

    def run(batches):
        rest, fn = None, make()
        for batch in _with_end(batches):
            if batch is not None:
                cols = columns(batch)
                rest = cols if rest is None else [np.concatenate(c) for c in zip(rest, cols, strict=True)]
            if rest is None or not len(rest[0]):
                continue
            key, i, j = rest[:3]
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *new.tolist()] + ([len(key)] if batch is None else [])
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                out = fn([c[lo:hi] for c in rest])
                if out is not None:
                    yield as_batch(out, schema)
            rest = [c[bounds[-1]:].copy() for c in rest]

    return dealt.mapInArrow(run, ddl)


def hopeful_pairs(group: list[np.ndarray], threshold: float, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group that are of different components, pass the sequential
    test and have no earlier bucket in common."""
    key, i, j, _, label, tile, n, sig = group[:8]
    if i[0] == j[0]:
        x, y = np.triu_indices(len(n), 1)
    else:
        x, y = (v.ravel() for v in np.meshgrid(np.flatnonzero(tile == i[0]), np.flatnonzero(tile == j[0]), indexing="ij"))
    ok = (label[x] != label[y]) & (np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]))
    x, y = x[ok], y[ok]
    agree, done = np.zeros(len(x), np.int64), 0
    for upto, least in steps:
        agree += (sig[x, done:upto] == sig[y, done:upto]).sum(1)
        ok = agree >= least
        x, y, agree, done = x[ok], y[ok], agree[ok], upto
    if len(x):
        keys = band_keys(sig)
        first = (keys[x] == keys[y]).argmax(1)
        ok = keys[x, first].view(np.int64) == key[0]
        x, y = x[ok], y[ok]
    return x, y


def hopeful(rows: DataFrame, percent: int) -> DataFrame:
    """The tiled rows of nodes that are in a pair the signatures leave: never
    more than there are, and only their full sets are looked at."""
    threshold = percent / 100
    steps = least_agreements(threshold)

    def make():
        def fn(group):
            take = np.unique(np.concatenate(hopeful_pairs(group, threshold, steps)))
            if not len(take):
                return None
            names = ("key", "i", "j", "node", "label", "tile", "n")
            return {k: c[take] for k, c in zip(names, group, strict=False)} | {"sig": _binary(group[7][take])}
        return fn

    return by_group(rows, "key long, i int, j int, node long, label long, tile int, n long, sig binary", False, make)


def across(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of different components that share a bucket: the
    pairs of ``hopeful`` rows whose full sets satisfy the condition, each in the
    first bucket the two have in common and only while the task has not joined
    the two otherwise.  Nothing is emitted for other pairs.
    """
    threshold = percent / 100
    steps = least_agreements(threshold)

    def make():
        up: dict[int, int] = {}  # the task's own union of labels

        def root(v):
            while up.get(v, v) != v:
                v = up[v]
            return v

        def fn(group):
            node, label, full = group[3], group[4], group[8]
            links = []
            for p, q in zip(*(v.tolist() for v in hopeful_pairs(group, threshold, steps)), strict=True):
                u, v = root(int(label[p])), root(int(label[q]))
                if u != v:
                    both = len(np.intersect1d(full[p], full[q], assume_unique=True))
                    if 100 * both >= percent * (len(full[p]) + len(full[q]) - both):
                        up[u] = v
                        links.append((int(node[p]), int(node[q])))
            return {"a": [p for p, _ in links], "b": [q for _, q in links]} if links else None
        return fn

    whole = rows.join(sets, "node").select("key", "i", "j", "node", "label", "tile", "n", "sig", "shingles")
    return by_group(whole, "a long, b long", True, make).distinct()


def _with_end(batches):
    """The batches that have rows, then None."""
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def sets_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted``, made again from their texts.

    A bitmap of fixed size over the representatives' keys tells tasks which
    texts to look at, so only those few sets are shuffled; the join decides.
    """
    reps = nodes.join(wanted, "node", "left_semi").select("node", "hi", "lo", "rep")
    spot = F.xxhash64("rep").bitwiseAND((1 << BITMAP_BITS) - 1)
    words = (reps.select(F.shiftright(spot, 5).alias("w"), F.expr("shiftleft(1L, cast(xxhash64(rep) & 31 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for r in words.collect():  # at most 2^17 words whatever the number of nodes
        bitmap[r.w] = r.b
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    rows = rows.select("id", "t", F.xxhash64("id").bitwiseAND((1 << BITMAP_BITS) - 1).alias("spot"))
    id_type = rows.schema["id"].dataType.simpleString()

    def make():
        bits = shared.value

        def fn(batch):
            spot = np.asarray(one(batch.column(2)))
            take = np.flatnonzero(bits[spot >> 5] >> (spot & 31).astype(np.uint32) & np.uint32(1))
            if not len(take):
                return None
            texts, hi, lo, flat, sizes = one(batch.column(1)).take(pa.array(take)), [], [], [], []
            for part in slices(texts):
                shingles, begin = distinct_sets(part, size)
                a, b = set_keys(shingles, begin)
                hi.append(a)
                lo.append(b)
                flat.append(shingles.view(np.int64))
                sizes.append(np.diff(begin))
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
            return {"rep": one(batch.column(0)).take(pa.array(take)), "hi": np.concatenate(hi), "lo": np.concatenate(lo),
                    "shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat)))}
        return fn

    made = map_batches(rows, f"rep {id_type}, hi long, lo long, shingles array<long>", make)
    found = made.alias("m").join(reps.alias("r"), (F.col("m.hi") == F.col("r.hi")) & (F.col("m.lo") == F.col("r.lo"))
                                 & F.col("m.rep").eqNullSafe(F.col("r.rep")))
    return found.select("node", "shingles").groupBy("node").agg(F.first("shingles").alias("shingles"))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets satisfy 100 * intersection >= percent * union."""
    joined = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def make():
        def fn(batch):
            keep = []
            x, y = one(batch.column(2)), one(batch.column(3))
            for i in range(batch.num_rows):
                p, q = x[i].values.to_numpy(zero_copy_only=False), y[i].values.to_numpy(zero_copy_only=False)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    keep.append(i)
            take = pa.array(keep, pa.int64())
            return {"a": one(batch.column(0)).take(take), "b": one(batch.column(1)).take(take)}
        return fn

    return map_batches(joined, "a long, b long", make)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row."""
    rows = sketch(docs, id_col, text_col, shingle)
    some = rows.where("n > 0")
    nodes = cut(some.groupBy("hi", "lo").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                .withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    # buckets of one node can hold no pair; the sum of partial counts is what is shuffled
    keys = banded(nodes)
    bands = cut(keys.join(keys.groupBy("key").count().where("count > 1").select("key"), "key"), "minhash-bands")
    spark = docs.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    labels = None
    for step in ("least", "other", "across"):
        if labels is None:
            leaders = bands.groupBy("key").agg(F.min("node").alias("b"))
            pairs = bands.join(leaders, "key").where("node != b").select(F.col("node").alias("a"), "b")
        else:
            at = bands.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
            # only buckets whose nodes are not all joined yet
            split = (at.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("size"),
                                           F.max_by(F.struct("node", "label"), F.xxhash64(F.lit(step), "node", "key")).alias("lead"))
                     .where("x != y"))
            if step != "across":
                pairs = (at.join(split, "key").where(F.col("label") != F.col("lead.label"))
                         .select(F.greatest("node", "lead.node").alias("a"), F.least("node", "lead.node").alias("b")))
            else:
                open_ = cut(hopeful(tiled(at.join(split.select("key", "size"), "key"), nodes), percent), "minhash-open")
                sets = sets_of(open_.select("node").distinct(), nodes, docs, id_col, text_col, shingle)
                found = across(open_, sets, percent)
        if step != "across":
            left = cut(prune(pairs.distinct(), nodes, percent / 100), "minhash-left")
            wanted = left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct()
            found = verify(left, sets_of(wanted, nodes, docs, id_col, text_col, shingle), percent)
        links = cut(links.union(found), "minhash-links")
        labels = components(links)
    at = nodes.join(labels, "node", "left").select("hi", "lo", "rep", F.coalesce("label", "node").alias("label"))
    least = at.groupBy("label").agg(F.min("rep").alias("component_id"))
    at = at.join(least, "label").select("hi", "lo", "component_id")
    linked = some.select("id", "n", "hi", "lo").join(at, ["hi", "lo"]).select("id", "n", "component_id")
    alone = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def parted(docs: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose id is surely none of ``ids`` (one column,
    ``of``), and the others: all that have one of them and a few more.

    A bitmap of fixed size decides, as a table of at most 2^17 words that every
    task gets, so the sure rows are never shuffled.
    """
    def spot(name):
        return F.xxhash64(F.col(name)).bitwiseAND((1 << BITMAP_BITS) - 1)

    words = (ids.select(F.shiftright(spot("of"), 5).alias("w"), F.expr("shiftleft(1L, cast(xxhash64(of) & 31 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    at = docs.alias("d").join(F.broadcast(words.alias("m")), F.shiftright(spot(f"d.{id_col}"), 5) == F.col("m.w"), "left")
    bit = F.coalesce(F.expr(f"shiftright(m.b, cast(xxhash64(d.{id_col}) & 31 as int)) & 1L"), F.lit(0))
    return at.where(bit == 0).select("d.*"), at.where(bit == 1).select("d.*")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                 percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of the documents that are kept.

    An id stays if any of its rows is kept; of its rows with equal texts one
    stays.  Rows without words, or without an id, stay.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, percent).where(F.col(id_col).isNotNull())
    by_id = cut(found.groupBy(F.col(id_col).alias("of")).agg(F.max("kept").alias("kept"), F.count("*").alias("times")), "minhash-ids")
    dropped = by_id.where("not kept").select("of")
    kept, rest = parted(docs, dropped, id_col)
    kept = kept.union(rest.join(dropped, F.col(id_col) == F.col("of"), "left_anti"))
    again = by_id.where("kept and times > 1").select("of")
    if again.limit(1).count():
        several = kept.join(again, F.col(id_col) == F.col("of"), "left_semi").dropDuplicates([id_col, text_col])
        kept = kept.join(again, F.col(id_col) == F.col("of"), "left_anti").union(several)
    return kept
