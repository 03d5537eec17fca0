"""Removal of repeated substrings of ``LENGTH`` bytes or more, within and across texts.

A suffix need not be sorted where nothing repeats.  So the work narrows down:

1. Every window of LENGTH bytes names an anchor: the place of the least hash
   among its ``SEED``-byte substrings.  Equal windows name equal anchors, and an
   anchor serves a run of neighbouring windows.  Anchors whose seed occurs once
   in the corpus are done.
2. The windows of a remaining anchor are looked at in groups of ``GROUP``
   neighbouring starts.  Prefix polynomial hashes give the hash of what the
   group's windows have in common (core) and of all they cover (full).  Groups
   with equal full are repeated as a whole; a core seen once can't be repeated.
3. What is left (the ends of repeated stretches) goes, a few hundred bytes each,
   to suffix sorting: a merge sort whose comparisons find the common extension
   of two suffixes by binary search over prefix hashes and then look at one
   byte.  Neighbours with a common extension of LENGTH bytes or more are
   compared byte by byte (collision check).  A run that one task sorts is
   bounded: cores are salted, and equal windows of different runs meet by a
   digest of their bytes, after each run has made its own into one row.

Documents with equal texts are one node with a count from the start.  All
counts are grouped sums with partial aggregation.

Defined cases: NULL or empty text, or text shorter than LENGTH, loses nothing;
every byte of a text of LENGTH bytes or more that occurs twice is removed;
repeated rows are copies of each other like any equal texts; NULL ids are kept;
other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, mix64, one, powers, slices, text_bytes, text_of

LENGTH = 400
SEED = 128
GROUP = 16
SALTS = 16
BITMAP_BITS = 22
_TABLES = tuple(mix64(np.arange(256, dtype=np.uint64), s) for s in (41, 42))


class Prefixes:
    """Polynomial prefix hashes (modulo 2^64) of a byte array, two of them."""

    def __init__(self, raw: np.ndarray, both: bool = True):
        n = len(raw)
        p, self.inverse = powers(n + 1)
        self.sums = []
        for k in range(1 + both):
            acc = np.zeros(n + 1, np.uint64)
            np.cumsum(_TABLES[k][raw] * p[:n], out=acc[1:])
            self.sums.append(acc)

    def of(self, start: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        """Hash of raw[start:end] for arrays of places."""
        return (self.sums[k][end] - self.sums[k][start]) * self.inverse[start]


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbouring keys."""
    n = len(keys)
    if n < width:
        return keys[:0]
    pad = -n % width
    grid = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(raw: np.ndarray, at: np.ndarray, length: int, seed: int):
    """Anchors of all windows of all texts of a buffer.

    Returns the place of each anchor in the buffer, its seed's hash, the first
    and last window start it serves, and the number of its text.
    """
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none, none
    prefix = Prefixes(raw, both=False)
    place = np.arange(n - seed + 1)
    hashes = mix64(prefix.of(place, place + seed))
    bits = np.uint64(max(24, int(n).bit_length()))
    least = sliding_least((hashes >> bits << bits) | place.astype(np.uint64), length - seed + 1)
    chosen = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    start = np.arange(len(chosen))
    text = np.searchsorted(at, start, "right") - 1
    inside = start + length <= at[text + 1]
    start, chosen, text = start[inside], chosen[inside], text[inside]
    if not len(start):
        return none, none.astype(np.uint64), none, none, none
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return chosen[first], hashes[chosen[first]], start[first], start[last], text[first]


# ------------------------------------------------------------- suffix sorting

def extension(prefix: Prefixes, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common extension of suffixes i and j, at most ``limit``."""
    low, high = np.zeros(len(i), np.int64), limit.astype(np.int64)
    while (open_ := low < high).any():
        mid = (low + high + 1) >> 1
        same = prefix.of(i, i + mid) == prefix.of(j, j + mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)
    return low


def suffix_order(raw: np.ndarray, prefix: Prefixes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Merge sort of the suffixes raw[start:end] (``end`` bounds each of them).

    Bottom-up: in every round each run finds the places of its members in its
    sibling by binary search; a comparison is a common extension and one byte.
    """
    padded = np.append(raw, np.uint8(0))

    def less(i, j, or_equal):  # suffix i before suffix j
        room = np.minimum(end[i] - start[i], end[j] - start[j])
        ext = extension(prefix, start[i], start[j], room)
        done = ext == room
        a, b = padded[np.minimum(start[i] + ext, len(raw))], padded[np.minimum(start[j] + ext, len(raw))]
        shorter = (end[i] - start[i]) - (end[j] - start[j])
        return np.where(done, (shorter < 0) | (or_equal & (shorter == 0)), a < b)

    n = len(start)
    order = np.arange(n)
    run = 1
    where = np.arange(n)
    while run < n:
        block = where // run
        base = (block // 2) * 2 * run
        left = block % 2 == 0
        low = np.where(left, base + run, base)
        high = np.where(left, np.minimum(base + 2 * run, n), base + run)
        low, high = np.minimum(low, n), np.minimum(high, n)
        origin = low.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) >> 1
            # members of the left run go before equal ones of the right run
            before = less(order[mid], order[open_], ~left[open_])
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        target = base + (where - np.where(left, base, base + run)) + (low - origin)
        new = np.empty(n, np.int64)
        new[target] = order
        order = new
        run *= 2
    return order


def equal_classes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """A number for each suffix, the same for those whose first ``length`` bytes are the same."""
    prefix = Prefixes(raw)
    order = suffix_order(raw, prefix, start, end)
    a, b = order[:-1], order[1:]
    same = extension(prefix, start[a], start[b], np.minimum(end[a] - start[a], end[b] - start[b])) >= length
    at = np.flatnonzero(same)
    if len(at):  # collision check on the bytes themselves
        span = np.arange(length)
        for part in np.array_split(at, len(at) // 4096 + 1):
            same[part] = (raw[start[a[part], None] + span] == raw[start[b[part], None] + span]).all(1)
    out = np.empty(len(start), np.int64)
    out[order] = np.concatenate(([0], np.cumsum(~same)))
    return out


# ------------------------------------------------------------------ the stages

def scan(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """One row per row: its digest, size, anchors and their seeds."""
    def make():
        def fn(batch):
            out = {"id": one(batch.column(0)), "sha": one(batch.column(2)), "n": [], "place": [], "seed": []}
            for part in slices(batch.column(1)):
                raw, at = text_bytes(part)
                chosen, hashes, _, _, text = anchors(raw, at, length, seed)
                bounds = np.searchsorted(text, np.arange(1, len(part)))
                out["n"] += np.diff(at).tolist()
                out["place"] += np.split((chosen - at[text]).astype(np.int32), bounds)
                out["seed"] += np.split(hashes.view(np.int64), bounds)
            return out
        return fn

    id_type = rows.schema["id"].dataType.simpleString()
    return map_batches(rows.select("id", "t", F.sha2("t", 256).alias("sha")),
                       f"id {id_type}, sha string, n long, place array<int>, seed array<long>", make)


def repeated_seeds(spots: DataFrame) -> DataFrame:
    """(seed, salt) of the seeds that occur more than once, for the salts they
    occur under: a seed that a third of all anchors share is joined in SALTS tasks."""
    parts = spots.groupBy("seed", "salt").agg(F.count("*").alias("c"))
    seeds = parts.groupBy("seed").agg(F.sum("c").alias("c"), F.collect_list("salt").alias("salts"))  # SALTS at most
    return seeds.where("c > 1").select("seed", F.explode("salts").alias("salt"))


def texts_of(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, t, places): texts of the wanted nodes (node, rep, sha, places).

    A bitmap of fixed size over the wanted digests keeps other texts out of the
    shuffle; the join decides.
    """
    spot = F.xxhash64("sha").bitwiseAND((1 << BITMAP_BITS) - 1)
    words = (wanted.select(F.shiftright(spot, 5).alias("w"), F.expr("shiftleft(1L, cast(xxhash64(sha) & 31 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for r in words.collect():  # at most 2^17 words whatever the number of texts
        bitmap[r.w] = r.b
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def make():
        bits = shared.value

        def fn(batch):
            spot = np.asarray(one(batch.column(3)))
            take = pa.array(np.flatnonzero(bits[spot >> 5] >> (spot & 31).astype(np.uint32) & np.uint32(1)))
            return {k: one(batch.column(i)).take(take) for i, k in enumerate(("rep", "t", "sha"))} if len(take) else None
        return fn

    id_type = rows.schema["id"].dataType.simpleString()
    sent = rows.select("id", "t", F.sha2("t", 256).alias("sha")).withColumn("spot", spot)
    found = map_batches(sent, f"rep {id_type}, t string, sha string", make)
    right = wanted.withColumnRenamed("rep", "r").withColumnRenamed("sha", "s")
    joined = found.join(right, (F.col("sha") == F.col("s")) & F.col("rep").eqNullSafe(F.col("r")))
    return joined.select("node", "t", "places").dropDuplicates(["node"])


def group_rows(texts: DataFrame, length: int, seed: int, group: int) -> DataFrame:
    """A row for each group of neighbouring windows of the surviving anchors."""
    def make():
        def fn(batch):
            nodes = np.asarray(one(batch.column(0)))
            places = one(batch.column(2))
            done, out = 0, {k: [] for k in ("node", "anchor", "low", "high", "core", "full1", "full2")}
            for part in slices(batch.column(1)):
                raw, at = text_bytes(part)
                chosen, _, first, last, text = anchors(raw, at, length, seed)
                mine = places.slice(done, len(part))
                wanted = np.asarray(mine.flatten()).astype(np.int64) + np.repeat(at[:-1], np.diff(np.asarray(mine.offsets)))
                keep = np.isin(chosen, wanted)
                chosen, first, last, text = chosen[keep], first[keep], last[keep], text[keep]
                low_x, high_x = chosen - last, chosen - first  # offsets of the anchor in its windows
                b0, b1 = low_x // group, high_x // group
                many = b1 - b0 + 1
                row = np.repeat(np.arange(len(chosen)), many)
                b = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + b0[row]
                prefix = Prefixes(raw)
                a = chosen[row]
                near, far = a - group * b, a - group * b - (group - 1)  # last and first start of the group
                core = mix64(prefix.of(near, far + length) ^ mix64(b.astype(np.uint64), 3))
                fits = (far >= at[text[row]]) & (near + length <= at[text[row] + 1])
                f1 = prefix.of(np.where(fits, far, 0), np.where(fits, near + length, 0))
                f2 = prefix.of(np.where(fits, far, 0), np.where(fits, near + length, 0), 1)
                node = nodes[done + text[row]]
                # a group that sticks out of its text is like no other
                f1 = np.where(fits, f1, mix64(node.astype(np.uint64), 5))
                f2 = np.where(fits, f2, mix64((a - at[text[row]]).astype(np.uint64), 6) ^ mix64(b.astype(np.uint64), 7))
                origin = at[text[row]]
                out["node"].append(node)
                out["anchor"].append(a - origin)
                out["low"].append(np.maximum(far, first[row]) - origin)
                out["high"].append(np.minimum(near, last[row]) - origin)
                for k, v in (("core", core), ("full1", f1), ("full2", f2)):
                    out[k].append(v.view(np.int64))
                done += len(part)
            return {k: np.concatenate(v) for k, v in out.items()}
        return fn

    return map_batches(texts, "node long, anchor long, low long, high long, core long, full1 long, full2 long", make)


def single_windows(pieces: DataFrame, length: int) -> DataFrame:
    """Suffix-sort the pieces a task holds; a row for each start, with the size
    of its class in this run and the digest of its window (on one row a class)."""
    def make():
        def fn(batch):
            node, low = np.asarray(one(batch.column(0))), np.asarray(one(batch.column(1)))
            parts = one(batch.column(2))
            raw, at = text_bytes(parts)
            size = np.diff(at)
            count = size - length + 1
            row = np.repeat(np.arange(len(size)), count)
            off = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = at[row] + off
            kind = equal_classes(raw, start, at[row + 1], length)
            members = np.bincount(kind)
            head = np.zeros(len(start), bool)
            head[np.unique(kind, return_index=True)[1]] = True
            data = raw.tobytes()
            digest = [hashlib.blake2b(data[s:s + length], digest_size=16).digest() if h else None for s, h in zip(start.tolist(), head, strict=True)]
            return {"node": node[row], "start": low[row] + off, "digest": digest, "here": members[kind]}
        return fn

    return map_batches(pieces, "node long, start long, digest binary, here long", make)


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  seed: int = SEED, group: int = GROUP) -> DataFrame:
    """(id, sha, n, removed, n_spans, kept_sha) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    seen = cut(scan(rows, length, seed), "suffix-rows")
    nodes = cut(seen.groupBy("sha").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
                                        F.first("place").alias("place"), F.first("seed").alias("seed"))
                .withColumn("node", F.monotonically_increasing_id()), "suffix-nodes")
    spots = nodes.select("node", F.explode(F.arrays_zip("place", "seed")).alias("z")).select(
        "node", "z.place", "z.seed", F.pmod("node", F.lit(SALTS)).alias("salt"))
    places = spots.join(repeated_seeds(spots), ["seed", "salt"]).groupBy("node").agg(F.collect_list("place").alias("places"))
    texts = cut(texts_of(nodes.join(places, "node").select("node", "rep", "sha", "places"), rows), "suffix-texts")
    groups = cut(group_rows(texts, length, seed, group), "suffix-groups")
    classes = cut(groups.groupBy("core", "full1", "full2").agg(F.count("*").alias("size"), F.min(F.struct("node", "low", "high")).alias("one")),
                  "suffix-classes")
    whole = groups.join(classes.where("size > 1").select("core", "full1", "full2"), ["core", "full1", "full2"], "left_semi")
    whole = whole.select("node", "low", (F.col("high") + length).alias("end"))
    # several classes share a core: their single windows decide, one member a class
    mixed = classes.groupBy("core").count().where("count > 1").select("core")
    ends = classes.join(mixed, "core", "left_semi").select("core", "one.*")
    pieces = (texts.select("node", "t").join(ends, "node")
              .select("node", "low", F.expr(f"substring(cast(t as binary), cast(low + 1 as int), cast(high - low + {length} as int))").alias("piece"),
                      "core", F.pmod("node", F.lit(SALTS)).alias("salt")))
    pieces = pieces.repartition("core", "salt").select("node", "low", "piece")
    single = cut(single_windows(pieces, length), "suffix-windows")
    shared = (single.where("digest is not null").groupBy("digest").agg(F.count("*").alias("runs")).where("runs > 1"))
    twice = (single.where("here > 1").select("node", "start")
             .union(single.where("here = 1").join(shared, "digest", "left_semi").select("node", "start")))
    twice = twice.select("node", F.col("start").alias("low"), (F.col("start") + length).alias("end"))
    spans = whole.union(twice).groupBy("node").agg(F.collect_list(F.struct("low", "end")).alias("spans"))

    def make():
        def fn(batch):
            out = {"node": one(batch.column(0)), "removed": [], "n_spans": [], "kept_sha": []}
            spans = one(batch.column(2))
            flat = spans.flatten()
            low, end = (np.asarray(flat.field(k)) for k in (0, 1))
            at = np.asarray(spans.offsets) - spans.offsets[0].as_py()
            for i, t in enumerate(one(batch.column(1)).to_pylist()):
                raw = t.encode("utf-8")
                order = np.argsort(low[at[i]:at[i + 1]], kind="stable")
                s, e = low[at[i]:at[i + 1]][order], np.maximum.accumulate(end[at[i]:at[i + 1]][order])
                begin = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
                stop = np.append(begin[1:], len(s)) - 1
                kept, last = [], 0
                for a, b in zip(s[begin].tolist(), e[stop].tolist(), strict=True):
                    kept.append(raw[last:a])
                    last = b
                kept = b"".join([*kept, raw[last:]])
                out["removed"].append(len(raw) - len(kept))
                out["n_spans"].append(len(begin))
                out["kept_sha"].append(hashlib.sha256(kept).hexdigest())
            return out
        return fn

    fixed = map_batches(texts.select("node", "t").join(spans, "node").select("node", "t", "spans"),
                        "node long, removed long, n_spans long, kept_sha string", make)
    copied = (F.col("copies") > 1) & (F.col("n") >= length)
    result = nodes.select("node", "sha", "n", "copies").join(fixed, "node", "left").select(
        "sha", F.when(copied, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha"))
    return seen.select("id", "n", "sha").join(result, "sha").select("id", "n", "removed", "n_spans", "kept_sha")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return removed_spans(docs, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("n").alias("n_bytes"), F.col("removed").alias("n_removed"), "n_spans",
        F.col("kept_sha").alias("kept_sha256"))
