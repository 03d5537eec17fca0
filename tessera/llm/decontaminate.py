"""Benchmark decontamination by latent semantic retrieval.

The benchmark's items are the query set; they are taken in blocks of
``ITEM_BLOCK``, and every block meets every document.  For a block:

1. One pass over all texts counts, for every term of the block's items, the
   ``CHUNK``-word chunks that hold it, and adds up the sketch Z = A' * Omega,
   where A is the chunk-term matrix and Omega has a random sign vector a chunk
   (made from the chunk's own hash, so it does not depend on partitions).  Tasks
   hand in one sum each; the sums meet by row block and bucket.
2. With term weights applied to its rows (inverse document frequency, and one
   over the length of the term's column), the SVD of Z - terms times
   ``RANK``, on the driver, a size the block bounds - spans the latent space of
   the TF-IDF matrix.
3. A second pass folds passages of ``PASSAGE`` words, half overlapping, into
   that space, and finds those whose cosine geometry with an item says that
   they hold a share of it (projection on the item >= ``CANDIDATE``).
   No exact weight is asked for: every candidate goes on, but those whose
   surroundings hold fewer of the item's words than any decision needs.
4. The longest common subsequence of words between the item and the passage
   with its surroundings decides: ``SURE`` of the item and the document is
   contaminated; from ``PARAPHRASE`` on it is if the item's answer (its last
   sentence, or its last words) is there as well.

All texts and all chunks take part, whole.  Defined cases: NULL or empty texts
and items match nothing; a text shorter than a passage is one passage; an item
longer than a passage is looked for by its passages, and ``SURE`` of one of them
is enough where the whole item is not there (the share is then that passage's);
repeated rows give their
own rows; NULL ids are kept; other columns are ignored; an empty table on
either side gives an empty result.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_parts, arrow_schema, as_batch, give_back, map_batches, mix64, one, slices, text_bytes, text_of, words_of

CHUNK = 64
PASSAGE, STRIDE = 64, 32
RANK = 128
CANDIDATE = 0.18
PARAPHRASE, SURE = 0.6, 0.75
ANSWER_WORDS = 8
SPREAD = 1.5
#: items looked for in one pass over the texts
ITEM_BLOCK = 1024
#: terms in more than this share of the chunks take no part in the latent search,
#: but for items with fewer than FEW_TERMS others
STOP_SHARE, FEW_TERMS = 0.02, 4
BUCKETS = 64
SLICE = 1 << 20
_SPOTS = 20  # bits of the lookup table for terms


class Terms:
    """Finds the block's terms among word hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        spot = (self.hashes >> np.uint64(64 - _SPOTS)).astype(np.int64)
        #: where in the sorted hashes a spot begins; one more than spots
        self.begin = np.searchsorted(spot, np.arange((1 << _SPOTS) + 1))

    def find(self, words: np.ndarray) -> np.ndarray:
        """Number of each word's term, or -1."""
        spot = (words >> np.uint64(64 - _SPOTS)).astype(np.int64)
        at, end = self.begin[spot], self.begin[spot + 1]
        out = np.full(len(words), -1, np.int64)
        some = np.flatnonzero(at < end)
        at, end = at[some], end[some]
        while len(some):
            hit = self.hashes[at] == words[some]
            out[some[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < end)
            some, at, end = some[go], at[go], end[go]
        return out


def item_words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(_LOWER))


# A-Z only, as the word hashes do
_LOWER = {c: c + 32 for c in range(65, 91)}


def answer_at(text: str) -> int:
    """Index of the word where the item's answer begins: its last sentence if
    it has several, else its last words."""
    words = item_words(text)
    ends = [i + 1 for i, w in enumerate(words[:-1]) if w[-1] in ".?!:"]
    ends = [e for e in ends if len(words) - e >= 3]
    return ends[-1] if ends else max(0, len(words) - ANSWER_WORDS)


def hashed(texts: list[str]) -> list[np.ndarray]:
    raw, at = text_bytes(pa.array(texts, pa.string()))
    hashes, _, _, first = words_of(raw, at)
    return [hashes[first[i]:first[i + 1]] for i in range(len(texts))]


def lcs(masks: dict[int, int], words: list[int], length: int) -> int:
    """Longest common subsequence, bit-parallel; ``masks`` has the item's
    positions of each word."""
    row = full = (1 << length) - 1
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return length - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def signs(keys: np.ndarray) -> np.ndarray:
    """A row of +-1 for each key."""
    bits = np.stack([mix64(keys, 61 + i) for i in range(RANK // 64)], 1)
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def chunk_sums(terms: Terms, df: np.ndarray, z: np.ndarray, texts: pa.Array) -> int:
    """Add a slice's chunks to the counts and to the sketch; how many chunks."""
    raw, at = text_bytes(texts)
    words, _, _, first = words_of(raw, at)
    count = np.diff(first)
    chunks = -(-count // CHUNK)
    base = np.cumsum(chunks) - chunks
    chunk = (np.arange(len(words)) - np.repeat(first[:-1], count)) // CHUNK + np.repeat(base, count)
    total = int(chunks.sum())
    if not total:
        return 0
    name = np.add.reduceat(words, np.flatnonzero(np.diff(chunk, prepend=-1)))
    term = terms.find(words)
    known = np.flatnonzero(term >= 0)
    pair = np.unique(term[known] * total + chunk[known])  # a term counts once a chunk
    term, chunk = pair // total, pair % total
    if len(term):
        begin = np.flatnonzero(np.diff(term, prepend=-1))
        df[term[begin]] += np.diff(np.append(begin, len(term)))
        z[term[begin]] += np.add.reduceat(signs(name)[chunk], begin, axis=0)
    return total


def corpus_sums(texts: DataFrame, hashes: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Chunks of the corpus, chunks per term, and the sketch."""
    size = len(hashes)
    shared = texts.sparkSession.sparkContext.broadcast(hashes)
    ddl = "block int, bucket int, part binary"
    schema = arrow_schema(ddl)
    blocks = max(1, size // 1024)

    def sums(batches):
        from pyspark import TaskContext
        terms = Terms(shared.value)
        df, z, total = np.zeros(size), np.zeros((size, RANK), np.float32), 0
        for batch in batches:
            for part in slices(batch.column(0), SLICE) if batch.num_rows else ():
                total += chunk_sums(terms, df, z, part)
        bucket = TaskContext.get().partitionId() % BUCKETS
        # the last row holds the number of chunks; blocks are made one at a time
        for i, at in enumerate(np.array_split(np.arange(size + 1), blocks)):
            inner = at[at < size]
            part = np.hstack([df[inner, None], z[inner]])
            if at[-1] == size:
                part = np.vstack([part, np.full((1, RANK + 1), float(total))])
            yield as_batch({"block": [i], "bucket": [bucket], "part": [part.tobytes()]}, schema)
        del df, z
        give_back()

    rows = add_parts(texts.mapInArrow(sums, ddl), blocks).reshape(-1, RANK + 1)
    if not len(rows):
        return 0, np.zeros(size), np.zeros((size, RANK))
    return int(rows[-1, 0]), rows[:-1, 0], rows[:-1, 1:]


class Space:
    """The latent space of one block of items, and the items in it."""

    def __init__(self, hashes: np.ndarray, chunks: int, df: np.ndarray, z: np.ndarray, items: list[np.ndarray], answers: list[int]):
        self.terms = Terms(hashes)
        # a term of a single chunk in a hundred weighs little over 1, one in every chunk next to nothing
        idf = np.log((chunks + 1) / (df + 1)) + 1e-3
        u, _, _ = np.linalg.svd(z * (idf / np.sqrt(np.maximum(df, 1)))[:, None], full_matrices=False)
        if u.shape[1] < RANK:  # fewer terms than dimensions: the space is the term space
            u = np.eye(len(idf), dtype=np.float64)
        # the basis is orthonormal; the scale makes projections estimate inner products of the term space
        leverage = (u ** 2).sum(1)
        self.base = (u / np.sqrt(np.maximum(leverage, 1e-12))[:, None] * idf[:, None]).astype(np.float32)
        self.square = idf ** 2
        self.items = [w.tolist() for w in items]
        self.masks = [masks_of(w) for w in self.items]
        self.answers = answers
        self.answer_masks = [masks_of(w[a:]) for w, a in zip(self.items, answers, strict=True)]
        # terms of many chunks say little: left to the subsequence, unless an item has hardly any other
        self.active = df <= STOP_SHARE * chunks
        for w in items:
            t = np.unique(self.terms.find(w))
            if self.active[t].sum() < FEW_TERMS:
                self.active[t] = True
        queries, self.owner, self.parts = [], [], []
        for i, w in enumerate(items):
            for s in range(0, max(1, len(w) - PASSAGE + STRIDE), STRIDE):
                t = np.unique(self.terms.find(w[s:s + PASSAGE]))
                t = t[self.active[t]]
                v = self.base[t].sum(0)
                norm = float(v @ v)
                if len(t) and norm > 0:
                    queries.append(v / norm)
                    self.owner.append(i)
                    part = w[s:s + PASSAGE].tolist()
                    #: of a longer item, the passage the query is made of
                    self.parts.append((masks_of(part), len(part)) if len(part) < len(w) else None)
        self.queries = np.array(queries, np.float32).reshape(-1, self.base.shape[1]).T.copy()

    def candidates(self, words: np.ndarray, first: np.ndarray):
        """(text, query, projection, first word, end word) of passages that pass
        the latent search."""
        count = np.diff(first)
        halves = -(-count // STRIDE)
        base = np.cumsum(halves) - halves
        total = int(halves.sum())
        if not total or not len(self.owner):
            return
        owner = np.repeat(np.arange(len(count)), count)
        half = (np.arange(len(words)) - first[:-1][owner]) // STRIDE + base[owner]
        term = self.terms.find(words)
        known = np.flatnonzero((term >= 0) & self.active[term])
        pair = np.unique(half[known] * len(self.square) + term[known])
        half, term = pair // len(self.square), pair % len(self.square)
        at = np.searchsorted(half, np.arange(total + 1))
        some = np.flatnonzero(np.diff(at))
        vectors = np.zeros((total + 1, self.base.shape[1]), np.float32)
        if len(some):
            vectors[some] = np.add.reduceat(self.base[term], at[some], axis=0)
        text = np.repeat(np.arange(len(count)), halves)
        together = np.zeros(total, bool)  # a half and the next one of the same text
        together[:-1] = text[1:] == text[:-1]
        single = together | (np.arange(total) == base[text])  # the last half alone is part of the passage before
        for low in range(0, total, 4096):
            high = min(low + 4096, total)
            v = vectors[low:high] + vectors[low + 1:high + 1] * together[low:high, None]
            near = v @ self.queries
            p, q = np.nonzero((near >= CANDIDATE) & single[low:high, None])
            for h, k, share in zip((low + p).tolist(), q.tolist(), near[p, q].tolist(), strict=True):
                i = int(text[h])
                start = int(first[i]) + (h - int(base[i])) * STRIDE
                yield i, k, share, start, min(start + PASSAGE, int(first[i + 1]))

    def matches(self, texts: pa.Array):
        """(text, item, projection, lcs share, first word, end word), the best a pair."""
        raw, at = text_bytes(texts)
        words, _, _, first = words_of(raw, at)
        best: dict[tuple[int, int], tuple] = {}
        parts: dict[tuple[int, int], tuple] = {}  # passages of long items
        tried: set[tuple[int, int, int]] = set()
        around: tuple = (None, frozenset())  # a passage's surroundings and their words
        for i, query, near, start, end in self.candidates(words, first):
            item, part = self.owner[query], self.parts[query]
            at_item = (i, query if part else -1 - item, start)
            if at_item in tried:
                continue
            tried.add(at_item)
            size = len(self.items[item])
            low, high = max(int(first[i]), start - size), min(int(first[i + 1]), end + size)
            if around[0] != (low, high):
                around = (low, high), frozenset(words[low:high].tolist())
            if part and best.get((i, item), (0, 0))[1] < SURE:
                masks, length = part
                if sum(masks[w].bit_count() for w in masks.keys() & around[1]) >= SURE * length:
                    have = max(lcs(masks, words[s:min(s + int(SPREAD * length) + 1, high)].tolist(), length)
                               for s in range(low, max(low + 1, high - length), length // 4)) / length
                    if have >= SURE and have > parts.get((i, item), (0, 0))[1]:
                        parts[i, item] = near, have, start - int(first[i]), end - int(first[i])
            # the subsequence can't be longer than the item's words that are there at all
            masks = self.masks[item]
            if sum(masks[w].bit_count() for w in masks.keys() & around[1]) < PARAPHRASE * size:
                continue
            # matched words must lie close together: windows of SPREAD times the item
            wide, step = int(SPREAD * size) + 1, max(1, size // 4)
            share, near_to = 0.0, []
            for s in range(low, max(low + 1, high - wide + step), step):
                region = words[s:min(s + wide, high)].tolist()
                have = lcs(self.masks[item], region, size) / size
                if have > share:
                    share, near_to = have, region
            if share < PARAPHRASE or share <= best.get((i, item), (0, 0))[1]:
                continue
            if share < SURE:
                rest = size - self.answers[item]
                if lcs(self.answer_masks[item], near_to, rest) < PARAPHRASE * rest:
                    continue
            best[i, item] = (near, share, start - int(first[i]), end - int(first[i]))
        for (i, item), found in (parts | best).items():
            yield i, item, *found


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, latent, lcs_share, first_word, end_word): every item that a
    document holds, as a copy or as a paraphrase, with its best passage."""
    rows = docs.select(F.col(id_col).alias("k0"), text_of(text_col).alias("t"))
    id_type = rows.schema["k0"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    ddl = f"id {id_type}, item {item_type}, latent double, lcs_share double, first_word int, end_word int"
    out = None
    for ids, shared in _spaces(rows, benchmark, item_col, item_text_col):
        def make(shared=shared, ids=ids):
            space = space_of(shared)

            def fn(batch):
                found, done = [], 0
                for part in slices(batch.column(1), SLICE):
                    found += [(done + i, ids[item], *rest) for i, item, *rest in space.matches(part)]
                    done += len(part)
                if not found:
                    return None
                cols = {k: [f[j] for f in found] for j, k in enumerate(("item", "latent", "lcs_share", "first_word", "end_word"), 1)}
                return cols | {"id": one(batch.column(0)).take(pa.array([f[0] for f in found]))}
            return fn

        some = map_batches(rows, ddl, make)
        out = some if out is None else out.union(some)
    if out is None:
        out = docs.sparkSession.createDataFrame([], ddl)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; no shuffle."""
    cols, at = docs.columns, docs.columns.index(text_col)
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)], text_of(text_col).alias("t"))
    ddl = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(cols)))
    for _, shared in _spaces(docs.select(text_of(text_col).alias("t")), benchmark, item_col, item_text_col):
        def make(shared=shared):
            space = space_of(shared)

            def fn(batch):
                keep, done = np.ones(batch.num_rows, bool), 0
                for part in slices(batch.column(len(cols)), SLICE):
                    keep[[done + i for i, *_ in space.matches(part)]] = False
                    done += len(part)
                take = pa.array(np.flatnonzero(keep))
                return {f"k{i}": one(batch.column(i)).take(take) for i in range(len(cols))}
            fn.finish = _SPACES.clear  # a stage of a pipeline leaves the memory to the next one
            return fn

        rows = map_batches(rows, ddl, make).withColumn("t", text_of(f"k{at}"))
    return rows.drop("t").toDF(*cols)


def _spaces(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str):
    """(item ids, broadcast space) for each block of items over the texts ``t``."""
    for block in _blocks(benchmark, item_col, item_text_col):
        items = hashed([t for _, t in block])
        hashes = np.unique(np.concatenate(items))
        chunks, df, z = corpus_sums(rows.select("t"), hashes)
        yield [i for i, _ in block], rows.sparkSession.sparkContext.broadcast(
            (hashes, chunks, df, z, items, [answer_at(t) for _, t in block]))


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str):
    """The items, in blocks of bounded size; the driver holds one block."""
    rows = benchmark.select(F.col(item_col).alias("i"), text_of(item_text_col).alias("t")).where(F.col("t") != "")
    block = []
    for r in rows.toLocalIterator():
        if item_words(r.t):
            block.append((r.i, r.t))
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


_SPACES: dict = {}


def space_of(shared) -> Space:
    """The block's space, made once a worker process."""
    key = hash((shared.value[0].tobytes(), shared.value[2].tobytes()))
    if key not in _SPACES:
        _SPACES.clear()
        _SPACES[key] = Space(*shared.value)
    return _SPACES[key]
