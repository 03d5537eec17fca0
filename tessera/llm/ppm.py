"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order`` bytes, counted over all
training texts (A-Z lower-cased).  A byte is predicted from the longest context
seen in training; a context that never showed the byte escapes to the next
shorter one with probability q / 2T (q distinct bytes in T occurrences; a byte
seen n times has (2n - 1) / 2T), and bytes that the longer context had shown are excluded there.  Below the
empty context the bytes never seen share the rest evenly.  Texts begin with
``order`` marks and end with one (byte 0xFF, which UTF-8 never uses), so the
probabilities of all texts sum to one.  Beside it stands an add-one word model.

How it is spread: what the model gathers grows with the corpus, so no task
holds it whole.

* Documents are cut into blocks of whole texts, by bytes.  A block asks for each
  distinct (order + 1)-gram of bytes and each distinct word it holds, with the
  count over its training texts: rows grow with distinct contents, not with bytes.
  Texts travel as compressed pieces of a block, not as rows.
* Counts meet by gram and by word.  Grams whose context ends in the same two
  bytes are one subtrie; a task builds the contexts of two bytes and more of its
  subtries from them and gets the outer nodes - one byte and none, at most
  65,536 counts - with it.  A subtrie of order 4 has at most 2^24 grams.
* Answers go back to the blocks that asked, and a block's texts meet them in a
  cogroup.  The commonest gram or word has one row a block.

Defined results: NULL texts count as empty; a text without words has one token,
its end; NULL ids are training rows and kept; repeated rows count and score as
often as they occur; without training texts every byte has 1/256 and every token
log10(1) = 0; an empty table gives no rows; columns besides id and text are not
read.  Words of over 16 bytes are told apart by a 128-bit digest.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, _SPACE, arrow_schema, as_batch, cut, give_back, mix64, slices, text_bytes, text_of

#: bytes of context; at most 6, so that a gram fits a long
ORDER = 5
#: begin and end of a text: a byte that UTF-8 never uses
MARK = 0xFF
ALPHABET = 256
#: bytes of text a block holds at most (but a piece at least), and at least when data are few
BLOCK_BYTES, LEAST_BLOCK = 32_000_000, 1_000_000
#: pieces of a block are merged this many at a time (two lists of grams each); rows of a batch of asks
MERGE, ROWS = 12, 100_000
GRAM, WORD = 0, 1
_U = np.uint64


def held_out(key: str = "doc_id") -> Column:
    """Rows that are scored but not learned from: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "utf-8")) % 7 == 2, F.lit(False))


# ------------------------------------------------------------------- pieces
def grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram (context and byte) of every byte and end of ``texts``, and where texts begin."""
    raw, offsets = text_bytes(texts)
    m, sizes = len(offsets) - 1, np.diff(offsets)
    marked = np.full(len(raw) + m * (order + 1) + order, MARK, np.uint8)
    marked[np.arange(len(raw)) + np.repeat(np.arange(m) * (order + 1) + order, sizes)] = _LOWER[raw]
    at = np.arange(len(raw) + m) + np.repeat(np.arange(m) * order, sizes + 1)
    out = np.zeros(len(at), np.int64)
    for j in range(order + 1):
        out <<= 8
        out |= marked[at + j]
    return out, offsets[:-1] + np.arange(m)


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two longs that name each word, and the text it is of.

    Up to 16 bytes the longs are the word itself, filled up with 0xFF; longer
    words are named by a digest.
    """
    raw, offsets = text_bytes(texts)
    low = np.concatenate((_LOWER[raw], np.full(24, MARK, np.uint8)))
    word = np.zeros(len(raw) + 1, bool)
    word[:-1] = ~_SPACE[raw]
    begin = word[:-1].copy()
    begin[1:] &= ~word[:-2]
    edges = offsets[1:-1][offsets[1:-1] < len(raw)]
    begin[edges] = word[edges]  # a text's first byte starts a word of its own
    stop = ~word[1:]
    stop[edges - 1] = True
    start, end = np.flatnonzero(begin), np.flatnonzero(stop & word[:-1]) + 1
    size = end - start
    windows = np.ndarray(len(low) - 7, "<u8", low.tobytes(), strides=(1,))

    def part(skip: int) -> np.ndarray:
        have = np.clip(size - skip, 0, 8)
        keep = np.where(have == 8, _U(0), ~_U(0) << (_U(8) * (have % 8).astype(_U)))
        return windows[np.minimum(start + skip, len(windows) - 1)] | keep

    a, b = part(0), part(8)
    for i in np.flatnonzero(size > 16):
        name = hashlib.blake2b(low[start[i]:end[i]].tobytes(), digest_size=16).digest()
        a[i], b[i] = np.frombuffer(name, "<u8")
    return a, b, np.searchsorted(offsets, start, "right") - 1


def word_order(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """An order that puts equal words side by side, where each distinct one
    begins, their hashes, and the seed under which no two words share a hash."""
    for seed in range(64):
        h = mix64(a ^ mix64(b, seed + 1), seed + 2)
        order = np.argsort(h, kind="stable")
        hs, sa, sb = h[order], a[order], b[order]
        new = np.ones(len(h), bool)
        new[1:] = hs[1:] != hs[:-1]
        if not ((sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1]))[~new[1:]].any():
            return order, np.flatnonzero(new), hs[new], seed
    raise RuntimeError("words share hashes under 64 seeds")


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their counts added."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts[order], at)


def summed_words(a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words with their counts added."""
    at, begin, _, _ = word_order(a, b)
    return a[at[begin]], b[at[begin]], np.add.reduceat(counts[at], begin)


# ----------------------------------------------------------------- gathering
def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(piece: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(piece) as stream:
        return stream.read_next_batch()


def blocked(docs: DataFrame, key: str, text: str, held: Column) -> DataFrame:
    """(block, piece): whole texts (id, held, body) of a block, packed some at a time."""
    rows = docs.select(F.col(key).alias("id"), held.alias("held"), text_of(text).alias("body"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    # at least four blocks a core, as far as the data go: parallelism, not results
    share = total // (4 * docs.sparkSession.sparkContext.defaultParallelism)
    limit = max(LEAST_BLOCK, min(BLOCK_BYTES, share))
    schema = arrow_schema("block long, piece binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            at = 0
            for texts in slices(batch.column(2)):
                size = pc.sum(pc.binary_length(texts)).as_py()
                if filled and filled + size > limit:
                    block, filled = block + 1, 0
                filled += size
                yield as_batch({"block": [block], "piece": [packed(batch.slice(at, len(texts)))]}, schema)
                at += len(texts)

    return cut(rows.mapInArrow(run, "block long, piece binary"), "ppm-blocks")


class _Asks:
    """What one block asks for, gathered piece by piece."""

    def __init__(self, block: int):
        self.block, self.grams, self.words = block, [], []

    def add(self, texts: pa.Array, train: np.ndarray, order: int) -> None:
        g, begin = grams(texts, order)
        learned = np.repeat(train, np.diff(np.append(begin, len(g))))
        self.grams.append(np.unique(g[learned], return_counts=True))
        unlearned = np.unique(g[~learned])
        self.grams.append((unlearned, np.zeros(len(unlearned), np.int64)))
        a, b, of = word_keys(texts)
        if len(a):
            self.words.append(summed_words(a, b, train[of].astype(np.int64)))
        if len(self.grams) >= MERGE:
            self.merge()

    def merge(self) -> None:
        self.grams = [summed(*map(np.concatenate, zip(*self.grams, strict=True)))]
        if self.words:
            self.words = [summed_words(*map(np.concatenate, zip(*self.words, strict=True)))]

    def rows(self) -> Iterator[dict]:
        self.merge()
        g, gn = self.grams[0]
        a, b, n = self.words[0] if self.words else (g[:0].view(_U), g[:0].view(_U), gn[:0])
        near = np.lexsort((b, a))  # neighbours share bytes: files and shuffles shrink
        a, b, n = a[near].view(np.int64), b[near].view(np.int64), n[near]
        for kind, keys in ((GRAM, (g, np.zeros_like(g), gn)), (WORD, (a, b, n))):
            for low in range(0, len(keys[0]), ROWS):
                first, second, counts = (k[low:low + ROWS] for k in keys)
                yield {"block": pa.array(np.full(len(first), self.block)), "kind": pa.array(np.full(len(first), kind, np.int8)),
                       "a": pa.array(first), "b": pa.array(second), "n": pa.array(counts)}


ASKS = "block long, kind byte, a long, b long, n long"


def asks(blocks: DataFrame, order: int) -> DataFrame:
    """Distinct grams and words of every block with their training counts."""
    schema = arrow_schema(ASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for number, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if block is None or block.block != number:
                    if block is not None:
                        yield from (as_batch(x, schema) for x in block.rows())
                    block = _Asks(number)
                texts = unpacked(piece.as_buffer())
                block.add(texts.column(2), ~texts.column(1).to_numpy(zero_copy_only=False).astype(bool), order)
        if block is not None:
            yield from (as_batch(x, schema) for x in block.rows())
        block = None
        give_back()

    return cut(blocks.mapInArrow(run, ASKS), "ppm-asks", "zstd")


# ---------------------------------------------------------------------- trie
class _Level:
    """Contexts of one length: counts of (context, byte), and what their
    parents have left when the bytes seen here are excluded."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        ctx = keys >> 8
        self.begin = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(ctx) else np.zeros(0, np.int64)
        self.ctx = ctx[self.begin]
        self.total = np.add.reduceat(counts, self.begin) if len(ctx) else counts
        self.distinct = np.diff(np.append(self.begin, len(ctx)))

    def of_context(self, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _find(self.ctx, ctx)

    def count(self, keys: np.ndarray) -> np.ndarray:
        at, found = _find(self.keys, keys)
        return np.where(found, self.counts[at] if len(self.counts) else 0, 0)

    def left_in(self, parent: _Level, bits: int) -> None:
        """Occurrences and distinct bytes the parents have besides the bytes seen here."""
        if not len(self.ctx):
            self.rest_total = self.rest_distinct = self.total
            return
        mask = (1 << bits) - 1
        at, _ = parent.of_context(self.ctx & (mask >> 8))
        self.rest_total = parent.total[at] - np.add.reduceat(parent.count(self.keys & mask), self.begin)
        self.rest_distinct = parent.distinct[at] - self.distinct


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def log_probabilities(gram: np.ndarray, count: np.ndarray, outer: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of every gram's last byte after its context.

    ``gram`` has all grams of the subtries it is of, ``count`` how often training
    texts hold them; ``outer[c, s]`` counts byte s after byte c in all of them.
    """
    levels: list[_Level] = []
    for k in range(order + 1):
        if k >= 2:
            known = count > 0
            levels.append(_Level(*summed(gram[known] & ((1 << 8 * (k + 1)) - 1), count[known])))
        else:
            table = outer if k else outer.sum(axis=0, keepdims=True)
            c, s = np.nonzero(table)
            levels.append(_Level((c << 8) | s, table[c, s]))
    for k in range(1, order + 1):
        levels[k].left_in(levels[k - 1], 8 * k)
    out = np.zeros(len(gram))
    todo = np.arange(len(gram))
    above: np.ndarray | None = None  # place of the longer context of each gram to do, -1: never seen
    for k in range(order, -1, -1):
        level, g = levels[k], gram[todo]
        at, seen = level.of_context((g & ((1 << 8 * (k + 1)) - 1)) >> 8)
        total = np.where(seen, level.total[at] if len(level.ctx) else 0, 0)
        distinct = np.where(seen, level.distinct[at] if len(level.ctx) else 0, 0)
        if above is not None and len(levels[k + 1].ctx):
            total = np.where(above >= 0, levels[k + 1].rest_total[above], total)
            distinct = np.where(above >= 0, levels[k + 1].rest_distinct[above], distinct)
        n = level.count(g & ((1 << 8 * (k + 1)) - 1))
        hit = n > 0
        out[todo[hit]] += np.log10((2 * n[hit] - 1) / (2 * total[hit]))
        escape = ~hit & (distinct > 0)  # where nothing is left, the escape is certain
        out[todo[escape]] += np.log10(distinct[escape] / (2 * total[escape]))
        above = np.where(seen, at, -1)[~hit]
        todo = todo[~hit]
    out[todo] -= np.log10(max(ALPHABET - len(levels[0].keys), 1))
    return out


def model(counts: DataFrame, order: int) -> DataFrame:
    """(a, v): log10 probability of every gram asked for, subtrie by subtrie."""
    pairs = counts.where("n > 0").groupBy(F.shiftright("a", 8).bitwiseAND(255).alias("c"), F.col("a").bitwiseAND(255).alias("s")).agg(F.sum("n").alias("n"))
    outer = np.zeros((256, 256), np.int64)
    for r in pairs.collect():  # at most 65,536 rows, whatever the corpus
        outer[r.c, r.s] = r.n
    spread = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        g = pdf["a"].to_numpy()
        return pd.DataFrame({"a": g, "v": log_probabilities(g, pdf["n"].to_numpy(), outer, order)})

    subtrie = F.pmod(F.hash(F.shiftright("a", 8).bitwiseAND(0xFFFF)), F.lit(4 * spread))
    return counts.select("a", "n", subtrie.alias("subtrie")).groupBy("subtrie").applyInPandas(score, "a long, v double")


# -------------------------------------------------------------------- scores
def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, held: Column | None = None) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``held``: rows that are not learned from (default: :func:`held_out`).
    """
    if not 2 <= order <= 6:
        raise ValueError("order is 2 to 6")
    held = held_out(key) if held is None else held
    blocks = blocked(docs, key, text, held)
    asked = asks(blocks, order)
    grams_asked = asked.where(F.col("kind") == GRAM).select("block", "a", "n")
    words_asked = asked.where(F.col("kind") == WORD).select("block", "a", "b", "n")
    counts = cut(grams_asked.groupBy("a").agg(F.sum("n").alias("n")), "ppm-grams")
    words = cut(words_asked.groupBy("a", "b").agg(F.sum("n").alias("n")), "ppm-words", "zstd")
    trie = cut(model(counts, order), "ppm-model")

    ends = docs.where(~held).count()
    spoken = words.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    tokens, vocabulary = (spoken["n"] or 0) + ends, spoken["v"] + (ends > 0)

    answers = (grams_asked.join(trie, "a").select("block", F.lit(GRAM).cast("byte").alias("kind"), "a", F.lit(0).cast("long").alias("b"), "v")
               .unionByName(words_asked.drop("n").join(words, ["a", "b"])
                            .select("block", F.lit(WORD).cast("byte").alias("kind"), "a", "b", F.col("n").cast("double").alias("v"))))
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"{key} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    schema = arrow_schema(ddl)

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        is_word = found["kind"].to_numpy() == WORD
        a, b, v = found["a"].to_numpy(), found["b"].to_numpy(), found["v"].to_numpy()
        gram, logp = a[~is_word], v[~is_word]
        by_gram = np.argsort(gram)
        gram, logp = gram[by_gram], logp[by_gram]
        at, _, hashes, seed = word_order(a[is_word].view(_U), b[is_word].view(_U))
        counts = v[is_word][at]
        del found, is_word, a, b, v, by_gram, at
        out = []
        for piece in rows["piece"].combine_chunks():
            batch = unpacked(piece.as_buffer())
            texts, m = batch.column(2), batch.num_rows
            g, begin = grams(texts, order)
            wa, wb, of = word_keys(texts)
            c = counts[np.searchsorted(hashes, mix64(wa ^ mix64(wb, seed + 1), seed + 2))] if len(wa) else np.zeros(0)
            share = np.log10(tokens + vocabulary + 1)
            out.append(pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(np.bincount(of, minlength=m) + 1),
                pa.array(np.bincount(of, c > 0, minlength=m).astype(np.int64) + (ends > 0)), pa.array(np.full(m, tokens)),
                pa.array(np.bincount(of, np.log10(c + 1) - share, minlength=m) + np.log10(ends + 1) - share),
                pa.array(np.add.reduceat(logp[np.searchsorted(gram, g)], begin))], schema=schema))
        give_back()
        return pa.Table.from_batches(out, schema)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, ddl)
