"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte spans.  Every merge rank owns a bucket of
list positions; three levels of 64-bit words mark the ranks whose bucket is not
empty, so the lowest rank is found by three find-first-set steps whatever the
pre-token's length.  A position whose pair no longer has that rank is stale
and skipped.  Work is near linear in the pre-token, also for very long ones.

Ranks come from a ``.tiktoken`` file; the ids equal those of the tiktoken
library for the same ranks and split pattern, without special tokens.

Defined cases: NULL or empty text has no ids and decodes to no bytes; repeated
rows give one row each; NULL ids are kept; other columns are ignored; an empty
table gives an empty result.
"""
from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, one, text_of

#: pieces kept per Python worker; then they become the old ones, and the old ones go
CACHE_PIECES = 600_000
#: matches without a space before them, likewise
CACHE_STARTS = 50_000


class ByteBPE:
    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        #: decoding goes by the decimal ids themselves
        self.bytes_of = {str(r): b for b, r in self.ranks.items()}
        self.find = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                  .replace(r"\S", r"\P{White_Space}")).findall
        ranks = max(self.ranks.values()) + 1
        #: a bit per rank that has waiting positions, a bit per word of those
        self.low, self.mid = [0] * ((ranks >> 6) + 1), [0] * ((ranks >> 12) + 1)
        #: rank of every pair of bytes, or -1
        self.first = [-1] * 65536
        for token, r in self.ranks.items():
            if len(token) == 2:
                self.first[token[0] << 8 | token[1]] = r
        #: id of every single byte, or None
        self.single = [self.ranks.get(bytes([b])) for b in range(256)]
        self.pieces = _Pieces(self)
        #: ids of matches that no space precedes: marks, and words that begin a line
        self.starts = _Starts(self)

    # ------------------------------------------------------------- encoding
    def encode_word(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        ``bucket[rank]`` is a heap of positions, so within a rank the leftmost
        pair goes first.  ``low``, ``mid`` and ``top`` are the three levels of
        the bitmap (a bit per rank, per word of ``low``, per word of ``mid``);
        ``(x & -x).bit_length() - 1`` finds the first set bit.  The queue is
        empty again, all bits clear, when the loop ends.
        """
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        get, low, mid, first, n = ranks.get, self.low, self.mid, self.first, len(piece)
        push, pop = heapq.heappush, heapq.heappop
        after, before = list(range(1, n + 2)), list(range(-1, n))  # after[i]: end of the span at i
        token = [self.single[a] for a in piece]  # token[i]: id of the span at i
        #: rank of the pair that begins at i, or -1; a position popped with another rank is stale
        pair = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        bucket: dict[int, list[int]] = {}
        top = 0
        # entering a pair is written out in its three places: a call would cost as much as the step
        for i, r in enumerate(pair):
            if r >= 0:
                if r in bucket:
                    bucket[r].append(i)  # positions come in order: the list is a heap
                else:
                    bucket[r] = [i]
                    w = r >> 6
                    x = low[w]
                    low[w] = x | 1 << (r & 63)
                    if not x:
                        m = w >> 6
                        x = mid[m]
                        mid[m] = x | 1 << (w & 63)
                        if not x:
                            top |= 1 << m
        while top:
            m = (top & -top).bit_length() - 1
            x = mid[m]
            w = m << 6 | (x & -x).bit_length() - 1
            x = low[w]
            rank = w << 6 | (x & -x).bit_length() - 1
            waiting = bucket[rank]
            if len(waiting) > 1:
                i = pop(waiting)
            else:
                i = waiting[0]
                del bucket[rank]
                low[w] = x = x & (x - 1)
                if not x:
                    x = mid[m]
                    mid[m] = x = x & (x - 1)
                    if not x:
                        top &= top - 1
            if pair[i] != rank:
                continue  # stale: the pair at i has changed or is gone
            j = after[i]
            k = after[j]
            token[i] = rank
            pair[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
                r = get(piece[i:after[k]])
                if r is None:
                    pair[i] = -1
                else:
                    pair[i] = r
                    if r in bucket:
                        push(bucket[r], i)
                    else:
                        bucket[r] = [i]
                        w = r >> 6
                        x = low[w]
                        low[w] = x | 1 << (r & 63)
                        if not x:
                            m = w >> 6
                            x = mid[m]
                            mid[m] = x | 1 << (w & 63)
                            if not x:
                                top |= 1 << m
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                r = get(piece[h:k])
                if r is None:
                    pair[h] = -1
                else:
                    pair[h] = r
                    if r in bucket:
                        push(bucket[r], h)
                    else:
                        bucket[r] = [h]
                        w = r >> 6
                        x = low[w]
                        low[w] = x | 1 << (r & 63)
                        if not x:
                            m = w >> 6
                            x = mid[m]
                            mid[m] = x | 1 << (w & 63)
                            if not x:
                                top |= 1 << m
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        if None in out:
            raise KeyError(piece)  # a byte that the ranks lack is left over
        return out

    def word_ids(self, word: str) -> str:
        return ",".join(map(str, self.encode_word(word.encode("utf-8"))))

    def ids_plain(self, text: str) -> list[str]:
        """Ids of any text by the split pattern, a string for each match."""
        pieces, starts = self.pieces, self.starts
        return [pieces[m[1:]] if m[0] == " " and m[1:].isalpha() else starts[m] for m in self.find(text)]

    def ids(self, text: str) -> list[str]:
        """Ids of a text, as comma-joined strings for each of its pieces.

        Where single spaces part words, each match lies within a space and the
        word after it, so such pieces are encoded by themselves and remembered.
        Any other white space makes the whole text go through the pattern.
        """
        if not text:
            return []
        first, *rest = text.split(" ")
        if not first or first[-1].isspace() or first[0].isspace():
            return self.ids_plain(text)
        try:
            return [*self.ids_plain(first), *map(self.pieces.__getitem__, rest)]
        except _Loose:
            return self.ids_plain(text)

    # ------------------------------------------------------------- decoding
    def decode(self, joined: str) -> bytes:
        """Bytes of comma-joined decimal ids."""
        return b"".join(map(self.bytes_of.__getitem__, joined.split(","))) if joined else b""


class _Loose(Exception):
    """A piece that begins or ends with white space, or is empty."""


class _Pieces(dict):
    """Ids of a space and a piece that follows it; bounded.

    When full, the pieces become the old ones; those met again come back, so
    words in use are not encoded anew.  A word with a mark behind it is put
    together from the two each time: it would take the place of another word.
    """

    def __init__(self, bpe: ByteBPE):
        super().__init__()
        self.bpe = bpe
        self.old: dict[str, str] = {}

    def __missing__(self, piece: str) -> str:
        if piece[-1:] in _MARKS and piece[:-1].isalpha():
            return self[piece[:-1]] + "," + self.bpe.starts[piece[-1]]
        have = self.old.get(piece)
        if have is None:
            if piece.isalpha():
                have = self.bpe.word_ids(" " + piece)
            elif not piece or piece[0].isspace() or piece[-1].isspace():
                raise _Loose
            else:
                have = ",".join(self.bpe.ids_plain(" " + piece))
        if len(piece) <= 64:
            if len(self) >= CACHE_PIECES:
                self.old = {}
                kept = dict(self)
                self.clear()
                self.old = kept
            self[piece] = have
        return have

    def clear(self) -> None:
        super().clear()
        self.old = {}


_MARKS = frozenset(".,;:!?")


class _Starts(dict):
    """Ids of a match by itself; bounded, cleared when full."""

    def __init__(self, bpe: ByteBPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> str:
        have = self.bpe.word_ids(word)
        if len(word) <= 32:
            if len(self) >= CACHE_STARTS:
                self.clear()
            self[word] = have
        return have


_CODERS: dict = {}


def coder_for(rank_file: bytes, pattern: str) -> ByteBPE:
    key = (hash(rank_file), pattern)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = ByteBPE(rank_file, pattern)
    return _CODERS[key]


def forget() -> None:
    """Drop the tables and pieces of this worker."""
    for bpe in _CODERS.values():
        bpe.pieces.clear()
        bpe.starts.clear()
    _CODERS.clear()


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", keep: list[str] | None = None,
                  with_ids: bool = False, with_decoded: bool = False, remember: bool = True) -> DataFrame:
    """Encode every whole text and decode its ids again.

    Returns ``keep`` columns (default: the id), ``n_tokens``, ``ids_sha256``
    (of the comma-joined ids), ``decoded_sha256``; with ``with_ids`` the ids as
    ``token_ids array<int>``, with ``with_decoded`` the decoded text.  Pieces are
    remembered for the worker's next task unless ``remember`` is false, which
    leaves the memory to other operators between tasks.
    """
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = keep if keep is not None else [id_col]
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)], text_of(text_col).alias("t"))
    kinds = [rows.schema[f"k{i}"].dataType.simpleString() for i in range(len(kept))]
    ddl = ", ".join([f"k{i} {k}" for i, k in enumerate(kinds)]
                    + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
                    + ["token_ids array<int>"] * with_ids + ["decoded string"] * with_decoded)
    n_kept = len(kept)

    def make():
        bpe, sha = coder_for(ranks.value, pattern), hashlib.sha256

        def fn(batch):
            out = {f"k{i}": one(batch.column(i)) for i in range(n_kept)}
            count, coded, plain, lists, texts = [], [], [], [], []
            for t in one(batch.column(n_kept)).to_pylist():
                ids = bpe.ids(t)
                joined = ",".join(ids)
                raw = bpe.decode(joined)
                count.append(joined.count(",") + 1 if joined else 0)
                coded.append(sha(joined.encode("ascii")).hexdigest())
                plain.append(sha(raw).hexdigest())
                if with_ids:
                    lists.append(np.fromstring(joined, np.int32, sep=",") if joined else [])
                if with_decoded:
                    texts.append(raw.decode("utf-8"))
            return out | {"n_tokens": count, "ids_sha256": coded, "decoded_sha256": plain,
                          "token_ids": lists, "decoded": texts}
        if not remember:
            fn.finish = forget
        return fn

    out = map_batches(rows, ddl, make)
    for i, c in enumerate(kept):
        out = out.withColumnRenamed(f"k{i}", c)
    return out
