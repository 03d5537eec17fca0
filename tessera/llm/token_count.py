"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as a linked list of byte symbols.  A heap holds the ranks
of its adjacent pairs; the lowest rank (leftmost first) is popped, its two
nodes become one, and the two new neighbour pairs are pushed.  Entries whose
pair has changed meanwhile are skipped.  No identifiers are produced: the
count is the number of initial symbols minus the number of merges.

Tokenizer: a ``tokenizers`` JSON of kind BPE with word ends (lower case, white
space dropped).  Counts equal ``encode(text, add_special_tokens=False)``:
special strings inside a text count one token each, as its default is.

Defined cases: NULL or empty text counts 0 tokens and 0 bytes; repeated rows
give one row each; NULL ids are kept; other columns are ignored; an empty
table gives an empty result; a text of any length is counted whole.
"""
from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, one, text_of

#: white-space separated pieces kept per Python worker; then the memory is cleared
CACHE_PIECES = 1_000_000

# fixed values: the tokenizer file's own split pattern, \s spelled as White_Space
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


class PairCounter:
    """Counts tokens of pre-tokens and of whole texts for one vocabulary file."""

    def __init__(self, tokenizer_json: str):
        import regex
        spec = json.loads(tokenizer_json)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + suffix] for c in letters]
        self.rank, self.made = {}, []
        for r, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[a] << 20 | vocab[b], r)
            self.made.append(vocab[a + b])
        self.find = regex.compile(PATTERN).findall
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.mark = special[0][0] if special else ""
        if any(s[0] != self.mark for s in special):
            self.mark = ""
        self.pieces = _Pieces(self)

    def merges_of(self, symbols: list[int]) -> int:
        """Number of merges the heap performs on one list of symbols (changed in place)."""
        n, rank, made = len(symbols), self.rank, self.made
        get = rank.get
        heap = []
        for i in range(n - 1):
            r = get(symbols[i] << 20 | symbols[i + 1])
            if r is not None:
                heap.append(r << 32 | i)
        if not heap:
            return 0
        heapq.heapify(heap)
        push, pop = heapq.heappush, heapq.heappop
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merged = 0
        while heap:
            top = pop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            a, j = symbols[i], after[i]
            if a < 0 or j >= n or get(a << 20 | symbols[j]) != r:
                continue  # the pair this entry spoke of is gone
            c = made[r]
            symbols[i], symbols[j] = c, -1
            k = after[i] = after[j]
            merged += 1
            if k < n:
                before[k] = i
                r = get(c << 20 | symbols[k])
                if r is not None:
                    push(heap, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = get(symbols[h] << 20 | c)
                if r is not None:
                    push(heap, r << 32 | h)
        return merged

    def word(self, word: str) -> int:
        """Tokens of one lower-case pre-token."""
        raw = word.encode("utf-8")
        inner = self.inner
        symbols = [inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        return len(raw) - self.merges_of(symbols)

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text.isascii():
            # one letter at a time: a final capital sigma is no special case
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        pieces = self.pieces
        if text.isalpha():
            return pieces.of_word(text)
        if text and text[-1] in ".,;:!?" and text[:-1].isalpha():
            return pieces.of_word(text[:-1]) + 1
        return sum([pieces.of_word(w) if w.isalpha() else self.word(w) for w in self.find(text)])

    def piece(self, text: str) -> int:
        if self.special is None or self.mark not in text:
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1

    def count(self, text: str) -> int:
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self.piece(text)  # str.split parts at these, the pattern does not
        # no match crosses white space, so white-space separated pieces add up
        return sum(map(self.pieces.__getitem__, text.split()))


class _Pieces(dict):
    """Counts of recent pieces and words; bounded, cleared when full."""

    def __init__(self, counter: PairCounter):
        super().__init__()
        self.counter = counter

    def put(self, piece: str, n: int) -> int:
        if len(piece) <= 64:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = n
        return n

    def of_word(self, word: str) -> int:
        """``word``: letters, lower case and normalised, so it is a piece as well."""
        n = self.get(word)
        return self.put(word, self.counter.word(word)) if n is None else n

    def __missing__(self, piece: str) -> int:
        return self.put(piece, self.counter.piece(piece))


_COUNTERS: dict[int, PairCounter] = {}


def counter_for(tokenizer_json: str) -> PairCounter:
    key = hash(tokenizer_json)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PairCounter(tokenizer_json)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row.

    The vocabulary file (bounded: the tokenizer's own size) is read on the
    driver and broadcast, so executors need no local copy of it.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def make():
        count = counter_for(spec.value).count

        def fn(batch):
            texts = one(batch.column(1))
            return {"id": one(batch.column(0)), "n_bytes": pc.binary_length(texts),
                    "n_tokens": [count(t) for t in texts.to_pylist()]}
        return fn

    return map_batches(rows, f"id {id_type}, n_bytes long, n_tokens long", make).withColumnRenamed("id", id_col)
