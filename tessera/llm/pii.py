"""Personal data: fixed patterns, and terms that give protected entities away.

The patterns find e-mail and IP addresses, card and phone numbers.  Each
matched value is a protected entity.  The terms (letters, four or more) within
``WINDOW`` words of its mentions are counted with it over the whole corpus; for
a term t and an entity e the disclosure is

    p(e | t) = documents with t beside e / documents with t,

and the information a reader gains is log2(p(e | t) / p(e)) bits.  A term that
is seen beside e in ``MIN_CONTEXTS`` different surroundings (copies of one text
are one surrounding), gains ``MIN_BITS`` or more, and whose disclosure reaches
``GENERALISE_AT`` is replaced by a general word for it; from ``REMOVE_AT`` on it
is removed.  Every occurrence of such a term in any document counts.

All counts are grouped sums with partial aggregation.  The table of disclosing
terms is never broadcast: tasks get a bitmap of their checksums, of a fixed
512 KB, and what passes it is joined with the table itself.

Defined cases: NULL or empty text has no spans; repeated rows give one row
each; NULL ids are kept; other columns are ignored; an empty table gives an
empty result; offsets are code points of the whole text, ends exclusive.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, as_batch, cut, map_batches, one, text_of

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 8
MIN_CONTEXTS = 3
MIN_BITS = 6.0
GENERALISE_AT = 0.5
REMOVE_AT = 0.8
BITMAP_BITS = 22
#: distinct terms a task counts before it hands partial counts on
FLUSH_TERMS = 400_000

# fixed values: the patterns of the contract; possessive where nothing can be given back
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{4,}")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @, dotted domain.

    A local part can't hold an @, so a match is an @ with a domain behind it
    and the longest run of local letters before it, up to the last match.
    """
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        begin = at
        if m:
            while begin > floor and text[begin - 1] in _LOCAL:
                begin -= 1
        if m and begin < at:
            out.append((begin, m.end()))
            floor = m.end()
            at = text.find("@", floor)
        else:
            at = text.find("@", at + 1)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text)
            if all(len(p) <= 400 and int(p) <= 255 for p in m[0].split("."))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if len(m[0]) >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        out += [(s, 1, e) for s, e in ips(text)]
        out += [(s, 2, e) for s, e in cards(text)]
        out += [(s, 3, e) for s, e in phones(text)]
    out.sort()
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def entity(kind: int, value: str) -> str:
    """What makes two mentions one entity."""
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else ''.join(filter(str.isdigit, value))}"


def contexts(text: str, spans) -> list[tuple[str, str, int]]:
    """(entity, term, checksum of the surroundings) around every mention, and
    (entity, "", 0) for the entity itself."""
    out, parts, at = [], [], 0
    for s, _, e in spans:  # mentions themselves are no terms
        if e > at:
            parts += [text[at:max(at, s)], " " * (e - max(at, s))]
            at = e
    plain = "".join([*parts, text[at:]])
    for s, k, e in spans:
        name = entity(k, text[s:e])
        before, after, width = [], [], 32 * WINDOW
        while len(before) <= WINDOW:  # one word more than needed: the first may be cut
            before = plain[max(0, s - width):s].split()
            if width >= s:
                break
            width *= 4
        width = 32 * WINDOW
        while len(after) <= WINDOW:
            after = plain[e:e + width].split()
            if e + width >= len(plain):
                break
            width *= 4
        near = " ".join(before[-WINDOW:] + ["|"] + after[:WINDOW]).lower()
        terms = sorted(set(_TERM.findall(near)))
        mark = zlib.crc32(" ".join(terms).encode())
        out.append((name, "", 0))
        out += [(name, t, mark) for t in terms]
    return out


def disclosing_terms(texts: DataFrame) -> DataFrame:
    """(term, disclosure) over all rows of one column ``text``."""
    ddl = "entity string, term string, mark long, n long"
    schema = arrow_schema(ddl)

    def count(batches):
        seen: Counter = Counter()

        def flush():
            terms = list(seen)
            for i in range(0, len(terms), 50_000):
                part = terms[i:i + 50_000]
                yield as_batch({"entity": pa.nulls(len(part), pa.string()), "term": part,
                                "mark": pa.nulls(len(part), pa.int64()), "n": [seen[t] for t in part]}, schema)
            seen.clear()

        for batch in batches:
            pairs: Counter = Counter()
            for text in one(batch.column(0)).to_pylist():
                spans = base_spans(text)
                if spans:
                    found = set(contexts(text, spans))
                    pairs.update(found)
                seen.update(set(_TERM.findall(text.lower())))
                if len(seen) >= FLUSH_TERMS:
                    yield from flush()
            if pairs:
                keys = list(pairs)
                yield as_batch({"entity": [k[0] for k in keys], "term": [k[1] for k in keys],
                                "mark": [k[2] for k in keys], "n": [pairs[k] for k in keys]}, schema)
        yield from flush()

    counted = cut(texts.mapInArrow(count, ddl).groupBy("entity", "term", "mark").agg(F.sum("n").alias("n")), "pii-counts")
    pairs = counted.where(F.col("entity").isNotNull())
    held = pairs.where(F.col("term") == "").select("entity", F.col("n").alias("holders"))
    beside = (pairs.where(F.col("term") != "").groupBy("entity", "term")
              .agg(F.sum("n").alias("beside"), F.count("*").alias("contexts")).where(F.col("contexts") >= MIN_CONTEXTS))
    within = counted.where(F.col("entity").isNull()).select("term", F.col("n").alias("docs"))
    rows = max(texts.count(), 1)
    disclosure = F.least(F.lit(1.0), F.col("beside") / F.col("docs"))
    return (beside.join(within, "term").join(held, "entity")
            .withColumn("disclosure", disclosure)
            .withColumn("bits", F.log2(F.col("disclosure") * F.lit(rows) / F.col("holders")))
            .where((F.col("disclosure") >= GENERALISE_AT) & (F.col("bits") >= MIN_BITS))
            .groupBy("term").agg(F.max("disclosure").alias("disclosure")))


def bitmap_of(terms: DataFrame) -> np.ndarray:
    """Checksums of the terms as a bitmap of fixed size."""
    at = F.crc32(F.col("term").cast("binary")).bitwiseAND((1 << BITMAP_BITS) - 1)
    words = (terms.select(F.shiftright(at, 5).alias("w"), F.expr("shiftleft(1L, cast(crc32(cast(term as binary)) & 31 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for r in words.collect():  # at most 2^17 words whatever the number of terms
        out[r.w] = r.b
    return out


def find(docs: DataFrame, text_col: str, kept: list[str]) -> DataFrame:
    """Spans of every row: the columns ``kept`` as k0, k1, ..., the arrays
    ``base`` of (s, k, e) and ``added`` of (s, e, disclosure), by start."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)], text_of(text_col).alias("t"))
    terms = cut(disclosing_terms(rows.select(F.col("t").alias("text"))), "pii-terms")
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(bitmap_of(terms))
    span = "array<struct<s:int,k:int,e:int>>"
    kinds = [rows.schema[f"k{i}"].dataType.simpleString() for i in range(len(kept))]
    ddl = ", ".join([f"k{i} {k}" for i, k in enumerate(kinds)] + [f"base {span}", "hits array<struct<term:string,s:int,e:int>>"])
    n_kept = len(kept)

    def make():
        bitmap, mask = shared.value, (1 << BITMAP_BITS) - 1
        some = bool(bitmap.any())

        def passes(term):
            h = zlib.crc32(term.encode())
            return int(bitmap[(h & mask) >> 5]) >> (h & 31) & 1

        def fn(batch):
            base, hits = [], []
            for text in one(batch.column(n_kept)).to_pylist():
                spans = base_spans(text)
                base.append([{"s": s, "k": k, "e": e} for s, k, e in spans])
                near = []
                if some:
                    low = text.lower()
                    if len(low) != len(text):  # a letter that lower-cases to two: offsets would shift
                        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
                    wanted = {t for t in set(_TERM.findall(low)) if passes(t)}
                    if wanted:
                        near = [{"term": m[0], "s": m.start(), "e": m.end()} for m in _TERM.finditer(low)
                                if m[0] in wanted and not any(s < m.end() and m.start() < e for s, _, e in spans)]
                hits.append(near)
            return {f"k{i}": one(batch.column(i)) for i in range(n_kept)} | {"base": base, "hits": hits}
        return fn

    found = cut(map_batches(rows, ddl, make).withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    hit = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    added = (hit.join(terms, "term").groupBy("row")
             .agg(F.sort_array(F.collect_list(F.struct("s", "e", "disclosure"))).alias("added")))
    return found.join(added, "row", "left").select(
        *[f"k{i}" for i in range(n_kept)], "base",
        F.coalesce("added", F.expr("cast(array() as array<struct<s:int,e:int,disclosure:double>>)")).alias("added"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans, per row."""
    found = find(docs, text_col, [id_col])
    id_type = found.schema["k0"].dataType.simpleString()
    ddl = f"id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def make():
        def fn(batch):
            out = {"id": one(batch.column(0)), **{f"n_{k}": [] for k in KINDS[:4]}, "base_sha256": [], "spans": [], "n_added": []}
            for base, added in zip(one(batch.column(1)).to_pylist(), one(batch.column(2)).to_pylist(), strict=True):
                spans = [(b["s"], b["k"], b["e"]) for b in base]
                for i, k in enumerate(KINDS[:4]):
                    out[f"n_{k}"].append(sum(x[1] == i for x in spans))
                out["base_sha256"].append(hashlib.sha256(joined(spans).encode()).hexdigest())
                out["spans"].append(joined(sorted(spans + [(a["s"], 4, a["e"]) for a in added])))
                out["n_added"].append(len(added))
            return out
        return fn

    return map_batches(found, ddl, make).withColumnRenamed("id", id_col)


def redact(text: str, base, added) -> str:
    """The text with its entities and disclosing terms taken out.

    Overlapping spans become one; an entity leaves its kind in brackets, a
    generalised term leaves ``[TERM]``, a removed term leaves nothing.
    """
    marks = sorted([(b["s"], b["e"], f"[{KINDS[b['k']].upper()}]") for b in base]
                   + [(a["s"], a["e"], "" if a["disclosure"] >= REMOVE_AT else "[TERM]") for a in added])
    out, at, end = [], 0, -1
    for s, e, mark in marks:
        if s >= end:
            out += [text[at:s], mark]
        end = at = max(end, e)
    return "".join([*out, text[at:]]) if marks else text


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, with personal data taken out of the text.

    Text without spans is passed on as it is (also NULL).
    """
    cols = docs.columns
    at = cols.index(text_col)
    sent = find(docs, text_col, cols)
    ddl = ", ".join(f"k{i} {sent.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(cols)))

    def make():
        def fn(batch):
            out = {f"k{i}": one(batch.column(i)) for i in range(len(cols))}
            texts = out[f"k{at}"].to_pylist()
            both = zip(texts, one(batch.column(len(cols))).to_pylist(), one(batch.column(len(cols) + 1)).to_pylist(), strict=True)
            return out | {f"k{at}": [t if t is None else redact(t, b, a) for t, b, a in both]}
        return fn

    return map_batches(sent, ddl, make).toDF(*cols)
