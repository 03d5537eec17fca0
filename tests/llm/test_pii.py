"""Base patterns against the plain expressions of the contract, and the added
terms against a count by hand."""
import hashlib
import math
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from tessera.llm import pii
from tessera.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@pytest.mark.parametrize("text", ["a@b@c.de", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "1.2.3.4.5.6.7", "999.1.1.1 x 01.002.3.4", "@x.y a.@b-.c. ..@-.-",
                                  "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111", "++44 (0) 20.7946-0958x +1 +12", "٣.٣.٣.٣ é@ü.de x@y.zé",
                                  "12.34.5.6@host.org", "a" * 5000 + "@", "1" * 20000, "1." * 3000, "@" * 3000])
def test_base_patterns(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aZ09.%+-@ ()é\n", max_size=40))
def test_any_text(text):
    assert pii.base_spans(text) == plain(text)


def corpus():
    docs = [(i, f"filler{'abcdefghijklmnop'[i % 16]} words {'qrstuvwxyz'[i % 10]}{'klmno'[i % 5]}thing go here") for i in range(900)]
    for i, extra in enumerate(["north", "south", "eastern", "western"]):  # four different surroundings
        docs.append((1000 + i, f"{extra} gate asks Krzysztofa at kk@x.org about {extra} things"))
    docs += [(2000 + i, "the very same Zbigniewa copy zz@x.org here") for i in range(50)]  # one surrounding, many copies
    docs += [(3000, "Krzysztofa was seen without the address"), (3001, None), (3002, ""), (None, "reach kk@x.org")]
    return docs + [(3000, "Krzysztofa was seen without the address")]


def by_hand(docs):
    beside, ctx, within, held = defaultdict(int), defaultdict(set), defaultdict(int), defaultdict(int)
    for _, t in docs:
        t = t or ""
        spans = plain(t)
        for w in set(re.findall(r"[^\W\d_]{4,}", t.lower())):
            within[w] += 1
        seen = set()
        for s, k, e in spans:
            name = t[s:e].lower()
            seen.add((name, None))
            near = tuple(sorted(set(re.findall(r"[^\W\d_]{4,}", " ".join(t[:s].split()[-8:] + t[e:].split()[:8]).lower()))))
            for w in near:
                seen.add((name, w))
                ctx[name, w].add(near)
        for name, w in seen:
            if w is None:
                held[name] += 1
            else:
                beside[name, w] += 1
    out = {}
    for (name, w), n in beside.items():
        p = n / within[w]
        if len(ctx[name, w]) >= 3 and p >= 0.5 and math.log2(p * len(docs) / held[name]) >= 6:
            out[w] = max(p, out.get(w, 0))
    return out


def test_terms_by_hand(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.term: r.disclosure for r in pii.disclosing_terms(df.selectExpr("coalesce(text, '') text")).collect()}
    assert got == pytest.approx(by_hand(docs)) and "krzysztofa" in got and "zbigniewa" not in got
    rows = pii.report(df.repartition(5)).collect()
    assert len(rows) == len(docs)
    seen = [r for r in rows if r.doc_id == 3000]
    assert [r.spans for r in seen] == ["term:0:10"] * 2 and [r.n_added for r in seen] == [1, 1]
    assert [r.spans for r in rows if r.doc_id == 3001] == [""]


def test_sanitise_keeps_rows_and_columns(spark):
    schema = T.StructType.fromDDL("doc_id long, text string, base string, k0 int, added double")
    rows = [(d, t, "b", 1, 0.5) for d, t in corpus()]
    df = spark.createDataFrame(rows, schema)
    out = pii.sanitise(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows) and all(r.base == "b" and r.k0 == 1 and r.added == 0.5 for r in got)
    by = {r.doc_id: r.text for r in got}
    assert by[None] == "reach [EMAIL]" and by[3001] is None and by[3002] == "" and by[5] == dict(corpus())[5]
    assert by[3000].startswith((" was", "[TERM] was")) and "Krzysztofa" not in by[1000]
    assert pii.report(df.limit(0)).count() == 0


def test_redact_overlaps():
    assert pii.redact("call +1 234 567 890 now", [{"s": 5, "k": 3, "e": 19}, {"s": 6, "k": 2, "e": 10}], []) == "call [PHONE] now"


def test_query_base_by_plain_patterns(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in spans) for k in range(4)]
        assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == [x for x in pii.joined(spans).split(",") if x]
