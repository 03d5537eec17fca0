"""Token counts and byte-level BPE against the libraries they must equal."""
import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tessera.llm import byte_bpe, token_count
from tessera.llm.queries import QUERIES

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
HARD = ["", " ", "a", "Hello  World\n\n x", "don't we'll THEY'RE", "ΣΣ ΑΣ", "é Å İ", "x\x1cy\x1f z\x85w",
        "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "\ttab\r\nline  wide nbsp", "aaaaaaaaaaaaaaa aaaa", "\U0001f600\U0001f468‍\U0001f469 中文 123²½",
        "end. \nStart", "trail ", " lead", "a\n b", "word" * 400, "$$$ %%% ___", "नमस्ते สวัสดี"]


@pytest.fixture(scope="module")
def lib():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return (tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}),
            Tokenizer.from_file(WORDS),
            byte_bpe.ByteBPE(open(RANKS, "rb").read(), P.PATTERN),
            token_count.PairCounter(open(WORDS, encoding="utf-8").read()))


def flat(ids):
    return [int(x) for s in ids for x in s.split(",")]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(lib, text):
    enc, tok, bpe, counter = lib
    ids = bpe.ids(text)
    assert flat(ids) == enc.encode_ordinary(text)
    assert bpe.decode(",".join(ids)).decode() == text
    assert counter.count(text) == len(tok.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs", "Cn", "Co"], max_codepoint=0x2FFF), st.sampled_from(" \n\t'abcdeinrst.<|>")), max_size=60))
def test_any_text(lib, text):
    enc, tok, bpe, counter = lib
    ids = bpe.ids(text)
    assert flat(ids) == enc.encode_ordinary(text)
    assert bpe.decode(",".join(ids)).decode() == text
    assert counter.count(text) == len(tok.encode(text, add_special_tokens=False).ids)


def test_very_long_pretoken(lib):
    enc, tok, bpe, counter = lib
    text = "thander" * 3000
    assert flat(bpe.ids(text)) == enc.encode_ordinary(text)
    assert counter.count(text) == len(tok.encode(text, add_special_tokens=False).ids)


def test_queue_is_empty_afterwards(lib):
    bpe = lib[2]
    bpe.encode_word(b"thethethexthaanderons" * 40)
    assert not any(bpe.low) and not any(bpe.mid)


def test_matches_without_a_space_are_encoded_once():
    bpe, coded = byte_bpe.ByteBPE(open(RANKS, "rb").read(), P.PATTERN), []
    plain = bpe.encode_word
    bpe.encode_word = lambda piece: coded.append(piece) or plain(piece)
    first, again = bpe.ids("Thander\n$$$ on.\nThander"), bpe.ids("Thander\n$$$ on.\nThander")
    assert first == again
    assert sorted(coded) == sorted(set(coded))


def test_words_in_use_outlive_a_full_store(lib, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 4)
    bpe, coded = byte_bpe.ByteBPE(open(RANKS, "rb").read(), P.PATTERN), []
    plain = bpe.encode_word
    bpe.encode_word = lambda piece: coded.append(piece) or plain(piece)
    for c in "abcdefghijklmnopqrstuvw":
        text = f"x thander q{c}zq{c}z thander. thanderx, {c}9{c}"
        assert flat(bpe.ids(text)) == lib[0].encode_ordinary(text)
        assert len(bpe.pieces) <= 4 and len(bpe.pieces.old) <= 4
    assert coded.count(b" thander") == coded.count(b" thanderx") == 1
    bpe.pieces.clear()
    assert not bpe.pieces and not bpe.pieces.old


def test_rows_kept(spark):
    schema = T.StructType.fromDDL("doc_id long, text string, n_tokens string, id int")
    df = spark.createDataFrame([(1, None, "x", 1), (None, "a b", "y", 2), (2, "dup", None, 3), (2, "dup", None, 3)], schema)
    out = token_count.count_tokens(df, WORDS).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in out] == [(None, 3, 2), (1, 0, 0), (2, 3, 1), (2, 3, 1)]
    enc = byte_bpe.encode_decode(df, RANKS, P.PATTERN, with_ids=True, with_decoded=True).orderBy("doc_id").collect()
    assert [r.decoded for r in enc] == ["a b", "", "dup", "dup"]
    assert enc[1].ids_sha256 == hashlib.sha256(b"").hexdigest() and enc[1].token_ids == []
    assert token_count.count_tokens(df.limit(0), WORDS).count() == 0
    assert byte_bpe.encode_decode(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_queries_equal_libraries(spark, lib, sf_dir):
    enc, tok, _, _ = lib
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(tok.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(docs[r.doc_id].encode()), n > 2048)
    rows = QUERIES["op9_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids, raw = enc.encode_ordinary(docs[r.doc_id]), docs[r.doc_id].encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()
