"""Encoding and token counts against the libraries."""

import hashlib

import numpy as np
import public_tokenizers as vocabularies
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from worklode.llm import piece_bpe, token_counts
from worklode.llm.queries import PIECES, QUERIES

SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
ENCODER = piece_bpe.Encoder(piece_bpe.read_vocabulary(PIECES))


def check(text):
    ids = np.frombuffer(ENCODER.encode(text), "<u4").tolist()
    assert ids == SP.encode(text)
    whole = [1, *ids, 2]
    assert ENCODER.decode(whole) == SP.decode(whole)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([p for i, p in enumerate(ENCODER.v.pieces) if ENCODER.v.normal[i]]), max_size=8))
def test_texts_of_pieces(pieces):
    check("".join(pieces))


@pytest.mark.parametrize("text", ["", " ", "  ", "a  b", " a ", "▁a", "<s>x</s>", "\0\n\t", "a" * 4000, " " * 500, "ab" * 2000, "é😀中"])
def test_odd_texts(text):
    check(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=12))
def test_decoding_any_ids(ids):
    assert ENCODER.decode(ids) == SP.decode(ids)


def test_merging_is_what_the_check_undoes():
    v = ENCODER.v
    order = {i: int(v.rank[i]) for i in np.flatnonzero(v.normal).tolist()}
    rng = np.random.default_rng(1)
    usable = np.flatnonzero(v.normal)
    for a, b in rng.choice(usable, (300, 2)).tolist():
        parts, _ = piece_bpe.merged(v.pieces[a] + v.pieces[b], ENCODER.ids, order)
        assert ENCODER._apart(a, b) == (parts == [v.pieces[a], v.pieces[b]])


def test_documents(docs, no_docs):
    got = piece_bpe.round_trip(docs, PIECES).collect()
    want = []
    for r in docs.collect():
        ids = [1, *SP.encode(r.text or ""), 2]
        packed = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(SP.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in got)
    assert all(r.exact for r in got)
    full = piece_bpe.encode_documents(docs, PIECES, decoded=True).collect()
    assert all(r.exact and r.n_tokens == len(r.ids) for r in full)
    assert piece_bpe.round_trip(no_docs, PIECES).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts(spark, docs, no_docs, name):
    path = vocabularies.path(name)
    extra = spark.createDataFrame([(20, "x <s> <|endoftext|> y\n\nz"), (21, "  two  spaces ")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra)
    library = Tokenizer.from_file(path) if name.endswith("json") else SP
    count = (lambda t: len(library.encode(t, add_special_tokens=False))) if name.endswith("json") else (lambda t: len(SP.encode(t)))
    want = sorted(str((r.doc_id, len((r.text or "").encode()), count(r.text or ""))) for r in rows.collect())
    got = token_counts.count_tokens(rows, path, limit=10).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_tokens)) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 10) for r in got)
    assert token_counts.count_tokens(no_docs, path).count() == 0


def test_many_parts_are_merged(docs):
    words = token_counts.frequent_pretokens(docs.repartition(40), PIECES)
    assert {"sat", "the"} <= set(words)


def test_queries(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op10_sentencepiece"](spark, sf).collect():
        assert r.n_tokens == len(SP.encode(texts[r.doc_id])) + 2
    for r in QUERIES["op7_token_counts"](spark, sf).collect():
        assert r.n_tokens == len(SP.encode(texts[r.doc_id]))


@pytest.mark.parametrize("text", ["ʄ", "hello ʄ world", "日本語龘", "aʄ", "ʄa", "aʄb ʄ. b龘龘c龘", "Straßeʄ, naïveʄʄ!"])
def test_letters_outside_the_vocabulary(text):
    check(text)
