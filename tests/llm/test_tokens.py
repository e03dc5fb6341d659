"""BPE and token counts against the library."""

import hashlib

import pytest

pytest.importorskip("runatlas.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from runatlas.llm import token_counts
from runatlas.llm.word_bpe import WordBpe, encode_documents

WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
BYTE_PATH = public_tokenizers.path("byte_bpe_50k.json")
OURS, LIBRARY = WordBpe(WORD_PATH), Tokenizer.from_file(WORD_PATH)
COUNTER, BYTES = token_counts.WordCounter(BYTE_PATH), Tokenizer.from_file(BYTE_PATH)
PIECES = ["hello", "World", "'S", "'re", "é", "ñÑ", "Σς", "İ", "中文", " ", "\n\n", "\t", "\x1c", "\x85", "123", "½", "...", "<|endoftext|>", "<|startoftext|>", "<|endof", "<|EndOfText|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "😀", "Å", "Å"]
texts = st.one_of(st.text(max_size=40), st.lists(st.sampled_from(PIECES), max_size=15).map("".join))


@settings(max_examples=300, deadline=None)
@given(texts)
def test_encoding_and_decoding_equal_the_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OURS.encode(text) == ids
    assert OURS.written(text) == " ".join(map(str, ids))
    assert OURS.decode(ids) == OURS.read(OURS.written(text)) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_word_counts_equal_the_library(text):
    words = COUNTER.words(text)
    assert "".join(words) == text
    assert sum(COUNTER.counts(words)) == len(BYTES.encode(text, add_special_tokens=False).ids)


def test_long_words_merge_like_the_library():
    for word in ("a" * 3000, "abcab" * 500, "é" * 700):
        assert OURS.encode(word) == LIBRARY.encode(word, add_special_tokens=False).ids


def test_every_character_is_classed_as_in_the_library():
    shown = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for beside in "a!":
        texts = [beside + c + beside for c in shown]
        assert [t for t, e in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False), strict=True) if OURS.encode(t) != e.ids] == []


def test_encoded_rows(spark):
    rows = [(1, "Hello  World's end", "a"), (2, None, "b"), (2, None, "b"), (3, "", "c"), (None, "x", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = encode_documents(docs, WORD_PATH).collect()
    assert len(found) == 5
    for row in found:
        text = {1: rows[0][1], 2: "", 3: "", None: "x"}[row.doc_id]
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert (row.n_tokens, row.ids) == (len(ids), ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert encode_documents(docs.limit(0), WORD_PATH).count() == 0


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 512), (900, 40), (300, 20)])
def test_spliced_counts_equal_the_library(spark, chunk, overlap):
    texts = ["a" * 4000, "<|endoftext|>" * 400, None, "", " " * 3000 + "x" * 2000, "it's\n\n 12 " * 600, "é中 , " * 900]
    rows = [(k, t, "k") for k, t in enumerate(texts)] + [(4, texts[4], "k"), (None, "x y", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    found = token_counts.count_tokens(docs, BYTE_PATH, chunk=chunk, overlap=overlap, limit=500).collect()
    want = [(i, len((t or "").encode()), len(BYTES.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    assert sorted((tuple(r)[:3] for r in found), key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 500) for r in found)
    assert token_counts.count_tokens(docs.limit(0), BYTE_PATH).count() == 0


def test_piece_models_are_counted_whole(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "Hello there"), (2, None)], "doc_id long, text string")
    want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode("Hello there"))
    assert {(r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, path).collect()} == {(1, want), (2, 0)}
