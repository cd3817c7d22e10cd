"""SentencePiece encoding against the library, and memories that rotate."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import byte_bpe, piece_bpe, token_counts
from ledgerloom.llm.common import Recent, worker_memory
from tests.llm.conftest import EDGE

MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return piece_bpe.PieceBpe(MODEL)


def encoded(coder, text):
    return [int(i) for _, decimals, _ in coder.encode_batch([text])[0] for i in decimals.split()]


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from([
    " ", "  ", "▁", "\n", "\t", "a", "b", "the", "ing", "er", "=", "==", "é", "é", "中", "😀", "\x00", "1", " ", "ram", "skill",
    "х", "{", " " * 17, " " * 50, "</s>", "<0x41>", "tion", "David"]), max_size=40).map("".join))
def test_ids_and_text_are_those_of_the_library(coder, text):
    ids = LIBRARY.encode(text)
    assert encoded(coder, text) == ids
    assert coder.decode([*ids, 2]) == LIBRARY.decode([*ids, 2])


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(coder, text):
    assert encoded(coder, text) == LIBRARY.encode(text)


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.integers(0, 31999), max_size=30))
def test_any_ids_decode(coder, ids):
    shown = [i for i in ids if i != 0]  # the unknown id never comes from encoding
    assert coder.decode(shown) == LIBRARY.decode(shown)


@pytest.mark.parametrize("text", [" " * 40_000 + "the end", "=" * 9_999, "中文" * 9_000, "ab3" * 20_000, "skill" * 5_000])
def test_long_words(coder, text):
    assert encoded(coder, text) == LIBRARY.encode(text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pieces_edges(spark, edge):
    got = sorted(map(tuple, piece_bpe.encode_pieces(edge, MODEL).collect()), key=repr)
    want = []
    for i, text, _ in EDGE:
        ids = [*LIBRARY.encode(text or ""), 2]
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids)), ids))
    assert got == sorted(want, key=repr)
    assert piece_bpe.encode_pieces(edge.limit(0), MODEL).count() == 0
    back = piece_bpe.decode_pieces(piece_bpe.encode_pieces(edge, MODEL), MODEL)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr((i, t or "")) for i, t, _ in EDGE)


def test_pieces_of_documents(spark, documents):
    got = {r.doc_id: r for r in piece_bpe.encode_pieces(documents, MODEL, keep_ids=False, memory=50).collect()}
    for r in documents.select("doc_id", "text").collect():
        ids = [*LIBRARY.encode(r.text or ""), 2]
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert got[r.doc_id].decoded_sha256 == sha(LIBRARY.decode(ids))


def test_other_models_are_refused(tmp_path):
    with pytest.raises((ValueError, OSError, RuntimeError)):
        piece_bpe.PieceBpe(JSON)


def test_what_a_memory_finds_outlives_its_rotation():
    memory = Recent(3)
    memory.learn({k: k.upper() for k in "abcdefg"})
    found, new = memory.known(set("abefgxyz"))
    memory.learn({k: k.upper() for k in "xyz"})
    assert all(found[k] == k.upper() for k in found)
    assert found.keys() | new == set("abefgxyz") and {"e", "f", "g"} <= found.keys()


def test_counts_and_ids_with_a_tiny_memory(spark, documents, monkeypatch):
    monkeypatch.setattr(token_counts, "TEXT_BYTES", 500)
    monkeypatch.setattr(token_counts, "MEMORY", 3)
    library = Tokenizer.from_file(JSON)
    want = sorted((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in documents.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts.token_counts(documents, JSON).collect()) == want
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    few = byte_bpe.encode_texts(documents, ranks, public_tokenizers.PATTERN, memory=3)
    many = byte_bpe.encode_texts(documents, ranks, public_tokenizers.PATTERN)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    worker_memory().clear()
