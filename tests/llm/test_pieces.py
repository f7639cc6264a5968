"""Piece codes against the sentencepiece library and against merging itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyworks.llm import piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "   a", "a  b   c", "hello world\n\nx\t1 234", "▁x ▁", "<s>a</s><unk><0x0A>", "日本語テキスト😀😀 é", "a" * 9000, " " * 3000, "\x00\x01x", "ab" * 5000 + "xyz", "\r\n"]


@pytest.fixture(scope="module")
def codec():
    return piece_bpe.Codec(piece_bpe.read_model(PATH))


def agrees(codec, text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    got = codec.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert codec.decode(got) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library(codec, text):
    agrees(codec, text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcdehilnorstAB  ▁\n\téßΣ日の😀.,!?13-_/='", max_size=60))
def test_random_texts_as_the_library(codec, text):
    agrees(codec, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 260)), max_size=9))
def test_any_ids_decode_as_the_library(codec, ids):
    assert codec.decode(np.array(ids, "<u4").tobytes()) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("ab", min_size=2, max_size=5), st.integers(-6, 0).map(float), max_size=12), st.text("ab", min_size=1, max_size=40))
def test_backtracking_is_merging(scores, text):
    encoder = piece_bpe.Encoder(scores | {"a": -9.0, "b": -9.0})
    assert encoder.encode(text) == encoder.merged(text)


def test_failed_places_are_left_once_and_windows_are_bounded(codec):
    text = "ab" * 30000
    found = piece_bpe.Matches(codec.stretches.encoder.automaton, text, codec.stretches.encoder.reach)
    direct = found.of(0, len(text))
    assert all(found[i] == direct[i] for i in range(0, len(text), 611)) and len(found.windows) <= piece_bpe.WINDOWS
    assert "".join(codec.stretches.encoder.encode(text)) == text


def test_table_with_odd_rows(spark):
    rnd = random.Random(3)
    rows = [(1, None), (1, "twice"), (1, "twice"), (None, "no id"), *[(i, t) for i, t in enumerate(ODD)], (99, "".join(rnd.choice("abc d") for _ in range(200_000)))]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, k0 string, t string")
    got = piece_bpe.encode_documents(docs, PATH, outputs=("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")).collect()

    def want(i, t):
        ids = LIBRARY.encode(t or "", add_bos=True, add_eos=True)
        text = LIBRARY.decode(ids)
        return (i, len(ids), ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text, hashlib.sha256(text.encode()).hexdigest())

    assert sorted(map(tuple, got), key=str) == sorted([want(i, t) for i, t in rows], key=str)
    assert piece_bpe.encode_documents(docs.where("false"), PATH).count() == 0
