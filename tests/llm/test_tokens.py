"""Token counts and byte-pair codes against plain algorithms and the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyworks.llm import bpe, wordpiece
from tallyworks.llm.bytelevel import Vocabulary, ended, read_file, stand_ins

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ODD = [None, "", " ", "a", "a" * 3000, "ab" * 2000 + "!" * 3000, "Hello World's 12,345 <|endoftext|>x<|startoftext|>", "ΣΑΣ Σ İstanbul ﬁ é é",
       "😄😄😄😄😄😄😄😄😄😄😄!!!!!????", "x\x1cy\x85z\xa0w​q﻿日本語 \r\n\t"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(read_file(PATH))


def agrees(codec, text):
    ids = TOKENIZER.encode(text, add_special_tokens=False).ids
    got = codec.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert "".join(codec.decode(got)) == TOKENIZER.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [t for t in ODD if t is not None])
def test_odd_texts_as_the_library(codec, text):
    agrees(codec, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdehilnorst' éßÀΣ日😀.,!?13\n\t", max_size=80))
def test_random_texts_as_the_library(codec, text):
    agrees(codec, text)


def test_long_words_are_emitted_before_they_end(codec):
    rnd = random.Random(5)
    word = "".join(rnd.choice("aeinrst") for _ in range(4000))
    transducer = codec.words.transducer
    read = 0

    def pieces():
        nonlocal read
        for i in range(0, len(word), 50):
            read = i + 50
            yield word[i:i + 50]

    out = []
    for token in transducer.tokens(pieces()):
        out.append(token)
        # What has been read and not emitted stays short, however long the word.
        assert read - sum(map(len, out)) <= 12 * transducer.reach
    assert "".join(out) == word


def test_plain_text_comes_back(codec):
    assert "".join(codec.plain_text(codec.encode("the cat's 9 日本 😀"))) == "the cat 's 9 日本 😀 "


def test_encode_documents_on_odd_rows(spark):
    rows = [(i, t, i % 3) for i, t in enumerate(ODD)] + [(None, "twice", 7), (None, "twice", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.encode_documents(df, PATH, outputs=("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            text = "twice"
        else:
            text = ODD[r["doc_id"]] or ""
        ids = TOKENIZER.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids"]) == (len(ids), ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0), PATH).collect() == []


def greedy(tokens, symbols):
    n = 0
    while symbols:
        size = next((k for k in range(len(symbols), 0, -1) if symbols[:k] in tokens), 0)
        if not size:
            return 1
        symbols, n = symbols[size:], n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=5), max_size=8), st.text("abc", max_size=14))
def test_automaton_counts_as_greedy_matching(tokens, word):
    assert wordpiece.Automaton(tokens).count(word) == greedy(tokens, word)


def test_token_counts_on_odd_rows(spark):
    vocabulary = Vocabulary(read_file(PATH))
    signs = dict(enumerate(stand_ins()))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, n_words string")
    for r in wordpiece.token_counts(df, PATH).collect():
        words = (ODD[r["doc_id"]] or "").encode().lower().split()
        each = [greedy(vocabulary.ids, ended(w.decode("latin-1").translate(signs))) for w in words]
        assert (r["n_words"], r["n_tokens"], r["most_in_word"]) == (len(words), sum(each), max(each, default=0))
    assert wordpiece.token_counts(df.limit(0), PATH).collect() == []
