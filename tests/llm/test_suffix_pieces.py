"""Suffix-array encoding and decoding against the sentencepiece library."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortrec.llm.suffix_pieces import LONG, Index, SuffixEncoder, decode_documents, encode_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")
ENCODER = SuffixEncoder(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = st.text(
    st.one_of(st.sampled_from("abetnio  ▁rs.,-=*/#é\t\n<0x>"), st.characters(codec="utf-8")), max_size=50
)


def check(texts):
    ids, starts = ENCODER.encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, starts, starts[1:]):
        wanted = LIBRARY.encode(text or "")
        assert ids[a:b].tolist() == wanted, text
        assert ENCODER.decode(ids[a:b]) == LIBRARY.decode(wanted)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.none()), max_size=8))
def test_encoding_equals_the_library(texts):
    check(texts)


def test_runs_words_and_long_words():
    rng = random.Random(1)
    check([" " * n + "a" + "-" * n + "=" * (n // 2) for n in range(40)])
    check(["", None, " ", "▁", "<s> </s> <unk> <0x09>", "日本語のテキスト", "a\x00b", "é é", "internationalization representation"])
    letters = "etaoinshrdlu"
    check(["".join(rng.choice(letters) for _ in range(n)) for n in (LONG - 1, LONG, LONG + 1, 3000)])
    check([" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(2000))])
    check([chr(c) for c in range(0x20, 0x3000, 7)])


def test_index_finds_all_occurrences():
    rng = np.random.default_rng(0)
    symbols = rng.integers(2, 5, 500).astype(np.uint16)
    for bits in (8, 16):
        index = Index(symbols, 11, bits)
        patterns, lengths = np.zeros((60, 11), dtype=np.uint16), rng.integers(1, 7, 60)
        for row, n in zip(patterns, lengths):
            at = rng.integers(0, 490)
            row[:n] = symbols[at : at + n] if rng.random() < 0.8 else rng.integers(2, 5, n)
        low, high = index.ranges(patterns, lengths)
        for row, n, a, b in zip(patterns, lengths, low, high):
            wanted = [i for i in range(501 - n) if (symbols[i : i + n] == row[:n]).all()]
            assert sorted(index.order[a:b].tolist()) == wanted


def test_documents(spark):
    texts = ["One two  three", None, "", "é ▁ \U0001f600 x", "word " * 60_000, "One two  three"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(3)
    found = {r.doc_id: r for r in decode_documents(encode_documents(docs, PATH), PATH).collect()}
    for i, text in enumerate(texts):
        wanted = LIBRARY.encode(text or "")
        assert np.frombuffer(found[i].ids, dtype="<u4").tolist() == wanted
        assert found[i].text == LIBRARY.decode(wanted)
    assert encode_documents(docs.limit(0), PATH).collect() == []
