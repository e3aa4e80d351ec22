"""Token files against the tokenizers library and packed blocks against plain arrays."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortrec.llm import pfor
from cohortrec.llm.token_files import read_token_files, write_token_files
from cohortrec.llm.tokens import BatchEncoder

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = BatchEncoder(PATH)
TEXTS = st.text(
    st.one_of(
        st.sampled_from("abcABC ÀÉßµ²½ \t\n\r\x0b\x0c\x1c\x85\xa0'\"<|>.,!123"),
        st.characters(codec="utf-8"),
    ),
    max_size=60,
)


def direct(text):
    return ENCODER.whole.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.none()), max_size=8))
def test_batches_equal_the_library(texts):
    ids, starts = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [direct(t) for t in texts]


def test_words_and_special_tokens():
    texts = ["It's The <|endoftext|> end", "Thatndou, the ANTI. 12a3", "", "Über straße", "x" * 5000]
    ids, starts = ENCODER.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [direct(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700),
    st.sampled_from([0.0, 0.5, 0.9, 1.0]),
    st.integers(0, 700),
    st.integers(0, 700),
)
def test_blocks_round_trip(values, percentile, begin, end):
    data = pfor.encode(np.array(values, dtype=np.uint32), percentile)
    assert pfor.decode(data).tolist() == values
    assert pfor.decode(data, begin, end).tolist() == values[begin:end]


def test_outliers_do_not_widen_a_block():
    flat = np.arange(128, dtype=np.uint32) % 16
    spiked = flat.copy()
    spiked[5] = 2**31
    assert len(pfor.encode(spiked)) == len(pfor.encode(flat)) + 5


def test_files_hold_every_document(spark, tmp_path):
    rows = [(i, f"Text number {i}, of some länge " * (i % 5), i) for i in range(200)]
    rows += [(7, "again", 0), (7, None, 0), (None, "no id", 0), (300, "long " * 400_000, 0), (301, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(7)
    write_token_files(docs, str(tmp_path / "files"), PATH, parts=5)
    found = sorted(read_token_files(spark, str(tmp_path / "files")).collect(), key=lambda r: r.start)
    assert len(found) == len(rows)
    keys = [r.doc_id for r in found]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    position = 0
    for row in found:
        assert row.start == position
        position += len(row.ids) // 4
    expected = sorted(zlib.crc32(np.array(direct(t), dtype="<u4").tobytes()) for _, t, _ in rows)
    assert sorted(zlib.crc32(r.ids) for r in found) == expected


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(docs, str(tmp_path / "none"), PATH)
    assert read_token_files(spark, str(tmp_path / "none")).collect() == []
