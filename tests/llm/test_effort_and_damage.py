"""Exhaustive packing, column names that packing must not touch, damaged token files, and long texts in linear time."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortrec.llm import bin_completion as bc
from cohortrec.llm import pfor, secrets
from cohortrec.llm.packing import pack_pieces
from cohortrec.llm.token_files import SEGMENTS, read_token_files, write_token_files
from cohortrec.llm.tokens import BatchEncoder

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def optimum(items, capacity):
    """Fewest bins, by trying every open bin for every item."""
    best = len(items)

    def put(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= rest[0] and room not in rooms[:i]:
                put(rest[1:], (*rooms[:i], room - rest[0], *rooms[i + 1 :]))
        put(rest[1:], (*rooms, capacity - rest[0]))

    put(tuple(sorted(items, reverse=True)), ())
    return best


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_exhaustive_search_is_optimal(items):
    counts = {length: items.count(length) for length in items}
    found = bc.pack(counts, 20, bc.EXHAUSTIVE)
    used = {}
    for pattern, copies in found:
        assert sum(pattern) <= 20
        for length in pattern:
            used[length] = used.get(length, 0) + copies
    assert used == counts
    assert sum(copies for _, copies in found) == optimum(items, 20)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=8), st.integers(1, 30))
def test_all_undominated_fillings(items, space):
    """Every set that fits is dominated by one of the fillings."""
    import itertools

    import numpy as np

    counts = np.bincount(items, minlength=space + 1) if items else np.zeros(space + 1, dtype=int)
    found = bc.fillings(counts, space, space, bc.EXHAUSTIVE)
    for size in range(len(items) + 1):
        for chosen in set(itertools.combinations(sorted(items, reverse=True), size)):
            if sum(chosen) <= space:
                assert any(bc.dominates(f, chosen) for f in found)


def test_packing_leaves_other_columns_alone(spark):
    rows = [(i, 5 + i % 90, f"p{i}", i, "r", 1, 2, 3) for i in range(500)]
    schema = "doc_id long, length long, part string, piece int, rank string, low int, high int, shift int"
    found = pack_pieces(spark.createDataFrame(rows, schema), 100).toPandas()
    assert list(found.columns) == [f.split()[0] for f in schema.split(", ")] + ["sequence_id", "offset"]
    assert sorted(found[["doc_id", "length", "part", "rank", "low", "high", "shift"]].itertuples(index=False, name=None)) == sorted(
        (r[0], r[1], r[2], *r[4:]) for r in rows
    )
    for _, bin_ in found.sort_values("offset").groupby("sequence_id"):
        assert bin_.offset.tolist() == [0, *bin_.length.cumsum().tolist()[:-1]] and bin_.length.sum() <= 100
    with pytest.raises(ValueError, match="offset"):
        pack_pieces(spark.createDataFrame([(1, 5, 0, 0)], "doc_id long, length long, piece int, offset long"))


def test_a_frequent_length_meets_few_ranges(spark):
    rows = [(i, 30 if i % 3 else 1 + i % 70, 0) for i in range(3000)]
    found = pack_pieces(spark.createDataFrame(rows, "doc_id long, length long, piece int"), 100)
    assert found.count() == found.select("sequence_id", "offset").distinct().count() == 3000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_damaged_segments_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} of some") for i in range(50)], "doc_id long, text string")
    write_token_files(docs, str(tmp_path / "good"), PATH, parts=2)
    rows = spark.read.schema(SEGMENTS).parquet(str(tmp_path / "good")).collect()
    assert all(r.ids_crc32 is not None for r in rows)
    ids = pfor.decode(bytes(rows[0].data)).copy()
    ids[3] += 1
    for name, changed in (("ids", pfor.encode(ids)), ("less", pfor.encode(ids[:-1]))):
        damaged = [{**rows[0].asDict(), "data": changed}, *(r.asDict() for r in rows[1:])]
        spark.createDataFrame(damaged, SEGMENTS).write.parquet(str(tmp_path / name))
        with pytest.raises(Exception, match="damaged"):
            read_token_files(spark, str(tmp_path / name)).collect()
    assert read_token_files(spark, str(tmp_path / "good")).count() == 50


def test_equal_rows_lie_in_several_parts(spark, tmp_path):
    docs = spark.createDataFrame([(7, "the same row again")] * 4000, "doc_id long, text string").repartition(4)
    write_token_files(docs, str(tmp_path / "files"), PATH, parts=4)
    sizes = spark.read.schema(SEGMENTS).parquet(str(tmp_path / "files")).groupBy("part").sum("n_ids").collect()
    assert len(sizes) == 4 and max(r[1] for r in sizes) < 0.5 * sum(r[1] for r in sizes)


def test_words_are_forgotten_without_effect():
    import pyarrow as pa

    encoder = BatchEncoder(PATH)
    texts = pa.array(["Some words, again; Some words.", "", None, "x1y2 (three)"])
    first = encoder.encode(texts)
    assert encoder.known and encoder.remembered > 0
    encoder.forget()
    again = encoder.encode(texts)
    assert not encoder.known or encoder.remembered > 0
    assert all((a == b).all() for a, b in zip(first, again))


@pytest.mark.parametrize("part", ["7", "0af3", "ab_", "x-9_", "pwd ", "token ", "pwd:", "key=  ", "password = 'abcdef' "])
def test_long_texts_in_linear_time(part):
    text = part * (1_000_000 // len(part))
    begin = time.process_time()
    secrets.find_spans(text[:20_000])  # spans of assignments are costed
    secrets.CONTEXT.findall(text)
    secrets.ASSIGN.findall(text)
    secrets.HEX.findall(text)
    assert time.process_time() - begin < 20
