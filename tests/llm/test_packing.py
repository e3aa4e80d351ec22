"""Bin completion against exhaustive search, and the packed table against its own rules."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortrec.llm import bin_completion as bc
from cohortrec.llm.packing import cut_pieces, pack_documents, pack_pieces

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def optimum(items, capacity):
    """Fewest bins, by trying every bin for every item."""
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in sorted({r for r in bins if r >= items[i]}):
            k = bins.index(room)
            place(i + 1, [*bins[:k], room - items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best


def check(solution, counts, capacity):
    placed = Counter()
    for pattern, copies in solution:
        assert copies > 0 and sum(pattern) <= capacity
        for length in pattern:
            placed[length] += copies
    assert placed == Counter({k: v for k, v in counts.items() if v})
    return sum(copies for _, copies in solution)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_small_cases_are_optimal(items):
    counts = Counter(items)
    assert check(bc.pack(counts, 20), counts, 20) == optimum(sorted(items, reverse=True), 20)


def test_search_beats_best_fit():
    counts = {44: 1, 24: 2, 27: 1, 20: 1, 53: 1, 50: 1, 26: 2, 30: 1, 23: 1, 21: 1, 56: 1}
    best, found = sum(bc.best_fit(counts, 100).values()), check(bc.pack(counts, 100), counts, 100)
    assert found <= best
    rng = random.Random(4)
    better = 0
    for _ in range(60):
        counts = Counter(rng.choice([7, 11, 23, 31, 38, 41, 47, 52]) for _ in range(40))
        greedy = check(sorted(bc.best_fit(counts, 100).items()), counts, 100)
        found = check(bc.pack(counts, 100), counts, 100)
        assert found <= greedy
        better += found < greedy
    assert better


def test_domination():
    assert bc.dominates((7,), (4, 3)) and bc.dominates((5, 4), (5, 2, 2)) and bc.dominates((3,), ())
    assert not bc.dominates((4, 3), (7,)) and not bc.dominates((4, 4), (3, 3, 2))


def test_many_items_come_close_to_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6.5, 1.0, 300_000).astype(int) + 1, 4096)
    counts = Counter(lengths.tolist())
    array = np.bincount(lengths, minlength=4097)
    found, bound = check(bc.pack(counts, 4096), counts, 4096), bc.lower_bound(array)
    assert bound <= found <= bound * 1.0002
    assert found < sum(bc.best_fit(counts, 4096).values())


def test_packed_documents(spark):
    rng = random.Random(3)
    words = ["alpha", "beta,", "Gamma", "delta.", "è1"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(200))), i) for i in range(150)]
    rows += [(150, None, 0), (151, "", 0), (152, "word " * 9000, 0), (3, rows[3][1], 0), (None, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(6)
    pieces = cut_pieces(docs, PATH, 256, with_ids=True).collect()
    found = pack_documents(docs, PATH, 256).collect()
    key = lambda r: (str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, found)) == Counter(map(key, pieces))
    assert all(zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length for p in pieces)
    sequences = {}
    for row in found:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(p.length for p in pieces)
    assert len(sequences) == -(-total // 256)
    long = sorted((r for r in found if r.doc_id == 152), key=lambda r: r.piece)
    assert [r.length for r in long[:-1]] == [256] * (len(long) - 1) and len(long) == -(-9001 // 256)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, PATH).collect() == []


def test_one_length_holds_all_rows(spark):
    pieces = spark.range(5000).selectExpr("id doc_id", "0 piece", "100L length").repartition(8)
    found = pack_pieces(pieces, 300).toPandas()
    assert found.groupby("sequence_id").size().max() == 3
    assert found["sequence_id"].nunique() == -(-5000 // 3)
    assert not found.duplicated(["sequence_id", "offset"]).any()
