"""Hard negatives against explicit loops, and Strassen's recursion against plain products."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortrec.llm.hard_negatives import mine_negatives, strassen, with_shifted_labels

SIDE = st.integers(1, 70)
SCHEMA = "vec_id long, embedding array<double>, label int, row int, rank string, side string"


@settings(max_examples=60, deadline=None)
@given(SIDE, SIDE, SIDE, st.sampled_from([1, 5, 24]), st.sampled_from([9, 2**31, 2**62]), st.integers(0, 99))
def test_strassen_is_exact(rows, inner, columns, leaf, most, seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(-most, most, (rows, inner))
    b = rng.integers(-most, most, (inner, columns))
    assert (strassen(a, b, leaf) == a @ b).all()


def plain(rows, every, window=(80, 100)):
    able = {}
    for i, vector, label, *_ in rows:
        if i is None or label is None or not vector or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        able[(i, label, tuple(math.floor(256 * x) for x in vector))] = None
    out = []
    for a, label, v in able:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in able if i != a and len(w) == len(v)]
        for score, p, _ in sorted(s for s in scored if s[2] == label)[:5]:
            inside = sorted(s for s in scored if s[2] != label and window[0] * -score <= 100 * -s[0] <= window[1] * -score)
            out += [(a, p, rank, n, -score, -s) for rank, (s, n, _) in enumerate(inside[:5], 1)]
    return sorted(out)


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(3, 6))
    rows = [(i, (centres[i % 3] + rng.normal(size=6) / 2).tolist(), i % 4, 0, "r", "s") for i in range(160)]
    rows += [(200 + i, rows[i][1], i % 3, 0, "r", "s") for i in range(40)]  # equal scores
    rows += [rows[20], rows[20], (20, rows[21][1], 1, 0, "", ""), (None, rows[1][1], 1, 0, "", "")]
    rows += [(300, None, 1, 0, "", ""), (310, rows[1][1], None, 0, "", ""), (320, [1.0, None] * 3, 1, 0, "", "")]
    rows += [(330, [float("nan")] * 6, 1, 0, "", ""), (340, [float("inf")] * 6, 1, 0, "", ""), (350, [], 2, 0, "", "")]
    rows += [(360, [0.0] * 6, 1, 0, "", ""), (370, [1.0, 2.0], 9, 0, "", ""), (371, [1.0, 1.5], 8, 0, "", ""), (372, [1.0, 2.5], 9, 0, "", "")]
    return rows


@pytest.mark.parametrize("block", [(3, 7), (1024, 8192)])
def test_equals_the_plain_version(spark, block):
    rows = vectors()
    found = mine_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), every=10, block=block).collect()
    assert sorted(map(tuple, found)) == plain(rows, 10)
    assert len(found) > 50


def test_vectors_too_long_for_64_bits_take_no_part(spark):
    rows = [(10, [1.0, 1.0], 1), (11, [1.0, 1.0], 1), (12, [1.0, 0.9], 2), (13, [1e300, 1.0], 2), (14, [2.0**21, 0.0], 2)]
    found = mine_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), every=10).collect()
    assert [(r.anchor_id, r.positive_id, r.negative_id) for r in found] == [(10, 11, 12)]


def test_labels_of_any_type_and_empty_table(spark):
    rows = [(10, [1.0, 1.0], "x"), (11, [1.0, 1.0], "x"), (12, [1.0, 0.9], "y")]
    schema = "vec_id long, embedding array<float>, label string"
    assert mine_negatives(spark.createDataFrame(rows, schema), every=10).count() == 1
    assert mine_negatives(spark.createDataFrame([], schema)).collect() == []


def test_shifted_labels(spark):
    rows = [(7, 9), (8, 9), (14, None), (None, 3)]
    found = with_shifted_labels(spark.createDataFrame(rows, "vec_id long, label int")).collect()
    assert [tuple(r) for r in found] == [(7, 0), (8, 9), (14, None), (None, 3)]
