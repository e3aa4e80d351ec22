"""Golay keys, fingerprints and groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortrec.llm import golay, simhash
from cohortrec.llm.components import connected_components, forest


def test_code_is_perfect_and_keys_are_all_codewords_within_four():
    code = np.array([w for w in (m << 11 for m in range(1 << 12))], dtype=np.uint32)
    code = np.array([w ^ golay.remainder(int(w)) for w in code], dtype=np.uint32)
    assert min(bin(int(w)).count("1") for w in code[1:]) == 7
    words = np.random.default_rng(0).integers(0, 1 << 23, 300).astype(np.uint32)
    found, count = golay.keys(words)
    for word, row, n in zip(words, found, count):
        near = set((code[np.bitwise_count(code ^ word) <= 4] >> 11).tolist())
        assert set(row[:n].tolist()) == near and len(near) == n


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_close_fingerprints_share_a_key(value, bits):
    other = value ^ sum(1 << b for b in bits)
    a, _ = simhash.fuzzy_keys(np.array([value], dtype=np.uint64))
    b, _ = simhash.fuzzy_keys(np.array([other], dtype=np.uint64))
    assert set(a.tolist()) & set(b.tolist())


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, fps, bits=4):
    a, b = [], []
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a.append(i), b.append(j)
    nodes, roots = forest(a, b)
    root = list(range(len(ids)))
    for node, top in zip(nodes, roots):
        root[node] = top
    least = {}
    for i, r in zip(ids, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(r) for r in root]


TEXTS = [None, "", " \t\n", "one", "One two", "a b c d", "A  b\tC d e", "ÀB Éé x y z À", "\x1c w \x85 v u t s", "k " * 600]


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_groups_equal_brute_force(spark, block):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(300)) for _ in range(6)]
    texts = list(TEXTS)
    for text in base:
        words = text.split()
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    ids = [None if i == 7 else i for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)], "doc_id long, text string, fp int").repartition(5)
    fps = [brute_fingerprint(t) for t in texts]
    expected = sorted(zip(map(str, ids), (f"{f:016x}" for f in fps), brute_groups(ids, fps)))
    found = simhash.near_groups(docs, block=block).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found) == expected
    assert len({r.component_id for r in found}) < len(texts) - 20


def test_long_keys_and_chains(spark):
    rng = random.Random(6)
    start = rng.getrandbits(64)
    values = {start}
    for _ in range(400):  # a chain of steps, and a dense ball around one value
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(8)) ^ (1 << rng.randrange(8)))
    values |= {start ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, 64, 7)}
    values |= {rng.getrandbits(64) for _ in range(300)}
    values = sorted(values)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), block=16)
    found = {r.node: r.component for r in connected_components(links).collect()}
    expected = brute_groups(signed, values)
    assert [found.get(s, s) for s in signed] == expected


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (7, 8), (5, 5), (None, 4), (3, 1)] + [(100 + i, 101 + i) for i in range(300)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long").repartition(9)).collect()}
    assert {k: v for k, v in found.items() if k < 100} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 5: 5}
    assert {v for k, v in found.items() if k >= 100} == {100}


def test_empty_and_filter(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(empty).collect() == []
    rows = [(1, "same text here now ok", "x"), (2, "Same text  here now ok", "y"), (3, "another one entirely different", "z")]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string"))
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
