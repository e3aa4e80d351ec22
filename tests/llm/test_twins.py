"""Plain Python twins of expressions that the fitted and hashed operators rest on."""

import math
import re
import struct

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortrec.llm import guess_cost, piece_model, quality, sharding

public_tokenizers = pytest.importorskip("public_tokenizers")


def plain_statistics(text):
    chars = len(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    pieces = re.split(r"[\x20\x09-\x0D]+", text.lower())
    lines = [line for line in text.split("\n") if line]
    share = lambda part, whole: part / whole if whole > 0 else 0.0
    count = lambda pattern: len(re.findall(pattern, text))
    return {
        "n_words": math.log1p(len(words)),
        "word_length": share(chars, len(words)),
        "distinct_words": share(len(set(pieces)), len(pieces)),
        "distinct_lines": share(len(set(lines)), len(lines)),
        "words_per_line": math.log1p(share(len(words), len(lines))),
        "symbols": share(count(r"[#$%&*@^~+=<>{}\[\]\\_]"), chars),
        "bars": share(count(r"[|/]"), len(words)),
        "exclamations": share(count(r"[!?]"), len(words)),
        "stops": share(count(r"[.,;:]"), len(words)),
        "digits": share(count(r"[0-9]"), chars),
        "capitals": share(sum(c.isupper() for c in text if c.isalpha()), chars),
    }


def test_statistics(spark):
    texts = [
        "", " ", "\n\n", "One line.", "A b a B\nA b a B\n\nsecond, LINE! really?\t12 34", "x" * 5000, "#$ {} [] \\ _ | / a/b|c",
        " leading and trailing ", "Über ÄÖ ß straße\x0b\x0cnew", "same same same\nsame same same\n" * 30, "1,2;3:4.5!",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = docs.select("i", *[c.alias(n) for n, c in quality.statistics(F.col("text")).items()]).collect()
    assert len(found) == len(texts)
    for row in found:
        expected = plain_statistics(texts[row.i])
        assert set(expected) == set(quality.FEATURES)
        for name, value in expected.items():
            assert row[name] == pytest.approx(value, abs=1e-12), (texts[row.i], name)


def plain_shard(key, weights):
    draws = []
    for shard, weight in enumerate(weights):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        value = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed)
        draws.append((-math.log(((value >> 11) + 0.5) * 2.0**-53) / weight, shard))
    return min(draws)[1]


@pytest.mark.parametrize("weights", [(1.0,) * 8, (1.0,) * 9, (3.0, 1.0, 0.5)])
def test_rendezvous_draws(spark, weights):
    keys = [None, 0, 1, -1, 2**62, *range(100, 1500)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.rendezvous(F.col("k"), weights).alias("shard"))
    assert {r.k: r.shard for r in rows.collect()} == {k: plain_shard(k, weights) for k in keys}
    shares = np.bincount([plain_shard(k, weights) for k in keys]) / len(keys)
    assert abs(shares - np.array(weights) / sum(weights)).max() < 0.05


def test_assigned_shards(spark):
    rows = [(i % 70, f"text {i} é" * (i % 4)) for i in range(300)] + [(None, None), (5, None)]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.size, r.shard, r.grown_shard) for r in found), key=str) == sorted(
        ((k, len((t or "").encode()) + 1, plain_shard(k, (1.0,) * 8), plain_shard(k, (1.0,) * 9)) for k, t in rows), key=str
    )
    for shard in range(8):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


def plain_cost(value):
    """The cheapest cut of a short value into words, years, dates, repeats, walks and characters, tried one by one."""
    digit, letter = math.log10(10), math.log10(26)
    brute = lambda c: digit if c.isdigit() else letter if c.isascii() and c.isalpha() else math.log10(33)

    def whole(part):
        """Costs of ``part`` as one segment, brute force aside."""
        lower, found = part.lower(), []
        for text, extra in ((lower, 0.0), (lower.translate(str.maketrans("430157@$!", "aeoistasi")), math.log10(4))):
            if len(part) >= 3 and text in guess_cost.WORDS:
                capital = 0.0 if part == lower else math.log10(2) if part[1:] == lower[1:] else math.log10(8)
                found.append(math.log10(guess_cost.WORDS.index(text) + 2) + capital + extra)
                break
        if re.fullmatch(r"(19|20)\d\d", part):
            found.append(math.log10(120))
        month, day, sep = "(0[1-9]|1[0-2])", r"(0[1-9]|[12]\d|3[01])", "[-/._]?"
        for order in ((r"(19|20)\d\d", month, day), (day, month, r"(19|20)\d\d"), (month, day, r"(19|20)\d\d")):
            if re.fullmatch(sep.join(order), part):
                found.append(math.log10(365 * 120 * 4))
        if len(part) >= 3 and len(set(part)) == 1:
            found.append(brute(part[0]) + math.log10(len(part)))
        for period in range(2, 9):
            times = len(part) // period
            if times >= 2 and part == part[:period] * times:
                found.append(sum(map(brute, part[:period])) + math.log10(times))
        steps = [guess_cost.NEXT_TO.get(pair) for pair in zip(lower, lower[1:])]
        if len(part) >= 3 and all(steps):
            turns = sum(a != b for a, b in zip(steps, steps[1:]))
            found.append(math.log10(47) + turns * math.log10(3) + math.log10(len(part)))
        return found

    best = [0.0]
    for end in range(1, len(value) + 1):
        ways = [best[end - 1] + brute(value[end - 1])]
        for begin in range(end):
            ways += [best[begin] + cost + math.log10(2) for cost in whole(value[begin:end])]
        best.append(min(ways))
    return best[-1]


PARTS = ["password", "Dragon", "p4ss", "qwer", "asd", "aaaa", "19990412", "2024", "31.12.1999", "x", "7", "Zq", "!", "abab", "abcabc", "zxcv", "REDACTED"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=4).map("".join))
def test_guess_costs(value):
    assert guess_cost.log10_guesses(value) == pytest.approx(plain_cost(value), abs=1e-9)


def test_models_of_another_kind_are_refused(monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    real = sentencepiece.SentencePieceProcessor.get_score
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "get_score", lambda self, i: real(self, i) - 0.5)
    with pytest.raises(ValueError, match="only BPE"):
        piece_model.PieceModel(path)
