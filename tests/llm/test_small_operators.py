"""Exact dedup, sharding and the classifier on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cohortrec.llm import exact_dedup, quality, sharding
from compare import DATA, compare, twin

# The third column has names that the operators use themselves.
ROWS = [
    (5, "a  b", "x"), (3, "a\tb", "x"), (9, "a b", "x"), (1, " a b", "x"), (2, None, "x"), (7, "", "x"), (8, "   ", "x"),
    (None, "a b", "x"), (None, "alone", "x"), (4, "q " * 50_000, "x"), (6, "q  " * 50_000, "x"), (3, "a\tb", "x"), (10, "\x1ca\x85b", "x"),
]
SCHEMA = "doc_id long, text string, keep_id string"


def expected():
    groups = {}
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in ROWS]
    for (i, _, _), n in zip(ROWS, norm):
        groups.setdefault(n, []).append(i)
    out = []
    for (i, _, _), n in zip(ROWS, norm):
        keep = min((x for x in groups[n] if x is not None), default=None)
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_groups_and_digest_clashes(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    assert sorted(map(tuple, exact_dedup.mark_copies(docs).collect()), key=str) == expected()
    weak = lambda content: F.substring(F.sha2(content, 256), 1, 0)  # noqa: E731  every content clashes
    assert sorted(map(tuple, exact_dedup.mark_copies(docs, digest=weak).collect()), key=str) == expected()
    for name in ("_dropped_id", "content", "digest", "salt", "kept"):
        kept = exact_dedup.drop_copies(docs.withColumnRenamed("keep_id", name))
        assert kept.columns == ["doc_id", "text", name]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 10, 2, 3, 3, 4, 8, None, None]
    assert exact_dedup.mark_copies(docs.limit(0)).collect() == []
    plan = exact_dedup.mark_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sql_twins(spark):
    con = twin(f"{DATA}/sf0.001")
    for name, sql in contract.oracle_sql().items():
        if re.match(r"op\d+_", name):
            assert compare(contract.queries()[name](spark, f"{DATA}/sf0.001"), con, sql) == [], name


def test_sharding(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "", "é" * 3, "text"]), 1) for i in range(4000)] + [(None, "n", 1)] * 3 + [(7, "again", 1)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(6)
    found = sharding.assign_shards(docs).collect()
    assert len(found) == len(rows)
    slots, place = {}, {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        assert place.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sorted(slots) == list(range(8))
    keys = [p for k, p in place.items() if k is not None]
    assert all(400 < sum(s == i for s, _ in keys) < 600 for i in range(8))
    assert 350 < sum(g == 8 for _, g in keys) < 550
    texts = sorted(((t or "").encode() for _, t, _ in rows))
    assert sorted((r.size, r.text_crc32) for r in found) == sorted((len(t) + 1, zlib.crc32(t)) for t in texts)
    assert sharding.assign_shards(docs.limit(0)).collect() == []
    weighted = sharding.assign_shards(docs, weights=[1, 3]).where("doc_id is not null").collect()
    assert 0.7 < np.mean([r.shard for r in weighted]) < 0.8


def test_written_shards(spark, tmp_path):
    docs = spark.range(500).selectExpr("id doc_id", "cast(id as string) text")
    sharding.write_shards(docs, str(tmp_path / "out"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    placed = {r.doc_id: r.shard for r in sharding.assign_shards(docs).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == placed
    sharding.write_shards(docs.withColumn("shard", F.lit("own")), str(tmp_path / "again"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "again"))
    assert {r.doc_id: r.shard_ for r in back.collect()} == placed and back.where("shard = 'own'").count() == 500


def test_rules_hold_and_weights_are_sparse():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.4) & (x[:, 5] < 0.7)).astype(float)
    rules = quality.tree_rules(x, y)
    assert any(len(r) > 1 for r in rules) and rules == quality.tree_rules(x, y)
    model = quality.fit_rules(x, y)
    margin = np.full(len(x), model.intercept)
    for w, rule in model.rules:
        margin += w * quality.holds(rule, x)
    for w, f, low, high, scale in model.linear:
        margin += w * np.clip(x[:, f], low, high) / scale
    assert ((margin > 0) == (y == 1)).mean() > 0.97
    assert len(model.rules) < len(rules) / 2


def test_compiled_score_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.random((300, len(quality.FEATURES)))
    model = quality.fit_rules(x, (x[:, 0] + x[:, 6] > 1).astype(float))
    table = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"f{i} double" for i in range(x.shape[1])))
    found = [r[0] for r in table.select(model.margin(lambda i: F.col(f"f{i}"))).collect()]
    margin = np.full(len(x), model.intercept)
    for w, rule in model.rules:
        margin += w * quality.holds(rule, x)
    for w, f, low, high, scale in model.linear:
        margin += w * np.clip(x[:, f], low, high) / scale
    assert np.allclose(found, margin)


def test_one_class_and_held_out_accuracy(spark):
    x = np.zeros((10, len(quality.FEATURES)))
    assert quality.fit_rules(x, np.ones(10)).rules == ()
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    scored = quality.score_documents(docs, quality.train(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    assert len(scored) > 60 and np.mean([r.predicted == r.quality for r in scored]) > 0.95
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_an_id_with_two_texts_loses_only_the_copy(spark):
    from cohortrec.llm import simhash

    a, b = "one text of some words that is here", "something else entirely which nobody has twice"
    rows = [(3, a), (5, a), (5, b), (5, b), (7, a), (None, a), (None, b), (8, None), (9, None), (9, "alone with its words in here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = sorted([(3, a), (5, b), (5, b), (None, a), (None, b), (8, None), rows[-1]], key=str)
    assert sorted(map(tuple, exact_dedup.drop_copies(docs).collect()), key=str) == wanted
    assert sorted(map(tuple, simhash.drop_near_copies(docs).collect()), key=str) == wanted
