import random

import pytest
from pyspark.sql import functions as F

from cohortrec.operators.lists import cut_lists, joined, list_parts, list_start


def expected_parts(rows, size):
    groups = {}
    for key, item in rows:
        groups.setdefault(key, []).append(item)
    return {
        (key, start // size): sorted(items)[start : start + size]
        for key, items in groups.items()
        for start in range(0, len(items), size)
    }


def skewed_rows(seed=3):
    """One group holds a third of all rows, and in it one item is repeated very often."""
    rng = random.Random(seed)
    rows = [(rng.randrange(30), rng.randrange(-200, 200)) for _ in range(2000)]
    hot = [(7, rng.randrange(-200, 200)) for _ in range(500)] + [(7, 13)] * 500
    return rows + hot


@pytest.mark.parametrize("size", [1, 7, 64, 5000])
def test_cut_lists_match_brute_force(spark, size):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k int, item long")
    found = {(r.k, r.part): list(r.items) for r in cut_lists(df, ["k"], "item", "items", size).collect()}
    assert found == expected_parts(rows, size)


@pytest.mark.parametrize("size", [7, 100, 5000])
def test_list_parts_with_aggregates(spark, size):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k int, item long")
    totals = [F.sum("item").alias("total")]
    parts = list_parts(df, ["k"], "item", "items", size, aggregates=totals).collect()
    assert {(r.k, r.part): list(r["items"]) for r in parts} == expected_parts(rows, size)
    sums = {}
    for key, item in rows:
        sums[key] = sums.get(key, 0) + item
    assert all(r.total == sums[r.k] for r in parts)


@pytest.mark.parametrize("size", [2, 100])
def test_list_parts_with_value(spark, size):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (1, 2, "b")], "k int, item long, v string")
    rows = list_parts(df, ["k"], "item", "items", size, value="v").orderBy("part").collect()
    assert [x.v for r in rows for x in r["items"]] == ["a", "b", "b", "c"]


@pytest.mark.parametrize("parts", [1, 8])
def test_list_start_across_ranges(spark, parts):
    counts = spark.createDataFrame([(1, i, 1 + i % 3) for i in range(-50, 50)], "k int, item long, n long")
    found = {r.item: r.start for r in list_start(counts, ["k"], ["item"], parts).collect()}
    start = 0
    for item in range(-50, 50):
        assert found[item] == start
        start += 1 + item % 3


def test_sparse_ids_of_one_group_are_spread(spark):
    """No window may hold much more than its share of a single group with hash-like ids."""
    items = spark.range(1_000_000).selectExpr("0 k", "xxhash64(id) item", "1L n")
    started = list_start(items, ["k"], ["item"], parts=16)
    assert started.select(F.max("start"), F.countDistinct("start")).first() == (999_999, 1_000_000)
    largest = {}

    def visit(node):
        if node.nodeName() == "Window":
            child = node.child()
            keys = node.partitionSpec().toString()
            largest[keys] = child
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(started._jdf.queryExecution().sparkPlan())
    assert len(largest) == 2 and all("k#" in keys for keys in largest)
    sizes = items.repartitionByRange(16, "k", "item").groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 120_000 and sizes.count() == 16


ODD = [
    (1, 2, "b"), (1, 2, "B"), (1, None, "n"), (1, 3, "c"), (1, 2, "b"), (1, 1, None), (1, 1, "a"),
    (2, None, "x"), (2, None, None), (None, 5, "y"), (None, 5, "y"), (None, 4, "z"), (3, 9, "w"),
]


@pytest.mark.parametrize("value", [None, "v"])
def test_same_rows_for_every_part_size(spark, value):
    df = spark.createDataFrame(ODD, "k int, item long, v string").repartition(3)
    totals = [F.count("*").alias("n"), F.sum("item").alias("total")]

    def entry(r):
        return r if value is None else (r.item, r.v)

    def expected(size):
        out = []
        for key in {k for k, _, _ in ODD}:
            rows = [r for r in ODD if r[0] == key]
            items = sorted(
                ((i, v) if value else i for _, i, v in rows if i is not None),
                key=lambda e: (e[0], e[1] is not None, e[1] or "") if value else e,
            )
            sums = [i for _, i, _ in rows if i is not None]
            for start in range(0, max(len(items), 1), size):
                out.append((key, start // size, items[start : start + size], len(rows), sum(sums) if sums else None))
        return sorted(out, key=str)

    for size in (1, 2, 3, 100):
        found = list_parts(df, ["k"], "item", "items", size, value, totals).collect()
        assert sorted(((r.k, r.part, [entry(e) for e in r["items"]], r.n, r.total) for r in found), key=str) == expected(size)
        cut = cut_lists(df, ["k"], "item", "items", size, value).collect()
        assert sorted(((r.k, r.part, [entry(e) for e in r["items"]]) for r in cut), key=str) == [e[:3] for e in expected(size)]


def test_no_long_group_reads_the_entries_once(spark):
    plan = list_parts(spark.range(100).selectExpr("id % 7 k", "id item"), ["k"], "item", "items")
    rows = plan.collect()
    assert len(rows) == 7
    final = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Range (") == 1


def test_joined(spark):
    assert spark.sql("select array(3L, 10L) as a").select(joined(F.col("a"))).first()[0] == "3,10"
