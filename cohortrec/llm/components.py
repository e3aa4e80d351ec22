"""Connected components of a table of links."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.plans.materialize import materialize


def forest(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Nodes and the smallest node of their component, for nodes that are not it."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if find(x) != x]
    return nodes, [find(x) for x in nodes]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of each batch by stars; bounded by a batch, and connectivity stays."""
    for batch in batches:
        nodes, roots = forest(batch["a"].to_pylist(), batch["b"].to_pylist())
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its smallest node.

    Links are contracted to stars batch by batch, then rounds of large-star and small-star joins
    run until nothing changes. All state is in written tables; the driver only sees a count and a
    checksum per round. Joins are between written tables, so that adaptive execution can split a
    node with very many links. Links with a NULL end are left out, links of a node with itself only
    make it a node.
    """
    links = links.where("a is not null and b is not null").select("a", "b")
    alone = links.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    stars = links.where("a <> b").mapInArrow(_contract, "a long, b long").distinct()
    edges = materialize(stars, "stars")  # a > b
    before = None
    while True:
        state = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.union(edges.select("b", "a"))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")), "least")
        least = least.select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["k"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "large")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        named = least.withColumnRenamed("a", "k")
        small = large.join(named, large["a"] == named["k"]).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.union(least.select("a", "m")).distinct(), "edges")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return members.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
