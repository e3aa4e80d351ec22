"""Embedding near-dedup: int8 tile products with rigorous error bounds, exact where they matter.

Equal vectors of one label are a class and take part once. The classes of a label are dealt into
blocks, and every pair of blocks is a task of bounded size, so a label with a third of all rows is
many equal tasks. In a tile each unit vector is quantised to int8 with its own scale. If
``x = xq + ex`` and ``y = yq + ey``, then ``|x.y - xq.yq| <= |xq||ey| + |ex||y|``, so a pair whose
quantised product plus this bound stays below the threshold cannot be a link. Only the others are
computed again in double precision. A tile returns a sum of links and a spanning link per class, never
its pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.llm.components import connected_components
from cohortrec.plans.materialize import materialize

THRESHOLD = 0.98
BLOCK = 2048
STRIP = 512  # rows of a tile that are compared at once
ROUNDING = 1e-5  # more than what single precision can lose in the bound


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of what the codes stand for, and norm of the error, per row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def candidates(x: tuple, y: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of quantised rows that may reach ``threshold``; a superset of those that do."""
    # Products of int8 codes are whole numbers, exact in single precision below 2**24.
    exact = np.float32 if x[0].shape[1] * 127 * 127 < 1 << 24 else np.float64
    bound = x[0].astype(exact) @ y[0].astype(exact).T
    bound *= x[1][:, None].astype(exact)
    bound *= y[1][None, :].astype(exact)
    bound += (x[2][:, None] * y[3][None, :] + x[3][:, None]).astype(exact)
    return np.nonzero(bound >= threshold - ROUNDING)


def _spread(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked rows one label, the smallest, by minimum steps and pointer jumps."""
    while True:
        least = np.minimum(labels[a], labels[b])
        if (labels[a] == least).all() and (labels[b] == least).all():
            return
        # Hook the roots as well as the rows, so that whole trees move.
        for side in (labels[a], labels[b], a, b):
            np.minimum.at(labels, side, least)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def tile_links(vectors: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float):
    """Links between rows ``left`` and rows ``right`` (the same rows: each pair once).

    Returns the weight of linked rows per row, and per row the first row it is connected to.
    """
    # A power of two takes nothing from the precision and keeps squares finite.
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    norm = np.linalg.norm(vectors, axis=1)
    codes = quantise(vectors / norm[:, None])
    same = left is right
    links, labels = np.zeros(len(vectors), dtype=np.int64), np.arange(len(vectors))
    for begin in range(0, len(left), STRIP):
        rows = left[begin : begin + STRIP]
        cols = right[begin:] if same else right
        i, j = candidates([c[rows] for c in codes], [c[cols] for c in codes], threshold)
        if same:
            later = i < j
            i, j = i[later], j[later]
        for part in range(0, len(i), 1 << 17):
            a, b = rows[i[part : part + (1 << 17)]], cols[j[part : part + (1 << 17)]]
            cosine = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norm[a] * norm[b])
            hit = cosine >= threshold
            a, b = a[hit], b[hit]
            links += np.bincount(a, weight[b], len(links)).astype(np.int64)
            links += np.bincount(b, weight[a], len(links)).astype(np.int64)
            _spread(labels, a, b)
    return links, labels


def _usable(column: str) -> str:
    """Not NULL, no NULL or non-finite component, not zero."""
    return (
        f"{column} is not null and forall({column}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        f" and exists({column}, x -> x <> 0)"
    )


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Rows link when their labels are equal and not NULL, their vectors equally long, and the cosine
    in double precision is at least ``threshold``, which must be above 0. NULL, zero and non-finite vectors link with
    nothing and name their own component. Repeated rows count as rows of their own; a row with a
    NULL id is linked, but names no component. An empty table gives no rows; other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.when(F.expr(_usable(f"`{vector_col}`")), F.col(vector_col).cast("array<double>")).alias("vector"),
    )
    able = rows.where("label is not null and vector is not null")
    grouped = able.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    grouped = grouped.withColumn("class", F.monotonically_increasing_id()).withColumn("dim", F.size("vector"))
    classes = materialize(grouped, "classes")

    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = classes.join(sizes, ["label", "dim"]).select(
        "label", "dim", "class", "n", "vector", "blocks",
        F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"),
    )
    tiles = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "label", "dim", "class", "n", "vector", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))  # two blocks
        flat = table["vector"].combine_chunks().flatten().to_numpy()
        matrix = flat.reshape(len(table), -1)
        place, low, high = table["block"].to_numpy(), table["low"][0].as_py(), table["high"][0].as_py()
        left = np.flatnonzero(place == low)
        right = left if low == high else np.flatnonzero(place == high)
        links, labels = tile_links(matrix, table["n"].to_numpy(), left, right, threshold)
        some = np.flatnonzero(links)
        ids = table["class"].to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(links[some]), pa.array(ids[labels[some]])], ["class", "links", "root"]
        )

    found = tiles.groupBy("label", "dim", "low", "high").applyInArrow(tile, "class long, links long, root long")
    found = materialize(found, "tiles")
    members = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    linked = linked.join(members, F.col("class") == F.col("node")).select("class", "links", "component")
    linked = materialize(classes.select("class", "first").join(linked, "class"), "linked")
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    named = linked.join(least, "component").select(F.col("class").alias("member"), "links", "least")
    summary = classes.join(named, classes["class"] == named["member"], "left").select(
        "label",
        "vector",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("least", "first").alias("component_id"),
    )
    placed = rows.join(summary, ["label", "vector"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return placed.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
