"""Hard-negative mining: exact integer products of anchor and candidate tiles by Strassen recursion.

Vectors become whole numbers, ``floor(scale * x)`` per component. Anchors and candidates are dealt into blocks of bounded
size, and every pair of an anchor block and a candidate block is a tile, a task of its own. A tile multiplies its two
matrices by Strassen's recursion on int64, padding odd sides with zeros; sums of whole numbers are exact, and
sums between that overflow wrap around and come back.

Two passes over tiles are needed, as the window of a negative depends on the score of its positive:

1. Tiles inside one label return, per anchor, the heap of its best positives; heaps are merged by their first rows.
2. Tiles over all labels return, per anchor and positive, the heap of the best rows of other labels with a score inside
   the positive's window; these are merged in the same way.

A heap never holds more than its few rows, so a tile returns a bounded number of rows whatever its size, and
merging cuts them before the shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.plans.materialize import materialize

SCALE = 256
POSITIVES = NEGATIVES = 5
WINDOW = (80, 100)  # per cent of the positive's score
ANCHOR_BLOCK, CANDIDATE_BLOCK = 1024, 8192
STRIP = 128  # anchors of a tile that are scored at once
LEAF = 24  # side below which numbers are multiplied directly
# A score is at most the product of two norms; 100 times it has to fit into 64 bits.
MOST_NORM = float(2**28)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for int64, exact modulo 2**64, by seven products of halves."""
    rows, inner = a.shape
    columns = b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    if rows % 2 or inner % 2:
        a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    if inner % 2 or columns % 2:
        b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


def first_places(scores: np.ndarray, ids: np.ndarray, limit: int) -> np.ndarray:
    """Places of the ``limit`` rows with the highest scores, ties by smaller id, in this order."""
    if len(scores) > limit:
        least = np.partition(scores, len(scores) - limit)[len(scores) - limit]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:limit]


def window_places(scores: np.ndarray, ids: np.ndarray, positives: np.ndarray, window: tuple[int, int], limit: int) -> list[np.ndarray]:
    """Per positive score the places of the first ``limit`` rows with a score inside its window."""
    low, high = window
    found = []
    for score in positives.tolist():
        inside = np.flatnonzero((100 * scores >= low * score) & (100 * scores <= high * score))
        found.append(inside[first_places(scores[inside], ids[inside], limit)])
    return found


def _matrix(table: pa.Table, column: str = "vector") -> np.ndarray:
    flat = table[column].combine_chunks().flatten().to_numpy()
    return flat.reshape(len(table), -1)


def _by_side(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    side = table["side"].to_numpy()
    return tuple(table.take(pa.array(np.flatnonzero(side == s))) for s in (0, 1))


def _strips(anchors: np.ndarray, candidates: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    right = np.ascontiguousarray(candidates.T)
    for begin in range(0, len(anchors), STRIP):
        for nth, scores in enumerate(strassen(anchors[begin : begin + STRIP], right)):
            yield begin + nth, scores


def _positive_tile(table: pa.Table, limit: int) -> pa.Table:
    anchors, others = _by_side(table)
    anchor_row, anchor_id = anchors["row"].to_numpy(), anchors["id"].to_numpy()
    row, ids = others["row"].to_numpy(), others["id"].to_numpy()
    out: list[list[np.ndarray]] = [[np.empty(0, dtype=np.int64)] for _ in range(5)]
    for nth, scores in _strips(_matrix(anchors), _matrix(others)) if len(anchors) and len(others) else ():
        other = np.flatnonzero(ids != anchor_id[nth])
        best = other[first_places(scores[other], ids[other], limit)]
        for values, column in zip((np.full(len(best), anchor_row[nth]), np.full(len(best), anchor_id[nth]), row[best], ids[best], scores[best]), out):
            column.append(values)
    names = ["anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score"]
    return pa.table([pa.array(np.concatenate(c)) for c in out], names=names)


def _negative_tile(table: pa.Table, window: tuple[int, int], limit: int) -> pa.Table:
    anchors, others = _by_side(table)
    label, ids, row = others["label"].to_numpy(), others["id"].to_numpy(), others["row"].to_numpy()
    labels, rows = anchors["label"].to_numpy(), anchors["row"].to_numpy()
    positives = anchors["positives"].to_pylist()
    out: list[list[np.ndarray]] = [[np.empty(0, dtype=np.int64)] for _ in range(5)]
    for nth, scores in _strips(_matrix(anchors), _matrix(others)) if len(anchors) and len(others) else ():
        wanted = np.array([p["positive_score"] for p in positives[nth]], dtype=np.int64)
        # Outside of the widest window no row counts.
        able = np.flatnonzero((label != labels[nth]) & (scores <= wanted.max()) & (100 * scores >= window[0] * wanted.min()))
        found = window_places(scores[able], ids[able], wanted, window, limit)
        for positive, places in zip(positives[nth], found):
            best = able[places]
            of = (rows[nth], positive["positive_row"])
            for values, column in zip((*(np.full(len(best), x) for x in of), row[best], ids[best], scores[best]), out):
                column.append(values)
    names = ["anchor_row", "positive_row", "negative_row", "negative_id", "negative_score"]
    return pa.table([pa.array(np.concatenate(c)) for c in out], names=names)


def _first(rows: DataFrame, keys: list[str], score: str, ident: str, row: str, limit: int, rank: str = "rank") -> DataFrame:
    """Merge heaps: the first ``limit`` rows of each key; Spark cuts before the shuffle as well as behind it."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(ident), F.asc(row))
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= limit)


def _tiles(anchors: DataFrame, candidates: DataFrame, keys: list[str], block: tuple[int, int]) -> DataFrame:
    """Every anchor block with every candidate block of equal ``keys``; blocks are dealt by a hash of the row."""

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    counts = blocks(anchors, block[0], "left_blocks").join(blocks(candidates, block[1], "right_blocks"), keys)
    counts = materialize(counts, "blocks")

    def dealt(rows: DataFrame, own: str, other: str, own_block: str, other_block: str, side: int) -> DataFrame:
        placed = rows.join(counts, keys).withColumn(own_block, F.pmod(F.xxhash64("row"), F.col(own)).cast("int"))
        return placed.withColumn(other_block, F.explode(F.expr(f"sequence(0, {other} - 1)"))).withColumn("side", F.lit(side))

    left = dealt(anchors, "left_blocks", "right_blocks", "left", "right", 0)
    right = dealt(candidates, "right_blocks", "left_blocks", "right", "left", 1)
    return left.unionByName(right, allowMissingColumns=True).drop("left_blocks", "right_blocks")


def prepare(
    vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``(row, id, label, dim, vector)`` of the rows that take part, with whole numbers as components.

    Equal rows count once. Rows without an id or label, and those whose vector is NULL, empty or holds a NULL or non-finite
    component, are left out; so are vectors whose norm after scaling, with 1 added to each component, is above
    ``MOST_NORM``, as their scores might not fit into 64 bits. Labels are numbered, so they may have any type.
    """
    vector = F.expr(f"transform(`{vector_col}`, x -> {scale} * cast(x as double))")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vector.alias("scaled"))
    finite = "forall(scaled, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    rows = rows.where(f"id is not null and label is not null and scaled is not null and size(scaled) > 0 and {finite}")
    # Whole numbers below lie within 1 of these.
    rows = rows.where(f"sqrt(aggregate(scaled, 0D, (a, x) -> a + (abs(x) + 1) * (abs(x) + 1))) <= {MOST_NORM}D")
    whole = rows.select("id", F.xxhash64("label").alias("label"), F.expr("transform(scaled, x -> cast(floor(x) as long))").alias("vector"))
    # Label numbers are 64-bit hashes of at most as many labels as rows.
    numbered = whole.dropDuplicates().withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("vector"))
    return numbered.select("row", "id", "label", "dim", "vector")


def mine_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    block: tuple[int, int] = (ANCHOR_BLOCK, CANDIDATE_BLOCK),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id is divisible by ``every``. A score is the whole-number product with the anchor; higher ones come
    first, ties by smaller id. An anchor's positives are its first ``positives`` rows of equal label and other id; per
    positive the first ``negatives`` rows of another label are returned whose score lies within ``window`` per cent of the
    positive's score. Vectors are compared with those of equal length. Which rows take part is stated at
    ``prepare``; rows of one id that differ count each, an anchor without positives or without rows inside a window gives
    no row, an empty table gives none, and other columns are not read.
    """
    rows = materialize(prepare(vectors, scale, id_col, vector_col, label_col), "vectors")
    anchors = rows.where(F.col("id") % every == 0)
    tiles = _tiles(anchors, rows, ["label", "dim"], block)
    heap = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long"
    heaps = tiles.groupBy("label", "dim", "left", "right").applyInArrow(lambda t: _positive_tile(t, positives), heap)
    best = _first(heaps, ["anchor_row"], "positive_score", "positive_id", "positive_row", positives)
    best = materialize(best.drop("rank"), "positives")

    listed = best.groupBy("anchor_row").agg(F.collect_list(F.struct("positive_row", "positive_score")).alias("positives"))
    # An anchor whose positives all score below 0 has only empty windows.
    listed = listed.where("exists(positives, p -> p.positive_score >= 0)")
    asking = anchors.join(listed, F.col("row") == F.col("anchor_row")).drop("anchor_row")
    tiles = _tiles(materialize(asking, "asking"), rows, ["dim"], block)
    heap = "anchor_row long, positive_row long, negative_row long, negative_id long, negative_score long"
    heaps = tiles.groupBy("dim", "left", "right").applyInArrow(lambda t: _negative_tile(t, window, negatives), heap)
    found = _first(heaps, ["anchor_row", "positive_row"], "negative_score", "negative_id", "negative_row", negatives)
    named = best.withColumnsRenamed({"anchor_row": "_anchor", "positive_row": "_positive"})
    found = found.join(named, (F.col("anchor_row") == F.col("_anchor")) & (F.col("positive_row") == F.col("_positive")))
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def with_shifted_labels(vectors: DataFrame, every: int = 7, labels: int = 10, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """Labels of rows whose id is divisible by ``every`` moved to the next of ``labels``."""
    shifted = F.when(F.col(id_col) % every == 0, (F.col(label_col) + 1) % labels).otherwise(F.col(label_col))
    return vectors.withColumn(label_col, shifted)
