"""Rendezvous hashing of record keys over weighted shards.

A key goes to the shard with the smallest ``-ln(u) / weight``, where ``u`` in (0, 1) is a hash of
key and shard. A shard's draw depends on nothing else, so a further shard only takes rows into
itself, and a removed one only gives its own rows away. Everything is one narrow column expression.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortrec.llm.ranks import gapless_rank
from cohortrec.plans.materialize import materialize


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard number of ``key``; shard ``i`` gets a share of ``weights[i]`` over their sum."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")

    def draw(shard: int, weight: float) -> Column:
        # 53 bits of the hash as a number strictly between 0 and 1.
        unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((-F.log(unit) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[draw(i, w) for i, w in enumerate(weights)]))["shard"]


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 8,
    grown: Sequence[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per input row.

    ``size`` is the UTF-8 length plus 1; NULL text has size 1 and the checksum of no bytes.
    ``grown_shard`` is the shard under the weights ``grown``, by default one more shard of the mean
    weight. Rows of one key, also of the NULL key, share a shard. Slots count from 0 without gaps
    in every shard: ranks inside one scan task's rows of a shard, plus the rows of the tasks
    before, so neither a large shard nor a repeated key meets in one task.
    """
    weights = list(weights)
    grown = [*weights, sum(weights) / len(weights)] if grown is None else list(grown)
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        rendezvous(F.col(id_col), weights).alias("shard"),
        rendezvous(F.col(id_col), grown).alias("grown_shard"),
        F.spark_partition_id().alias("part"),
    )
    placed = materialize(placed, "placed")
    return gapless_rank(placed, ["shard"], "part", ["doc_id"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def write_shards(
    docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * 8, files_per_shard: int = 16, id_col: str = "doc_id"
) -> None:
    """Write ``docs`` with all their columns below ``shard=N`` folders, about ``files_per_shard`` files each.

    A table that has a column ``shard`` gets folders with a longer name. Rows are dealt to files in
    turn, so neither a large shard nor a repeated key meets in one task.
    """
    name = "shard"
    while name in docs.columns:
        name += "_"
    placed = docs.withColumn(name, rendezvous(F.col(id_col), weights))
    file = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_shard))
    placed.repartition(len(weights) * files_per_shard, name, file).write.partitionBy(name).parquet(path)
