"""Id lists of any length, held in rows of bounded length.

A list per user or per cluster has no upper bound, so it is never built in one row or task.
It is cut into parts of ``part_size`` items: part 0 holds the smallest items, and only the last
part is shorter. A group that fits into one part is a single row with part 0. NULL items are no
entries; a group with nothing else has one row with an empty list. NULL is a key like any other.
"""

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.plans.materialize import materialize

LIST_PART_SIZE = 100_000


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], mark: str = "_") -> Column:
    """Equality of ``left``'s keys and ``right``'s keys named with ``mark``, in which NULL equals NULL."""
    return functools.reduce(Column.__and__, [left[k].eqNullSafe(right[f"{mark}{k}"]) for k in keys])


def marked(rows: DataFrame, keys: Sequence[str], mark: str = "_") -> DataFrame:
    return rows.withColumnsRenamed({k: f"{mark}{k}" for k in keys})


def list_start(counts: DataFrame, keys: Sequence[str], order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """Add ``start``: how many list entries of the group come before this row in ``order``.

    ``counts`` has one row per (keys, order) and its number of entries ``n``. The rows are range-partitioned
    at sampled bounds and written, so a window holds one range of a group whatever its size and
    however its items are spread; one total per (group, range) gives the entries before.
    """
    keys, order = list(keys), list(order)
    spark = counts.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    totals = ranged.groupBy(*keys, "_range").agg(F.sum("n").alias("_size"))
    offset = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_size")
    totals = marked(totals.select(*keys, "_range", offset.alias("_offset")), [*keys, "_range"])
    inside = F.sum("n").over(Window.partitionBy(*keys, "_range").orderBy(*order)) - F.col("n")
    placed = ranged.withColumn("_before", inside)
    placed = placed.join(totals, same_keys(placed, totals, [*keys, "_range"]))
    return placed.select(*counts.columns, (F.col("_offset") + F.col("_before")).alias("start"))


def cut_lists(
    entries: DataFrame,
    keys: Sequence[str],
    item: str,
    out: str,
    part_size: int,
    value: str | None = None,
    keep_empty: bool = True,
) -> DataFrame:
    """One row per (keys, part) with the ascending array ``out`` of that part's items.

    Without ``keep_empty`` groups of nothing but NULL items are left out, which saves reading ``entries`` again for their keys.

    With ``value`` the array holds ``struct(item, value)``, ascending by both. Entries are counted
    before the shuffle, so neither a long list nor an item that is repeated very often meets in one task.
    """
    keys = list(keys)
    fields = [item] if value is None else [item, value]
    counts = entries.where(F.col(item).isNotNull()).groupBy(*keys, *fields).agg(F.count("*").alias("n"))
    first_part, last_part = f"start div {part_size}", f"(start + n - 1) div {part_size}"
    begin = F.greatest(F.col("start"), F.col("part") * part_size)
    end = F.least(F.col("start") + F.col("n"), (F.col("part") + 1) * part_size)
    pieces = (
        list_start(counts, keys, fields)
        .withColumn("part", F.explode(F.expr(f"sequence({first_part}, {last_part})")))
        .withColumn("_copies", (end - begin).cast("int"))
    )

    def repeated(run: Column) -> Column:
        entry = run[item] if value is None else F.struct(*[run[f].alias(f) for f in fields])
        return F.array_repeat(entry, run["_copies"])

    runs = pieces.repartition(*keys, "part").groupBy(*keys, "part")
    runs = runs.agg(F.sort_array(F.collect_list(F.struct(*fields, "_copies"))).alias("_runs"))
    lists = runs.select(*keys, "part", F.flatten(F.transform("_runs", repeated)).alias(out))
    if not keep_empty:
        return lists

    groups = marked(entries.select(*keys).distinct(), keys)
    whole = groups.join(lists, same_keys(lists, groups, keys), "left")
    empty = F.array().cast(lists.schema[out].dataType)
    return whole.select(
        *[F.col(f"_{k}").alias(k) for k in keys],
        F.coalesce("part", F.lit(0).cast("long")).alias("part"),
        F.coalesce(out, empty).alias(out),
    )


def list_parts(
    entries: DataFrame,
    keys: Sequence[str],
    item: str,
    out: str,
    part_size: int = LIST_PART_SIZE,
    value: str | None = None,
    aggregates: Sequence[Column] = (),
    sizing: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``cut_lists``, with ``aggregates`` over the whole group repeated on each of its parts.

    ``sizing`` may be a cheaper frame whose rows per key bound the group size from above; a count over
    it finds the keys of groups that may not fit into one part. The plan is the same whatever it
    finds: those groups take ``cut_lists``, the others one ``groupBy``. Where there are none, adaptive
    execution sees the empty list of keys and drops that branch before it reads anything.
    """
    keys = list(keys)
    sizes = entries if sizing is None else sizing
    large = sizes.groupBy(*keys).agg(F.count("*").alias("_size")).where(F.col("_size") > part_size)
    large = materialize(marked(large.select(*keys), keys), "large_groups")

    # Shuffled first: lists do not shrink map-side, they would only be sorted there in vain.
    element = F.col(item) if value is None else F.when(F.col(item).isNotNull(), F.struct(item, value))
    rest = entries.join(large, same_keys(entries, large, keys), "left_anti")
    whole = rest.repartition(*keys).groupBy(*keys)
    whole = whole.agg(*aggregates, F.sort_array(F.collect_list(element)).alias(out))
    whole = whole.withColumn("part", F.lit(0).cast("long"))

    long = entries.join(large, same_keys(entries, large, keys), "left_semi")
    cut = cut_lists(long, keys, item, out, part_size, value)
    if aggregates:
        totals = marked(long.groupBy(*keys).agg(*aggregates), keys)
        cut = cut.join(totals, same_keys(cut, totals, keys)).drop(*[f"_{k}" for k in keys])
    return whole.unionByName(cut)


def joined(ids: Column) -> Column:
    """The comma-separated text form of an id array."""
    return F.array_join(ids.cast("array<string>"), ",")
