"""Gapless ranks inside groups of any size."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gapless_rank(rows: DataFrame, keys: Sequence[str], part: str, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... inside every group of ``keys``.

    ``part`` is a column of a written table that cuts the rows into pieces of bounded size, such as
    the scan task that wrote them. Rows are ranked inside (group, part), and one count per (group,
    part) gives the rows before it, so a group with a third of all rows meets in no task.
    """
    keys = list(keys)
    counts = rows.groupBy(*keys, part).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy(part)) - F.col("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order)) - 1
    return (
        rows.withColumn("_inside", inside)
        .join(counts.select(*keys, part, before.alias("_before")), [*keys, part])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )
