"""As-of join: every row with the last mark at or before it.

Marks are meant to be much fewer than rows. Each mark becomes the interval up to the next mark of its keys, cut at
the borders of equal buckets of the position, and rows find their interval by an equi-join on (keys, bucket) and a
comparison. Rows are never ranked. Where the intervals are small the optimizer broadcasts them and rows stay where they
are; where they are many, ``hashed`` makes them the hashed side of a shuffle, so that rows are not sorted either.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.operators.lists import marked, same_keys

BUCKET = 4096


def mark_intervals(marks: DataFrame, keys: Sequence[str], at: str, ends: DataFrame, end: str) -> DataFrame:
    """``marks`` with ``_until``, the position of the next mark of the same keys, or one past ``ends``' last position.

    ``marks`` must not repeat a position inside its keys. Marks of one key are sorted in one task.
    """
    keys = list(keys)
    following = F.lead(at).over(Window.partitionBy(*keys).orderBy(at))
    last = marked(ends.select(*keys, F.col(end).alias("_end")), keys)
    joined = marks.withColumn("_next", following).join(last, same_keys(marks, last, keys))
    until = F.coalesce("_next", F.col("_end") + 1)
    return joined.withColumn("_until", until).drop("_next", "_end", *[f"_{k}" for k in keys])


def asof_join(
    rows: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, bucket: int = BUCKET, hashed: bool = False
) -> DataFrame:
    """All columns of ``rows`` with those of the interval ``[at, _until)`` of equal keys that holds their position.

    Rows before the first mark of their keys, or without one, are left out; NULL keys are equal to each other. The
    columns of ``intervals`` other than keys and position must have names of their own. Any ``bucket`` gives the
    same rows; a good one holds few marks, so that a row is compared with few.
    """
    keys = list(keys)
    buckets = F.expr(f"sequence(floor({at} / {bucket}), floor((_until - 1) / {bucket}))")
    cut = intervals.where(F.col("_until") > F.col(at)).withColumn("_bucket", F.explode(buckets))
    cut = marked(cut, [*keys, at, "_bucket"])
    placed = rows.withColumn("_bucket", F.floor(F.col(at) / bucket))
    inside = (placed[at] >= cut[f"_{at}"]) & (placed[at] < cut["_until"])
    cut_side = cut.hint("shuffle_hash") if hashed else cut
    found = placed.join(cut_side, same_keys(placed, cut, [*keys, "_bucket"]) & inside)
    return found.drop("_bucket", "_until", *[f"_{c}" for c in (*keys, at, "_bucket")])
