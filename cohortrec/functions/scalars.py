"""Column functions; all of them stay inside whole-stage codegen or are plain built-ins."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the middle of the 1..5 rating scale used for centering is 2.5.
RATING_MIDPOINT = 2.5


def centered(rating: Column) -> Column:
    return rating - F.lit(RATING_MIDPOINT)


def round_half_up(value: Column) -> Column:
    """Half toward plus infinity: -0.5 gives 0.0. ``round`` would give -1.0."""
    return F.floor(value + F.lit(0.5)).cast("double")


def manhattan(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.abs(x1 - x2) + F.abs(y1 - y2)


def same_truncated(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Points are equal when both coordinates agree after dropping the fraction."""
    return (x1.cast("int") == x2.cast("int")) & (y1.cast("int") == y2.cast("int"))


def two_decimals(value: Column) -> Column:
    return F.format_string("%.2f", value)


def id_items(ids: Column) -> Column:
    """``"5,6,"`` to ``["5", "6"]``: empty items vanish, ``split`` alone would keep the last."""
    return F.filter(F.split(ids, ","), lambda item: item != "")
