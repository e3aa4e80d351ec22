import pytest
from pyspark.sql import functions as F

from cohortrec.functions import centered, id_items, manhattan, round_half_up, same_truncated, two_decimals


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("value, rounded", [(-0.5, 0.0), (0.5, 1.0), (-1.5, -1.0), (2.4, 2.0), (-0.6, -1.0)])
def test_round_half_up(spark, value, rounded):
    assert one(spark, round_half_up(F.lit(value))) == (rounded,)


def test_centered_and_text(spark):
    assert one(spark, centered(F.lit(1)), two_decimals(F.lit(1995.0))) == (-1.5, "1995.00")


def test_distances(spark):
    whole = [F.lit(v) for v in (1, 2, 4, -6)]
    assert one(spark, manhattan(*whole)) == (11,)


def test_same_truncated(spark):
    def same(*values):
        return one(spark, same_truncated(*[F.lit(v) for v in values]))[0]

    assert same(3.0, 4.0, 3.7, 4.2)
    assert not same(1.2, 5.9, 2.0, 5.9)
    assert same(-0.5, 0.0, 0.5, 0.0)


def test_id_items_drop_empty(spark):
    assert one(spark, id_items(F.lit("5,6,")), id_items(F.lit(""))) == (["5", "6"], [])
