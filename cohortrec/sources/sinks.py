"""Text sinks. A list longer than one part is several lines; files are as many as tasks that write."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortrec.functions import two_decimals
from cohortrec.operators.lists import joined


def _or_empty(value: Column) -> Column:
    """NULL as an empty field, so that no line loses a field."""
    return F.coalesce(value.cast("string"), F.lit(""))


def profile_lines(profiles: DataFrame) -> DataFrame:
    """``user <tab> rating,watch,release,movies`` with two decimals."""
    numbers = [
        _or_empty(F.when(F.col(c).isNotNull(), two_decimals(F.col(c))))
        for c in ("avg_rating", "avg_watch_year", "avg_release_year")
    ]
    fields = F.concat_ws(",", *numbers, _or_empty(joined(F.col("movies"))))
    return profiles.select(F.concat_ws("\t", _or_empty(F.col("user_id")), fields).alias("line"))


def holdout_lines(users: DataFrame) -> DataFrame:
    """``user,watch,release,"m1,m2"``, the layout that the test-user reader takes.

    Further parts of a list carry the user ``id#part``.
    """
    user = F.when(F.col("part") > 0, F.concat_ws("#", "user_id", "part")).otherwise(F.col("user_id").cast("string"))
    quoted = F.concat(F.lit('"'), _or_empty(joined(F.col("movies"))), F.lit('"'))
    features = [_or_empty(F.col(c)) for c in ("avg_watch_year", "avg_release_year")]
    return users.select(F.concat_ws(",", _or_empty(user), *features, quoted).alias("line"))


def recommendation_lines(titled: DataFrame) -> DataFrame:
    """An empty key, a tab, then ``user,title``; an unknown title prints as ``null``."""
    title = F.coalesce("title", F.lit("null"))
    return titled.select(F.concat(F.lit("\t"), F.concat_ws(",", _or_empty(F.col("user_id")), title)).alias("line"))


def pair_lines(pairs: DataFrame) -> DataFrame:
    """``user,movie``, the layout that the prediction-pair reader takes."""
    return pairs.select(F.concat_ws(",", "user_id", "movie_id").alias("line"))


def cluster_list_lines(lists: DataFrame) -> DataFrame:
    """``cluster <tab> m1,m2,...``"""
    return lists.select(F.concat_ws("\t", "cluster_id", "movies").alias("line"))


def title_list_lines(lists: DataFrame) -> DataFrame:
    """``user <tab> title,title,...``"""
    return lists.select(F.concat_ws("\t", "user_id", "titles").alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("overwrite").text(path)
