"""User profiles: ratings joined with titles, one aggregate row and one movie list per user."""

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrec.functions import centered, round_half_up
from cohortrec.operators.lists import LIST_PART_SIZE, list_parts


def center_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.select("rating_key", "movie_id", "user_id", centered(F.col("rating")).alias("centered"))


def watch_years(ratings: DataFrame) -> DataFrame:
    return ratings.select("rating_key", "movie_id", "user_id", F.year("watch_date").alias("watch_year"))


def rated_titles(ratings: DataFrame, titles: DataFrame) -> DataFrame:
    """Ratings with the release year of their movie; a rating of an unknown movie is dropped.

    ``titles`` has one row per movie; the readers and ``jobs.latest_tables`` see to that.

    The join carries no hint: the optimizer broadcasts titles when their measured size allows
    it and otherwise shuffles, where adaptive execution splits a movie with very many ratings.
    """
    return ratings.join(titles.select("movie_id", "release_year"), "movie_id").select(
        "user_id", "movie_id", "rating", F.year("watch_date").alias("watch_year"), "release_year"
    )


def _mean(value: Column) -> Column:
    # Sum and count merge exactly in any order for whole and half numbers; NULLs count on neither side.
    return F.sum(value.cast("double")) / F.count(value)


def build_profiles(ratings: DataFrame, titles: DataFrame, part_size: int = LIST_PART_SIZE) -> DataFrame:
    """Rounded means and the ascending movie list of every user, repeated ratings kept.

    A user with more than ``part_size`` ratings has several rows that differ in ``part`` and
    ``movies``; ``first_rows`` gives one row per user. Such users are found by a count over the user
    ids alone; all others take one shuffle of the ratings.
    """
    means = [
        round_half_up(_mean(centered(F.col("rating")))).alias("avg_rating"),
        round_half_up(_mean(F.col("watch_year"))).alias("avg_watch_year"),
        round_half_up(_mean(F.col("release_year"))).alias("avg_release_year"),
    ]
    return list_parts(
        rated_titles(ratings, titles),
        ["user_id"],
        "movie_id",
        "movies",
        part_size=part_size,
        aggregates=means,
        sizing=ratings,
    ).select("user_id", "avg_rating", "avg_watch_year", "avg_release_year", "part", "movies")


def first_rows(profiles: DataFrame) -> DataFrame:
    """Exactly one row per user."""
    return profiles.where("part = 0")


def user_movies(profiles: DataFrame) -> DataFrame:
    """One row per entry of the movie lists, repeats kept."""
    return profiles.select("user_id", F.explode("movies").alias("movie_id"))


def user_averages(ratings: DataFrame) -> DataFrame:
    """Unrounded means of the raw rating and the watch year."""
    return ratings.groupBy("user_id").agg(
        _mean(F.col("rating")).alias("avg_rating"),
        _mean(F.year("watch_date")).alias("avg_watch_year"),
    )


def rounded_means(ratings: DataFrame) -> DataFrame:
    """The mean centered rating of every user before and after rounding."""
    means = ratings.groupBy("user_id").agg(_mean(centered(F.col("rating"))).alias("mean_centered"))
    return means.withColumn("rounded", round_half_up(F.col("mean_centered")))


def average_histogram(averages: DataFrame, column: str) -> DataFrame:
    """How many users share each mean."""
    return averages.groupBy(F.col(column).alias("avg")).agg(F.count("*").alias("n"))


def lookup_profiles(profiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """Batch form of a keyed lookup: the averages and movies of the wanted users."""
    return profiles.join(wanted.select("user_id"), "user_id", "left_semi").select(
        "user_id", "avg_rating", "avg_watch_year", "part", "movies"
    )


LOOKUP_KEYS = 500


def write_lookup(profiles: DataFrame, path: str, parts: int | None = None, group_bytes: int = 16 << 20) -> None:
    """Profiles for look-ups by key: sorted by user, in small row groups with a bloom filter over the user ids."""
    spark = profiles.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = profiles.repartitionByRange(parts, "user_id", "part").sortWithinPartitions("user_id", "part")
    writer = ordered.write.option("parquet.bloom.filter.enabled#user_id", "true").option("parquet.block.size", group_bytes)
    writer.parquet(path)


def lookup_stored(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``lookup_profiles`` from a table of ``write_lookup``, reading few row groups.

    Up to ``LOOKUP_KEYS`` wanted users become comparisons that reach the scan, where statistics and bloom filters
    skip row groups; more of them are joined, since they touch most row groups anyway.
    """
    stored = spark.read.parquet(path)
    users = [r[0] for r in wanted.select("user_id").where("user_id is not null").distinct().limit(LOOKUP_KEYS + 1).collect()]
    if len(users) > LOOKUP_KEYS:
        return lookup_profiles(stored, wanted)
    same = functools.reduce(Column.__or__, [F.col("user_id") == user for user in sorted(users)], F.lit(False))
    return stored.where(same).select("user_id", "avg_rating", "avg_watch_year", "part", "movies")


def holdout_users(profiles: DataFrame, limit: int = 500) -> DataFrame:
    """The first users in the order of their key as text, with all parts of their lists.

    Planned as a top-k per task, so only ``limit`` rows per task reach the final merge.
    """
    key = F.col("user_id").cast("string")
    chosen = first_rows(profiles).where("user_id is not null").select("user_id").orderBy(key).limit(limit)
    return profiles.join(chosen, "user_id", "left_semi").select(
        "user_id", "avg_watch_year", "avg_release_year", "part", "movies"
    )
