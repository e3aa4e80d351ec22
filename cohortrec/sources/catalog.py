"""Catalog tables: stated columns, bucketed files, and statistics that the optimizer uses in every session of the catalog."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.operators.lists import joined

# Columns of the tables that SQL sees, in order, with their types.
PROFILES = "user_id long, avg_release_year double, avg_watch_year double, avg_rating double, membership int, part long, movies string"
ASSIGNMENTS = "user_id long, avg_release_year double, avg_watch_year double, membership int, part long, movies string"
UNCOUNTED = ("array", "map", "struct", "binary", "variant")


def save_table(
    df: DataFrame, name: str, path: str, bucket_by: Sequence[str] = (), buckets: int = 0, schema: str | None = None
) -> DataFrame:
    """Write ``df`` below ``path``, name it in the catalog, and collect the statistics of its columns.

    With ``bucket_by`` rows are dealt to ``buckets`` files by a hash of these columns and sorted by them in each, so that tables
    with equal buckets join and group by them without an exchange, however often. ``schema`` states the columns to
    keep and their types. Replaces a table of the same name; the rows of a dropped table stay at its path, and other
    sessions that have read it refresh it first.
    """
    spark = df.sparkSession
    if schema is not None:
        stated = [field.strip().rsplit(" ", 1) for field in schema.split(",")]
        df = df.select(*[F.col(column).cast(kind).alias(column) for column, kind in stated])
    if bucket_by:
        writer = df.repartition(buckets, *bucket_by).write.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    else:
        writer = df.write
    writer.mode("overwrite").option("path", path).format("parquet").saveAsTable(name)
    counted = [f"`{column}`" for column, kind in df.dtypes if not kind.startswith(UNCOUNTED)]
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(counted)}")
    return spark.table(name)


def save_cohorts(profiles: DataFrame, assignments: DataFrame, path: str, prefix: str = "") -> None:
    """The tables of ``register_views``, kept in the catalog beyond the session: ``profiles`` and ``knn_assignments``."""
    for name, frame, schema in (("profiles", profiles, PROFILES), ("knn_assignments", assignments, ASSIGNMENTS)):
        flat = frame.withColumn("movies", joined(F.col("movies")))
        save_table(flat, f"{prefix}{name}", f"{path}/{name}", schema=schema)


def save_facts(ratings: DataFrame, titles: DataFrame, path: str, prefix: str = "", buckets: int = 64) -> tuple[DataFrame, DataFrame]:
    """Ratings and titles bucketed by movie, so that every build from them joins without an exchange.

    Take as many buckets as make one a few hundred megabytes. A movie lies in one bucket: where one has a large share of all
    ratings, join the plain tables instead, which adaptive execution splits.
    """
    kept = [
        save_table(frame, f"{prefix}{name}", f"{path}/{name}", ["movie_id"], buckets)
        for name, frame in (("ratings", ratings), ("titles", titles))
    ]
    return kept[0], kept[1]
