"""Table sources and sinks: Parquet tables that are replaced or updated by key, and SQL-visible views."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrec.operators.lists import joined, list_parts, marked, same_keys
from cohortrec.plans.materialize import materialize


def _hadoop(spark: SparkSession, path: str):
    """The file system and path object of ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop(spark, path)
    return files.exists(target)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    files, source = _hadoop(spark, path)
    if not files.rename(source, _hadoop(spark, to)[1]):
        raise OSError(f"{path} was not renamed to {to}")


def _remove(spark: SparkSession, path: str) -> None:
    files, target = _hadoop(spark, path)
    files.delete(target, True)


def _sides(path: str) -> tuple[str, str]:
    """Where a replacement writes its rows, and where the replaced ones stand until it is done."""
    return f"{path.rstrip('/')}.new", f"{path.rstrip('/')}.old"


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table; naming ``columns`` narrows the scan to them.

    If a replacement broke off between its two renames, the replaced rows are read.
    """
    old = _sides(path)[1]
    table = spark.read.parquet(old if not _exists(spark, path) and _exists(spark, old) else path)
    return table if columns is None else table.select(*columns)


def replace_table(df: DataFrame, path: str) -> None:
    """Write a new snapshot beside the table at ``path``, then put it in its place by renaming folders.

    The old rows are there until the new ones are complete: a write that fails leaves the table as it was, and after a
    driver that dies between the renames ``read_table`` finds the old rows and the next replacement puts them back
    first. ``df`` may read the table it replaces. One writer at a time; where a rename copies, as in object
    stores, the time between the renames is that of the copy.
    """
    spark = df.sparkSession
    new, old = _sides(path)
    if _exists(spark, old):
        if _exists(spark, path):
            _remove(spark, old)
        else:
            _rename(spark, old, path)
    df.write.mode("overwrite").parquet(new)
    if _exists(spark, path):
        _rename(spark, path, old)
    _rename(spark, new, path)
    _remove(spark, old)


BUCKETS = 64
BUCKET_COLUMN = "bucket_of_"  # followed by the number of buckets, so the files say how they are cut


def _bucketed(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(f"{BUCKET_COLUMN}{buckets}", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def _write_buckets(rows: DataFrame, path: str, key: Sequence[str], buckets: int, files: int, mode: str) -> None:
    column = f"{BUCKET_COLUMN}{buckets}"
    file = F.pmod(F.xxhash64(F.lit(column), *key), F.lit(files))
    writer = rows.repartition(column, file).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)


def write_keyed(rows: DataFrame, path: str, key: Sequence[str], buckets: int = BUCKETS, files: int = 1) -> None:
    """A table cut by a hash of its key into ``buckets`` folders of up to about ``files`` files each.

    Take as many buckets as make one a few hundred megabytes or more. ``rows`` has one row per key, see ``latest_rows``.
    """
    _write_buckets(_bucketed(rows, key, buckets), path, key, buckets, files, "errorifexists")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table of ``write_keyed``."""
    table = spark.read.parquet(path)
    return table.drop(*[c for c in table.columns if c.startswith(BUCKET_COLUMN)])


def upsert_keyed(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str], files: int = 1) -> list[int]:
    """Replace or add the rows of ``updates``, one row per key, in the table at ``path``; returns the buckets it wrote.

    Only buckets that hold a key of ``updates`` are read and written; files of all others stay as they are. The driver
    sees bucket numbers alone. NULL is a key like any other. The merged buckets are written to the shared folder first,
    so they can be written again should the switch of their folders break off. One writer at a time.
    """
    table = spark.read.parquet(path)
    column = next(c for c in table.columns if c.startswith(BUCKET_COLUMN))
    buckets = int(column.removeprefix(BUCKET_COLUMN))
    placed = materialize(_bucketed(updates, key, buckets), "updates")
    touched = sorted(r[0] for r in placed.select(column).distinct().collect())
    if not touched:
        return []
    wanted = marked(placed.select(*key), key)
    old = table.where(F.col(column).isin(touched))
    kept = old.join(wanted, same_keys(old, wanted, key), "left_anti")
    merged = materialize(kept.unionByName(placed), "merged")
    _write_buckets(merged, path, key, buckets, files, "overwrite")
    return touched


def latest_rows(rows: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Keyed upsert: of all rows with one key the greatest ``version`` stays.

    Columns outside of ``version`` break ties, so the result does not depend on row order. The
    maximum is taken map-side first, so a key that holds a large share of the rows is cheap.
    """
    rest = [c for c in rows.columns if c not in {*key, *version}]
    newest = F.max(F.struct(*version, *rest)).alias("_newest")
    columns = [F.col(c) if c in key else F.col(f"_newest.{c}").alias(c) for c in rows.columns]
    return rows.groupBy(*key).agg(newest).select(*columns)


def upsert(table: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """A new snapshot of ``table`` in which ``updates``, one row per key, replace or add rows."""
    kept = table.join(updates.select(*key), list(key), "left_anti")
    return kept.unionByName(updates)


def wide_rows(ratings: DataFrame, part_size: int | None = None) -> DataFrame:
    """One open map ``values`` of movie to rating per user; the latest rating of a movie counts.

    Users with more movies than ``part_size`` get several rows, told apart by ``part``. A rating
    without a movie is no cell.
    """
    newest = F.max(F.struct("watch_date", "rating")).alias("_newest")
    latest = ratings.where("movie_id is not null").groupBy("user_id", "movie_id").agg(newest)
    latest = latest.select("user_id", "movie_id", F.col("_newest.rating").alias("rating"))
    size = {} if part_size is None else {"part_size": part_size}
    parts = list_parts(latest, ["user_id"], "movie_id", "_cells", value="rating", sizing=ratings, **size)
    text_cell = F.transform(
        "_cells",
        lambda cell: F.struct(cell["movie_id"].cast("string"), cell["rating"].cast("string")),
    )
    return parts.select("user_id", "part", F.map_from_entries(text_cell).alias("values"))


def wide_cells(wide: DataFrame) -> DataFrame:
    """The map rows of ``wide_rows`` back in long form."""
    return wide.select("user_id", F.explode("values").alias("movie_id", "rating")).select(
        "user_id",
        F.col("movie_id").cast("long").alias("movie_id"),
        F.col("rating").cast("int").alias("rating"),
    )


def register_views(profiles: DataFrame, assignments: DataFrame, prefix: str = "") -> None:
    """Make clustered profiles and classified test users visible to SQL, with flat typed columns.

    The views are named ``profiles`` and ``knn_assignments`` behind ``prefix``.
    """
    typed = ("user_id", "avg_release_year", "avg_watch_year", "avg_rating", "membership", "part")
    for name, frame in (("profiles", profiles), ("knn_assignments", assignments)):
        columns = [c for c in typed if c in frame.columns]
        movies = [joined(F.col("movies")).alias("movies")] if "movies" in frame.columns else []
        frame.select(*columns, *movies).createOrReplaceTempView(f"{prefix}{name}")
