"""Text sources.

Each format has a reader that takes a path and a parser that takes the lines as a DataFrame.
Where the order of lines matters, lines carry their place in the input: ``file``, ``split``
(byte offset of the scan split in the file) and ``seq`` (ascending inside a split). A split is
bounded by ``spark.sql.files.maxPartitionBytes``, so no step needs a whole file in one task.

One rule holds for bad input everywhere: a row whose ids cannot be parsed is left out, any other
value that cannot be parsed is NULL.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cohortrec.functions import id_items
from cohortrec.operators.asof import asof_join, mark_intervals
from cohortrec.operators.lists import list_start
from cohortrec.plans.materialize import materialize
from cohortrec.sources.schemas import RATINGS

PLACE = ["file", "split", "seq"]
# Headers up to which the optimizer may broadcast them, some megabytes; beyond, they are hashed in a shuffle.
MANY_HEADERS = 100_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` with its place in the input; partition directories appear as columns."""
    return spark.read.text(path).select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
    )


def _rating_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RATINGS).csv(path, dateFormat="yyyy-MM-dd")


_RATING_IDS = "user_id is not null and movie_id is not null"


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``rating_key,movie_id,user_id,rating,watch_date`` without a header line."""
    return _rating_lines(spark, path).where(_RATING_IDS)


def rejected_ratings(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_ratings`` leaves out, for keeping; to count them see ``parse_ratings``."""
    return _rating_lines(spark, path).where(f"not ({_RATING_IDS})")


# Fixed name of the column that keeps a line of which some field could not be parsed.
DAMAGED = "_damaged"


def parse_ratings(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows of ``read_ratings`` from a ``value`` column, and what the same pass counts on its way.

    The observation is filled by the first action on the rows: ``lines`` read, ``kept``, ``rejected`` for want of an id, and
    ``damaged`` ones with a field that could not be parsed, kept or not. Nothing is read twice for them.
    """
    options = {"dateFormat": "yyyy-MM-dd", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED}
    ddl = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in RATINGS), f"{DAMAGED} string"])
    rows = lines.select(F.from_csv("value", ddl, options).alias("_row")).select("_row.*")
    counts = Observation("ratings")
    kept = F.expr(_RATING_IDS)
    observed = rows.observe(
        counts,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("rejected"),
        F.count_if(F.col(DAMAGED).isNotNull()).alias("damaged"),
    )
    return observed.where(kept).drop(DAMAGED), counts


def read_counted_ratings(spark: SparkSession, path: str) -> tuple[DataFrame, Observation]:
    """``read_ratings`` with counts of what it leaves out."""
    return parse_ratings(spark.read.text(path))


def parse_titles(lines: DataFrame) -> DataFrame:
    """``movie_id,release_year,title``; commas inside the title belong to the title.

    An unparsable year is NULL, a line without a numeric id is dropped. Of several lines of one movie the
    last one counts where lines carry their place; without it they must not repeat a movie.
    """
    fields = F.split("value", ",", 3)
    title = F.get(fields, F.lit(2))
    inner = F.replace(title.substr(F.lit(2), F.length(title) - 2), F.lit('""'), F.lit('"'))
    unquoted = F.when(title.rlike('^".*"$'), inner)
    placed = [F.struct(*PLACE).alias("_place")] if set(PLACE) <= set(lines.columns) else []
    rows = lines.select(
        F.get(fields, F.lit(0)).try_cast("long").alias("movie_id"),
        F.get(fields, F.lit(1)).try_cast("int").alias("release_year"),
        F.coalesce(unquoted, title).alias("title"),
        *placed,
    ).where("movie_id is not null")
    if not placed:
        return rows
    last = F.max_by(F.struct("release_year", "title"), "_place").alias("_last")
    return rows.groupBy("movie_id").agg(last).select("movie_id", "_last.release_year", "_last.title")


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """One row per movie; later lines replace earlier ones."""
    return parse_titles(read_lines(spark, path))


# Fixed format of a test-user line: four fields, each of which may be quoted.
TEST_USER_LINE = "^" + ",".join([r'(?:"([^"]*)"|([^,"]*))'] * 4) + "$"


def parse_test_users(lines: DataFrame) -> DataFrame:
    """Lines with exactly four fields; of several lines of one user the last one counts.

    A list longer than one line goes on in lines with the user ``id#part``; each part is replaced on its
    own. A column ``part`` takes the place of that mark.
    """

    def field(index: int) -> Column:
        quoted, bare = (F.regexp_extract("value", TEST_USER_LINE, 2 * index - k) for k in (1, 0))
        return F.concat(quoted, bare)

    user = F.split(field(1), "#", 2)
    marked = F.coalesce(F.get(user, F.lit(1)), F.lit("0")).try_cast("long")
    part = F.col("part").cast("long") if "part" in lines.columns else marked
    rows = lines.where(F.col("value").rlike(TEST_USER_LINE)).select(
        F.get(user, F.lit(0)).try_cast("long").alias("user_id"),
        part.alias("part"),
        F.struct(*PLACE).alias("_place"),
        F.struct(
            field(2).try_cast("double").alias("avg_watch_year"),
            field(3).try_cast("double").alias("avg_release_year"),
            field(4).alias("movies"),
        ).alias("_row"),
    )
    return (
        rows.where("user_id is not null and part is not null")
        .groupBy("user_id", "part")
        .agg(F.max_by("_row", "_place").alias("_row"))
        .select("user_id", "_row.avg_watch_year", "_row.avg_release_year", "part", "_row.movies")
    )


def read_test_users(spark: SparkSession, path: str) -> DataFrame:
    return parse_test_users(read_lines(spark, path))


def with_movie_arrays(test_users: DataFrame) -> DataFrame:
    """The list text of ``movies`` as an id array."""
    ids = F.transform(id_items(F.col("movies")), lambda item: item.try_cast("long"))
    return test_users.withColumn("movies", F.filter(ids, lambda movie: movie.isNotNull()))


def parse_seed_centroids(lines: DataFrame, k: int) -> DataFrame:
    """The first ``k`` ``x,y`` lines, numbered from 0 in line order; other lines are skipped."""
    fields = F.split("value", ",")
    points = lines.select(
        *PLACE, F.get(fields, F.lit(0)).try_cast("double").alias("x"), F.get(fields, F.lit(1)).try_cast("double").alias("y")
    ).where("x is not null and y is not null")
    first = points.orderBy(*PLACE).limit(k)
    numbered = first.withColumn("_rn", F.row_number().over(Window.orderBy(*PLACE)))
    return numbered.select((F.col("_rn") - 1).cast("int").alias("cluster_id"), "x", "y")


def read_seed_centroids(spark: SparkSession, path: str, k: int) -> DataFrame:
    """Fails when the file holds fewer than ``k`` seeds."""
    seeds = parse_seed_centroids(read_lines(spark, path), k)
    found = seeds.count()
    if found < k:
        raise ValueError(f"{k} seed centroids needed, {found} found in {path}")
    return seeds


def split_marks(lines: DataFrame) -> DataFrame:
    """One row per split: ``first`` and ``last`` position, ``n`` lines, and the marks among them.

    Marks are the lines that are no data, headers and blank lines: ``struct(seq, header)`` with a NULL header for blank
    ones. A split is bounded, and so is its list.
    """
    value = F.col("value")
    is_header = value.contains(":")
    header = F.when(is_header, F.replace("value", F.lit(":"), F.lit("")))
    mark = F.when(is_header | (value == ""), F.struct(F.col("seq"), header.alias("header")))
    return lines.groupBy("file", "split").agg(
        F.min("seq").alias("first"), F.max("seq").alias("last"), F.count("*").alias("n"), F.collect_list(mark).alias("marks")
    )


def header_intervals(splits: DataFrame) -> DataFrame:
    """From where to where in a split each header holds: ``(file, split, seq, _until, header, base)``.

    ``base`` is what a data line adds to its position for its running key. The first interval of a split starts in front
    of it and holds the last header above in the same file, found among one row per split. Keys run on
    over all files: the data lines before a split are summed over ranges of splits.
    """
    in_file = Window.partitionBy("file").orderBy("split")
    headers = F.filter(F.array_sort("marks"), lambda m: m["header"].isNotNull())
    own = F.try_element_at(headers, F.lit(-1))["header"]
    data = splits.withColumn("n", F.col("n") - F.size("marks"))
    placed = list_start(data.select("file", "split", "n"), [], ["file", "split"]).drop("n")
    above = F.last(own, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    carried = splits.withColumn("above", above).join(placed, ["file", "split"])
    in_split = Window.partitionBy("file", "split").orderBy("seq")
    opening = F.array(F.struct((F.col("first") - 1).alias("seq"), F.col("above").alias("header")))
    marks = carried.select(
        "file", "split", "last", (F.col("start") - F.col("first")).alias("_shift"), F.inline(F.concat(opening, "marks"))
    )
    # The opening mark stands for no line, so the first line of a split has no mark before it.
    before = F.count(F.lit(1)).over(in_split) - 1
    marks = marks.withColumn("_header", F.last("header", ignorenulls=True).over(in_split)).withColumn("base", F.col("_shift") - before)
    intervals = mark_intervals(marks, ["file", "split"], "seq", splits, "last")
    return intervals.select("file", "split", "seq", "_until", F.col("_header").alias("header"), "base")


def carry_header(lines: DataFrame) -> DataFrame:
    """Give every data line the last ``movie_id:`` header above it in its file, and a running key.

    ``(rating_key, header, value)``. Positions must count without gaps inside a split, as ``read_lines`` does. Headers are few, so
    lines are joined as of the last one: their text is not sorted for it, and not shuffled while the
    headers fit into a broadcast. A file of any size spreads over the cluster by its splits.
    """
    splits = materialize(split_marks(lines), "splits")
    gaps = splits.where(F.col("last") - F.col("first") + 1 != F.col("n"))
    if not gaps.isEmpty():
        raise ValueError("the lines of a split must be numbered without gaps")
    # Intervals per bucket are about as many as headers: rows are compared with few of them.
    lines_n, marks_n = splits.agg(F.sum("n"), F.sum(F.size("marks"))).first()
    bucket = min(max(2 * (lines_n or 0) // ((marks_n or 0) + 1), 16), 1 << 20)
    intervals = materialize(header_intervals(splits), "headers")
    data = lines.select(*PLACE, "value").where(~F.col("value").contains(":") & (F.col("value") != ""))
    found = asof_join(data, intervals, ["file", "split"], "seq", bucket, hashed=(marks_n or 0) > MANY_HEADERS)
    return found.select((F.col("seq") + F.col("base")).alias("rating_key"), "header", "value")


def parse_headered(lines: DataFrame) -> DataFrame:
    """``movie_id:`` lines followed by ``user_id,rating,watch_date`` lines, to ratings.

    ``rating_key`` runs from 0 over all data lines in (file, line) order.
    """
    fields = F.split("value", ",")
    return (
        carry_header(lines)
        .select(
            "rating_key",
            F.col("header").try_cast("long").alias("movie_id"),
            F.get(fields, F.lit(0)).try_cast("long").alias("user_id"),
            F.get(fields, F.lit(1)).try_cast("int").alias("rating"),
            F.get(fields, F.lit(2)).try_cast("date").alias("watch_date"),
        )
        .where(_RATING_IDS)
    )


def read_headered(spark: SparkSession, path: str) -> DataFrame:
    """Any number of headers per file; blank lines are skipped."""
    return parse_headered(read_lines(spark, path))


def parse_cluster_list(lines: DataFrame) -> DataFrame:
    """``cluster_id <tab> m1,m2,...`` to one row per (cluster, movie), repeats kept."""
    fields = F.split("value", "\t", 2)
    items = F.explode(id_items(F.get(fields, F.lit(1)))).alias("movie_id")
    return (
        lines.select(F.get(fields, F.lit(0)).try_cast("int").alias("cluster_id"), items)
        .withColumn("movie_id", F.col("movie_id").try_cast("long"))
        .where("cluster_id is not null and movie_id is not null")
    )


def read_cluster_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_cluster_list(spark.read.text(path))


def parse_member_list(members: DataFrame) -> DataFrame:
    """``(cluster_id, members)`` with a comma-separated list to one row per (cluster, user)."""
    users = members.select("cluster_id", F.explode(id_items(F.col("members"))).alias("user_id"))
    return users.withColumn("user_id", F.col("user_id").try_cast("long")).where("user_id is not null")


def parse_prediction_pairs(lines: DataFrame) -> DataFrame:
    """``user_id,movie_id`` lines."""
    fields = F.split("value", ",")
    pair = [F.get(fields, F.lit(i)).try_cast("long").alias(name) for i, name in enumerate(("user_id", "movie_id"))]
    return lines.select(*pair).where("user_id is not null and movie_id is not null")


def read_prediction_pairs(spark: SparkSession, path: str) -> DataFrame:
    return parse_prediction_pairs(spark.read.text(path))


# Fixed pattern of one CSV cell: a quoted text with doubled quotes, or a text without a comma. The
# possessive quantifiers never step back, so a cell of any length needs no recursion.
CSV_CELL = r'(?:^|,)(\s*+"[^"]*+(?:""[^"]*+)*+"\s*+|[^,]*)'


def cells_to_rows(lines: DataFrame) -> DataFrame:
    """Every non-blank cell of comma-separated lines as one trimmed row."""
    cells = lines.select(F.explode(F.regexp_extract_all("value", F.lit(CSV_CELL), 1)).alias("cell"))
    trimmed = cells.select(F.trim("cell").alias("cell"))
    inner = F.col("cell").substr(F.lit(2), F.length("cell") - 2)
    unquoted = F.trim(F.replace(inner, F.lit('""'), F.lit('"')))
    return trimmed.select(
        F.when(F.col("cell").rlike('(?s)^".*"$'), unquoted).otherwise(F.col("cell")).alias("cell")
    ).where("cell <> ''")


def first_field(lines: DataFrame) -> DataFrame:
    """Lines with a comma, cut before the first one."""
    return lines.where(F.col("value").contains(",")).select(
        F.substring_index("value", ",", 1).alias("field")
    )
