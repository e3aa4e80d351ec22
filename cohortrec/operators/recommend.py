"""Movies of a cluster, and the ones among them that a user has not seen.

``titles`` has one row per movie everywhere; the readers and ``jobs.latest_tables`` see to that.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.operators.lists import LIST_PART_SIZE, cut_lists, joined, list_parts, list_start
from cohortrec.operators.membership import CLUSTER_PART_SIZE
from cohortrec.plans.materialize import materialize

RECOMMENDATIONS = 10
# Ranks per join bucket in the capped search, and per slice of a cluster in the uncapped one.
RANK_BUCKET = 64
SLICE = 4096


def _cluster_entries(clustered: DataFrame) -> DataFrame:
    placed = clustered.where("membership is not null")
    return placed.select(F.col("membership").alias("cluster_id"), F.explode("movies").alias("movie_id"))


def cluster_movies(clustered: DataFrame) -> DataFrame:
    """Distinct (cluster, movie); repeats are removed map-side before the shuffle."""
    return _cluster_entries(clustered).distinct()


def cluster_movie_list(clustered: DataFrame, part_size: int = CLUSTER_PART_SIZE) -> DataFrame:
    """The ascending movie list of every cluster with repeats, ``part_size`` entries per row."""
    parts = cut_lists(_cluster_entries(clustered), ["cluster_id"], "movie_id", "_ids", part_size, keep_empty=False)
    return parts.select("cluster_id", "part", joined(F.col("_ids")).alias("movies"))


def watched_movies(test_users: DataFrame) -> DataFrame:
    """Distinct (user, movie) of the test users' own lists."""
    return test_users.select("user_id", F.explode("movies").alias("movie_id")).distinct()


def _labels(test_users: DataFrame) -> DataFrame:
    firsts = test_users.where("part = 0") if "part" in test_users.columns else test_users
    return firsts.select("user_id", F.col("membership").alias("cluster_id"))


def ranked_movies(movies: DataFrame, order: Sequence[str | Column] = ("movie_id",)) -> DataFrame:
    """``movies`` with ``start``, the place of each movie in its cluster from 0."""
    return list_start(movies.withColumn("n", F.lit(1).cast("long")), ["cluster_id"], order).drop("n")


def unseen_movies(test_users: DataFrame, movies: DataFrame, watched: DataFrame) -> DataFrame:
    """All movies of a test user's cluster without the watched ones: ``(user_id, movie_id)``.

    The result is as long as (test users x movies of their cluster), so ask for it only where all of
    it is wanted. A cluster is one of few join keys: its movies are joined in slices of ``SLICE``
    ranks, as many as the cluster needs.
    """
    sliced = ranked_movies(movies).withColumn("_slice", F.expr(f"start div {SLICE}")).drop("start")
    sizes = sliced.groupBy("cluster_id").agg(F.max("_slice").alias("_last"))
    spread = _labels(test_users).join(sizes, "cluster_id")
    spread = spread.withColumn("_slice", F.explode(F.expr("sequence(0L, _last)")))
    offered = spread.join(sliced, ["cluster_id", "_slice"]).select("user_id", "movie_id")
    return offered.join(watched, ["user_id", "movie_id"], "left_anti")


def first_unseen(
    test_users: DataFrame,
    movies: DataFrame,
    watched: DataFrame,
    limit: int = RECOMMENDATIONS,
    order: Sequence[str | Column] = ("movie_id",),
) -> DataFrame:
    """The first ``limit`` unseen movies per test user in ``order``: ``(user_id, movie_id, rn)``.

    A user who watched ``w`` movies finds the first ``limit`` unseen ones among the first
    ``limit + w`` movies of the cluster, since the watched ones can push out at most ``w``.
    Movies are ranked once per cluster, and only these are joined, by (cluster, rank bucket), so the
    work is the limit plus the watched movies of each user whatever the size of the cluster.
    """
    unseen = movies.sparkSession.sql(
        f"""
        WITH seen AS (SELECT user_id, count(*) AS n FROM {{watched}} GROUP BY user_id),
        reach AS (
          SELECT l.user_id, l.cluster_id, {limit} + coalesce(seen.n, 0) AS reach
          FROM {{labels}} l LEFT JOIN seen ON l.user_id = seen.user_id),
        wanted AS (
          SELECT *, explode(sequence(0L, (reach - 1) div {RANK_BUCKET})) AS bucket FROM reach),
        ranked AS (SELECT *, start div {RANK_BUCKET} AS bucket FROM {{ranked}}),
        offered AS (
          SELECT user_id, movie_id, start FROM wanted JOIN ranked USING (cluster_id, bucket) WHERE start < reach)
        SELECT user_id, movie_id, start FROM offered ANTI JOIN {{watched}} USING (user_id, movie_id)
        """,
        ranked=ranked_movies(movies, order),
        labels=_labels(test_users),
        watched=watched,
    )
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("start"))
    return unseen.withColumn("rn", rank).where(F.col("rn") <= limit).drop("start")


def recommend(
    test_users: DataFrame,
    movies: DataFrame,
    titles: DataFrame,
    limit: int | None = RECOMMENDATIONS,
    order: Sequence[Column] | None = None,
    watched: DataFrame | None = None,
) -> DataFrame:
    """Unseen movies of the cluster with their titles; a movie without a title gets NULL.

    ``limit=None`` gives all of them. Ascending movie id is the default order of the cap;
    another ``order`` may use any column of ``titles``, and ties take the smaller movie id.
    """
    watched = watched_movies(test_users) if watched is None else watched
    named = titles.select("movie_id", "title")
    if limit is None:
        return unseen_movies(test_users, movies, watched).join(named, "movie_id", "left").select(
            "user_id", "movie_id", "title"
        )
    if order is None:
        top = first_unseen(test_users, movies, watched, limit)
    else:
        described = movies.join(titles, "movie_id", "left")
        top = first_unseen(test_users, described, watched, limit, [*order, F.col("movie_id")])
    return top.join(named, "movie_id", "left").select("user_id", "movie_id", "title", "rn")


def unseen_summary(test_users: DataFrame, movies: DataFrame, watched: DataFrame) -> DataFrame:
    """Number, first and last id of all unseen movies per test user, without listing them.

    The number is the size of the cluster less the watched movies in it; the ends are capped searches
    from both sides.
    """
    sizes = movies.groupBy("cluster_id").agg(F.count("*").alias("size"))
    labels = _labels(test_users).where("cluster_id is not null")
    inside = watched.join(labels, "user_id").join(movies, ["cluster_id", "movie_id"])
    inside = inside.groupBy("user_id").agg(F.count("*").alias("seen"))
    counts = labels.join(sizes, "cluster_id").join(inside, "user_id", "left")
    counts = counts.select("user_id", (F.col("size") - F.coalesce("seen", F.lit(0))).alias("n"))
    first = first_unseen(test_users, movies, watched, 1).select("user_id", F.col("movie_id").alias("first_movie_id"))
    last = first_unseen(test_users, movies, watched, 1, [F.desc("movie_id")])
    last = last.select("user_id", F.col("movie_id").alias("last_movie_id"))
    return counts.join(first, "user_id").join(last, "user_id")


def unseen_factors(test_users: DataFrame, movies: DataFrame, watched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``unseen_movies`` without listing them: ``asked(user_id, cluster_id, n)`` and ``seen(user_id, cluster_id, movie_id)``.

    The unseen movies of a user are those of ``movies`` for its cluster but for its rows in ``seen``; ``n`` is their number.
    With ``movies`` itself the factors are as long as their inputs. ``expand_unseen`` lists them for the users that are wanted.
    """
    labels = _labels(test_users).where("cluster_id is not null")
    sizes = movies.groupBy("cluster_id").agg(F.count("*").alias("_size"))
    seen = watched.join(labels, "user_id").join(movies, ["cluster_id", "movie_id"]).select("user_id", "cluster_id", "movie_id")
    gone = seen.groupBy("user_id").agg(F.count("*").alias("_seen"))
    counts = labels.join(sizes, "cluster_id").join(gone, "user_id", "left")
    left = F.col("_size") - F.coalesce("_seen", F.lit(0))
    return counts.select("user_id", "cluster_id", left.alias("n")), seen


def expand_unseen(asked: DataFrame, movies: DataFrame, seen: DataFrame) -> DataFrame:
    """``(user_id, movie_id)`` of the users in ``asked``, as long as the sum of their ``n``."""
    tests = asked.select("user_id", F.col("cluster_id").alias("membership"))
    return unseen_movies(tests, movies, seen.select("user_id", "movie_id"))


def movie_bitmaps(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, bucket, bits)``: distinct movies of each key as bitmaps of 32,768 ids, whatever the repeats."""
    bucket = F.bitmap_bucket_number("movie_id").alias("bucket")
    return entries.where("movie_id is not null").groupBy(*keys, bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("movie_id")).alias("bits")
    )


def unseen_counts(test_users: DataFrame, clustered: DataFrame) -> DataFrame:
    """``(user_id, n)``: number of unseen movies of the cluster per test user, from bitmaps.

    What a cluster holds beyond a user's own movies is the size of both together less the user's. Only bitmaps of
    buckets that a user touches are united; the others count by their cluster alone. So neither the
    cluster's movies nor the result of an anti join are listed, and repeats need no removal before.
    """
    cluster = materialize(movie_bitmaps(_cluster_entries(clustered), ["cluster_id"]), "cluster_bitmaps")
    cluster = cluster.withColumn("n", F.bitmap_count("bits"))
    labels = _labels(test_users).where("cluster_id is not null")
    own = movie_bitmaps(test_users.select("user_id", F.explode("movies").alias("movie_id")), ["user_id"])
    own = own.withColumn("_own", F.bitmap_count("bits")).join(labels, "user_id")
    touched = own.join(cluster.select("cluster_id", "bucket", F.col("bits").alias("_more"), "n"), ["cluster_id", "bucket"])
    sides = touched.select("user_id", "bucket", F.explode(F.array("bits", "_more")).alias("side"))
    both = sides.groupBy("user_id", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("side")).alias("_both"))
    seen = touched.select("user_id", "bucket", "n", "_own").join(both, ["user_id", "bucket"])
    seen = seen.groupBy("user_id").agg(F.sum(F.col("n") + F.col("_own") - F.col("_both")).alias("_seen"))
    sizes = cluster.groupBy("cluster_id").agg(F.sum("n").alias("_size"))
    counts = labels.join(sizes, "cluster_id").join(seen, "user_id", "left")
    return counts.select("user_id", (F.col("_size") - F.coalesce("_seen", F.lit(0))).alias("n")).where("n > 0")


def title_lists(pairs: DataFrame, titles: DataFrame, part_size: int = LIST_PART_SIZE) -> DataFrame:
    """The titles of every user's movies, in movie order, joined by commas."""
    named = pairs.select("user_id", "movie_id").join(titles.select("movie_id", "title"), "movie_id")
    parts = list_parts(named, ["user_id"], "movie_id", "_named", part_size=part_size, value="title")
    return parts.select("user_id", "part", F.array_join(F.col("_named.title"), ",").alias("titles"))
