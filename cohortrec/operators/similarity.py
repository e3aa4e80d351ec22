"""Cosine similarity of sparse vectors in long form: one row per (vec_id, movie_id, rating)."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.operators.lists import list_start
from cohortrec.plans.materialize import materialize


def rating_vectors(ratings: DataFrame) -> DataFrame:
    """One mean rating per user and movie, so no coordinate of a vector repeats."""
    return ratings.groupBy(F.col("user_id").alias("vec_id"), "movie_id").agg(
        (F.sum(F.col("rating").cast("double")) / F.count("rating")).alias("rating")
    )


def cosine_similarity(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Similarity of each given pair ``(left_id, right_id)``.

    Pairs without a common movie give 0, a zero or empty vector gives NULL. Both vectors are
    joined on ids, the second one also on the movie, so work and shuffle are the summed length
    of the requested vectors and one popular movie does not meet all other rows.
    """
    left = vectors.select(F.col("vec_id").alias("left_id"), "movie_id", F.col("rating").alias("_l"))
    right = vectors.select(F.col("vec_id").alias("right_id"), "movie_id", F.col("rating").alias("_r"))
    pairs = pairs.select("left_id", "right_id").distinct()
    asked = pairs.select(F.explode(F.array("left_id", "right_id")).alias("vec_id")).distinct()
    norms = vectors.join(asked, "vec_id", "left_semi").groupBy("vec_id")
    norms = norms.agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"))
    dots = (
        pairs.join(left, "left_id")
        .join(right, ["right_id", "movie_id"])
        .groupBy("left_id", "right_id")
        .agg(F.sum(F.col("_l") * F.col("_r")).alias("_dot"))
    )
    left_norm = norms.select(F.col("vec_id").alias("left_id"), F.col("norm").alias("_ln"))
    right_norm = norms.select(F.col("vec_id").alias("right_id"), F.col("norm").alias("_rn"))
    length = F.nullif(F.col("_ln") * F.col("_rn"), F.lit(0.0))
    return (
        pairs.join(dots, ["left_id", "right_id"], "left")
        .join(left_norm, "left_id", "left")
        .join(right_norm, "right_id", "left")
        .select("left_id", "right_id", (F.coalesce("_dot", F.lit(0.0)) / length).alias("similarity"))
    )


POSTING_BLOCK = 4096
SLACK = 1e-9  # more than rounding takes from sums of squares; only lets more pairs through
STEPS = 127  # weights of unit vectors are rounded up to this many steps, so that one takes a byte
PAIRS_A_TASK = 1_000_000


def placed_entries(vectors: DataFrame, threshold: float) -> DataFrame:
    """``(vec_id, movie_id, _vectors, weight, rare)``: entries of unit vectors without their signs.

    Entries of every vector are ordered by how many vectors hold their movie, the most frequent first. As long as the
    squares up to an entry stay below ``threshold**2`` times the squared norm, the entries so far cannot reach the
    threshold with any other vector, so they are not ``rare``: frequent movies mostly. Of two similar vectors the one
    with more such entries could not reach the threshold by them, so some movie is rare in both.
    Squares before an entry are summed over ranges of entries, so a very long vector meets in no task.
    """
    frequency = vectors.groupBy("movie_id").agg(F.count("*").alias("_vectors"))
    norms = vectors.groupBy("vec_id").agg(F.sum(F.col("rating") * F.col("rating")).alias("_square"))
    entries = vectors.join(frequency, "movie_id").withColumn("n", F.col("rating") * F.col("rating"))
    placed = list_start(entries.select("vec_id", "movie_id", "_vectors", "n"), ["vec_id"], [F.desc("_vectors"), "movie_id"])
    needed = F.lit(max(threshold - SLACK, 0.0) ** 2 * (1 - SLACK)) * F.col("_square")
    weight, rare = F.sqrt(F.col("n") / F.col("_square")), F.col("start") + F.col("n") >= needed
    return placed.join(norms, "vec_id").select("vec_id", "movie_id", "_vectors", weight.alias("weight"), rare.alias("rare"))


def whole_movies(placed: DataFrame) -> int:
    """Up to how many vectors a movie may have to be indexed whole, so that no more than twice the pairs meet as by rare entries."""
    movies = placed.groupBy("movie_id", "_vectors").agg(F.sum(F.col("rare").cast("double")).alias("_rare"))
    # As many rows as there are different sizes of movies.
    sizes = movies.groupBy("_vectors").agg(
        F.sum(F.col("_rare") * F.col("_rare")).alias("_met"),
        F.sum(F.col("_vectors").cast("double") * F.col("_vectors")).alias("_all"),
    )
    more = F.sum(F.col("_all") - F.col("_met")).over(Window.orderBy("_vectors"))
    sizes = sizes.select("_vectors", more.alias("_more"), F.sum("_met").over(Window.partitionBy()).alias("_rare"))
    return sizes.where("_more <= _rare").agg(F.max("_vectors")).first()[0] or 0


def posting_lists(indexed: DataFrame, block: int) -> DataFrame:
    """``(movie_id, _block, ids, steps)``: the vectors that index a movie, ascending, at most ``block`` a row; blocks follow each other."""
    indexed = indexed.select("movie_id", "vec_id", F.least(F.ceil(F.col("weight") * STEPS), F.lit(STEPS)).cast("tinyint").alias("_step"))
    long = indexed.groupBy("movie_id").agg(F.count("*").alias("n")).where(F.col("n") > block)
    long = materialize(long.select(F.col("movie_id").alias("_long")), "long_lists")
    cut = indexed.join(long, indexed["movie_id"] == long["_long"], "left_semi").withColumn("n", F.lit(1))
    cut = list_start(cut, ["movie_id"], ["vec_id"]).withColumn("_block", F.expr(f"start div {block}")).drop("n", "start")
    whole = indexed.join(long, indexed["movie_id"] == long["_long"], "left_anti").withColumn("_block", F.lit(0).cast("long"))
    lists = whole.unionByName(cut).groupBy("movie_id", "_block")
    lists = lists.agg(F.sort_array(F.collect_list(F.struct("vec_id", "_step"))).alias("_list"))
    return lists.select("movie_id", "_block", F.col("_list.vec_id").alias("ids"), F.col("_list._step").alias("steps"))


def similar_candidates(vectors: DataFrame, threshold: float, block: int = POSTING_BLOCK) -> DataFrame:
    """Distinct pairs ``(left_id, right_id)``, left below right, among which are all of at least ``threshold``.

    The products of the weights of all movies that both index are summed, each weight rounded up; pairs stay that may reach the
    threshold by this sum and what is not indexed. A vector gets for each of its movies the array of the vectors
    after it, so pairs are shuffled as parts of arrays and summed where they arrive. Lists of vectors are cut
    into blocks of ``block``, so a movie that many vectors index is spread over the cluster.
    """
    spark = vectors.sparkSession
    placed = materialize(placed_entries(vectors, threshold), "placed")
    most = whole_movies(placed)
    lists = materialize(posting_lists(placed.where((F.col("_vectors") <= most) | F.col("rare")), block), "lists")

    # Of a pair the part that is not indexed in both is at most what one leaves out times the frequent part of the other.
    square = F.col("weight") * F.col("weight")
    left_out = F.sqrt(F.sum(F.when(~F.col("rare"), square).otherwise(0.0))).alias("_out")
    parts = placed.where(F.col("_vectors") > most).groupBy("vec_id")
    parts = materialize(parts.agg(left_out, F.sqrt(F.sum(square)).alias("_frequent")), "frequent_parts")
    frequent = parts.agg(F.max("_out"), F.max("_frequent")).first()
    out, part = frequent[0] or 0.0, frequent[1] or 0.0

    place = F.posexplode("ids").alias("_at", "left_id")
    after = F.col("_at") + 2
    own = lists.where(F.size("ids") > 1).select("ids", "steps", place).where(F.col("_at") + 1 < F.size("ids"))
    own = own.select(
        "left_id", F.col("steps")[F.col("_at")].alias("_step"),
        F.slice("ids", after, F.size("ids")).alias("ids"), F.slice("steps", after, F.size("ids")).alias("steps"),
    )
    later = lists.where("_block > 0").select(F.col("movie_id").alias("_of"), F.col("_block").alias("_later"), "ids", "steps")
    ahead = lists.select("movie_id", "_block", "steps", place)
    ahead = ahead.select("movie_id", "_block", "left_id", F.col("steps")[F.col("_at")].alias("_step"))
    across = ahead.join(later, (F.col("movie_id") == F.col("_of")) & (F.col("_block") < F.col("_later")))
    met = own.union(across.select("left_id", "_step", "ids", "steps"))

    size = F.size("ids").cast("double")
    pairs = lists.groupBy("movie_id").agg(F.sum(size).alias("_n")).agg(F.sum(F.col("_n") * F.col("_n")) / 2).first()[0] or 0.0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs / PAIRS_A_TASK))
    met = met.repartition(tasks, "left_id").select("left_id", "_step", "steps", F.posexplode("ids").alias("_at", "right_id"))
    product = F.col("_step").cast("int") * F.col("steps")[F.col("_at")].cast("int")
    sums = met.select("left_id", "right_id", product.alias("_product")).where("left_id < right_id")
    sums = sums.groupBy("left_id", "right_id").agg((F.sum("_product") / float(STEPS * STEPS)).alias("_sum"))
    needed = threshold * (1 - SLACK) - SLACK
    found = sums.where(F.col("_sum") >= needed - out * part)
    if out == 0:
        return found.select("left_id", "right_id")
    for side in ("left", "right"):
        columns = [F.col("vec_id").alias(f"{side}_id"), F.col("_out").alias(f"_{side}_out"), F.col("_frequent").alias(f"_{side}_part")]
        found = found.join(parts.select(*columns), f"{side}_id", "left").na.fill(0.0, [f"_{side}_out", f"_{side}_part"])
    missing = F.greatest(F.col("_left_out") * F.col("_right_part"), F.col("_right_out") * F.col("_left_part"))
    return found.where(F.col("_sum") + missing >= needed).select("left_id", "right_id")


def similar_vectors(vectors: DataFrame, threshold: float, block: int = POSTING_BLOCK) -> DataFrame:
    """``(left_id, right_id, similarity)`` of all pairs whose cosine, rounded to 9 digits, is at least ``threshold``.

    Pairs are not given but found by an index of few entries per vector, and every candidate is compared in full. Zero and
    NULL entries take no part. The threshold must be above 0.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    vectors = materialize(vectors.where("rating <> 0 and vec_id is not null and movie_id is not null"), "vectors")
    pairs = materialize(similar_candidates(vectors, threshold, block), "candidates")
    return cosine_similarity(vectors, pairs).where(F.round("similarity", 9) >= F.lit(threshold))
