"""Exact K nearest neighbours in the feature plane and their majority vote.

No cross join is planned. Users of one point are equidistant from everything, so a point keeps
only its K smallest user ids. The plane is cut into square blocks of doubling width, from blocks that
hold everything down to fractions of the mean spacing; the widths follow the extent and the number of the
points. For each distinct test point the smallest width is taken at which the 3x3 blocks around
it hold K users. The K-th distance among these bounds the search, and a second look-up adds the blocks
around them that the bound reaches. Both look-ups are equi-joins on (level, block), and cost does
not depend on how many users or test users share a point.

A level-0 block holds all points and test points, so every test point finds K users if there are K.
"""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.operators.kmeans import FEATURES
from cohortrec.plans.materialize import materialize

NEIGHBOURS = 25
# With so many halvings of the extent, blocks are still exact to a thousandth in double precision.
MOST_LEVELS = 40


def _located(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with both features as finite ``x`` and ``y``; zero has one sign."""
    finite = " and ".join(f"(`{f}` is not null and not isnan(`{f}`) and abs(`{f}`) < double('Infinity'))" for f in features)
    x, y = ((F.col(f).cast("double") + F.lit(0.0)).alias(name) for f, name in zip(features, ("x", "y")))
    return rows.where(finite).select("*", x, y)


def point_neighbours(
    profiles: DataFrame, test_users: DataFrame, need: int, features: Sequence[str] = FEATURES
) -> DataFrame:
    """The ``need`` nearest users of every distinct test point, ties by smaller user id.

    ``profiles`` has one row per user and a ``membership``. Result columns: ``tx, ty``,
    ``distance``, ``user_id``, ``membership``, ``rn``. Users without two finite features are left out.
    """
    spark = profiles.sparkSession
    users = _located(profiles.select(*features, "user_id", "membership"), features)
    points = spark.sql(
        f"""
        SELECT x, y, sort_array(collect_list(struct(user_id, membership))) AS users, count(*) AS n FROM (
          SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY user_id) AS place FROM {{users}})
        WHERE place <= {need} GROUP BY x, y
        """,
        users=users,
    )
    points = materialize(points, "points")
    targets = _located(test_users.select(*features), features).selectExpr("x AS tx", "y AS ty").distinct()
    targets = materialize(targets, "targets")
    # One row.
    ends = points.select("x", "y", F.lit(1).alias("own")).union(targets.select("tx", "ty", F.lit(0)))
    x0, y0, x1, y1, count = ends.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y"), F.sum("own")).first()
    if x0 is None:
        x0 = y0 = x1 = y1 = count = 0.0
    extent = max(x1 - x0, y1 - y0)
    top = math.frexp(extent)[1] + 1  # a power of two above the extent
    levels = min(2 * math.ceil(math.log2(count + 1)) + 6, MOST_LEVELS) if extent else 0

    def block(x: str, y: str) -> str:
        width = f"pow(2D, {top} - level)"
        return f"floor(({x} - ({x0!r}D)) / {width}) AS bx, floor(({y} - ({y0!r}D)) / {width}) AS by"

    return spark.sql(
        f"""
        WITH blocked AS (
          SELECT x, y, n, level, {block("x", "y")} FROM {{points}} LATERAL VIEW explode(sequence(0, {levels})) AS level),
        totals AS (SELECT level, bx, by, sum(n) AS n FROM blocked GROUP BY level, bx, by),
        centred AS (
          SELECT tx, ty, level, {block("tx", "ty")} FROM {{targets}} LATERAL VIEW explode(sequence(0, {levels})) AS level),
        probes AS (
          SELECT tx, ty, level, bx + dx AS bx, by + dy AS by
          FROM centred LATERAL VIEW explode(sequence(-1, 1)) AS dx LATERAL VIEW explode(sequence(-1, 1)) AS dy),
        -- Without enough users at any level there are fewer than K in all, and level 0 has them.
        chosen AS (
          SELECT tx, ty, max(if(held >= {need}, level, 0)) AS level FROM (
            SELECT tx, ty, level, sum(n) AS held FROM probes JOIN totals USING (level, bx, by) GROUP BY tx, ty, level)
          GROUP BY tx, ty),
        middle AS (SELECT tx, ty, level, {block("tx", "ty")} FROM chosen),
        near AS (
          SELECT tx, ty, level, x, y, n, sqrt((x - tx) * (x - tx) + (y - ty) * (y - ty)) AS distance
          FROM (SELECT tx, ty, level, bx + dx AS bx, by + dy AS by
                FROM middle LATERAL VIEW explode(sequence(-1, 1)) AS dx LATERAL VIEW explode(sequence(-1, 1)) AS dy)
          JOIN blocked USING (level, bx, by)),
        -- The K-th distance so far. With fewer than K users level 0 has shown all of them.
        bounds AS (
          SELECT tx, ty, level, min(distance) AS radius FROM (
            SELECT *, sum(n) OVER (PARTITION BY tx, ty ORDER BY distance) AS reached FROM near)
          WHERE reached >= {need} GROUP BY tx, ty, level),
        around AS (
          SELECT tx, ty, level, radius, bx + dx AS bx, by + dy AS by, pow(2D, {top} - level) AS width
          FROM (SELECT *, {block("tx", "ty")} FROM bounds)
          LATERAL VIEW explode(sequence(-3, 3)) AS dx LATERAL VIEW explode(sequence(-3, 3)) AS dy
          WHERE abs(dx) > 1 OR abs(dy) > 1),
        reached AS (
          SELECT * FROM (
            SELECT *, greatest(bx * width + ({x0!r}D) - tx, tx - (bx + 1) * width - ({x0!r}D), 0D) AS gap_x,
                      greatest(by * width + ({y0!r}D) - ty, ty - (by + 1) * width - ({y0!r}D), 0D) AS gap_y FROM around)
          -- A hundredth of a block covers what rounding may do to its border.
          WHERE sqrt(gap_x * gap_x + gap_y * gap_y) <= radius * 1.0001D + width * 0.01D),
        far AS (
          SELECT tx, ty, x, y, n, sqrt((x - tx) * (x - tx) + (y - ty) * (y - ty)) AS distance
          FROM reached JOIN blocked USING (level, bx, by)),
        candidates AS (
          SELECT tx, ty, x, y, n, distance FROM near UNION ALL SELECT tx, ty, x, y, n, distance FROM far),
        -- A point holds at least one user: with K users strictly nearer, it is too far.
        kept AS (
          SELECT tx, ty, x, y, distance FROM (
            SELECT *, coalesce(sum(n) OVER (PARTITION BY tx, ty ORDER BY distance RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
                      - sum(n) OVER (PARTITION BY tx, ty, distance) AS nearer FROM candidates)
          WHERE nearer < {need}),
        listed AS (SELECT tx, ty, distance, inline(users) FROM kept JOIN {{points}} USING (x, y))
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY tx, ty ORDER BY distance, user_id) AS rn FROM listed)
        WHERE rn <= {need}
        """,
        points=points,
        targets=targets,
    )


def neighbours(
    profiles: DataFrame,
    test_users: DataFrame,
    k: int = NEIGHBOURS,
    exclude_self: bool = False,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """``(test_user_id, user_id, membership, distance, rn)``, ``k`` rows per test user.

    A test user that is also a profile is its own neighbour unless ``exclude_self`` is set.
    """
    found = point_neighbours(profiles, test_users, k + int(exclude_self), features)
    tests = _located(test_users.select("user_id", *features), features)
    tests = tests.selectExpr("user_id AS test_user_id", "x AS tx", "y AS ty")
    rows = tests.join(found, ["tx", "ty"])
    if exclude_self:
        order = Window.partitionBy("test_user_id").orderBy("distance", "user_id")
        rows = rows.where("user_id <> test_user_id").withColumn("rn", F.row_number().over(order))
        rows = rows.where(F.col("rn") <= k)
    return rows.select("test_user_id", "user_id", "membership", "distance", "rn")


def majority_vote(labelled: DataFrame, key: Sequence[str]) -> DataFrame:
    """The most frequent ``membership`` per key; of equally frequent ones the smallest."""
    counts = labelled.where("membership is not null").groupBy(*key, "membership").agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("_n"), "membership"))
    return counts.groupBy(*key).agg(best["membership"].alias("membership"))


def classify(
    profiles: DataFrame,
    test_users: DataFrame,
    k: int = NEIGHBOURS,
    exclude_self: bool = False,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Test users, all their columns kept, with the ``membership`` their neighbours vote for.

    ``test_users`` may hold several list parts per user; each gets the same label. A test user
    without both features stays, with NULL as its label.
    """
    x, y = features
    if exclude_self:
        firsts = test_users.where("part = 0") if "part" in test_users.columns else test_users
        votes = majority_vote(neighbours(profiles, firsts, k, True, features), ["test_user_id"])
        return test_users.join(votes.withColumnRenamed("test_user_id", "user_id"), "user_id", "left")
    votes = majority_vote(point_neighbours(profiles, test_users, k, features), ["tx", "ty"])
    same = (test_users[x] == votes["tx"]) & (test_users[y] == votes["ty"])
    return test_users.join(votes, same, "left").drop("tx", "ty")
