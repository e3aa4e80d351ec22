"""Cluster membership: member lists, sizes, and the way back from lists to profiles."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrec.operators.lists import cut_lists, joined
from cohortrec.operators.profile import first_rows
from cohortrec.sources.text import parse_member_list

# Cluster lists are as long as the data, so their rows are kept short.
CLUSTER_PART_SIZE = 1_000


def cluster_members(clustered: DataFrame, part_size: int = CLUSTER_PART_SIZE) -> DataFrame:
    """The ascending user list of every cluster, ``part_size`` users per row."""
    entries = first_rows(clustered).where("membership is not null")
    entries = entries.select(F.col("membership").alias("cluster_id"), "user_id")
    parts = cut_lists(entries, ["cluster_id"], "user_id", "_ids", part_size, keep_empty=False)
    return parts.select("cluster_id", "part", joined(F.col("_ids")).alias("members"))


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    """Users per cluster; one row per user makes the count a distinct count."""
    placed = first_rows(clustered).where("membership is not null")
    return placed.groupBy(F.col("membership").alias("cluster_id")).agg(F.count("*").alias("n"))


def assign_from_members(profiles: DataFrame, members: DataFrame) -> DataFrame:
    """Set ``membership`` of every listed user from the member lists."""
    listed = parse_member_list(members).withColumnRenamed("cluster_id", "membership")
    return profiles.join(listed, "user_id")


# Users of a cluster per slice of the cohort join.
SLICE = 4096


def cohort_join(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Every test user with the users of its cluster, from the views of ``register_views`` or the tables of ``save_cohorts``.

    As long as (test users x users of their cluster), so meant for a bounded set of test users.
    A cluster is one of few join keys; hash slices, as many as its users need, spread it over tasks.
    """
    return spark.sql(
        f"""
        WITH sizes AS (
          SELECT membership, count(*) div {SLICE} + 1 AS slices FROM {prefix}profiles
          WHERE membership IS NOT NULL AND part = 0 GROUP BY membership)
        SELECT k.user_id AS test_user_id, p.user_id, p.membership
        FROM (SELECT user_id, membership, pmod(hash(user_id), slices) AS slice
              FROM {prefix}profiles JOIN sizes USING (membership) WHERE part = 0) p
        JOIN (SELECT user_id, membership, explode(sequence(0L, slices - 1)) AS slice
              FROM {prefix}knn_assignments JOIN sizes USING (membership) WHERE part = 0) k
          ON p.membership = k.membership AND p.slice = k.slice
        """
    )


def cohort_factors(clustered: DataFrame, assignments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``cohort_join`` without multiplying them out: ``asked(test_user_id, membership, n)`` and ``members(user_id, membership)``.

    Together they are as long as their inputs, whatever the sizes of the clusters. ``n`` is the number of rows a test user
    has in the join. ``expand_cohorts`` gives the join for the test users that are wanted.
    """
    members = first_rows(clustered).where("membership is not null").select("user_id", "membership")
    sizes = members.groupBy("membership").agg(F.count("*").alias("n"))
    firsts = first_rows(assignments) if "part" in assignments.columns else assignments
    asked = firsts.select(F.col("user_id").alias("test_user_id"), "membership").join(sizes, "membership")
    return asked.select("test_user_id", "membership", "n"), members


def expand_cohorts(asked: DataFrame, members: DataFrame) -> DataFrame:
    """``(test_user_id, user_id, membership)`` for the rows of ``asked``, as long as the sum of their ``n``.

    A cluster is one of few join keys; hash slices, as many as its users need, spread it over tasks.
    """
    slices = F.expr(f"n div {SLICE} + 1")
    counts = asked.groupBy("membership").agg(F.max(slices).alias("_slices"))
    wanted = asked.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))
    dealt = members.join(counts, "membership").withColumn("_slice", F.pmod(F.hash("user_id"), F.col("_slices")))
    return wanted.join(dealt, ["membership", "_slice"]).select("test_user_id", "user_id", "membership")
