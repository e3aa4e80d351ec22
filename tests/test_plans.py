"""What the plans of the main stages must look like."""

import pytest
from pyspark.sql import functions as F

from cohortrec.operators import kmeans, knn, profile, recommend
from cohortrec.plans import standin
from cohortrec.plans.materialize import materialize

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def profiles(spark):
    return materialize(
        profile.build_profiles(standin.ratings(spark, SF_DIR), standin.titles(spark, SF_DIR)), "profiles"
    )


def test_profile_build_shuffles_the_ratings_once(spark):
    build = profile.build_profiles(standin.ratings(spark, SF_DIR), standin.titles(spark, SF_DIR))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in physical(build)
    build.collect()
    # No user needs more than one part here, so the branch for such users is gone from the final plan.
    final = physical(build).split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") + final.count("Exchange REPARTITION") <= 1
    assert final.count("lineitem") == 1


def test_cells_read_only_the_features(profiles):
    plan = physical(kmeans.weighted_cells(profile.first_rows(profiles)))
    assert "ReadSchema: struct<avg_watch_year:double,avg_release_year:double,part:bigint>" in plan
    assert "EqualTo(part,0)" in plan
    assert plan.count("Exchange") == 1


def test_membership_is_narrow(profiles):
    assert "Exchange" not in physical(kmeans.with_membership(profiles, standin.SEEDS))


def test_holdout_is_a_top_k(profiles):
    plan = physical(profile.holdout_users(profiles))
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan


def test_neighbours_join_on_blocks(profiles):
    people = kmeans.with_membership(profile.first_rows(profiles), standin.SEEDS)
    plan = physical(knn.point_neighbours(people, profile.holdout_users(people), 25))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "avg_release_year" not in plan  # users and test users were read for the written points


def test_cluster_movies_are_distinct_before_the_shuffle(profiles):
    plan = physical(recommend.cluster_movies(kmeans.with_membership(profiles, standin.SEEDS)))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def join_outputs(df):
    """Rows out of each join of the plan that ran, by node."""
    found = {}

    def visit(node):
        name = node.nodeName()
        if "Join" in name and node.metrics().contains("numOutputRows"):
            key = node.simpleString(200)
            found[key] = max(found.get(key, 0), node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
        if name == "AdaptiveSparkPlan":
            visit(node.executedPlan())
        if name.endswith("QueryStage"):
            visit(node.plan())

    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    visit(plan)
    return found


def test_capped_search_reads_few_candidates(spark):
    """2,000 users with few watched movies never meet most of the 50,000 movies of their cluster."""
    movies = spark.range(50_000).select(F.lit(0).alias("cluster_id"), F.col("id").alias("movie_id"))
    tests = spark.range(2_000).selectExpr("id user_id", "0 membership", "array(id, id + 1) movies", "0L part")
    top = recommend.first_unseen(tests, movies, recommend.watched_movies(tests))
    assert top.count() == 20_000
    assert 0 < max(join_outputs(top).values()) <= 2_000 * (10 + 2 + recommend.RANK_BUCKET)
