import random

import pytest
from pyspark.sql import functions as F

from cohortrec.operators import recommend

TESTS = "user_id long, membership int, movies array<long>, part long"


def frames(spark, tests, movies):
    test_users = spark.createDataFrame(tests, TESTS)
    cluster_movies = spark.createDataFrame(movies, "cluster_id int, movie_id long")
    titles = cluster_movies.select("movie_id", F.concat(F.lit("t"), "movie_id").alias("title")).distinct()
    return test_users, cluster_movies, titles


def test_unseen_movies_only(spark):
    test_users, movies, titles = frames(spark, [(1, 0, [2], 0)], [(0, 1), (0, 2), (0, 3), (1, 9)])
    rows = recommend.recommend(test_users, movies, titles).orderBy("rn").collect()
    assert [tuple(r) for r in rows] == [(1, 1, "t1", 1), (1, 3, "t3", 2)]


def test_cap_takes_smallest_ids(spark):
    test_users, movies, titles = frames(spark, [(1, 0, [], 0)], [(0, m) for m in range(12)])
    rows = recommend.recommend(test_users, movies, titles).collect()
    assert sorted(r.movie_id for r in rows) == list(range(10))


def test_unknown_title_is_null(spark):
    test_users, movies, titles = frames(spark, [(1, 0, [], 0)], [(0, 1)])
    assert recommend.recommend(test_users, movies, titles.where("movie_id > 1")).first().title is None


def test_other_order(spark):
    test_users, movies, titles = frames(spark, [(1, 0, [8], 0)], [(0, m) for m in range(10)])
    rows = recommend.recommend(test_users, movies, titles, limit=2, order=[F.desc("title")]).orderBy("rn").collect()
    assert [r.movie_id for r in rows] == [9, 7]


@pytest.mark.parametrize("limit", [1, 10, None])
def test_equals_brute_force(spark, limit):
    rng = random.Random(5)
    movies = {c: sorted(rng.sample(range(3000), 40 * (c + 1) ** 2)) for c in range(5)}
    tests = []
    for user in range(60):
        cluster = 4 if user < 20 else rng.randrange(6)  # a third of the users in one cluster
        own = movies.get(cluster, [])
        # One user has seen almost all, another everything.
        share = {0: 0.99, 1: 1.0}.get(user, rng.random() * 0.3)
        watched = own[: int(len(own) * share)] + rng.sample(range(3000), 5)
        half = len(watched) // 2
        tests += [(user, cluster, watched[:half], 0), (user, cluster, watched[half:] + watched[:2], 1)]
    test_users, cluster_movies, titles = frames(spark, tests, [(c, m) for c, ms in movies.items() for m in ms])

    expected = {}
    for user, cluster, _, _ in tests:
        seen = {m for u, _, ms, _ in tests if u == user for m in ms}
        unseen = [m for m in movies.get(cluster, []) if m not in seen]
        if unseen:
            expected[user] = unseen[:limit]
    found = {}
    for r in recommend.recommend(test_users, cluster_movies, titles, limit=limit).orderBy("movie_id").collect():
        found.setdefault(r.user_id, []).append(r.movie_id)
    assert found == expected


def test_cluster_movies_and_list(spark):
    clustered = spark.createDataFrame([(1, 0, [5, 5, 6], 0), (2, 0, [5, 7], 0), (3, None, [8], 0)], TESTS)
    assert sorted(map(tuple, recommend.cluster_movies(clustered).collect())) == [(0, 5), (0, 6), (0, 7)]
    rows = recommend.cluster_movie_list(clustered, part_size=2).orderBy("part").collect()
    assert [(r.part, r.movies) for r in rows] == [(0, "5,5"), (1, "5,6"), (2, "7")]


def test_title_lists_keep_movie_order(spark):
    pairs = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (1, 99)], "user_id long, movie_id long")
    titles = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b")], "movie_id long, title string")
    assert recommend.title_lists(pairs, titles).first().titles == "b,a,b"
    assert [r.titles for r in recommend.title_lists(pairs, titles, 2).orderBy("part").collect()] == ["b,a", "b"]
