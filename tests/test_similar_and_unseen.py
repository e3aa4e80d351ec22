"""Pairs above a cosine and bitmap counts against plain loops."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortrec.operators import recommend, similarity


def plain_similar(rows, threshold):
    vectors = {}
    for user, movie, rating in rows:
        if rating:
            vectors.setdefault(user, {})[movie] = rating
    norm = {u: math.sqrt(sum(x * x for x in v.values())) for u, v in vectors.items()}
    found = {}
    for a, b in itertools.combinations(sorted(vectors), 2):
        cosine = sum(x * vectors[b].get(m, 0) for m, x in vectors[a].items()) / (norm[a] * norm[b])
        if round(cosine, 9) >= threshold:
            found[(a, b)] = round(cosine, 9)
    return found


def vectors():
    rng = random.Random(8)
    rows = [(u, 0, float(rng.randrange(1, 6))) for u in range(80)]  # a movie that everyone saw
    rows += [(u, m, float(rng.randrange(-2, 6))) for u in range(80) for m in rng.sample(range(1, 60), 1 + u % 9)]
    rows += [(200 + u, m, r) for u, m, r in rows if u < 20]  # equal vectors
    return rows + [(400, 5, 3.0), (401, 5, 1.0), (402, 77, 2.0), (403, 5, 0.0)]


@pytest.mark.parametrize("threshold, block", [(0.3, 4096), (0.8, 4096), (0.8, 5), (1.0, 7)])
def test_similar_vectors(spark, threshold, block):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, movie_id long, rating double")
    found = {(r.left_id, r.right_id): round(r.similarity, 9) for r in similarity.similar_vectors(frame, threshold, block).collect()}
    assert found == plain_similar(rows, threshold)


def test_few_candidates(spark):
    """The movie that everyone saw makes all pairs share a movie, but not all of them candidates."""
    frame = spark.createDataFrame([r for r in vectors() if r[2]], "vec_id long, movie_id long, rating double")
    users = frame.select("vec_id").distinct().count()
    candidates = similarity.similar_candidates(frame, 0.8)
    assert candidates.count() < users * (users - 1) / 2 / 3
    assert candidates.count() == candidates.distinct().count()


def test_few_candidates_at_a_low_threshold(spark):
    """All pairs that met at one of almost all movies were compared in full: 99 % of those here, of which few are similar."""
    rng = random.Random(11)
    rows = [(u, m, float(rng.randrange(1, 6))) for u in range(150) for m in rng.sample(range(400), 40)]
    frame = spark.createDataFrame(rows, "vec_id long, movie_id long, rating double")
    wanted = plain_similar(rows, 0.2)
    candidates = {tuple(r) for r in similarity.similar_candidates(frame, 0.2).collect()}
    assert set(wanted) <= candidates and len(candidates) < 1.5 * len(wanted) < 150 * 149 / 2 / 10
    found = {(r.left_id, r.right_id): round(r.similarity, 9) for r in similarity.similar_vectors(frame, 0.2).collect()}
    assert found == wanted


@pytest.mark.parametrize("most", [0, 20, None])
@pytest.mark.parametrize("threshold, block", [(0.25, 4096), (0.25, 3), (0.7, 6)])
def test_movies_that_are_not_indexed_whole(spark, monkeypatch, most, threshold, block):
    """Parts of vectors that are not indexed count towards the threshold, whatever their signs."""
    if most is not None:
        monkeypatch.setattr(similarity, "whole_movies", lambda placed: most)
    rng = random.Random(12)
    rows = [(u, m, float(rng.choice([-2, -1, 1, 2, 3, 5, 0.25]))) for u in range(-30, 30) for m in range(12) if rng.random() < 0.5]
    rows += [(u, 100 + m, float(rng.randrange(1, 6))) for u in range(-30, 30) for m in rng.sample(range(30), 4)]
    frame = spark.createDataFrame(rows, "vec_id long, movie_id long, rating double")
    found = {(r.left_id, r.right_id): round(r.similarity, 9) for r in similarity.similar_vectors(frame, threshold, block).collect()}
    assert found == plain_similar(rows, threshold)


def test_no_rows_and_bad_threshold(spark):
    frame = spark.createDataFrame([], "vec_id long, movie_id long, rating double")
    assert similarity.similar_vectors(frame, 0.5).collect() == []
    with pytest.raises(ValueError):
        similarity.similar_vectors(frame, 0.0)


def test_unseen_counts_equal_the_anti_join(spark):
    rng = random.Random(9)
    # Ids over several bitmaps, negative and very large ones among them.
    ids = [-40_000, -1, 0, 1, 32_767, 32_768, 32_769, 65_536, 10**12, *range(100, 140)]
    clustered = [(u, u % 3 if u % 7 else None, [rng.choice(ids) for _ in range(12)], 0) for u in range(40)]
    clustered += [(u, m, movies[:2], 1) for u, m, movies, _ in clustered[:5]]
    tests = [(100 + i, i % 4 if i % 5 else None, [rng.choice([*ids, 7_777_777]) for _ in range(i)], 0) for i in range(15)]
    tests += [(100 + i, i % 4 if i % 5 else None, [rng.choice(ids)], 1) for i in range(0, 15, 2)]
    schema = "user_id long, membership int, movies array<long>, part long"
    profiles, users = spark.createDataFrame(clustered, schema), spark.createDataFrame(tests, schema)
    listed = recommend.unseen_movies(users, recommend.cluster_movies(profiles), recommend.watched_movies(users))
    expected = {r.user_id: r.n for r in listed.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert {r.user_id: r.n for r in recommend.unseen_counts(users, profiles).collect()} == expected
