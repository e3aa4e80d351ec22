import math
import random
from collections import Counter

import pytest

from cohortrec.operators import knn

SCHEMA = "user_id long, avg_release_year double, avg_watch_year double, membership int"


def brute(users, tests, k, exclude_self):
    found = {}
    for tid, tx, ty in tests:
        ranked = sorted(
            (math.sqrt((x - tx) * (x - tx) + (y - ty) * (y - ty)), uid, label)
            for uid, x, y, label in users
            if not (exclude_self and uid == tid)
        )
        found[tid] = ranked[:k]
    return found


def lattice(rng, n):
    return [(rng.randrange(1940, 2000), rng.randrange(1995, 2006)) for _ in range(n)]


def plane(rng, n):
    return [(rng.uniform(-300, 300), rng.uniform(-300, 300)) for _ in range(n)]


def clumps(rng, n):
    centres = [(0, 0), (5000, 0), (0, 9000), (-20000, 70000)]
    return [(c[0] + rng.randrange(8), c[1] + rng.randrange(8)) for c in (rng.choice(centres) for _ in range(n))]


def far_apart(rng, n):
    return [(x * 1e11, y * 1e11) for x, y in lattice(rng, n)]


def unit(rng, n):
    return [(rng.random(), rng.random()) for _ in range(n)]


def mixed(rng, n):
    return [(rng.random() * 1e-6, rng.choice([0.0, 1e12]) + rng.randrange(50)) for _ in range(n)]


def line(rng, n):
    return [(rng.randrange(-40, 40) * 1e11, 7.0) for _ in range(n)]


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("layout", [lattice, plane, clumps, far_apart, unit, mixed, line])
def test_equals_brute_force(spark, layout, exclude_self):
    rng = random.Random(11)
    points = layout(rng, 400)
    points += [points[0]] * 200  # one point with a third of all users
    users = [(i, float(x), float(y), rng.randrange(5)) for i, (x, y) in enumerate(points)]
    away = [(10_000 + i, float(x), float(y)) for i, (x, y) in enumerate(layout(rng, 20))] + [(20_000, 1e5, -1e5)]
    tests = [u[:3] for u in users[:30]] + away
    profiles = spark.createDataFrame(users, SCHEMA)
    test_users = spark.createDataFrame(tests, "user_id long, avg_release_year double, avg_watch_year double")
    expected = brute(users, tests, 9, exclude_self)

    found = {}
    for r in knn.neighbours(profiles, test_users, 9, exclude_self).orderBy("rn").collect():
        found.setdefault(r.test_user_id, []).append((r.distance, r.user_id, r.membership))
    assert found == expected

    votes = {r.user_id: r.membership for r in knn.classify(profiles, test_users, 9, exclude_self).collect()}
    for tid, rows in expected.items():
        counts = Counter(label for _, _, label in rows)
        assert votes[tid] == min(counts, key=lambda label: (-counts[label], label))


def test_fewer_users_than_k(spark):
    profiles = spark.createDataFrame([(1, 1990.0, 2000.0, 3), (2, 1000.0, 2000.0, 3)], SCHEMA)
    rows = knn.neighbours(profiles, profiles.where("user_id = 1"), 25).orderBy("rn").collect()
    assert [r.user_id for r in rows] == [1, 2]


def test_distance_tie_takes_smaller_ids(spark):
    users = [(i, 1990.0 + (1 if i % 2 else -1), 2000.0, 0) for i in range(26)]
    test = spark.createDataFrame([(99, 1990.0, 2000.0)], "user_id long, avg_release_year double, avg_watch_year double")
    rows = knn.neighbours(spark.createDataFrame(users, SCHEMA), test).collect()
    assert sorted(r.user_id for r in rows) == list(range(25))


def test_vote_tie_takes_smaller_label(spark):
    labelled = spark.createDataFrame([(1, 3), (1, 3), (1, 1), (1, 1), (2, 4)], "id int, membership int")
    assert sorted(map(tuple, knn.majority_vote(labelled, ["id"]).collect())) == [(1, 1), (2, 4)]


def test_distant_users_are_all_found(spark):
    users = spark.range(40).selectExpr("id user_id", "id * 1e11D avg_release_year", "0D avg_watch_year", "1 membership")
    rows = knn.neighbours(users, users.where("user_id = 0"), 25).orderBy("rn").collect()
    assert [r.user_id for r in rows] == list(range(25))


def test_missing_features(spark):
    rows = [(1, None, 2000.0, 3), (2, math.nan, 2000.0, 3), (3, math.inf, 2000.0, 3), (4, 1990.0, 2000.0, 3), (5, -0.0, 0.0, 3)]
    profiles = spark.createDataFrame(rows, SCHEMA)
    votes = {r.user_id: r.membership for r in knn.classify(profiles, profiles.drop("membership")).collect()}
    assert votes == {1: None, 2: None, 3: None, 4: 3, 5: 3}
    found = {r.test_user_id: r.user_id for r in knn.neighbours(profiles, profiles, 1).collect()}
    assert found == {4: 4, 5: 5}
    votes = knn.classify(profiles.where("user_id < 4"), profiles.drop("membership"), exclude_self=True).collect()
    assert [r.membership for r in votes] == [None] * 5


def test_few_candidates_in_the_unit_square(spark):
    from test_plans import join_outputs

    points = spark.range(2_000).selectExpr(
        "id user_id", "rand(1) avg_release_year", "rand(2) avg_watch_year", "0 membership"
    )
    found = knn.point_neighbours(points, points, 25)
    assert found.count() == 50_000
    assert max(join_outputs(found).values()) < 200_000
