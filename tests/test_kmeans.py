import math
import random

import pytest

from cohortrec.operators import kmeans, membership
from cohortrec.plans import jobs


def people(spark, points):
    return spark.createDataFrame(
        [(i, float(x), float(y), 0) for i, (x, y) in enumerate(points)],
        "user_id long, avg_release_year double, avg_watch_year double, part long",
    )


def distance(x, y, cx, cy):
    return math.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))


def brute_fit(points, seeds, max_steps=50):
    """Unweighted steps in plain Python."""
    current = [(x, y) for _, x, y in seeds]
    for steps in range(1, max_steps + 1):
        labels = [
            min(range(len(current)), key=lambda c: (distance(x, y, *current[c]), c))
            for x, y in points
        ]
        means = []
        for c, old in enumerate(current):
            own = [p for p, label in zip(points, labels) if label == c]
            means.append((sum(p[0] for p in own) / len(own), sum(p[1] for p in own) / len(own)) if own else old)
        whole = {(int(x), int(y)) for x, y in means}
        if all((int(x), int(y)) in whole for x, y in current):
            break
        current = means
    return labels, means, steps


def test_tie_goes_to_lowest_id(spark):
    found = kmeans.assign(people(spark, [(2, 2)]), [(1, 3.0, 2.0), (0, 1.0, 2.0)]).first()
    assert (found.cluster_id, found.distance) == (0, 1.0)


def test_step_keeps_empty_cluster_and_ids(spark):
    cells = kmeans.weighted_cells(people(spark, [(1, 1), (1, 1), (3, 1)]))
    rows = kmeans.step(cells, [(0, 500.0, 500.0), (1, 0.0, 0.0)]).orderBy("cluster_id").collect()
    assert [tuple(r) for r in rows] == [(0, 500.0, 500.0, 0), (1, 5 / 3, 1.0, 3)]


@pytest.mark.parametrize(
    "old, new, expected",
    [
        ([(1.2, 5.9), (3.0, 4.0)], [(3.7, 4.2), (1.9, 5.1)], True),
        ([(1.2, 5.9)], [(2.0, 5.9)], False),
    ],
)
def test_converged(spark, old, new, expected):
    def frame(points):
        return kmeans.centroid_frame(spark, [(i, x, y) for i, (x, y) in enumerate(points)])

    assert kmeans.converged(frame(old), frame(new)).first()[0] is expected


@pytest.mark.parametrize("seed", range(3))
def test_weighted_fit_equals_unweighted(spark, seed):
    rng = random.Random(seed)
    points = [(rng.randrange(1950, 2000), rng.randrange(1995, 2006)) for _ in range(300)]
    points += [(1960, 2000)] * 150  # one cell with a third of all users
    seeds = [(c, 1950.0 + 7 * c, 1996.0 + c % 4) for c in range(6)] + [(6, 9000.0, 9000.0)]
    labels, means, steps = brute_fit(points, seeds)
    cohorts = jobs.cluster_profiles(people(spark, points), seeds)
    assert cohorts.model.steps == steps
    assert [(x, y) for _, x, y in cohorts.model.centroids] == means
    assert [r.membership for r in cohorts.profiles.orderBy("user_id").collect()] == labels


def test_centroids_are_means_of_final_membership(spark):
    points = [(1950 + i % 37, 1996 + i % 9) for i in range(200)]
    seeds = [(c, 1950.0 + 9 * c, 1998.0) for c in range(4)]
    cohorts = jobs.cluster_profiles(people(spark, points), seeds)
    means = kmeans.update(kmeans.assign(people(spark, points), cohorts.model.members_of))
    assert [tuple(r) for r in means.orderBy("cluster_id").collect()] == cohorts.model.centroids


def test_user_without_features_has_no_cluster(spark):
    rows = [(1, 1990.0, 2004.0, 0), (2, None, 2004.0, 0)]
    df = spark.createDataFrame(rows, "user_id long, avg_release_year double, avg_watch_year double, part long")
    cohorts = jobs.cluster_profiles(df, [(0, 1990.0, 2000.0)])
    assert {r.user_id: r.membership for r in cohorts.profiles.collect()} == {1: 0, 2: None}
    assert [tuple(r) for r in membership.cluster_sizes(cohorts.profiles).collect()] == [(0, 1)]


def test_members_and_way_back(spark):
    points = [(1950 + i % 37, 1996 + i % 9) for i in range(200)]
    cohorts = jobs.cluster_profiles(people(spark, points), [(c, 1950.0 + 9 * c, 1998.0) for c in range(4)])
    members = membership.cluster_members(cohorts.profiles, part_size=10)
    assert members.count() > 4
    back = membership.assign_from_members(cohorts.profiles.drop("membership"), members)
    expected = {r.user_id: r.membership for r in cohorts.profiles.collect()}
    assert {r.user_id: r.membership for r in back.collect()} == expected
    assert sum(r.n for r in membership.cluster_sizes(cohorts.profiles).collect()) == len(points)
