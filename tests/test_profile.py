import datetime

import pytest

from cohortrec.operators import profile

RATINGS = "rating_key long, movie_id long, user_id long, rating int, watch_date date"
PROFILES = (
    "user_id long, avg_rating double, avg_watch_year double, avg_release_year double, part long, movies array<long>"
)
TITLES = "movie_id long, release_year int, title string"


def day(year):
    return datetime.date(year, 6, 1)


def frames(spark, ratings, titles):
    numbered = [(i, *row) for i, row in enumerate(ratings)]
    return spark.createDataFrame(numbered, RATINGS), spark.createDataFrame(titles, TITLES)


def test_rounding_and_list(spark):
    ratings, titles = frames(
        spark,
        [(7, 1, 2, day(2004)), (5, 1, 2, day(2005)), (7, 1, 2, day(2005)), (9, 2, 3, day(2001))],
        [(5, 1990, "a"), (7, 1991, "b"), (9, 2000, "c")],
    )
    rows = profile.build_profiles(ratings, titles).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, 0.0, 2005.0, 1991.0, 0, [5, 7, 7]),
        (2, 1.0, 2001.0, 2000.0, 0, [9]),
    ]


def test_unknown_movie_and_year(spark):
    ratings, titles = frames(
        spark,
        [(5, 1, 5, day(2004)), (6, 1, 5, day(2004)), (404, 1, 1, day(1999)), (6, 2, 5, day(2004))],
        [(5, 1990, "a"), (6, None, "b")],
    )
    rows = {r.user_id: r for r in profile.build_profiles(ratings, titles).collect()}
    assert (rows[1].avg_release_year, rows[1].avg_watch_year, rows[1].movies) == (1990.0, 2004.0, [5, 6])
    assert rows[2].avg_release_year is None


@pytest.mark.parametrize("part_size", [4, 50])
def test_hot_user_is_cut_but_whole(spark, part_size):
    hot = [(m % 30, 1, 1 + m % 5, day(2000 + m % 5)) for m in range(120)]
    rest = [(u, u, 3, day(2002)) for u in range(2, 30) for _ in range(2)]
    ratings, titles = frames(spark, hot + rest, [(m, 1950 + m, "t") for m in range(30)])
    whole = {r.user_id: r for r in profile.build_profiles(ratings, titles).collect()}
    parts = profile.build_profiles(ratings, titles, part_size).orderBy("user_id", "part").collect()
    assert len([r for r in parts if r.user_id == 1]) == -(-120 // part_size)
    lists = {}
    for r in parts:
        lists.setdefault(r.user_id, []).extend(r.movies)
        assert len(r.movies) <= part_size
        assert (r.avg_rating, r.avg_watch_year, r.avg_release_year) == (
            whole[r.user_id].avg_rating,
            whole[r.user_id].avg_watch_year,
            whole[r.user_id].avg_release_year,
        )
    assert lists == {user: list(r.movies) for user, r in whole.items()}


def test_histogram(spark):
    averages = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 4.0)], "user_id long, avg_rating double")
    rows = profile.average_histogram(averages, "avg_rating").collect()
    assert sorted(map(tuple, rows)) == [(3.0, 2), (4.0, 1)]


def test_holdout_in_text_order(spark):
    rows = [(u, 0.0, 2000.0, 1990.0, p, [u]) for u in (1, 2, 10, 11, 3) for p in range(2 if u == 10 else 1)]
    chosen = profile.holdout_users(spark.createDataFrame(rows, PROFILES), limit=3)
    assert sorted((r.user_id, r.part) for r in chosen.collect()) == [(1, 0), (10, 0), (10, 1), (11, 0)]


def test_lookup(spark):
    profiles = spark.createDataFrame([(u, 0.0, 2000.0, 1990.0, 0, [u]) for u in range(5)], PROFILES)
    wanted = spark.createDataFrame([(1,), (1,), (9,)], "user_id long")
    assert [r.user_id for r in profile.lookup_profiles(profiles, wanted).collect()] == [1]
