"""The jobs: profiles, clusters, classification and recommendation, chained through tables."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortrec.operators.kmeans import (
    CLUSTERS,
    FEATURES,
    Centroid,
    KMeansFit,
    centroid_frame,
    centroid_rows,
    fit,
    weighted_cells,
    with_membership,
)
from cohortrec.operators.knn import NEIGHBOURS, classify
from cohortrec.operators.membership import cluster_members
from cohortrec.operators.profile import build_profiles, first_rows, holdout_users
from cohortrec.operators.recommend import (
    RECOMMENDATIONS,
    cluster_movie_list,
    cluster_movies,
    recommend,
    title_lists,
)
from cohortrec.plans.materialize import materialize, scoped_tables
from cohortrec.plans.restart import StageRecord
from cohortrec.sources import sinks
from cohortrec.sources.tables import latest_rows, read_table, replace_table
from cohortrec.sources.text import (
    read_headered,
    read_ratings,
    read_seed_centroids,
    read_test_users,
    read_titles,
    with_movie_arrays,
)


@dataclass(frozen=True)
class Cohorts:
    """Profiles with ``membership`` (a narrow plan over one written table) and the model."""

    profiles: DataFrame
    model: KMeansFit


def cluster_profiles(
    profiles: DataFrame, seeds: Sequence[Centroid], features: Sequence[str] = FEATURES
) -> Cohorts:
    """Fit the clusters and set every user's membership.

    ``profiles`` should be a written table; it is read once for the cells. Membership follows
    the assignment of the last executed step, and the final centroids are the means of it.
    """
    cells = materialize(weighted_cells(first_rows(profiles), features), "cells")
    model = fit(cells, seeds)
    return Cohorts(with_membership(profiles, model.members_of, features), model)


def latest_tables(ratings: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with one row per key, as a keyed store would hold them after loading.

    Of ratings with one key the latest counts, of titles of one movie the greatest. ``titles`` may
    have a column ``version`` that decides before the others.
    """
    version = ["version"] if "version" in titles.columns else []
    titles = latest_rows(titles, ["movie_id"], [*version, "release_year", "title"])
    version = ["watch_date", "movie_id", "user_id", "rating"]
    return latest_rows(ratings, ["rating_key"], version), titles.select("movie_id", "release_year", "title")


def build_cohorts(ratings: DataFrame, titles: DataFrame, seeds: Sequence[Centroid]) -> Cohorts:
    """Profile build and clustering. ``titles`` must have one row per movie, see ``latest_tables``."""
    return cluster_profiles(materialize(build_profiles(ratings, titles), "profiles"), seeds)


def classified_holdout(
    cohorts: Cohorts, limit: int = 500, k: int = NEIGHBOURS, exclude_self: bool = False
) -> DataFrame:
    """The held-out users with the membership voted by their neighbours, as a written table."""
    tests = materialize(holdout_users(cohorts.profiles, limit), "test_users")
    return materialize(classify(first_rows(cohorts.profiles), tests, k, exclude_self), "knn_assignments")


def recommend_top(cohorts: Cohorts, titles: DataFrame, limit: int | None = RECOMMENDATIONS) -> DataFrame:
    """Recommended titles for the held-out users."""
    return recommend(classified_holdout(cohorts), cluster_movies(cohorts.profiles), titles, limit)


def run_files(
    spark: SparkSession,
    ratings_path: str,
    titles_path: str,
    seeds_path: str,
    out: str,
    test_users_path: str | None = None,
    k: int = CLUSTERS,
    headered: bool = False,
    list_all: bool = False,
    resume: bool = False,
) -> None:
    """All stages from text inputs to tables and text outputs under ``out``.

    Without ``test_users_path`` the first 500 profiles are exported and used as test users. With
    ``headered`` the ratings are files of ``movie_id:`` lines and ``user,rating,date`` lines, and their rows
    are kept in ``out/ratings``. ``list_all`` also writes every unseen movie of every test user, which is as long as
    test users times movies of their cluster. Tables between the steps of a stage are deleted at the end.

    Stages read the outputs of earlier ones from ``out`` and are recorded there when they are whole. ``resume`` goes on
    after the last recorded stage of a run with the same arguments; inputs must not have changed in between.
    """
    settings = {
        "ratings": ratings_path, "titles": titles_path, "seeds": seeds_path, "test_users": test_users_path,
        "k": k, "headered": headered, "list_all": list_all,
    }
    record = StageRecord(spark, out, settings, resume)

    def table(name: str) -> DataFrame:
        return read_table(spark, f"{out}/{name}")

    def load() -> None:
        replace_table(read_titles(spark, titles_path), f"{out}/titles")
        if headered:
            replace_table(read_headered(spark, ratings_path), f"{out}/ratings")

    def profile() -> None:
        ratings = table("ratings") if headered else read_ratings(spark, ratings_path)
        replace_table(build_profiles(ratings, table("titles")), f"{out}/unplaced_profiles")

    def cluster() -> None:
        seeds = centroid_rows(read_seed_centroids(spark, seeds_path, k))
        cohorts = cluster_profiles(table("unplaced_profiles"), seeds)
        replace_table(centroid_frame(spark, cohorts.model.centroids), f"{out}/centroids")
        replace_table(cohorts.profiles, f"{out}/profiles")

    def export() -> None:
        profiles = table("profiles")
        sinks.write_lines(sinks.profile_lines(profiles), f"{out}/profile_text")
        replace_table(cluster_members(profiles), f"{out}/cluster_members")
        sinks.write_lines(sinks.cluster_list_lines(cluster_movie_list(profiles)), f"{out}/cluster_movie_list")
        replace_table(cluster_movies(profiles), f"{out}/cluster_movies")
        if test_users_path is None:
            sinks.write_lines(sinks.holdout_lines(holdout_users(profiles)), f"{out}/test_users")

    def label() -> None:
        tests = with_movie_arrays(read_test_users(spark, test_users_path or f"{out}/test_users"))
        replace_table(classify(first_rows(table("profiles")), tests), f"{out}/knn_assignments")

    def offer() -> None:
        labelled, movies, titles = table("knn_assignments"), table("cluster_movies"), table("titles")
        replace_table(recommend(labelled, movies, titles), f"{out}/recommended")
        top = table("recommended")
        sinks.write_lines(sinks.recommendation_lines(top), f"{out}/recommendations")
        sinks.write_lines(sinks.title_list_lines(title_lists(top, titles)), f"{out}/title_lists")
        if list_all:
            everything = recommend(labelled, movies, titles, limit=None)
            sinks.write_lines(sinks.recommendation_lines(everything), f"{out}/all_recommendations")

    with scoped_tables(spark):
        for stage in (load, profile, cluster, export, label, offer):
            record.stage(stage.__name__, stage)
