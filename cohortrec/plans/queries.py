"""The registered queries: every operator over the whole stand-in tables of a directory."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrec.operators import kmeans, knn, membership, profile, recommend, similarity
from cohortrec.operators.lists import joined, list_start
from cohortrec.plans import jobs, standin
from cohortrec.plans.materialize import materialize, shared_root
from cohortrec.sources import catalog, sinks, tables, text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    return profile.build_profiles(standin.ratings(spark, sf), standin.titles(spark, sf))


def _people(spark: SparkSession, sf: str) -> DataFrame:
    return profile.first_rows(_profiles(spark, sf))


def _cohorts(spark: SparkSession, sf: str) -> jobs.Cohorts:
    return jobs.build_cohorts(standin.ratings(spark, sf), standin.titles(spark, sf), standin.SEEDS)


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/cohortrec/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def _text_list(rows: DataFrame) -> DataFrame:
    return rows.withColumn("movies", joined(F.col("movies")))


# --- sources ---------------------------------------------------------------------------------


@query("ratings_scan")
def ratings_scan(spark, sf):
    return standin.ratings(spark, sf)


@query("pruned_scan")
def pruned_scan(spark, sf):
    return standin.ratings(spark, sf).select("user_id", "movie_id").distinct()


@query("titles_scan")
def titles_scan(spark, sf):
    year = F.expr("CASE WHEN p_size % 7 = 0 THEN 'NULL' ELSE CAST(1945 + p_size AS STRING) END")
    part = tables.read_table(spark, f"{sf}/part.parquet")
    lines = part.select(F.concat_ws(",", "p_partkey", year, F.concat_ws(", ", "p_name", "p_brand")).alias("value"))
    return text.parse_titles(lines)


@query("test_users_scan")
def test_users_scan(spark, sf):
    """An early line for every user, a later one for some, and malformed lines at the end."""
    profiles = _profiles(spark, sf)
    early = F.concat_ws(",", "user_id", "avg_watch_year", F.col("avg_release_year") + 1, F.lit("0"))
    late = F.concat_ws(
        ",", "user_id", "avg_watch_year", "avg_release_year", F.concat(F.lit('"'), joined(F.col("movies")), F.lit('"'))
    )
    malformed = F.concat_ws(",", "user_id", "avg_watch_year", "avg_release_year")
    versions = F.array(
        F.struct(F.lit(0).alias("split"), early.alias("value")),
        F.struct(F.lit(1).alias("split"), F.when(F.col("avg_watch_year") % 2 == 0, late).alias("value")),
        F.struct(F.lit(2).alias("split"), malformed.alias("value")),
    )
    lines = profiles.select("part", F.lit("tests").alias("file"), F.col("user_id").alias("seq"), F.inline(versions))
    return text.parse_test_users(lines.where("value is not null"))


@query("seed_centroids")
def seed_centroids(spark, sf):
    """Profile points as seed lines in user order, each followed by a blank line."""
    values = F.posexplode(F.array(F.concat_ws(",", "avg_release_year", "avg_watch_year"), F.lit("")))
    lines = _people(spark, sf).select(
        F.lit("seeds").alias("file"), F.lit(0).alias("split"), "user_id", values.alias("nth", "value")
    )
    lines = lines.select("file", "split", (F.col("user_id") * 2 + F.col("nth")).alias("seq"), "value")
    return text.parse_seed_centroids(lines, kmeans.CLUSTERS)


@query("headered_ingest")
def headered_ingest(spark, sf):
    """One headered text per movie, cut into splits of 10 lines each."""
    order = ["rating_key", "user_id", "rating", "watch_date"]
    counts = standin.ratings(spark, sf).groupBy("movie_id", *order).agg(F.count("*").alias("n"))
    rated = list_start(counts, ["movie_id"], order)
    rated = rated.withColumn("line", F.explode(F.expr("sequence(start + 1, start + n)")))
    header = standin.titles(spark, sf).select(
        F.col("movie_id").alias("file"),
        F.lit(0).cast("long").alias("seq"),
        F.concat("movie_id", F.lit(":")).alias("value"),
    )
    data = rated.select(
        F.col("movie_id").alias("file"),
        F.col("line").alias("seq"),
        F.concat_ws(",", "user_id", "rating", "watch_date").alias("value"),
    )
    lines = header.unionByName(data).withColumn("split", F.expr("seq div 10"))
    return text.parse_headered(lines)


@query("wide_row_map")
def wide_row_map(spark, sf):
    return tables.wide_cells(tables.wide_rows(standin.ratings(spark, sf)))


@query("cluster_list_scan")
def cluster_list_scan(spark, sf):
    lists = recommend.cluster_movie_list(_cohorts(spark, sf).profiles)
    return text.parse_cluster_list(sinks.cluster_list_lines(lists).withColumnRenamed("line", "value"))


@query("cells_to_rows")
def cells_to_rows(spark, sf):
    """Padded, blank and quoted cells of one line per part."""
    quoted = F.concat(F.lit('"'), F.concat_ws(", ", "p_type", "p_brand"), F.lit('"'))
    padded = [F.concat(F.lit("  "), "p_name"), F.lit("   "), quoted, F.lit(""), F.concat("p_size", F.lit(" "))]
    line = F.concat_ws(",", *padded)
    return text.cells_to_rows(tables.read_table(spark, f"{sf}/part.parquet").select(line.alias("value")))


@query("quoted_cells")
def quoted_cells(spark, sf):
    """Every document as one quoted cell with doubled quotes, beside a plain cell."""
    doubled = F.replace("text", F.lit('"'), F.lit('""'))
    line = F.concat(F.lit('"'), doubled, F.lit('",'), "source")
    return text.cells_to_rows(tables.read_table(spark, f"{sf}/documents.parquet").select(line.alias("value")))


@query("titles_latest")
def titles_latest(spark, sf):
    """Title lines that repeat every movie; the later line counts."""
    version = F.explode(F.array(F.lit(0), F.lit(1))).alias("split")
    rows = standin.titles(spark, sf).select("*", version)
    line = F.concat_ws(",", "movie_id", F.col("release_year") + F.col("split"), F.concat_ws(", ", "title", "split"))
    return text.parse_titles(
        rows.select(F.lit("titles").alias("file"), "split", F.col("movie_id").alias("seq"), line.alias("value"))
    )


@query("first_field")
def first_field(spark, sf):
    documents = tables.read_table(spark, f"{sf}/documents.parquet", ["text"])
    return text.first_field(documents.select(F.explode(F.split("text", "\n")).alias("value")))


# --- sinks -----------------------------------------------------------------------------------


@query("upsert_latest")
def upsert_latest(spark, sf):
    version = ["watch_date", "movie_id", "user_id", "rating"]
    return tables.latest_rows(standin.ratings(spark, sf), ["rating_key"], version)


@query("replace_table")
def replace_table(spark, sf):
    """A table that is written, replaced by another snapshot, and read."""
    path = _new_path(spark, "titles")
    titles = standin.titles(spark, sf)
    tables.replace_table(titles, path)
    tables.replace_table(titles.where("release_year > 1960"), path)
    return tables.read_table(spark, path, ["movie_id", "title"])


@query("upsert_keyed")
def upsert_keyed(spark, sf):
    """A table in hash buckets; ratings of some users are turned around, those of others come again under new keys."""
    path = _new_path(spark, "keyed")
    version = ["watch_date", "movie_id", "user_id", "rating"]
    tables.write_keyed(tables.latest_rows(standin.ratings(spark, sf), ["rating_key"], version), path, ["rating_key"], buckets=16)
    stored = tables.read_keyed(spark, path)
    changed = stored.where("user_id % 13 = 0").withColumn("rating", 6 - F.col("rating"))
    added = stored.where("user_id % 17 = 0").withColumn("rating_key", -F.col("rating_key"))
    tables.upsert_keyed(spark, path, changed.unionByName(added), ["rating_key"])
    return tables.read_keyed(spark, path)


@query("counted_ratings")
def counted_ratings(spark, sf):
    """Rating lines, some without a usable id and some with a broken date; the rows that stay, beside all counts."""
    user = F.expr("CASE WHEN rating_key % 11 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END")
    date = F.expr("CASE WHEN rating_key % 13 = 0 THEN '2000-13-01' ELSE CAST(watch_date AS STRING) END")
    lines = standin.ratings(spark, sf).select(F.concat_ws(",", "rating_key", "movie_id", user, "rating", date).alias("value"))
    rows, counts = text.parse_ratings(lines)
    rows = materialize(rows, "ratings")
    totals = [F.lit(counts.get[name]).cast("long").alias(name) for name in ("lines", "kept", "rejected", "damaged")]
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count("watch_date").alias("dated")).select("*", *totals)


@query("profile_text")
def profile_text(spark, sf):
    return sinks.profile_lines(_profiles(spark, sf)).select("line")


@query("holdout_export")
def holdout_export(spark, sf):
    return _text_list(profile.holdout_users(materialize(_profiles(spark, sf), "profiles")))


# --- projections -----------------------------------------------------------------------------


@query("center_ratings")
def center_ratings(spark, sf):
    return profile.center_ratings(standin.ratings(spark, sf))


@query("watch_year")
def watch_year(spark, sf):
    return profile.watch_years(standin.ratings(spark, sf))


@query("round_half_up")
def round_half_up(spark, sf):
    return profile.rounded_means(standin.ratings(spark, sf))


@query("euclidean_distance")
def euclidean_distance(spark, sf):
    return kmeans.centroid_distances(_people(spark, sf), standin.SEEDS)


@query("manhattan_distance")
def manhattan_distance(spark, sf):
    return kmeans.centroid_distances(_people(spark, sf), standin.SEEDS, metric="manhattan")


@query("explode_movies")
def explode_movies(spark, sf):
    return profile.user_movies(_profiles(spark, sf))


@query("profile_lookup")
def profile_lookup(spark, sf):
    wanted = tables.read_table(spark, f"{sf}/events.parquet", ["user_id"]).distinct()
    return _text_list(profile.lookup_profiles(_profiles(spark, sf), wanted))


@query("stored_lookup")
def stored_lookup(spark, sf):
    """Some of the users of ``events`` looked up in profiles stored for it."""
    path = _new_path(spark, "lookup")
    profile.write_lookup(_profiles(spark, sf), path)
    wanted = tables.read_table(spark, f"{sf}/events.parquet", ["user_id"]).where("user_id % 50 = 0").distinct()
    return _text_list(profile.lookup_stored(spark, path, wanted))


# --- joins and aggregations ------------------------------------------------------------------


@query("replicated_join")
def replicated_join(spark, sf):
    return profile.rated_titles(standin.ratings(spark, sf), standin.titles(spark, sf))


@query("user_profile")
def user_profile(spark, sf):
    return _text_list(_profiles(spark, sf))


@query("user_averages")
def user_averages(spark, sf):
    return profile.user_averages(standin.ratings(spark, sf))


@query("average_histogram_rating")
def average_histogram_rating(spark, sf):
    return profile.average_histogram(profile.user_averages(standin.ratings(spark, sf)), "avg_rating")


@query("average_histogram_year")
def average_histogram_year(spark, sf):
    return profile.average_histogram(profile.user_averages(standin.ratings(spark, sf)), "avg_watch_year")


# --- clustering ------------------------------------------------------------------------------


@query("kmeans_assign")
def kmeans_assign(spark, sf):
    return kmeans.assign(_people(spark, sf), standin.SEEDS).select("user_id", "cluster_id", "distance")


@query("kmeans_update")
def kmeans_update(spark, sf):
    return kmeans.update(kmeans.assign(_people(spark, sf), standin.SEEDS))


@query("kmeans_step")
def kmeans_step(spark, sf):
    return kmeans.step(kmeans.weighted_cells(_people(spark, sf)), [*standin.SEEDS, standin.FAR_SEED])


@query("kmeans_converged")
def kmeans_converged(spark, sf):
    stepped = kmeans.step(kmeans.weighted_cells(_people(spark, sf)), standin.SEEDS)
    return kmeans.converged(kmeans.centroid_frame(spark, standin.SEEDS), stepped)


@query("kmeans_fit")
def kmeans_fit(spark, sf):
    return kmeans.centroid_frame(spark, _cohorts(spark, sf).model.centroids)


@query("kmeans_membership")
def kmeans_membership(spark, sf):
    placed = profile.first_rows(_cohorts(spark, sf).profiles)
    return placed.select("user_id", F.col("membership").alias("cluster_id"))


@query("cluster_members")
def cluster_members(spark, sf):
    return membership.cluster_members(_cohorts(spark, sf).profiles)


@query("cluster_sizes")
def cluster_sizes(spark, sf):
    return membership.cluster_sizes(_cohorts(spark, sf).profiles)


@query("assign_membership")
def assign_membership(spark, sf):
    profiles = _cohorts(spark, sf).profiles
    people = profile.first_rows(profiles).drop("membership")
    assigned = membership.assign_from_members(people, membership.cluster_members(profiles))
    return assigned.select("user_id", "membership")


@query("clustered_profiles")
def clustered_profiles(spark, sf):
    columns = ["user_id", "avg_watch_year", "avg_release_year", "membership", "part", "movies"]
    return _text_list(_cohorts(spark, sf).profiles.select(*columns))


# --- neighbours ------------------------------------------------------------------------------


@query("knn_neighbors")
def knn_neighbors(spark, sf):
    profiles = materialize(_profiles(spark, sf), "profiles").withColumn("membership", F.lit(None).cast("int"))
    people = profile.first_rows(profiles)
    return knn.neighbours(people, profile.holdout_users(people)).drop("membership")


@query("knn_classify")
def knn_classify(spark, sf):
    columns = ["user_id", "membership", "avg_watch_year", "avg_release_year", "part", "movies"]
    return _text_list(jobs.classified_holdout(_cohorts(spark, sf)).select(*columns))


# --- recommendation --------------------------------------------------------------------------


@query("cluster_movies")
def cluster_movies(spark, sf):
    return recommend.cluster_movies(_cohorts(spark, sf).profiles)


@query("cluster_movie_list")
def cluster_movie_list(spark, sf):
    return recommend.cluster_movie_list(_cohorts(spark, sf).profiles)


def _offer(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    cohorts = _cohorts(spark, sf)
    tests = jobs.classified_holdout(cohorts)
    return tests, recommend.cluster_movies(cohorts.profiles), recommend.watched_movies(tests)


@query("recommend_candidates")
def recommend_candidates(spark, sf):
    return recommend.unseen_movies(*_offer(spark, sf))


@query("recommend_top10")
def recommend_top10(spark, sf):
    return jobs.recommend_top(_cohorts(spark, sf), standin.titles(spark, sf))


@query("recommend_all")
def recommend_all(spark, sf):
    return recommend.unseen_summary(*_offer(spark, sf))


@query("unseen_counts")
def unseen_counts(spark, sf):
    cohorts = _cohorts(spark, sf)
    return recommend.unseen_counts(jobs.classified_holdout(cohorts), cohorts.profiles)


@query("recommendation_text")
def recommendation_text(spark, sf):
    return sinks.recommendation_lines(jobs.recommend_top(_cohorts(spark, sf), standin.titles(spark, sf)))


@query("prediction_names")
def prediction_names(spark, sf):
    """The recommendations as pair lines, parsed again and named."""
    titles = standin.titles(spark, sf)
    top = materialize(sinks.pair_lines(jobs.recommend_top(_cohorts(spark, sf), titles)), "pairs")
    return recommend.title_lists(text.parse_prediction_pairs(top.withColumnRenamed("line", "value")), titles)


@query("cohort_join")
def cohort_join(spark, sf):
    cohorts = _cohorts(spark, sf)
    tables.register_views(profile.first_rows(cohorts.profiles), jobs.classified_holdout(cohorts), "checked_")
    return membership.cohort_join(spark, "checked_")


@query("cohort_factors")
def cohort_factors(spark, sf):
    """The cohort join as its factors: who asks, and who belongs where."""
    cohorts = _cohorts(spark, sf)
    asked, members = membership.cohort_factors(cohorts.profiles, jobs.classified_holdout(cohorts))
    asked = asked.select(F.lit("asked").alias("side"), F.col("test_user_id").alias("user_id"), "membership", "n")
    return asked.union(members.select(F.lit("member"), "user_id", "membership", F.lit(None).cast("long")))


@query("cohort_join_tables")
def cohort_join_tables(spark, sf):
    """The cohort join over tables of the catalog."""
    cohorts = _cohorts(spark, sf)
    prefix = f"kept_{uuid.uuid4().hex}_"
    catalog.save_cohorts(cohorts.profiles, jobs.classified_holdout(cohorts), _new_path(spark, "catalog"), prefix)
    return membership.cohort_join(spark, prefix)


@query("unseen_factors")
def unseen_factors(spark, sf):
    """The uncapped recommendation as its factors: who asks, what the clusters hold, and what is seen of it."""
    tests, movies, watched = _offer(spark, sf)
    asked, seen = recommend.unseen_factors(tests, materialize(movies, "movies"), watched)
    none = F.lit(None).cast("long")
    rows = asked.select(F.lit("asked").alias("side"), "user_id", "cluster_id", none.alias("movie_id"), "n")
    rows = rows.union(movies.select(F.lit("offered"), none, "cluster_id", "movie_id", none))
    return rows.union(seen.select(F.lit("seen"), "user_id", "cluster_id", "movie_id", none))


@query("bucketed_profiles")
def bucketed_profiles(spark, sf):
    """Profiles from bucketed tables, whose join needs no exchange."""
    prefix = f"kept_{uuid.uuid4().hex}_"
    facts = catalog.save_facts(standin.ratings(spark, sf), standin.titles(spark, sf), _new_path(spark, "facts"), prefix, buckets=8)
    return _text_list(profile.build_profiles(*facts))


@query("cosine_similarity")
def cosine_similarity(spark, sf):
    """Every customer against the next one by id."""
    vectors = materialize(similarity.rating_vectors(standin.ratings(spark, sf)), "vectors")
    users = vectors.select(F.col("vec_id").alias("left_id")).distinct()
    following = users.select((F.col("left_id") - 1).alias("left_id"), F.col("left_id").alias("right_id"))
    found = similarity.cosine_similarity(vectors, users.join(following, "left_id"))
    return found.withColumn("similarity", F.round("similarity", 9))


@query("similar_users")
def similar_users(spark, sf):
    """All pairs of customers whose ratings have a cosine of at least 0.2."""
    found = similarity.similar_vectors(similarity.rating_vectors(standin.ratings(spark, sf)), 0.2)
    return found.withColumn("similarity", F.round("similarity", 9))
