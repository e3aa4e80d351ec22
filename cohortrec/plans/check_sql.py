"""Plain SQL twins of the registered queries, for comparison in an independent engine.

They state each result directly (brute-force joins, window ranks, a recursive query for K-Means)
and share no plan with the Spark side.
"""

BASE = """
ratings AS (
  SELECT l_orderkey * 10 + l_linenumber AS rating_key, l_partkey AS movie_id, o_custkey AS user_id,
         CAST(CAST(l_quantity AS INT) % 5 + 1 AS INT) AS rating, CAST(l_shipdate AS DATE) AS watch_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
titles AS (SELECT p_partkey AS movie_id, CAST(1945 + p_size AS INT) AS release_year, p_name AS title FROM part)
"""

# User lists hold up to 100000 entries per row, cluster lists 1000.
PROFILES = (
    BASE
    + """,
rated AS (
  SELECT r.user_id, r.movie_id, r.rating, CAST(year(r.watch_date) AS INT) AS watch_year, t.release_year
  FROM ratings r JOIN titles t ON r.movie_id = t.movie_id),
people AS (
  SELECT user_id,
         CAST(floor(sum(rating - 2.5::DOUBLE) / count(rating) + 0.5::DOUBLE) AS DOUBLE) AS avg_rating,
         CAST(floor(sum(CAST(watch_year AS DOUBLE)) / count(watch_year) + 0.5::DOUBLE) AS DOUBLE) AS avg_watch_year,
         CAST(floor(sum(CAST(release_year AS DOUBLE)) / count(release_year) + 0.5::DOUBLE) AS DOUBLE) AS avg_release_year
  FROM rated GROUP BY user_id),
user_lists AS (
  SELECT user_id, part, string_agg(CAST(movie_id AS VARCHAR), ',' ORDER BY movie_id) AS movies
  FROM (SELECT user_id, movie_id,
               (row_number() OVER (PARTITION BY user_id ORDER BY movie_id) - 1) // 100000 AS part FROM rated)
  GROUP BY user_id, part),
profiles AS (SELECT * FROM people JOIN user_lists USING (user_id))
"""
)

SEED_ROWS = """SELECT CAST(i AS INT) AS cluster_id, 1960.0::DOUBLE + i AS x, 1996.0::DOUBLE + i % 4 AS y
               FROM range(20) AS r(i)"""

ASSIGNED = (
    PROFILES
    + f""",
seeds AS ({SEED_ROWS}),
assigned AS (
  SELECT user_id, px, py, cluster_id, distance FROM (
    SELECT user_id, p.avg_release_year AS px, p.avg_watch_year AS py, cluster_id,
           sqrt((p.avg_release_year - x) * (p.avg_release_year - x)
              + (p.avg_watch_year - y) * (p.avg_watch_year - y)) AS distance
    FROM people p, seeds)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY distance, cluster_id) = 1)
"""
)

# One row per step and cluster; done marks the step whose means settle the centroids before it.
FITTED = (
    PROFILES
    + f""",
cells AS MATERIALIZED (
  SELECT avg_release_year AS cx, avg_watch_year AS cy, count(*) AS n FROM people GROUP BY 1, 2),
steps AS (
  SELECT 0 AS step, cluster_id, x, y, false AS done FROM ({SEED_ROWS})
  UNION ALL
  SELECT step, cluster_id, x, y,
         bool_and(list_contains(fresh, struct_pack(fx := trunc(old_x), fy := trunc(old_y)))) OVER () AS done
  FROM (
    SELECT o.step + 1 AS step, o.cluster_id, coalesce(m.x, o.x) AS x, coalesce(m.y, o.y) AS y,
           o.x AS old_x, o.y AS old_y,
           list(struct_pack(fx := trunc(coalesce(m.x, o.x)), fy := trunc(coalesce(m.y, o.y)))) OVER () AS fresh
    FROM (SELECT * FROM steps WHERE NOT done AND step < 50) o
    LEFT JOIN (
      SELECT cluster_id, sum(cx * n) / sum(n) AS x, sum(cy * n) / sum(n) AS y
      FROM (
        SELECT cx, cy, n, cluster_id,
               row_number() OVER (PARTITION BY cx, cy ORDER BY sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y)), cluster_id) AS place
        FROM cells, steps)
      WHERE place = 1 GROUP BY cluster_id) m
    ON o.cluster_id = m.cluster_id)),
last_step AS (SELECT max(step) AS step FROM steps),
membership AS (
  SELECT user_id, CAST(cluster_id AS INT) AS membership FROM (
    SELECT user_id, cluster_id,
           row_number() OVER (PARTITION BY user_id ORDER BY
             sqrt((avg_release_year - x) * (avg_release_year - x) + (avg_watch_year - y) * (avg_watch_year - y)),
             cluster_id) AS place
    FROM people, steps WHERE steps.step = (SELECT step - 1 FROM last_step))
  WHERE place = 1),
clustered AS (SELECT * FROM people JOIN membership USING (user_id)),
cluster_entries AS (SELECT membership AS cluster_id, movie_id FROM rated JOIN membership USING (user_id))
"""
)

TESTS = """,
tests AS (SELECT user_id, avg_watch_year, avg_release_year FROM people ORDER BY CAST(user_id AS VARCHAR) LIMIT 500)
"""

NEIGHBOURS = (
    TESTS
    + """,
near AS (
  SELECT * FROM (
    SELECT t.user_id AS test_user_id, p.user_id,
           sqrt((p.avg_release_year - t.avg_release_year) * (p.avg_release_year - t.avg_release_year)
              + (p.avg_watch_year - t.avg_watch_year) * (p.avg_watch_year - t.avg_watch_year)) AS distance
    FROM tests t, people p)
  QUALIFY row_number() OVER (PARTITION BY test_user_id ORDER BY distance, user_id) <= 25),
neighbours AS (
  SELECT test_user_id, user_id, distance,
         CAST(row_number() OVER (PARTITION BY test_user_id ORDER BY distance, user_id) AS INT) AS rn FROM near)
"""
)

CLASSIFIED = (
    FITTED
    + NEIGHBOURS
    + """,
labels AS (
  SELECT test_user_id AS user_id, membership FROM (
    SELECT test_user_id, membership, count(*) AS votes FROM neighbours JOIN membership USING (user_id) GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY test_user_id ORDER BY votes DESC, membership) = 1)
"""
)

CANDIDATES = (
    CLASSIFIED
    + """,
cluster_movies AS (SELECT DISTINCT cluster_id, movie_id FROM cluster_entries),
watched AS (SELECT DISTINCT user_id, movie_id FROM rated),
candidates AS (
  SELECT l.user_id, c.movie_id FROM labels l JOIN cluster_movies c ON c.cluster_id = l.membership
  WHERE NOT EXISTS (SELECT 1 FROM watched w WHERE w.user_id = l.user_id AND w.movie_id = c.movie_id)),
top AS (
  SELECT user_id, movie_id, title, CAST(rn AS INT) AS rn FROM (
    SELECT user_id, movie_id, row_number() OVER (PARTITION BY user_id ORDER BY movie_id) AS rn FROM candidates)
  LEFT JOIN titles USING (movie_id) WHERE rn <= 10)
"""
)

_CLUSTER_LIST = """
  SELECT cluster_id, part, string_agg(CAST({item} AS VARCHAR), ',' ORDER BY {item}) AS {out}
  FROM (SELECT cluster_id, {item},
               (row_number() OVER (PARTITION BY cluster_id ORDER BY {item}) - 1) // 1000 AS part FROM {source})
  GROUP BY cluster_id, part"""


def _sql(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{body.strip()}"


_RATING_COLUMNS = "rating_key, movie_id, user_id, rating, watch_date"

SQL: dict[str, str] = {
    "ratings_scan": _sql(BASE, f"SELECT {_RATING_COLUMNS} FROM ratings"),
    "pruned_scan": _sql(BASE, "SELECT DISTINCT user_id, movie_id FROM ratings"),
    "titles_scan": _sql(
        BASE,
        """SELECT p_partkey AS movie_id, CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(1945 + p_size AS INT) END AS release_year,
                  p_name || ', ' || p_brand AS title FROM part""",
    ),
    "test_users_scan": _sql(
        PROFILES,
        """SELECT user_id, avg_watch_year,
                  CASE WHEN avg_watch_year % 2 = 0 THEN avg_release_year ELSE avg_release_year + 1 END AS avg_release_year,
                  part, CASE WHEN avg_watch_year % 2 = 0 THEN movies ELSE '0' END AS movies
           FROM profiles""",
    ),
    "seed_centroids": _sql(
        PROFILES,
        """SELECT CAST(row_number() OVER (ORDER BY user_id) - 1 AS INT) AS cluster_id, avg_release_year AS x, avg_watch_year AS y
           FROM people ORDER BY user_id LIMIT 20""",
    ),
    "headered_ingest": _sql(
        BASE,
        """SELECT row_number() OVER (ORDER BY movie_id, rating_key, user_id, rating, watch_date) - 1 AS rating_key,
                  movie_id, user_id, rating, watch_date FROM ratings""",
    ),
    "quoted_cells": """
        SELECT trim(text, ' ') AS cell FROM documents WHERE text IS NOT NULL AND source IS NOT NULL
        UNION ALL SELECT source FROM documents WHERE text IS NOT NULL AND source IS NOT NULL""",
    "titles_latest": _sql(
        BASE, "SELECT movie_id, CAST(release_year + 1 AS INT) AS release_year, title || ', 1' AS title FROM titles"
    ),
    "replace_table": _sql(BASE, "SELECT movie_id, title FROM titles WHERE release_year > 1960"),
    "wide_row_map": _sql(
        BASE,
        """SELECT user_id, movie_id, rating FROM ratings
           QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY watch_date DESC, rating DESC) = 1""",
    ),
    "cluster_list_scan": _sql(FITTED, "SELECT cluster_id, movie_id FROM cluster_entries"),
    "cells_to_rows": """
        SELECT p_name AS cell FROM part WHERE trim(p_name) <> ''
        UNION ALL SELECT p_type || ', ' || p_brand FROM part
        UNION ALL SELECT CAST(p_size AS VARCHAR) FROM part""",
    "first_field": """
        SELECT split_part(line, ',', 1) AS field
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE contains(line, ',')""",
    "upsert_latest": _sql(
        BASE,
        f"""SELECT {_RATING_COLUMNS} FROM ratings
            QUALIFY row_number() OVER (PARTITION BY rating_key
              ORDER BY watch_date DESC, movie_id DESC, user_id DESC, rating DESC) = 1""",
    ),
    "profile_text": _sql(
        PROFILES,
        """SELECT user_id || chr(9) || printf('%.2f', avg_rating) || ',' || printf('%.2f', avg_watch_year) || ','
                  || printf('%.2f', avg_release_year) || ',' || movies AS line FROM profiles""",
    ),
    "holdout_export": _sql(
        PROFILES + TESTS,
        "SELECT user_id, avg_watch_year, avg_release_year, part, movies FROM tests JOIN user_lists USING (user_id)",
    ),
    "center_ratings": _sql(BASE, "SELECT rating_key, movie_id, user_id, rating - 2.5::DOUBLE AS centered FROM ratings"),
    "watch_year": _sql(
        BASE, "SELECT rating_key, movie_id, user_id, CAST(year(watch_date) AS INT) AS watch_year FROM ratings"
    ),
    "round_half_up": _sql(
        BASE,
        """SELECT user_id, mean_centered, CAST(floor(mean_centered + 0.5::DOUBLE) AS DOUBLE) AS rounded
           FROM (SELECT user_id, sum(rating - 2.5::DOUBLE) / count(rating) AS mean_centered FROM ratings GROUP BY user_id)""",
    ),
    "euclidean_distance": _sql(
        PROFILES,
        f"""SELECT user_id, cluster_id, sqrt((avg_release_year - x) * (avg_release_year - x)
                   + (avg_watch_year - y) * (avg_watch_year - y)) AS distance FROM people, ({SEED_ROWS})""",
    ),
    "manhattan_distance": _sql(
        PROFILES,
        f"""SELECT user_id, cluster_id, CAST(abs(trunc(avg_release_year) - trunc(x)) + abs(trunc(avg_watch_year) - trunc(y)) AS INT)
                   AS distance FROM people, ({SEED_ROWS})""",
    ),
    "explode_movies": _sql(PROFILES, "SELECT user_id, movie_id FROM rated"),
    "profile_lookup": _sql(
        PROFILES,
        """SELECT user_id, avg_rating, avg_watch_year, part, movies FROM profiles
           WHERE user_id IN (SELECT user_id FROM events)""",
    ),
    "replicated_join": _sql(PROFILES, "SELECT user_id, movie_id, rating, watch_year, release_year FROM rated"),
    "user_profile": _sql(
        PROFILES, "SELECT user_id, avg_rating, avg_watch_year, avg_release_year, part, movies FROM profiles"
    ),
    "user_averages": _sql(
        BASE,
        """SELECT user_id, sum(CAST(rating AS DOUBLE)) / count(rating) AS avg_rating,
                  sum(CAST(year(watch_date) AS DOUBLE)) / count(watch_date) AS avg_watch_year
           FROM ratings GROUP BY user_id""",
    ),
    "average_histogram_rating": _sql(
        BASE,
        """SELECT avg, count(*) AS n FROM (SELECT sum(CAST(rating AS DOUBLE)) / count(rating) AS avg FROM ratings GROUP BY user_id)
           GROUP BY avg""",
    ),
    "average_histogram_year": _sql(
        BASE,
        """SELECT avg, count(*) AS n
           FROM (SELECT sum(CAST(year(watch_date) AS DOUBLE)) / count(watch_date) AS avg FROM ratings GROUP BY user_id)
           GROUP BY avg""",
    ),
    "kmeans_assign": _sql(ASSIGNED, "SELECT user_id, cluster_id, distance FROM assigned"),
    "kmeans_update": _sql(
        ASSIGNED,
        """SELECT cluster_id, sum(px) / count(DISTINCT user_id) AS x, sum(py) / count(DISTINCT user_id) AS y
           FROM assigned GROUP BY cluster_id""",
    ),
    "kmeans_step": _sql(
        PROFILES,
        f"""
        , old AS ({SEED_ROWS} UNION ALL SELECT 20, 5000.0::DOUBLE, 5000.0::DOUBLE),
        placed AS (
          SELECT p.user_id, p.avg_release_year AS px, p.avg_watch_year AS py, cluster_id FROM people p, old
          QUALIFY row_number() OVER (PARTITION BY p.user_id ORDER BY
            sqrt((p.avg_release_year - x) * (p.avg_release_year - x) + (p.avg_watch_year - y) * (p.avg_watch_year - y)),
            cluster_id) = 1),
        means AS (SELECT cluster_id, sum(px) / count(*) AS x, sum(py) / count(*) AS y, count(*) AS n FROM placed GROUP BY 1)
        SELECT old.cluster_id, coalesce(m.x, old.x) AS x, coalesce(m.y, old.y) AS y, coalesce(m.n, 0) AS n
        FROM old LEFT JOIN means m ON old.cluster_id = m.cluster_id""",
    ),
    "kmeans_converged": _sql(
        ASSIGNED,
        """
        , means AS (SELECT cluster_id, sum(px) / count(*) AS x, sum(py) / count(*) AS y FROM assigned GROUP BY 1),
        fresh AS (SELECT coalesce(m.x, s.x) AS x, coalesce(m.y, s.y) AS y FROM seeds s LEFT JOIN means m USING (cluster_id))
        SELECT count(*) = 0 AS converged FROM seeds s
        WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE trunc(f.x) = trunc(s.x) AND trunc(f.y) = trunc(s.y))""",
    ),
    "kmeans_fit": _sql(
        FITTED, "SELECT CAST(cluster_id AS INT) AS cluster_id, x, y FROM steps WHERE step = (SELECT step FROM last_step)"
    ),
    "kmeans_membership": _sql(FITTED, "SELECT user_id, membership AS cluster_id FROM membership"),
    "cluster_members": _sql(
        FITTED + ", labelled AS (SELECT membership AS cluster_id, user_id FROM membership)",
        _CLUSTER_LIST.format(item="user_id", out="members", source="labelled"),
    ),
    "cluster_sizes": _sql(
        FITTED, "SELECT membership AS cluster_id, count(DISTINCT user_id) AS n FROM membership GROUP BY membership"
    ),
    "assign_membership": _sql(FITTED, "SELECT user_id, membership FROM membership"),
    "clustered_profiles": _sql(
        FITTED,
        "SELECT user_id, avg_watch_year, avg_release_year, membership, part, movies FROM clustered JOIN user_lists USING (user_id)",
    ),
    "knn_neighbors": _sql(PROFILES + NEIGHBOURS, "SELECT test_user_id, user_id, distance, rn FROM neighbours"),
    "knn_classify": _sql(
        CLASSIFIED,
        """SELECT user_id, membership, avg_watch_year, avg_release_year, part, movies
           FROM labels JOIN tests USING (user_id) JOIN user_lists USING (user_id)""",
    ),
    "cluster_movies": _sql(FITTED, "SELECT DISTINCT cluster_id, movie_id FROM cluster_entries"),
    "cluster_movie_list": _sql(FITTED, _CLUSTER_LIST.format(item="movie_id", out="movies", source="cluster_entries")),
    "recommend_candidates": _sql(CANDIDATES, "SELECT user_id, movie_id FROM candidates"),
    "recommend_top10": _sql(CANDIDATES, "SELECT user_id, movie_id, title, rn FROM top"),
    "recommendation_text": _sql(
        CANDIDATES, "SELECT chr(9) || user_id || ',' || coalesce(title, 'null') AS line FROM top"
    ),
    "recommend_all": _sql(
        CANDIDATES,
        """SELECT user_id, count(*) AS n, min(movie_id) AS first_movie_id, max(movie_id) AS last_movie_id
           FROM candidates GROUP BY user_id""",
    ),
    "prediction_names": _sql(
        CANDIDATES,
        """SELECT user_id, CAST(0 AS BIGINT) AS part, string_agg(title, ',' ORDER BY movie_id) AS titles
           FROM top WHERE title IS NOT NULL GROUP BY user_id""",
    ),
    "cohort_join": _sql(
        CLASSIFIED,
        """SELECT l.user_id AS test_user_id, m.user_id, m.membership FROM labels l JOIN membership m ON m.membership = l.membership""",
    ),
    "cosine_similarity": _sql(
        BASE,
        """
        , vectors AS (SELECT user_id, movie_id, sum(CAST(rating AS DOUBLE)) / count(rating) AS rating FROM ratings GROUP BY 1, 2),
        norms AS (SELECT user_id, sqrt(sum(rating * rating)) AS norm FROM vectors GROUP BY 1),
        pairs AS (SELECT a.user_id AS left_id, b.user_id AS right_id, a.norm * b.norm AS length
                  FROM norms a JOIN norms b ON b.user_id = a.user_id + 1),
        dots AS (SELECT left_id, right_id, sum(l.rating * r.rating) AS dot
                 FROM pairs JOIN vectors l ON l.user_id = left_id
                 JOIN vectors r ON r.user_id = right_id AND r.movie_id = l.movie_id GROUP BY 1, 2)
        SELECT left_id, right_id, round(coalesce(dot, 0.0::DOUBLE) / nullif(length, 0.0::DOUBLE), 9) AS similarity
        FROM pairs LEFT JOIN dots USING (left_id, right_id)""",
    ),
    "similar_users": _sql(
        BASE,
        """
        , vectors AS (SELECT user_id, movie_id, sum(CAST(rating AS DOUBLE)) / count(rating) AS rating FROM ratings GROUP BY 1, 2),
        norms AS (SELECT user_id, sqrt(sum(rating * rating)) AS norm FROM vectors GROUP BY 1),
        dots AS (SELECT l.user_id AS left_id, r.user_id AS right_id, sum(l.rating * r.rating) AS dot
                 FROM vectors l JOIN vectors r ON r.movie_id = l.movie_id AND l.user_id < r.user_id GROUP BY 1, 2)
        SELECT left_id, right_id, round(dot / (a.norm * b.norm), 9) AS similarity
        FROM dots JOIN norms a ON a.user_id = left_id JOIN norms b ON b.user_id = right_id
        WHERE round(dot / (a.norm * b.norm), 9) >= 0.2""",
    ),
    "unseen_counts": _sql(CANDIDATES, "SELECT user_id, count(*) AS n FROM candidates GROUP BY user_id"),
    "stored_lookup": _sql(
        PROFILES,
        """SELECT user_id, avg_rating, avg_watch_year, part, movies FROM profiles
           WHERE user_id % 50 = 0 AND user_id IN (SELECT user_id FROM events)""",
    ),
    "upsert_keyed": _sql(
        BASE,
        f"""
        , latest AS (
          SELECT {_RATING_COLUMNS} FROM ratings
          QUALIFY row_number() OVER (PARTITION BY rating_key
            ORDER BY watch_date DESC, movie_id DESC, user_id DESC, rating DESC) = 1)
        SELECT rating_key, movie_id, user_id, CAST(CASE WHEN user_id % 13 = 0 THEN 6 - rating ELSE rating END AS INT) AS rating,
               watch_date FROM latest
        UNION ALL
        SELECT -rating_key, movie_id, user_id, rating, watch_date FROM latest WHERE user_id % 17 = 0""",
    ),
    "counted_ratings": _sql(
        BASE,
        """
        SELECT user_id, count(*) AS n, CAST(count(*) FILTER (rating_key % 13 <> 0) AS BIGINT) AS dated,
               (SELECT count(*) FROM ratings) AS lines,
               (SELECT count(*) FROM ratings WHERE rating_key % 11 <> 0) AS kept,
               (SELECT count(*) FROM ratings WHERE rating_key % 11 = 0) AS rejected,
               (SELECT count(*) FROM ratings WHERE rating_key % 11 = 0 OR rating_key % 13 = 0) AS damaged
        FROM ratings WHERE rating_key % 11 <> 0 GROUP BY user_id""",
    ),
    "cohort_factors": _sql(
        CLASSIFIED,
        """SELECT 'asked' AS side, l.user_id, l.membership, count(*) AS n
           FROM labels l JOIN membership m ON m.membership = l.membership GROUP BY ALL
           UNION ALL SELECT 'member', user_id, membership, NULL FROM membership""",
    ),
    "unseen_factors": _sql(
        CANDIDATES,
        """SELECT 'asked' AS side, l.user_id, l.membership AS cluster_id, CAST(NULL AS BIGINT) AS movie_id,
                  (SELECT count(*) FROM candidates c WHERE c.user_id = l.user_id) AS n FROM labels l
           UNION ALL SELECT 'offered', NULL, cluster_id, movie_id, NULL FROM cluster_movies
           UNION ALL SELECT 'seen', w.user_id, c.cluster_id, c.movie_id, NULL
           FROM watched w JOIN labels l ON l.user_id = w.user_id
           JOIN cluster_movies c ON c.cluster_id = l.membership AND c.movie_id = w.movie_id""",
    ),
}
SQL["cohort_join_tables"] = SQL["cohort_join"]
SQL["bucketed_profiles"] = SQL["user_profile"]
