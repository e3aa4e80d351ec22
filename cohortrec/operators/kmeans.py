"""Seeded K-Means on two features with a fixed tie, stop and empty-cluster rule.

Points are collapsed to weighted cells first: profile features are rounded, so any number of
users shares few distinct points. Assignment is a narrow expression over the K centroids held as
literals, a step shuffles at most K partial sums per task, and only K rows reach the driver.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrec.functions import manhattan, same_truncated

CLUSTERS = 20
MAX_STEPS = 50
FEATURES = ("avg_release_year", "avg_watch_year")

Centroid = tuple[int, float, float]


@dataclass(frozen=True)
class KMeansFit:
    """``members_of`` are the centroids of the last executed assignment, ``centroids`` its means."""

    members_of: list[Centroid]
    centroids: list[Centroid]
    steps: int
    converged: bool


def centroid_rows(centroids: DataFrame) -> list[Centroid]:
    """K rows in id order."""
    return [tuple(r) for r in centroids.select("cluster_id", "x", "y").orderBy("cluster_id").collect()]


def centroid_frame(spark: SparkSession, centroids: Sequence[Centroid]) -> DataFrame:
    """K literal rows, whose size the optimizer knows."""
    rows = ", ".join(f"(CAST({cid} AS INT), {float(x)!r}D, {float(y)!r}D)" for cid, x, y in centroids)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS centroids(cluster_id, x, y)")


def weighted_cells(profiles: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Distinct points ``(x, y)`` and the number of users ``n`` on each.

    ``profiles`` has one row per user. A user without both features belongs to no cluster.
    """
    x, y = features
    points = profiles.select(F.col(x).alias("x"), F.col(y).alias("y")).dropna()
    return points.groupBy("x", "y").agg(F.count("*").alias("n"))


def _distance_sql(x: str, y: str, cx: float, cy: float) -> str:
    """The distance of columns ``x``, ``y`` to fixed coordinates, as SQL text: one call builds it."""
    dx, dy = f"(`{x}` - {float(cx)!r}D)", f"(`{y}` - {float(cy)!r}D)"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def nearest(x: str, y: str, centroids: Sequence[Centroid]) -> tuple[Column, Column]:
    """Id and distance of the nearest centroid; the lowest id wins a tie.

    The distances form one flat array in id order, which compiles to straight-line code. A
    lambda over the centroids would be interpreted for every row.
    """
    ordered = sorted(centroids)
    distances = f"array({', '.join(_distance_sql(x, y, cx, cy) for _, cx, cy in ordered)})"
    ids = f"array({', '.join(str(cid) for cid, _, _ in ordered)})"
    place = f"cast(array_position({distances}, array_min({distances})) as int)"
    return F.expr(f"get({ids}, {place} - 1)"), F.expr(f"array_min({distances})")


def assign(
    profiles: DataFrame, centroids: Sequence[Centroid], features: Sequence[str] = FEATURES
) -> DataFrame:
    """Every user with the nearest cluster; a narrow projection, no join."""
    x, y = features
    cluster, distance = nearest(x, y, centroids)
    return profiles.dropna(subset=[x, y]).select(
        "user_id",
        cluster.alias("cluster_id"),
        distance.alias("distance"),
        F.col(x).alias("x"),
        F.col(y).alias("y"),
    )


def with_membership(
    profiles: DataFrame, centroids: Sequence[Centroid], features: Sequence[str] = FEATURES
) -> DataFrame:
    """A new snapshot of the profiles with ``membership`` set; NULL without both features."""
    x, y = features
    cluster, _ = nearest(x, y, centroids)
    placed = F.col(x).isNotNull() & F.col(y).isNotNull()
    return profiles.withColumn("membership", F.when(placed, cluster))


def centroid_distances(
    profiles: DataFrame,
    centroids: Sequence[Centroid],
    metric: str = "euclidean",
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """The distance of every user to each of the K centroids; Manhattan works on whole numbers."""
    x, y = features

    def pair(centroid: Centroid) -> Column:
        cid, cx, cy = centroid
        if metric == "manhattan":
            points = (F.col(x).cast("int"), F.col(y).cast("int"), F.lit(int(cx)), F.lit(int(cy)))
            distance = manhattan(*points)
        else:
            distance = F.expr(_distance_sql(x, y, cx, cy))
        return F.struct(F.lit(cid).alias("cluster_id"), distance.alias("distance"))

    return profiles.select("user_id", F.inline(F.array(*map(pair, centroids))))


def cell_means(cells: DataFrame, centroids: Sequence[Centroid]) -> DataFrame:
    """Mean point and number of users of every cluster that has members."""
    cluster, _ = nearest("x", "y", centroids)
    placed = cells.withColumn("cluster_id", cluster)
    return placed.groupBy("cluster_id").agg(
        (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x"),
        (F.sum(F.col("y") * F.col("n")) / F.sum("n")).alias("y"),
        F.sum("n").alias("n"),
    )


def update(assigned: DataFrame) -> DataFrame:
    """New centroids of an assignment with one row per user: coordinate sums over user count."""
    return assigned.groupBy("cluster_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def step(cells: DataFrame, centroids: Sequence[Centroid]) -> DataFrame:
    """One assignment and update. Ids are stable: a cluster without members keeps its point."""
    old = centroid_frame(cells.sparkSession, centroids).withColumnsRenamed({"x": "_x", "y": "_y"})
    return old.join(cell_means(cells, centroids), "cluster_id", "left").select(
        "cluster_id",
        F.coalesce("x", "_x").alias("x"),
        F.coalesce("y", "_y").alias("y"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def converged(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: does every old centroid equal some new one after dropping the fractions?"""
    same = same_truncated(F.col("o.x"), F.col("o.y"), F.col("w.x"), F.col("w.y"))
    moved = old.alias("o").join(new.alias("w"), same, "left_anti")
    return moved.agg((F.count("*") == 0).alias("converged"))


def _settled(old: Sequence[Centroid], new: Sequence[Centroid]) -> bool:
    points = {(int(x), int(y)) for _, x, y in new}
    return all((int(x), int(y)) in points for _, x, y in old)


def fit(cells: DataFrame, seeds: Sequence[Centroid], max_steps: int = MAX_STEPS) -> KMeansFit:
    """Repeat ``step`` until the centroids settle or ``max_steps`` ran.

    Pass a written or cached ``cells``; each step then reads it once, and since the next
    step starts from K plain numbers the plan does not grow.
    """
    current = list(seeds)
    for steps in range(1, max_steps + 1):
        found = {r["cluster_id"]: (r["cluster_id"], r["x"], r["y"]) for r in cell_means(cells, current).collect()}
        means = [found.get(c[0], c) for c in current]
        done = _settled(current, means)
        if done or steps == max_steps:
            return KMeansFit(current, means, steps, done)
        current = means
    raise ValueError("max_steps must be at least 1")
