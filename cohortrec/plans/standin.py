"""Rating facts on the star-schema test tables: customers rate the parts they ordered."""

from pyspark.sql import DataFrame, SparkSession

from cohortrec.operators.kmeans import CLUSTERS, Centroid
from cohortrec.sources.tables import read_table

# Fixed values of the stand-in, shared with the check SQL.
RATINGS_EXPR = [
    "l_orderkey * 10 + l_linenumber AS rating_key",
    "l_partkey AS movie_id",
    "o_custkey AS user_id",
    "CAST(l_quantity AS INT) % 5 + 1 AS rating",
    "CAST(l_shipdate AS DATE) AS watch_date",
]
TITLES_EXPR = ["p_partkey AS movie_id", "1945 + p_size AS release_year", "p_name AS title"]
SEEDS: list[Centroid] = [(i, 1960.0 + i, 1996.0 + i % 4) for i in range(CLUSTERS)]
# Too far away for any user, so this seed stays without members.
FAR_SEED: Centroid = (CLUSTERS, 5000.0, 5000.0)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet")
    orders = read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_custkey"])
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(*RATINGS_EXPR)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/part.parquet").selectExpr(*TITLES_EXPR)
