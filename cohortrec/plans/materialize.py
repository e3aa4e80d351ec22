"""Written tables that cut lineage between the stages of a job."""

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Fallback folder of local sessions without a configured one.
_local_root: str | None = None
# Open scopes, each with the folders written inside it.
_scopes: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster session without it
    is refused, because a machine-local folder is not visible to the other executors.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="cohortrec-")
    return _local_root


def _application_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/cohortrec/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    Later stages read only the columns they need, see true sizes for their join choice, and
    after an executor loss restart from the table instead of the raw ratings.
    """
    spark = df.sparkSession
    folder = f"{_application_root(spark)}/{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(folder)
    df.write.parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scoped_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are materialized inside the block when it ends, and no others."""
    folders: list[str] = []
    _scopes.append(folders)
    try:
        yield
    finally:
        _scopes.pop()
        for folder in folders:
            _delete(spark, folder)


def release_tables(spark: SparkSession) -> None:
    """Delete all tables this application materialized, once no frame over them is needed."""
    _delete(spark, _application_root(spark))
