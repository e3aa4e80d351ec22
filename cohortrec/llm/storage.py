"""Paths below the shared folder of the running application."""

import uuid

from pyspark.sql import SparkSession

from cohortrec.plans.materialize import shared_root


def new_path(spark: SparkSession, name: str) -> str:
    """A path not used before; ``release_tables`` deletes it with the other written tables."""
    return f"{shared_root(spark)}/cohortrec/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"
