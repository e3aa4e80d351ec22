"""Run a registered query in Spark and its SQL twin in DuckDB, and compare whole results."""

import glob
import os
from collections import Counter

import duckdb

DATA = os.environ.get("COHORTREC_TESTDATA", "/root/testdata")


def twin(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def type_name(name):
    plain = name.lower()
    for short, long in (
        ("bigint", "long"), ("int", "integer"), ("varchar", "string"), ("integer", "integer"),
    ):
        if plain == short:
            return long
    return plain


def compare(spark_df, con, sql):
    """Returns a list of differences; empty when names, types and rows agree."""
    columns = sorted(spark_df.columns)
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    twin_types = {row[0]: type_name(row[1]) for row in described}
    spark_types = {f.name: type_name(f.dataType.simpleString()) for f in spark_df.schema.fields}
    if spark_types != twin_types:
        return [f"columns differ: {spark_types} / {twin_types}"]
    select = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(con.execute(f"SELECT {select} FROM ({sql})").fetchall())
    table = spark_df.select(*columns).toArrow()
    found = Counter(zip(*[table.column(c).to_pylist() for c in columns]))
    if found == expected:
        return []
    return [
        f"{sum(found.values())} rows in Spark, {sum(expected.values())} in the twin",
        f"only in Spark: {list((found - expected).items())[:3]}",
        f"only in the twin: {list((expected - found).items())[:3]}",
    ]
