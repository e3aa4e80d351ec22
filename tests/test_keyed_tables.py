"""Tables that are replaced, updated by key, and looked up by key, by the files they touch."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from cohortrec.operators import profile
from cohortrec.sources import tables


def files_below(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def failing(spark, rows):
    return spark.range(rows).select(F.expr("CASE WHEN id = 3 THEN raise_error('stop') ELSE id END").cast("long").alias("id"))


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    before = files_below(path)
    with pytest.raises(Exception, match="stop"):
        tables.replace_table(failing(spark, 10), path)
    assert tables.read_table(spark, path).count() == 5
    assert files_below(path) == before
    tables.replace_table(spark.range(7), path)
    assert tables.read_table(spark, path).count() == spark.read.parquet(path).count() == 7
    assert os.listdir(tmp_path) == ["t"]


@pytest.mark.parametrize("break_at", [1, 2])
def test_broken_switch_leaves_the_old_table(spark, tmp_path, monkeypatch, break_at):
    path, done, rename = str(tmp_path / "t"), [], tables._rename
    tables.replace_table(spark.range(5), path)

    def broken(*args):
        done.append(args)
        if len(done) == break_at:
            raise OSError("driver gone")
        rename(*args)

    with monkeypatch.context() as m:
        m.setattr(tables, "_rename", broken)
        with pytest.raises(OSError, match="driver gone"):
            tables.replace_table(spark.range(9), path)
    assert tables.read_table(spark, path, ["id"]).count() == 5
    tables.replace_table(tables.read_table(spark, path).where("id > 0") if break_at == 1 else spark.range(4), path)
    assert tables.read_table(spark, path).count() == 4 and os.listdir(tmp_path) == ["t"]


def test_replacement_may_read_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    tables.replace_table(tables.read_table(spark, path).where("id > 2"), path)
    assert sorted(r.id for r in tables.read_table(spark, path, ["id"]).collect()) == [3, 4]


SCHEMA = "k long, v string"


def keyed(spark, tmp_path, n=1000, **options):
    path = str(tmp_path / "k")
    rows = [(i, f"old {i}") for i in range(n)] + [(None, "none")]
    tables.write_keyed(spark.createDataFrame(rows, SCHEMA), path, ["k"], **options)
    return path, dict(rows)


def test_upsert_touches_the_buckets_of_its_keys_only(spark, tmp_path):
    path, expected = keyed(spark, tmp_path, buckets=8, files=2)
    stored = tables._bucketed(tables.read_keyed(spark, path), ["k"], 8)
    one = [r.k for r in stored.where("bucket_of_8 = 5 and k is not null").orderBy("k").limit(10).collect()]
    before = files_below(path)
    updates = {k: "new" for k in one} | {k + 10_000: "added" for k in one}
    placed = tables._bucketed(spark.createDataFrame(list(updates.items()), SCHEMA), ["k"], 8)
    updates = {r.k: r.v for r in placed.where("bucket_of_8 = 5").collect()}
    written = tables.upsert_keyed(spark, path, spark.createDataFrame(list(updates.items()), SCHEMA), ["k"])
    after = files_below(path)
    assert written == [5]
    assert {f: t for f, t in before.items() if "bucket_of_8=5/" not in f} == {f: t for f, t in after.items() if "bucket_of_8=5/" not in f}
    assert not {f for f in before if "bucket_of_8=5/" in f} & set(after)
    expected |= updates
    assert {r.k: r.v for r in tables.read_keyed(spark, path).collect()} == expected
    assert tables.read_keyed(spark, path).count() == len(expected)


def test_null_key_all_buckets_and_no_updates(spark, tmp_path):
    path, expected = keyed(spark, tmp_path, n=50, buckets=4)
    assert tables.upsert_keyed(spark, path, spark.createDataFrame([], SCHEMA), ["k"]) == []
    updates = {None: "known", 7: "seven", **{k: "more" for k in range(100, 140)}}
    assert tables.upsert_keyed(spark, path, spark.createDataFrame(list(updates.items()), SCHEMA), ["k"]) == [0, 1, 2, 3]
    found = tables.read_keyed(spark, path).collect()
    assert {r.k: r.v for r in found} == expected | updates and len(found) == len(expected | updates)


def scanned_rows(df):
    """Rows that the file scans of a finished query returned."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


PROFILES = "user_id long, avg_rating double, avg_watch_year double, avg_release_year double, part long, movies array<long>"


def stored_profiles(spark, tmp_path, n):
    path = str(tmp_path / "profiles")
    rows = spark.range(n).selectExpr("id * 2 user_id", "0D avg_rating", "1D avg_watch_year", "2D avg_release_year", "0L part", "sequence(id, id + 20) movies")
    profile.write_lookup(rows.orderBy(F.rand(1)), path, parts=4, group_bytes=64 << 10)
    return path


def test_lookup_reads_few_row_groups(spark, tmp_path):
    path = stored_profiles(spark, tmp_path, 100_000)
    wanted = [2 * i for i in range(500, 600)] + [1, 777_777_777]
    found = profile.lookup_stored(spark, path, spark.createDataFrame([(w,) for w in wanted] + [(None,)], "user_id long"))
    assert sorted(r.user_id for r in found.collect()) == [w for w in wanted if w % 2 == 0]
    assert scanned_rows(found) < 20_000
    absent = profile.lookup_stored(spark, path, spark.createDataFrame([(1001,), (90_001,)], "user_id long"))
    assert scanned_rows(absent) == 0  # inside the range of ids, kept out by the bloom filters


def test_many_wanted_users_are_joined(spark, tmp_path):
    path = stored_profiles(spark, tmp_path, 2_000)
    wanted = spark.range(0, 4_000, 3).withColumnRenamed("id", "user_id")
    assert profile.lookup_stored(spark, path, wanted).count() == len(range(0, 4_000, 6))
    nobody = wanted.where("user_id < 0")
    assert profile.lookup_stored(spark, path, nobody).count() == 0
