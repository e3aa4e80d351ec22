import datetime

from pyspark.sql import functions as F

from cohortrec.sources import tables

DAY = datetime.date


def test_latest_rows(spark):
    rows = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, 1, "only")], "k int, version int, payload string")
    assert sorted(map(tuple, tables.latest_rows(rows, ["k"], ["version"]).collect())) == [(1, 9, "new"), (2, 1, "only")]


def test_upsert_replaces_and_adds(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, tables.upsert(table, updates, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_wide_rows_round_trip_in_parts(spark):
    data = [(1, m, m % 5, DAY(2005, 1, 1)) for m in range(10)]
    data += [(1, 3, 5, DAY(2006, 1, 1)), (2, 7, 1, DAY(2004, 1, 1))]
    ratings = spark.createDataFrame(data, "user_id long, movie_id long, rating int, watch_date date")
    wide = tables.wide_rows(ratings, part_size=4)
    assert dict(wide.dtypes)["values"] == "map<string,string>"
    assert wide.where("user_id = 1").count() == 3
    cells = {(r.user_id, r.movie_id): r.rating for r in tables.wide_cells(wide).collect()}
    assert cells == {**{(1, m): m % 5 for m in range(10)}, (1, 3): 5, (2, 7): 1}


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    tables.replace_table(spark.range(2), path)
    assert tables.read_table(spark, path, ["id"]).count() == 2


def test_views(spark):
    profiles = spark.sql(
        """select 1L user_id, 1990D avg_release_year, 2004D avg_watch_year, 1D avg_rating, 3 membership,
                  array(5L, 6L) movies"""
    )
    tables.register_views(profiles, profiles.drop("avg_rating"))
    row = spark.sql("select p.movies, k.membership from profiles p join knn_assignments k using (membership)").first()
    assert tuple(row) == ("5,6", 3)


def test_pruned_scan_reads_two_columns(spark):
    scan = tables.read_table(spark, "/root/testdata/sf0.001/lineitem.parquet", ["l_partkey", "l_quantity"])
    plan = scan.where(F.col("l_quantity") > 10)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan
