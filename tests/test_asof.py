"""As-of joins against a plain search, and headered text in few and in very many files."""

import bisect

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortrec.operators.asof import asof_join, mark_intervals
from cohortrec.sources import text


def plain_asof(rows, marks):
    found = []
    for key, at in rows:
        mine = sorted(m for m in marks if m[0] == key)
        place = bisect.bisect_right([m[1] for m in mine], at) - 1
        if place >= 0:
            found.append((key, at, mine[place][2]))
    return sorted(found, key=str)


KEYS = st.sampled_from(["a", "b", None])
ROWS = st.lists(st.tuples(KEYS, st.integers(-20, 60)), min_size=1, max_size=40)
MARKS = st.lists(st.tuples(KEYS, st.integers(-20, 60)), min_size=1, max_size=12, unique=True)


@settings(max_examples=12, deadline=None)
@given(ROWS, MARKS, st.sampled_from([1, 7, 4096]), st.booleans())
def test_equals_a_plain_search(spark, rows, marks, bucket, hashed):
    marks = [(*m, i) for i, m in enumerate(marks)]
    left = spark.createDataFrame(rows, "key string, at long")
    right = spark.createDataFrame(marks, "key string, at long, mark int")
    intervals = mark_intervals(right, ["key"], "at", left.groupBy("key").agg(F.max("at").alias("last")), "last")
    found = asof_join(left, intervals, ["key"], "at", bucket, hashed)
    assert found.columns == ["key", "at", "mark"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_asof(rows, marks)


def lines_of(spark, texts, split):
    rows = [(name, i // split, i, line) for name, lines in texts.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "file string, split long, seq long, value string")


def plain_ingest(texts):
    found, key = [], 0
    for name in sorted(texts):
        movie = None
        for line in texts[name]:
            if ":" in line:
                movie = int(line.rstrip(":"))
            elif line:
                found.append((key, movie, *map(int, line.split(",")[:2])))
                key += 1
    return [f for f in found if f[1] is not None]


@pytest.mark.parametrize("split", [1, 3, 1000])
def test_headers_blank_lines_and_lines_without_a_header(spark, split):
    day = "2004-01-02"
    texts = {
        "a": ["", f"1,1,{day}", "5:", "6:", f"2,2,{day}", "", "", f"3,3,{day}", "7:"],
        "b": [f"4,4,{day}", "8:", *[f"{i},1,{day}" for i in range(20)], ""],
        "c": ["9:"],
        "d": ["", ""],
        "e": [f"5,5,{day}"],
    }
    found = text.parse_headered(lines_of(spark, texts, split).repartition(3))
    assert sorted(tuple(r)[:4] for r in found.collect()) == plain_ingest(texts)


def test_many_files(spark):
    """100,000 files of a header and two lines each, and one file of all of them."""
    n = 100_000
    rows = spark.range(3 * n).select(
        F.expr("id div 3").alias("movie"),
        F.expr("id % 3").alias("nth"),
        F.expr("CASE WHEN id % 3 = 0 THEN concat(id div 3, ':') ELSE concat(id, ',3,2004-01-02') END").alias("value"),
        "id",
    )
    apart = rows.select(F.format_string("%06d", "movie").alias("file"), F.lit(0).alias("split"), F.col("nth").alias("seq"), "value")
    merged = rows.select(F.lit("all").alias("file"), F.expr("id div 1000").alias("split"), F.col("id").alias("seq"), "value")
    for lines in (apart, merged):
        found = text.parse_headered(lines)
        wrong = found.where("user_id <> movie_id * 3 + rating_key % 2 + 1 or rating_key div 2 <> movie_id")
        assert found.count() == 2 * n and wrong.isEmpty()


def test_lines_with_gaps_are_refused(spark):
    lines = spark.createDataFrame([("a", 0, 0, "1:"), ("a", 0, 2, "5,3,2004-01-02")], "file string, split long, seq long, value string")
    with pytest.raises(ValueError, match="without gaps"):
        text.parse_headered(lines)


def test_text_is_not_sorted_or_shuffled_for_few_headers(spark, tmp_path):
    (tmp_path / "m.txt").write_text("1:\n" + "".join(f"{u},3,2004-01-02\n" for u in range(500)))
    plan = text.read_headered(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "Sort" not in plan and "hashpartitioning" not in plan


def test_counted_ratings(spark, tmp_path):
    good = [f"{i},{i % 3},{i % 5},4,2004-01-02" for i in range(50)]
    (tmp_path / "r.csv").write_text("\n".join([*good, "x,y,z", "7,,1,2,2004-01-02", "8,1,2,five,2004-01-02", "9,1,2,3,never"]) + "\n")
    path = str(tmp_path / "r.csv")
    rows, counts = text.read_counted_ratings(spark, path)
    kept = rows.collect()
    assert sorted(kept, key=str) == sorted(text.read_ratings(spark, path).collect(), key=str)
    assert counts.get == {"lines": 54, "kept": 52, "rejected": text.rejected_ratings(spark, path).count(), "damaged": 3}
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
