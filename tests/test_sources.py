import datetime

import pytest

from cohortrec.sources import text


def write(path, content):
    path.write_text(content)
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ratings(spark, tmp_path):
    path = write(tmp_path / "ratings.csv", "0,7,11,3,2005-01-02\n1,7,12,5,2004-02-03\n")
    assert rows(text.read_ratings(spark, path)) == [
        (0, 7, 11, 3, datetime.date(2005, 1, 2)),
        (1, 7, 12, 5, datetime.date(2004, 2, 3)),
    ]


def test_bad_ratings_are_set_apart(spark, tmp_path):
    path = write(tmp_path / "ratings.csv", "key,movie,user,rating,date\n0,7,11,x,2005-01-02\n1,,12,5,2004-02-03\n")
    assert rows(text.read_ratings(spark, path)) == [(0, 7, 11, None, datetime.date(2005, 1, 2))]
    assert text.rejected_ratings(spark, path).count() == 2


def test_bad_tokens_are_left_out(spark):
    lines = spark.createDataFrame([("3\t7,x,8",), ("no tab",), ("y\t1",)], "value string")
    assert rows(text.parse_cluster_list(lines)) == [(3, 7), (3, 8)]
    members = spark.createDataFrame([(1, "5,z,6")], "cluster_id int, members string")
    assert rows(text.parse_member_list(members)) == [(1, 5), (1, 6)]
    pairs = spark.createDataFrame([("1,5",), ("1",), ("a,b",)], "value string")
    assert rows(text.parse_prediction_pairs(pairs)) == [(1, 5)]


def test_later_titles_win(spark, tmp_path):
    content = "".join(f"{i % 10},{1950 + i},T{i}\n" for i in range(300))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        found = rows(text.read_titles(spark, write(tmp_path / "titles.txt", content)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(i, 2240 + i, f"T{290 + i}") for i in range(10)]


def test_titles(spark, tmp_path):
    content = '7,NULL,Some Title\n8,1999,One, Two\n9,2001,"Quoted, ""Title"""\nno id,1990,x\n'
    assert rows(text.read_titles(spark, write(tmp_path / "titles.txt", content))) == [
        (7, None, "Some Title"),
        (8, 1999, "One, Two"),
        (9, 2001, 'Quoted, "Title"'),
    ]


def test_test_users(spark, tmp_path):
    content = '1,2004.0,1990.0,"5,6"\n2,2004.0,1990.0\n1,2005.0,1991.0,"7"\n3,2003.0,1980.0,9\n4,2003.0,1980.0,9,8\n'
    content += '"5",2000.0,"1999.0","1,2"\nx,2000.0,1999.0,1\n5#1,2000.0,1999.0,"3"\n'
    found = text.read_test_users(spark, write(tmp_path / "test_users.csv", content))
    assert rows(found) == [
        (1, 2005.0, 1991.0, 0, "7"),
        (3, 2003.0, 1980.0, 0, "9"),
        (5, 2000.0, 1999.0, 0, "1,2"),
        (5, 2000.0, 1999.0, 1, "3"),
    ]


def test_test_users_last_line_wins_across_splits(spark, tmp_path):
    lines = [f'{i % 10},{2000 + i}.0,1990.0,"{i}"' for i in range(400)]
    path = write(tmp_path / "many.csv", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        found = {r.user_id: r.movies for r in text.read_test_users(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {i: str(390 + i) for i in range(10)}


def test_seed_centroids(spark, tmp_path):
    path = write(tmp_path / "centroids.txt", "1.5,2\n\n3,4\n5,6\n")
    assert rows(text.read_seed_centroids(spark, path, 2)) == [(0, 1.5, 2.0), (1, 3.0, 4.0)]
    with pytest.raises(ValueError, match="4 seed centroids needed, 3 found"):
        text.read_seed_centroids(spark, path, 4)


def test_headered_files(spark, tmp_path):
    write(tmp_path / "mv_7.txt", "7:\n11,3,2005-01-02\n12,5,2004-02-03\n")
    write(tmp_path / "mv_8.txt", "8:\n11,1,2003-01-02\n9:\n\n13,2,2002-02-03\n")
    found = text.read_headered(spark, str(tmp_path))
    assert [r[:4] for r in rows(found)] == [(0, 7, 11, 3), (1, 7, 12, 5), (2, 8, 11, 1), (3, 9, 13, 2)]


def test_headered_file_larger_than_a_split(spark, tmp_path):
    lines, expected = [], []
    for movie, users in ((1, 3), (2, 900), (3, 0), (4, 250)):
        lines.append(f"{movie}:")
        for user in range(users):
            expected.append((len(expected), movie, user, 1 + user % 5, datetime.date(2005, 1, 1)))
            lines.append(f"{user},{1 + user % 5},2005-01-01")
    write(tmp_path / "merged.txt", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        source = text.read_headered(spark, str(tmp_path))
        assert text.read_lines(spark, str(tmp_path)).select("split").distinct().count() > 10
        assert rows(source) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cluster_and_member_lists(spark, tmp_path):
    path = write(tmp_path / "lists.txt", "0\t5,6,6\n3\t7,\n")
    assert rows(text.read_cluster_list(spark, path)) == [(0, 5), (0, 6), (0, 6), (3, 7)]
    members = spark.createDataFrame([(1, "5,6,")], "cluster_id int, members string")
    assert rows(text.parse_member_list(members)) == [(1, 5), (1, 6)]


def test_prediction_pairs(spark, tmp_path):
    assert rows(text.read_prediction_pairs(spark, write(tmp_path / "pairs.csv", "1,5\n2,6\n"))) == [(1, 5), (2, 6)]


def test_cells_of_any_length(spark):
    inner = 'say "x"\n, ' * 100_000
    line = '"' + inner.replace('"', '""') + '",plain," open'
    cells = sorted(r.cell for r in text.cells_to_rows(spark.createDataFrame([(line,)], "value string")).collect())
    assert cells == sorted([inner.strip(" "), "plain", '" open'])


def test_cells_and_first_field(spark):
    lines = spark.createDataFrame([('a, b ,,"c, d"',), ("e",), (" , ",)], "value string")
    assert rows(text.cells_to_rows(lines)) == [("a",), ("b",), ("c, d",), ("e",)]
    assert rows(text.first_field(lines)) == [(" ",), ("a",)]
