"""One row per group: repeated rows, rows without an id and ids with several texts, through both dedup operators."""

import itertools
import re

import corpus_pipeline
from cohortrec.llm import exact_dedup, simhash

SCHEMA = "doc_id long, text string, extra int, _row int"


def documents():
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (3, "a b", 0), (3, "a  b", 1), (3, "a b", 0), (5, "a b", 2),  # one text, one id three times
        (5, "other words", 3), (7, "other words", 4), (5, "other words", 3),
        (None, "alone", 5), (None, "alone", 6), (None, "a\tb", 7),
        (None, None, 8), (None, "", 9), (11, None, 10), (11, "", 11),
        (20, long, 12), (21, long + " x", 13), (21, long + " x", 14), (None, long + " y", 15), (22, "quite another text of it", 16),
    ]
    return [(*r, 1) for r in rows]


def winners(rows, groups):
    """The least row of each group by id (none last), text and columns."""
    best = {}
    for row, group in zip(rows, groups):
        key = (row[0] is None, row[0] or 0, row[1] is not None, row[1] or "", str(row))
        if group not in best or key < best[group][0]:
            best[group] = (key, row)
    return sorted((r for _, r in best.values()), key=str)


def test_exact(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = sorted(map(tuple, exact_dedup.drop_copies(docs, single=True).collect()), key=str)
    groups = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _, _ in rows]
    assert [r[:2] for r in kept] == [r[:2] for r in winners(rows, groups)]
    assert len(kept) == len(set(groups)) and set(kept) <= set(rows)
    assert sorted(map(tuple, exact_dedup.drop_copies(docs.repartition(2), single=True).collect()), key=str) == kept


def near_groups(rows):
    prints = []
    for _, text, _, _ in rows:
        hashes = simhash.shingle_hashes((text or "").encode())
        prints.append(int(simhash.majority(hashes, __import__("numpy").array([len(hashes)]))[0]))
    group = list(range(len(rows)))
    for _ in rows:
        for a, b in itertools.combinations(range(len(rows)), 2):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                group[a] = group[b] = min(group[a], group[b])
    return group


def test_near(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = sorted(map(tuple, simhash.drop_near_copies(docs, single=True).collect()), key=str)
    groups = near_groups(rows)
    assert [r[0] for r in kept] == [r[0] for r in winners(rows, groups)]
    assert len(kept) == len(set(groups)) and set(kept) <= set(rows)


def test_columns_of_other_names(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e")]
    docs = spark.createDataFrame(rows, "key long, body string")
    for found in (
        exact_dedup.drop_copies(docs, "key", "body", single=True),
        simhash.drop_near_copies(docs, id_col="key", text_col="body", single=True),
    ):
        assert [tuple(r) for r in found.collect()] == [(1, "a b c d e")]
    assert simhash.drop_near_copies(docs, id_col="key", text_col="body").count() == 2


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.drop_copies(docs, single=True).collect() == []
    assert simhash.drop_near_copies(docs, single=True).collect() == []


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_exact_shuffles_texts_once(spark):
    """The step took 2.04 x input of disk: two shuffles of the contents for the groups, one of the rows to find theirs."""
    docs = spark.createDataFrame(documents(), SCHEMA)
    found = plan(exact_dedup.drop_copies(docs, single=True))
    assert found.count("Exchange") == 1 and "Join" not in found
    assert found.index("1, Final") < found.index("Exchange") < found.index("1, Partial")  # one row a content leaves a task


def test_exact_with_odd_columns(spark):
    rows = [(2, "a\nb", {"k": 1}, 1, 5.0), (2, "a b", {"k": 1}, 1, 5.0), (2, "a\tb", {"k": 0}, 2, None), (9, "a  b", None, None, 1.0)]
    rows += [(2, "a\tb", {"k": 0}, 1, None)]
    docs = spark.createDataFrame(rows, "id long, body string, _content map<string, int>, _Hash int, _place double").repartition(3)
    for frame in (docs, docs.coalesce(1)):
        found = exact_dedup.drop_copies(frame, "id", "body", single=True)
        assert found.schema == docs.schema
        assert [tuple(r) for r in found.collect()] == [(2, "a\tb", {"k": 0}, 1, None)]
    alone = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x")], "doc_id long, text string")
    assert [tuple(r) for r in exact_dedup.drop_copies(alone, single=True).collect()] == [(1, "x")]


def test_exact_by_content_of_one_hash(spark, monkeypatch):
    """Rows of one hash stay apart while their contents differ."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda content: exact_dedup.F.length(content).cast("long"))
    docs = spark.createDataFrame([(1, "aa bb"), (2, "bb aa"), (3, "aa\nbb")], "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup.drop_copies(docs, single=True).collect())) == [(1, "aa bb"), (2, "bb aa")]


def test_near_leaves_texts_where_few_go(spark):
    """All ids were written to find the few that go, too many for a broadcast, so all texts were shuffled twice."""
    rows = [(i, " ".join(f"w{i * 50 + j}" for j in range(30)), 0, 1) for i in range(3000)]
    rows += [(4000 + i, rows[i][1], 0, 1) for i in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        found = simhash.drop_near_copies(docs, single=True)
        joins = [line for line in plan(found).splitlines() if "LeftAnti" in line]
        assert len(joins) == 1 and "BroadcastHashJoin" in joins[0]
        assert sorted(r.doc_id for r in found.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pipeline_keeps_exact_copies_by_marks(spark, monkeypatch):
    """The stage ranked rows by a hash of their content and made no digests, groups or marks."""
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made, mark_copies = [], exact_dedup.mark_copies

    def marks(*args, **kwargs):
        made.append(mark_copies(*args, **kwargs))
        return made[-1]

    monkeypatch.setattr(exact_dedup, "mark_copies", marks)
    stage = dict(corpus_pipeline.STAGES)["exact dedup"]
    kept = sorted(map(tuple, stage(spark, docs, "").collect()), key=str)
    groups = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _, _ in rows]
    assert len(made) == 1 and made[0].count() == len(rows)
    assert kept == sorted(map(tuple, exact_dedup.drop_copies(docs, single=True).collect()), key=str)
    assert [r[:2] for r in kept] == [r[:2] for r in winners(rows, groups)]
    assert stage(spark, docs.limit(0), "").collect() == []


def test_marked_rows_of_other_names_and_clashing_digests(spark, monkeypatch):
    rows = [(2, "a\nb", {"k": 1}, 1), (2, "a b", {"k": 1}, 1), (2, "a\tb", {"k": 0}, 2), (9, "a  b", None, None), (None, "a b", None, 3)]
    rows += [(2, "a\tb", {"k": 0}, 1), (2, "c", None, 5), (1, "c", None, 4), (None, "c", None, 4), (None, "d", None, 0), (None, "d", None, 0)]
    docs = spark.createDataFrame(rows, "id long, body string, _content map<string, int>, _id int").repartition(3)
    wanted = sorted([(2, "a\tb", {"k": 0}, 1), (1, "c", None, 4), (None, "d", None, 0)], key=str)
    for _ in range(2):
        found = exact_dedup.keep_marked(docs, "id", "body")
        assert found.schema == docs.schema
        assert sorted(map(tuple, found.collect()), key=str) == wanted
        mark_copies = exact_dedup.mark_copies
        weak = lambda *args: mark_copies(*args, digest=lambda content: exact_dedup.F.length(content).cast("string"))
        monkeypatch.setattr(exact_dedup, "mark_copies", weak)
