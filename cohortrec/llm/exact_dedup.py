"""Exact dedup: local, then salted, then global combining of digest groups, on built-in functions only.

Three combining steps, each of which groups by digest **and** full normalised content:

1. inside every scan task (the map-side part of the first aggregation), so a task ships one row
   per content however many copies it read;
2. per (digest, content, salt), where the salt comes from the task: the rows of a content that
   holds a third of the table are spread over ``SALTS`` reducers;
3. per (digest, content) over at most ``SALTS`` salt winners.

Rows then find their group by digest alone, which is exact because it was checked before that no
digest has two contents; if one has, rows are matched on the content instead.

Where only one row of each group is wanted, ``keep_marked`` takes it by these marks: ids of one row
are decided by the id, so their texts are not shuffled again. ``drop_copies`` with ``single`` makes no
marks; it combines whole rows inside every task and then per content.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.plans.materialize import materialize

SALTS = 32
# Every run of white space that is not already a single space.
WHITE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ``[\\x20\\x09-\\x0D]`` as one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_hex) -> DataFrame:
    """``(digest, content, keep_id, group_size)``, one row per distinct normalised text."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("content"))
    salted = rows.withColumn("digest", digest(F.col("content"))).withColumn(
        "salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))
    )
    local = salted.groupBy("digest", "content", "salt").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return local.groupBy("digest", "content").agg(
        F.min("id").alias("keep_id"), F.sum("n").alias("group_size")
    )


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_hex) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    The row with the smallest id of a group stays. NULL text equals empty text. Repeated rows of
    one id are all marked alike, and rows without an id are kept only if their whole group has
    none. An empty table gives no rows; other columns are not read and may have any name.
    """
    groups = content_groups(docs, id_col, text_col, digest)
    winners = materialize(groups.select("digest", "keep_id", "group_size"), "winners")
    clashes = winners.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    if clashes.isEmpty():
        placed = rows.drop("content").join(winners, "digest")
        sha = F.col("digest") if digest is sha256_hex else F.lit(None).cast("string")
    else:
        placed = rows.join(groups, ["digest", "content"])
        sha = sha256_hex(F.col("content"))
    return placed.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        sha.alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", single: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row goes by its id and text together, so an id with two texts loses only the one that is a copy. NULL text equals
    empty text; an empty table gives no rows. Rows without an id all stay, and so do repeated rows of the id that stays; with
    ``single`` exactly one row of each group stays, the least by id, text and its other columns.
    """
    if single:
        return _one_of_each(docs, id_col, text_col)
    marks = mark_copies(docs, id_col, text_col)
    sha = sha256_hex(normalised(docs[text_col]))
    # Dropped ids are fewer than kept ones, so the optimizer may find them small enough to broadcast.
    dropped = marks.where("not kept and doc_id is not null")
    dropped = dropped.select(F.col("doc_id").alias("_dropped_id"), F.col("text_sha256").alias("_dropped_sha"))
    return docs.join(dropped, (docs[id_col] == dropped["_dropped_id"]) & (sha == dropped["_dropped_sha"]), "left_anti")


def keep_marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``drop_copies`` keeps with ``single``, chosen by the marks of ``mark_copies``.

    An id of one row is decided by the id. Rows of other ids, and those without one, are few as a rule: they are looked
    at by id and digest, and of those that are marked as kept one row of each group stays. NULL text equals empty
    text; an empty table gives no rows.
    """
    marks = materialize(mark_copies(docs, id_col, text_col).select("doc_id", "kept", "text_sha256"), "marks")
    ids = marks.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
    ids = ids.agg(F.count("*").alias("rows"), F.min("kept").alias("kept"))
    # Ids of one row that stays are most by far and not written, so that the joins see how few the others are.
    ids = materialize(ids.where("rows > 1 or not kept").select("_id", "rows"), "ids")
    several = materialize(ids.where("rows > 1").select("_id"), "several")
    whole = docs.where(F.col(id_col).isNotNull())
    other = ids.select("_id")
    decided = whole.join(other, whole[id_col] == other["_id"], "left_anti")
    open_rows = whole.join(several, whole[id_col] == several["_id"], "left_semi").unionByName(docs.where(F.col(id_col).isNull()))

    kept = marks.where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    of_several = kept.join(several, kept["_kept_id"] == several["_id"], "left_semi")
    kept = materialize(of_several.union(kept.where("_kept_id is null")).distinct(), "kept")
    sha = sha256_hex(normalised(open_rows[text_col]))
    stay = open_rows.join(kept, open_rows[id_col].eqNullSafe(kept["_kept_id"]) & (sha == kept["_kept_sha"]), "left_semi")
    return decided.unionByName(drop_copies(stay, id_col, text_col, single=True))


def one_row(rows: DataFrame, group: str, text_col: str, columns: list[str]) -> DataFrame:
    """``columns`` of one row per ``group``: the least by text, then by all columns as JSON; combined before the shuffle."""
    order = F.struct(F.col(text_col), F.to_json(F.struct(*columns)))
    chosen = rows.groupBy(group).agg(F.min_by(F.struct(*columns), order).alias("_row"))
    return chosen.select(*[F.col("_row")[c].alias(c) for c in columns])


def _one_of_each(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of each group; the texts are shuffled once, and of each content a task sends one row only.

    The hash only makes sorting and shuffling cheap, groups are rows of equal content.
    """
    new = ["_hash", "_content", "_others", "_place"]
    while set(new) & {c.lower() for c in docs.columns}:
        new = [name + "_" for name in new]
    key, content, rest, place = new
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.withColumn(content, normalised(F.col(text_col))).withColumn(key, F.xxhash64(content))
    rows = rows.withColumn(rest, F.to_json(F.struct(*others)) if others else F.lit(""))
    # A rank that is asked for its first row alone is cut to it in every task before the shuffle.
    order = Window.partitionBy(key, content).orderBy(F.asc_nulls_last(id_col), text_col, rest)
    return rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(*new)
