"""Mixing sources to target weights by Pareto order sampling.

1. Sources share the words of the whole table by weight; a target above ``cap`` times its source is cut
   there and the excess is shared again by weight, until no target is above.
2. Inside a source a document of sampling weight ``w`` is expected ``min(cap, rate * w)`` times, where ``rate`` makes
   the expected words meet the target. Whole copies are certain: the whole part of the expectation.
3. The fraction that is left is the document's inclusion probability ``p`` in a sample of fixed size. Documents are
   ranked by their random odds over their inclusion odds, ``u / (1 - u)`` over ``p / (1 - p)``, and taken in this order
   until the words left for the source are reached.
4. Only the document at the end of the sample does not fit. The gap it leaves is filled in the same order by
   documents that fit, round by round, until none fits or the gap is below ``tolerance`` of the target. One more
   document is taken where that leaves the source nearer to its target.

Random numbers are hashes of id and text, so neither partitioning nor a second run changes the mix. Running
sums over the ranking are taken over ranges at sampled bounds plus one total per range, so a source
with a third of all rows is spread over the cluster. The driver sees a few sums, never rows of a source.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.operators.lists import list_start
from cohortrec.plans.materialize import materialize

CAP = 3
SHARES = (5.0, 2.0, 1.0)
SEED = 42
TOLERANCE = 1e-4
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, shares: Sequence[float] = SHARES, cap: float = CAP) -> DataFrame:
    """``(source, words, share, target)`` from ``sizes(source, words)``, one row per source.

    Sources in code-point order, NULL last, take ``shares`` in turn. Targets sum to all words, as ``cap`` is at least 1.
    """
    if cap < 1 or not shares or min(shares) <= 0:
        raise ValueError("shares must be above 0 and the cap at least 1")
    ranked = list_start(sizes.withColumn("n", F.lit(1)), [], [F.asc_nulls_last("source")])
    share = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), (F.col("start") % len(shares) + 1).cast("int"))
    state = ranked.select("source", "words", share.alias("share"), F.lit(False).alias("full"))
    state = materialize(state, "shares")
    total = state.agg(F.sum("words")).first()[0] or 0
    full = 0
    while True:
        held = F.sum(F.when(F.col("full"), F.col("words")))
        open_share = F.sum(F.when(~F.col("full"), F.col("share")))
        taken, weight = state.agg(held, open_share).first()
        rest = float(total) - float(cap) * float(taken or 0)
        target = F.when(F.col("full"), F.lit(float(cap)) * F.col("words"))
        target = target.otherwise(F.lit(rest) * F.col("share") / F.lit(weight or 1.0))
        placed = state.withColumn("target", target)
        above = F.col("full") | (F.col("target") > F.lit(float(cap)) * F.col("words"))
        state = materialize(placed.select("source", "words", "share", above.alias("full"), "target"), "targets")
        now = state.where("full").count()
        if now == full:
            return state.select("source", "words", "share", "target")
        full, state = now, state.drop("target")


def expected_copies(docs: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Add ``copies``, the expected copies of each row of ``docs(source, size, weight, ...)``.

    The rate of a source follows from sums over its documents below the cap; documents that reach the cap
    leave them, and the rates are taken again until no further one does.
    """
    keyed = targets.withColumnsRenamed({"source": "_source", "words": "_words", "target": "_target"}).drop("share")
    classes = docs.groupBy("source", "weight").agg(F.sum("size").alias("words"))
    classes = materialize(classes.withColumn("full", F.lit(False)), "weights")
    full = 0
    while True:
        sums = classes.groupBy("source").agg(
            F.coalesce(F.sum(F.when(F.col("full"), F.col("words"))), F.lit(0)).alias("_held"),
            F.sum(F.when(~F.col("full"), F.col("words") * F.col("weight"))).alias("_open"),
        )
        sums = sums.withColumnRenamed("source", "_of")
        rates = sums.join(keyed, F.col("_of").eqNullSafe(F.col("_source"))).select(
            "_of", ((F.col("_target") - F.lit(float(cap)) * F.col("_held")) / F.nullif("_open", F.lit(0.0))).alias("_rate")
        )
        rates = materialize(rates, "rates")
        rated = classes.join(rates, F.col("source").eqNullSafe(F.col("_of")), "left")
        above = F.col("full") | F.coalesce(F.col("_rate") * F.col("weight") > F.lit(float(cap)), F.lit(False))
        classes = materialize(rated.select("source", "weight", "words", above.alias("full")), "weights")
        now = classes.where("full").count()
        if now == full:
            break
        full = now
    copies = F.when(F.col("_rate").isNull(), F.lit(float(cap))).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(float(cap)), F.col("_rate") * F.col("weight")))
    )
    return docs.join(rates, F.col("source").eqNullSafe(F.col("_of")), "left").withColumn("copies", copies).drop("_of", "_rate")


def _running(rows: DataFrame) -> DataFrame:
    """Words of the source that rank before each row."""
    order = ["rank", "doc_id", "row"]
    return list_start(rows.withColumn("n", F.col("size")), ["source"], order)


def order_sample(rows: DataFrame, quotas: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``row`` of the sampled documents, from ``rows(row, doc_id, source, size, rank)`` and ``quotas(source, quota, target)``.

    Of each source the documents of smallest rank are taken while their words stay within its quota; then
    documents of the rest that fit into the gap, in rounds, while it is above ``tolerance`` of the target. A last
    document may go beyond the quota where the source ends nearer to it.
    """
    pool, gaps = rows, quotas.select(F.col("source").alias("_source"), F.col("quota").alias("_gap"), F.col("target").alias("_target"))
    samples = rows.select("row", "source", "size").limit(0)
    while True:
        fits = (F.col("size") <= F.col("_gap")) & (F.col("_gap") > F.lit(tolerance) * F.col("_target"))
        open_rows = pool.join(gaps, F.col("source").eqNullSafe(F.col("_source"))).where(fits)
        placed = _running(open_rows.select("row", "doc_id", "source", "size", "rank", "_gap", "_target"))
        taken = F.col("start") + F.col("size") <= F.col("_gap")
        placed = materialize(placed.select("row", "doc_id", "source", "size", "rank", "_gap", "_target", taken.alias("_taken")), "ranking")
        chosen = placed.where("_taken").select("row", "source", "size")
        if chosen.isEmpty():
            break
        samples = samples.union(chosen)
        used = F.coalesce(F.sum(F.when(F.col("_taken"), F.col("size"))), F.lit(0))
        left = placed.groupBy("source").agg(F.first("_gap").alias("_before"), F.first("_target").alias("_target"), used.alias("_used"))
        gaps = materialize(left.select(F.col("source").alias("_source"), (F.col("_before") - F.col("_used")).alias("_gap"), "_target"), "gaps")
        pool = placed.where("not _taken").select("row", "doc_id", "source", "size", "rank")
    return samples.select("row").union(_nearest(rows, samples, quotas))


def _nearest(rows: DataFrame, samples: DataFrame, quotas: DataFrame) -> DataFrame:
    """Of each source the document outside of the sample that brings it nearest to its quota, if one brings it nearer."""
    used = samples.groupBy("source").agg(F.sum("size").alias("_used")).withColumnRenamed("source", "_of")
    gaps = quotas.join(used, F.col("source").eqNullSafe(F.col("_of")), "left").select(
        F.col("source").alias("_source"), (F.col("quota") - F.coalesce("_used", F.lit(0))).alias("_gap")
    )
    gaps = materialize(gaps, "gaps")  # of a known size, so that few sources are broadcast and rows stay where they are
    taken = samples.select(F.col("row").alias("_row"))
    rest = rows.join(gaps, F.col("source").eqNullSafe(F.col("_source"))).where("size < 2 * _gap")
    rest = rest.join(taken, F.col("row") == F.col("_row"), "left_anti")
    best = F.min(F.struct(F.abs(F.col("size") - F.col("_gap")).alias("off"), "rank", "doc_id", "row")).alias("best")
    return rest.groupBy("source").agg(best).select("best.row")


def mix_documents(
    docs: DataFrame,
    shares: Sequence[float] = SHARES,
    cap: float = CAP,
    seed: int = SEED,
    tolerance: float = TOLERANCE,
    weight_col: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per input row.

    ``size`` is the number of words of the text, ``taken`` the words the mix takes of it, a whole number of
    copies of at most ``cap``. ``weight_col`` is the relative number of copies of a document inside its source; without it, or
    where it is NULL or not above 0, the weight is 1. NULL and empty texts have size 0 and are taken 0 words. NULL is a
    source like any other. Repeated rows are documents of their own with equal rank: of equal rows it is open
    which ones are taken, but not how many. Rows without an id are ranked by their text. An empty table gives no
    rows; other columns are not read.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    weight = F.lit(1.0)
    if weight_col is not None:
        given = F.col(weight_col).cast("double")
        usable = (given > 0) & ~F.isnan(given) & (given < F.lit(float("inf")))
        weight = F.coalesce(F.when(usable, given), weight)
    draw = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), 11)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        size.alias("size"),
        weight.alias("weight"),
        ((draw + F.lit(0.5)) * F.lit(2.0**-53)).alias("u"),
    )
    rows = materialize(rows, "sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("words")), shares, cap)
    worded = rows.where("size > 0")
    copies = materialize(expected_copies(worded, targets, cap), "copies")
    odds = F.col("u") / (1 - F.col("u"))
    p = F.col("copies") - F.floor("copies")
    ranked = copies.withColumn("whole", F.floor("copies").cast("long")).withColumn("p", p)
    certain = ranked.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("_certain"))
    certain = certain.withColumnRenamed("source", "_of")
    quotas = targets.join(certain, F.col("source").eqNullSafe(F.col("_of"))).select(
        "source", (F.col("target") - F.col("_certain")).alias("quota"), "target"
    )
    quotas = materialize(quotas, "quotas")
    pool = ranked.where("p > 0").select(
        "row", "doc_id", "source", "size", (odds / (F.col("p") / (1 - F.col("p")))).alias("rank")
    )
    sampled = order_sample(materialize(pool, "ranks"), quotas, tolerance).select(F.col("row").alias("_sampled"))
    whole = ranked.select(F.col("row").alias("_row"), F.col("whole").alias("_whole"))
    named = targets.select(F.col("source").alias("_source"), F.col("words").alias("source_size"), "target")
    mixed = rows.join(whole, F.col("row") == F.col("_row"), "left").join(sampled, F.col("row") == F.col("_sampled"), "left")
    mixed = mixed.join(named, F.col("source").eqNullSafe(F.col("_source")))
    times = F.coalesce("_whole", F.lit(0)) + F.when(F.col("_sampled").isNotNull(), 1).otherwise(0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))
