"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on a bounded sample of labelled rows, every path from a root to a
node becomes a rule (a conjunction of comparisons), a logistic model with an L1 penalty weighs
rules and standardised statistics, and what keeps a weight is compiled into one Spark column
expression. Scoring is a single narrow pass without Python.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows for fitting are collected to the driver: the labelled rows with the smallest hashes of their
# id, at most so many. A dozen numbers each, so the fit is bounded whatever the table holds.
SAMPLE_ROWS = 20_000
TREES = 24
DEPTH = 3
BINS = 48
MIN_LEAF = 20
L1 = 0.002
KEEP_SCORE = 0.7


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a whole text by name; all are 0 for an empty text."""
    chars = F.length(text)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    pieces = F.split(F.lower(text), r"[\x20\x09-\x0D]+")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(line) > 0)
    return {
        "n_words": F.log1p(words.cast("double")),
        "word_length": _share(chars, words),
        "distinct_words": _share(F.size(F.array_distinct(pieces)), F.size(pieces)),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), F.size(lines)),
        "words_per_line": F.log1p(_share(words, F.size(lines))),
        "symbols": _share(F.regexp_count(text, F.lit(r"[#$%&*@^~+=<>{}\[\]\\_]")), chars),
        "bars": _share(F.regexp_count(text, F.lit(r"[|/]")), words),
        "exclamations": _share(F.regexp_count(text, F.lit(r"[!?]")), words),
        "stops": _share(F.regexp_count(text, F.lit(r"[.,;:]")), words),
        "digits": _share(F.regexp_count(text, F.lit("[0-9]")), chars),
        "capitals": _share(F.regexp_count(text, F.lit(r"\p{Lu}")), chars),
    }


FEATURES = (
    "n_words", "word_length", "distinct_words", "distinct_lines", "words_per_line", "symbols",
    "bars", "exclamations", "stops", "digits", "capitals",
)
Rule = tuple[tuple[int, bool, float], ...]  # (feature, above the threshold, threshold) each


def _grow(bins: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rules: set[Rule]) -> np.ndarray:
    """One regression tree on the gradients; adds its paths to ``rules``, returns its prediction."""
    out = np.zeros(len(grad))

    def split(rows: np.ndarray, path: Rule) -> None:
        if path:
            rules.add(tuple(sorted(path)))
        g, h = grad[rows], hess[rows]
        best = (1e-6, None)
        if len(path) < DEPTH and len(rows) >= 2 * MIN_LEAF:
            total = g.sum() ** 2 / (h.sum() + 1.0)
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                b = bins[rows, f]
                gs, hs, ns = (np.cumsum(np.bincount(b, w, len(cuts) + 1))[:-1] for w in (g, h, np.ones(len(b))))
                gain = gs**2 / (hs + 1.0) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1.0) - total
                gain[(ns < MIN_LEAF) | (len(rows) - ns < MIN_LEAF)] = 0.0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k))
        if best[1] is None:
            out[rows] = g.sum() / (h.sum() + 1.0)
            return
        f, k = best[1]
        above = bins[rows, f] > k
        split(rows[~above], (*path, (f, False, float(edges[f][k]))))
        split(rows[above], (*path, (f, True, float(edges[f][k]))))

    split(np.arange(len(grad)), ())
    return out


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of ``TREES`` boosted trees, sorted and without repeats."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    base = y.mean()
    margin, rules = np.full(len(y), np.log(base / (1 - base))), set()
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        margin = margin + 0.3 * _grow(bins, edges, y - p, p * (1 - p), rules)
    return sorted(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, f] > t) if above else (x[:, f] <= t) for f, above, t in rule])


def lasso_logistic(z: np.ndarray, y: np.ndarray, l1: float = L1, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic model, by accelerated proximal gradient steps."""
    design = np.column_stack([np.ones(len(z)), z])
    lipschitz = 0.25 * np.linalg.eigvalsh(design.T @ design / len(z))[-1]
    w = look = np.zeros(design.shape[1])
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ look, -500, 500)))
        step = look - design.T @ (p - y) / len(y) / lipschitz
        new = np.sign(step) * np.maximum(np.abs(step) - l1 / lipschitz, 0)
        new[0] = step[0]
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


@dataclass(frozen=True)
class RuleEnsemble:
    """Weights of rules and of clipped, scaled statistics. Compiles into a column expression."""

    intercept: float
    rules: tuple[tuple[float, Rule], ...] = ()
    linear: tuple[tuple[float, int, float, float, float], ...] = ()  # weight, feature, low, high, scale

    def margin(self, feature: Callable[[int], Column]) -> Column:
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            tests = [feature(f) > F.lit(t) if above else feature(f) <= F.lit(t) for f, above, t in rule]
            met = tests[0]
            for test in tests[1:]:
                met = met & test
            total = total + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        for weight, f, low, high, scale in self.linear:
            clipped = F.greatest(F.lit(low), F.least(F.lit(high), feature(f)))
            total = total + clipped * F.lit(weight / scale)
        return total

    def score(self, feature: Callable[[int], Column]) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(feature)))


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """With rows of one class only, or none, the score is constant: (ones + 1) / (rows + 1)."""
    ones = int(y.sum())
    if ones in (0, len(y)):
        share = min((ones + 1) / (len(y) + 1), 1 - 1e-9)
        return RuleEnsemble(float(np.log(share / (1 - share))))
    rules = tree_rules(x, y)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    spread = clipped.std(axis=0)
    used = np.flatnonzero(spread > 1e-12)
    scale = spread[used] / 0.4  # as much as a rule that holds for a fifth of the rows
    met = np.column_stack([holds(r, x) for r in rules]) if rules else np.empty((len(x), 0))
    design = np.column_stack([met.astype(float), clipped[:, used] / scale])
    intercept, w = lasso_logistic(design, y)
    return RuleEnsemble(
        intercept,
        tuple((float(v), r) for v, r in zip(w, rules) if v),
        tuple(
            (float(v), int(f), float(low[f]), float(high[f]), float(s))
            for v, f, s in zip(w[len(rules):], used, scale)
            if v
        ),
    )


def held_out(doc_id: Column) -> Column:
    """Rows that never train: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def with_statistics(docs: DataFrame, text: Column, keep: list[str], mark: str = "_f") -> DataFrame:
    """Columns ``keep`` and the statistics as ``<mark>0``, ``<mark>1``, ...

    The optimizer would move a filter on a score below this projection and repeat each statistic in
    every rule. It leaves a projection alone that holds an expression of the running task, so one is
    added as ``<mark>task``; a user of the statistics has to refer to it.
    """
    named = statistics(F.coalesce(text, F.lit("")))
    return docs.select(
        *keep,
        *[named[n].cast("double").alias(f"{mark}{i}") for i, n in enumerate(FEATURES)],
        F.spark_partition_id().alias(f"{mark}task"),
    )


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> RuleEnsemble:
    """Fit on at most ``sample_rows`` labelled rows that are not held out.

    Labels other than 0 and 1, NULL ids and labels of unknown documents are left out. The chosen
    labels are bounded by the parameter, hence the broadcast.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = (
        usable.select("doc_id", F.col("quality").cast("double").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
    )
    wanted = F.broadcast(chosen.withColumnRenamed("doc_id", "_labelled"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(wanted, F.col("doc_id") == F.col("_labelled"))
    sample = with_statistics(rows, F.col("text"), ["doc_id", "quality"])
    # A repeated document id must not lift the sample over its bound.
    table = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "_f0").limit(sample_rows).toArrow()
    x = np.column_stack([table[f"_f{i}"].to_numpy() for i in range(len(FEATURES))]).reshape(-1, len(FEATURES))
    return fit_rules(x, table["quality"].to_numpy())


def score_documents(
    docs: DataFrame, model: RuleEnsemble, threshold: float = KEEP_SCORE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Labels, language, source and id are no inputs of the score. NULL text counts as empty, empty
    text is scored by its zero statistics, a NULL id is not held out.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = with_statistics(rows, F.col("text"), ["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("_ftask") >= 0, model.score(lambda i: F.col(f"_f{i}"))).alias("score"),
    )
    return scored.select("*", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(
    docs: DataFrame, model: RuleEnsemble, threshold: float = KEEP_SCORE, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns.

    NULL text is scored as empty text. Repeated rows stay or go alike, a row needs no id, an empty table stays empty, and
    columns of any name pass through.
    """
    mark = "_f"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    computed = with_statistics(docs, F.col(text_col), docs.columns, mark)
    score = model.score(lambda i: F.col(f"{mark}{i}"))
    return computed.where((score >= threshold) & (F.col(f"{mark}task") >= 0)).select(*docs.columns)
