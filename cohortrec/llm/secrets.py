"""Secret scan: exact base patterns, and hard-to-guess values in a credential context.

Base kinds are ``assign``, ``access`` and ``hex``. The method adds ``guess``: values behind a wider set of
credential words, whose cheapest segmentation into words, dates, repeats, keyboard walks and
brute-force characters takes at least ``10 ** HARD`` guesses. A placeholder such as
``changeme2024`` is cheap and stays. Words cost by their rank in a table that Spark counts over the documents themselves, at
most ``TABLE_WORDS`` of them, so prose is cheap in any language. Only where no table is given, values
of digits alone, or without a digit and both letter cases, are not costed. Base matches stay whatever they cost.
"""

import bisect
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.llm.guess_cost import COMMON, WORDS, WordTable, log10_guesses
from cohortrec.llm.tokens import byte_slices
from cohortrec.plans.materialize import materialize

HARD = 10.0
KINDS = ("assign", "access", "hex", "guess")
SPANS = "array<struct<kind: string, start: long, end: long, log10_guesses: double>>"
PLACEHOLDER = "[SECRET]"

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # greedy: whole runs
CONTEXT = re.compile(
    r"""(?<![a-z])(pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth(?:orization)?"""
    r"""|bearer|(?:private|access|signing|encryption)[_-]?key)["']?\x20*(?::|=>?)\x20*(?:(?:bearer|basic)\x20+)?["']?([^\s"'<>,;]{8,})""",
    re.ASCII | re.IGNORECASE,
)
JAVA_CONTEXT = "(?i)" + CONTEXT.pattern  # the same in both dialects
# What a text must hold for one of the patterns to match, for a fast look at whole batches.
HINT = r"(?i)AKIA[A-Z0-9]{16}|[0-9a-f]{24}|(?:pass|pwd|secret|token|key|credential|auth|bearer)[a-z]*[\"']? *[:=]"
JAVA_HINT = HINT

# Words of the table, bounded: it goes to the driver and to every task. Texts in many languages deserve more.
TABLE_WORDS = 20_000
LEVELS = 4  # of counts, per doubling


def hard_to_guess(value: str, table: WordTable | None = None) -> float | None:
    """The cost of a value if it reaches ``HARD``.

    Without a table only values with a digit or both letter cases and two kinds of characters are costed.
    """
    if table is None:
        kinds = (any(map(str.islower, value)), any(map(str.isupper, value)), any(map(str.isdigit, value)))
        if sum(kinds) + any(not c.isalnum() for c in value) < 2 or not (kinds[2] or kinds[0] and kinds[1]):
            return None
    cost = log10_guesses(value, table or COMMON)
    return cost if cost >= HARD else None


def word_table(docs: DataFrame, text_col: str = "text", limit: int = TABLE_WORDS) -> WordTable:
    """Words by the number of documents that hold them, behind the list of common passwords; at most ``limit``.

    Counts are cut into levels of a quarter of a doubling, and whole levels are taken from the highest on.

    Whole texts of all documents are counted, but for values in a credential context, so a secret that many copies
    repeat is no word. Words are runs of 3 to 20 letters in lower case, in two documents at least; ties go by alphabet.
    """
    text = F.col(text_col)
    prose = F.when(text.rlike(JAVA_HINT), F.regexp_replace(text, JAVA_CONTEXT, " ")).otherwise(text)
    words = F.array_distinct(F.regexp_extract_all(F.lower(prose), F.lit(r"(?<!\p{L})\p{L}{3,20}(?!\p{L})"), F.lit(0)))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    level = F.floor(F.log2("n") * LEVELS).cast("int")
    counts = materialize(counts.where("n > 1").withColumn("level", level), "words")
    # The driver sees a few counts of levels, then the words of the highest levels that fit into the limit.
    held, lowest = 0, None
    for row in counts.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        held += row["words"]
        if held > limit:
            break
        lowest = row["level"]
    chosen = [] if lowest is None else counts.where(F.col("level") >= lowest).select("word", "n").collect()
    chosen.sort(key=lambda r: (-r["n"], r["word"]))
    return WordTable([*WORDS, *(r["word"] for r in chosen)])


def find_spans(text: str, table: WordTable | None = None) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, log10_guesses)`` by start, then kind; ends exclusive, in code points.

    Base kinds hold whole matches, leftmost and without overlap within a kind. An added span is a
    whole value that no base span covers; it may overlap one that ends early. The cost is that of the value.
    """
    found = []
    words = table or COMMON
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            found.append(("assign", m.start(), m.end(), log10_guesses(m[2], words)))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= 20:
            found.append(("access", m.start(), m.end(), log10_guesses(m[0], words)))
    for m in HEX.finditer(text):
        found.append(("hex", m.start(), m.end(), log10_guesses(m[0], words)))
    base = sorted((start, end) for _, start, end, _ in found)
    starts = [start for start, _ in base]
    reach = list(itertools.accumulate((end for _, end in base), max))  # the furthest end of the spans so far
    for m in CONTEXT.finditer(text):
        value, start = m[2].rstrip(".:)]}"), m.start(2)
        end = start + len(value)
        before = bisect.bisect_right(starts, start)
        if len(value) >= 8 and not (before and reach[before - 1] >= end):
            if (cost := hard_to_guess(value, table)) is not None:
                found.append(("guess", start, end, cost))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _batch_spans(texts: pa.Array, table: WordTable | None = None) -> list[list[tuple[str, int, int, float]]]:
    hints = pc.fill_null(pc.match_substring_regex(texts, HINT), False)
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in range(len(texts))]
    for row in pc.indices_nonzero(hints).to_pylist():
        out[row] = find_spans(texts[row].as_py(), table)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)``, one row per input row; whole texts are searched.

    ``spans`` is an array of ``(kind, start, end, log10_guesses)``, empty for NULL and clean texts.
    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    fields = ["kind", "start", "end", "log10_guesses"]
    table = word_table(docs, text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), (fields[3], pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                spans = [[dict(zip(fields, s)) for s in each] for each in _batch_spans(rows["text"], table)]
                yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans {SPANS}")


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Each stretch of overlapping spans as one placeholder."""
    out, done = [], 0
    for _, start, end, _ in spans:
        if start >= done:
            out += [text[done:start], PLACEHOLDER]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with found secrets replaced by a placeholder.

    ``length_col`` names a column with the text's length, which follows the text of changed rows.
    Clean, empty and NULL texts stay as they are. Repeated rows are replaced alike, an empty table stays empty.
    """
    table = word_table(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, text_col):
                texts = rows[text_col]
                spans = _batch_spans(texts, table)
                changed = [i for i, each in enumerate(spans) if each]
                if changed:
                    new = texts.to_pylist()
                    for i in changed:
                        new[i] = redacted(new[i], spans[i])
                    at = rows.schema.get_field_index(text_col)
                    rows = rows.set_column(at, rows.schema.field(at), pa.array(new, texts.type))
                    if length_col is not None:
                        at = rows.schema.get_field_index(length_col)
                        lengths = rows[length_col].to_pylist()
                        for i in changed:
                            lengths[i] = len(new[i])
                        rows = rows.set_column(at, rows.schema.field(at), pa.array(lengths, rows[length_col].type))
                yield rows

    return docs.mapInArrow(run, docs.schema)
