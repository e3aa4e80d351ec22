"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep the columns
of ``documents``. Between stages the table is written as Parquet and read again.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortrec.llm import exact_dedup, packing, quality, secrets, simhash
from cohortrec.plans.materialize import materialize

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it is fitted on the labelled ones among ``docs``.

    NULL and empty texts are scored like any other; repeated rows get one verdict; an empty table stays empty.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, that of the smallest id, by the marks of all rows.

    NULL equals empty text. Of repeated rows and of rows without an id one stays too; an empty table stays empty.
    """
    return exact_dedup.keep_marked(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group one row, that of the smallest id.

    Texts without words are like each other. Of repeated rows and of rows without an id one stays too; an
    empty table stays empty.
    """
    return simhash.drop_near_copies(docs, shingle=4, max_bits=4, single=True)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a placeholder; NULL, empty and clean texts and repeated rows stay as they are."""
    return secrets.redact(docs, length_col="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it.

    NULL and empty texts are pieces of their end id. Repeated rows are packed each on its own; an empty table gives no pieces.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), CAPACITY)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("best-fit packing", pack_sequences),
]

# Fitted weights, XXH64 and token ids have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads the written table of the one before. An empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
