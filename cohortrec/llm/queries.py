"""The registered queries of this package: (spark, sf_dir) to the rows of each operator's contract."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrec.llm import (
    embeddings,
    exact_dedup,
    hard_negatives,
    html_template,
    packing,
    pareto_mix,
    periodic_runs,
    quality,
    secrets,
    sharding,
    simhash,
    suffix_pieces,
    token_files,
)
from cohortrec.llm.storage import new_path

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_files.read_token_files(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def secret_digest(scanned: DataFrame) -> DataFrame:
    """Counts and joined spans of ``secrets.scan``."""
    base = "filter(spans, s -> s.kind <> 'guess')"
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    counts = [f"cast(size(filter(spans, s -> s.kind = '{k}')) as long) AS n_{k}" for k in ("assign", "access", "hex")]
    return scanned.selectExpr(
        "doc_id", *counts, f"sha2({joined.format(base)}, 256) AS base_sha256", f"{joined.format('spans')} AS spans"
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op6_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = html_template.extract_articles(_table(spark, sf_dir, "pages"))
    return articles.withColumn("n_chars", F.length("text").cast("long"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(_table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the checksum of the text decoded from them."""
    model = public_tokenizers.path(PIECE_BPE)
    encoded = suffix_pieces.encode_documents(_table(spark, sf_dir, "documents"), model)
    return suffix_pieces.decode_documents(encoded, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(_table(spark, sf_dir, "documents"))
    return periodic_runs.summarise_runs(periodic_runs.find_runs(docs))


def op12_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inside a source a document of sixteen times the bytes is expected half as many copies."""
    docs = _table(spark, sf_dir, "documents")
    doublings = F.floor(F.log2(F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(1.0)))
    return pareto_mix.mix_documents(docs.withColumn("weight", F.pow(F.lit(2.0), -doublings / 4)), weight_col="weight")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_negatives(hard_negatives.with_shifted_labels(_table(spark, sf_dir, "embeddings")))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_embeddings": op5_embeddings,
    "op6_html_template": op6_html_template,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality": op9_quality,
    "op10_rendezvous_shards": op10_rendezvous_shards,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_pareto_mix": op12_pareto_mix,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op5_embeddings": """
        WITH RECURSIVE able AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE len(a.v) = len(b.v)
            AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98),
        reach AS (
          SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        named AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN named ON vec_id = named.a LEFT JOIN counted ON vec_id = counted.a
    """,
    "op7_exact_dedup": r"""
        WITH rows AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(content) AS text_sha256
        FROM rows WINDOW same AS (PARTITION BY content)
    """,
    "op13_hard_negatives": """
        WITH able AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                 CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
          FROM able a JOIN able b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
          SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        negatives AS (
          SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
                 CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank
          FROM positives JOIN scored USING (anchor_id)
          WHERE NOT same AND 100 * score BETWEEN 80 * positive_score AND 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
    """,
}
