"""The pipeline's stages against brute force on a small table, and odd input through all of them."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortrec.llm import quality
from cohortrec.llm.tokens import BatchEncoder
from compare import DATA
from test_secrets import brute as brute_spans
from test_simhash import brute_fingerprint, brute_groups

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = rows(documents)
    columns = documents.columns

    kept = stages["quality classifier"](spark, documents, SF_DIR)
    assert kept.columns == columns
    model = quality.train(documents, labels)
    good = {r.doc_id for r in quality.score_documents(documents, model).collect() if r.predicted}
    docs = [d for d in docs if d[0] in good]
    assert rows(kept) == docs and 0 < len(docs) < documents.count()

    kept = stages["exact dedup"](spark, spark.createDataFrame(docs, documents.schema), SF_DIR)
    first = {}
    for d in docs:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", d[1])
        first[key] = min(first.get(key, d[0]), d[0])
    docs = [d for d in docs if d[0] in set(first.values())]
    assert kept.columns == columns and rows(kept) == docs

    kept = stages["simhash near-dedup"](spark, spark.createDataFrame(docs, documents.schema), SF_DIR)
    groups = brute_groups([d[0] for d in docs], [brute_fingerprint(d[1]) for d in docs])
    docs = [d for d, g in zip(docs, groups) if d[0] == g]
    assert kept.columns == columns and rows(kept) == docs

    kept = stages["secret scan"](spark, spark.createDataFrame(docs, documents.schema), SF_DIR)
    after = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == columns and len(after) == len(docs)
    for d in docs:
        secret = brute_spans(d[1])
        assert (after[d[0]].text == d[1]) == (not secret)
        assert not brute_spans(after[d[0]].text)
        assert after[d[0]].n_chars == (len(after[d[0]].text) if secret else d[4])

    pieces = stages["best-fit packing"](spark, kept, SF_DIR).collect()
    encode = BatchEncoder(corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER)).whole.encode
    wanted = Counter()
    for r in after.values():
        ids = encode(r.text, add_special_tokens=False).ids + [1]
        for i in range(0, len(ids), 4096):
            part = ids[i : i + 4096]
            wanted[r.doc_id, i // 4096, i, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == wanted


def test_run(spark):
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    ends = {}
    for p in sorted(whole, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0)
        ends[p.sequence_id] = p.offset + p.length
    assert max(ends.values()) <= 4096 and sorted(ends) == list(range(len(ends)))


@pytest.mark.parametrize("case", ["odd", "empty"])
def test_odd_rows(spark, documents, case):
    odd = [(1, None, None, None, None), (None, "no id here at all", "en", "s", 17), (2, "", "en", "s", 0), (3, "a b c d " * 20_000, "en", "s", 160_000)]
    odd += [odd[3], (4, "token = 0123456789abcdef", None, None, None)]
    docs = spark.createDataFrame(odd if case == "odd" else [], documents.schema)
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF_DIR)
        out.collect()
    model = quality.fit_rules(np.empty((0, len(quality.FEATURES))), np.empty(0))
    assert quality.keep_good(docs, model).count() == docs.count()
    scored = quality.score_documents(docs, model).collect()
    assert all(0 <= r.score <= 1 and r.predicted == 1 for r in scored)
    assert [r.held_out for r in scored if r.doc_id is None] == [False] * (case == "odd")
