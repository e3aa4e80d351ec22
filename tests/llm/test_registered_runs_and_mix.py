"""The registered queries of runs, mix and hard negatives over whole small tables, against the plain versions."""

import math

import __spark_entry__ as contract
from compare import DATA, compare, twin
from test_pareto_mix import plain_mix
from test_periodic_runs import plain_row

SF_DIR = f"{DATA}/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def test_runs(spark):
    found = {r.doc_id: tuple(r) for r in contract.queries()["op11_periodic_runs"](spark, SF_DIR).collect()}
    docs = documents(spark)
    assert set(found) == {d.doc_id for d in docs} and len(found) == len(docs)
    short = [d for d in docs if len((d.text or "").split()) <= 700]
    assert len(short) > 0.8 * len(docs)
    for d in short:
        assert found[d.doc_id] == plain_row(d.doc_id, d.text)
    assert any(found[d.doc_id][1] for d in short)


def test_mix(spark):
    found = contract.queries()["op12_pareto_mix"](spark, SF_DIR).collect()
    rows = []
    for d in documents(spark):
        doublings = math.floor(math.log2(len((d.text or "").encode()) + 1))
        rows.append((d.doc_id, d.text, d.source, 2.0 ** (-doublings / 4)))
    assert sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in found) == plain_mix(rows, (5.0, 2.0, 1.0))


def test_negatives(spark):
    con = twin(SF_DIR)
    try:
        found = contract.queries()["op13_hard_negatives"](spark, SF_DIR)
        assert compare(found, con, contract.oracle_sql()["op13_hard_negatives"]) == []
        assert found.count() > 0
    finally:
        con.close()
