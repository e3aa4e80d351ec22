import os
from types import SimpleNamespace

import pytest

from cohortrec.plans import materialize as tables


def fake_session(master, setting=None, checkpoint_dir=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint_dir)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)


def test_configured_folder_wins():
    assert tables.shared_root(fake_session("yarn", "hdfs://a/b/")) == "hdfs://a/b"
    assert tables.shared_root(fake_session("yarn", None, "hdfs://c")) == "hdfs://c"


def test_cluster_without_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_root(fake_session("spark://host:7077"))


def test_local_session_keeps_one_folder():
    root = tables.shared_root(fake_session("local[2]"))
    assert os.path.isdir(root) and tables.shared_root(fake_session("local[4]")) == root


def test_written_table_is_read_back(spark):
    df = tables.materialize(spark.range(3).selectExpr("id", "array(id) as items"), "t")
    assert df.count() == 3
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_release(spark):
    df = tables.materialize(spark.range(3), "t")
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    tables.release_tables(spark)
    assert not os.path.exists(folder)


def test_scope_deletes_its_own_tables_only(spark):
    outer = tables.materialize(spark.range(3), "t")
    with tables.scoped_tables(spark):
        inner = tables.materialize(spark.range(4), "t")
        with tables.scoped_tables(spark):
            deepest = tables.materialize(spark.range(5), "t").inputFiles()[0].removeprefix("file://")
            assert os.path.exists(deepest)
        assert not os.path.exists(deepest)
        folders = [df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0] for df in (outer, inner)]
        assert all(map(os.path.isdir, folders))
    assert [os.path.isdir(f) for f in folders] == [True, False]
    assert outer.count() == 3
