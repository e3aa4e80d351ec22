"""A job that broke off goes on after its last whole stage."""

import glob
import os
import random

import pytest

from cohortrec.plans import jobs
from cohortrec.plans.restart import StageRecord
from test_sinks_and_jobs import file_lines


def inputs(tmp_path):
    rng = random.Random(4)
    ratings = [f"{i},{rng.randrange(30)},{rng.randrange(40)},{rng.randrange(1, 6)},{rng.randrange(1999, 2005)}-03-04" for i in range(300)]
    (tmp_path / "ratings.csv").write_text("\n".join(ratings) + "\n")
    (tmp_path / "titles.txt").write_text("".join(f"{m},{1950 + m},Title {m}\n" for m in range(30)))
    (tmp_path / "seeds.txt").write_text("1955,2000\n1965,2001\n1975,2002\n")
    return [str(tmp_path / name) for name in ("ratings.csv", "titles.txt", "seeds.txt")]


def stamps(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/part-*", recursive=True)}


def test_goes_on_after_clustering(spark, tmp_path, monkeypatch):
    paths = inputs(tmp_path)
    whole, out = str(tmp_path / "whole"), str(tmp_path / "out")
    jobs.run_files(spark, *paths, whole, k=3)

    def broken(*_):
        raise RuntimeError("driver gone")

    with monkeypatch.context() as m:
        m.setattr(jobs, "classify", broken)
        with pytest.raises(RuntimeError, match="driver gone"):
            jobs.run_files(spark, *paths, out, k=3)
    done = ("titles", "profiles", "centroids", "cluster_members", "cluster_movies", "test_users")
    before = {name: stamps(f"{out}/{name}") for name in done}
    assert all(before.values()) and not glob.glob(f"{out}/recommendations")
    with monkeypatch.context() as m:
        m.setattr(jobs, "build_profiles", broken)  # would run again only if the stage were not recorded
        jobs.run_files(spark, *paths, out, k=3, resume=True)
    assert {name: stamps(f"{out}/{name}") for name in done} == before
    for name in ("recommendations", "title_lists", "profile_text", "cluster_movie_list"):
        assert file_lines(f"{out}/{name}") == file_lines(f"{whole}/{name}") != []


def test_records_count_for_equal_settings_only(spark, tmp_path):
    ran = []
    out = str(tmp_path / "out")

    def run(names, settings, resume):
        record = StageRecord(spark, out, settings, resume)
        for name in names:
            record.stage(name, lambda name=name: ran.append(name))

    run("ab", {"k": 1}, resume=False)
    run("abc", {"k": 1}, resume=True)
    assert ran == ["a", "b", "c"]
    run("abc", {"k": 2}, resume=True)
    assert ran == ["a", "b", "c"] * 2
    run("ab", {"k": 2}, resume=False)
    assert ran == ["a", "b", "c"] * 2 + ["a", "b"]


def test_a_stage_that_runs_again_makes_all_later_ones_run_again(spark, tmp_path):
    ran = []
    record = StageRecord(spark, str(tmp_path), {}, False)
    for name in "abc":
        record.stage(name, lambda name=name: ran.append(name))
    os.remove(tmp_path / "_stages" / "b")
    record = StageRecord(spark, str(tmp_path), {}, True)
    for name in "abc":
        record.stage(name, lambda name=name: ran.append(name))
    assert "".join(ran) == "abcbc"
