"""Runs that are interrupted, resumed and changed."""

import pytest

from eventloom.plans import pipeline
from eventloom.plans.pipeline import Run, run_all
from eventloom.plans.versions import Versions
from eventloom.spec import LogSpec

SPEC = LogSpec(dynamic_categorical=("activity",), dynamic_numeric=("x",), rare_threshold=1)
ROWS = [(f"c{i % 6}", "abc"[i % 3], i, float(i % 5)) for i in range(30)]


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame(ROWS, "case_id string, activity string, seq long, x double").selectExpr("*", "timestamp_seconds(seq) AS ts").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def tables(run):
    return {s: (run.versions.manifest(s) or {}).get("tables") for s in pipeline.STAGES}


def test_a_killed_stage_leaves_the_earlier_tables(spark, raw, tmp_path, monkeypatch):
    out = str(tmp_path / "run")
    options = {"kind": "contextual", "initial": 0, "include_attributes": False}
    run = Run(spark, SPEC, out)
    first = sorted(map(tuple, run_all(spark, SPEC, out, raw, horizon=2, **options).collect()))
    before = tables(run)
    described = sorted(map(str, run.read("mdp/states_described").collect()))

    # the discovery of another model dies between two of its tables
    write = Versions.write

    def dying(self, df, table):
        if table == "mdp/states_described":
            raise RuntimeError("killed")
        return write(self, df, table)

    monkeypatch.setattr(Versions, "write", dying)
    with pytest.raises(RuntimeError, match="killed"):
        run_all(spark, SPEC, out, raw, horizon=2, resume=True, **options | {"kind": "none"})
    monkeypatch.setattr(Versions, "write", write)
    assert tables(run) == before
    assert sorted(map(str, Run(spark, SPEC, out).read("mdp/states_described").collect())) == described

    # the earlier options: everything is valid, nothing is written
    monkeypatch.setattr(Versions, "write", None)
    assert sorted(map(tuple, run_all(spark, SPEC, out, raw, horizon=2, resume=True, **options).collect())) == first
    monkeypatch.setattr(Versions, "write", write)
    assert tables(run) == before

    # the other model: the log is reused, the rest is made again
    run_all(spark, SPEC, out, raw, horizon=2, resume=True, **options | {"kind": "none"})
    after = tables(run)
    assert after["preprocess"] == before["preprocess"]
    assert all(after[s] != before[s] for s in ("discovery", "discretize", "encoding", "policy"))

    # a longer horizon concerns the policy only
    run_all(spark, SPEC, out, raw, horizon=3, resume=True, **options | {"kind": "none"})
    last = tables(run)
    assert {s for s in last if last[s] != after[s]} == {"policy"}

    # a table that lost its mark of success is not whole
    version = last["discretize"]["mdp/states_discretized"]
    success, files = run.versions._path(version, "_SUCCESS")
    files.delete(success, False)
    run_all(spark, SPEC, out, raw, horizon=3, resume=True, **options | {"kind": "none"})
    assert tables(run)["discretize"] != last["discretize"]

    # versions that no manifest names can be deleted
    kept = tables(run)
    assert len(run.versions.clear_old(pipeline.STAGES)) > 5
    assert run.versions.clear_old(pipeline.STAGES) == [] and tables(run) == kept
    assert run.read("policy").count() > 0
    with pytest.raises(ValueError, match="no stage has finished"):
        run.read("other")


def test_a_changed_input_is_noticed(spark, raw, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    before = versions.input_digest(raw)
    assert versions.input_digest(raw) == before
    assert versions.input_digest(raw.select("seq")) != before
    path = str(tmp_path / "raw2")
    raw.write.parquet(path)
    assert versions.input_digest(spark.read.parquet(path)) != before
