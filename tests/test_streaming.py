"""availableNow pickup: each invocation processes only newly landed days."""

import os
import uuid

import pytest

from conftest import envelope, land
from dailylake.operators.snapshots import Snapshots
from dailylake.plans import pipeline as PL
from dailylake.streaming import process_new_files


def test_new_files_only(spark, tmp_root):
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    for d in ["2024-03-01", "2024-03-02"]:
        for loc in ["a", "b"]:
            land(paths.bronze, d, loc, envelope(d, loc, ingested_at=f"{d}T06:00:00+00:00"))
    name = f"pickup-{uuid.uuid4().hex[:8]}"
    first = process_new_files(spark, paths, name=name)
    assert first == [("2024-03-01", "2024-03-02")]
    assert PL.table(spark, paths, PL.STG_DAILY).count() == 4
    assert process_new_files(spark, paths, name=name) == []  # nothing new
    land(paths.bronze, "2024-03-03", "a", envelope("2024-03-03", "a", ingested_at="2024-03-03T06:00:00+00:00"))
    assert process_new_files(spark, paths, name=name) == [("2024-03-03", "2024-03-03")]
    assert PL.table(spark, paths, PL.STG_DAILY).count() == 5


def test_only_touched_days_and_no_poison(spark, tmp_root):
    """Days between the touched ones stay as they are; a failing batch holds nothing up."""
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))

    def put(d, **kw):
        land(paths.bronze, d, "a", envelope(d, "a", ingested_at=f"{d}T06:00:00+00:00", **kw))

    name = f"pickup-{uuid.uuid4().hex[:8]}"
    put("2024-03-02")
    process_new_files(spark, paths, name=name)
    folder = lambda: Snapshots(spark, paths.staging).record()["tables"][PL.STG_DAILY]["folders"]["dt=2024-03-02"]
    between = folder()
    put("2024-03-01")
    put("2024-03-10")
    assert process_new_files(spark, paths, name=name) == [("2024-03-01", "2024-03-10")]
    assert folder() == between
    logged = sorted(str(r["dt"]) for r in spark.read.parquet(paths.runs).collect())
    assert logged == ["2024-03-01", "2024-03-02", "2024-03-10"]
    put("2024-03-11", temp_avg="75")
    assert process_new_files(spark, paths, name=name) == []
    put("2024-03-12")
    assert process_new_files(spark, paths, name=name) == [("2024-03-12", "2024-03-12")]
    assert {str(r["dt"]) for r in PL.table(spark, paths, PL.STG_DAILY).select("dt").collect()} == {"2024-03-01", "2024-03-02", "2024-03-10", "2024-03-12"}
    failed = spark.read.parquet(paths.runs).where("status = 'failed'").collect()
    assert [str(r["dt"]) for r in failed] == ["2024-03-11"] and "range" in failed[0]["error_summary"]


def test_passing_faults_are_replayed_and_bad_days_are_not(spark, tmp_root, monkeypatch):
    """A malformed file fails its day alone; an error of the cluster fails the batch, which comes again."""
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    name = f"pickup-{uuid.uuid4().hex[:8]}"
    for d in ("2024-03-01", "2024-03-02"):
        land(paths.bronze, d, "a", envelope(d, "a", ingested_at=f"{d}T06:00:00+00:00"))
    land(paths.bronze, "2024-03-03", "a", '{"metadata": {"dt"')
    with monkeypatch.context() as m:
        m.setattr(PL, "load_staging", lambda *a, **k: (_ for _ in ()).throw(OSError("no route to storage")))
        with pytest.raises(Exception, match="no route to storage"):
            process_new_files(spark, paths, name=name)
    assert PL.table(spark, paths, PL.STG_DAILY) is None
    assert process_new_files(spark, paths, name=name) == [("2024-03-01", "2024-03-03")]
    assert sorted(str(r["dt"]) for r in PL.table(spark, paths, PL.STG_DAILY).collect()) == ["2024-03-01", "2024-03-02"]
    last = {str(r["dt"]): r["error_summary"] for r in spark.read.parquet(paths.runs).orderBy("started_at").collect()}
    assert last["2024-03-01"] is None and last["2024-03-03"].startswith("malformed_bronze: 1 record(s)")
