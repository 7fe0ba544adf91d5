"""The exposure report from per-file parts: only new and changed files are read."""

import json
import os

import pytest
from pyspark.sql import functions as F

from adlens import schemas
from adlens.operators import reports
from adlens.plans import jobs
from adlens.plans.incremental import IncrementalExposure
from adlens.sources import files, logs
from adlens.sources import testdata as td

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark):
    log = td.exposure_log(spark, SF).orderBy("event_id").drop("event_id")
    return [r[0] for r in log.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in log.columns]))).collect()]


def put(root, name, rows):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w") as f:
        f.write("\n".join(rows) + "\n")


def full(spark, root):
    log = jobs.with_ord(logs.read_all(spark, root, schemas.EXPOSURE_LOG))
    return reports.exposure_report_all(log, td.ssp_tag(spark, SF))


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_runs_read_only_new_files(spark, lines, tmp_path):
    root, tags = str(tmp_path / "logs"), td.ssp_tag(spark, SF)
    state = IncrementalExposure(str(tmp_path / "state"))
    put(root, "202401.log", lines[:100])
    put(root, "202402.log", lines[100:150])
    name = lambda read: sorted(os.path.basename(f) for f in read)
    assert name(state.update(spark, root)) == ["202401.log", "202402.log"]
    assert same(state.report(spark, tags), full(spark, root))
    assert state.update(spark, root) == []
    put(root, "202403.log", lines[150:])
    assert name(state.update(spark, root)) == ["202403.log"]
    assert same(state.report(spark, tags), full(spark, root))
    # a file that grew replaces its own rows, whichever run held them
    put(root, "202401.log", lines[:100] + lines[:30])
    assert name(state.update(spark, root)) == ["202401.log"]
    assert same(state.report(spark, tags), full(spark, root))
    # a file that is gone no longer counts
    os.remove(os.path.join(root, "202402.log"))
    assert state.update(spark, root) == []
    assert same(state.report(spark, tags), full(spark, root))


def test_unfinished_run_counts_nothing(spark, lines, tmp_path, monkeypatch):
    root, tags = str(tmp_path / "logs"), td.ssp_tag(spark, SF)
    state = IncrementalExposure(str(tmp_path / "state"))
    put(root, "a.log", lines[:80])
    state.update(spark, root)
    before = sorted(map(str, state.report(spark, tags).collect()))
    put(root, "b.log", lines[80:])
    put_file = files.put
    monkeypatch.setattr(files, "put", lambda *a: (_ for _ in ()).throw(OSError("died before the ledger")))
    with pytest.raises(OSError):
        state.update(spark, root)
    monkeypatch.setattr(files, "put", put_file)
    assert sorted(map(str, state.report(spark, tags).collect())) == before
    assert [os.path.basename(f) for f in state.update(spark, root)] == ["b.log"]
    assert same(state.report(spark, tags), full(spark, root))


def test_nothing_read_yet(spark, tmp_path):
    state = IncrementalExposure(str(tmp_path / "state"))
    assert state.report(spark, td.ssp_tag(spark, SF)).count() == 0
    put(str(tmp_path / "logs"), "a.log", [json.dumps({"dealid": "1", "local-month": "202401", "local-day": "05"})])
    state.update(spark, str(tmp_path / "logs"))
    row = state.report(spark, td.ssp_tag(spark, SF)).collect()[0]
    assert (row["dealid"], row["daytime"], row["total"], row["media_id"]) == ("1", "2024-01-05", 1, "000")
