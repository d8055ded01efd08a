"""The warehouse load: a new folder for each run, an audit trail, staging
counts from the files' footers, and no failed check on the test data."""

import tempfile

import pytest

from cardspark.plans import load
from cardspark.plans.load import audit_runs, build_warehouse

SF = "/root/testdata/sf0.001"


def test_two_runs_and_a_failed_one(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="wh-run-", dir="/tmp")
    first = build_warehouse(spark, SF, out)
    run = first["run"]
    assert first["staged_rows"]["users"] == 150 and first["staged_rows"]["transactions"] == 6000
    fact = spark.read.parquet(f"{run}/fact/FactTransaction")
    assert fact.count() == 6000 and "Year" in fact.columns
    report = {r["check_id"]: r["status"] for r in spark.read.parquet(f"{run}/verify").collect()}
    assert len(report) == 42
    assert "FAIL" not in report.values()
    # orphan cards / mcc in the test data land on the unknown members: warnings
    assert report["V18"] == "WARN" and report["V20"] == "WARN"
    assert spark.read.json(f"{run}/_manifest").count() == 4

    # a second load beside it, its keys after those of the first
    second = build_warehouse(spark, SF, out)
    assert second["run"] != run
    assert second["ctx"].extract_audit == first["ctx"].fact_audit + 1

    # a load that dies in the fact leaves no manifest, and the others whole
    def broken(*args, **kw):
        raise RuntimeError("no fact today")
    monkeypatch.setattr(load, "fact_transaction", broken)
    with pytest.raises(RuntimeError):
        build_warehouse(spark, SF, out)
    runs = audit_runs(spark, out).collect()
    assert [r["AuditKey"] for r in runs] == list(range(9, 0, -1))
    assert [r["ExecutionStatus"] for r in runs] == ["Failed"] + ["Success"] * 8
    assert all(r["ExecutionStartTime"] <= r["ExecutionEndTime"] for r in runs)
    dead = runs[0]["RunFolder"]
    with pytest.raises(Exception):
        spark.read.json(f"{dead}/_manifest").count()
    assert spark.read.parquet(f"{run}/fact/FactTransaction").count() == 6000
    # an existing folder is refused
    with pytest.raises(Exception):
        build_warehouse(spark, SF, out, first["ctx"])
