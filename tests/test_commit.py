"""Loads that fail somewhere and are started again."""

from __future__ import annotations

import os

import pytest

from staylake.errors import LoadMismatch
from staylake.plans import load as L
from staylake.plans.load import load_parsed, run_load, tagged_rows
from staylake.plans.queries import _database
from staylake.sinks import commit as C
from staylake.sinks.table import table_history
from staylake.sources.json_lines import read_json_lines
from staylake.streaming.incremental import append_batch

LINES = [
    '{"id":"1","status":"F","start":"2024-01-05T00:00:00Z","booker":{"address":{"country":"japan"}}}',
    '{"id":"2","status":"O","start":"2024-01-09T00:00:00Z","booker":{"address":{"country":"japan"}}}',
    '{"id":"3","status":"F","start":"2024-02-05T00:00:00Z"}',
    '{"id":"4"}',
    '{"id":"5",',
    '{"id":"6","label":{}}',
]


@pytest.fixture()
def source(scratch):
    local = scratch.removeprefix("file:")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/a.jsonl", "w") as f:
        f.write("\n".join(LINES) + "\n")
    return scratch


def _fail_once(monkeypatch, owner, name, before=0):
    """The function raises at its next call but ``before``, once."""
    real, calls = getattr(owner, name), []

    def call(*a, **k):
        calls.append(1)
        if len(calls) == before + 1:
            raise RuntimeError("the driver is lost here")
        return real(*a, **k)

    monkeypatch.setattr(owner, name, call)


POINTS = [(L, "record_run", 0), (L, "forget", 0), (C, "commit", 0), (C._Files, "move", 0), (C._Files, "move", 2), (C, "stage", 0), (C, "ensure_side_table", 0)]


@pytest.mark.parametrize("owner,name,before", POINTS)
def test_a_failed_append_is_completed_once(spark, lookups, source, monkeypatch, owner, name, before):
    table = f"{_database(spark, 'crash')}.bookings"
    load = lambda run: append_batch(read_json_lines(spark, source), lookups, table, run)
    load("first")
    with monkeypatch.context() as m:
        _fail_once(m, owner, name, before)
        with pytest.raises(RuntimeError):
            load("second")
        load("second")
    load("second")
    assert spark.table(table).count() == 8 and spark.table(f"{table}_rejects").count() == 4
    hist = table_history(spark, table).collect()
    assert [(r["run_id"], r["rows_written"], r["rows_rejected"]) for r in hist] == [("first", 4, 2), ("second", 4, 2)]
    assert C._Files(spark, C.table_location(spark, table)).children(C.table_location(spark, table) + "/_staging") == []


@pytest.mark.parametrize("owner,name,before", [(L, "record_run", 0), (C._Files, "move", 1), (C._Files, "move_into", 0), (C._Files, "delete", 0)])
def test_a_failed_load_is_completed_once(spark, lookups, source, monkeypatch, owner, name, before):
    table = f"{_database(spark, 'crash')}.bookings"
    run_load(spark, source, lookups, table, "append", run_id="before")
    for mode, want in (("append", 8), ("overwrite", 4)):
        with monkeypatch.context() as m:
            _fail_once(m, owner, name, before)
            with pytest.raises(RuntimeError):
                run_load(spark, source, lookups, table, mode, run_id=mode)
            report = run_load(spark, source, lookups, table, mode, run_id=mode)
        assert (report.rows_read, report.rows_written, report.rows_rejected) == (6, 4, 2)
        assert spark.table(table).count() == want
        assert run_load(spark, source, lookups, table, mode, run_id=mode) == report
    assert sorted(r["transaction_id"] or "" for r in spark.table(table).collect()) == [""] * 4
    assert spark.table(f"{table}_rejects").count() == 6


def test_staged_rows_are_not_read_again(spark, lookups, source, monkeypatch):
    """What a run has staged is what it loads, whatever its source holds by then."""
    table = f"{_database(spark, 'crash')}.bookings"
    _fail_once(monkeypatch, L, "record_run")
    with pytest.raises(RuntimeError):
        run_load(spark, source, lookups, table, "append", run_id="r")
    with open(source.removeprefix("file:") + "/a.jsonl", "a") as f:
        f.write('{"id":"7"}\n')
    assert run_load(spark, source, lookups, table, "append", run_id="r").rows_read == 6
    assert spark.table(table).count() == 4


def test_an_overwrite_without_good_rows_empties_the_table(spark, lookups, source):
    table = f"{_database(spark, 'crash')}.bookings"
    run_load(spark, source, lookups, table, "overwrite")
    bad = read_json_lines(spark, source).where("id = '5' OR value LIKE '%\"6\"%' OR id IS NULL")
    load_parsed(bad, lookups, table, "overwrite", "none good")
    assert spark.table(table).count() == 0


def test_records_that_go_missing_stop_the_load(spark, lookups, source, monkeypatch):
    table = f"{_database(spark, 'crash')}.bookings"
    real = L.tagged_rows
    with monkeypatch.context() as m:
        m.setattr(L, "tagged_rows", lambda *a: real(*a).where("coalesce(status, '') <> 'pending'"))
        with pytest.raises(LoadMismatch):
            run_load(spark, source, lookups, table, "append", run_id="r")
    assert spark.table(table).count() == 0
    assert run_load(spark, source, lookups, table, "append", run_id="r").rows_written == 4


def test_one_scan_of_the_text(spark, lookups, source):
    plan = tagged_rows(read_json_lines(spark, source), lookups, "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("from_json(StructField") == 1
    assert "Python" not in plan
