from datetime import datetime, timezone

import pytest

from tidemark.operators.increments import Position
from tidemark.sinks.ledger import Intent, Ledger


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "ledger"))


def names(df):
    return {r["table_name"] for r in df.collect()}


def test_progress(ledger):
    assert ledger.get_progress("users") is None
    ledger.set_progress("users", Position("2026-01-01"))
    ledger.set_progress("orders", Position("5", "7"))
    ledger.set_progress("users", Position("2026-02-01"))
    assert ledger.get_progress("users") == Position("2026-02-01", None)
    assert ledger.get_progress("orders") == Position("5", "7")
    again = Ledger(ledger.spark, ledger.root)
    assert again.get_progress("orders") == Position("5", "7")
    ledger.clear_progress("users")
    assert ledger.get_progress("users") is None
    ledger.clear_all_progress()
    assert ledger.progress().isEmpty()


def test_reset_by_reference(ledger):
    everyone = ("users", "analytics.users", "sales.users", "orders")
    for name in everyone:
        ledger.set_progress(name, Position("1"))
    assert ledger.clear_progress_by_ref("analytics.users") == 1
    assert ledger.clear_progress_by_ref("users") == 2
    assert ledger.clear_progress_by_ref("users") == 0
    assert names(ledger.progress()) == {"orders"}


def test_files(ledger):
    assert not ledger.is_file_ingested("users/a.parquet")
    ledger.mark_file("users/a.parquet", "users", 500)
    ledger.mark_file("users/a.parquet", "users", 750)
    assert ledger.is_file_ingested("users/a.parquet")
    assert [r["rows_ingested"] for r in ledger.files().collect()] == [750]
    ledger.set_progress("users", Position("1"))
    ledger.clear_all_progress()
    assert ledger.is_file_ingested("users/a.parquet")
    ledger.reset()
    assert not ledger.is_file_ingested("users/a.parquet")
    ledger.mark_file("users/b.parquet", "users", 1)
    assert ledger.is_file_ingested("users/b.parquet")


def test_files_of_an_open_commit_do_not_count(spark, ledger):
    rows = spark.createDataFrame(
        [("a", "t", 3, "c1"), ("b", "t", 4, "c2")],
        "file_key string, target_table string, rows_ingested bigint, commit_id string",
    )
    assert ledger.mark_files(rows) == {"files": 2, "rows": 7, "last": "b"}
    assert ledger.files().isEmpty()
    ledger.append_row("commits", table_name="t", commit_id="c2", kind="append", op="set")
    assert [r["file_key"] for r in ledger.files().collect()] == ["b"]


def test_intents(ledger):
    ts = datetime(2026, 2, 3, 4, 5, 6, tzinfo=timezone.utc)
    first = Intent("r1", ts, None, Position("5", "7"))
    assert ledger.pending_intent("t") is None
    ledger.start_intent("t", first)
    assert ledger.pending_intent("t") == first
    assert ledger.pending_intent("u") is None
    ledger.finish("t", first)
    assert ledger.pending_intent("t") is None
    assert ledger.get_progress("t") == Position("5", "7")
    full = Intent("r2", ts, None, None)
    ledger.start_intent("t", full)
    assert ledger.pending_intent("t") == full
    ledger.finish("t", full)
    assert ledger.pending_intent("t") is None
    assert ledger.get_progress("t") == Position("5", "7")
    ledger.start_intent("t", Intent("r3", ts, Position("5", "7"), Position("6", "8")))
    ledger.clear_progress("t")
    assert ledger.pending_intent("t") is None


def test_old_log_without_a_cursor_loads(spark, ledger):
    spark.sql("SELECT 'users' AS table_name, '9' AS watermark_value, 1L AS seq, 'set' AS op").write.parquet(
        f"{ledger.root}/progress/epoch=0/append-old"
    )
    assert ledger.get_progress("users") == Position("9", None)


def test_half_written_epoch_is_ignored(spark, ledger):
    ledger.set_progress("t", Position("1"))
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{ledger.root}/progress/epoch=1/000000000009-snapshot"
    )
    assert ledger.get_progress("t") == Position("1")


def test_compaction_keeps_what_counts(spark, ledger):
    ts = datetime(2026, 2, 3, tzinfo=timezone.utc)
    for i in range(3):
        ledger.set_progress("t", Position(str(i)))
    ledger.start_intent("u", Intent("r9", ts, None, Position("1")))
    ledger.start_run("r9", "u", ts)
    for i, kind in enumerate(("create", "append", "replace", "append")):
        ledger.append_row("commits", table_name="t", commit_id=f"c{i}", kind=kind, op="set")
    rows = [("a", "t", 1, "c1"), ("b", "t", 1, "zz")]
    ledger.mark_files(
        spark.createDataFrame(
            rows, "file_key string, target_table string, rows_ingested bigint, commit_id string"
        )
    )
    ledger.compact()
    assert ledger.get_progress("t") == Position("2")
    assert ledger.pending_intent("u").run_id == "r9"
    assert ledger.runs().count() == 1
    assert [r["commit_id"] for r in ledger.commits("t")] == ["c2", "c3"]
    assert [r["file_key"] for r in ledger.files().collect()] == ["a"]
    ledger.set_progress("t", Position("3"))
    assert ledger.get_progress("t") == Position("3")


def test_runs(ledger):
    ts = datetime(2026, 2, 3, tzinfo=timezone.utc)
    ledger.start_run("r1", "t", ts)
    assert ledger.runs().first()["status"] == "running"
    ledger.finish_run("r1", "t", ts, "failed", error="boom", severity="warning", metrics_json="{}")
    row = ledger.runs().first()
    assert (row["status"], row["error"], row["severity"]) == ("failed", "boom", "warning")
    assert row["duration_ms"] > 0 and row["finished_at"] is not None
