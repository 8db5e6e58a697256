import pytest

from tests.test_ingest import write_csv, write_file
from tidemark.sinks.lake import LakeTargets
from tidemark.sinks.ledger import Ledger
from tidemark.sources.tables import MissingTable
from tidemark.specs import IngestSpec, Location, SpecError
from tidemark.streaming.file_ingest import start_ingest

SCHEMA = "id int, name string"


@pytest.fixture
def targets(spark, tmp_path):
    return LakeTargets(spark, str(tmp_path / "lake"), Ledger(spark, str(tmp_path / "ledger")), 2)


def run(spark, targets, tmp_path, checkpoint="checkpoint", **spec):
    plan = IngestSpec(Location(path=str(tmp_path / "in")), **spec)
    keys = ("id",) if plan.write_mode == "upsert" else ()
    query = start_ingest(spark, plan, targets, "users", str(tmp_path / checkpoint), keys)
    assert query.awaitTermination(120)
    if query.exception():
        raise query.exception()
    return query


def test_each_file_once(spark, targets, tmp_path, rows):
    targets.create("users", spark.createDataFrame([], SCHEMA).schema, ["id"])
    write_file(spark, tmp_path / "in/x/a.parquet", [(1, "a"), (2, "b"), (2, "c")], SCHEMA)
    run(spark, targets, tmp_path, write_mode="upsert")
    assert rows(targets.read("users")) == [(1, "a"), (2, "c")]
    commits = len(targets.ledger.commits("users"))
    run(spark, targets, tmp_path, write_mode="upsert")
    assert len(targets.ledger.commits("users")) == commits
    write_file(spark, tmp_path / "in/b.parquet", [(2, "z")], SCHEMA)
    run(spark, targets, tmp_path, write_mode="upsert")
    assert rows(targets.read("users")) == [(1, "a"), (2, "z")]


def test_folders_of_the_pattern_count(spark, targets, tmp_path, rows):
    targets.create("users", spark.createDataFrame([], SCHEMA).schema)
    write_file(spark, tmp_path / "in/users/a.parquet", [(1, "a")], SCHEMA)
    write_file(spark, tmp_path / "in/users/deep/a.parquet", [(2, "b")], SCHEMA)
    write_file(spark, tmp_path / "in/orders/a.parquet", [(3, "c")], SCHEMA)
    run(spark, targets, tmp_path, pattern="users/*.parquet")
    assert rows(targets.read("users")) == [(1, "a")]


def test_repeated_micro_batch_is_skipped(spark, targets, tmp_path, rows):
    targets.create("users", spark.createDataFrame([], SCHEMA).schema)
    write_csv(tmp_path / "in/a.csv", "id,name\n1,a\n")
    targets.ledger.append_row(
        "commits", table_name="users", commit_id=f"{tmp_path}/done#0", kind="append",
        folders=[], buckets=[], op="set",
    )
    run(spark, targets, tmp_path, "done", file_format="csv")
    assert rows(targets.read("users")) == []
    run(spark, targets, tmp_path, "fresh", file_format="csv")
    assert rows(targets.read("users")) == [(1, "a")]


def test_specs_a_stream_cannot_run(spark, targets, tmp_path):
    here = Location(path=str(tmp_path))
    with pytest.raises(SpecError, match="truncate"):
        start_ingest(spark, IngestSpec(here, write_mode="truncate_insert"), targets, "t", "c")
    with pytest.raises(SpecError, match="key columns"):
        start_ingest(spark, IngestSpec(here, write_mode="upsert"), targets, "t", "c")


def test_columns_that_a_file_lacks_keep_their_values(spark, targets, tmp_path, rows):
    schema = "id int, name string, mail string"
    targets.create("users", spark.createDataFrame([], schema).schema, ["id"])
    write_file(spark, tmp_path / "in/a.parquet", [(1, "a", "a@x")], schema)
    run(spark, targets, tmp_path, write_mode="upsert")
    write_file(spark, tmp_path / "in/b.parquet", [(1, "A")], SCHEMA)
    run(spark, targets, tmp_path, write_mode="upsert")
    assert rows(targets.read("users")) == [(1, "A", "a@x")]


def test_decimals_become_text_as_in_a_batch(spark, targets, tmp_path, rows):
    targets.create("users", spark.createDataFrame([], SCHEMA).schema)
    write_file(spark, tmp_path / "in/a.parquet", [(1, 2)], "id int, name int")
    spark.sql("SELECT 2 AS id, CAST(1.50 AS DECIMAL(9,2)) AS name").write.parquet(str(tmp_path / "in/b"))
    run(spark, targets, tmp_path)
    assert rows(targets.read("users")) == [(1, "2"), (2, "1.50")]


def test_a_stream_needs_its_target(spark, targets, tmp_path):
    with pytest.raises(MissingTable):
        start_ingest(spark, IngestSpec(Location(path=str(tmp_path))), targets, "none", "c")
