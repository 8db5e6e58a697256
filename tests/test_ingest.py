import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import DuplicateKeys
from tidemark.plans.ingest import Ingest
from tidemark.sinks.lake import LakeTargets
from tidemark.sinks.ledger import Ledger
from tidemark.sources import files
from tidemark.sources.tables import MissingTable
from tidemark.specs import IngestRoute, IngestSpec, Location, SpecError

USERS = IngestRoute("users/*", "users", ("id",), create_if_missing=True)


def write_file(spark, path, rows, schema):
    """One Parquet file of the given name."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(spark.createDataFrame(rows, schema).toArrow(), path)
    assert isinstance(pq.read_table(path), pa.Table)


def write_csv(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


class Place:
    def __init__(self, spark, root):
        self.spark, self.inbox = spark, root / "in"
        self.inbox.mkdir()
        self.ledger = Ledger(spark, str(root / "ledger"))
        self.targets = LakeTargets(spark, str(root / "lake"), self.ledger, n_buckets=3)

    def ingest(self, *routes, **kwargs):
        spec = IngestSpec(Location(path=str(self.inbox)), tables=routes or (USERS,), **kwargs)
        return Ingest(self.spark, spec, self.targets, self.ledger)

    def file(self, key, rows, schema="id int, name string"):
        write_file(self.spark, self.inbox / key, rows, schema)

    def rows(self, table="public.users"):
        return sorted((tuple(r) for r in self.targets.read(table).collect()), key=repr)


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_discovery(spark, tmp_path):
    for key in ("users/part-0.parquet", "users/part-1.parquet", "orders/data.parquet",
                "orders/data.csv", "orders/odd name+%.parquet", "orders/deep/x.parquet"):
        write_csv(tmp_path / key, "x")
    here = Location(path=str(tmp_path))
    keys = lambda p, **k: sorted(
        r["file_key"] for r in files.discover_files(spark, here, p, **k).collect()
    )
    assert keys("**/*.parquet") == [
        "orders/data.parquet", "orders/deep/x.parquet", "orders/odd name+%.parquet",
        "users/part-0.parquet", "users/part-1.parquet",
    ]
    assert keys("**/*.csv") == ["orders/data.csv"]
    assert keys("*/*.parquet") == [
        "orders/data.parquet", "orders/odd name+%.parquet", "users/part-0.parquet",
        "users/part-1.parquet",
    ]
    assert "orders/deep/x.parquet" in keys("*/*.parquet", limit_to_component=False)
    assert keys("users/part-[1-9].parquet") == ["users/part-1.parquet"]
    nowhere = Location(path=str(tmp_path / "none"))
    assert files.discover_files(spark, nowhere, "**/*").isEmpty()


def test_scans(spark, tmp_path, rows):
    write_file(spark, tmp_path / "t.parquet", [(1, "alice"), (2, "bob"), (3, "charlie")], "id int, name string")
    write_csv(tmp_path / "t.csv", "id,name\n1,alice\n2,bob\n3,charlie\n")
    want = [(1, "alice"), (2, "bob"), (3, "charlie")]
    for kind in ("parquet", "csv"):
        assert rows(files.read_files(spark, [str(tmp_path / f"t.{kind}")], kind)) == want
    with pytest.raises(SpecError):
        files.read_files(spark, ["x"], "orc")


def test_insert_once(place):
    place.file("users/part-0.parquet", [(1, "a")])
    place.file("users/part-1.parquet", [(2, "b"), (2, "b")])
    done = place.ingest().run()
    assert (done.files, done.rows, done.tables) == (2, 3, ("users",))
    assert place.rows() == [(1, "a"), (2, "b"), (2, "b")]
    assert place.ingest().run().files == 0
    place.file("users/part-2.parquet", [(3, "c")])
    assert place.ingest().plan().select("file_key").collect()[0][0] == "users/part-2.parquet"
    assert place.ingest().run().files == 1
    assert place.rows() == [(1, "a"), (2, "b"), (2, "b"), (3, "c")]
    by_key = {r["file_key"]: r["rows_ingested"] for r in place.ledger.files().collect()}
    assert by_key == {"users/part-0.parquet": 1, "users/part-1.parquet": 2, "users/part-2.parquet": 1}


def test_batches_of_files_cover_all(place):
    for i in range(5):
        place.file(f"users/p{i}.parquet", [(i, "x")])
    done = place.ingest(files_per_batch=2).run()
    assert (done.files, done.rows) == (5, 5) and [r[0] for r in place.rows()] == [0, 1, 2, 3, 4]


def test_upsert_follows_file_order_across_column_sets(place):
    place.file("users/aa odd+%41.parquet", [(1, "first"), (1, "a")], "id int, name string")
    place.file("users/a.parquet", [(1, "a", "a@x"), (2, "b", "b@x")], "id int, name string, email string")
    place.file("users/b.parquet", [(1, None), (3, "c")])
    place.file("users/c.parquet", [(1, "last", "z@x")], "id int, name string, email string")
    done = place.ingest(write_mode="upsert").run()
    assert (done.files, done.rows) == (4, 7)
    assert place.rows() == [(1, "last", "z@x"), (2, "b", "b@x"), (3, "c", None)]
    place.file("users/d.parquet", [(2, "B"), (2, "BB"), (None, "n")])
    place.ingest(write_mode="upsert").run()
    assert place.rows() == [(1, "last", "z@x"), (2, "BB", "b@x"), (3, "c", None), (None, "n", None)]


def test_upsert_can_refuse_duplicates(place):
    place.file("users/a.parquet", [(1, "a"), (1, "b")])
    with pytest.raises(DuplicateKeys):
        place.ingest(write_mode="upsert", on_duplicate="error").run()
    assert place.ledger.files().isEmpty() and place.rows() == []


def test_upsert_rewrites_touched_buckets_only(place):
    place.file("users/a.parquet", [(i, "old") for i in range(30)])
    place.ingest(write_mode="upsert").run()
    place.file("users/b.parquet", [(7, "new")])
    place.ingest(write_mode="upsert").run()
    last = place.ledger.commits("public.users")[-1]
    assert last["kind"] == "rewrite" and len(last["buckets"]) == 1
    got = dict(place.rows())
    assert len(got) == 30 and got[7] == "new" and set(got.values()) == {"old", "new"}


def test_rows_without_keys_pile_up_apart(place):
    for i, rows in enumerate([[(None, "a"), (1, "a")], [(None, "b")], [(1, "c"), (None, "c")]]):
        place.file(f"users/{i}.parquet", rows)
        place.ingest(write_mode="upsert").run()
    assert place.rows() == [(1, "c"), (None, "a"), (None, "b"), (None, "c")]
    assert [r[1] for r in place.targets.read("public.users", [-1]).orderBy("name").collect()] == ["a", "b", "c"]
    assert all(-1 not in c["buckets"] for c in place.ledger.commits("public.users"))


def test_upsert_needs_a_route_with_keys(place):
    place.file("other/a.parquet", [(1, "a")])
    with pytest.raises(SpecError, match="key columns"):
        place.ingest(write_mode="upsert").run()


def test_missing_target(place):
    place.file("other/a.parquet", [(1, "a")])
    with pytest.raises(MissingTable):
        place.ingest().run()
    assert place.ledger.files().isEmpty()


@pytest.mark.parametrize("truncate, want", [("once", [(1, "a"), (2, "b"), (3, "c")]), ("per_file", [(3, "c")])])
@pytest.mark.parametrize("size", [1, 10])
def test_truncate_insert(place, truncate, want, size):
    place.file("users/0.parquet", [(9, "gone")])
    place.ingest().run()
    for key, row in (("a", (1, "a")), ("b", (2, "b")), ("c", (3, "c"))):
        place.file(f"users/{key}.parquet", [row])
    done = place.ingest(write_mode="truncate_insert", truncate=truncate, files_per_batch=size).run()
    assert (done.files, done.rows) == (3, 3)
    assert place.rows() == want
    assert place.ingest(write_mode="truncate_insert").run().files == 0
    assert place.rows() == want


def test_empty_files_are_looked_at_again(place):
    place.file("users/a.parquet", [])
    assert place.ingest().run().files == 0
    assert place.ledger.files().isEmpty()
    assert place.ingest().plan().count() == 1
    place.file("users/b.parquet", [(1, "b")])
    assert place.ingest().run().rows == 1


def test_csv_files_with_different_headers(place):
    write_csv(place.inbox / "users/a.csv", "id,name\n1,alice\n2,\n")
    write_csv(place.inbox / "users/b.csv", "name,id\nbob,3\n")
    write_csv(place.inbox / "users/c.csv", "id\n4\n")
    done = place.ingest(file_format="csv").run()
    assert done.rows == 4
    assert place.rows() == [(1, "alice"), (2, None), (3, "bob"), (4, None)]


def test_empty_csv_files(place):
    write_csv(place.inbox / "users/a.csv", "")
    write_csv(place.inbox / "users/b.csv", "id,name\n")
    for mode in ("insert", "truncate_insert"):
        assert place.ingest(file_format="csv", write_mode=mode).run().files == 0
    assert not place.targets.exists("public.users")
    write_csv(place.inbox / "users/c.csv", "id,name\n1,a\n")
    assert place.ingest(file_format="csv", write_mode="truncate_insert").run().files == 1
    assert place.rows() == [(1, "a")]


def test_column_sets_by_task_and_by_reader(spark, place, monkeypatch):
    place.file("users/a.parquet", [(1, "a")])
    place.file("users/b.parquet", [(1, "a")])
    place.file("users/c.parquet", [(1,)], "id int")
    here = Location(path=str(place.inbox))
    found = files.discover_files(spark, here, "**/*.parquet")
    for schemes in (files.TASK_SCHEMES, ()):
        monkeypatch.setattr(files, "TASK_SCHEMES", schemes)
        marked = files.with_column_sets(spark, found, "parquet", here).orderBy("file_key").collect()
        groups = files.group_by_columns(spark, marked, "parquet")
        assert [[r["file_key"][-9] for r in g] for g in groups] == [["a", "b"], ["c"]]
    apart = files.group_by_columns(spark, [marked[0], marked[2], marked[1]], "parquet")
    assert [len(g) for g in apart] == [2, 1]


def test_workers_need_no_copy_of_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    for kind in ("parquet", "csv"):
        pickled = tmp_path / kind
        pickled.write_bytes(cloudpickle.dumps(files.column_prober(kind, Location(path="/x"))))
        code = (
            "import pickle, sys; from pyspark import cloudpickle; "
            f"f = pickle.loads(open({str(pickled)!r}, 'rb').read()); "
            "assert list(f(iter([]))) == [] and 'tidemark' not in sys.modules"
        )
        subprocess.run([sys.executable, "-I", "-c", code], cwd="/", check=True, timeout=60)


def test_csv_upsert_takes_the_last_line(place):
    lines = "".join(f"{i % 10},v{i}\n" for i in range(2000))
    write_csv(place.inbox / "users/a.csv", "id,name\n" + lines)
    place.spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        place.ingest(file_format="csv", write_mode="upsert").run()
        assert place.rows() == [(i, f"v{1990 + i}") for i in range(10)]
    finally:
        place.spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_values_take_the_target_type(place):
    place.file("users/a.parquet", [(1, "a")])
    place.ingest().run()
    place.file("users/b.parquet", [(2, [1, 2])], "id bigint, name array<int>")
    place.ingest().run()
    assert place.rows() == [(1, "a"), (2, "[1,2]")]
    place.file("users/c.parquet", [(3, "c", 1)], "id int, name string, extra int")
    with pytest.raises(ValueError, match="extra"):
        place.ingest().run()


def test_types_spark_has_no_equal_for(place):
    import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    ns = 1770681600123456789
    data = {
        "id": pa.array([2**64 - 1, 7], pa.uint64()),
        "plain": pa.array([ns, None], pa.timestamp("ns")),
        "zoned": pa.array([ns, -1], pa.timestamp("ns", "UTC")),
        "price": pa.array([1, 2]).cast(pa.decimal128(20, 0)),
        "small": pa.array([255, 1], pa.uint8()),
        "at": pa.array([datetime.time(1, 2, 3, 4), None], pa.time64("us")),
    }
    (place.inbox / "users").mkdir()
    pq.write_table(pa.table(data), place.inbox / "users/a.parquet")
    place.ingest(IngestRoute("users/*", "users", create_if_missing=True)).run()
    out = place.targets.read("public.users")
    assert dict(out.dtypes) == {
        "id": "bigint", "plain": "timestamp_ntz", "zoned": "timestamp", "price": "string",
        "small": "smallint", "at": "string",
    }
    when = datetime.datetime(2026, 2, 10, 0, 0, 0, 123456)
    got = {r["id"]: r for r in out.withColumn("zoned", F.col("zoned").cast("string")).collect()}
    assert (got[-1]["plain"], got[-1]["zoned"]) == (when, "2026-02-10 00:00:00.123456")
    assert (got[7]["plain"], got[7]["zoned"]) == (None, "1969-12-31 23:59:59.999999")
    assert (got[7]["price"], got[-1]["small"]) == ("2", 255)
    assert (got[-1]["at"], got[7]["at"]) == ("01:02:03.000004", None)


def test_a_crash_before_the_commit_loads_the_files_again(place, monkeypatch):
    place.file("users/a.parquet", [(1, "a")])

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(place.targets, "insert", fail)
        with pytest.raises(RuntimeError):
            place.ingest().run()
    assert place.ingest().run().rows == 1
    assert place.rows() == [(1, "a")]


def test_changed_files_on_request(place):
    import os

    place.file("users/a.parquet", [(1, "a")])
    place.ingest(track_changes=True, write_mode="upsert").run()
    place.file("users/a.parquet", [(1, "b")])
    os.utime(place.inbox / "users/a.parquet", (2_000_000_000, 2_000_000_000))
    assert place.ingest(write_mode="upsert").run().files == 0
    assert place.ingest(track_changes=True, write_mode="upsert").run().files == 1
    assert place.rows() == [(1, "b")]


def test_targets_without_keys(place, rows):
    schema = place.spark.createDataFrame([], "id int, name string").schema
    place.targets.create("t", schema)
    batch = place.spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    place.targets.insert("t", batch)
    place.targets.upsert("t", batch.where("id = 2").withColumn("name", F.lit("B")), ["id"])
    assert rows(place.targets.read("t")) == [(1, "a"), (2, "B")]
    with pytest.raises(MissingTable):
        place.targets.read("u")


def test_bucketed_read_by_bucket(place):
    place.file("users/a.parquet", [(i, "x") for i in range(20)])
    place.ingest().run()
    parts = [place.targets.read("public.users", [b]).count() for b in range(3)]
    assert sum(parts) == 20 and max(parts) < 20


def test_csv_by_the_standard(place):
    text = 'id,at,note\n1,2024-05-01 10:00:00,"a ""b"", c"\n2,2024-05-02 00:00:00,"x\ny"\n'
    write_csv(place.inbox / "users/a.csv", text)
    place.ingest(file_format="csv").run()
    assert place.targets.read("public.users").dtypes == [("id", "bigint"), ("at", "timestamp_ntz"), ("note", "string")]
    assert [(r[0], r[2]) for r in place.rows()] == [(1, 'a "b", c'), (2, "x\ny")]
    write_csv(place.inbox / "users/b.csv", "id,at,note\n3000000000,2024-05-01,z\n")
    place.ingest(file_format="csv").run()
    assert place.rows()[-1][0] == 3000000000


@pytest.mark.parametrize("line", ["3", "4,z,extra"])
def test_ragged_csv_lines_fail(place, line):
    write_csv(place.inbox / "users/a.csv", f"id,name\n1,a\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        place.ingest(file_format="csv").run()


@pytest.mark.parametrize("files_per_batch", [1, 10])
def test_csv_types_do_not_depend_on_batches(place, files_per_batch):
    write_csv(place.inbox / "users/a.csv", "id,name,empty\n1,10,\n")
    write_csv(place.inbox / "users/b.csv", "id,name,empty\n2,1.75,2024-01-01\n")
    place.ingest(file_format="csv", files_per_batch=files_per_batch).run()
    assert [k for _, k in place.targets.read("public.users").dtypes] == ["bigint", "double", "date"]
    assert [r[1] for r in place.rows()] == [10.0, 1.75]


def test_a_value_that_does_not_fit_the_target_fails(place):
    write_csv(place.inbox / "users/a.csv", "id,name\n1,10\n")
    place.ingest(file_format="csv").run()
    write_csv(place.inbox / "users/b.csv", "id,name\n1,1.75\n")
    with pytest.raises(Exception, match="1.75 does not fit bigint"):
        place.ingest(file_format="csv").run()
    assert place.rows() == [(1, 10)]


@pytest.mark.parametrize("key", ["users/_a.parquet", "_stage/b.parquet", ".x/y/c.parquet", "users/deep/.d.parquet"])
def test_hidden_files_are_named(place, key):
    place.file(key, [(1, "a")])
    with pytest.raises(files.HiddenFiles, match=key):
        place.ingest().run()


def test_what_writers_leave_is_no_hidden_file(place):
    place.file("users/a.parquet", [(1, "a")])
    place.file("users/_temporary/0/b.parquet", [(2, "b")])
    write_csv(place.inbox / "users/_SUCCESS", "")
    write_csv(place.inbox / "users/.other.parquet.crc", "")
    assert place.ingest().run().files == 1


def test_types_spark_has_no_equal_for_on_any_store(place, monkeypatch):
    monkeypatch.setattr(files, "TASK_SCHEMES", ())
    test_types_spark_has_no_equal_for(place)


@pytest.mark.parametrize("keys", [(), ("id",)])
def test_compacted_tables_have_one_folder(spark, place, keys):
    rows = [spark.createDataFrame([(i, f"v{i}")], "id int, name string") for i in range(5)]
    place.targets.create("public.users", rows[0].schema, keys)
    for frame in rows:
        place.targets.insert("public.users", frame)
    if keys:
        place.targets.upsert("public.users", rows[0].selectExpr("id", "'w' AS name"), keys)
    want = place.rows()
    place.targets.compact("public.users")
    assert place.targets.vacuum("public.users") >= 5
    assert place.rows() == want and len(want) == 5
    (commit,) = place.ledger.commits("public.users")
    assert len(commit["folders"]) == 1 and place.targets.vacuum("public.users") == 0
