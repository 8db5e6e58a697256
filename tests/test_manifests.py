"""Table state by manifest: what a read looks at, and compaction of the worst buckets."""

import pytest

from tidemark.sinks import lake
from tidemark.sinks.lake import LakeTargets
from tidemark.sinks.ledger import Ledger


class Place:
    def __init__(self, spark, root):
        self.spark, self.ledger = spark, Ledger(spark, f"{root}/ledger")
        self.targets = LakeTargets(spark, f"{root}/lake", self.ledger, n_buckets=4)

    def rows(self, *rows):
        return self.spark.createDataFrame(list(rows), "id int, v string")

    def found(self, buckets=None):
        return sorted((tuple(r) for r in self.targets.read("t", buckets).collect()), key=repr)


@pytest.fixture
def place(spark, tmp_path):
    place = Place(spark, str(tmp_path))
    place.targets.create("t", place.rows((0, "")).schema, ("id",))
    return place


def test_a_read_takes_one_commit_and_lists_no_folder(place, monkeypatch):
    for i in range(6):
        place.targets.upsert("t", place.rows((i, f"v{i}"), (0, f"zero{i}")), ("id",))

    def refused(*_):
        raise AssertionError("a folder was listed or the commit list read")

    monkeypatch.setattr(lake, "child_names", refused)
    monkeypatch.setattr(Ledger, "commits", refused)
    assert place.found() == [(0, "zero5"), *((i, f"v{i}") for i in range(1, 6))]
    assert place.targets.exists("t") and place.targets.schema("t").names == ["id", "v"]


def test_the_manifest_counts_what_is_live(place):
    place.targets.upsert("t", place.rows(*((i, "a") for i in range(40))), ("id",))
    place.targets.upsert("t", place.rows((1, "b"), (None, "keyless")), ("id",))
    place.targets.insert("t", place.rows((None, "more"), (100, "c")))
    files = place.targets.files("t").collect()
    assert sum(r["n_rows"] for r in files) == 43 == len(place.found())
    assert {r["bucket"] for r in files} == {-1, 0, 1, 2, 3} and all(r["bytes"] > 0 for r in files)
    assert place.found([-1]) == [(None, "keyless"), (None, "more")]


def test_only_the_worst_buckets_are_rewritten(place):
    place.targets.upsert("t", place.rows(*((i, "a") for i in range(40))), ("id",))
    for i in range(4):
        place.targets.insert("t", place.rows((None, f"n{i}"), (1000, f"x{i}")))
    before = {r["path"]: r["bucket"] for r in place.targets.files("t").collect()}
    rows = place.found()
    worst = {b for b in before.values() if list(before.values()).count(b) > 2}
    assert place.targets.compact_worst("t", files_allowed=2) == len(worst) == 2
    after = {r["path"]: r["bucket"] for r in place.targets.files("t").collect()}
    assert place.found() == rows
    assert {p for p, b in before.items() if b not in worst} == {p for p in after if p in before}
    assert all(list(after.values()).count(b) == 1 for b in worst)
    assert place.targets.compact_worst("t", files_allowed=2) == 0
    assert place.targets.vacuum("t") == 4 and place.found() == rows


def test_tables_without_keys(place):
    place.targets.create("log", place.rows((0, "")).schema)
    for i in range(3):
        place.targets.insert("log", place.rows((i, "x")))
    assert place.targets.compact_worst("log", files_allowed=2) == 1
    assert sorted(r["id"] for r in place.targets.read("log").collect()) == [0, 1, 2]
    place.targets.replace("log", [])
    assert place.targets.read("log").count() == 0


def test_an_empty_batch_leaves_no_file(place):
    place.targets.insert("t", place.rows((1, "a")).where("false"))
    place.targets.upsert("t", place.rows((1, "a")).where("false"), ("id",))
    assert place.found() == [] and place.targets.files("t").count() == 0


def test_tables_from_before_manifests_are_read_and_go_on(place):
    place.targets.upsert("t", place.rows((1, "a"), (2, "b")), ("id",))
    place.targets.upsert("t", place.rows((2, "c"), (None, "n")), ("id",))
    rows = place.found()
    log = place.ledger.read("commits").drop("manifest").collect()
    place.ledger._start_epoch("commits", place.spark.createDataFrame([], place.ledger.read("commits").schema))
    for r in sorted(log, key=lambda r: r["seq"]):
        values = {k: v for k, v in r.asDict().items() if k != "seq"}
        if r["kind"] == "rewrite":
            values |= {"keys": None, "n_buckets": None, "schema_json": None}
        schema = place.ledger.read("commits").select(*values).schema
        frame = place.spark.createDataFrame([tuple(values.values())], schema)
        place.ledger.append("commits", frame)
    assert place.ledger.last_commit("t")["manifest"] is None
    assert place.found() == rows
    place.targets.upsert("t", place.rows((3, "d")), ("id",))
    assert place.found() == sorted([*rows, (3, "d")], key=repr)
    assert place.ledger.last_commit("t")["manifest"] is not None
