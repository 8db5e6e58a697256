"""Increments by zone map: which files are opened, and that no row is missed."""

from datetime import datetime, timedelta

import pytest

from tidemark.operators.increments import NullKeyError, Position, increment
from tidemark.plans.sync import Sync, SyncFailed
from tidemark.sinks import parquet
from tidemark.sinks.ledger import Ledger
from tidemark.sources.zoned import ZonedSource
from tidemark.specs import Location, SyncSpec, TableSpec

T0 = datetime(2026, 1, 1)
USERS = TableSpec("users", incremental_column="updated_at", incremental_tiebreaker_column="id")
SCHEMA = "id int, updated_at timestamp_ntz, payload string"


def stamp(day: int) -> str:
    return (T0 + timedelta(days=day)).strftime("%Y-%m-%d %H:%M:%S.000000")


class Place:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.ledger = Ledger(spark, f"{root}/ledger")
        self.source = ZonedSource(spark, f"{root}/in", self.ledger)

    def add(self, rows, mode="append"):
        """One more file of (id, day) rows."""
        frame = [(i, None if day is None else T0 + timedelta(days=day), "x") for i, day in rows]
        self.spark.createDataFrame(frame, SCHEMA).coalesce(1).write.mode(mode).parquet(f"{self.root}/in/users.parquet")

    def opened(self, lo=None, hi=None, spec=USERS):
        return len(self.source.between(spec, lo, hi).inputFiles())

    def sync(self, spec=USERS, **options):
        plan = SyncSpec(output=Location(path=f"{self.root}/out"), tables=(spec,), **options)
        return Sync(self.spark, plan, self.source, self.ledger).run()

    def ids(self, spec=USERS):
        return sorted(r["id"] for r in parquet.read_output(self.spark, f"{self.root}/out", spec).collect())


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, str(tmp_path))


def test_only_files_of_the_range_are_opened(place):
    for day in range(6):
        place.add([(10 * day + i, day) for i in range(3)])
    assert place.opened() == 6
    assert place.opened(lo=Position(stamp(3), "32")) == 2
    assert place.opened(lo=Position(stamp(3), "31")) == 3
    assert place.opened(hi=Position(stamp(1), "9")) == 1
    assert place.opened(Position(stamp(1), "12"), Position(stamp(3), "30")) == 2
    assert place.opened(lo=Position(stamp(9), "0")) == 0


def test_no_row_is_missed(place):
    for rows in ([(1, 0), (2, 5)], [(3, 3), (4, 3)], [(5, 3)], [(6, 7), (7, 1)]):
        place.add(rows)
    whole = place.source(USERS)
    for lo, hi in ((-1, 0), (0, 3), (3, 3), (3, 9), (5, 9), (7, 9)):
        ends = Position(stamp(lo), "3"), Position(stamp(hi), "4")
        want = {r["id"] for r in increment(whole, USERS, *ends).collect()}
        assert {r["id"] for r in increment(place.source.between(USERS, *ends), USERS, *ends).collect()} == want


def test_files_are_looked_into_once_and_again_when_they_change(place):
    place.add([(1, 1)])
    place.add([(2, 2)])
    assert place.source.refresh(USERS) == 2
    assert place.source.refresh(USERS) == 0
    place.add([(3, 3)])
    assert place.source.refresh(USERS) == 1
    place.add([(4, 4)], mode="overwrite")
    assert place.opened(lo=Position(stamp(3), "9")) == 1
    assert place.opened(lo=Position(stamp(4), "4")) == 0


def test_entries_belong_to_their_key_columns(place):
    place.add([(1, 1)])
    place.source.refresh(USERS)
    unique = TableSpec("users", incremental_column="id", incremental_column_is_unique=True)
    assert place.source.refresh(unique) == 1
    assert place.opened(lo=Position("0"), spec=unique) == 1
    assert place.opened(lo=Position("1"), spec=unique) == 0


def test_an_entry_of_another_type_opens_the_file(place):
    place.add([(1, 1)])
    place.source.refresh(USERS)
    entries = place.ledger.zones(USERS).collect()
    assert entries[0]["last_watermark"] == stamp(1)
    from tidemark.operators.zones import may_hold

    as_numbers = place.source(USERS).selectExpr("id", "cast(1 as bigint) as updated_at").schema
    said = place.ledger.zones(USERS).select(may_hold(as_numbers, USERS, Position("5", "1"), None).alias("yes"))
    assert [r["yes"] for r in said.collect()] == [True]


def test_null_keys_are_still_found_in_old_files(place):
    place.add([(1, 1), (2, None)])
    place.add([(3, 3)])
    assert place.opened(lo=Position(stamp(2), "0")) == 2
    with pytest.raises(SyncFailed) as failed:
        place.sync()
    assert isinstance(failed.value.failures[0][1], NullKeyError)
    place.sync(null_keys="skip")
    assert place.ids() == [1, 3]


def test_empty_files_are_not_opened_again(place):
    place.add([])
    place.add([(1, 1)])
    assert place.opened(lo=Position(stamp(0), "0")) == 1
    assert place.source.refresh(USERS) == 0


def test_runs_over_a_growing_table(place):
    place.add([(1, 0), (2, 1)])
    place.sync()
    assert place.sync()[0].rows == 0
    place.add([(3, 1), (4, 2)])
    place.add([(0, 0)])
    assert place.sync()[0].rows == 2
    assert place.ids() == [1, 2, 3, 4]


def test_partition_folders_keep_their_columns(place, spark):
    rows = [(1, T0, "a"), (2, T0 + timedelta(days=1), "b")]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("payload").parquet(f"{place.root}/in/users.parquet")
    found = place.source.between(USERS, Position(stamp(0), "5"))
    assert [(r["id"], r["payload"]) for r in found.collect()] == [(2, "b")]


def test_compacting_keeps_the_latest_versions(place):
    place.add([(1, 1)])
    place.source.refresh(USERS)
    place.ledger.compact()
    assert place.source.refresh(USERS) == 0 and place.ledger.zones(USERS).count() == 1
