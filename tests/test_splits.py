"""Ranges of a column: every row in one of them, whatever the values."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql.readwriter import DataFrameReader

from tidemark.operators import splits
from tidemark.sources.tables import jdbc_range_source
from tidemark.specs import SpecError, TableSpec

WAYS = (splits.ranges_of_equal_width, splits.ranges_of_equal_depth)
T0 = datetime(2026, 1, 1)
VALUES = {
    "bigint": [*range(0, 3000, 3), -(1 << 62), 1 << 62],
    "int": [5] * 40,
    "date": [date(2020, 1, 1) + timedelta(days=i % 400) for i in range(900)],
    "timestamp_ntz": [T0 + timedelta(microseconds=i**3) for i in range(500)],
    "smallint": [],
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("kind", list(VALUES))
def test_every_row_is_in_one_range(spark, way, kind):
    values = VALUES[kind]
    df = spark.createDataFrame([(v,) for v in [*values, None, None]], f"v {kind}")
    found = way(df, "v", 8)
    counts = splits.rows_per_range(df, found).collect()
    assert sum(r["n_rows"] for r in counts) == len(values) + 2
    assert counts[-1]["n_rows"] == 2 and found[-1].nulls
    assert [r.upper for r in found[:-2]] == [r.lower for r in found[1:-1]]


def test_depths_are_even_and_a_hot_value_stands_alone(spark):
    hot = spark.range(60_000).selectExpr("if(id % 2 = 0, 777, id) as v")
    counts = splits.rows_per_range(hot, splits.ranges_of_equal_depth(hot, "v", 10)).collect()
    alone = [r for r in counts if r["lower_bound"] == "777"]
    assert [(r["upper_bound"], r["n_rows"]) for r in alone] == [("778", 30_000 + 1)]
    rest = [r["n_rows"] for r in counts if r["lower_bound"] != "777"]
    assert max(rest) < 60_000 / 10 * 1.1


def test_other_types_are_refused(spark):
    df = spark.createDataFrame([("a",)], "v string")
    for way in WAYS:
        with pytest.raises(SpecError, match="cannot be cut"):
            way(df, "v", 4)


def test_a_database_is_asked_by_ranges(spark, monkeypatch):
    asked = {}

    def jdbc(self, url, table, predicates, properties):
        asked.update(url=url, table=table, predicates=predicates, properties=properties)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    rows = spark.range(100).withColumnRenamed("id", 'o"id')
    source = jdbc_range_source(spark, "jdbc:x", lambda _: rows, {"public.orders": 'o"id'}, 4, {"user": "reader"})
    source(TableSpec("orders"))
    assert asked["url"] == "jdbc:x" and asked["table"] == '"public"."orders"'
    assert asked["predicates"] == [
        '"o""id" < 25', '"o""id" >= 25 AND "o""id" < 50', '"o""id" >= 50 AND "o""id" < 75', '"o""id" >= 75', '"o""id" IS NULL',
    ]
    assert asked["properties"]["user"] == "reader" and "dbtable" not in asked["properties"]
    days = spark.createDataFrame([(date(2020, 1, 1),), (date(2020, 1, 3),)], "d date")
    jdbc_range_source(spark, "jdbc:x", lambda _: days, {"public.orders": "d"}, 2)(TableSpec("orders"))
    assert asked["predicates"] == ["\"d\" < DATE '2020-01-02'", "\"d\" >= DATE '2020-01-02'", '"d" IS NULL']
