from datetime import datetime

import pytest
from tidemark.operators import increments as inc
from tidemark.operators.increments import Position
from tidemark.specs import SpecError, TableSpec

SPEC = TableSpec("t", incremental_column="updated_at", incremental_tiebreaker_column="id")
UNIQUE = TableSpec("t", incremental_column="id", incremental_column_is_unique=True)
T0, T1 = datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 1)
TEXT0 = "2026-01-01 00:00:00.000000"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, T0, "a"), (2, T0, "b"), (3, T0, "c"), (4, T1, "d")],
        "id int, updated_at timestamp, payload string",
    )


def ids(df):
    return [r["id"] for r in df.collect()]


def test_pages_cover_each_row_once(table):
    at, pages = None, []
    while True:
        page = inc.first_rows(table, SPEC, at, 2)
        got = ids(page)
        if not got:
            break
        pages.append(got)
        row = inc.high_watermark(page, SPEC).first()
        at = Position(row["watermark_value"], row["cursor_value"])
    assert pages == [[1, 2], [3, 4]]
    assert at == Position("2026-01-01 00:01:00.000000", "4")


def test_slices(table):
    assert ids(inc.in_order(inc.increment(table, SPEC), SPEC)) == [1, 2, 3, 4]
    assert ids(inc.increment(table, SPEC, Position(TEXT0))) == [4]
    assert ids(inc.increment(table, SPEC, Position(TEXT0, "2"))) == [3, 4]
    assert ids(inc.increment(table, SPEC, Position(TEXT0, "1"), Position(TEXT0, "3"))) == [2, 3]
    assert ids(inc.increment(table, UNIQUE, Position("2"))) == [3, 4]
    assert inc.after(table.schema, TableSpec("t"), Position("1")) is None


def test_paging_equals_range_on_mixed_keys(spark):
    import random

    rng = random.Random(5)
    rows = [(i, rng.randint(0, 5), rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, updated_at int, v double")
    for lo, hi in [((1, 50), (4, 120)), ((0, 199), (0, 199)), ((2, 0), (5, 300))]:
        got = ids(inc.increment(df, SPEC, Position(*map(str, lo)), Position(*map(str, hi))))
        assert sorted(got) == sorted(r[0] for r in rows if lo < (r[1], r[0]) <= hi)


@pytest.mark.parametrize(
    "dtype, values, text",
    [
        ("bigint", [100, 200, 300], "300"), ("int", [10, 30, 20], "30"),
        ("smallint", [1, 2], "2"), ("string", ["v1", "v3", "v2"], "v3"), ("bigint", [None], None),
        ("double", [0.5, 1.5], "1.5"), ("boolean", [True, False], "true"),
    ],
)
def test_position_text(spark, dtype, values, text):
    df = spark.createDataFrame([(v,) for v in values], f"w {dtype}")
    spec = TableSpec("t", incremental_column="w", incremental_column_is_unique=True)
    assert inc.high_watermark(df, spec).first()["watermark_value"] == text


def test_position_text_of_dates(spark):
    df = spark.sql("SELECT DATE'2026-02-10' AS d, TIMESTAMP_MICROS(1770681600000000) AS ts")
    by = lambda c: TableSpec("t", incremental_column=c, incremental_column_is_unique=True)
    assert inc.high_watermark(df, by("d")).first()[0] == "2026-02-10"
    assert inc.high_watermark(df, by("ts")).first()[0] == "2026-02-10 00:00:00.000000"


def test_null_keys(spark):
    df = spark.createDataFrame(
        [(1, T0), (None, T0), (3, None), (None, T1), (5, T1)], "id int, updated_at timestamp"
    )
    first = inc.frontier(df, SPEC, None)
    assert first.position == Position("2026-01-01 00:01:00.000000", "5")
    assert (first.rows, first.null_keys) == (2, 3)
    later = inc.frontier(df, SPEC, Position("2026-01-01 00:00:30.000000", "0"))
    assert (later.rows, later.null_keys) == (1, 2)
    assert tuple(inc.null_key_rows(df, SPEC).first()) == (1, 2, 3)
    with pytest.raises(inc.NullKeyError, match="3 row"):
        inc.guard_null_keys(SPEC, first.null_keys, "error")
    inc.guard_null_keys(SPEC, first.null_keys, "skip")
    for lo in (None, Position(TEXT0, "1")):
        a, b = inc.frontier(df, SPEC, lo), inc.frontier_by_aggregates(df, SPEC, lo)
        assert (a.position, a.null_keys) == (b.position, b.null_keys)


def test_frontier_of_nothing_new(table):
    end = Position("2026-01-01 00:01:00.000000", "4")
    assert inc.frontier(table, SPEC, end).position is None
    assert inc.frontier_by_aggregates(table, SPEC, end).position is None


def test_saved_position_checks(spark, table):
    with pytest.raises(SpecError, match="watermark but no cursor"):
        inc.check_position(SPEC, Position(TEXT0))
    inc.check_position(UNIQUE, Position("4"))
    inc.check_position(SPEC, None)
    assert inc.position_fits(table, SPEC, Position(TEXT0, "4"))
    assert not inc.position_fits(table, SPEC, Position(TEXT0, "four"))
    assert not inc.position_fits(table, SPEC, Position("4", "4"))
    assert not inc.position_fits(table.drop("id"), SPEC, Position(TEXT0, "4"))


def scan_of(df):
    """The scan of an executed plan and the rows it gave out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while "Scan" not in node.nodeName():
        node = node.children().head()
    return node.verboseStringWithOperatorId(), node.metrics().apply("numOutputRows").value()


def test_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.range(10).selectExpr(
        "id", "TIMESTAMP_NTZ'2026-01-01 00:00:00' AS updated_at", "'x' AS payload"
    ).write.parquet(path)
    df = inc.increment(spark.read.parquet(path), SPEC, Position(TEXT0, "3")).select("id")
    scan, _ = scan_of(df)
    assert "Or(GreaterThan(updated_at" in scan and "GreaterThan(id,3)" in scan
    assert "ReadSchema: struct<id:bigint,updated_at:timestamp_ntz>" in scan


def test_increment_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(0, 300_000, 1, 1).selectExpr("id", "TIMESTAMP_SECONDS(id) AS updated_at").write.option(
        "parquet.block.size", 64 * 1024
    ).parquet(path)
    at = Position("1970-01-04 10:00:00.000000", "295200")
    df = inc.increment(spark.read.parquet(path), SPEC, at)
    _, scanned = scan_of(df)
    assert df.count() == 4799 and scanned < 30_000
