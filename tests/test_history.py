from datetime import datetime

from tidemark.operators import history, quality


def day(n):
    return datetime(2026, 1, n)


RUNS = "run_id string, table_name string, started_at timestamp, finished_at timestamp, status string"


def make_runs(spark):
    return spark.createDataFrame(
        [
            ("r1", "a", day(1), day(2), "failed"), ("r2", "a", day(3), day(4), "Pending"),
            ("r3", "b", day(2), None, "running"), ("r4", "c", day(2), day(3), "FAILED"),
            ("r5", "d", day(2), day(5), "succeeded"),
        ],
        RUNS,
    )


def test_run_questions(spark):
    runs = make_runs(spark)
    assert tuple(history.run_summary(runs).first()) == (1, 1, 1, 4)
    order = [(r["table_name"], r["run_id"]) for r in history.run_status_list(runs).collect()]
    assert order == [("c", "r4"), ("a", "r2"), ("d", "r5"), ("b", "r3")]
    assert [r["run_id"] for r in history.recent_runs(runs, 2).collect()] == ["r2", "r5"]
    assert history.recent_runs(runs, 0).count() == 1
    assert history.recent_runs(runs).count() == 5
    assert {r["run_id"] for r in history.runs_by_status(runs, "Failed").collect()} == {"r1", "r4"}
    assert history.runs_by_status(runs, None).count() == 5
    assert history.last_finished(runs).first()[0] == day(5)
    assert history.last_finished(runs.limit(0)).first()[0] is None


def test_run_limit_has_a_ceiling(spark):
    runs = spark.range(1200).selectExpr("id AS run_id", "TIMESTAMP_SECONDS(id) AS started_at")
    assert history.recent_runs(runs, 5000).count() == 1000


def test_durations_round(spark):
    df = spark.sql(
        "SELECT TIMESTAMP'2026-01-01 00:00:00' AS started_at, "
        "EXPLODE(ARRAY(TIMESTAMP'2026-01-01 00:00:00.0014', TIMESTAMP'2026-01-01 00:00:00.0015', "
        "CAST(NULL AS TIMESTAMP))) AS finished_at"
    )
    assert [r["duration_ms"] for r in history.with_durations(df).collect()] == [1, 2, None]


def test_unseen_files(spark, rows):
    files = spark.createDataFrame([("a", day(1)), ("b", day(2))], "file_key string, modified_at timestamp")
    seen = spark.createDataFrame([("a", day(1)), ("b", day(1))], "file_key string, modified_at timestamp")
    assert rows(history.unseen_files(files, seen)) == []
    assert rows(history.unseen_files(files, seen, track_changes=True)) == [("b", day(2))]


def test_reset_by_ref_takes_names_as_they_are(spark):
    df = spark.createDataFrame([(n,) for n in ("a_b", "x.a_b", "aXb", "x.aXb")], "table_name string")
    cleared = {r["table_name"] for r in history.reset_by_ref(df, "a_b").where("cleared").collect()}
    assert cleared == {"a_b", "x.a_b"}


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", [1]), (2, None, [2]), (3, "a", None)], "n int, s string, l array<int>"
    )
    got = {r["column_name"]: tuple(r)[1:] for r in quality.profile(df, exact_distinct=["s"]).collect()}
    assert got["n"] == (3, 0, 3, "1", "3")
    assert got["s"] == (3, 1, 1, "a", "a")
    assert got["l"][:2] == (3, 1) and got["l"][3:] == (None, None)
    assert quality.profile(df, columns=["n"], distinct="none").first()["distinct_count"] is None


def test_approximate_distinct_is_close(spark):
    df = spark.range(20000).selectExpr("id % 5000 AS k")
    found = quality.profile(df).first()["distinct_count"]
    assert abs(found - 5000) <= 5000 * 0.15


def test_severity(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "n int")
    rules = {"known": ("n IS NOT NULL", "warning"), "positive": ("n > 0", "info")}
    row = quality.severity(df, rules).first()
    assert tuple(row) == (3, "warning", '{"rows":3,"known":1,"positive":2}')
    assert quality.severity(df.where("n = 1"), rules).first()["severity"] == "ok"
