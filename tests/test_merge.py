import random

import pytest

from tidemark.operators import merge
from tidemark.operators.merge import DuplicateKeys
from tidemark.specs import SpecError

USER = "id int, name string, email string"


def test_upsert_updates_and_inserts(spark, rows):
    target = spark.createDataFrame([(1, "a", "a@x"), (2, "b", "b@x")], USER)
    batch = spark.createDataFrame([(2, "B", None), (3, "c", "c@x")], USER)
    assert rows(merge.upsert(target, batch, ["id"])) == [(1, "a", "a@x"), (2, "B", None), (3, "c", "c@x")]


def test_upsert_of_some_columns_keeps_the_others(spark, rows):
    target = spark.createDataFrame([(1, "a", "a@x"), (2, "b", "b@x")], USER)
    batch = spark.createDataFrame([(2, None), (3, "c")], "id int, name string")
    out = merge.upsert(target, batch, ["id"])
    assert out.columns == ["id", "name", "email"]
    assert rows(out) == [(1, "a", "a@x"), (2, None, "b@x"), (3, "c", None)]


def test_composite_key_and_last_wins(spark, rows):
    schema = "order_id int, item_id int, quantity int"
    target = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], schema)
    batch = spark.createDataFrame(
        [(1, 2, 7, "b", 0), (1, 2, 8, "a", 9), (2, 1, 1, "a", 0)], schema + ", f string, r int"
    )
    out = merge.upsert(target, batch, ["order_id", "item_id"], ["f", "r"])
    assert rows(out) == [(1, 1, 5), (1, 2, 7), (2, 1, 1)]
    with pytest.raises(DuplicateKeys):
        merge.upsert(target, batch, ["order_id", "item_id"], ["f", "r"], on_duplicate="error")


def test_keys_only_do_nothing(spark, rows):
    target = spark.createDataFrame([(1, "kept")], "id int, note string")
    batch = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert rows(merge.upsert(target, batch, ["id"])) == [(1, "kept"), (2, None)]


@pytest.mark.parametrize("columns", ["id int, v int", "id int, v int, w int", "id int"])
def test_null_keys_never_conflict(spark, rows, columns):
    n = len(columns.split(","))
    target = spark.createDataFrame([(None, 1, 1), (1, 1, 1)], "id int, v int, w int")
    batch = spark.createDataFrame([(None, 2, 2)[:n], (None, 2, 2)[:n], (1, 2, 2)[:n]], columns)
    out = merge.upsert(target, batch, ["id"])
    assert out.where("id IS NULL").count() == 3
    assert out.where("id = 1").count() == 1


def test_upsert_needs_known_columns(spark):
    target = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(SpecError, match="key columns"):
        merge.upsert(target, target, [])
    with pytest.raises(SpecError, match="not in the target"):
        merge.upsert(target, spark.createDataFrame([(1, 2)], "id int, x int"), ["id"])
    with pytest.raises(SpecError, match="not in the batch"):
        merge.upsert(target, target, ["x"])
    with pytest.raises(SpecError, match="not in the target"):
        merge.insert(target, spark.createDataFrame([(1, 2)], "id int, x int"))


@pytest.mark.parametrize("with_w", [True, False])
def test_upsert_against_a_loop(spark, rows, with_w):
    """A hot key holds a third of the batch; a plain loop says what is right."""
    rng = random.Random(11)
    key = lambda: 7 if rng.random() < 0.34 else rng.choice([*range(60), None])
    old = [(k, k * 10, f"w{k}") for k in range(40)] + [(None, 0, "n")]
    new = [(key(), rng.choice([None, rng.randint(0, 9)]), f"x{i}", i) for i in range(400)]
    state = {k: (k, v, w) for k, v, w in old if k is not None}
    loose = [(None, 0, "n")]
    for k, v, w, _ in new:
        w = w if with_w else (state[k][2] if k in state else None)
        if k is None:
            loose.append((k, v, w if with_w else None))
        else:
            state[k] = (k, v, w)
    target = spark.createDataFrame(old, "k int, v int, w string")
    batch = spark.createDataFrame(new, "k int, v int, w string, i int").repartition(7)
    out = merge.upsert(target, batch if with_w else batch.drop("w"), ["k"], ["i"])
    assert rows(out) == sorted([*state.values(), *loose], key=repr)


def test_hot_keys_shrink_before_the_shuffle(spark):
    batch = spark.range(1000).selectExpr("0 AS k", "id AS v", "id AS o")
    plan = merge.last_per_key(batch, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("max_by") < plan.index("Exchange") < plan.index("partial_max_by")


def test_truncate_insert(spark, rows):
    batch = spark.createDataFrame(
        [("a.csv", 1), ("b.csv", 2), ("b.csv", 3)], "f string, id int"
    )
    assert rows(merge.truncate_insert(batch, ["id", "x"])) == [(1, None), (2, None), (3, None)]
    assert rows(merge.truncate_insert(batch, ["id"], "f")) == [(2,), (3,)]


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(merge.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]
    merge.require_unique(df.where("a IS NULL"), ["a", "b"])
