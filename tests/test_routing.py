from tidemark.operators.routing import resolve_refs, route_files
from tidemark.specs import IngestRoute


def table_of(spark, key, *routes):
    files = spark.createDataFrame([(key,)], "file_key string")
    row = route_files(files, [IngestRoute(p, t, create_if_missing=c) for p, t, c in routes]).first()
    return row["target_table"], row["create_if_missing"], row["route"]


def test_routes(spark):
    users = ("users/*.parquet", "users", False)
    assert table_of(spark, "users/part-0.parquet", users) == ("users", False, 0)
    assert table_of(spark, "orders/2024/data.parquet") == ("orders", False, -1)
    assert table_of(spark, "products.parquet") == ("products", False, -1)
    assert table_of(spark, "raw/data.parquet", ("raw/*.parquet", "customers", True)) == (
        "customers", True, 0,
    )
    orders = ("orders/*.parquet", "orders", True)
    assert table_of(spark, "unknown/file.parquet", users, orders) == ("unknown", False, -1)


def test_first_route_wins_and_bad_patterns_are_skipped(spark):
    routes = [("[", "broken", True), ("a/*", "first", False), ("a/b*", "second", True)]
    assert table_of(spark, "a/b.csv", *routes) == ("first", False, 1)
    assert table_of(spark, "noext", *routes) == ("noext", False, -1)


def test_resolve_refs(spark, rows):
    tables = spark.createDataFrame(
        [("a", "users"), ("b", "users"), (None, "orders"), ("a", "only"), ("a", "only")],
        "schema_name string, table_name string",
    )
    refs = spark.createDataFrame(
        [(r,) for r in ("users", "a.users", "c.users", "orders", "public.orders", "only", "new", ".x", "new")],
        "table_ref string",
    )
    assert rows(resolve_refs(refs, tables)) == sorted(
        [
            ("users", None, "users", "ambiguous"),
            ("a.users", "a", "users", "configured"),
            ("c.users", "c", "users", "minimal"),
            ("orders", "public", "orders", "configured"),
            ("public.orders", "public", "orders", "configured"),
            ("only", "a", "only", "configured"),
            ("new", None, "new", "minimal"),
            (".x", None, ".x", "minimal"),
        ],
        key=repr,
    )
