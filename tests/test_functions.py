import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import contracts, literals
from tidemark.functions.conversions import as_text, floor_div, from_epoch, from_epoch_day, wrap_unsigned
from tidemark.functions.paths import InvalidGlob, file_key, file_stem, glob_to_regex


@pytest.mark.parametrize(
    "name, dtype",
    [
        ("boolean", T.BooleanType()), ("BOOL", T.BooleanType()), ("int2", T.ShortType()),
        ("Integer", T.IntegerType()), ("serial", T.IntegerType()), ("bigserial", T.LongType()),
        ("real", T.FloatType()), ("double precision", T.DoubleType()), ("numeric", T.StringType()),
        ("citext", T.StringType()), ("bytea", T.BinaryType()), ("date", T.DateType()),
        ("timestamp", T.TimestampNTZType()), ("timestamptz", T.TimestampType()),
        ("timestamp with time zone", T.TimestampType()), ("time", T.StringType()),
        ("interval", T.StringType()), ("uuid", T.StringType()), ("jsonb", T.StringType()),
        ("_int4", T.StringType()), ("text[]", T.StringType()), ("hstore", T.StringType()),
    ],
)
def test_lake_types(name, dtype):
    assert contracts.lake_type(name) == dtype


def test_decimal_on_request():
    assert contracts.lake_type("numeric", T.DecimalType(12, 3)) == T.DecimalType(12, 3)


@pytest.mark.parametrize(
    "dtype, name",
    [
        (T.BooleanType(), "BOOLEAN"), (T.ByteType(), "SMALLINT"), (T.ShortType(), "SMALLINT"),
        (T.IntegerType(), "INTEGER"), (T.LongType(), "BIGINT"), (T.FloatType(), "REAL"),
        (T.DoubleType(), "DOUBLE PRECISION"), (T.StringType(), "TEXT"), (T.BinaryType(), "BYTEA"),
        (T.DateType(), "DATE"), (T.TimestampType(), "TIMESTAMPTZ"),
        (T.TimestampNTZType(), "TIMESTAMP"), (T.DayTimeIntervalType(), "INTERVAL"),
        (T.TimeType(), "TIME"),
        (T.DecimalType(10, 2), "TEXT"), (T.ArrayType(T.LongType()), "TEXT"),
        (T.StructType([T.StructField("a", T.LongType())]), "TEXT"),
        (T.MapType(T.StringType(), T.LongType()), "TEXT"),
    ],
)
def test_target_types(dtype, name):
    assert contracts.target_type(dtype) == name


def test_target_contract_keeps_nullability():
    schema = T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("name", T.StringType()),
            T.StructField("active", T.BooleanType()),
        ]
    )
    assert contracts.target_columns(schema) == [
        (1, "id", "BIGINT", False), (2, "name", "TEXT", True), (3, "active", "BOOLEAN", True),
    ]


def test_casts_that_change_a_value_fail(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    for good, want in (("CAST(2 AS DOUBLE)", 2), ("CAST(3 AS DECIMAL(9,2))", 3), ("NULL", None), ("'7'", 7), ("5S", 5)):
        assert contracts.conform(spark.sql(f"SELECT {good} AS a"), schema).first()["a"] == want
    for bad in ("1.75D", "CAST(1.75 AS DECIMAL(9,2))", "'1.75'", "1e30D", "CAST('NaN' AS DOUBLE)"):
        with pytest.raises(Exception, match="does not fit bigint"):
            contracts.conform(spark.sql(f"SELECT {bad} AS a"), schema).collect()
    day = T.StructType([T.StructField("a", T.DateType())])
    assert str(contracts.conform(spark.sql("SELECT timestamp_ntz'2024-05-01' AS a"), day).first()["a"]) == "2024-05-01"
    with pytest.raises(Exception, match="does not fit date"):
        contracts.conform(spark.sql("SELECT timestamp_ntz'2024-05-01 10:00:00' AS a"), day).collect()


def test_lake_schema():
    schema = contracts.lake_schema(
        [("id", "integer", False), ("email", "text", True), ("active", "boolean", True)]
    )
    assert [(f.name, f.dataType, f.nullable) for f in schema] == [
        ("id", T.IntegerType(), False), ("email", T.StringType(), True),
        ("active", T.BooleanType(), True),
    ]
    assert contracts.lake_schema([]) == T.StructType([])


def test_to_lake_values(spark):
    df = spark.sql(
        "SELECT 1L AS id, CAST(1.50 AS DECIMAL(10,2)) AS price, ARRAY(1, NULL, 3) AS tags, "
        "NAMED_STRUCT('a', 1, 'b', CAST(NULL AS STRING)) AS pair, CAST(NULL AS DECIMAL(4,1)) AS none"
    )
    out = contracts.to_lake(df, {"id": "integer", "price": "numeric", "tags": "_int4"})
    assert dict(out.dtypes) == {
        "id": "int", "price": "string", "tags": "string", "pair": "string", "none": "string",
    }
    assert tuple(out.first()) == (1, "1.50", "[1,null,3]", '{"a":1,"b":null}', None)
    assert out.schema["price"].metadata["src_type"] == "numeric"
    kept = contracts.to_lake(df, {"price": "numeric"}, {"price": T.DecimalType(10, 2)})
    assert dict(kept.dtypes)["price"] == "decimal(10,2)"


def test_for_target_values(spark):
    df = spark.sql(
        "SELECT CAST(7 AS TINYINT) AS small, CAST(1.5 AS DECIMAL(5,1)) AS price, MAP('k', 2) AS m, "
        "INTERVAL '1' DAY AS gap, X'01' AS raw"
    )
    out = contracts.for_target(df)
    assert dict(out.dtypes) == {
        "small": "smallint", "price": "string", "m": "string", "gap": "string", "raw": "binary",
    }
    row = out.first()
    assert (row["small"], row["price"], row["m"]) == (7, "1.5", '{"k":2}')
    assert dict(contracts.for_target(df, keep_decimal=True).dtypes)["price"] == "decimal(5,1)"


def test_conform(spark):
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("t", T.StringType())]
    )
    out = contracts.conform(spark.sql("SELECT 1 AS id, ARRAY(1) AS t"), schema)
    assert out.dtypes == [("id", "bigint"), ("t", "string")] and tuple(out.first()) == (1, "[1]")
    with pytest.raises(ValueError, match="extra"):
        contracts.conform(spark.sql("SELECT 1 AS extra"), schema)


@pytest.mark.parametrize("unit, scale", [("s", 1), ("ms", 10**3), ("us", 10**6), ("ns", 10**9)])
@pytest.mark.parametrize("seconds", [0, 1770681600, -1])
def test_epoch_units(spark, unit, scale, seconds):
    df = spark.createDataFrame([(seconds * scale,)], "n bigint").select(
        from_epoch(F.col("n"), unit).alias("plain"),
        from_epoch(F.col("n"), unit, zoned=True).cast("string").alias("zoned"),
    )
    want = datetime(1970, 1, 1) + __import__("datetime").timedelta(seconds=seconds)
    assert tuple(df.first()) == (want, want.strftime("%Y-%m-%d %H:%M:%S"))


def test_epoch_rounding_and_days(spark):
    df = spark.createDataFrame([(-1,)], "n bigint").select(
        floor_div(F.col("n"), 1000).alias("down"),
        from_epoch(F.col("n"), "ns").alias("t"),
        from_epoch_day(F.lit(-1)).alias("d"),
    )
    assert tuple(df.first()) == (-1, datetime(1969, 12, 31, 23, 59, 59, 999999), date(1969, 12, 31))
    with pytest.raises(ValueError):
        from_epoch(F.lit(1), "h")


def test_unsigned_wrap(spark):
    values = [0, 2**63 - 1, 2**63, 2**64 - 1]
    df = spark.range(1).select(
        *[wrap_unsigned(F.lit(str(v)).cast("decimal(20,0)")).alias(f"v{i}") for i, v in enumerate(values)]
    )
    assert tuple(df.first()) == (0, 2**63 - 1, -(2**63), -1)


@pytest.mark.parametrize(
    "text, zoned, plain",
    [
        ("2026-01-05 10:20:30", "2026-01-05T10:20:30+00:00", "2026-01-05 10:20:30"),
        ("2026-01-05 10:20:30.5", "2026-01-05T10:20:30.500+00:00", "2026-01-05 10:20:30.500"),
        ("2026-01-05 10:20:30.123456", "2026-01-05T10:20:30.123456+00:00", "2026-01-05 10:20:30.123456"),
    ],
)
def test_timestamp_text(spark, text, zoned, plain):
    df = spark.range(1).select(
        as_text(F.lit(text).cast("timestamp"), T.TimestampType()),
        as_text(F.lit(text).cast("timestamp_ntz"), T.TimestampNTZType()),
    )
    assert tuple(df.first()) == (zoned, plain)


@pytest.mark.parametrize(
    "text, dtype, kind, ok",
    [
        ("42", T.IntegerType(), None, True), ("+42", T.LongType(), None, True),
        ("4.2", T.IntegerType(), None, False), (" 42", T.IntegerType(), None, False),
        ("99999999999", T.IntegerType(), None, False), ("v3", T.LongType(), None, False),
        ("4.2e1", T.DoubleType(), None, True), ("inf", T.DoubleType(), None, True),
        ("5d", T.DoubleType(), None, False), ("TRUE", T.BooleanType(), None, True),
        ("t", T.BooleanType(), None, False), ("2026-01-05", T.DateType(), None, True),
        ("2026-13-05", T.DateType(), None, False), ("2026-01-05 1", T.DateType(), None, False),
        ("2026-01-05 10:20:30.123456", T.TimestampNTZType(), None, True),
        ("2026-01-05 10:20:30", T.TimestampType(), None, True),
        ("2026-01-05T10:20:30Z", T.TimestampType(), None, True),
        ("2026-01-05T10:20:30+02:00", T.TimestampNTZType(), None, False),
        ("550e8400-e29b-41d4-a716-446655440000", T.StringType(), "uuid", True),
        ("550e8400e29b41d4a716446655440000", T.StringType(), "uuid", True),
        ("not-a-uuid", T.StringType(), "uuid", False), ("anything", T.StringType(), None, True),
        ("12.50", T.StringType(), "numeric", True), ("12,50", T.StringType(), "numeric", False),
        ("1", None, None, False),
    ],
)
def test_fits(spark, text, dtype, kind, ok):
    assert spark.range(1).select(literals.fits(F.lit(text), dtype, kind)).first()[0] is ok


def test_literals(spark):
    df = spark.range(1).select(
        literals.literal("2026-01-05 10:20:30.123456", T.TimestampNTZType()).alias("ts"),
        literals.literal("42", T.IntegerType()).alias("n"),
        literals.literal("v1", T.StringType()).alias("s"),
        literals.parse_as(F.lit("nope"), T.LongType()).alias("bad"),
    )
    assert tuple(df.first()) == (datetime(2026, 1, 5, 10, 20, 30, 123456), 42, "v1", None)


@pytest.mark.parametrize(
    "pattern, cross, hits, misses",
    [
        ("users/*.parquet", True, ["users/a.parquet", "users/x/a.parquet"], ["users/a.csv", "users.parquet"]),
        ("users/*.parquet", False, ["users/a.parquet"], ["users/x/a.parquet"]),
        ("**/*.parquet", False, ["a.parquet", "x/a.parquet", "x/y/a.parquet"], ["a.csv"]),
        ("x/**/a.csv", False, ["x/a.csv", "x/y/z/a.csv"], ["y/a.csv", "xa.csv"]),
        ("x/**", False, ["x/a", "x/a/b"], ["y/a"]),
        ("part-?.csv", False, ["part-1.csv"], ["part-.csv", "part-12.csv", "part-/.csv"]),
        ("part-[0-3].csv", True, ["part-2.csv"], ["part-7.csv"]),
        ("part-[!0-3].csv", True, ["part-7.csv"], ["part-2.csv"]),
        ("a[]]b", True, ["a]b"], ["ab"]),
        ("a.b+c(d)", True, ["a.b+c(d)"], ["aXb+c(d)"]),
        ("{x}", True, ["{x}"], ["x"]),
    ],
)
def test_globs(spark, pattern, cross, hits, misses):
    regex = glob_to_regex(pattern, cross)
    for key in hits + misses:
        want = key in hits
        assert bool(re.search(regex, key)) is want, key
        assert spark.range(1).select(F.lit(key).rlike(regex)).first()[0] is want, key


@pytest.mark.parametrize("pattern", ["a**", "**a", "a/**b/c", "[ab", "***"])
def test_bad_globs(pattern):
    with pytest.raises(InvalidGlob):
        glob_to_regex(pattern)


@pytest.mark.parametrize(
    "path, base, key",
    [
        ("file:///data/in/users/a.parquet", "/data/in", "users/a.parquet"),
        ("file:/data/in/users/a.parquet", "file:/data/in/", "users/a.parquet"),
        ("s3a://lake/raw/x/y.csv", "s3a://lake/raw", "x/y.csv"),
        ("s3a://lake/x%20y+z.csv", "s3a://lake", "x y+z.csv"),
        ("hdfs://node:8020/data/in/a.csv", "hdfs://node:8020/data/in", "a.csv"),
    ],
)
def test_file_keys(spark, path, base, key):
    assert spark.range(1).select(file_key(F.lit(path), base)).first()[0] == key


@pytest.mark.parametrize(
    "key, stem", [("a/b.c.csv", "b.c"), ("plain", "plain"), (".hidden", ".hidden"), ("x.csv", "x")]
)
def test_file_stem(spark, key, stem):
    assert spark.range(1).select(file_stem(F.lit(key))).first()[0] == stem
