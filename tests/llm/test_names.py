"""Columns of the input named as the operators' own stay as they are."""

from pyspark.sql import functions as F

from tidemark.llm import lines, packing


def test_line_dedup_keeps_columns_of_any_name(spark):
    rows = [(i, "one line on all sites", f"s{i}", i, f"k{i}", 2 * i, "l", -i) for i in range(6)]
    names = "doc_id long, text string, source string, _row int, _kept string, _removed int, line string, keeper int"
    docs = spark.createDataFrame(rows, names)
    found = lines.clean(docs)
    assert found.columns == [*docs.columns, "n_removed"]
    assert sorted(tuple(r[c] for c in docs.columns) for r in found.collect()) == sorted(
        (*r[:1], r[1] if r[0] == 0 else "", *r[2:]) for r in rows
    )


def test_packing_keeps_columns_of_any_name(spark):
    rows = spark.range(40).select(
        F.col("id").alias("doc_id"), (F.col("id") % 9 + 1).alias("length"), *(F.col("id").alias(c) for c in packing.WORKING), F.lit(1).alias("__n")
    )
    found = packing.pack(rows, 16, ("doc_id", "_groups"))
    assert found.columns == [*rows.columns, "sequence_id", "offset"]
    assert all(r["doc_id"] == r["_groups"] == r["_n"] == r["_rank"] and r["__n"] == 1 for r in found.collect())
