"""CSV read by splits of every size, against Python's reader."""

import csv
import io
import random

import pytest

from tidemark.queries import ingest
from tidemark.sources import csv_splits
from tidemark.sources.files import FILE_PATH, ROW_ORDER, csv_rows, read_csv_text

CELLS = ["plain", "", "a,b", 'say "hi"', '""', '"', "two\nlines", "three\n\nlines", "carriage\r\nreturn", " spaces ", "é日本", "x" * 70]


@pytest.fixture
def split_at(spark):
    """Splits of so many bytes for the rest of a test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def written(path, rows, end="\r\n"):
    text = io.StringIO()
    csv.writer(text, lineterminator=end).writerows([["id", "one", "two"], *rows])
    path.write_bytes(text.getvalue().encode())
    return text.getvalue().encode()


def in_order(df):
    rows = df.orderBy(FILE_PATH, ROW_ORDER).drop(FILE_PATH, ROW_ORDER).collect()
    return [tuple(v or "" for v in r) for r in rows]


@pytest.mark.parametrize("end", ("\n", "\r\n"))
def test_splits_anywhere_give_the_same_records(spark, tmp_path, split_at, end):
    rng = random.Random(len(end))
    want = [(str(i), rng.choice(CELLS), rng.choice(CELLS)) for i in range(30)]
    data = written(tmp_path / "a.csv", want, end)
    places = {size: data[size : size + 1] for size in range(1, len(data))}
    wanted = [
        next(s for s in places if s > 60 and data.count(b'"', 0, s) % 2 == 1),  # inside quotes
        next(s for s in places if data[s - 1 : s + 1] == b'""' and s > 60),  # inside a doubled quote
        next((s for s in places if data[s - 1 : s + 1] == b"\r\n" and s > 60), 61),  # between CR and LF
        37,
        len(data) // 2,
    ]
    for size in wanted:
        split_at(size)
        lines = csv_splits.lines_of(spark, [str(tmp_path / "a.csv")])
        assert lines.rdd.getNumPartitions() > 1
        assert in_order(csv_rows(spark, [str(tmp_path / "a.csv")])) == want


def test_a_record_over_many_splits(spark, tmp_path, split_at):
    long = "\n".join(f'line {i} with "quotes"' for i in range(200))
    want = [("1", long, ""), ("2", "short", long), ("3", long, long)]
    written(tmp_path / "a.csv", want)
    split_at(100)
    assert in_order(csv_rows(spark, [str(tmp_path / "a.csv")])) == want


def test_files_with_and_without_line_breaks_together(spark, tmp_path, split_at):
    written(tmp_path / "a b+%.csv", [("1", "x", "y"), ("2", 'q"q', "z")])
    written(tmp_path / "b.csv", [("3", "two\nlines", "y")])
    (tmp_path / "c.csv").write_text("")
    written(tmp_path / "d.csv", [])
    split_at(16)
    paths = sorted(str(p) for p in tmp_path.iterdir())
    assert in_order(csv_rows(spark, paths)) == [("1", "x", "y"), ("2", 'q"q', "z"), ("3", "two\nlines", "y")]
    broken, plain = csv_splits.by_line_breaks(spark, paths)
    assert [u.rsplit("/", 1)[1] for u in broken] == ["b.csv"] and len(plain) == 2


def test_headers_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"i\nd",b\n1,"x\ny"\n')
    found = read_csv_text(spark, [str(tmp_path / "a.csv")])
    assert found.columns == ["i\nd", "b"] and [tuple(r) for r in found.collect()] == [("1", "x\ny")]


@pytest.mark.parametrize("bad", ['1,"open\nand\nopen', '1,"a\nb"\n2\n', '1,"a\nb"\n2,x,y\n'])
def test_unclosed_quotes_and_ragged_records_fail(spark, tmp_path, split_at, bad):
    (tmp_path / "a.csv").write_text("id,b\n" + bad)
    split_at(7)
    with pytest.raises(Exception, match="(?i)quote is not closed|malformed"):
        read_csv_text(spark, [str(tmp_path / "a.csv")]).collect()


def test_the_query_writes_a_file_a_task(spark, tmp_path, split_at, monkeypatch):
    """A table of several files is written by as many tasks, none of which has all of it."""
    monkeypatch.setattr(ingest, "scratch_dir", lambda spark, name: str(tmp_path / name))
    docs = spark.range(0, 400, 1, 4).selectExpr("id AS doc_id", "concat('text\n', id) AS text", "'en' AS lang", "'web' AS source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    split_at(4096)
    found = sorted(tuple(r) for r in ingest.csv_splits(spark, str(tmp_path)).collect())
    assert found == [(i, f'"text\n{i}"\n\n,"",\r\nweb', "en") for i in range(400)]
    sizes = [p.stat().st_size for p in (tmp_path / "csv-splits" / "in").glob("part-*")]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
