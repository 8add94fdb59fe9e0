"""CSV files whose quotes hold line breaks, read in several splits."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources.csv import breaks_in_quotes, csv_records, scan_csv


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def rows_of(seed, n):
    draw = random.Random(seed)
    parts = ["a", "b,", '"', "\n", "\n\n", " é", "x" * 30, '""', "', "]
    return [[str(i), "".join(draw.choice(parts) for _ in range(draw.choice([0, 1, 3, 9, 60]))), f"end {i}"] for i in range(n)]


def text_of(rows, header, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerows([header, *rows])
    return out.getvalue()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splits_are_read_apart(spark, small_splits, tmp_path, seed):
    rows, header = rows_of(seed, 300), ["id", "note", "tail"]
    (tmp_path / "a.csv").write_text(text_of(rows[:200], header), newline="")
    (tmp_path / "b.csv").write_text(text_of(rows[200:], header), newline="")
    path = str(tmp_path)
    assert breaks_in_quotes(spark, path)
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    got = scan_csv(spark, path, null_tokens=[])
    assert got.columns == header
    # the reader of both engines takes an empty field for a null
    assert sorted((r["id"], r["note"] or "", r["tail"]) for r in got.collect()) == sorted((int(i), n, t) for i, n, t in rows)


def test_one_record_over_many_splits(spark, small_splits, tmp_path):
    note = "\n".join(f"line {i}, with \"words\"" for i in range(400))
    rows = [["1", "x", "y"], ["2", note, "z"], ["3", "x", "y"]]
    (tmp_path / "a.csv").write_text(text_of(rows, ["id", "note", "tail"]), newline="")
    got = scan_csv(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "x", "y"), (2, note, "z"), (3, "x", "y")]
    with pytest.raises(ValueError, match="not closed"):
        csv_records(spark, str(tmp_path), max_lines=50)


def test_ends_marks_and_headers(spark, tmp_path):
    text = "﻿" + text_of([["1", "a\nb"], ["2", ""]], ["id", "two\nwords"], "\r\n") + "\r\n\r\n"
    (tmp_path / "a.csv").write_text(text, encoding="utf-8", newline="")
    got = scan_csv(spark, str(tmp_path))
    assert got.columns == ["id", "two\nwords"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\nb"), (2, None)]


def test_plain_files_take_the_plain_way(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"a, ""b"""\n2,c\n')
    assert not breaks_in_quotes(spark, str(tmp_path))
    assert "csv-lines" not in scan_csv(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in scan_csv(spark, str(tmp_path)).collect()) == [(1, 'a, "b"'), (2, "c")]


@pytest.mark.parametrize("note", ["b", '"b\nc"'])
def test_rows_of_other_lengths(spark, tmp_path, note):
    (tmp_path / "a.csv").write_text(f"id,note\n1,{note}\n2\n3,{note},more\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        scan_csv(spark, str(tmp_path)).collect()
    got = scan_csv(spark, str(tmp_path), surplus="drop").collect()
    assert sorted((r["id"], r["note"] is None) for r in got) == [(1, False), (2, True), (3, False)]
    with pytest.raises(ValueError):
        scan_csv(spark, str(tmp_path), surplus="keep")


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"i\nd",note\n')
    got = scan_csv(spark, str(tmp_path))
    assert got.columns == ["i\nd", "note"] and got.where(F.lit(True)).count() == 0
