"""Strict CSV in many splits against the reader of the standard library; what it refuses."""

from __future__ import annotations

import csv
import io
import random
import re

import pytest
from pyspark.errors import PySparkException

from tallyloom.sources import sheets

PIECES = ("a", " b ", ",", '"', "\n", "\r\n", '""', ",\n", "é", " ", "x" * 70, "\\", "'", "", "#", "\t")


def plain(path) -> list[list[str]]:
    return list(csv.reader(io.StringIO(path.read_bytes().decode("utf-8-sig"), newline=""), strict=True))


@pytest.mark.parametrize(("split", "mark"), [(64, ""), (200, "﻿"), (1 << 27, "")])
def test_many_splits_equal_one_reader(spark, tmp_path, split, mark):
    draw = random.Random(split)
    for name in ("a.csv", "b.csv"):
        rows = [["id", "text", "more"]] + [[str(i), "".join(draw.choices(PIECES, k=draw.randrange(9))), draw.choice(("", "y", "z\nz"))] for i in range(150)]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=draw.choice(("\n", "\r\n"))).writerows(rows)
        (tmp_path / name).write_bytes((mark + out.getvalue()).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = sheets.scan_csv(spark, str(tmp_path), ("text", "id", "more"))
        splits = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
        assert splits > 20 or split > 200
        found = sorted((r["id"], r["text"], r["more"]) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted(tuple(r) for name in ("a.csv", "b.csv") for r in plain(tmp_path / name)[1:])
    assert found == want and len(want) == 300


def test_lines_of_records(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,text\n1,"x\ny"\n\n2,z\n3,"p\n\n\nq"\n4,last')
    found = sorted((r["line"], r["value"]) for r in sheets.csv_records(spark, str(tmp_path)).collect())
    assert found == [(1, "id,text"), (2, '1,"x\ny"'), (5, "2,z"), (6, '3,"p\n\n\nq"'), (10, "4,last")]


def test_lines_of_a_split_are_numbered_by_chunks(spark, tmp_path, monkeypatch):
    """A split is no longer one group: two lines at most are here, and records run over many chunks."""
    monkeypatch.setattr(sheets, "CHUNK", 1, raising=False)
    draw, out = random.Random(5), io.StringIO(newline="")
    rows = [["id", "text"]] + [[str(i), "".join(draw.choices(PIECES, k=draw.randrange(15)))] for i in range(300)]
    csv.writer(out, lineterminator="\n").writerows(rows)
    (tmp_path / "a.csv").write_bytes(out.getvalue().encode())
    records = sheets.csv_records(spark, str(tmp_path))
    dealt = re.findall(r"hashpartitioning\(path#\d+, block#\d+L?, ([a-z]+)", records._jdf.queryExecution().executedPlan().toString())
    assert dealt and set(dealt) == {"chunk"}
    got = sheets.scan_csv(spark, str(tmp_path), ("id", "text"))
    assert sorted((r["id"], r["text"]) for r in got.collect()) == sorted(tuple(r) for r in rows[1:])


FAULTS = {
    "not_utf8": b"id,text\n1,a\n2,\xff\n",
    "open_quote": b'id,text\n1,a\n2,"b\n3,c\n',
    "stray_quote": b'id,text\n1,a\n2,b"c"\n',
    "bare_return": b"id,text\n1,a\n2,b\rc\n",
    "cells": b"id,text\n1,a\n2\n",
}


@pytest.mark.parametrize("fault", FAULTS)
def test_faults_are_named_and_refused(spark, tmp_path, fault):
    (tmp_path / "a.csv").write_bytes(FAULTS[fault])
    path = str(tmp_path)
    assert [tuple(r) for r in sheets.bad_rows(spark, path, ("id", "text")).collect()] == [("a.csv", 3, fault)]
    with pytest.raises(PySparkException, match=f"{fault} in a.csv line 3"):
        sheets.scan_csv(spark, path, ("id",)).count()


def test_text_after_a_closing_quote_and_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,text\n1,"a"b\n2,"c"",d"\n3,"",\n')
    (tmp_path / "b.csv").write_bytes(b"text,id\n4,e\n")
    found = sorted(tuple(r) for r in sheets.bad_rows(spark, str(tmp_path), ("id", "text")).collect())
    assert found == [("a.csv", 2, "stray_quote"), ("a.csv", 4, "cells"), ("b.csv", 1, "header")]


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"id,text\n")
    assert sheets.scan_csv(spark, str(tmp_path), ("id", "text")).count() == 0
    (tmp_path / "a.csv").write_bytes(b"")
    with pytest.raises(ValueError, match="no rows"):
        sheets.scan_csv(spark, str(tmp_path), ("id",))
