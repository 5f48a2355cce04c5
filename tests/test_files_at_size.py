"""Files of any size: order digests, manifests by blocks, zip members; labelled texts as state of a stream."""

from __future__ import annotations

import hashlib
import random
import shutil
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.corpus import tree_digest
from tallyloom.plans.file_queries import write_blocks
from tallyloom.sources import files, zips
from tallyloom.streaming.classify import classify_stream


def plain_tree(digests, width, levels):
    for _ in range(levels):
        digests = [hashlib.sha256("".join(digests[i : i + width]).encode()).hexdigest() for i in range(0, len(digests), width)]
    return digests[0] if digests else None


@pytest.mark.parametrize(("n", "width", "levels"), [(0, 4, 2), (1, 4, 3), (64, 4, 3), (65, 5, 3), (300, 1024, 4)])
def test_tree_of_hashes(spark, n, width, levels):
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    rows = spark.createDataFrame(list(enumerate(digests)), "place long, digest string").orderBy(F.rand(1))
    assert tuple(tree_digest(rows, "place", "digest", width, levels).first()) == (n, plain_tree(digests, width, levels))


def test_digest_of_lines_sees_two_rows_swapped(spark, tmp_path):
    lines = [f"row {i} {'x' * (i % 50)}" for i in range(3000)]
    swapped = lines[:1000] + [lines[1001], lines[1000]] + lines[1002:]
    found = []
    for name, split in (("a", 1 << 12), ("b", 1 << 27)):
        for which, rows in (("plain", lines), ("swapped", swapped)):
            folder = tmp_path / f"{name}-{which}"
            folder.mkdir()
            (folder / "part-0.txt").write_text("\n".join(rows[:1500]) + "\n")
            (folder / "part-1.txt").write_text("\n".join(rows[1500:]) + "\n")
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            found.append(tuple(files.lines_digest(spark, str(folder)).first()))
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[2] == (3000, plain_tree([hashlib.sha256(x.encode()).hexdigest() for x in lines], 1024, 4))
    assert found[1] == found[3] and found[1] != found[0]


def test_manifest_by_blocks(spark, tmp_path):
    folder, said = tmp_path / "run", str(tmp_path / "manifest")
    (folder / "deep" / "er").mkdir(parents=True)
    contents = {"a.bin": random.Random(1).randbytes(3_000_001), "deep/b c.txt": b"x", "deep/er/c.gz": b"\x1f\x8bno gzip"}
    (folder / "empty").write_bytes(b"")  # not listed
    for name, content in contents.items():
        (folder / name).write_bytes(content)
    hashes = {r["file"]: (r["sha256"], r["length"]) for r in files.file_hashes(spark, str(folder), str(folder), block=1 << 16).collect()}
    assert hashes == {k: (hashlib.sha256(v).hexdigest(), len(v)) for k, v in contents.items()}
    files.write_manifest(spark, str(folder), said)
    assert files.manifest_faults(spark, str(folder), said).count() == 0
    (folder / "a.bin").write_bytes(contents["a.bin"][:-1] + b"?")
    (folder / "deep" / "er" / "c.gz").rename(folder / "d.gz")
    faults = {r["file"]: r["fault"] for r in files.manifest_faults(spark, str(folder), said).collect()}
    assert faults == {"a.bin": "changed", "deep/er/c.gz": "missing", "d.gz": "unlisted"}


def test_stream_does_not_read_what_it_wrote(spark, tmp_path):
    rows = lambda xs: spark.createDataFrame([(x, x) for x in xs], "text_key string, review_text string")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    args = (source, "text_key string, review_text string", lambda batch: batch.withColumn("n", F.length("review_text")), out, state)
    rows(["a", "bb", None, None]).write.parquet(source)
    assert {r["text_key"] for r in classify_stream(spark, *args).collect()} == {"a", "bb", None}
    shutil.rmtree(out)
    rows(["bb", "ccc", "a", None]).write.mode("append").parquet(source)
    assert [r["text_key"] for r in classify_stream(spark, *args).collect()] == ["ccc"]


def test_stream_that_failed_labels_each_text_once(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i in range(3):
        spark.createDataFrame([(x, x) for x in ("a", f"b{i}")], "text_key string, review_text string").coalesce(1).write.mode("append").parquet(source)
    calls = []

    def label(batch):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("the labeler went away")
        return batch

    args = (source, "text_key string, review_text string", label, out, state, 1)
    with pytest.raises(Exception, match="went away"):
        classify_stream(spark, *args)
    assert sorted(r["text_key"] for r in classify_stream(spark, *args).collect()) == ["a", "b0", "b1", "b2"]


def write_zip(path: Path, members: dict[str, bytes]) -> None:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as target:
        for name, content in members.items():
            target.writestr(name, content)


def test_zip_members(spark, tmp_path):
    write_zip(tmp_path / "one.zip", {"in/a.csv": '﻿id,body,at,more\n1,"x, ""y""\r\nz",2024-01-02T03:00,q\n2,é,2024-01-03,\n'.encode(), "readme.txt": b"no table"})
    write_zip(tmp_path / "two.zip", {"b.csv": b"at,id,body\n2024-01-01,3,\n2024-01-02,4,last", "empty.csv": b"id,body,at\n"})
    read = lambda **more: sorted(tuple(r) for r in zips.scan_zip(spark, str(tmp_path), {"id": "review_id", "body": "text", "at": "ts"}, **more).collect())
    assert read() == [("1", 'x, "y"\r\nz', "2024-01-02T03:00"), ("2", "é", "2024-01-03"), ("3", "", "2024-01-01"), ("4", "last", "2024-01-02")]
    assert [r[0] for r in read(date="at", start="2024-01-02", end="2024-01-03")] == ["1", "4"]


@pytest.mark.parametrize(("content", "message"), [
    (b"id,id\n1,2\n", "repeats a column"), (b"other\n1\n", "lacks id"), (b"", "no rows"), (b"id,x\n1\n", "line 2"), (b"id\n\xff\n", "utf-8"), (b'id\n"open\n', "b.csv"),
])
def test_zip_members_that_are_refused(spark, tmp_path, content, message):
    write_zip(tmp_path / "one.zip", {"b.csv": content})
    with pytest.raises(Exception, match=message):
        zips.scan_zip(spark, str(tmp_path), {"id": "id"}).collect()


def test_members_and_files_are_read_by_many_tasks(spark, tmp_path):
    """Names of files are few bytes, so partitions of them must not be merged by bytes; folders are listed by few tasks."""
    for n in range(12):
        (tmp_path / f"z{n}").mkdir()
        with zipfile.ZipFile(tmp_path / f"z{n}" / "a.zip", "w") as archive:
            archive.writestr("a.csv", f"id\n{n}\n")
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    rows = zips.scan_zip(spark, str(tmp_path), {"id": "id"})
    hashes = files.file_hashes(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert sorted(int(r["id"]) for r in rows.collect()) == list(range(12))
    assert rows.rdd.getNumPartitions() == 4 and hashes.rdd.getNumPartitions() == 4


def test_blocks_are_written_by_their_tasks(spark, tmp_path):
    """Thousands of small files are neither moved nor marked by a commit; each holds its lines in order of id."""
    write_blocks(spark, "/root/testdata/sf0.001", str(tmp_path / "blocks"), lost=False)
    found = {str(p.parent.relative_to(tmp_path / "blocks")): [int(x.split()[0]) for x in p.read_text().splitlines()] for p in (tmp_path / "blocks").rglob("*.txt")}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.coalesce("source", F.lit("none")).alias("source")).collect()
    want: dict[str, list[int]] = {}
    for r in sorted(docs):
        want.setdefault(f"source={r['source']}/block={r['doc_id'] // 1000}", []).append(r["doc_id"])
    assert found == want
    assert not list((tmp_path / "blocks").rglob("_SUCCESS"))
