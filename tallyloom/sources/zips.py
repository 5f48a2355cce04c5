"""CSV members of zip files, a member at a time."""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources import stores


def _rows(source: io.BufferedIOBase, where: str, wanted: dict[str, str]) -> Iterator[list[str]]:
    """The wanted cells of a strict CSV stream; what is wrong with it names its place."""
    reader = csv.reader(io.TextIOWrapper(source, encoding="utf-8-sig", newline=""), strict=True)
    try:
        head = next(reader, None)
        if not head:
            raise ValueError("the file has no rows")
        if len(set(head)) < len(head):
            raise ValueError("the header repeats a column")
        if lacking := [c for c in wanted if c not in head]:
            raise ValueError(f"the header lacks {', '.join(lacking)}")
        places = [head.index(c) for c in wanted]
        for row in reader:
            if len(row) != len(head):
                raise ValueError(f"line {reader.line_num} has {len(row)} cells of {len(head)}")
            yield [row[i] for i in places]
    except (ValueError, csv.Error) as error:
        raise ValueError(f"{where}: {error}") from error


def scan_zip(spark: SparkSession, path: str, columns: dict[str, str], *, date: str | None = None, start: str = "", end: str = "\U0010ffff", members: str = "*.csv", batch: int = 4096) -> DataFrame:
    """Rows of the CSV members of all zip files under ``path``, as exact strings: ``columns`` gives the name in the file and the new one.

    Spark lists the files, tasks read their directories, and the members are dealt anew, so
    that each is streamed by one task (its compression has no other order) in batches. With
    ``date`` only rows with ``start <= first ten characters < end`` leave the reader. As
    strict as ``scan_csv``: UTF-8 (a mark at the start is allowed), one header, equal numbers
    of cells, closed quotes; a fault fails the read and names member and reason. Members
    that do not match ``members`` are left out; one with a header alone has no rows.
    """
    with stores.listing_by_cores(spark):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path).select("path")

    def directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for zips in batches:
            for uri in zips.column("path").to_pylist():
                store, inner = stores.opened(uri)
                with store.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
                    names = [m.filename for m in archive.infolist() if not m.is_dir() and fnmatch(m.filename, members)]
                yield pa.RecordBatch.from_pydict({"path": [uri] * len(names), "member": names}, schema=pa.schema([("path", pa.string()), ("member", pa.string())]))

    names = list(columns.values())
    schema = pa.schema([(n, pa.string()) for n in names])
    wanted = dict.fromkeys([*columns, *([date] if date else [])], "")
    at = list(wanted).index(date) if date else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for found in batches:
            for uri, member in zip(found.column("path").to_pylist(), found.column("member").to_pylist(), strict=True):
                store, inner = stores.opened(uri)
                with store.open_input_file(inner) as file, zipfile.ZipFile(file) as archive, archive.open(member) as source:
                    held: list[list[str]] = []
                    for row in _rows(source, f"{inner.rsplit('/', 1)[-1]}/{member}", wanted):
                        if at is None or start <= row[at][:10] < end:
                            held.append(row[: len(names)])
                        if len(held) == batch:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=schema)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=schema)

    found = stores.spread(listed, "path").mapInArrow(directory, "path string, member string")
    return stores.spread(found, "path", "member").mapInArrow(read, ", ".join(f"`{n}` string" for n in names))
