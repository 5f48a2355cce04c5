"""The strict scanner against the standard library's parser, at any depth, and line numbers over many splits."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.functions.json import fault
from tallyloom.sources import files

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x) | st.dictionaries(st.text(), x), max_leaves=12)


@settings(deadline=None)
@given(VALUES, st.booleans(), st.sampled_from([None, 1]))
def test_what_the_library_writes_is_fine(value, ascii_only, indent):
    want = None if isinstance(value, dict) else "not_object"
    assert fault(json.dumps(value, ensure_ascii=ascii_only, indent=indent)) == want


@settings(deadline=None, max_examples=400)
@given(st.dictionaries(st.text("ab", max_size=2), VALUES, min_size=1), st.data())
def test_broken_texts_are_refused_as_by_the_library(value, data):
    text = json.dumps(value)
    at = data.draw(st.integers(0, len(text) - 1))
    broken = text[:at] + data.draw(st.sampled_from(["", ",", "}", '"', "[", "x", "\\", "0", ":", "\x01"])) + text[at + 1 :]

    def pairs(found: list) -> dict:
        if len({k for k, _ in found}) < len(found):
            raise KeyError
        return dict(found)

    try:
        want = None if isinstance(json.loads(broken, object_pairs_hook=pairs), dict) else "not_object"
    except KeyError:
        want = "repeated_key"
    except ValueError:
        want = "not_json"
    got = fault(broken)
    assert got == want or {got, want} == {"repeated_key", "not_json"}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"a":1,"a":2}', "repeated_key"), ('{"a":1,"\\u0061":2}', "repeated_key"), ('{"a":{"x":1},"b":{"x":2}}', None), ('{"a":[{"c":1,"c":2}]}', "repeated_key"), ('{"a":NaN}', "not_finite"), ('{"a":-Infinity}', "not_finite"),
        ("[1]", "not_object"), ("3", "not_object"), ("", "not_json"), ("{}{}", "not_json"), ("{} x", "not_json"), ('{"a":01}', "not_json"), ("{'a':1}", "not_json"), ('{"a":1,}', "not_json"), ('{"a" 1}', "not_json"), ("[}", "not_json"), (None, "not_json"),
        ('{"a":' * 5000 + "1" + "}" * 5000, None), ('{"a":' * 5000 + '{"b":1,"b":2}' + "}" * 5000, "repeated_key"), ('{"a":' + "[" * 90_000 + "]" * 90_000 + "}", None), ('{"a":' * 5000 + "1" + "}" * 4999, "not_json"),
    ],
)
def test_faults(text, want):
    assert fault(text) == want


def test_lines_are_numbered_over_splits(spark, tmp_path):
    lines = [f'{{"a":"{"x" * (i % 37)}","b":{i}}}' if i % 100 != 41 else f'{{"a":{i}' for i in range(3000)]
    (tmp_path / "one.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.jsonl").write_bytes(b'{"a":"x"}\n{"a":"\xff"}\n\n{"a":1,"a":2}\n' + b'{"a":' * 300 + b"1" + b"}" * 300 + b"\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = {(r["file"], r["line"]): r["value"] for r in files.numbered_lines(spark, str(tmp_path)).filter("file = 'one.jsonl'").collect()}
        assert found == {("one.jsonl", i + 1): x for i, x in enumerate(lines)}
        bad = {(r["file"], r["line"], r["fault"]) for r in files.bad_lines(spark, str(tmp_path), "a string, b long").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert bad == {("one.jsonl", i + 1, "not_json") for i in range(41, 3000, 100)} | {("two.jsonl", 2, "not_utf8"), ("two.jsonl", 4, "repeated_key")}
