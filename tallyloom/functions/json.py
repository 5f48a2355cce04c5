"""Strict JSON: a scanner with a stack of its own, so that depth has no limit."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGN, _TEXT, _NUMBER, _WORD, _ODD = range(1, 6)
_TOKEN = re.compile(
    r'[ \t\r\n]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null)|(NaN|-?Infinity))',
)
_CLOSES = {"}": "{", "]": "["}


def fault(text: str | None) -> str | None:
    """Why a text is not one strict JSON object: ``not_json``, ``not_finite`` (NaN, Infinity),
    ``repeated_key`` (as unescaped, in one object at any depth) or ``not_object``; None if it is one."""
    if text is None:
        return "not_json"
    open_: list[str] = []
    keys: list[set[str]] = []
    want, at, top, twice, odd = "value", 0, None, False, False
    while token := _TOKEN.match(text, at):
        at, kind, found = token.end(), token.lastindex, token[token.lastindex]
        top = top or found
        if want == "next":
            if found == "," and open_:
                want = "key" if open_[-1] == "{" else "value"
            elif open_ and _CLOSES.get(found) == open_[-1] and kind == _SIGN:
                keys.pop() if open_.pop() == "{" else None
            else:
                return "not_json"
        elif want == "colon":
            if found != ":" or kind != _SIGN:
                return "not_json"
            want = "value"
        elif want.startswith("key"):
            if kind == _TEXT:
                name = json.loads(found)
                twice |= name in keys[-1]
                keys[-1].add(name)
                want = "colon"
            elif found == "}" and want == "key or end":
                open_.pop()
                keys.pop()
                want = "next"
            else:
                return "not_json"
        elif kind == _SIGN and found in "{[":
            open_.append(found)
            if found == "{":
                keys.append(set())
            want = "key or end" if found == "{" else "value or end"
        elif kind == _SIGN:
            if found != "]" or want != "value or end":
                return "not_json"
            open_.pop()
            want = "next"
        else:
            odd |= kind == _ODD
            want = "next"
    if open_ or want != "next" or text[at:].strip(" \t\r\n"):
        return "not_json"
    return "not_finite" if odd else "repeated_key" if twice else None if top == "{" else "not_object"


def json_fault(text: Column) -> Column:
    """``fault`` of a column; ``not_utf8`` where its bytes are no UTF-8."""

    @F.pandas_udf("string")
    def faults(texts: pd.Series) -> pd.Series:
        return pd.Series([fault(x) for x in texts], dtype=object)

    return F.when(~F.is_valid_utf8(text), "not_utf8").otherwise(faults(F.make_valid_utf8(text)))
