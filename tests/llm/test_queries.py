"""The queries themselves, over a table of odd rows, against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.sharding import jump
from tallyloom.llm.simhash import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: Names that the operators make: their columns in the input must neither crash nor win.
CLASHES = ("size", "shard", "slot", "secrets", "kept", "n_words", "base_failed", "fingerprint", "component_id", "length", "score", "target", "fence_symbols", "text_hash", "block")


def prose(seed: int, n: int) -> str:
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 400, n))


TEXTS = [
    None, "", " \t\n", "Two WORDS", prose(1, 90), prose(1, 90), prose(1, 90).upper(), prose(2, 30_000), "é😀 " + prose(3, 70), "password = hunter2hunter2 \"token\": 'abc' AKIA" + "A1" * 9 + " " + "0f" * 20 + " tail",
    "same line\n" * 30 + prose(4, 60), "again and again " * 40, "#$%& " * 60, "x=" * 3000 + "secret=" + "k" * 50,
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3 - 1], len(t or ""), *("clash",) * len(CLASHES)) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "no id " + prose(9, 60), "en", "a", 0, *("clash",) * len(CLASHES))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{path}/empty/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/empty/labels.parquet")
    return path


def rows_of(spark, folder, name: str) -> list:
    got = QUERIES[name](spark, str(folder)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([*range(len(TEXTS)), 4, 4, None]) or name.startswith("op4")
    return got


def text_of(row) -> str:
    return ("no id " + prose(9, 60)) if row["doc_id"] is None else TEXTS[row["doc_id"]] or ""


def test_shards(spark, folder):
    slots: dict[int, list[int]] = {}
    for r in rows_of(spark, folder, "op1_shard_documents"):
        raw = text_of(r).encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key") and r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(jump(np.arange(1000, dtype=np.uint64), 16)) == set(range(16))


def test_fingerprints(spark, folder):
    of: dict[str, set] = {}
    for r in rows_of(spark, folder, "op2_near_duplicates"):
        assert r["fingerprint"] == f"{simhash(text_of(r).encode(), 3) % (1 << 64):016x}"
        of.setdefault(r["fingerprint"], set()).add(r["component_id"])
    assert all(len(ids) == 1 for ids in of.values()) and of["0" * 16] == {0}


def test_secret_spans(spark, folder):
    for r in rows_of(spark, folder, "op6_find_secrets"):
        text, spans = text_of(r), []
        spans += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        shown = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, _, x, _ in spans) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest() and all(s in r["spans"].split(",") for s in shown.split(",") if s)


def test_toxicity_scores(spark, folder):
    for r in rows_of(spark, folder, "op7_score_toxicity"):
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == held


def test_quality_counts_and_base_rules(spark, folder):
    for r in rows_of(spark, folder, "op8_quality_rules"):
        words = WORD.findall(text_of(r))
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if many[w] > 1:
                covered |= {i, i + 1, i + 2}
        lines = [x for x in text_of(r).split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(words), sum(map(len, words)), len(covered), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r["kept"] and r["base_failed"])


def test_mix_columns(spark, folder):
    got, sizes = rows_of(spark, folder, "op9_mix_sources"), Counter()
    source = lambda r: "a" if r["doc_id"] is None else ["a", "b", None][r["doc_id"] % 3 - 1]
    for r in got:
        sizes[source(r)] += len(WORD.findall(text_of(r)))
    for r in got:
        assert r["size"] == len(WORD.findall(text_of(r))) and r["source_size"] == sizes[source(r)] and 0 <= r["taken"] <= 3 * r["size"] and 0 < r["target"] <= 3 * r["source_size"]


@pytest.mark.parametrize(("name", "file", "end"), [("op10_token_files", "word_bpe_49k.json", 1), ("op4_pack_documents", "byte_bpe_50k.json", 0)])
def test_token_checksums(spark, folder, name, file, end):
    plain = Tokenizer.from_file(public_tokenizers.path(file))
    seen = Counter()
    for r in rows_of(spark, folder, name):
        ids = [*plain.encode(text_of(r), add_special_tokens=False).ids, end]
        if name.startswith("op4"):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r["offset"] + r["length"] <= 1024
            seen[r["doc_id"]] += r["length"]
        else:
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert not seen or seen[4] == 3 * len([*plain.encode(TEXTS[4], add_special_tokens=False).ids, end])


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("op3", "op5"))))
def test_empty_tables(spark, folder, name):
    assert QUERIES[name](spark, f"{folder}/empty").count() == 0
