"""Encoding, packing, token files and vector search against the libraries and brute force."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyloom.llm.ann import Codebooks, nearest
from tallyloom.llm.encode import Encoder, encoder
from tallyloom.llm.packing import cutting_plan, pack_documents, token_pieces
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.tokenbin import pack, read_tokens, unpack, write_tokens

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
TEXTS = [None, "", " ", "\n\n  x", "Hello, world! it's", "a b　c", "<|endoftext|> <|startoftext|>", "é ß ﬁ İstanbul ſ", "😀👍🏽 日本語 عربى", "x" * 5000, "word " * 3000, "1234567 89,0.5", "tabs\tand\r\nlines\x0b\x0c\x85 end ", "don't I'll we've", "   odd​", "ΑΣ ΣΑΣ."]


def library(kind: str):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(FILES[kind]))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_encoder_equals_the_library(kind):
    own, theirs = encoder(public_tokenizers.path(FILES[kind]), kind), library(kind)
    for _ in range(2):  # pieces are remembered the second time
        for text in TEXTS:
            assert own(text or "").tolist() == theirs(text or ""), text


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_encoder_on_any_text(kind):
    own, theirs = encoder(public_tokenizers.path(FILES[kind]), kind), library(kind)
    marks = st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x1f\x85    　.,;:!?'’-_()<|>/0129aAbZéßÀÿſİ日😀́‍"))

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(max_size=40), st.text(alphabet=marks, max_size=60)))
    def check(text: str) -> None:
        assert own(text).tolist() == theirs(text)

    check()


def documents(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)


def test_pieces_cover_each_document_and_fill_sequences(spark):
    docs, theirs = documents(spark), library("byte")
    path = public_tokenizers.path(FILES["byte"])
    whole = {i: [*theirs(t or ""), 0] for i, t in enumerate(TEXTS)} | {None: [*theirs("no id"), 0]}
    rows = pack_documents(docs, path, kind="byte", end_id=0, capacity=1024, grain=128).collect()
    starts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(whole[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and len(ids) == r["length"]
        starts[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, cuts in starts.items():
        times = 2 if doc == 3 else 1
        assert sum(n for _, n in cuts) == times * len(whole[doc])
        assert sorted(sorted(set(cuts))[1:]) == sorted((a + n) for a, n in sorted(set(cuts))[:-1]) or [a for a, _ in sorted(set(cuts))[1:]] == [a + n for a, n in sorted(set(cuts))[:-1]]
    for held in sequences.values():
        held.sort()
        assert held[0][0] == 0 and [a for a, _ in held[1:]] == [a + n for a, n in held[:-1]] and sum(n for _, n in held) <= 1024
    assert pack_documents(docs.limit(0), path, kind="byte", end_id=0, capacity=1024, grain=128).count() == 0
    some = token_pieces(docs, path, kind="byte", end_id=0, capacity=1024, grain=128, ids=True).filter("doc_id = 10 AND start = 0").first()
    assert some["ids"] == whole[10][: some["length"]]


def test_cutting_plan_places_every_piece_with_little_padding():
    draw = np.random.default_rng(0)
    lengths = np.unique(draw.integers(1, 1024, 120))
    demand = draw.integers(1, 4000, len(lengths))
    plan = cutting_plan(lengths, demand, 1024)
    placed = defaultdict(int)
    for many, pattern in plan:
        assert sum(size * n for size, n in pattern.items()) <= 1024
        for size, n in pattern.items():
            placed[size] += many * n
    assert placed == {int(a): int(n) for a, n in zip(lengths, demand, strict=True)}
    least = max(int(lengths @ demand) / 1024, int(demand[lengths > 512].sum()))  # no two over half a sequence share one
    assert sum(many for many, _ in plan) <= 1.01 * least + len(lengths)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=300))
def test_simple8b_round_trip(values):
    assert unpack(pack(np.array(values, np.uint64))).tolist() == values


def test_simple8b_packs_small_values():
    assert len(pack(np.zeros(60_000, np.uint64))) == 16 + 8 * 1000
    with pytest.raises(ValueError, match="Simple-8b"):
        unpack(b"nope")


def test_token_files_read_back_in_order(spark, tmp_path):
    docs, theirs = documents(spark), library("word")
    write_tokens(docs, str(tmp_path / "t"), public_tokenizers.path(FILES["word"]), kind="word", end_id=1, block=500)
    rows = sorted(read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 2, 3, 3, *range(4, len(TEXTS))]
    at = 0
    for r in rows:
        ids = [*theirs("no id" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""), 1]
        assert (r["start"], r["n_tokens"], r["ids"], r["ids_crc32"]) == (at, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    write_tokens(docs.limit(0), str(tmp_path / "e"), public_tokenizers.path(FILES["word"]), kind="word", end_id=1)
    assert read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_nearest_reaches_the_true_neighbours(spark):
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(40, 24))
    x = (centres[draw.integers(0, 40, 4000)] + 0.3 * draw.normal(size=(4000, 24))).astype(np.float32)
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(x)]
    odd = [(5000, None, ""), (5100, [0.0] * 24, ""), (5200, [float("nan")] * 24, ""), (5300, [1.0] * 23 + [None], ""), (None, [1.0] * 24, ""), (5400, [float("inf")] * 24, ""), (100, x[100].tolist(), "")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score string")
    got = defaultdict(list)
    for r in nearest(table, "id % 100 = 0", k=10, rows_block=512, queries_block=16).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 4000, 100))
    hits = 0
    for q, found in got.items():
        found.sort()
        far = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(1))
        far[q] = np.inf
        true = np.lexsort((np.arange(len(x)), far))[:10]
        assert [r for r, _, _ in found] == list(range(1, 11)) and all(abs(s - far[v]) < 1e-9 for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(true.tolist()))
    assert hits / (10 * len(got)) >= 0.95
    few = nearest(table.filter("vec_id in (0, 7, 100)"), "id % 100 = 0", k=10).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in few) == [(0, 7), (0, 100), (100, 0), (100, 7)]
    assert nearest(table.limit(0), "id % 100 = 0").count() == 0


def test_more_levels_leave_less():
    x = np.random.default_rng(7).normal(size=(800, 16)).astype(np.float32)
    left = []
    for levels in (1, 2, 4):
        books = Codebooks.fit(x, levels, 32)
        left.append(float(((x - books.decode(books.encode(x, 4))) ** 2).sum()))
    assert left[0] > left[1] > left[2]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_special_strings_get_the_ids_of_the_plain_library(kind):
    path = public_tokenizers.path(FILES[kind])
    own, plain = encoder(path, kind, specials=True), Tokenizer.from_file(path)
    for text in [*TEXTS, "end  <|endoftext|>\n\n x", "a,<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>"]:
        assert own(text or "").tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


class Counted:
    """A pattern that notes how many characters it is asked to cut."""

    def __init__(self, pattern):
        self.pattern, self.read = pattern, 0

    def findall(self, text):
        self.read += len(text)
        return self.pattern.findall(text)


def test_words_are_cut_and_encoded_once(monkeypatch):
    own, theirs, fresh = Encoder(public_tokenizers.path(FILES["word"]), "word"), library("word"), []
    own.pattern, encoded = Counted(own.pattern), own._encoded
    monkeypatch.setattr(own, "_encoded", lambda pieces: fresh.extend(pieces) or encoded(pieces))
    texts = ["Übung übung, ÜBUNG\n" * 500, "Word word WORD " * 500]
    assert [x.tolist() for x in own.stream(texts)] == [theirs(x) for x in texts]
    assert own.pattern.read < 50 and sorted(x for x in fresh if x.strip()) == [",", "word", "übung"]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_texts_encoded_together_equal_the_library(kind):
    path = public_tokenizers.path(FILES[kind])
    plain = Tokenizer.from_file(path)
    odd = ["", "H\u0331 h\u0331 I\u0307 K\u030c", "É\xa0È\x85µ ß ÿ", "a\x1cb\x1f c\0d", "1<|ENDOFTEXT|>2", "x <|endoftext|> y", "<|EndOfText|>\n", "ΑΣ Σ", " ", "it's IT'S Ça"]
    texts = [x or "" for x in [*TEXTS, *odd, *reversed(TEXTS)]]
    for chunk in (1, 100, 1 << 21):
        got = list(Encoder(path, kind, specials=True).stream(texts, chunk))
        assert [x.tolist() for x in got] == [plain.encode(x, add_special_tokens=False).ids for x in texts]


def test_queries_give_special_ids(spark, tmp_path):
    text = "one  <|endoftext|> two"
    spark.createDataFrame([(1, text, "en", "a", len(text))], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    for kind, end, name in (("byte", 0, "op4_pack_documents"), ("word", 1, "op10_token_files")):
        ids = [*Tokenizer.from_file(public_tokenizers.path(FILES[kind])).encode(text, add_special_tokens=False).ids, end]
        assert QUERIES[name](spark, str(tmp_path)).first()["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
