"""License scans by diagonal voting: word k-grams meet template positions, offsets gather votes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.shared import cut

#: What each byte of a text counts as: A-Z as a-z, other ASCII characters that are no digits or letters as spaces.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LONGEST = 4
#: An odd factor of the rolling hash.
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def license_words(raw: bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in small letters."""
    return raw.translate(BYTES).split()


@dataclass(frozen=True)
class Template:
    """A text that stands for ``label``. A ``phrase`` counts wherever it stands whole; of
    other templates a share of the words is enough."""

    label: str
    text: str
    phrase: bool = False

    @cached_property
    def words(self) -> list[bytes]:
        return license_words(self.text.encode())

    @property
    def k(self) -> int:
        """Words a gram: two where there are few, so that a changed word costs few votes."""
        return 2 if self.phrase or len(self.words) < 20 else LONGEST


# Phrases that count wherever they stand, and the published wording of common licenses and notices.
PHRASES = (
    Template("gpl", "gnu general public license", phrase=True),
    Template("apache", "apache license", phrase=True),
    Template("cc-by", "cc by", phrase=True),
    Template("mit", "mit license", phrase=True),
)
NOTICES = (
    Template("mit", "Released under the MIT License."),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
)

GRAMS = "two long, four long, template int, k int, words int, at int"


def word_hashes(raw: bytes, piece: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash a word of a text; words are held a piece of the text at a time."""
    flat, at, parts = raw.translate(BYTES), 0, [np.zeros(0, np.uint64)]
    while at < len(flat):
        end = flat.find(b" ", at + piece)
        end = len(flat) if end < 0 else end
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, flat[at:end].split()), np.uint64))
        at = end
    return np.concatenate(parts)


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """At each word the rolling hash of it and the next ``k`` - 1 (zeros after the end)."""
    padded, out = np.concatenate([hashes, np.zeros(k - 1, np.uint64)]), np.zeros(len(hashes), np.uint64)
    for i in range(k):
        out = out * FACTOR + padded[i : i + len(hashes)]
    return out


def gram_rows(templates: tuple[Template, ...]) -> list[tuple]:
    """A row (``GRAMS``) a k-gram of a template, and one of template -1 for the ends of texts."""
    if any(len(t.words) < 2 for t in templates):
        raise ValueError("templates have two words or more")
    rows = [(-1, -1, -1, LONGEST, 0, 0)]
    for n, t in enumerate(templates):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, t.words), np.uint64)
        two, four = (rolled(hashes, k).view(np.int64).tolist() for k in (2, LONGEST))
        rows += [(two[i], four[i], n, t.k, len(t.words), i) for i in range(len(t.words) - t.k + 1)]
    return rows


def windows(docs: DataFrame, *, key: str, text: str, most: int = 1 << 17) -> DataFrame:
    """``id``, ``text_hash``, ``pos``, ``two`` and ``four``: the rolling hashes at every word of
    every text, and a row with -1 at its end, whose ``pos`` is the number of words."""

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held, n = [], [], [], 0
            end = np.full(1, -1, np.int64)
            for row, x in enumerate(batch.column(2)):
                hashes = word_hashes(x.as_py())
                held.append([np.arange(len(hashes) + 1), *(np.concatenate([rolled(hashes, k).view(np.int64), end]) for k in (2, LONGEST))])
                ids.append(np.full(len(hashes) + 1, row))
                n += len(hashes) + 1
                if n >= most or row == batch.num_rows - 1:
                    at = pa.array(np.concatenate(ids))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(np.concatenate(c)) for c in zip(*held, strict=True))], ["id", "text_hash", "pos", "two", "four"])
                    ids, held, n = [], [], 0

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(whole).alias("text_hash"), whole.cast("binary").alias("raw"))
    return rows.mapInArrow(emitted, "id long, text_hash long, pos long, two long, four long")


def votes(docs: DataFrame, templates: tuple[Template, ...], *, key: str, text: str) -> DataFrame:
    """``id``, ``text_hash``, ``template``, ``k``, ``words``, ``at`` (in the template) and
    ``pos`` (in the text) of all k-grams of texts whose hashes are those of templates.

    Every document comes out with template -1 and its number of words as ``pos``. The
    templates are broadcast as long as they have at most 200,000 grams.
    """
    rows = gram_rows(templates)
    known = docs.sparkSession.createDataFrame(rows, GRAMS).withColumnRenamed("four", "all_four")
    if len(rows) <= 200_000:
        known = F.broadcast(known)
    seen = windows(docs, key=key, text=text)
    return seen.join(known, "two").filter("k = 2 OR four = all_four").select("id", "text_hash", "template", "k", "words", "at", "pos")


def verified(spans: DataFrame, docs: DataFrame, templates: tuple[Template, ...], *, key: str, text: str, most: int = 200_000) -> DataFrame:
    """``id``, ``text_hash``, ``template``, ``k``, ``words``, ``diagonals`` of spans, with only those
    places left whose words are the template's.

    ``diagonals`` are (diagonal, ats). Spans with at most ``most`` grams altogether are broadcast, so that no
    text moves; more of them are joined by a shuffle.
    """

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, found in zip(batch.column("raw"), batch.column("spans"), strict=True):
                words, kept = license_words(raw.as_py()), []
                for span in found.as_py():
                    t, k = templates[span["template"]].words, span["k"]
                    for x in span["diagonals"]:
                        d = x["diagonal"]
                        x["ats"] = [a for a in x["ats"] if words[a + d : a + d + k] == t[a : a + k]]
                    kept.append(span)
                out.append(kept)
            kind = batch.schema.field("spans").type
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array(out, kind)], ["id", "text_hash", "spans"])

    one = cut(spans.groupBy("id", "text_hash").agg(F.collect_list(F.struct("template", "k", "words", "diagonals")).alias("spans")))
    size = one.agg(F.sum(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.aggregate(s["diagonals"], F.lit(0).cast("long"), lambda m, x: m + F.size(x["ats"]) + 1)))).first()[0]
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("hash"), whole.cast("binary").alias("raw"))
    wanted = F.broadcast(one) if (size or 0) <= most else one
    met = texts.join(wanted, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash"))).select("id", "text_hash", "raw", "spans")
    shape = "id long, text_hash long, spans array<struct<template:int,k:int,words:int,diagonals:array<struct<diagonal:bigint,ats:array<int>>>>>"
    done = met.mapInArrow(checked, shape).groupBy("id", "text_hash").agg(F.first("spans").alias("spans"))  # of rows that repeat, one
    return done.select("id", "text_hash", F.explode("spans").alias("s")).select("id", "text_hash", "s.*")


def scan_licenses(docs: DataFrame, *, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES, share: float = 0.75, least: float = 0.25, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a document: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` and ``spans``.

    Rolling hashes of all words of a text are joined to the templates' positions; the
    difference of the two places is a diagonal. A phrase stands where all its grams vote
    for one diagonal (the base). Of a notice, diagonals that an eighth of its words or less (one
    at least) parts are merged, so that a few words more or less do not split it. Spans whose
    grams cover ``least`` of a notice are verified: the words themselves are compared,
    and those under equal grams are to be ``share`` of the template and of the span.
    ``spans`` (start, end: words, end exclusive, label, share) are those of such notices;
    ``score`` is the largest verified share of a notice from ``least`` up, and at least 0.5 where a
    phrase stands.

    Null, empty and blank texts have no words and score 0; equal texts score alike and
    rows repeated in full are scanned as one and come back as often; very long texts
    are read whole, and a diagonal gathers at most a template; a null doc_id stays null;
    other columns are not read; an empty table gives no rows.
    """
    templates, first = (*phrases, *notices), len(phrases)
    by = ["id", "text_hash", "template", "k", "words"]
    met = votes(docs, templates, key=key, text=text)
    diagonals = cut(met.groupBy(*by, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("ats"), F.count("*").alias("times")))
    ends = diagonals.filter("template < 0").select("id", "text_hash", F.col("times").alias("copies"), F.col("diagonal").alias("n_words"))

    def coverage(ats: str) -> F.Column:
        return F.size(F.array_distinct(F.flatten(F.transform(ats, lambda i: F.sequence(i, i + F.col("k") - 1)))))

    grouped = Window.partitionBy(*by).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(grouped) > F.greatest(F.lit(1), F.floor(F.col("words") / 8))
    notice = F.col("template") >= first
    span = F.when(notice, F.sum(F.coalesce(apart.cast("int"), F.lit(0))).over(grouped)).otherwise(F.col("diagonal"))
    merged = diagonals.filter("template >= 0").withColumn("span", span).groupBy(*by, "span").agg(F.collect_list(F.struct("diagonal", "ats")).alias("diagonals"))
    every = F.array_distinct(F.flatten("diagonals.ats"))
    likely = merged.withColumn("every", every).filter(F.when(notice, coverage("every") >= least * F.col("words")).otherwise(F.size("every") == F.col("words") - F.col("k") + 1))
    sure = verified(likely, docs, templates, key=key, text=text).withColumn("diagonals", F.filter("diagonals", lambda x: F.size(x["ats"]) > 0)).withColumn("every", every)
    start = F.array_min(F.transform("diagonals", lambda x: x["diagonal"] + F.array_min(x["ats"])))
    end = F.array_max(F.transform("diagonals", lambda x: x["diagonal"] + F.array_max(x["ats"]))) + F.col("k")
    rated = sure.select("id", "text_hash", notice.alias("notice"), "words", coverage("every").alias("covered"), start.alias("start"), end.alias("end"), F.element_at(F.array(*(F.lit(t.label) for t in templates)), F.col("template") + 1).alias("label"))
    ratio = F.col("covered") / F.col("words")
    stands = ~F.col("notice") & (F.col("covered") == F.col("words"))
    holds = F.col("notice") & (ratio >= share) & (F.col("covered") >= share * (F.col("end") - F.col("start")))
    per_text = rated.groupBy("id", "text_hash").agg(
        F.count(F.when(stands, 1)).alias("n_base"), F.min(F.when(stands, F.col("start"))).alias("first_word"), F.max(F.when(stands, F.col("start"))).alias("last_word"),
        F.collect_set(F.when(stands, F.col("label"))).alias("base"), F.collect_set(F.when(holds, F.col("label"))).alias("more"), F.max(F.when(F.col("notice") & (ratio >= least), ratio)).alias("most"),
        F.sort_array(F.collect_list(F.when(holds, F.struct("start", "end", "label", ratio.alias("share"))))).alias("spans"),
    )
    one = ends.unionByName(per_text, allowMissingColumns=True).groupBy("id", "text_hash").agg(*(F.max(c).alias(c) for c in ("copies", "n_words", "n_base", "first_word", "last_word", "base", "more", "most", "spans")))
    some = lambda c: F.coalesce(c, F.array())
    listed = lambda labels: F.array_join(F.array_sort(labels), ",")
    score = F.greatest(F.when(F.col("n_base") > 0, 0.5).otherwise(0.0), F.coalesce("most", F.lit(0.0)))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint,label:string,share:double>>"))
    out = one.select(F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", listed(some("base")).alias("base_labels"), listed(F.array_union(some("base"), some("more"))).alias("labels"), score.alias("score"), spans.alias("spans"), F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return out.drop("copy")
