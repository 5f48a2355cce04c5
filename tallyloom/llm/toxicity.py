"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is a logistic function of its words' weights; a document's is the
noisy-or of its sentences, the chance that at least one offends. The weights are fitted
to the documents' labels through that, so the sentences to blame come out without ever
having been labelled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Weights of words, and the bias of a sentence."""

    weights: dict[str, float]
    bias: float

    def judge(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The score of a text, and start, end (code points) and score of each sentence
        that has a weighted word; others have the bias alone. A text without sentences
        counts as one."""
        get, found, plain = self.weights.get, [], 0
        low = text.lower()
        low = low if len(low) == len(text) else "".join(x.lower() if len(x.lower()) == 1 else x for x in text)
        for match in SENTENCE.finditer(low):
            known = [w for w in map(get, WORD.findall(match[0])) if w is not None]
            if known:
                found.append((match.start(), match.end(), 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(known)))))))
            else:
                plain += 1
        plain = plain if found else max(plain, 1)
        clean = sum(math.log1p(-min(x, 1 - 1e-12)) for _, _, x in found)
        return -math.expm1(clean + plain * math.log1p(-1 / (1 + math.exp(-self.bias)))), found


def fit(docs: list[tuple[str, int]], *, vocabulary: int = 2048, least: int = 3, rounds: int = 400, penalty: float = 1e-3, rate: float = 0.1) -> Model:
    """A model of labelled texts, by gradient descent (Adam) on the noisy-or's log-loss.

    Words that ``least`` documents have and that tell most about the label, by the
    log-likelihood ratio, become features; ``vocabulary`` bounds them.
    """
    if not docs:
        return Model({}, -4.0)
    labels = np.array([label for _, label in docs], float)
    counts: dict[str, list[int]] = {}
    for text, label in docs:
        for word in set(WORD.findall(text.lower())):
            counts.setdefault(word, [0, 0])[label] += 1
    positive, n = labels.sum(), len(labels)
    if not 0 < positive < n:
        return Model({}, 4.0 if positive else -8.0)

    def told(pair: list[int]) -> float:
        without, with_ = pair
        df, out = without + with_, 0.0
        for seen, total, share in ((with_, df, positive / n), (without, df, 1 - positive / n), (positive - with_, n - df, positive / n), (n - positive - without, n - df, 1 - positive / n)):
            if seen > 0 and total:
                out += seen * np.log(seen / total / share)
        return out

    frequent = sorted(((told(v), w) for w, v in counts.items() if sum(v) >= least), reverse=True)[:vocabulary]
    index = {w: i for i, (_, w) in enumerate(sorted(frequent, key=lambda x: x[1]))}
    sentence_of, word_of, doc_of = [], [], []
    for d, (text, _) in enumerate(docs):
        found = SENTENCE.findall(text.lower()) or [""]
        for sentence in found:
            ids = [index[w] for w in WORD.findall(sentence) if w in index]
            word_of += ids
            sentence_of += [len(doc_of)] * len(ids)
            doc_of.append(d)
    sentence_of, word_of, doc_of = np.array(sentence_of, np.int64), np.array(word_of, np.int64), np.array(doc_of)
    theta = np.zeros(len(index) + 1)
    theta[-1] = -4.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(sentence_of, theta[word_of], len(doc_of))
        p = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-12, 1 - 1e-9)
        clean = np.bincount(doc_of, np.log1p(-p), n)
        toxic = np.clip(-np.expm1(clean), 1e-9, 1)
        # d loss / d log(1 - p of a sentence): 1 for label 0; -(1 - toxic) / toxic for label 1
        outer = np.where(labels > 0, -(1 - toxic) / toxic, 1.0)[doc_of] * p
        grad = np.append(np.bincount(word_of, outer[sentence_of], len(index)), outer.sum()) / n
        grad[:-1] += penalty * theta[:-1] / np.sqrt(n)
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model({w: float(theta[i]) for w, i in index.items()}, float(theta[-1]))


def held_out(key: str) -> Column:
    """Whether a row is kept out of the fit: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, key: str, text: str, most: int) -> list[tuple[str, int]]:
    """Texts and labels of at most about ``most`` labelled documents that are not held out.

    They are those whose id hashes lowest; a document with several labels is toxic if
    one says so, and of several texts with one id the least by hash counts. Only ids and
    labels of the sample are broadcast, so texts of other documents do not move, and
    repeated ids are reduced before anything goes to the driver.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max("toxic").alias("toxic"))
    share = most / max(known.count(), 1)
    picked = known
    if share < 1:
        picked = known.filter(F.xxhash64(F.col(key), F.lit("sample")).cast("double") < (share - 0.5) * 2.0**64)
    whole = F.coalesce(F.col(text), F.lit(""))
    met = docs.select(key, whole.alias("__text")).join(F.broadcast(picked), key)
    rows = met.groupBy(key).agg(F.min(F.struct(F.xxhash64("__text"), "__text"))["__text"], F.first("toxic")).drop(key).collect()
    return sorted((r[0], int(r[1] > 0)) for r in rows)


def score_toxicity(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", most: int = 8000, blame: float = 0.5) -> DataFrame:
    """A row a document: ``doc_id``, ``held_out``, ``score``, ``predicted`` and
    ``offending`` (start, end and score of the sentences that score ``blame`` or more).

    The model is fitted on a bounded sample of labelled documents (``most``); every whole
    text is scored, from its words alone. A null text is empty and gets the score of one
    empty sentence. Repeated rows get equal scores; without usable labels all scores are
    low; an empty table gives an empty result.
    """
    model = fit(labelled_sample(docs, labels, key=key, text=text, most=most))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for whole in batch.column(2):
                score, found = model.judge(whole.as_py())
                scores.append(score)
                spans.append([{"start": a, "end": b, "score": x} for a, b, x in found if x >= blame])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32()), pa.array(spans, span)], ["doc_id", "held_out", "score", "predicted", "offending"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.coalesce(F.col(text), F.lit("")))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int, offending array<struct<start: long, end: long, score: double>>")
