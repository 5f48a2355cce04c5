"""DuckDB SQL of the operators that it can express, from the same parameters."""

from __future__ import annotations

from tallyloom.llm.licenses import NOTICES, PHRASES


def _nibbles() -> list[int]:
    """The table of CRC-32 for four bits at a time."""
    out = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        out.append(i)
    return out


def crc32(text: str) -> str:
    """The checksum of a text's UTF-8 bytes: its hex digits, the low one of each byte first."""
    digit = f"strpos('0123456789ABCDEF', substr(hex({text}), i, 1)) - 1"
    turned = f"list_transform(range(1, 1 + length(hex({text}))), lambda p: CASE WHEN p % 2 = 1 THEN p + 1 ELSE p - 1 END)"
    digits = f"list_transform({turned}, lambda i: CAST({digit} AS UBIGINT))"
    return f"xor(list_reduce({digits}, lambda c, d: xor(c >> 4, list_extract(CAST({_nibbles()} AS UBIGINT[]), CAST(xor(c, d) & 15 AS BIGINT) + 1)), 4294967295::UBIGINT), 4294967295::UBIGINT)"


SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
kept AS (SELECT run, count(*) AS times, {crc32("id || ':' || run")} AS h FROM runs WHERE length(run) >= 7 GROUP BY id, run),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM kept)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (SELECT DISTINCT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
  UNION SELECT a.word, b.word, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
path AS (
  SELECT word, word AS root FROM found
  UNION ALL SELECT p.word, f.form FROM path p JOIN found f ON p.root = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT p.word, p.root FROM path p JOIN found f ON p.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM found JOIN roots USING (word)
"""


def licenses(share: float = 0.75, least: float = 0.25) -> str:
    """The scan for licenses, with grams as texts instead of hashes."""
    rows = []
    for number, t in enumerate((*PHRASES, *NOTICES)):
        words = [w.decode() for w in t.words]
        rows += [f"({number}, '{t.label}', {str(t.phrase).lower()}, {t.k}, {len(words)}, {i}, '{' '.join(words[i : i + t.k])}')" for i in range(len(words) - t.k + 1)]
    return rf"""
WITH known(template, label, phrase, k, words, "at", gram) AS (VALUES {", ".join(rows)}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS held FROM documents),
seen AS (SELECT r, held, unnest(range(len(held))) AS pos FROM docs),
grams AS (
  SELECT r, pos, 2 AS k, held[pos + 1] || ' ' || held[pos + 2] AS gram FROM seen WHERE pos + 2 <= len(held)
  UNION ALL SELECT r, pos, 4, held[pos + 1] || ' ' || held[pos + 2] || ' ' || held[pos + 3] || ' ' || held[pos + 4] FROM seen WHERE pos + 4 <= len(held)),
votes AS (SELECT r, template, label, phrase, known.k, words, "at", pos - "at" AS diagonal FROM grams JOIN known ON grams.gram = known.gram AND grams.k = known.k),
lines AS (SELECT DISTINCT r, template, phrase, words, diagonal FROM votes),
steps AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > greatest(1, words // 8) THEN 1 ELSE 0 END AS apart FROM lines),
spans AS (SELECT r, template, diagonal, CASE WHEN phrase THEN diagonal ELSE sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) END AS span FROM steps),
under AS (
  SELECT r, template, label, phrase, words, span, min("at" + diagonal) AS start, max("at" + diagonal + k) AS stop, count(DISTINCT "at") AS n_grams, max(k) AS k, list_distinct(flatten(list(range("at", "at" + k)))) AS places
  FROM votes JOIN spans USING (r, template, diagonal) GROUP BY r, template, label, phrase, words, span),
rated AS (
  SELECT *, phrase AND n_grams = words - k + 1 AS stands, NOT phrase AND len(places) >= {share} * words AND len(places) >= {share} * (stop - start) AS holds,
    CASE WHEN NOT phrase AND len(places) >= {least} * words THEN CAST(len(places) AS DOUBLE) / words END AS ratio FROM under),
texts AS (
  SELECT r, count(*) FILTER (stands) AS n_base, min(start) FILTER (stands) AS first_word, max(start) FILTER (stands) AS last_word, max(ratio) AS most,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (stands) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (stands OR holds) AS labels
  FROM rated GROUP BY r)
SELECT doc_id, CAST(len(held) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(greatest(CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END, coalesce(most, 0.0)) AS DOUBLE) AS score
FROM docs LEFT JOIN texts USING (r)
"""
