"""Text scalars as column expressions: keys, trimming, pieces, rules, features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that count as white space when a text is trimmed.
WS = r"\x09-\x0D\x1C-\x20\x85\xA0  -     　"
# The same characters one by one.
WS_CHARS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Where sentences end: marks before white space, line breaks, and marks of scripts without spaces.
SENTENCE_END = rf"(?<=[.!?])[{WS}]+|[\r\n]+|(?<=[।。！？؟۔])[{WS}]*"


def trim_ws(text: Column) -> Column:
    """A text without white space at its ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def is_blank(text: Column) -> Column:
    """Whether nothing but white space is there; null counts as blank."""
    return ~F.coalesce(text, F.lit("")).rlike(rf"[^{WS}]")


def text_key(text: Column) -> Column:
    """SHA-256 of the bytes of a text: equal bytes share a key."""
    return F.sha2(text, 256)


def order_key(seed: str, key: Column) -> Column:
    """The hash that orders rows by seed: it depends on seed and id alone."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def json_string(text: Column) -> Column:
    """A text as a compact JSON string: only quotes, backslashes and control characters are escaped."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    for code in range(32):
        out = F.replace(out, F.lit(chr(code)), F.lit(short.get(code, f"\\u{code:04x}")))
    return F.concat(F.lit('"'), out, F.lit('"'))


def row_sha(*fields: Column) -> Column:
    """SHA-256 of the fields as a compact JSON array of strings; null fields are empty."""
    parts = [json_string(F.coalesce(f.cast("string"), F.lit(""))) for f in fields]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")), 256)


def canonical_json(**fields: Column) -> Column:
    """An object of strings with sorted keys, no spaces."""
    parts = [F.concat(F.lit(f'"{k}":'), json_string(fields[k].cast("string"))) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def has_content(part: Column) -> Column:
    """Whether a part holds a letter or digit."""
    return part.rlike(r"[\p{L}\p{N}]")


def pieces(text: Column, parts: Column | None = None) -> Column:
    """Sentences that hold a letter or digit, each an exact part of the text; a text with none is one piece, trimmed.

    ``parts`` is the text as split already. The sentences are bound to a name, so that the text is split once.
    """
    content = F.transform(F.filter(F.split(text, SENTENCE_END, -1) if parts is None else parts, has_content), trim_ws)
    return F.get(F.transform(F.array(content), lambda c: F.when(F.size(c) > 0, c).otherwise(F.array(trim_ws(text)))), 0)


def piece_count(text: Column) -> Column:
    """How many ``pieces`` a text has."""
    return F.greatest(F.lit(1), F.size(F.filter(F.split(text, SENTENCE_END, -1), has_content)))


def part_tags(parts: Column) -> Column:
    """Pieces by tag: part_aa, part_ab and on; past part_zz the first letter is the code
    point that follows z, and so on, surrogates left out."""

    def letter(n: Column) -> Column:
        code = F.when(n < 0xD800 - 97, n + 97).otherwise(n + 97 + 2048)
        return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")

    tags = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.concat(F.lit("part_"), letter(F.floor(i / 26)), letter(i % 26)))
    return F.map_from_arrays(tags, parts)


def feature_pattern(features: Sequence[str]) -> str:
    """One pattern for whole words or phrases, a plural s allowed, longer ones first."""
    listed = sorted(features, key=len, reverse=True)
    return "(?<=^|[^a-z0-9])(" + "|".join(rf"\Q{f}\E" for f in listed) + ")s?(?=$|[^a-z0-9])"


def entities(text: Column, features: Sequence[str]) -> Column:
    """The features a text names, once each, in order of first appearance."""
    if not features:
        return F.array().cast("array<string>")
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(feature_pattern(features)), F.lit(1)))


def first_match(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The label of the first rule with a keyword in the lower-cased text."""
    low, out = F.lower(text), None
    for label, keywords in rules:
        hit = F.lit(False)
        for keyword in keywords:
            hit = hit | F.contains(low, F.lit(keyword))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def word_list(text: Column) -> Column:
    """Lower-cased words: letters, with an apostrophe inside."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+'?\p{L}*"), F.lit(0))


def lang_bucket(text: Column, markers: Sequence[str], stop: Sequence[str]) -> Column:
    """no_letters, non_english, ascii_unsure, english or short, from letters, marker words and stop words."""
    found = word_list(text)
    letters = F.array_join(found, "")
    other = F.length(F.regexp_replace(letters, "[a-z]", "")) / F.greatest(F.length(letters), F.lit(1))
    held = lambda words: F.arrays_overlap(found, F.array(*map(F.lit, words)))
    foreign = (other > 0.3) | ((F.size(found) >= 2) & held(markers))
    return F.when(F.length(letters) == 0, "no_letters").when(foreign, "non_english").when((F.size(found) >= 4) & ~held(stop), "ascii_unsure").when(F.size(found) >= 4, "english").otherwise("short")


def scrub(text: Column, key: str = "") -> Column:
    """A text as it may be saved: a key, if given, and every bearer token taken out."""
    # Fixed value: the form of a bearer token, which must match.
    kept = F.replace(text, F.lit(key), F.lit("[removed]")) if key else text
    return F.regexp_replace(kept, r"Bearer\s+[A-Za-z0-9._~+/=-]+", "Bearer [removed]")


def token_estimate(size_bytes: Column) -> Column:
    """Tokens that so many bytes may take: ten for 24 bytes, rounded up, one at least."""
    return F.greatest(F.lit(1), F.ceil(size_bytes * 10 / 24)).cast("long")


def shuffled_options(options: Sequence[str], text: Column, salt: str) -> Column:
    """Options in an order that salt and text decide."""
    keyed = F.transform(F.array(*map(F.lit, options)), lambda o: F.struct(F.sha2(F.concat(F.lit(f"{salt}:"), text, F.lit(":"), o), 256).alias("h"), o.alias("o")))
    return F.transform(F.array_sort(keyed), lambda x: x["o"])


def hash_mod(salt: str, key: Column, k: int) -> Column:
    """A number from 0 below ``k``: the first eight hex digits of SHA-256 of salt and key, modulo k."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), key), 256), 1, 8), 16, 10).cast("long"), F.lit(k))
