"""Quality rules with adaptive thresholds from mergeable sketches; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import cut, words

SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-Z\\xC0-\\xD6\\xD8-\\xDE]"
SPACES = r"[\x20\x09-\x0D]"


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def window_hashes(found: Column) -> Column:
    """A 64-bit hash of each 3-word window, in text order."""
    at = F.sequence(F.lit(1), F.greatest(F.size(found) - 2, F.lit(1)))
    hashes = F.transform(at, lambda i: F.xxhash64(F.get(found, i - 1), F.get(found, i), F.get(found, i + 1)))
    return F.when(F.size(found) < 3, F.array().cast("array<bigint>")).otherwise(hashes)


def sorted_windows(hashes: Column) -> Column:
    """Windows' hashes with their places, equal ones side by side; null if all differ."""
    differ = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(~differ, F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))


def repeated_places(windows: Column) -> Column:
    """Places of the windows that the text holds twice or more, in text order."""
    same = F.filter(windows, lambda x, i: x["h"].eqNullSafe(F.get(windows, i - 1)["h"]) | x["h"].eqNullSafe(F.get(windows, i + 1)["h"]))
    return F.array_sort(F.transform(same, lambda x: x["i"]))


def covered_words(places: Column) -> Column:
    """Words that windows at these places cover, each once."""
    each = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
    return F.coalesce(F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long")


def counts(docs: DataFrame, text: str = "text", repeats: bool = True) -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_capitals``, ``n_dup_lines``, ``n_lines`` and, if
    wanted, ``n_repeat_words`` of whole texts (null: none) to any columns; columns of these
    names are replaced."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"__words": words(F.col(text)), "__lines": lines})
    made = {
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(whole) - _found(whole, SPACES),
        "n_symbols": _found(whole, SYMBOLS),
        "n_capitals": _found(whole, CAPITALS),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
    }
    if not repeats:
        return out.withColumns(made).drop("__words", "__lines")
    out = out.withColumns(made | {"__w": window_hashes(F.col("__words"))}).drop("__words", "__lines")
    for step in (sorted_windows, repeated_places, covered_words):
        out = out.withColumn("__w", step(F.col("__w")))
    return out.withColumnRenamed("__w", "n_repeat_words")


def base_failed() -> Column:
    """Too few words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: What the adaptive rules look at: ratios of two counts.
RATIOS = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "capitals": ("n_capitals", "word_chars"), "word_length": ("word_chars", "n_words")}


def _ratio(name: str) -> Column:
    a, b = RATIOS[name]
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def fences(counted: DataFrame, *, groups: tuple[str, ...] = ("lang", "source"), reach: float = 6.0, tail: float = 0.95, prior: float = 10.0) -> DataFrame:
    """A row a group: ``__fence_`` and the ratio, its upper fence, from quantile sketches over all
    documents of 50 words or more that ``counts`` has measured.

    Each group has mergeable KLL sketches; partial ones are merged where groups meet, so
    a source with most rows moves no more than others. A fence is the third quartile and
    ``reach`` times the quartiles' distance, or the quantile at ``tail`` where that is
    greater: it rejects no more than the group's last 5 % even if the quartiles meet. It is
    then averaged with the fence of the wider group (all languages, then the language),
    which weighs as much as ``prior`` documents, so a group leans on the wider one the
    more, the fewer documents it has. No fence has a fixed part.
    """
    ratios = counted.filter("n_words >= 50").select(*groups, *(_ratio(k).alias(k) for k in RATIOS))
    own = cut(ratios.groupBy(*groups).agg(F.count("*").alias("__n"), *(F.kll_sketch_agg_double(k).alias(k) for k in RATIOS)))
    out, wider = own.select(*groups), None
    for depth in range(len(groups) + 1):
        keys = groups[:depth]
        merged = own if depth == len(groups) else own.groupBy(*keys).agg(F.sum("__n").alias("__n"), *(F.kll_merge_agg_double(k).alias(k) for k in RATIOS)).filter("__n > 0")

        def fence(k: str) -> Column:
            low, high, last = (F.kll_sketch_get_quantile_double(k, F.lit(q)) for q in (0.25, 0.75, tail))
            return F.greatest(high + reach * (high - low), last).alias(f"__fence_{k}")

        here = merged.select(*(F.col(g).alias(f"__{g}") for g in keys), F.col("__n"), *map(fence, RATIOS))
        if wider is None:
            wider = here.drop("__n")
            out = out.crossJoin(F.broadcast(wider))  # one row
            continue
        near = here.select("*", *(F.col(f"__fence_{k}").alias(f"__own_{k}") for k in RATIOS)).drop(*(f"__fence_{k}" for k in RATIOS))
        met = out.join(near, [out[g].eqNullSafe(near[f"__{g}"]) for g in keys])
        mean = {k: ((F.col("__n") * F.col(f"__own_{k}") + prior * F.col(f"__fence_{k}")) / (F.col("__n") + prior)).alias(f"__fence_{k}") for k in RATIOS}
        out = met.select(*groups, *mean.values())
    return out


def judged(counted: DataFrame, *, groups: tuple[str, ...] = ("lang", "source"), most: int = 100_000, **options) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to documents that ``counts`` has measured.

    A document is kept unless a base rule or a fence of its group rejects it, which a
    ratio equal to the fence does not. Null and empty texts fail; a null language or
    source is a group of its own; repeated rows get the same verdict; an empty table
    gives an empty result; very long texts are one row like others. The fences are
    broadcast while there are at most ``most`` groups, which is counted; beyond that
    the join shuffles. Columns named like the verdicts are replaced; names that begin
    with two underscores are the operator's own.
    """
    limits = cut(fences(counted, groups=groups, **options))
    renamed = limits.select(*(F.col(g).alias(f"__{g}") for g in groups), *(f"__fence_{k}" for k in RATIOS))
    if limits.count() <= most:
        renamed = F.broadcast(renamed)
    marked = counted.withColumn("base_failed", base_failed())
    met = marked.join(renamed, [marked[g].eqNullSafe(F.col(f"__{g}")) for g in groups], "left")
    bad = F.lit(False)
    for k in RATIOS:
        bad = bad | F.coalesce(_ratio(k) > F.col(f"__fence_{k}") * (1 + 1e-9), F.lit(False))
    # one expression over both sides of the join, so that a filter on it is not moved below the counts and evaluated with them
    return met.withColumn("kept", F.when(bad, False).otherwise(~F.col("base_failed"))).drop(*(f"__{g}" for g in groups), *(f"__fence_{k}" for k in RATIOS))
