"""Seeded orders and samples: what depends on seed and id alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.functions.text import order_key


def position(df: DataFrame, key: str, ties: list[str], out: str) -> DataFrame:
    """Adds the place from 0 of each row in the order of a hex ``key``, then ``ties``.

    No task sorts all rows: the key's first three digits make 4096 even ranges, their
    counts (broadcast, 4096 rows at most) give each range its offset, and rows are
    numbered inside their range.
    """
    ranged = df.withColumn("__range", F.conv(F.substring(key, 1, 3), 16, 10).cast("int"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__range").orderBy(key, *ties)
    placed = ranged.join(F.broadcast(offsets), "__range")
    return placed.withColumn(out, F.col("__offset") + F.row_number().over(inside) - 1).drop("__range", "__offset")


def seeded(df: DataFrame, seed: str, id_column: str = "review_id") -> DataFrame:
    """Adds ``order_key`` for a seed."""
    return df.withColumn("order_key", order_key(seed, F.col(id_column)))


def hash_sample(df: DataFrame, seed: str, n: int, id_column: str = "review_id") -> DataFrame:
    """The ``n`` rows of the least order keys, with their place from 0; all if fewer."""
    picked = seeded(df, seed, id_column).orderBy("order_key", id_column).limit(n)
    return picked.withColumn("place", F.row_number().over(Window.orderBy("order_key", id_column)) - 1)


def repeated_draws(df: DataFrame, seed: str, n: int, rounds: int, id_column: str = "review_id") -> DataFrame:
    """``rounds`` samples of ``n`` rows each without replacement (all rows if fewer): those of the least hashes of seed, round and id.

    Only hashes that can be among the least are kept where the rows are: below a threshold
    that lets ten standard deviations more than ``n`` through in the mean (the chance that a
    round runs short is under 1e-20), so what is sorted grows with ``n`` and not with the
    rows. Rows whose id is null are never drawn. Adds ``round`` (from 1).
    """
    given = df.filter(F.col(id_column).isNotNull())
    room = (n + 10 * n**0.5 + 100) * float(1 << 32)
    share = given.agg(F.least(F.lit(room) / F.greatest(F.count("*"), F.lit(1)), F.lit(float(1 << 32))).cast("long").alias("__least"))
    key = lambda r: F.sha2(F.concat_ws(":", F.lit(seed), r.cast("string"), id_column), 256)
    keyed = F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda r: F.struct(r.alias("round"), key(r).alias("key")))
    near = F.filter(keyed, lambda s: F.conv(F.substring(s["key"], 1, 8), 16, 10).cast("long") < F.col("__least"))
    kept = given.crossJoin(F.broadcast(share)).withColumn("__s", F.explode(near)).withColumns({"round": F.col("__s.round"), "__key": F.col("__s.key")})
    placed = kept.withColumn("__n", F.row_number().over(Window.partitionBy("round").orderBy("__key", id_column)))
    return placed.filter(F.col("__n") <= n).drop("__least", "__s", "__key", "__n")


def nested_samples(df: DataFrame, seed: str, sizes: dict[str, tuple[int, int]], id_column: str = "review_id") -> DataFrame:
    """Samples that are ranges of places in one hash order; ``sizes`` gives from and to by name."""
    top = hash_sample(df, seed, max(b for _, b in sizes.values()), id_column)
    named = F.array(*(F.struct(F.lit(k).alias("sample"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in sizes.items()))
    return top.withColumn("s", F.explode(named)).filter("place >= s.a AND place < s.b").select(id_column, "place", F.col("s.sample").alias("sample"))


def halves(df: DataFrame, without: DataFrame, salt: str, id_column: str = "review_id") -> DataFrame:
    """The rows that ``without`` lacks, in hash order, the first half (rounded up) and the rest."""
    left = seeded(df.join(without.select(id_column).distinct(), id_column, "left_anti"), salt, id_column)
    placed = position(left, "order_key", [id_column], "place")
    total = left.agg(F.count("*").alias("n"))
    return placed.crossJoin(F.broadcast(total)).select(id_column, "place", F.when(F.col("place") * 2 < F.col("n"), "tune").otherwise("holdout").alias("half"))


def alternating(df: DataFrame, salt: str, id_column: str = "review_id") -> DataFrame:
    """Every other row of the hash order goes to the other side."""
    placed = position(seeded(df, salt, id_column), "order_key", [id_column], "place")
    return placed.select(id_column, "place", (F.col("place") % 2).cast("int").alias("side"))


def every_nth(df: DataFrame, seed: str, step: int, id_column: str = "review_id") -> DataFrame:
    """Each ``step``-th row of the hash order."""
    return position(seeded(df, seed, id_column), "order_key", [id_column], "place").filter(F.col("place") % step == 0).select(id_column, "place")


def sliding_sums(df: DataFrame, order: str, value: Column, k: int, group: str) -> DataFrame:
    """Per group, the largest sum over ``k`` rows in order (full windows only), and over aligned blocks of ``k``."""
    by = Window.partitionBy(group).orderBy(order)
    numbered = df.withColumns({"__n": F.row_number().over(by), "__v": value})
    slid = numbered.withColumn("__s", F.sum("__v").over(by.rowsBetween(-(k - 1), 0))).filter(F.col("__n") >= k)
    sliding = slid.groupBy(group).agg(F.max("__s").alias("max_sliding"))
    blocks = numbered.groupBy(group, F.floor((F.col("__n") - 1) / k).alias("b")).agg(F.sum("__v").alias("s"), F.count("*").alias("c")).filter(F.col("c") == k)
    return sliding.join(blocks.groupBy(group).agg(F.max("s").alias("max_aligned")), group)


def running(df: DataFrame, group: str, bucket: Column, order: list[str], value: Column, out: str, *, largest: bool = False, before: bool = False) -> DataFrame:
    """Adds ``out``: per group the sum (or the largest) of ``value`` over the rows up to this one, or ``before`` it.

    Rows are ordered by ``bucket``, which must not decrease along ``order``, and then by
    ``order``. Only a bucket is sorted in one task; what came before it is one number, from
    totals by bucket.
    """
    fold = F.max if largest else F.sum
    dealt = df.withColumns({"__b": bucket, "__v": value})
    earlier = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(group, "__b").agg(fold("__v").alias("__t")).select(group, "__b", fold("__t").over(earlier).alias("__o"))
    inside = Window.partitionBy(group, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    here = dealt.join(totals, [group, "__b"]).withColumn("__i", fold("__v").over(inside))
    whole = F.greatest("__o", "__i") if largest else F.coalesce("__o", F.lit(0)) + F.coalesce("__i", F.lit(0))
    return here.withColumn(out, whole).drop("__b", "__v", "__o", "__i")


def top_words(dated: DataFrame, part: str, without: Sequence[str], k: int) -> DataFrame:
    """The ``k`` words that most rows have, by ``part``: ``place``, ``word``, ``n``, the part's ``documents`` and their share.

    ``words`` holds a row's distinct words. Only counts of words are ordered, and of these
    the first ``k`` of each part are kept before they meet in one task. Ties go to the
    smaller word; the share is in ten thousandths, half up.
    """
    words = dated.select(part, F.explode(F.array_except("words", F.array(*map(F.lit, without)))).alias("word"))
    counts = words.groupBy(part, "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(F.desc("n"), "word"))
    first = counts.withColumn("place", place).filter(F.col("place") <= k)
    every = dated.groupBy(part).agg(F.count("*").alias("documents"))
    share = F.expr("(2 * n * 10000 + documents) DIV (2 * documents)").alias("per_ten_thousand")
    return first.join(every, part).select(part, F.col("place").cast("long").alias("place"), "word", "n", "documents", share)
