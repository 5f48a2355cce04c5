"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.shared import cut, running_start

# Fixed value: the golden ratio's fractional part, times 2 ** 64; whole numbers keep it exact at any number of slots.
GOLDEN = Decimal(11400714819323198485)
CELLS = 4096


def source_key(source: Column) -> Column:
    """A source as a key without nulls; a null source is a source of its own."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def source_targets(sizes: DataFrame, weights: Sequence[float], limit: int) -> DataFrame:
    """Adds ``target`` to a table of ``source`` and ``source_size``.

    Sources in code-point order, null last, have the weights in turn and share the sum
    of all sizes; no target exceeds ``limit`` times its source's size, and what is above
    goes to the others by weight until none is above. With targets min(cap, level *
    weight), the level is the one that the sources below their caps agree on. The table
    has one row a source, so it is ordered in one task.
    """
    alphabetic = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(float(w)) for w in weights))
    ranked = sizes.withColumn("__w", F.element_at(turn, ((F.row_number().over(alphabetic) - 1) % len(weights) + 1).cast("int"))).withColumn("__cap", F.col("source_size") * limit)
    filling = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    everywhere = Window.partitionBy()
    capped = F.coalesce(F.sum("__cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("__w").over(filling.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everywhere) - capped) / open_weight
    leveled = ranked.withColumn("__level", level)
    common = F.max(F.when(F.col("__level") * F.col("__w") <= F.col("__cap"), F.col("__level"))).over(everywhere)
    return leveled.select("source", "source_size", F.coalesce(F.least(F.col("__cap").cast("double"), common * F.col("__w")), F.col("__cap").cast("double"), F.lit(0.0)).alias("target"))


def schedule(targets: DataFrame, slots: int, block: int, limit: int) -> DataFrame:
    """(``__s``, ``block``, ``at``): the slots, in order, in which the mix takes each block of a source.

    Slot n goes to the source whose share of the cumulative targets holds the
    fractional part of (n + 1) times the golden ratio; the r-th slot of a source takes
    its r-th block, starting over after the last, ``limit`` times at most.
    """
    spark = targets.sparkSession
    along = Window.orderBy("__s").rowsBetween(Window.unboundedPreceding, 0)
    ends = targets.withColumn("__end", F.sum("target").over(along) / F.sum("target").over(Window.partitionBy()))
    shares = ends.withColumn("__from", F.coalesce(F.lag("__end").over(Window.orderBy("__s")), F.lit(0.0))).filter("__end > __from")
    cell = lambda x: F.least(F.floor(x * CELLS), F.lit(CELLS - 1)).cast("int")
    spread = shares.select("__s", "__from", "__end", F.ceil(F.col("source_size") / block).cast("long").alias("__blocks"), F.explode(F.sequence(cell(F.col("__from")), cell(F.col("__end")))).alias("__cell"))
    x = (F.col("id") + 1).cast("decimal(18,0)") * F.lit(GOLDEN) % F.lit(Decimal(1 << 64))
    points = spark.range(slots).withColumn("__u", x.cast("double") / 2.0**64).withColumn("__cell", cell(F.col("__u")))
    dealt = points.join(spread, "__cell").filter("__from <= __u AND __u < __end").select("id", "__s", "__blocks")
    ranked = running_start(dealt, ["__s"], ["id"], F.lit(1), "__r", F.shiftright("id", 11).cast("int"))
    return ranked.filter(F.col("__r") < F.col("__blocks") * limit).groupBy("__s", (F.col("__r") % F.col("__blocks")).alias("block")).agg(F.sort_array(F.collect_list("id")).alias("at"))


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5, 2, 1), limit: int = 3, slots: int | None = None, seed: str = "mix") -> DataFrame:
    """A row a document: ``doc_id``, ``text_hash``, ``size`` (words), ``source_size``,
    ``target`` (its source's), ``taken`` (words that the mix takes, repeats counted) and
    ``slots`` (when, in the order of the mix, the block that holds its first word is taken).

    Each source is shuffled by a hash of document and text and cut into blocks of equal
    size and of 16 words at least, about ``slots`` in all (if not given, as many as
    documents or 2^19, if that is more); ``schedule`` takes them. The
    same rows give the same mix, in any partitioning. A null text has no words and is
    taken for none; a null source is one of its own; repeated rows have their own places.
    Nothing is gathered by source: places come from per-bucket totals, and documents
    meet blocks on (source, block). An empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")), whole))
    rows = cut(docs.select(F.col(key).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), F.col(source).alias("source"), source_key(F.col(source)).alias("__s"), F.regexp_count(whole, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), mark.alias("__h")))
    sizes = rows.groupBy("source", "__s").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, limit).withColumn("__s", source_key(F.col("source"))))
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    slots = slots or max(1 << 19, rows.count())
    block = max(16, -(-total // slots))
    bucket = F.conv(F.substring("__h", 1, 3), 16, 10).cast("int")
    placed = running_start(rows, ["__s"], ["__h", "doc_id", "size"], F.col("size"), "__at", bucket)
    some = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("__at") / block), F.floor((F.col("__at") + F.col("size") - 1) / block))))
    start = F.greatest(F.col("__at"), F.col("block") * block)
    stop = F.least(F.col("__at") + F.col("size"), (F.col("block") + 1) * block)
    times = F.coalesce(F.size("at"), F.lit(0))
    here = F.col("block") == F.floor(F.col("__at") / block)
    none_taken = F.array().cast("array<long>")
    met = some.join(schedule(targets, -(-total // block), block, limit), ["__s", "block"], "left")
    taken = met.groupBy("__s", "__at", "doc_id", "text_hash", "size").agg(F.sum((stop - start) * times).alias("taken"), F.coalesce(F.max(F.when(here, F.col("at"))), none_taken).alias("slots"))
    none = placed.filter("size = 0").select("__s", "__at", "doc_id", "text_hash", "size", F.lit(0).cast("long").alias("taken"), none_taken.alias("slots"))
    return taken.unionByName(none).join(targets.select("__s", "source_size", "target"), "__s").select("doc_id", "text_hash", "size", "source_size", "target", "taken", "slots")


def mixed_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents as often as ``mix`` takes them, with their own columns, in the order of
    the slots that take them: partitions are ranges of slots, and rows in them are sorted.

    Of rows equal in document and text one stands for all, as often as they are taken
    together; documents without words are not taken; an empty table gives an empty result.
    """
    times = mix(docs, key=key, text=text, **options).filter(F.size("slots") > 0).select(_shown(F.col("doc_id")).alias("__id"), F.col("text_hash").alias("__text_hash"), "slots")
    taken = times.select("__id", "__text_hash", F.explode("slots").alias("__slot"))
    hashed = docs.withColumns({"__id": _shown(F.col(key)), "__text_hash": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    first = Window.partitionBy("__id", "__text_hash").orderBy(*[c for c in docs.columns if c not in (key, text)])
    single = hashed.withColumn("__n", F.row_number().over(first)).filter("__n = 1")
    each = single.join(taken, ["__id", "__text_hash"])
    return each.repartitionByRange("__slot", "__text_hash").sortWithinPartitions("__slot", "__text_hash").select(*docs.columns)


def _shown(key: Column) -> Column:
    """A key as text without nulls."""
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))
