"""Reply trees to conversations: paths, branch ranks and a reversible template; DataFrame
functions only.

The template of a turn is ``<|turn|>role``, a line feed, the text, ``<|end|>`` and a line
feed. In roles and texts a backslash becomes two and ``<|`` becomes ``<\\|``; in roles a
line feed gets a backslash as well. So no text can hold a marker, and taking away one
backslash before any character gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.shared import cut

TURN, END = "<|turn|>", "<|end|>\n"


def escape(text: Column) -> Column:
    """A text without markers; null is empty."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def ancestor_steps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables (``tree``, ``node``, ``up``) of each node's 1st, 2nd, 4th, ... ancestor, and
    the nodes that have no root (None if all have one).

    ``nodes`` has ``tree``, ``node`` and ``parent``; a null or missing parent makes a
    root. Each table is the one before joined with itself, so there are as many as the
    deepest tree's depth has binary digits, and each holds only nodes that are deep
    enough. Depths have no gaps: once a table is as large as the one before, all that
    is left hangs on circles of parents.
    """
    ids = nodes.select("tree", F.col("node").alias("parent"))
    now = cut(nodes.select("tree", "node", "parent").join(ids, ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("up")))
    steps, size = [], now.count()
    while size:
        steps.append(now)
        upper = now.select("tree", F.col("node").alias("up"), F.col("up").alias("above"))
        now = cut(now.join(upper, ["tree", "up"]).select("tree", "node", F.col("above").alias("up")))
        before, size = size, now.count()
        if size == before:
            return steps, now.select("tree", "node")
    return steps, None


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """(``tree``, ``leaf``, ``node``, ``height``): a row for each node between a root and a
    leaf, with the steps from the leaf up to it.

    Paths double in each round: every node found so far is joined, on (tree, node), to
    its ancestor as many steps above as the path is long. So the rows made are those of
    the result, whatever the depth. A leaf whose ancestors go in a circle has no path.
    """
    steps, lost = ancestor_steps(nodes)
    parents = nodes.filter("parent is not null").select("tree", F.col("parent").alias("node"))
    leaves = nodes.join(parents, ["tree", "node"], "left_anti")
    if lost is not None:
        leaves = leaves.join(lost, ["tree", "node"], "left_anti")
    found = cut(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height")))
    for k, step in enumerate(steps):
        more = found.join(step, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("height") + (1 << k)).alias("height"))
        found = found.unionByName(cut(more))
    return found


def format_trees(messages: DataFrame, *, branches: int | None = None, trained: str = "assistant") -> DataFrame:
    """A row a conversation: ``tree``, ``leaf``, ``rank``, ``score``, ``formatted`` and
    ``loss_spans`` (start and end, in code points, of each trained role's text there).

    ``messages`` has ``tree``, ``node`` (unique in its tree), ``parent``, ``role``,
    ``text`` and ``score``. Each root-to-leaf path is a conversation; those of a tree
    are ranked by score, higher first, ties to the smaller leaf, and the first
    ``branches`` (all if None) are formatted. Null roles and texts are empty; a circle
    of parents yields nothing; an empty table gives an empty result. A reply under many
    leaves is joined to each path on (tree, node), and only one conversation, which is
    one row of the result, is brought together.
    """
    nodes = cut(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("worth")))
    paths = leaf_paths(nodes)
    totals = paths.join(nodes.select("tree", "node", "worth"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sum("worth").alias("total"))
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "leaf")
    ranked = totals.withColumn("rank", F.row_number().over(order))
    if branches is not None:
        ranked = ranked.filter(F.col("rank") <= branches)
    steps = paths.join(ranked, ["tree", "leaf"]).withColumn("at", -F.col("height"))
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    turns = messages.select("tree", "node", head.alias("head"), escape(F.col("text")).alias("body"), F.coalesce(F.col("role") == trained, F.lit(False)).alias("trained"))
    shown = steps.join(turns, ["tree", "node"]).withColumn("turn", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("tree", "leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.length("head")
    placed = shown.withColumn("start", start)
    span = F.when(F.col("trained"), F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    whole = placed.groupBy("tree", "leaf", "rank", "total").agg(F.array_sort(F.collect_list(F.struct("at", "turn"))).alias("turns"), F.array_sort(F.collect_list(span)).alias("loss_spans"))
    return whole.select("tree", "leaf", "rank", F.col("total").alias("score"), F.array_join(F.col("turns.turn"), "").alias("formatted"), "loss_spans")


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as structs of role and text."""
    parts = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda x: x != "")
    header = r"(?s)^<\|turn\|>([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)$"
    return F.transform(parts, lambda x: F.struct(unescape(F.regexp_extract(x, header, 1)).alias("role"), unescape(F.regexp_extract(x, header, 2)).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def threads(rows: DataFrame, *, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it.

    Rows are ordered by turn, nulls first, then by role and text, so repeated turns and
    repeated rows each stay a turn. Rows without a key are one conversation.
    """
    by_turn = Window.partitionBy(key).orderBy(order, "role", "text")
    number = F.row_number().over(by_turn).cast("long")
    return rows.select(F.coalesce(F.concat(F.lit("c"), F.col(key).cast("string")), F.lit("n")).alias("tree"), F.col(key).alias("key"), number.alias("node"), "role", "text").withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))
