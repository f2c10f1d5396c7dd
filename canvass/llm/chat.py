"""Reply trees as chat conversations, with DataFrame operations alone.

Self-joins that double their reach in every round list the ancestors of each leaf; each
root-to-leaf path is a branch.  Branches are ranked by the sum of their
scores, and each chosen one is formatted as one conversation.

A turn is `<|im_start|>`, the role, a line break, the text, `<|im_end|>` and a line break.
Control strings cannot occur inside a text: a backslash is put between < and | wherever they meet, also if
backslashes are already there, which is undone by taking one away.  Roles are percent-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.llm.arrow import stored

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def threads(rows: DataFrame, tree: str, turn: str, role: str, text: str) -> DataFrame:
    """Reply trees of linear conversations: each row replies to the one before it.

    Rows of a conversation are ordered by turn (nulls last), then role and text, so repeated turns follow each other.
    """
    place = F.row_number().over(Window.partitionBy(tree).orderBy(F.asc_nulls_last(turn), role, text)).cast("long")
    return rows.select(
        F.col(tree).alias("tree"), place.alias("node"), (place - 1).alias("parent"), F.col(role).alias("role"),
        F.col(text).alias("text"), F.lit(0.0).alias("score"),
    )


def both(a: DataFrame, b: DataFrame, node: str, other: str) -> Column:
    return a["tree"].eqNullSafe(b["t"]) & (a[node] == b[other])


def without_cycles(edges: DataFrame, linked: DataFrame) -> DataFrame:
    """`linked` (tree, node, above) without the nodes on a cycle, which become roots.

    A cycle has a node whose parent is not smaller.  In trees with such nodes, those that are
    still reached after as many steps as the tree has nodes are the nodes on cycles.
    """
    suspect = linked.where("above >= node").select(F.col("tree").alias("t")).distinct()
    if suspect.isEmpty():
        return linked
    sizes = edges.join(suspect, edges["tree"].eqNullSafe(suspect["t"]), "left_semi").groupBy("tree").count()
    size = sizes.agg(F.max("count")).first()[0]
    far = stored(linked.join(suspect, linked["tree"].eqNullSafe(suspect["t"]), "left_semi"))
    reach = 1
    while reach < size:
        step = far.select(F.col("tree").alias("t"), F.col("node").alias("from"), F.col("above").alias("to"))
        far = stored(far.join(step, both(far, step, "above", "from")).select("tree", "node", F.col("to").alias("above")))
        reach *= 2
    cycle = far.select(F.col("tree").alias("t"), F.col("above").alias("c")).distinct()
    return linked.join(cycle, both(linked, cycle, "node", "c"), "left_anti")


def branches(nodes: DataFrame) -> DataFrame:
    """Columns tree, leaf, node, up: for every leaf all nodes on its path, `up` steps above it."""
    edges = stored(nodes.select("tree", "node", "parent"))
    known = edges.select(F.col("tree").alias("t"), F.col("node").alias("above"))
    linked = edges.join(known, both(edges, known, "parent", "above")).select("tree", "node", "above")
    jump = stored(without_cycles(edges, stored(linked)))
    replied = jump.select(F.col("tree").alias("t"), F.col("above").alias("r")).distinct()
    paths = edges.join(replied, both(edges, replied, "node", "r"), "left_anti").select(
        "tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")
    )
    reach = 1
    while not jump.isEmpty():
        step = jump.select(F.col("tree").alias("t"), F.col("node").alias("from"), F.col("above").alias("to"))
        higher = paths.join(step, both(paths, step, "node", "from"))
        paths = stored(paths.unionByName(higher.select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + reach).alias("up"))))
        jump = stored(jump.join(step, both(jump, step, "above", "from")).select("tree", "node", F.col("to").alias("above")))
        reach *= 2
    return paths


def format_trees(nodes: DataFrame, keep: int | None = None) -> DataFrame:
    """Conversations of reply trees (columns tree, node, parent, role, text, score).

    Returns tree, leaf, rank, score, formatted and loss: the places of learned texts as (begin, end) in code points.
    Branches rank by score, then length, then leaf; `keep` gives the number to format in each tree, all without it.

    Node ids are numbers; a parent that is missing or null makes the reply a root, and so does lying on a cycle.  Of rows
    with the same tree and node, the first by role and text counts.  Null roles, texts and scores count as empty and 0.
    A null tree is a tree.  A table without rows gives none.  Other columns are left out.
    """
    first = F.row_number().over(Window.partitionBy("tree", "node").orderBy("role", "text"))
    nodes = nodes.where(F.col("node").isNotNull()).select(
        "tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    ).withColumn("first", first).where("first = 1").drop("first")
    paths = branches(nodes)
    pieces = nodes.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), "score", "role",
        F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body"),
    )
    turns = paths.join(pieces, both(paths, pieces, "node", "n")).select("tree", "leaf", "up", "score", "role", "head", "body")
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    piece = F.concat("head", "body", F.lit(END))
    begin = F.coalesce(F.sum(F.length(piece)).over(before), F.lit(0)) + F.length("head")
    placed = turns.withColumn("begin", begin).withColumn("piece", piece)
    turn = F.struct((-F.col("up")).alias("at"), "piece", (F.col("role") == LEARNED).alias("learned"), "begin", (F.col("begin") + F.length("body")).alias("end"))
    whole = placed.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.sum("score").alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc(F.size("turns")), "leaf")
    ranked = whole.withColumn("rank", F.row_number().over(order))
    chosen = ranked if keep is None else ranked.where(F.col("rank") <= keep)
    return chosen.select(
        "tree", "leaf", "rank", "score",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["begin"].alias("begin"), t["end"].alias("end"))).alias("loss"),
    )


def turns_of(formatted: str) -> Column:
    """Roles and texts read back from a formatted conversation."""
    parts = F.filter(F.split(F.col(formatted), r"<\|im_start\|>"), lambda p: p != "")

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        begin = F.length(role) + 2
        text = F.substring(part, begin, F.length(part) - begin + 1 - F.lit(len(END)))
        return F.struct(F.url_decode(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def learned_texts(formatted: str, loss: str) -> Column:
    """Texts under the loss mask, as they were before formatting."""
    return F.transform(F.col(loss), lambda s: unescaped(F.substring(F.col(formatted), (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))))
