"""Reply trees to training conversations, in DataFrame functions alone.

Nodes point at the node they answer. Self-joins enumerate the root-to-leaf
paths, from the leaves upward: each round joins the links to themselves, so that
they reach twice as far, and joins what is known of the paths to them. A thread
of a thousand replies takes ten rounds, and rows are one for each node of a path
and each node of a round. Paths of a tree are ranked by their mean score; the
chosen ones are formatted, each as one conversation.

The template writes ``<|role|>text<|end|>`` for each turn. In roles and texts
the bar and the backslash, and the control strings of other common templates,
are written as a backslash and a letter, so marks are always marks and
``unescaped`` gives back every text. The loss mask is a list of intervals of the
output that cover exactly the texts of the assistant.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_at, let, running, text_of, written

#: Strings with a meaning in this or other templates, and what follows the backslash for each. The backslash comes first.
ESCAPES = {"\\": "s", "|": "p", "[INST]": "I", "[/INST]": "J", "<</SYS>>": "Z", "<<SYS>>": "Y", "</s>": "E", "<s>": "B"}


#: What ends a turn.
END = "<|end|>"


def escaped(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit("\\" + e[1])), ESCAPES.items(), text)


def unescaped(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit("\\" + e[1]), F.lit(e[0])), reversed(ESCAPES.items()), text)


def paths(nodes: DataFrame) -> DataFrame:
    """``tree, leaf, pos, node``: the nodes of each path, 0 at its root, for ``tree, node, parent`` that tell nodes apart.

    A node whose parent is null or unknown is a root. Nodes that lead round in a
    circle reach no root and are on no path.
    """
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    links = written(nodes.select("tree", "node", "parent").join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up")), "links")
    up = links.where("up is not null")
    longest = links.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).head()[0] or 0
    leaves = links.join(up.select("tree", F.col("up").alias("node")).distinct(), ["tree", "node"], "left_anti")
    found = written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back")), "paths")
    reach = 1
    while reach < longest:  # whoever is not at a root by then goes round in a circle
        further = written(found.join(up, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("back") + reach).alias("back")), "paths")
        if not further.limit(1).count():
            break
        found = found.unionByName(further)
        up = written(up.join(up.select("tree", F.col("node").alias("up"), F.col("up").alias("next")), ["tree", "up"]).select("tree", "node", F.col("next").alias("up")), "links")
        reach *= 2
    ends = found.join(links.where("up is null").select("tree", "node"), ["tree", "node"]).select("tree", "leaf", F.col("back").alias("last"))
    return found.join(ends, ["tree", "leaf"]).select("tree", "leaf", (F.col("last") - F.col("back")).alias("pos"), "node")


def conversations(nodes: DataFrame, top: int | None = None, assistant: str = "assistant") -> DataFrame:
    """``tree, leaf, rank, score, n_turns, formatted, loss array<struct<start,end>>``.

    ``nodes``: ``tree, node, parent, role, text, score``; ``tree`` and ``node``
    tell a node apart (of repeated nodes, the least by parent, role and text
    counts). A null tree is a tree of its own; null nodes are left out, null
    roles and texts are empty, null scores count as 0. ``rank`` is the place of
    the path among its tree's by mean score, the highest first, then by leaf;
    ``top`` keeps the first ones. ``loss`` gives intervals of code points of
    ``formatted``, from 0, the end exclusive. Other columns aren't read. An empty
    table gives no row.
    """
    # a record that holds a null is equal to another
    clean = nodes.where("node is not null").select(F.struct("tree").alias("tree"), *[c for c in ("node", "parent", "role", "text", "score")])
    clean = clean.groupBy("tree", "node").agg(
        F.min(F.struct("parent", text_of("role").alias("role"), text_of("text").alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"))).alias("n")
    ).select("tree", "node", "n.*")
    steps = paths(clean)
    if top is not None:
        scored = steps.join(clean.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
        order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
        chosen = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("tree", "leaf")
        steps = steps.join(chosen, ["tree", "leaf"], "left_semi")
    turns = steps.join(clean, ["tree", "node"]).groupBy("tree", "leaf").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text", "score"))).alias("turns"))
    marked = turns.withColumn("t", F.transform("turns", lambda x: F.struct(
        (x.role == assistant).alias("loss"), F.concat(F.lit("<|"), escaped(x.role), F.lit("|>")).alias("head"), escaped(x.text).alias("body"))))
    sizes = F.transform("t", lambda x: F.length(x["head"]) + F.length(x["body"]) + len(END))
    bodies = lambda at: F.transform("t", lambda x, k: let(F.get(at, k) + F.length(x["head"]), lambda start: F.struct(
        x["loss"].alias("loss"), start.cast("int").alias("start"), (start + F.length(x["body"])).cast("int").alias("end"))))
    spans = F.filter(let(running(sizes, lambda a, x: a + x), bodies), lambda s: s["loss"])
    score = F.aggregate("turns", F.lit(0.0), lambda a, x: a + x.score) / F.size("turns")
    out = marked.select(
        "tree", "leaf", score.alias("score"), F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss"))
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    return ranked.withColumn("tree", F.col("tree.tree"))


def read_back(formatted: Column) -> Column:
    """``array<struct<role,text>>``: the turns of a formatted conversation."""
    parts = F.split(formatted, r"<\|")
    turns = F.filter(parts, lambda x, i: i % 2 == 1)
    return F.transform(turns, lambda x: F.struct(
        unescaped(F.substring_index(x, "|>", 1)).alias("role"), unescaped(F.substring(x, F.instr(x, "|>") + 2, F.length(x))).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescaped(cut_at(formatted, lambda piece: F.array_join(F.transform(loss, lambda s: piece(s.start, s.end - s.start)), "")))


def thread(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Nodes of conversations without branches: each turn answers the one before; ties by role, then text.

    Null conversations are one conversation, null turns come first, null roles
    before others; null texts are empty. Repeated rows are turns of their own.
    Other columns aren't read; an empty table gives no node.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return rows.select(F.col(conv_col).alias("tree"), F.col(turn_col).alias("turn"), "role", text_of("text").alias("text")).withColumn(
        "node", F.row_number().over(order).cast("long")).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def digests(talks: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from the formatted output.

    One row for each row of ``talks`` (``tree, formatted, loss``); a conversation
    without an assistant has the empty text under its mask.
    """
    turns = read_back(F.col("formatted"))
    text = loss_text(F.col("formatted"), F.col("loss"))
    return talks.select(
        F.col("tree").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(text).cast("long").alias("loss_chars"), F.sha2(text, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
