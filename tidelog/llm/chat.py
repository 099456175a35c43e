"""Reply trees as chat texts, by DataFrame functions only.

Root-to-leaf paths come from self-joins that double their reach: round k adds to each leaf's known
ancestors those 2^k steps further up, so a chain of n replies takes log2(n) rounds. Branches are
ranked by the mean score of their messages and the best ones formatted.

A turn is `[INST]role[/INST]text</s>` and a conversation starts with `<s>`. Where a role or a text
holds one of these control strings, a backslash is put behind its bracket, and one more where
there are some already; taking one away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

BEGIN, TURN, SAYS, END = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = r"(/?s>|/?INST\])"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, "$1$2$3")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every node on the path of every leaf, `up` steps above it.

    nodes: (tree, node, parent), with (tree, node) unique. A parent that is not there makes a
    root. Parents in a circle raise an error.
    """
    nodes = stored(nodes.select("tree", "node", "parent"), "tree-nodes")
    own = nodes.select("tree", F.col("node").alias("parent"))
    up = stored(nodes.join(own, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("to")), "steps")
    has_reply = up.select("tree", F.col("to").alias("node")).distinct()
    found = stored(nodes.join(has_reply, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "paths")
    reach, most = 1, 2 * nodes.count()
    while not up.isEmpty():
        if reach > most:
            raise ValueError("some parents form a circle")
        more = found.join(up, ["tree", "node"]).select(
            "tree", "leaf", F.col("to").alias("node"), (F.col("up") + reach).alias("up"))
        found = stored(found.unionByName(more), "paths")
        further = up.select("tree", F.col("node").alias("to"), F.col("to").alias("next"))
        up = stored(up.join(further, ["tree", "to"]).select("tree", "node", F.col("next").alias("to")), "steps")
        reach *= 2
    return found


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, score, turns): the best branches of each tree, turns from the root on.

    messages: (tree, node, parent, role, text, score). A branch's score is the mean of its
    messages' scores, those without one not counted; ties go to the smaller leaf. A null role or
    text is empty.
    """
    said = stored(messages.select("tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
                                  F.coalesce("text", F.lit("")).alias("text"), "score"), "messages")
    found = paths(said)
    scores = found.join(said.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(
        F.avg("score").alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc_nulls_last("score"), "leaf")
    best = stored(scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches), "branches")
    chosen = found.join(best, ["tree", "leaf"]).join(said.select("tree", "node", "role", "text"), ["tree", "node"])
    turns = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text")))
    return chosen.groupBy("tree", "leaf", "rank", "score").agg(turns.alias("listed")).select(
        "tree", "leaf", "rank", "score",
        F.transform("listed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def formatted(chosen: DataFrame) -> DataFrame:
    """chosen with `formatted`, and `segments` (text, loss): its pieces in order and the loss mask."""
    def piece(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    def pieces(t):
        return F.array(
            piece(F.concat(F.lit(TURN), escaped(t["role"]), F.lit(SAYS)), F.lit(False)),
            piece(escaped(t["text"]), t["role"] == LEARNED),
            piece(F.lit(END), F.lit(False)))

    start = F.array(piece(F.lit(BEGIN), F.lit(False)))
    made = chosen.withColumn("segments", F.concat(start, F.flatten(F.transform("turns", pieces))))
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.split(F.substring(text, len(BEGIN) + 1, 2**31 - 1), END)

    def turn(part):
        sides = F.split(part, r"\[/INST\]", 2)
        return F.struct(unescaped(F.substring(sides[0], len(TURN) + 1, 2**31 - 1)).alias("role"),
                        unescaped(sides[1]).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def linear(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Messages of plain conversations: each turn replies to the one before it.

    Equal turns are ordered by role and text; a null turn comes first; rows without a conversation
    id make one conversation. tree is the id as text, for joins that a null takes part in.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = rows.select(tree.alias("tree"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
                           F.col(text).cast("string").alias("text")).withColumn("node", F.row_number().over(order))
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                           "role", "text", F.lit(None).cast("double").alias("score"))


def digests(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Format plain conversations and read them back: per conversation its id, n_turns,
    turns_sha256, loss_chars, loss_sha256 and formatted_chars."""
    kind = rows.schema[conv].dataType
    made = formatted(conversations(linear(rows, conv, turn, role, text)))
    back = made.select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"),
                       read_loss(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1)).cast(kind).alias(conv),
        F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
