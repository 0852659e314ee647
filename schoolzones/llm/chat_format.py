"""Chat formatting of reply trees, with Spark's own functions only.

Messages name their parent. Self-joins that double the reach each time give every message its depth and the score of its
path (messages that no root reaches, being in a cycle, are left out); the branches of a tree are ranked by score (ties:
the smaller leaf), and the chosen leaves climb back the same way. So a reply chain of n messages takes about log2(n)
rounds, and only ids move until the paths are known. Each chosen path becomes one conversation.

The template writes each turn as START role newline text END newline. Inside roles and texts every control string (not
only the template's own) gets a backslash after its first character and every backslash is doubled, so a formatted
conversation holds control strings only where the template put them, and reading it back is exact. In a role a newline
gets a backslash before it.

A null text or role is empty; a null score counts 0; a message whose parent is missing starts a tree of its own; of
messages with the same tree and id, the first by parent, role, text and score is used. Null tree ids are one tree; a
null message id is left out. Other columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

#: The template's marks, and what other templates use.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

_ESCAPED = "|".join([r"\\"] + [f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL])


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ESCAPED, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def messages_of(messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None) -> DataFrame:
    """The messages under fixed names, one per tree and id."""
    cols = [
        F.coalesce(F.col(tree).cast("string"), F.lit("")).alias("tree"),
        F.col(tree).isNull().alias("no_tree"),
        F.col(tree).alias("tree_id"),
        F.col(node).alias("node"),
        F.col(parent).alias("parent"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)).alias("score"),
    ]
    rows = messages.where(F.col(node).isNotNull()).select(*cols)
    first = Window.partitionBy("tree", "no_tree", "node").orderBy("parent", "role", "text", "score")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


_KEY = ["tree", "no_tree"]


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, no_tree, leaf, branch, node, pos): the messages of the ``best`` branches of every tree, root first."""
    ids = stored(messages.select(*_KEY, "node", "parent", "score"), "messages")
    known = ids.select(*_KEY, F.col("node").alias("parent"), F.lit(True).alias("known"))
    start = ids.join(known, [*_KEY, "parent"], "left").select(
        *_KEY,
        "node",
        F.when(F.col("known"), F.col("parent")).alias("up"),
        F.col("score").alias("total"),
        F.lit(1).cast("long").alias("depth"),
    )
    state, rounds = stored(start, "jumps"), math.ceil(math.log2(ids.count() + 1)) + 1
    done, jumps = state.where("up is null"), []
    open_ = state.where("up is not null")
    while len(jumps) < rounds and not open_.isEmpty():  # only messages below a root not yet reached go on
        jumps.append(open_)
        far = done.union(open_).select(
            *_KEY,
            F.col("node").alias("up"),
            F.col("up").alias("up2"),
            F.col("total").alias("total2"),
            F.col("depth").alias("depth2"),
        )
        state = stored(
            open_.join(far, [*_KEY, "up"]).select(
                *_KEY,
                "node",
                F.col("up2").alias("up"),
                (F.col("total") + F.col("total2")).alias("total"),
                (F.col("depth") + F.col("depth2")).alias("depth"),
            ),
            "jumps",
        )
        done, open_ = done.union(state.where("up is null")), state.where("up is not null")
    parents = ids.where("parent is not null").select(*_KEY, F.col("parent").alias("node"))
    ranked = Window.partitionBy(*_KEY).orderBy(F.desc("total"), "node")
    reached = (
        done.join(parents, [*_KEY, "node"], "left_anti")
        .withColumn("branch", F.row_number().over(ranked))
        .where(F.col("branch") <= best)
        .select(*_KEY, F.col("node").alias("leaf"), "branch", "node", F.col("depth").alias("pos"))
    )
    reached = stored(reached, "reached")
    for k, jump in enumerate(jumps):
        up = jump.select(*_KEY, "node", "up")
        higher = reached.join(up, [*_KEY, "node"]).select(
            *_KEY, "leaf", "branch", F.col("up").alias("node"), (F.col("pos") - (1 << k)).alias("pos")
        )
        reached = stored(reached.union(higher), "reached")
    return reached


def formatted(messages: DataFrame, chosen: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(tree_id, leaf, branch, formatted, loss): one row per path; ``loss`` spans the texts of roles to learn from,
    as [begin, end) in characters of ``formatted``."""
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    path = Window.partitionBy(*_KEY, "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    turns = (
        chosen.join(messages, [*_KEY, "node"])
        .select(*_KEY, "tree_id", "leaf", "branch", "pos", "role", head.alias("head"), escape(F.col("text")).alias("body"))
        .withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
        .withColumn("at", F.coalesce(F.sum(F.length("piece")).over(path), F.lit(0)) + F.length("head"))
    )
    span = F.struct(F.col("at").alias("begin"), (F.col("at") + F.length("body")).alias("end"))
    whole = turns.groupBy(*_KEY, "tree_id", "leaf", "branch").agg(
        F.sort_array(
            F.collect_list(F.struct("pos", "piece", span.alias("span"), F.col("role").isin(*learn).alias("learn")))
        ).alias("turns")
    )
    return whole.select(
        "tree_id",
        "leaf",
        "branch",
        F.array_join(F.transform("turns", lambda t: t.piece), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t.learn), lambda t: t.span).alias("loss"),
    )


def read_turns(text: Column) -> Column:
    """A formatted conversation -> array of (role, text)."""
    pieces = F.split(text, f"{re.escape(END)}\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    pattern = r"(?s)^((?:[^\\\n]++|\\.)*+)\n(.*)$"

    def turn(piece: Column) -> Column:
        inside = F.substring(piece, len(START) + 1, (1 << 31) - 1)
        role, body = (F.regexp_extract(inside, pattern, i) for i in (1, 2))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def read_loss(text: Column, loss: Column) -> Column:
    """What the mask covers, one string per span."""
    return F.transform(loss, lambda s: unescape(F.substr(text, s.begin + 1, s.end - s.begin)))


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A linear table as messages: each row answers the one before, by turn (ties: role, then text)."""
    order = Window.partitionBy(conv).orderBy(turn, role, text)
    numbered = rows.select(conv, role, text, F.row_number().over(order).cast("long").alias("_node"))
    numbered = numbered.withColumn("_parent", F.when(F.col("_node") > 1, F.col("_node") - 1))
    return messages_of(numbered, conv, "_node", "_parent", role, text, None)


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) for every conversation of a linear table."""
    messages = stored(conversations(rows), "turns")
    return formatted(messages, paths(messages)).select(F.col("tree_id").alias("conv_id"), "formatted", "loss")
