"""Conversations from reply trees.

Messages point to the message they answer. Self-joins that double their reach enumerate every path from a root to a leaf
in as many rounds as the logarithm of the longest one. The branches of a conversation are ranked by the mean score of
their messages, and each chosen path becomes one text: every turn between marks, with control strings inside texts made
harmless in a way that can be undone, and with the spans of the text the loss is taken on.

Defined results: a null text or role counts as empty, a null score as 0; a null conversation id is a conversation of its
own; a message whose parent is missing is a root; messages that hang on a circle of replies belong to no path; equally
ranked branches are taken in order of the leaf's number; of several messages with one number each stands for itself, as
leaf and as parent, so numbers should be unique (`chained` makes them so); an empty table gives an empty result. Other
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import staged

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
#: After its first character, a control string gets one more backslash than it has.
CONTROLS = ((r"<", r"(?=\||/?s>)"), (r"\[", r"(?=/?INST\])"))


def escaped(text: Column) -> Column:
    for first, rest in CONTROLS:
        text = F.regexp_replace(text, rf"{first}(\\*){rest}", rf"{first[-1]}\\$1")
    return text


def unescaped(text: Column) -> Column:
    for first, rest in CONTROLS:
        text = F.regexp_replace(text, rf"{first}\\(\\*){rest}", rf"{first[-1]}$1")
    return text


def _role_line(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_of(line: Column) -> Column:
    return F.replace(F.replace(unescaped(line), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def chained(rows: DataFrame, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """Messages of conversations without replies: each answers the one before it. Ties by role and text."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select(F.col(conversation).alias("conv_id"), F.col(order).alias("turn"), "role", "text")
    return rows.select(
        "conv_id",
        F.row_number().over(w).cast("bigint").alias("node"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))


def paths(messages: DataFrame) -> DataFrame:
    """conv_id, leaf, node, distance (from the leaf) of every message on every root-to-leaf path.

    `messages`: conv_id, node, parent. The jumps of each round are written to the shared folder.
    """
    nodes = messages.select("conv_id", "node")
    links = messages.where("parent IS NOT NULL").select("conv_id", "node", "parent")
    jumps = [
        staged(
            links.alias("a")
            .join(nodes.alias("b"), _same("a", "b") & (F.col("a.parent") == F.col("b.node")))
            .select("a.conv_id", "a.node", F.col("a.parent").alias("up"))
        )
    ]
    left = messages.count()
    while (reach := 1 << (len(jumps) - 1)) <= left and not jumps[-1].isEmpty():
        last = jumps[-1]
        jumps.append(
            staged(
                last.alias("a")
                .join(last.alias("b"), _same("a", "b") & (F.col("a.up") == F.col("b.node")))
                .select("a.conv_id", "a.node", "b.up")
            )
        )
    answered = jumps[0].select("conv_id", F.col("up").alias("node"))
    match = _same("a", "b") & (F.col("a.node") == F.col("b.node"))
    leaves = nodes.alias("a").join(answered.alias("b"), match, "left_anti")
    if reach > left:  # still moving after as many steps as there are messages: on a circle
        leaves = leaves.alias("a").join(jumps[-1].alias("b"), match, "left_anti")
    found = leaves.select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("distance"))
    for k, jump in enumerate(jumps[:-1] or jumps):
        further = (
            found.alias("a")
            .join(jump.alias("b"), match)
            .select("a.conv_id", "a.leaf", F.col("b.up").alias("node"), (F.col("a.distance") + (1 << k)).alias("distance"))
        )
        found = staged(found.unionByName(further))
    return found


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best branches of every conversation: conv_id, leaf, branch (rank from 1), score, text, loss_spans.

    `messages`: conv_id, node, parent, role, text, score. A span is start (from 0) and length, in characters of `text`.
    """
    messages = staged(messages.select("conv_id", "node", "parent", "role", "text", "score"))
    on_path = paths(messages)
    joined = on_path.alias("a").join(messages.alias("b"), _same("a", "b") & (F.col("a.node") == F.col("b.node")))
    ranked = (
        joined.groupBy("a.conv_id", "a.leaf")
        .agg(F.avg(F.coalesce("b.score", F.lit(0.0))).alias("score"))
        .withColumn("branch", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "leaf")))
        .where(F.col("branch") <= branches)
    )
    turns = (
        joined.select("a.conv_id", "a.leaf", "a.distance", F.coalesce("b.role", F.lit("")).alias("role"), F.coalesce("b.text", F.lit("")).alias("text"))
        .select(
            "conv_id",
            "leaf",
            F.struct(
                (-F.col("distance")).alias("at"),
                F.concat(F.lit(BEGIN), _role_line(F.col("role")), F.lit("\n")).alias("head"),
                escaped(F.col("text")).alias("body"),
                (F.col("role") == LOSS_ROLE).alias("loss"),
            ).alias("turn"),
        )
    )
    chosen = turns.alias("a").join(ranked.alias("b"), _same("a", "b") & (F.col("a.leaf") == F.col("b.leaf")))
    whole = chosen.groupBy("a.conv_id", "a.leaf", "b.branch", "b.score").agg(F.sort_array(F.collect_list("a.turn")).alias("turns"))
    span = "struct<start:bigint,length:bigint>"
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(
                t["loss"],
                F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).cast("bigint").alias("length")))),
            )
            .otherwise(a["spans"])
            .cast(f"array<{span}>")
            .alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return whole.select(
        "conv_id",
        "leaf",
        "branch",
        "score",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        spans.alias("loss_spans"),
    )


def turns_of(text: Column) -> Column:
    """Read back from a formatted text: an array of role and text."""
    pieces = F.split(text, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    line = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            _role_of(F.substring(line(p), len(BEGIN) + 1, 2**31 - 1)).alias("role"),
            unescaped(F.substr(p, F.length(line(p)) + 2)).alias("text"),
        ),
    )


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing in between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
