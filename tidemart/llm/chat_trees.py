"""Chat formatting from reply trees (op 1), DataFrame functions only.

Messages form trees by (tree, node, parent). Self-joins with doubling pointers
find every node's root distance and path score in about log2(depth) rounds;
leaves are ranked per tree by the score of their branch; the chosen branches
are walked back to the root through the same pointer tables (each ancestor is
reached exactly once), and each is formatted as one conversation with a loss
mask over the assistant's text.

Defined results: NULL text and role are empty; a message whose parent is NULL
or missing starts a tree; messages on a reply cycle have no root and belong to
no path; (tree, node) identifies a message: of rows that share it one is kept
whole, the first by parent, score, role and text (NULLs first); a NULL score
counts as 0; a NULL tree is a tree of its own; ties in score go to the smaller
leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_and_reread

MAX_DOUBLINGS = 40  # paths of up to 2**40 messages


@dataclass(frozen=True)
class Template:
    """One turn is ``open role mid text close``. Inside roles and texts every
    control string gets a backslash after its first character, and one that
    already holds backslashes there gets one more; undoing it takes one away."""

    open: str = "[INST]"
    mid: str = "[/INST]"
    close: str = "</s>"
    # fixed values: first characters, and what follows them in the control strings
    firsts: str = r"[\[<]"
    rests: str = r"INST\]|/INST\]|/s>"

    def escape(self, c: Column) -> Column:
        return F.regexp_replace(c, rf"({self.firsts})(\\*)({self.rests})", r"$1\\$2$3")

    def unescape(self, c: Column) -> Column:
        return F.regexp_replace(c, rf"({self.firsts})\\(\\*)({self.rests})", "$1$2$3")

    def turn(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.open), self.escape(role), F.lit(self.mid),
                        self.escape(text), F.lit(self.close))

    def parse(self, formatted: Column) -> Column:
        """array<struct<role, text>> of a formatted conversation, unescaped."""
        pieces = F.filter(F.split(formatted, _quoted(self.close)), lambda p: p != "")

        def turn(p: Column) -> Column:
            body = F.substring(p, len(self.open) + 1, F.length(p))
            cut = F.instr(body, self.mid)
            return F.struct(
                self.unescape(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                self.unescape(F.substring(body, cut + len(self.mid), F.length(body))).alias("text"))

        return F.transform(pieces, turn)


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"


def _one_row_each(messages: DataFrame) -> DataFrame:
    """Of rows that share (tree, node) the smallest one, whole."""
    rest = [c for c in ("parent", "score", "role", "text") if c in messages.columns]
    return messages.groupBy("tree", "node").agg(F.min(F.struct(*rest)).alias("m")).select("tree", "node", "m.*")


def chosen_paths(messages: DataFrame, *, top: int = 1) -> DataFrame:
    """``tree, leaf, path_rank, path_score, node, depth`` of the ``top`` best
    branches of each tree. ``messages``: tree, node, parent, score."""
    m = write_and_reread(_one_row_each(messages).withColumn("score", F.coalesce("score", F.lit(0.0))), "messages")
    known = m.select("tree", F.col("node").alias("parent"))
    linked = (m.select("tree", "node", "parent").filter("parent is not null")
              .join(known.withColumnRenamed("tree", "_t"),
                    F.col("tree").eqNullSafe(F.col("_t")) & (m["parent"] == known["parent"]))
              .select("tree", "node", known["parent"].alias("jump")))
    state = m.join(linked.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "jump"),
                   F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")), "left"
                   ).select("tree", "node", "jump", F.lit(0).cast("bigint").alias("depth"),
                            F.col("score").alias("path_score"))
    # depth and score of the nodes passed so far, this node in, the jump's out
    state = state.withColumn("depth", F.when(F.col("jump").isNotNull(), 1).otherwise(0).cast("bigint"))
    levels: list[DataFrame] = []
    n_nodes = m.count()
    for _ in range(MAX_DOUBLINGS):
        state = write_and_reread(state, "jumps")
        jumps = state.filter("jump is not null").select("tree", "node", "jump")
        # nodes that still jump after more steps than there are nodes are on, or
        # hang from, a cycle
        if jumps.isEmpty() or 2 ** len(levels) > n_nodes:
            break
        levels.append(jumps)
        ahead = state.select(F.col("tree").alias("_t"), F.col("node").alias("_n"),
                             F.col("jump").alias("_jump"), F.col("depth").alias("_depth"),
                             F.col("path_score").alias("_score"))
        going = state.filter("jump is not null").join(
            ahead, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("jump") == F.col("_n")))
        state = (state.filter("jump is null").unionByName(going.select(
            "tree", "node", F.col("_jump").alias("jump"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("path_score") + F.col("_score")).alias("path_score"))))
    rooted = state.filter("jump is null")
    parents = linked.select(F.col("tree").alias("_t"), F.col("jump").alias("_n")).distinct()
    leaves = rooted.join(parents, F.col("tree").eqNullSafe(F.col("_t"))
                         & (F.col("node") == F.col("_n")), "left_anti")
    # a rank filter: Spark keeps only ``top`` rows per tree before the shuffle
    best = Window.partitionBy("tree").orderBy(F.desc("path_score"), "node")
    chosen = (leaves.withColumn("path_rank", F.row_number().over(best)).filter(F.col("path_rank") <= top)
              .select("tree", F.col("node").alias("leaf"), "path_rank", "path_score", "node", "depth"))
    for k in range(len(levels) - 1, -1, -1):
        up = levels[k].select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "jump")
        above = (chosen.join(up, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")))
                 .select("tree", "leaf", "path_rank", "path_score", F.col("jump").alias("node"),
                         (F.col("depth") - 2 ** k).alias("depth")))
        chosen = chosen.unionByName(above)
        if k % 4 == 3:
            chosen = write_and_reread(chosen, "paths")
    return chosen


def format_conversations(messages: DataFrame, *, top: int = 1, loss_role: str = "assistant",
                         template: Template = Template()) -> DataFrame:
    """One row per chosen path: ``tree, leaf, path_rank, path_score, n_turns,
    formatted, loss_spans`` (array of start, end in code points of
    ``formatted``, covering each loss-role text in its escaped form).

    ``messages``: tree, node, parent, role, text, score.
    """
    messages = _one_row_each(messages)
    paths = chosen_paths(messages.select("tree", "node", "parent", "score"), top=top)
    said = messages.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"))
    turns = paths.join(said, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")))
    turn = F.struct("depth", F.col("said.role").alias("role"),
                    template.escape(F.col("said.role")).alias("role_out"),
                    template.escape(F.col("said.text")).alias("text_out"))
    grouped = turns.groupBy("tree", "leaf", "path_rank", "path_score").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))

    def lengths(t: Column) -> Column:  # of what stands before and in the text
        return F.length(t["role_out"]) + len(template.open) + len(template.mid)

    # start of each text: a running sum over the turns, kept as (next turn's start, spans)
    span = F.aggregate(
        "turns", F.struct(F.lit(0).cast("bigint").alias("at"),
                          F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + lengths(t) + F.length(t["text_out"]) + len(template.close)).alias("at"),
            F.when(t["role"] == loss_role, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + lengths(t)).alias("start"),
                (acc["at"] + lengths(t) + F.length(t["text_out"])).alias("end")))))
            .otherwise(acc["spans"]).alias("spans")))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(
        F.lit(template.open), t["role_out"], F.lit(template.mid), t["text_out"],
        F.lit(template.close))), "")
    return grouped.select("tree", "leaf", "path_rank", "path_score",
                          F.size("turns").cast("bigint").alias("n_turns"),
                          formatted.alias("formatted"), span["spans"].alias("loss_spans"))


def masked_text(formatted: Column, spans: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: template.unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def threads_from_turns(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn",
                       role: str = "role", text: str = "text") -> DataFrame:
    """Messages of plain conversations: each row replies to the row before it
    (by turn; NULL first, ties by role and text, repeated rows kept)."""
    order = Window.partitionBy("tree").orderBy(F.col("_turn").asc_nulls_first(),
                                               F.col("role").asc_nulls_first(),
                                               F.col("text").asc_nulls_first())
    said = rows.select(F.col(conv).alias("tree"), F.col(turn).alias("_turn"),
                       F.col(role).alias("role"), F.col(text).alias("text"))
    node = F.row_number().over(order).cast("bigint")
    return said.withColumn("node", node).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(1.0).alias("score"))
