"""Sharding by balanced label propagation (op 8).

Linked documents move towards their neighbours' shards in a few rounds of
joins and aggregations, under quotas that keep the shards even; then one global
order by (label, group, id) is cut at exact row counts, so that counts differ
by one at most and at most ``n_shards - 1`` further groups are cut. Groups
larger than a shard are split, since the quotas bind them too.

Links are stars: every member of a group of equal texts links to the group's
smallest member, so a group of n rows has n - 1 links. Votes are counted per
(node, label) before they meet, and no task holds a group. DataFrame functions
only.

Defined results: NULL and empty text are equal (size 1, crc of nothing); a
NULL doc_id is an id of its own that sorts first; repeated rows keep one row
each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_positions
from .common import hash128, row_key, write_and_reread

ROUNDS = 8
SLACK = 0.05  # a shard may hold this share over its even part between rounds
ASKED = 0.5  # of the nodes, by hash, in a round


def _unit(*cols: Column) -> Column:
    """A deterministic number in [0, 1) from the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def balanced_label_propagation(nodes: DataFrame, links: DataFrame, n_shards: int, *,
                               rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """Labels 0 to ``n_shards - 1`` for ``nodes`` (node, weight), moved along
    ``links`` (src, dst; one direction is enough).

    Each round counts the labels of every node's neighbours, proposes the
    commonest one where it beats the node's own, and accepts proposals of each
    shard pair up to its quota: what the opposite direction sends back, plus a
    share of the room the target has left. Acceptance is decided by a hash of
    node and round, and only a share ``ASKED`` of the nodes is asked in a round, so
    neighbours do not swap places for ever. Ends early when nothing is proposed.
    """
    both = write_and_reread(
        links.select("src", "dst").unionByName(
            links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), "links")
    linked = both.select(F.col("src").alias("node")).distinct()
    labels = nodes.select("node", "weight",
                          F.pmod(F.xxhash64("node"), F.lit(n_shards)).cast("int").alias("label"))
    moving = write_and_reread(labels.join(linked, "node"), "labels")
    fixed = labels.join(linked, "node", "left_anti")
    still = {r["label"]: r["w"] for r in
             fixed.groupBy("label").agg(F.sum("weight").alias("w")).collect()}  # n_shards rows
    for k in range(rounds):
        loads = {r["label"]: r["w"] for r in
                 moving.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
        loads = {s: (loads.get(s) or 0) + (still.get(s) or 0) for s in range(n_shards)}
        votes = (both.join(moving.select(F.col("node").alias("dst"), "label"), "dst")
                 .groupBy("src", "label").agg(F.count(F.lit(1)).alias("n")))
        mine = moving.select(F.col("node").alias("src"), F.col("label").alias("own"), "weight")
        best = (votes.join(mine, "src").groupBy("src").agg(
            F.max(F.struct("n", (-F.col("label")).alias("minus"))).alias("top"),
            F.max(F.when(F.col("label") == F.col("own"), F.col("n")).otherwise(0)).alias("here"),
            F.first("own").alias("own"), F.first("weight").alias("weight")))
        asked = write_and_reread(
            best.select(F.col("src").alias("node"), "own", (-F.col("top.minus")).alias("to"), "weight")
            .filter((F.col("top.n") > F.col("here"))
                    & (_unit(F.col("src"), F.lit(1000 + k)) < ASKED)), "proposals")
        demand = {(r["own"], r["to"]): r["w"] for r in
                  asked.groupBy("own", "to").agg(F.sum("weight").alias("w")).collect()}
        if not demand:
            if k == 0 or k == rounds - 1:
                break
            continue
        cap = (1 + slack) * sum(loads.values()) / n_shards
        into = {s: sum(w for (_, b), w in demand.items() if b == s) for s in range(n_shards)}
        accept = F.lit(0.0)
        for (a, b), w in demand.items():  # at most n_shards squared entries
            quota = min(w, demand.get((b, a), 0)) + max(0.0, cap - loads[b]) * w / into[b]
            accept = F.when((F.col("own") == a) & (F.col("to") == b),
                            F.lit(min(1.0, float(quota) / float(w)))).otherwise(accept)
        moved = asked.filter(_unit(F.col("node"), F.lit(k)) < accept).select("node", "to")
        moving = write_and_reread(
            moving.join(moved, "node", "left")
            .select("node", "weight", F.coalesce("to", "label").alias("label")), "labels")
    return fixed.select("node", "label").unionByName(moving.select("node", "label"))


def shard_documents(docs: DataFrame, n_shards: int = 8, *, doc_id: str = "doc_id",
                    text: str = "text", rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    Law ``rows``: row counts of shards differ by one at most. Links join equal
    texts; ``slot`` is gapless from 0 in each shard.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    g1, g2 = hash128(body)
    base = write_and_reread(docs.select(
        F.struct(*row_key(F.col(doc_id), F.col(text))).alias("node"),
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.struct(g1.alias("g1"), g2.alias("g2"), F.octet_length(body).alias("g3")).alias("group")),
        "shard-base")
    nodes = base.groupBy("node", "group").agg(F.count(F.lit(1)).alias("weight"))
    heads = (nodes.groupBy("group").agg(F.min("node").alias("dst"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    links = (nodes.join(heads, "group").select(F.col("node").alias("src"), "dst")
             .filter("src != dst"))
    labels = balanced_label_propagation(nodes.select("node", "weight"), links, n_shards,
                                        rounds=rounds, slack=slack)
    placed = with_positions(base.join(labels, "node"),
                            ["label", "group", F.col("doc_id").asc_nulls_first(), "node"], "_rank")
    total = base.count()
    # the first rank of shard s is the least r with r * n div total = s
    return (placed.withColumn("shard", F.expr(f"cast((_rank * {n_shards}) div {total or 1} as int)"))
            .withColumn("slot", F.col("_rank")
                        - F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
