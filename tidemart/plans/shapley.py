"""Shapley values of boosted trees: what each feature adds to a row's margin.

The model's own saved node table is the source. A leaf's path, one entry per
distinct feature on it, says in which interval the feature must lie and which
share of the training weight went that way. For a row only one thing matters per
entry: whether it lies in the interval. So each leaf has one small table from
the pattern of yes and no to the contributions of its features (the
path-dependent conditional expectation, all subsets of the path's features), and
a row's contributions are the sum of one entry per leaf. Rows stay where they
are; the tables (leaves times patterns) are bounded by the model and broadcast.

For each row base + contributions = margin, to rounding.
"""

from __future__ import annotations

from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows whose patterns are looked up at once.
_ROWS = 1024


class Leaves(NamedTuple):
    """The leaves of one tree; entries are padded to the deepest path."""

    feature: np.ndarray  # (leaves, depth), -1 where unused
    above: np.ndarray    # the row's value must be larger than this
    upto: np.ndarray     # and not larger than this
    share: np.ndarray    # training weight that fulfils the entry, of that which reached it
    value: np.ndarray    # (leaves,) times the tree's weight


def node_table(spark: SparkSession, model, path: str) -> DataFrame:
    """tree, id, value, weight, left, right, feature, threshold of every node of
    a tree ensemble, as saved under ``path``."""
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    if not spark.read.parquet(f"{path}/data").filter(n["split"]["numCategories"] > 0).isEmpty():
        raise ValueError("splits on categories are not supported: index them as numbers")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("value"),
        n["impurityStats"][0].alias("weight"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"))


def _tree_leaves(nodes: dict, weight: float) -> Leaves:
    found = []
    stack = [(0, {})]  # node, feature -> (above, upto, share)
    while stack:
        i, path = stack.pop()
        n = nodes[i]
        if n["left"] < 0:
            found.append((path, n["value"] * weight))
            continue
        f, t = n["feature"], n["threshold"]
        above, upto, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, low, high in ((n["left"], above, min(upto, t)), (n["right"], max(above, t), upto)):
            part = nodes[child]["weight"] / n["weight"] if n["weight"] else 0.0
            stack.append((child, {**path, f: (low, high, share * part)}))
    depth = max(1, max(len(p) for p, _ in found))
    out = Leaves(np.full((len(found), depth), -1), np.full((len(found), depth), -np.inf),
                 np.full((len(found), depth), np.inf), np.ones((len(found), depth)), np.array([v for _, v in found]))
    for k, (path, _) in enumerate(found):
        for j, (f, (low, high, share)) in enumerate(path.items()):
            out.feature[k, j], out.above[k, j], out.upto[k, j], out.share[k, j] = f, low, high, share
    return out


def ensemble_leaves(nodes: DataFrame, weights: list[float]) -> list[Leaves]:
    """Bounded by the model: trees times nodes of a tree."""
    trees: dict[int, dict] = {}
    for r in nodes.toLocalIterator():
        trees.setdefault(r["tree"], {})[r["id"]] = r
    return [_tree_leaves(trees[t], weights[t]) for t in sorted(trees)]


def pattern_table(leaves: Leaves, n_features: int) -> tuple[np.ndarray, float]:
    """(leaves, patterns, features): contributions of a leaf if the entries in
    the pattern's bits are fulfilled; and the tree's expected value."""
    n, depth = leaves.feature.shape
    bits = (np.arange(1 << depth)[:, None] >> np.arange(depth)) & 1  # of patterns and of subsets
    # value of a leaf when the subset's features are known and the others averaged
    known = np.ones((n, len(bits), len(bits)))
    for j in range(depth):
        yes = bits[:, j].astype(float)[None, :, None]
        known *= np.where(bits[:, j][None, None, :] == 1, yes, leaves.share[:, j][:, None, None])
    known *= leaves.value[:, None, None]
    out = np.zeros((n, len(bits), n_features))
    used = leaves.feature >= 0
    d = used.sum(axis=1)
    for j in range(depth):
        for s in np.flatnonzero(bits[:, j] == 0):
            size = int(bits[s].sum())
            # subsets that name an unused entry are not of this leaf
            fits = used[:, j] & (used | (bits[s] == 0)).all(axis=1)
            weight = np.array([factorial(size) * factorial(k - size - 1) / factorial(k) if f else 0.0
                               for k, f in zip(d.tolist(), fits.tolist())])
            gain = weight[:, None] * (known[:, :, s | (1 << j)] - known[:, :, s])
            rows = np.flatnonzero(used[:, j])
            out[rows, :, leaves.feature[rows, j]] += gain[rows]
    return out, float(known[:, 0, 0].sum())


def row_contributions(x: np.ndarray, tables: list[tuple[Leaves, np.ndarray]], n_features: int) -> np.ndarray:
    """(rows, features) for a block of rows."""
    out = np.zeros((len(x), n_features))
    for leaves, table in tables:
        v = x[:, np.maximum(leaves.feature, 0)]
        yes = (leaves.feature < 0) | ((v > leaves.above) & (v <= leaves.upto))
        pattern = (yes << np.arange(leaves.feature.shape[1])).sum(axis=2)
        out += table[np.arange(len(table)), pattern].sum(axis=1)
    return out


def tree_contributions(df: DataFrame, model, path: str, *, key: str, features: str = "features") -> DataFrame:
    """``key``, ``base`` and ``contributions`` (one per feature) to the margin
    of every row of ``df``; ``path``: where the node table is saved."""
    spark = df.sparkSession
    leaves = ensemble_leaves(node_table(spark, model, path), list(model.treeWeights))
    shared = spark.sparkContext.broadcast(leaves)
    n = model.numFeatures
    out = df.select(key, vector_to_array(features).alias("x"))
    schema = T.StructType([out.schema[key], T.StructField("base", T.DoubleType()),
                           T.StructField("contributions", T.ArrayType(T.DoubleType()))])

    def run(batches):
        made = [(t, *pattern_table(t, n)) for t in shared.value]
        tables, base = [(t, table) for t, table, _ in made], sum(b for *_, b in made)
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(b.num_rows, n)
            got = np.concatenate([row_contributions(x[i:i + _ROWS], tables, n)
                                  for i in range(0, len(x), _ROWS)]) if len(x) else np.zeros((0, n))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * n, pa.int32()), pa.array(got.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(x), base)), flat], names=schema.names)

    return out.mapInArrow(run, schema)


def importance(contributions: DataFrame, features: list[str]) -> DataFrame:
    """feature, importance: mean absolute contribution over the rows."""
    rows = contributions.select(F.posexplode("contributions").alias("i", "c"))
    names = F.array(*map(F.lit, features))
    return rows.groupBy("i").agg(F.avg(F.abs("c")).alias("importance")).select(
        F.get(names, F.col("i")).alias("feature"), "importance")
