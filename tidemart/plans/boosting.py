"""Gradient-boosted trees of Spark's kind, grown in one barrier stage.

``GBTClassifier`` runs two small stages per tree level, so hundreds of rounds are
mostly their fixed cost, and candidates that differ in the weights alone each
start again from the rows. Here every task keeps its rows as bin numbers, for all
candidates at once, and tasks add up what a level needs: the weight and target
sums per node, feature and bin, whose size depends on bins and depth, not on the
rows. All tasks then choose the same splits. (``BarrierTaskContext.allGather``
waits a second a call, several thousand times here, so only the first call is
made; the sums go by files in the shared work folder, two steps of them at a time.)

The rules are those of ``GBTClassifier`` with logistic loss (thresholds between
weighted quantiles of a sample of ``max(maxBins^2, 10000)`` rows, all of them if
there are fewer; variance gain, first best split; first tree with weight 1, later
ones with the step), and the result is its model, read from its own stored form.
Weights and weighted targets are rounded to multiples of a power of two by which
their sums are exact, so the trees do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import json
import math
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import write_and_reread
from ..session import remove, work_path

BINS = 32
SAMPLE = max(BINS * BINS, 10_000)
TASK_ROWS = 16_384  # fewer rows are not worth another task
MAX_TASKS = 96      # each reads the sums of all others

_NODES = ("fit int, treeID int, nodeData struct<id int, prediction double, impurity double, "
          "impurityStats array<double>, rawCount bigint, gain double, leftChild int, rightChild int, "
          "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")
_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                    ("numCategories", pa.int32())])
_ARROW = pa.schema([("fit", pa.int32()), ("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
    ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
    ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)]))])


def split_points(values: np.ndarray, weights: np.ndarray, total: float, splits: int) -> list[float]:
    """Thresholds of one feature, as Spark's trees choose them: between any two
    neighbouring values if these are few, else near the weighted quantiles.
    ``total`` is the weight the sample stands for; what the other values leave of
    it falls to zero, and where they exceed it there are more than ``splits``."""
    some = values != 0
    distinct, place = np.unique(values[some], return_inverse=True)
    counts = np.bincount(place, weights=weights[some], minlength=len(distinct))
    rest = total - counts.sum()
    if rest > np.finfo(float).eps * counts.sum() * 100:
        at = int(np.searchsorted(distinct, 0.0))
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, rest)
    between = ((distinct[:-1] + distinct[1:]) / 2).tolist()
    if len(between) <= splits:
        return between
    stride = total / (splits + 1)
    found, target, current = [], stride, float(counts[0])
    for i, more in enumerate(counts[1:].tolist()):
        before, current = current, current + more
        if abs(before - target) < abs(current - target):
            found.append(between[i])
            target += stride
    return found


def _exact(x: np.ndarray, bound: float) -> np.ndarray:
    """``x`` to multiples of a power of two of which 2^52 are ``bound`` or more."""
    unit = 2.0 ** (52 - math.ceil(math.log2(bound)))
    return np.rint(x * unit) / unit


class _Peers:
    """The tasks of one attempt of the stage; each adds up what all have given."""

    def __init__(self, ctx: BarrierTaskContext, folder: str):
        from pyarrow import fs

        attempt = ctx.allGather(uuid.uuid4().hex)
        self.me, self.count, self.step = ctx.partitionId(), len(attempt), 0
        if re.match(r"file:|/", folder):
            self.store, inner = fs.LocalFileSystem(), re.sub(r"^file:/*", "/", folder)
        else:
            self.store, inner = fs.FileSystem.from_uri(folder)
        self.folder = f"{inner}/{attempt[0]}"
        self.store.create_dir(self.folder, recursive=True)

    def _file(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def summed(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """Each array, added up over all tasks."""
        if self.count == 1:
            return parts
        mine = np.concatenate([p.ravel() for p in parts])
        given = self._file(self.step, self.me)
        with self.store.open_output_stream(f"{given}.part", compression=None) as f:
            f.write(mine.tobytes())
        self.store.move(f"{given}.part", given)
        total, pause = np.zeros(len(mine)), 0.0005
        for task in range(self.count):
            path = self._file(self.step, task)
            while not self.store.get_file_info(path).is_file:
                time.sleep(pause)  # Spark ends this task if another one fails
                pause = min(0.02, pause * 1.5)
            with self.store.open_input_file(path) as f:
                total += np.frombuffer(f.read())
        if self.step:  # all have given this step's, so all have read the last one's
            self.store.delete_file(self._file(self.step - 1, self.me))
        self.step += 1
        return [t.reshape(p.shape) for t, p in zip(np.split(total, np.cumsum([p.size for p in parts])[:-1]), parts)]


@dataclass
class _Tree:
    """Nodes by heap number: the root is 1, the children of i are 2i and 2i + 1."""

    depth: int
    feature: np.ndarray = field(init=False)  # -1: a leaf, or no node

    def __post_init__(self):
        size = 2 << self.depth
        self.feature, self.bin = np.full(size, -1), np.zeros(size, int)
        self.weight, self.target, self.gain = np.zeros(size), np.zeros(size), np.full(size, -1.0)

    def values(self) -> np.ndarray:
        return np.divide(self.target, self.weight, out=np.zeros(len(self.weight)), where=self.weight > 0)


class _Growing:
    """One candidate on one task's rows."""

    def __init__(self, x: np.ndarray, label: np.ndarray, weight: np.ndarray, points: list[list[float]],
                 total: float, depth: int, step: float):
        self.points, self.depth, self.step = points, depth, step
        self.width = max(BINS, 1 + max(map(len, points)))  # bins of a feature; a heavy sample makes more than BINS
        self.bins = np.empty(x.shape, np.min_scalar_type(self.width - 1), order="F")
        for f, p in enumerate(points):
            self.bins[:, f] = np.searchsorted(p, x[:, f])
        self.flat, self.offset = self.bins.ravel(order="F"), np.arange(len(x))
        self.y, self.margin = 2.0 * label - 1, np.zeros(len(x))
        self.bound = 4 * total  # targets lie between -4 and 4
        self.w = _exact(weight, self.bound)
        self.open = np.array([[s < len(p) for s in range(self.width - 1)] for p in points])
        self.trees: list[_Tree] = []
        self.leaf_stats: list[np.ndarray] = []

    def start(self) -> None:
        target = 4 * self.y / (1 + np.exp(2 * self.y * self.margin)) if self.trees else self.y
        self.wt = _exact(self.w * target, self.bound)
        self.squares = self.wt * target
        self.node = np.ones(len(self.y), int)
        self.trees.append(_Tree(self.depth))
        self.asked, self.sums = np.array([1]), {}  # nodes to count, sums of the level above

    def counted(self) -> np.ndarray:
        """Weight and target sums of the asked nodes, by feature and bin, over this task's rows."""
        out = np.zeros((2, len(self.asked), len(self.points), self.width))
        slot = np.full(2 << self.depth, -1)
        slot[self.asked] = np.arange(len(self.asked))
        at = slot[self.node]
        rows = np.flatnonzero(at >= 0)
        everything = len(rows) == len(at)
        base, w, wt = (at, self.w, self.wt) if everything else (at[rows], self.w[rows], self.wt[rows])
        base = base * self.width
        for f in range(len(self.points)):
            column = self.bins[:, f] if everything else self.bins[:, f][rows]
            key = base + column
            for k, values in enumerate((w, wt)):
                out[k, :, f] = np.bincount(key, values, len(self.asked) * self.width).reshape(-1, self.width)
        return out

    def split(self, level: int, total: np.ndarray) -> None:
        """Splits the level's nodes from the sums over all tasks and moves the rows down."""
        t = self.trees[-1]
        sums = {i: total[:, k] for k, i in enumerate(self.asked.tolist())}
        for i in list(sums):  # the other child is what its sibling leaves of the parent
            if i > 1:
                sums[i ^ 1] = self.sums[i >> 1] - sums[i]
        self.sums, asked = sums, []
        for i, (w, s) in sorted(sums.items()):
            if level == 0:
                t.weight[1], t.target[1] = w[0].sum(), s[0].sum()
            all_w, all_s = t.weight[i], t.target[i]
            left_w, left_s = np.cumsum(w, axis=1)[:, :-1], np.cumsum(s, axis=1)[:, :-1]
            right_w, right_s = all_w - left_w, all_s - left_s
            able = self.open & (left_w > 0) & (right_w > 0)
            if not able.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                parts = left_s ** 2 / left_w + right_s ** 2 / right_w
                gain = np.where(able, (parts - all_s ** 2 / all_w) / all_w, -np.inf)
            f, b = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[f, b] <= 4 * np.finfo(float).eps * parts[f, b] / all_w:  # nothing but rounding
                continue
            t.feature[i], t.bin[i], t.gain[i] = f, b, gain[f, b]
            t.weight[2 * i:2 * i + 2] = left_w[f, b], right_w[f, b]
            t.target[2 * i:2 * i + 2] = left_s[f, b], right_s[f, b]
            asked.append(2 * i + int(right_w[f, b] < left_w[f, b]))
        self.asked = np.array(asked, int)
        f = t.feature[self.node]
        right = self.flat[np.maximum(f, 0) * len(f) + self.offset] > t.bin[self.node]
        self.node = np.where(f >= 0, 2 * self.node + right, self.node)

    def finish(self) -> None:
        t = self.trees[-1]
        self.margin += (self.step if len(self.trees) > 1 else 1.0) * t.values()[self.node]
        size = len(t.feature)
        self.leaf_stats.append(np.stack([np.bincount(self.node, minlength=size).astype(float),
                                         np.bincount(self.node, self.squares, size)]))

    def nodes(self, fit: int, stats: np.ndarray) -> Iterator[dict]:
        """All trees' nodes as Spark stores them; ``stats``: rows and target squares of the leaves."""
        for tree, (t, (rows, squares)) in enumerate(zip(self.trees, stats)):
            for i in range((1 << self.depth) - 1, 0, -1):
                if t.feature[i] >= 0:
                    rows[i], squares[i] = rows[2 * i] + rows[2 * i + 1], squares[2 * i] + squares[2 * i + 1]
            inner = t.feature >= 0
            there = [1] + [c for i in np.flatnonzero(inner).tolist() for c in (2 * i, 2 * i + 1)]
            number, values = {i: k for k, i in enumerate(sorted(there))}, t.values()
            for i, k in number.items():
                f = int(t.feature[i])
                yield {"fit": fit, "treeID": tree, "nodeData": {
                    "id": k, "prediction": float(values[i]),
                    "impurity": max(0.0, float(squares[i] / t.weight[i] - values[i] ** 2)),
                    "impurityStats": [float(t.weight[i]), float(t.target[i]), float(squares[i])],
                    "rawCount": int(rows[i]), "gain": float(t.gain[i]),
                    "leftChild": number[2 * i] if inner[i] else -1, "rightChild": number[2 * i + 1] if inner[i] else -1,
                    "split": {"featureIndex": f, "numCategories": -1,
                              "leftCategoriesOrThreshold": [self.points[f][t.bin[i]]] if inner[i] else []}}}


def _grow(batches: Iterator[pa.RecordBatch], folder: str, points: list, totals: list[float], rounds: int, depth: int,
          step: float) -> Iterator[pa.RecordBatch]:
    peers = _Peers(BarrierTaskContext.get(), folder)
    width = len(points[0])
    parts = [(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width),
              b.column(1).to_numpy(zero_copy_only=False),
              b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(points))) for b in batches]
    x, label, weight = (np.concatenate([np.empty(shape), *(p[k] for p in parts)]) for k, shape in enumerate(
        ((0, width), 0, (0, len(points)))))
    fits = [_Growing(x, label, weight[:, k], p, totals[k], depth, step) for k, p in enumerate(points)]
    for _ in range(rounds):
        for g in fits:
            g.start()
        for level in range(depth):
            for g, total in zip(fits, peers.summed([g.counted() for g in fits])):
                g.split(level, total)
        for g in fits:
            g.finish()
    stats = peers.summed([np.stack(g.leaf_stats) for g in fits])
    if peers.me == 0:  # all tasks hold the same trees
        for k, (g, s) in enumerate(zip(fits, stats)):
            yield pa.RecordBatch.from_pylist(list(g.nodes(k, s)), schema=_ARROW)


def slots(spark: SparkSession) -> int:
    """Tasks that can run at once; a barrier stage must not have more."""
    sc = spark.sparkContext._jsc.sc()
    return max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


@dataclass(frozen=True)
class Booster:
    """An estimator of boosted trees for labels 0 and 1."""

    rounds: int
    step: float
    depth: int
    seed: int
    label: str
    features: str = "features"
    weight: str = "w"

    def fit(self, df: DataFrame) -> GBTClassificationModel:
        return self.fit_each(df, [self.weight])[0]

    def fit_each(self, df: DataFrame, weights: list[str], tasks: int | None = None) -> list[GBTClassificationModel]:
        """One model per weight column, all grown in the same pass."""
        spark = df.sparkSession
        if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":  # has no barrier stages
            return [self._classifier().setWeightCol(w).fit(df) for w in weights]
        x, y = vector_to_array(self.features), F.col(self.label).cast("double")
        bad = ~F.coalesce(y.isin(0, 1), F.lit(False)) | F.exists(x, lambda v: F.isnan(v)) | x.isNull()
        for w in weights:
            bad = bad | ~F.coalesce(F.col(w) > 0, F.lit(False))
        n, wrong, width, *totals = df.agg(
            F.count(F.lit(1)), F.count_if(bad), F.max(F.size(x)), *[F.sum(F.col(w).cast("double")) for w in weights]).first()
        if not n or wrong:
            raise ValueError(f"{wrong} of {n} rows without label 0 or 1, features or a positive weight")
        w = F.array(*[F.col(c).cast("double") for c in weights])
        rows = df.select(x.alias("x"), y.alias("y"), w.alias("w"))
        points = self._points(rows, n, width, totals)
        if tasks is None:
            tasks = min(slots(spark), MAX_TASKS, math.ceil(n / TASK_ROWS))
        rounds, depth, step = self.rounds, self.depth, self.step
        folder = work_path(spark, "sums", uuid.uuid4().hex)
        grown = write_and_reread(rows.repartition(tasks).mapInArrow(
            lambda batches: _grow(batches, folder, points, totals, rounds, depth, step), _NODES, barrier=True),
            "boosted-nodes")
        remove(spark, folder)
        return [self._model(grown.filter(F.col("fit") == k).select("treeID", "nodeData"), width, c)
                for k, c in enumerate(weights)]

    def _points(self, rows: DataFrame, n: int, width: int, totals: list[float]) -> list[list[list[float]]]:
        """Thresholds per weight and feature; each feature's are found in its own group."""
        share = min(1.0, SAMPLE / n)
        splits = min(BINS, n) - 1
        sample = rows.sample(False, share, self.seed) if share < 1 else rows

        def of_one(key, pdf):
            weights = np.stack(pdf["w"].to_numpy())
            values = pdf["value"].to_numpy(float)
            return type(pdf)([(int(key[0]), k, split_points(values, weights[:, k], t * share, splits))
                              for k, t in enumerate(totals)], columns=["feature", "fit", "points"])

        found = (sample.select(F.posexplode("x").alias("feature", "value"), "w").groupBy("feature")
                 .applyInPandas(of_one, "feature int, fit int, points array<double>").collect())
        points: list = [[[] for _ in range(width)] for _ in totals]
        for r in found:
            points[r["fit"]][r["feature"]] = list(r["points"])
        return points

    def _classifier(self) -> GBTClassifier:
        return GBTClassifier(featuresCol=self.features, labelCol=self.label, weightCol=self.weight, maxIter=self.rounds,
                             stepSize=self.step, maxDepth=self.depth, maxBins=BINS, seed=self.seed)

    def _model(self, nodes: DataFrame, width: int, weight: str) -> GBTClassificationModel:
        """The nodes in the form Spark stores its model in, read back as that model."""
        spark = nodes.sparkSession
        path = work_path(spark, "models", f"gbt-{uuid.uuid4().hex}")
        c = self._classifier().setWeightCol(weight)

        def metadata(kind: str, uid: str, **more) -> str:
            known = spark._jvm.org.apache.spark.ml.regression.DecisionTreeRegressor() if "Regression" in kind else c._java_obj
            has = {p.name() for p in known.params()}
            maps = [{p.name: v for p, v in m.items() if p.name in has} for m in (c._paramMap, c._defaultParamMap)]
            return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": 0, "sparkVersion": spark.version,
                               "uid": uid, "paramMap": maps[0], "defaultParamMap": maps[1], **more})

        nodes.coalesce(1).write.parquet(f"{path}/data")
        tree = "regression.DecisionTreeRegressionModel"
        each = metadata(tree, "dtr")
        spark.createDataFrame([(i, each.replace('"dtr"', f'"dtr_{c.uid}_{i}"'), self.step if i else 1.0)
                               for i in range(self.rounds)], "_1 int, _2 string, _3 double"
                              ).coalesce(1).write.parquet(f"{path}/treesMetadata")
        whole = metadata("classification.GBTClassificationModel", c.uid, numFeatures=width, numTrees=self.rounds)
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return GBTClassificationModel.load(path)
