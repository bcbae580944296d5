"""Fitted trees as tables of nodes: smaller trees cut out of larger ones, without fitting again.

A tree is grown greedily: how a node is split depends on the node's own rows.  So a
tree of smaller depth, or one that splits no node of few rows, is the larger tree
with the subtrees below some nodes cut off, and the first trees of an ensemble are
the smaller ensemble.  Rows keep the leaf they fall into; a cut only changes the
value that stands for the leaf.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.session import scratch_path

LEAF = "__leaf"
UNLIMITED = 1 << 30


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder; children are -1 and the feature is -1 at a leaf."""

    prediction: np.ndarray
    count: np.ndarray   # rows in the node
    weight: np.ndarray  # their weight
    gain: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray

    @property
    def leaves(self) -> np.ndarray:
        """Nodes that are leaves, in the order of Spark's leaf indices."""
        return np.flatnonzero(self.left < 0)

    def cut(self, max_depth: int | None = None, min_samples_split: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """(the value of each leaf, True for each node still split) with deeper or smaller nodes not split."""
        n = len(self.prediction)
        depth, fixed, split = np.zeros(n, np.int64), np.full(n, np.nan), np.zeros(n, bool)
        most = UNLIMITED if max_depth is None else max_depth
        for k in range(n):  # parents come before their children
            if self.left[k] < 0:
                continue
            cut = not np.isnan(fixed[k]) or depth[k] >= most or self.count[k] < min_samples_split
            split[k] = not cut
            value = (fixed[k] if not np.isnan(fixed[k]) else self.prediction[k]) if cut else np.nan
            for child in (self.left[k], self.right[k]):
                depth[child], fixed[child] = depth[k] + 1, value
        ends = self.leaves
        return np.where(np.isnan(fixed[ends]), self.prediction[ends], fixed[ends]), split

    def importance(self, split: np.ndarray, n_features: int) -> np.ndarray:
        """Gain times weight per feature over the split nodes, adding up to 1 (or all 0)."""
        out = np.zeros(n_features)
        np.add.at(out, self.feature[split], self.gain[split] * self.weight[split])
        return out / out.sum() if out.sum() > 0 else out


def read_trees(model: Model, spark) -> list[Tree]:
    """The trees of a fitted tree, forest or boosting model, from the tables it is saved as.

    As many nodes come to the driver as the model has, which holds them there already.
    """
    path = scratch_path(spark, "tree-nodes")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    if "nodeData" in rows.columns:
        rows = rows.select("treeID", "nodeData.*")
    else:
        rows = rows.withColumn("treeID", F.lit(0))
    nodes = rows.select("treeID", "id", "prediction", "rawCount", F.col("impurityStats")[0].alias("weight"), "gain", "leftChild", "rightChild",
                        "split.featureIndex", F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).toArrow()
    columns = {c: nodes.column(c).to_numpy() for c in nodes.column_names}
    order = np.lexsort((columns["id"], columns["treeID"]))
    columns = {c: v[order] for c, v in columns.items()}
    starts = np.flatnonzero(np.diff(columns["treeID"], prepend=-1))
    names = ["prediction", "rawCount", "weight", "gain", "leftChild", "rightChild", "featureIndex", "threshold"]
    return [Tree(*[columns[c][a:b] for c in names]) for a, b in zip(starts, [*starts[1:], len(order)], strict=True)]


class CutTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces the prediction of a tree model by values per leaf, looked up by the leaf indices it gives.

    ``values`` is a JSON list of lists (tree, leaf), ``weights`` what each tree counts
    by.  A JVM-side stage that is saved and loaded with its pipeline.
    """

    values = Param(Params._dummy(), "values", "value of each leaf of each tree", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "weight of each tree", TypeConverters.toListFloat)
    importances = Param(Params._dummy(), "importances", "importance of each feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, values: str = "[]", weights: list[float] | None = None, importances: list[float] | None = None):
        super().__init__()
        self._setDefault(values="[]", weights=[], importances=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def featureImportances(self):  # noqa: N802  the name that tree models use
        return Vectors.dense(self.getOrDefault(self.importances))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = self.getOrDefault(self.weights)
        table = F.from_json(F.lit(self.getOrDefault(self.values)), "array<array<double>>")
        if len(weights) == 1:
            value = F.get(F.get(table, F.lit(0)), F.col(LEAF).cast("int")) * F.lit(weights[0])
        else:
            leaf = vector_to_array(F.col(LEAF))
            parts = F.transform(F.array(*[F.lit(w) for w in weights]),
                                lambda w, i: F.get(F.get(table, i), F.get(leaf, i).cast("int")) * w)
            value = F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)
        return dataset.withColumn("prediction", value)


def cut_stage(model: Model, trees: list[Tree], n_features: int, max_depth: int | None, min_samples_split: int) -> CutTrees:
    """The model with its trees cut, as a stage behind it."""
    weights = tree_weights(model, len(trees))
    done = [t.cut(max_depth, min_samples_split) for t in trees]
    each = np.array([t.importance(split, n_features) for t, (_, split) in zip(trees, done, strict=True)])
    total = each.sum(0)
    return CutTrees(values=json.dumps([v.tolist() for v, _ in done]), weights=weights,
                    importances=(total / total.sum() if total.sum() > 0 else total).tolist())


def tree_weights(model: Model, n: int) -> list[float]:
    """What each tree counts by in the prediction: its boosting weight, or its share of a forest."""
    if type(model).__name__.startswith("GBT"):
        return [float(w) for w in model.treeWeights]
    return [1.0 / n] * n


@dataclass(frozen=True)
class Version:
    """A model cut out of a fitted one: its first ``trees`` trees, of a depth, without splits of small nodes."""

    trees: int
    max_depth: int | None = None
    min_samples_split: int = 2


def version_errors(held: DataFrame, model: Model, trees: list[Tree], versions: list[Version], label: str) -> list[float]:
    """Sum of squared errors of every version on ``held``, from one pass with the fitted model.

    The leaf of a row in each tree is looked up in one table of values per kind of
    cut; running sums over the trees give all numbers of trees together.
    """
    cuts = list(dict.fromkeys((v.max_depth, v.min_samples_split) for v in versions))
    first = np.append(0, np.cumsum([len(t.leaves) for t in trees]))[:-1]
    tables = np.stack([np.concatenate([t.cut(*c)[0] for t in trees]) for c in cuts])
    boosted = type(model).__name__.startswith("GBT")
    weights = np.array(tree_weights(model, len(trees))) if boosted else np.ones(len(trees))
    picks = [(cuts.index((v.max_depth, v.min_samples_split)), v.trees) for v in versions]
    leaf = vector_to_array(F.col(LEAF)) if len(trees) > 1 or boosted or "Forest" in type(model).__name__ else F.array(F.col(LEAF))
    rows = model.transform(held).select(F.col(label).alias("y"), leaf.alias("leaf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(picks))
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy()
            place = batch.column("leaf").flatten().to_numpy().astype(np.int64).reshape(len(y), -1) + first
            for c in range(len(cuts)):
                running = np.cumsum(tables[c][place] * weights, axis=1)
                for k, (own, n) in enumerate(picks):
                    if own == c:
                        guess = running[:, n - 1] / (1 if boosted else n)
                        total[k] += ((y - guess) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(picks), dtype=np.int32)), pa.array(total)], names=["k", "sse"])

    sums = rows.mapInArrow(run, "k int, sse double").groupBy("k").agg(F.sum("sse").alias("sse"))
    found = {r["k"]: r["sse"] for r in sums.collect()}
    return [found.get(k, 0.0) for k in range(len(picks))]


def leaf_weights(rows: DataFrame, inputs: list[str], trees: list[Tree], feature: int) -> np.ndarray:
    """For each leaf of each tree: how many rows reach it if splits of ``feature`` let every row through both ways.

    One pass: a row goes down each tree once, without being repeated per grid point.
    """
    sizes = [len(t.leaves) for t in trees]
    first = np.append(0, np.cumsum(sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(first[-1])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(c).to_numpy() for c in inputs])
            for t, start in zip(trees, first, strict=False):
                total[start:start + len(t.leaves)] += reached(t, x, feature)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["k", "n"])

    counts = rows.select(*inputs).mapInArrow(run, "k int, n double").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(first[-1])
    for r in counts.collect():
        out[r["k"]] = r["n"]
    return out


def reached(tree: Tree, x: np.ndarray, feature: int) -> np.ndarray:
    """Rows of ``x`` per leaf, splits of ``feature`` passed on both sides."""
    leaf, out = {int(k): i for i, k in enumerate(tree.leaves)}, np.zeros(len(tree.leaves))
    todo = [(0, np.ones(len(x), bool))]
    while todo:
        k, here = todo.pop()
        if not here.any():
            continue
        if k in leaf:
            out[leaf[k]] += here.sum()
            continue
        f = int(tree.feature[k])
        low = x[:, f] <= tree.threshold[k]
        sides = (here, here) if f == feature else (here & low, here & ~low)
        todo += [(int(tree.left[k]), sides[0]), (int(tree.right[k]), sides[1])]
    return out


def ranges_of(tree: Tree, feature: int) -> tuple[np.ndarray, np.ndarray]:
    """The open lower and closed upper bound that the splits of ``feature`` set to each leaf."""
    low, high = np.full(len(tree.prediction), -np.inf), np.full(len(tree.prediction), np.inf)
    for k in range(len(tree.prediction)):
        if tree.left[k] < 0:
            continue
        for child, is_left in ((tree.left[k], True), (tree.right[k], False)):
            low[child], high[child] = low[k], high[k]
            if tree.feature[k] == feature:
                if is_left:
                    high[child] = min(high[k], tree.threshold[k])
                else:
                    low[child] = max(low[k], tree.threshold[k])
    return low[tree.leaves], high[tree.leaves]
