"""Nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is built on a bounded sample, every vector is indexed.  A query walks
the tree through a priority queue and visits leaves in the order in which they
come off it; how many is calibrated by measuring recall against brute force.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import materialize


@dataclass
class SearchSpec:
    """Parameters of the index and of the search.

    sample_rows bounds the vectors that the tree is built on, calibration_queries
    those whose neighbours are found by brute force to choose the number of leaf
    visits, max_leaves the tree on the driver and in each task.  Leaves are stored
    in cells of about chunk_rows vectors, several small leaves in one cell or one
    large leaf in several.  The queries that visit a cell are dealt into blocks of
    about query_rows, each of which meets the cell in a task of its own.  recall is the calibrated mean recall; all leaves are visited if no
    smaller number reaches it.
    """

    neighbours: int = 20
    branching: int = 8
    leaf_rows: int = 256
    max_leaves: int = 4096
    sample_rows: int = 20_000
    calibration_queries: int = 200
    recall: float = 0.97
    chunk_rows: int = 4096
    query_rows: int = 4096
    iterations: int = 8
    seed: int = 7


@dataclass
class Tree:
    """Nodes by number: centre, children (none: a leaf) and the number of the leaf."""

    centres: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    leaves: int = 0
    radius2: float = 0.0  # squared length to which shorter vectors are lifted
    dims: int = 0

    def lift(self, x: np.ndarray) -> np.ndarray:
        """One more component, so that all vectors have one length and the nearest is the largest product."""
        rest = np.sqrt(np.maximum(0.0, self.radius2 - np.einsum("ij,ij->i", x, x)))
        return np.hstack([x, rest[:, None]])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest centre on every level."""
        x, out = self.lift(x), np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = distances(x[rows], np.array([self.centres[c] for c in self.children[node]])).argmin(1)
            todo += [(c, rows[near == i]) for i, c in enumerate(self.children[node]) if (near == i).any()]
        return out

    def visit(self, query: np.ndarray, visits: int, counts: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first leaves that a best-bin-first walk takes off its queue.

        With ``counts`` (rows of each leaf) it goes on until they hold ``least`` rows.
        """
        q = np.append(query, 0.0)
        queue, found, rows = [(0.0, 0)], [], 0
        while queue and (len(found) < visits or rows < least):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(self.leaf[node])
                rows += least if counts is None else int(counts[self.leaf[node]])
                continue
            kids = self.children[node]
            for d, c in zip(distances(q[None, :], self.kid_centres(node))[0], kids, strict=True):
                heapq.heappush(queue, (float(d), c))
        return found

    def kid_centres(self, node: int) -> np.ndarray:
        if not hasattr(self, "_kids"):
            self._kids = {}
        if node not in self._kids:
            self._kids[node] = np.array([self.centres[c] for c in self.children[node]])
        return self._kids[node]


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, but for the rows' own squared lengths."""
    return np.einsum("ij,ij->i", centres, centres)[None, :] - 2.0 * (x @ centres.T)


def build_tree(sample: np.ndarray, radius2: float, leaves: int, spec: SearchSpec) -> Tree:
    """Split by k-means until a node holds its share of the sample or its vectors are all equal."""
    tree, rng = Tree(radius2=radius2, dims=sample.shape[1]), np.random.default_rng(spec.seed)
    x = tree.lift(sample)
    enough = max(1, len(x) // max(1, leaves))

    def add(rows: np.ndarray) -> int:
        node = len(tree.centres)
        tree.centres.append(x[rows].mean(0) if len(rows) else np.zeros(x.shape[1]))
        tree.children.append([])
        tree.leaf.append(-1)
        return node

    todo = [(add(np.arange(len(x))), np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        parts = kmeans(x[rows], spec, rng) if len(rows) > max(enough, 1) else []
        if len(parts) < 2:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            continue
        for part in parts:
            child = add(rows[part])
            tree.children[node].append(child)
            todo.append((child, rows[part]))
    return tree


def kmeans(x: np.ndarray, spec: SearchSpec, rng: np.random.Generator) -> list[np.ndarray]:
    """Row numbers of the non-empty clusters; one cluster if all rows are equal."""
    distinct = np.unique(x, axis=0)
    if len(distinct) < 2:
        return [np.arange(len(x))]
    centres = distinct[rng.choice(len(distinct), min(spec.branching, len(distinct)), replace=False)]
    for _ in range(spec.iterations):
        near = distances(x, centres).argmin(1)
        centres = np.array([x[near == i].mean(0) if (near == i).any() else centres[i] for i in range(len(centres))])
    near = distances(x, centres).argmin(1)
    return [np.flatnonzero(near == i) for i in range(len(centres)) if (near == i).any()]


def usable(vectors: DataFrame, length: int | None = None) -> DataFrame:
    """(vec_id, vector as 8-byte doubles) of the rows that take part.

    Left out: null ids, null, empty or zero vectors, those with a null or
    non-finite component and those whose length is not the given one (None: the
    most frequent; ties: the longest).
    """
    x = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    x = x.where(~bad & F.exists("embedding", lambda v: v != 0))
    if length is None:
        size = x.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        length = size["d"] if size else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("embedding").flatten().to_numpy().astype("<f8")
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * 8 * length
            vectors = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), vectors], names=["vec_id", "vector"])

    return x.where(F.size("embedding") == length).mapInArrow(pack, "vec_id long, vector binary")


def matrix(column: pd.Series) -> np.ndarray:
    """The vectors of a column, one a row."""
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed from the first component on, the same for equal vectors wherever they lie."""
    total = np.zeros(len(vectors))
    for j in range(vectors.shape[1]):
        total += vectors[:, j] * query[j]
    return total


def best(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
         open_: np.ndarray | None = None) -> pd.DataFrame:
    """The k best of ``vectors`` for each query, without itself; ties to the smaller id.

    ``open_`` (queries x vectors) tells which of them a query visits.  A matrix
    product picks the candidates, with room for its rounding; they are scored
    again, exactly.
    """
    found_query, found_id, found_score = [], [], []
    step = max(1, 4_000_000 // max(1, len(ids)))
    for at in range(0, len(queries), step):
        part = queries[at:at + step]
        rough = part @ vectors.T
        slack = 1e-9 * max(1.0, float(np.abs(rough).max(initial=0.0)))
        closed = query_ids[at:at + step, None] == ids[None, :]
        rough[closed if open_ is None else closed | ~open_[at:at + step]] = -np.inf
        edge = np.partition(rough, -k, axis=1)[:, -k] if k < len(ids) else np.full(len(part), -np.inf)
        near = (rough >= edge[:, None] - slack) & (rough > -np.inf)
        for i in range(len(part)):
            rows = np.flatnonzero(near[i])
            score = exact_products(vectors[rows], part[i])
            order = np.lexsort((ids[rows], -score))[:k]
            found_query.append(np.full(len(order), query_ids[at + i]))
            found_id.append(ids[rows][order])
            found_score.append(score[order])
    empty = [np.zeros(0)]
    return pd.DataFrame({"query_id": np.concatenate(found_query or empty), "vec_id": np.concatenate(found_id or empty),
                         "score": np.concatenate(found_score or empty)})


FOUND = "query_id long, vec_id long, score double"


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query; at most k per (query, task) come here."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def brute_force(queries: pd.DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Exact neighbours of a bounded set of queries: each task keeps its k best per query."""
    ids, points = queries["vec_id"].to_numpy(), matrix(queries["vector"])

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield best(frame["vec_id"].to_numpy(), matrix(frame["vector"]), ids, points, k)

    return top(vectors.mapInPandas(scan, FOUND), k)


@dataclass
class Index:
    """The tree, the indexed rows (leaf, vec_id, vector) and the calibrated number of visits."""

    tree: Tree
    rows: DataFrame
    counts: np.ndarray  # rows of each leaf
    visits: int
    recall: float


def build_index(vectors: DataFrame, spec: SearchSpec) -> Index | None:
    """Index all usable vectors; None if there are none.

    The driver holds the sample, the tree, one count per leaf and the neighbours
    of the calibration queries, all bounded by ``spec``.
    """
    x = materialize(usable(vectors), "vectors")
    order = (F.xxhash64(F.lit(spec.seed), "vec_id"), F.col("vec_id"))

    def squared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"n2": np.einsum("ij,ij->i", *[matrix(frame["vector"])] * 2)})

    sample = x.orderBy(*order).limit(spec.sample_rows).toPandas()
    if not len(sample):
        return None
    facts = x.mapInPandas(squared, "n2 double").agg(F.count("*").alias("n"), F.max("n2").alias("r")).first()
    points = matrix(sample["vector"])
    leaves = int(min(spec.max_leaves, max(1, facts["n"] // spec.leaf_rows), max(1, len(points) // 8)))
    tree = build_tree(points, facts["r"], leaves, spec)
    shared = x.sparkSession.sparkContext.broadcast(tree)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(leaf=shared.value.assign(matrix(frame["vector"])))

    rows = materialize(x.mapInPandas(assign, "vec_id long, vector binary, leaf long"), "leaves")
    counts = np.zeros(tree.leaves, dtype=np.int64)
    for r in rows.groupBy("leaf").count().collect():
        counts[r["leaf"]] = r["count"]
    index = Index(tree, rows, counts, tree.leaves, 1.0)
    index.visits, index.recall = calibrate(index, sample.head(spec.calibration_queries), spec)
    return index


def calibrate(index: Index, queries: pd.DataFrame, spec: SearchSpec) -> tuple[int, float]:
    """Widen the number of visits until the mean recall of the calibration queries is reached."""
    truth = brute_force(queries, index.rows.select("vec_id", "vector"), spec.neighbours)
    homes = truth.join(index.rows.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    points = dict(zip(queries["vec_id"], matrix(queries["vector"]), strict=True))
    taken_at, shares = [], []
    for query, leaves in homes.groupby("query_id")["leaf"]:
        place = {leaf: i + 1 for i, leaf in enumerate(index.tree.visit(points[query], index.tree.leaves))}
        taken_at += [place[leaf] for leaf in leaves]
        shares += [1.0 / len(leaves)] * len(leaves)
    if not taken_at:
        return 1, 1.0
    gained = np.bincount(taken_at, weights=shares, minlength=index.tree.leaves + 1).cumsum() / homes["query_id"].nunique()
    visits = int(min(index.tree.leaves, np.searchsorted(gained, spec.recall - 1e-12)))
    return max(1, visits), float(gained[max(1, visits)])


def search(index: Index, queries: DataFrame, spec: SearchSpec) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for each query (vec_id, vector).

    A query goes once to every cell that holds a leaf it visits, with the list of
    these leaves; the cell sends its k best.  Cells and the blocks of queries that
    meet them are bounded, so a leaf that holds a third of all vectors is only more
    cells, and one that every query visits only more blocks.
    """
    spark = queries.sparkSession
    bundles = int(min(index.tree.leaves, max(1, -(-index.counts.sum() // spec.chunk_rows))))
    home = np.arange(index.tree.leaves) % bundles
    pieces = np.maximum(1, -(-np.bincount(home, weights=index.counts, minlength=bundles).astype(np.int64) // spec.chunk_rows))
    shared = spark.sparkContext.broadcast((index.tree, index.counts, pieces, index.visits))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, counts, pieces, visits = shared.value
        for frame in frames:
            rows = []
            for vec_id, vector in zip(frame["vec_id"], frame["vector"], strict=True):
                leaves = np.array(tree.visit(np.frombuffer(vector, "<f8"), visits, counts, spec.neighbours + 1))
                for bundle in np.unique(leaves % len(pieces)).tolist():
                    own = leaves[leaves % len(pieces) == bundle].astype("<i4").tobytes()
                    rows += [(bundle, chunk, vec_id, vector, own) for chunk in range(pieces[bundle])]
                if len(rows) >= 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    schema = "bundle long, chunk long, vec_id long, vector binary, leaves binary"
    names = [c.split()[0] for c in schema.split(", ")]
    asked = materialize(queries.select("vec_id", "vector").mapInPandas(route, schema), "asked")
    blocks = np.ones(bundles, np.int64)
    for r in asked.where("chunk = 0").groupBy("bundle").count().collect():  # a row per bundle
        blocks[r["bundle"]] = -(-r["count"] // spec.query_rows)
    sizes = spark.createDataFrame(pd.DataFrame({"bundle": np.arange(bundles), "pieces": pieces, "blocks": blocks}))
    asked = asked.join(F.broadcast(sizes), "bundle").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("block")), "blocks"))
    stored = index.rows.withColumn("bundle", F.pmod("leaf", F.lit(bundles))).join(F.broadcast(sizes), "bundle").select(
        "bundle", F.pmod(F.xxhash64("vec_id"), "pieces").alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "leaf", "vec_id", "vector")
    cell = ("bundle", "chunk", "block")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        here, at = np.unique(right["leaf"].to_numpy(), return_inverse=True)
        visited = np.zeros((len(left), len(here)), dtype=bool)
        for i, leaves in enumerate(left["leaves"]):
            visited[i] = np.isin(here, np.frombuffer(leaves, "<i4"))
        return best(right["vec_id"].to_numpy(), matrix(right["vector"]), left["vec_id"].to_numpy(), matrix(left["vector"]),
                    spec.neighbours, visited[:, at])

    asked = asked.select(*cell, "vec_id", "vector", "leaves")
    found = asked.groupBy(*cell).cogroup(stored.groupBy(*cell)).applyInPandas(compare, FOUND)
    return top(found, spec.neighbours).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, spec: SearchSpec | None = None) -> DataFrame:
    """The nearest vectors found for each row of ``queries``, itself left out.

    Both tables have vec_id and embedding; other columns are ignored.  Rows that
    ``usable`` leaves out take no part on either side.  Nearness is the inner
    product in double precision, ties go to the smaller vec_id.  Fewer rows than
    ``neighbours`` come only where there are fewer other vectors in the visited
    leaves.  Repeated rows of one id count as so many vectors, but none as a
    neighbour of its own id.  Without usable vectors the result is empty.
    """
    spec = spec or SearchSpec()
    index = build_index(vectors, spec)
    if index is None:
        spark = vectors.sparkSession
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, usable(queries, index.tree.dims).distinct(), spec)
