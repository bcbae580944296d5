"""Pairwise-complete co-moments of many columns from one scan, as blocks of products.

A task turns its rows into matrices of values and of presence, multiplies them
column against column, and keeps count, means and central co-moments of every
pair.  What tasks send are square blocks of pairs, added up in rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col
from panelwright.session import materialize

#: A spread this small against the distance from the reference value is rounding, not variance.
NOTHING = 1e-13
BLOCKS = "i int, j int, task int, block binary"


@dataclass(frozen=True)
class BlockSpec:
    """``block`` columns make a side of a block; a task holds at most ``memory`` bytes of sums.

    48 bytes a pair: up to 2,300 columns (with both halves counted) take one scan
    with 256 MiB; more columns take a scan per band of columns.  ``cells`` bounds the
    values of a slice of rows, ``fan_in`` the blocks that one group adds up.
    """

    block: int = 256
    memory: int = 1 << 28
    cells: int = 2_000_000
    fan_in: int = 32

    def bands(self, columns: int) -> list[tuple[int, int]]:
        """Ranges of first columns; each is compared with all columns from its start on."""
        rows = max(1, self.memory // (48 * max(1, columns)) // self.block) * self.block
        return [(a, min(columns, a + rows)) for a in range(0, columns, rows)]


def moments(values: np.ndarray, first: int, last: int) -> np.ndarray:
    """Count, two means, two sums of squares and the sum of products of columns [first, last) with all from ``first``.

    ``values`` (rows x columns) has NaN where a value is missing; the sums are about
    the means of the pair's common rows.  A column of one value gets exactly zero.
    """
    here = ~np.isnan(values)
    with np.errstate(invalid="ignore"):
        low = np.min(values, axis=0, initial=np.inf, where=here)
        high = np.max(values, axis=0, initial=-np.inf, where=here)
        mean = np.sum(values, axis=0, where=here) / np.maximum(here.sum(0), 1)
    about = np.where(low == high, low, mean)
    x, m = np.where(here, values - about, 0.0), here.astype(np.float64)
    a, b, am, bm = x[:, first:last], x[:, first:], m[:, first:last], m[:, first:]
    n, sx, sy, xy = am.T @ bm, a.T @ bm, am.T @ b, a.T @ b
    xx, yy = (a * a).T @ bm, am.T @ (b * b)
    some = np.maximum(n, 1)
    spread = [np.where(q - s * s / some <= NOTHING * q, 0.0, q - s * s / some) for q, s in ((xx, sx), (yy, sy))]
    about = np.where(np.isfinite(about), about, 0.0)
    return np.stack([n, np.where(n > 0, about[first:last, None] + sx / some, 0.0), np.where(n > 0, about[None, first:] + sy / some, 0.0),
                     *spread, xy - sx * sy / some])


def together(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows as one."""
    n = p[0] + q[0]
    share = np.divide(q[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy, w = q[1] - p[1], q[2] - p[2], p[0] * share
    return np.stack([n, p[1] + dx * share, p[2] + dy * share, p[3] + q[3] + dx * dx * w, p[4] + q[4] + dy * dy * w, p[5] + q[5] + dx * dy * w])


def correlation_of(block: np.ndarray) -> np.ndarray:
    """Pearson correlation per pair; NaN where a side has no spread or no rows are common."""
    size = np.sqrt(block[3]) * np.sqrt(block[4])
    return np.divide(block[5], size, out=np.full_like(size, np.nan), where=size > 0)


def band_blocks(df: DataFrame, columns: list[str], first: int, last: int, spec: BlockSpec) -> DataFrame:
    """BLOCKS of the pairs whose first column is in [first, last), added up over all rows: one scan."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    width = len(columns) - first
    rows = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns[first:])])
    slice_rows = max(1, spec.cells // max(1, width))
    steps = range(0, width, spec.block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns]).astype(np.float64)
                found = moments(values, 0, last - first)
                total = found if total is None else together(total, found)
        if total is None:
            return
        task = TaskContext.get().partitionId()
        for i in range(0, last - first, spec.block):
            for j in (s for s in steps if s >= i):
                block = np.ascontiguousarray(total[:, i:i + spec.block, j:j + spec.block])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([task], pa.int32()),
                                                  pa.array([block.tobytes()], pa.binary())], names=names)

    def shape(i: int, j: int) -> tuple[int, int, int]:
        return 6, min(spec.block, last - first - i), min(spec.block, width - j)

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        i, j, task = (k.as_py() for k in key)
        total = None
        for raw in parts.column("block").to_pylist():
            found = np.frombuffer(raw).reshape(shape(i, j))
            total = found if total is None else together(total, found)
        return pa.table([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([task], pa.int32()),
                         pa.array([total.tobytes()], pa.binary())], names=names)

    counted = materialize(rows.mapInArrow(count, BLOCKS), "products")
    left = (counted.agg(F.max("task")).first()[0] or 0) + 1
    while left > 1:
        left = -(-left // spec.fan_in)
        grouped = counted.withColumn("task", F.floor(F.col("task") / spec.fan_in).cast("int")).groupBy("i", "j", "task")
        counted = materialize(grouped.applyInArrow(add, BLOCKS), "products")
    return counted


def blocked_correlations(df: DataFrame, columns: list[str], spec: BlockSpec = BlockSpec()) -> DataFrame:
    """``a, b, corr`` for every two columns (a not after b in ``columns``, each with itself too).

    Pairwise complete: a pair takes the rows where both are present; NaN is missing.
    A column without spread there, or no common row, gives NULL.  No columns and no
    rows are fine: the pairs of an empty table are NULL.
    """
    spark, schema = df.sparkSession, "a string, b string, corr double"
    parts = []
    for first, last in spec.bands(len(columns)):
        found = band_blocks(df, columns, first, last, spec)
        names = columns[first:]
        height, width, block = last - first, len(names), spec.block

        def pairs(batches: Iterator[pa.RecordBatch], names=names, height=height, width=width, block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, j, raw in zip(*[batch.column(c).to_pylist() for c in ("i", "j", "block")], strict=True):
                    values = np.frombuffer(raw).reshape(6, min(block, height - i), min(block, width - j))
                    corr = correlation_of(values)
                    x, y = np.nonzero(np.arange(i, i + corr.shape[0])[:, None] <= np.arange(j, j + corr.shape[1])[None, :])
                    corr = corr[x, y]
                    yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in (x + i).tolist()]), pa.array([names[k] for k in (y + j).tolist()]),
                                                      pa.array(corr, mask=np.isnan(corr))], names=["a", "b", "corr"])

        parts.append(found.mapInArrow(pairs, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
