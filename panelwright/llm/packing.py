"""Best-fit packing of token pieces into sequences under several capacities.

A piece takes tokens, one place among the documents of a sequence and an
attention cost (its length squared).  What it takes is a function of its length,
so the whole corpus is planned over one count per length: best fit, longest
first, where the bins of one fill are handled together.  The plan's size is
bounded by the sequence length, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import fresh, in_slices
from panelwright.llm.tokens import encoder, id_lists, slices
from panelwright.session import materialize


@dataclass
class PackSpec:
    """Capacities of a sequence, the weights of the three residuals and how a bin is chosen.

    ``attention`` is the capacity for the sum of squared piece lengths (None: the
    square of ``tokens``).  ``choose`` is "norm" (least weighted length of the
    residual after the piece) or "dot" (largest weighted product of residual and
    piece).  Residuals are taken as shares of the capacities.
    """

    tokens: int = 1024
    documents: int = 1024
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    choose: str = "norm"

    @property
    def capacity(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention or self.tokens**2], dtype=np.int64)


def plan(counts: dict[int, int], spec: PackSpec) -> pd.DataFrame:
    """Slots (length, first, each, sequence, offset) for ``counts`` pieces of each length.

    The pieces of one length are numbered from 0.  A slot takes those from
    ``first`` on, ``each`` of them in a row into one sequence, from ``sequence``
    and ``offset`` on, until the next slot's ``first``.

    Lengths go from the longest down.  A length first fills the best of the open
    bins that take it under every capacity, as often as that bin does, before it
    opens new ones.  Bins with the same content are one entry with a number.
    """
    capacity, weights = spec.capacity, np.array(spec.weights, dtype=np.float64)
    left = np.zeros((0, 3), dtype=np.int64)
    number = np.zeros(0, dtype=np.int64)
    content: list[tuple[tuple[int, int], ...]] = []

    def add(residual: np.ndarray, n: int, items: tuple) -> None:
        nonlocal left, number
        if n:
            left, number = np.vstack([left, residual]), np.append(number, n)
            content.append(items)

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        need, n = np.array([length, 1, length * length], dtype=np.int64), int(counts[length])
        if (need > capacity).any():
            raise ValueError(f"a piece of {length} tokens is over a capacity")
        fits = np.flatnonzero((left >= need).all(1))
        share = left[fits] / capacity
        if spec.choose == "dot":
            order = fits[np.argsort(-(share * (need / capacity)) @ weights, kind="stable")]
        else:
            order = fits[np.argsort(((share - need / capacity) ** 2) @ weights, kind="stable")]
        for entry in order:
            if not n:
                break
            each = int((left[entry] // need).min())
            full = min(int(number[entry]), n // each)
            rest = n - full * each if full < number[entry] else 0
            residual, items, have = left[entry].copy(), content[entry], int(number[entry])
            if full:
                left[entry], number[entry], content[entry] = residual - each * need, full, (*items, (length, each))
                n -= full * each
                if rest:
                    add(residual - rest * need, 1, (*items, (length, rest)))
                    n -= rest
                add(residual, have - full - (rest > 0), items)
            else:
                left[entry], number[entry], content[entry] = residual - rest * need, 1, (*items, (length, rest))
                n -= rest
                add(residual, have - 1, items)
        if n:
            each = int((capacity // need).min())
            add(capacity - each * need, n // each, ((length, each),))
            if n % each:
                add(capacity - (n % each) * need, 1, ((length, n % each),))

    slots, sequence, used = [], 0, {}
    for items, n in zip(content, number.tolist(), strict=True):
        offset = 0
        for length, each in items:
            slots.append((length, used.get(length, 0), each, sequence, offset))
            used[length] = used.get(length, 0) + each * n
            offset += each * length
        sequence += n
    return pd.DataFrame(slots, columns=["length", "first", "each", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


PIECE_SCHEMA = "doc_id long, piece int, start long, length int, chunk int, place long, ids array<int>"


def cut(size: int, most: int) -> list[int]:
    """Lengths of the pieces of a document: only the first may be shorter than ``most``."""
    first = size % most
    return ([first] if first else []) + [most] * (size // most)


def pieces(docs: DataFrame, spec: PackSpec, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2,
           then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, schema: str = PIECE_SCHEMA) -> DataFrame:
    """One row per piece of each document of ``docs`` (doc_id, text).

    ``then`` turns each batch of pieces into one of ``schema`` before it leaves
    the task, so that ids need not travel where they are not wanted.

    chunk is the task that cut it and place its number among the pieces of its
    length there.  A null text is empty and becomes one piece, the end id.  Each
    repeated row is a document of its own; whole texts are encoded.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    most = spec.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(most + 1, dtype=np.int64)
        for batch in in_slices(batches, 2000):
            texts, names = batch.column("text"), batch.column("doc_id")
            for a, b in slices(texts):
                ids, sizes = known.encode(texts.slice(a, b - a), end_id)
                cuts = [cut(s, most) for s in sizes.tolist()]
                per_doc = np.array([len(c) for c in cuts])
                length = np.array([x for c in cuts for x in c], dtype=np.int64)
                doc = np.repeat(np.arange(b - a), per_doc)
                number = np.arange(len(length)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                start = np.cumsum(length) - length - np.repeat(np.cumsum(sizes) - sizes, per_doc)
                order = np.argsort(length, kind="stable")
                runs = np.flatnonzero(np.diff(length[order], prepend=-1))
                place = np.empty(len(length), dtype=np.int64)
                place[order] = np.arange(len(length)) - np.repeat(runs, np.diff(np.append(runs, len(length))))
                place += seen[length]
                seen += np.bincount(length, minlength=most + 1)
                out = pa.RecordBatch.from_arrays(
                    [names.slice(a, b - a).take(pa.array(doc)), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int32()), pa.array(np.full(len(length), chunk), pa.int32()), pa.array(place, pa.int64()),
                     id_lists(ids, length)],
                    names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])
                yield then(out) if then else out

    return rows.mapInArrow(run, schema)


def place(cut_pieces: DataFrame, spec: PackSpec) -> DataFrame:
    """Rows of ``pieces`` (ids or not, more columns or not) with sequence_id and offset, which replace columns of these names.

    The rows are stored first: numbers within a task must not change between the
    counting and the placing.  The driver sees one count per length, a task the
    plan's slots.  Counts per (chunk, length) are summed along the chunks to
    number all pieces of a length; the most frequent length is as many rows per
    chunk as any other chunk holds.
    """
    rows = materialize(cut_pieces.drop("sequence_id", "offset"), "pieces")
    from_here, rank_name = fresh(rows, "base"), fresh(rows, "rank")
    counts = materialize(rows.groupBy("length", "chunk").agg(F.count("*").alias("n")), "piece-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(totals, spec)
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(from_here))
    numbered = rows.join(base, ["length", "chunk"]).withColumn(rank_name, F.col(from_here) + F.col("place"))
    keep = [c for c in rows.columns if c not in ("chunk", "place")]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", sequence_id long, offset long"
    shared = rows.sparkSession.sparkContext.broadcast({c: slots[c].to_numpy(dtype=np.int64) for c in slots.columns})

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        keys = (s["length"] << 46) + s["first"]
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column(rank_name).to_numpy()
            slot = np.searchsorted(keys, (length << 46) + rank, side="right") - 1
            nth = rank - s["first"][slot]
            sequence = s["sequence"][slot] + nth // s["each"][slot]
            offset = s["offset"][slot] + nth % s["each"][slot] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(sequence), pa.array(offset)],
                                             names=[*keep, "sequence_id", "offset"])

    return numbered.select(*keep, rank_name).mapInArrow(seat, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the packed sequences themselves.

    A sequence is bounded by its capacities, so its pieces meet in one row.
    """
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))
