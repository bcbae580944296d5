"""Fill-in-the-middle arrangements of documents over a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that
never change: its UTF-8 text and the sentinels.  Cutting splits a descriptor,
arranging permutes the parts and puts a sentinel before each, the inverse
permutation restores the text, and hashes stream over the descriptors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import in_slices
from panelwright.llm.tokens import slices

#: Sentinels of prefix, middle and suffix (fixed by the contract), side by side in one buffer.
SENTINELS = b"<P><M><S>"
MARK = 3
TEXT, MARKS = 0, 1
#: Order of the parts prefix 0, middle 1, suffix 2 in each form.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: Bytes looked at together when a unit is sought in a long text.
BLOCK = 1 << 20

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class FimSpec:
    """Seed of the draws, per cent of documents arranged at all, and of those the per cent with the suffix first."""

    seed: int = 1
    percent: int = 90
    spm_percent: int = 20


class PieceTable:
    """Descriptors over immutable buffers."""

    def __init__(self, text: memoryview, pieces: list[Piece] | None = None) -> None:
        self.buffers = (text, memoryview(SENTINELS))
        self.pieces = [(TEXT, 0, len(text))] if pieces is None else pieces

    def cut(self, k: int, at: int) -> None:
        """Split descriptor ``k`` behind its first ``at`` bytes; either side may be empty."""
        buffer, start, length = self.pieces[k]
        self.pieces[k:k + 1] = [(buffer, start, at), (buffer, start + at, length - at)]

    def arranged(self, order: tuple[int, ...]) -> PieceTable:
        """The pieces in the given order, the sentinel of each before it."""
        pieces = [x for part in order for x in ((MARKS, MARK * part, MARK), self.pieces[part])]
        return PieceTable(self.buffers[TEXT], pieces)

    def restored(self, order: tuple[int, ...]) -> PieceTable:
        """The pieces of an arrangement without sentinels, back in the order of the text."""
        own = self.pieces[1::2]
        return PieceTable(self.buffers[TEXT], [own[order.index(part)] for part in range(len(order))])

    def parts(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start:start + length]

    def __len__(self) -> int:
        return sum(length for _, _, length in self.pieces)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.parts():
            digest.update(part)
        return digest.hexdigest()


def unit_ends(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(True at the last byte of each unit, True at the first byte of each code point) of texts that end at ``ends``.

    A unit is a run of letters A-Z and a-z, or any other code point.
    """
    letter = ((data | np.uint8(32)) - np.uint8(97)) < 26
    first = (data & np.uint8(0xC0)) != 0x80
    last = np.ones(len(data), bool)
    last[:-1] = first[1:] & ~(letter[1:] & letter[:-1])
    last[ends[ends > 0] - 1] = True
    return last, first


def bytes_of_units(last: np.ndarray, k: int) -> int:
    """Length of the first ``k`` units of a text."""
    at = 0
    while k:
        block = last[at:at + BLOCK]
        here = int(np.count_nonzero(block))
        if here >= k:
            return at + int(np.flatnonzero(block)[k - 1]) + 1
        k -= here
        at += BLOCK
    return 0


def draws(spec: FimSpec, doc_id: int | None) -> list[int]:
    """The first four 32-bit numbers of the hash of seed and id; no id counts as an empty one."""
    digest = hashlib.sha256(f"{spec.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def buffer_of(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all texts side by side, and where each starts (and the last ends)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = texts.buffers()[2]
    whole = memoryview(data)[offsets[0]:offsets[-1]] if data is not None else memoryview(b"")
    return whole.cast("B"), offsets - offsets[0]


def strings(tables: list[PieceTable]) -> pa.Array:
    """The texts that tables describe, as a column."""
    ends = np.append(0, np.cumsum([len(t) for t in tables])).astype(np.int32)
    data = b"".join(part for t in tables for part in t.parts())
    return pa.StringArray.from_buffers(len(tables), pa.py_buffer(ends), pa.py_buffer(data))


ARRANGED_SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
                   "pieces array<struct<buffer: int, start: long, length: long>>, output string")
PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))


def arrange(docs: DataFrame, spec: FimSpec = FimSpec()) -> DataFrame:
    """ARRANGED_SCHEMA for every row of ``docs`` (doc_id, text).

    n counts the units of the whole text.  The prefix ends behind the smaller, the
    middle behind the larger of two drawn numbers of units.  form is psm or spm, or
    plain where the draw says so, the text is empty or null, or it holds a sentinel:
    then output is the text, and prefix_chars and middle_chars are null.  pieces are
    the descriptors of the output: buffer 0 is the text, 1 the sentinels, in bytes.
    Draws depend on doc_id alone (null: as an empty id), so rows that repeat an id
    are cut alike where their texts are.  Other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    names = [f.name for f in rows.sparkSession.createDataFrame([], ARRANGED_SCHEMA).schema]
    sentinels = [SENTINELS[i:i + MARK] for i in range(0, len(SENTINELS), MARK)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1000):
            for a, b in slices(batch.column("text")):
                whole, at = buffer_of(batch.column("text").slice(a, b - a))
                last, first = unit_ends(np.frombuffer(whole, np.uint8), at[1:])
                ids, tables, facts = batch.column("doc_id").slice(a, b - a), [], []
                for doc_id, x, y in zip(ids.to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    table, n = PieceTable(whole[x:y]), int(np.count_nonzero(last[x:y]))
                    h = draws(spec, doc_id)
                    raw = bytes(whole[x:y]) if x < y else b""
                    if not n or h[2] % 100 >= spec.percent or any(s in raw for s in sentinels):
                        facts.append((n, "plain", None, None))
                    else:
                        form = "spm" if h[3] % 100 < spec.spm_percent else "psm"
                        p, q = (bytes_of_units(last[x:y], k) for k in sorted(v % (n + 1) for v in h[:2]))
                        table.cut(0, p)
                        table.cut(1, q - p)
                        facts.append((n, form, int(np.count_nonzero(first[x:x + p])), int(np.count_nonzero(first[x + p:x + q]))))
                        table = table.arranged(ORDERS[form])
                    tables.append(table)
                n, form, prefix, middle = zip(*facts, strict=True)
                pieces = [[{"buffer": u, "start": s, "length": k} for u, s, k in t.pieces] for t in tables]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     pa.array([t.sha256() for t in tables]), pa.array(pieces, PIECES), strings(tables)], names=names)

    return rows.mapInArrow(run, ARRANGED_SCHEMA)


def parse(output: memoryview, form: str) -> PieceTable:
    """Descriptors of an arranged output, found from its sentinels; a plain output is one piece.

    No part holds a sentinel, and none arises where a part meets one, so the first
    occurrence of each is the one that was put there.
    """
    table = PieceTable(output)
    if form == "plain":
        return table
    raw, at, pieces = bytes(output), 0, []
    order = ORDERS[form]
    for k, part in enumerate(order):
        following = order[k + 1:k + 2]
        end = raw.index(SENTINELS[MARK * following[0]:][:MARK], at + MARK) if following else len(raw)
        pieces += [(TEXT, at, MARK), (TEXT, at + MARK, end - at - MARK)]
        at = end
    table.pieces = pieces
    return table.restored(order)


def restore(arranged: DataFrame, keep: list[str], texts: bool = True) -> DataFrame:
    """The columns ``keep`` of ``arranged``, with restored_sha256 and (``texts``) the text, from output and form alone.

    A form other than plain, psm and spm, or an output without its sentinels,
    raises.  Columns of ``keep`` must not be called text or restored_sha256.
    """
    rows = arranged.select(*keep, F.col("form").alias("_form"), F.col("output").alias("_output"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    schema = ", ".join(x for x in (kept, "restored_sha256 string", "text string" if texts else "") if x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1000):
            for a, b in slices(batch.column("_output")):
                part = batch.slice(a, b - a)
                whole, at = buffer_of(part.column("_output"))
                tables = [parse(whole[x:y], form) for x, y, form in
                          zip(at[:-1].tolist(), at[1:].tolist(), part.column("_form").to_pylist(), strict=True)]
                columns = [*[part.column(c) for c in keep], pa.array([t.sha256() for t in tables], pa.string())]
                if texts:
                    columns.append(strings(tables))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "restored_sha256", *["text"] * texts])

    return rows.mapInArrow(run, schema)
