"""Quality rules: repetition inside a document, and lines that many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import fresh, in_slices
from panelwright.session import materialize

#: Characters that count as symbols (fixed by the contract).
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


@dataclass
class RuleSpec:
    """Limits of the rules.

    A document fails the base rules with fewer than ``min_words`` words or with
    more than ``max_repeat_percent`` per cent of them in repeated windows.  A line
    is boilerplate where more than ``max_line_documents`` documents of a host have
    it.  A document is depleted if less than ``min_left_percent`` per cent of its
    words or fewer than ``min_left_words`` words are left without such lines.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    max_line_documents: int = 50
    min_left_percent: int = 30
    min_left_words: int = 5


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def normal_line(line: bytes) -> bytes:
    """A-Z in lower case, single blanks, none at the ends."""
    return b" ".join(line.lower().split())


def line_hash(line: bytes) -> int:
    value = xxhash.xxh64_intdigest(normal_line(line))
    return value - (1 << 64) if value >> 63 else value


def repeated_words(per_text: list[list[bytes]]) -> np.ndarray:
    """For each text, its words that lie in 5-word windows found twice or more in it.

    Windows are compared by 64-bit sums of word hashes, told apart by text.
    """
    counts = np.array([len(w) for w in per_text], dtype=np.int64)
    total = int(counts.sum())
    out = np.zeros(len(per_text), dtype=np.int64)
    if total < WINDOW:
        return out
    hashes = np.fromiter((hash(w) for words in per_text for w in words), dtype=np.int64, count=total).view(np.uint64)
    text = np.repeat(np.arange(len(per_text)), counts)
    n = total - WINDOW + 1
    window = np.zeros(n, dtype=np.uint64)
    for j in range(WINDOW):
        window *= np.uint64(0x9E3779B97F4A7C15)
        window ^= window >> np.uint64(29)
        window += hashes[j:j + n]
    window += text[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    whole = np.flatnonzero(text[:n] == text[WINDOW - 1:])
    _, which, often = np.unique(window[whole], return_inverse=True, return_counts=True)
    starts = whole[often[which] > 1]
    edge = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(text[covered], minlength=len(per_text))


def text_facts(text: bytes, words: list[bytes]) -> tuple[int, int, int, list[int], list[int]]:
    """word_chars, n_symbols, n_dup_lines and the hash and words of each distinct normal line."""
    seen, lines, again = set(), {}, 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            again += line in seen
            seen.add(line)
            key = line_hash(line)
            lines[key] = lines.get(key, 0) + n
    blanks = len(text) - sum(map(len, words))
    return len(text.decode()) - blanks, sum(text.count(c) for c in SYMBOLS), again, list(lines), list(lines.values())


KEYS = "doc_id long, source string, digest long"
FACT_SCHEMA = KEYS + ", " + ", ".join(f"{s} long" for s in STATS) + ", lines array<long>, line_words array<long>"


def facts(docs: DataFrame) -> DataFrame:
    """Statistics and line hashes of each row of ``docs`` (doc_id, text, source)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", digest(F.col("text")).alias("digest"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("body"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, 1000):
            texts = part.column("body").to_pylist()
            words = [t.split() for t in texts]
            found = [text_facts(t, w) for t, w in zip(texts, words, strict=True)]
            longs = lambda x: pa.array(x, pa.int64())
            lists = lambda x: pa.array(x, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("source"), part.column("digest"), longs([len(w) for w in words]),
                 *[longs([f[i] for f in found]) for i in range(3)], longs(repeated_words(words)),
                 lists([f[3] for f in found]), lists([f[4] for f in found])],
                names=[c.split()[0] for c in FACT_SCHEMA.split(", ")])

    return rows.mapInArrow(measure, FACT_SCHEMA)


def digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def boilerplate(known: DataFrame, spec: RuleSpec) -> DataFrame:
    """(source, line) of the lines that more distinct documents of a host have than allowed.

    Documents of equal text are one.  They are combined before the shuffle, so one
    line in a third of all documents is a count like any other.
    """
    lines = known.where("n_words > 0").select("source", "digest", F.explode("lines").alias("line")).distinct()
    often = lines.groupBy("source", "line").agg(F.count("*").alias("n"))
    return often.where(F.col("n") > spec.max_line_documents).select("source", "line")


def _on_line(rows: DataFrame, lines: DataFrame, how: str) -> DataFrame:
    lines = lines.select(F.col("source").alias("s"), F.col("line").alias("l"))
    return rows.join(lines, F.col("source").eqNullSafe(F.col("s")) & (F.col("line") == F.col("l")), how)


def judge(docs: DataFrame, spec: RuleSpec | None = None) -> DataFrame:
    """Per row: keys, statistics, base_failed, removed (line hashes), left_words, kept.

    The host of a document is its source (null: one host of its own).  Null and
    empty texts have no words and fail.  Repeated rows count as one document and
    are judged alike; empty tables give empty results; other columns are ignored.
    Whole texts are read, and every line of every document is counted.
    """
    spec = spec or RuleSpec()
    known = materialize(facts(docs), "text-facts")
    bad = materialize(boilerplate(known, spec), "boilerplate")
    rows = known.select("doc_id", "source", "digest", F.explode(F.arrays_zip("lines", "line_words")).alias("z")).select(
        "doc_id", "source", "digest", F.col("z.lines").alias("line"), F.col("z.line_words").alias("words")).distinct()
    lost = _on_line(rows, bad, "left_semi").groupBy("doc_id", "source", "digest").agg(
        F.sum("words").alias("lost"), F.collect_set("line").alias("removed"))
    out = join_rows(known.drop("lines", "line_words"), lost)
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < spec.min_words) | (100 * F.col("n_repeat_words") > spec.max_repeat_percent * F.col("n_words"))
    whole = (100 * left >= spec.min_left_percent * F.col("n_words")) & (left >= spec.min_left_words)
    return out.select("doc_id", "source", "digest", *STATS, failed.alias("base_failed"),
                      F.coalesce("removed", F.array().cast("array<long>")).alias("removed"), left.alias("left_words"),
                      (~failed & (F.col("lost").isNull() | whole)).alias("kept"))


def join_rows(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Left join on (doc_id, source, digest), nulls equal; ``other`` has one row per key."""
    keys = ("doc_id", "source", "digest")
    other = other.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    same = [rows[k].eqNullSafe(other[f"_{k}"]) for k in keys]
    return rows.join(other, same[0] & same[1] & same[2], "left").drop(*[f"_{k}" for k in keys])


def strip_lines(docs: DataFrame, spec: RuleSpec | None = None) -> DataFrame:
    """The kept documents with all their columns, boilerplate lines cut from their texts.

    n_chars, where the table has it, becomes the length of the new text.
    """
    named = fresh(docs, "verdict")
    verdicts = judge(docs, spec).where("kept").select(F.struct("doc_id", "source", "digest", "removed").alias(named)).distinct()
    same = (docs["doc_id"].eqNullSafe(verdicts[named]["doc_id"]) & docs["source"].eqNullSafe(verdicts[named]["source"])
            & (digest(docs["text"]) == verdicts[named]["digest"]))
    rows = docs.join(verdicts, same).withColumn(named, F.col(named)["removed"])
    out_schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 500):
            at = batch.schema.get_field_index("text")
            texts, gone = batch.column(at).to_pylist(), batch.column(named).to_pylist()
            for i, lines in enumerate(gone):
                if lines:
                    drop = set(lines)
                    texts[i] = b"\n".join(x for x in texts[i].encode().split(b"\n") if not x.split() or line_hash(x) not in drop).decode()
            columns = [pa.array(texts, batch.schema.field(at).type) if i == at else c
                       for i, c in enumerate(batch.columns) if batch.schema.names[i] != named]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != named])

    out = rows.mapInArrow(cut, out_schema)
    return out.withColumn("n_chars", F.length("text").cast(out_schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
