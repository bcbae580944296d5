"""Hashed maximum-entropy language model with a class-factored softmax.

log P(word | history) = log P(class | history) + log P(member | class, history)
+ log P(word | class, member).  Class and member come from a hash of the word.
The class softmax has a bias, the previous word (bigram), the word before it
alone (skip) and both together (trigram) as hashed features; the member softmax
has a bias and the previous word.  The last factor is a smoothed count, so any
word, known or not, has a probability and all sum to one.

What the features can tell apart is a table of counts of bounded size.  One pass
over the corpus adds it up, together with the counts of all words; the softmax
weights are then found by gradient updates that tasks compute over the table.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import in_slices
from panelwright.session import materialize


@dataclass(frozen=True)
class ModelSpec:
    """Sizes of the hash spaces, and of the blocks of text that a task holds.

    They bound what the driver and a task keep, whatever the corpus: the count
    table has previous * skipped * classes + previous * classes * members cells.
    """

    classes: int = 32
    members: int = 32
    previous: int = 512
    skipped: int = 64
    trigrams: int = 8192
    rounds: int = 16
    step: float = 0.6
    prior: float = 2.0
    block_chars: int = 6_000_000
    cells: int = 1 << 14  # cells in one row of the count table

    @property
    def buckets(self) -> int:
        return self.classes * self.members

    @property
    def history_cells(self) -> int:
        return self.previous * self.skipped * self.classes

    @property
    def member_cells(self) -> int:
        return self.previous * self.buckets


#: What the end of a text counts as; no word holds a line end.
END = "\n"


def word_codes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def features(codes: np.ndarray, spec: ModelSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, number as the previous word, number as the skipped word); number 0 is the start of a text."""
    bucket = (codes % np.uint64(spec.buckets)).astype(np.int32)
    previous = 1 + ((codes >> np.uint64(20)) % np.uint64(spec.previous - 1)).astype(np.int32)
    skipped = 1 + ((codes >> np.uint64(40)) % np.uint64(spec.skipped - 1)).astype(np.int32)
    return bucket, previous, skipped


def tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(word numbers of all texts with an end behind each, tokens of each text, the distinct words).

    The end is the last of the distinct words.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    which = coded.indices.to_numpy(zero_copy_only=False) if len(coded) else np.zeros(0, np.int32)
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    if "" in words:
        empty = words.index("")
        keep = which != empty
        offsets = np.append(0, np.cumsum(keep))[offsets]
        which = which[keep]
        which = which - (which > empty)
        del words[empty]
    counts = np.diff(offsets)
    out = np.full(len(which) + len(texts), len(words), np.int32)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(counts + 1) - 1] = False
    out[inside] = which
    return out, counts + 1, [*words, END]


def histories(tokens: np.ndarray, sizes: np.ndarray, previous: np.ndarray, skipped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token, the numbers of the word before it and of the one before that (0 beyond the start)."""
    one, two = np.zeros(len(tokens), np.int32), np.zeros(len(tokens), np.int32)
    one[1:] = previous[tokens[:-1]]
    two[2:] = skipped[tokens[:-2]]
    starts = np.cumsum(sizes) - sizes
    one[starts] = 0
    two[starts] = 0
    two[(starts + 1)[sizes > 1]] = 0
    return one, two


GATHERED = "kind int, block long, item long, word string, bucket int, train long, data binary, more binary"


def packed(tokens: np.ndarray) -> bytes:
    """Word numbers as compressed planes of bytes; frequent words have small numbers."""
    planes = np.ascontiguousarray(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, size).T).view("<i4").ravel()


def gather(docs: DataFrame, learns: Column, spec: ModelSpec) -> DataFrame:
    """One pass over ``docs`` (doc_id, text).  Rows by kind:

    0: a block of texts as word numbers (data) and its documents (more);
    1: a word of a block (item: its number) with its bucket and its count in texts to learn from;
    2: a row of the task's count table (block: its task).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(learns, F.lit(False)).alias("learns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        table = np.zeros(spec.history_cells + spec.member_cells, np.int32)
        for number, group in enumerate(text_blocks(in_slices(batches, 2000), spec.block_chars)):
            block = (task << 24) + number
            tokens, sizes, words = tokenised(group.column("text").combine_chunks())
            learning = group.column("learns").to_numpy()
            used = np.repeat(learning, sizes)
            codes = word_codes(words)
            bucket, previous, skipped = features(codes, spec)
            one, two = (x[used] for x in histories(tokens, sizes, previous, skipped))
            target = bucket[tokens[used]]
            table[:spec.history_cells] += np.bincount(
                (one * spec.skipped + two) * spec.classes + target // spec.members, minlength=spec.history_cells).astype(np.int32)
            one *= spec.buckets
            one += target
            table[spec.history_cells:] += np.bincount(one, minlength=spec.member_cells).astype(np.int32)
            trained = np.bincount(tokens[used], minlength=len(words))
            head = {"doc_ids": group.column("doc_id").to_pylist(), "sizes": sizes.tolist(), "learns": learning.tolist()}
            numbers = (bucket * spec.previous + previous) * spec.skipped + skipped
            yield gathered(0, [block], [0], [None], [0], [0], [packed(tokens)],
                           [json.dumps(head).encode() + b"\0" + numbers.astype("<u4").tobytes()])
            yield gathered(1, np.full(len(words), block), np.arange(len(words)), words, bucket, trained, None, None)
        parts = np.split(table, range(spec.cells, len(table), spec.cells))
        some = [i for i, p in enumerate(parts) if p.any()]
        if some:
            yield gathered(2, np.full(len(some), task), some, [None] * len(some), [0] * len(some), [0] * len(some),
                           [parts[i].astype("<i8").tobytes() for i in some], None)

    return rows.mapInArrow(run, GATHERED)


def gathered(kind: int, block, item, word, bucket, train, data, more) -> pa.RecordBatch:
    size = len(item)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, kind, np.int32)), pa.array(block, pa.int64()), pa.array(item, pa.int64()), pa.array(word, pa.string()),
         pa.array(bucket, pa.int32()), pa.array(train, pa.int64()), pa.array(data or [None] * size, pa.binary()),
         pa.array(more or [None] * size, pa.binary())],
        names=[c.split()[0] for c in GATHERED.split(", ")])


def text_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows in blocks of at most ``most`` bytes of text; a longer text is a block of its own."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > most:
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches([h for h in held if h.num_rows])
                held, size, start = [], 0, i
            size += n + 1
        held.append(batch.slice(start))
    if any(h.num_rows for h in held):
        yield pa.Table.from_batches([h for h in held if h.num_rows])


def count_table(rows: DataFrame) -> DataFrame:
    """(item, data): the tasks' count tables added up, through groups of 32 tasks."""
    def add(frame: pd.DataFrame) -> np.ndarray:
        return np.sum([np.frombuffer(d, "<i8") for d in frame["data"]], axis=0)

    def some(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"item": [key[0]], "data": [add(frame).tobytes()]})

    part = rows.where("kind = 2").select("item", "data", F.floor(F.col("block") / 32).alias("tasks"))
    part = part.groupBy("item", "tasks").applyInPandas(some, "item long, data binary")
    return part.groupBy("item").applyInPandas(some, "item long, data binary")


@dataclass
class Softmax:
    """Natural-log probabilities: classes by (previous, skipped), members by previous word within their class."""

    classes: np.ndarray
    members: np.ndarray


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def trigram_rows(spec: ModelSpec) -> np.ndarray:
    """The hashed trigram feature of each history (previous, skipped)."""
    pair = np.arange(spec.previous * spec.skipped, dtype=np.uint64)
    return ((pair * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(spec.trigrams)).astype(np.int64)


def class_scores(w: dict[str, np.ndarray], at: np.ndarray, spec: ModelSpec) -> np.ndarray:
    """Scores of the classes after the histories ``at``."""
    return w["bias"] + w["previous"][at // spec.skipped] + w["skipped"][at % spec.skipped] + w["trigram"][trigram_rows(spec)[at]]


def train(counts: DataFrame, spec: ModelSpec) -> Softmax:
    """Weights by gradient updates over the count table.

    Each round the weights go to the tasks, each adds up its part of the
    gradient, and the driver sums these (as many as the table has parts, all
    bounded by ``spec``).  A step divides the gradient by the expected count of a
    feature, the usual diagonal scaling, with a prior that holds rare ones back.
    """
    spark = counts.sparkSession
    parts = 8
    shaped = counts.withColumn("part", F.pmod("item", F.lit(parts))).repartition(parts, "part").select("item", "data")
    shaped = materialize(shaped, "count-table")
    keys = ("bias", "previous", "skipped", "trigram")
    w = {"bias": np.zeros(spec.classes), "previous": np.zeros((spec.previous, spec.classes)),
         "skipped": np.zeros((spec.skipped, spec.classes)), "trigram": np.zeros((spec.trigrams, spec.classes)),
         "member_bias": np.zeros(spec.buckets), "member": np.zeros((spec.previous, spec.buckets))}

    def sums(shared, first: bool, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Observed and expected counts of the features over a part of the table."""
        w, rows = shared.value, trigram_rows(spec)
        seen, due = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
        for frame in frames:
            for item, data in zip(frame["item"], frame["data"], strict=True):
                cells, begin = np.frombuffer(data, "<i8").astype(np.float64), int(item) * spec.cells
                if begin < spec.history_cells:
                    n = cells.reshape(-1, spec.classes)
                    at = begin // spec.classes + np.arange(len(n))
                    expect = np.exp(log_softmax(class_scores(w, at, spec))) * n.sum(1, keepdims=True)
                    for to, x in ((seen, n), (due, expect)):
                        to["bias"] += x.sum(0)
                        np.add.at(to["previous"], at // spec.skipped, x)
                        np.add.at(to["skipped"], at % spec.skipped, x)
                        np.add.at(to["trigram"], rows[at], x)
                else:
                    n = cells.reshape(-1, spec.classes, spec.members)
                    at = (begin - spec.history_cells) // spec.buckets + np.arange(len(n))
                    scores = (w["member_bias"] + w["member"][at]).reshape(n.shape)
                    expect = np.exp(log_softmax(scores)) * n.sum(2, keepdims=True)
                    for to, x in ((seen, n), (due, expect)):
                        x = x.reshape(len(n), -1)
                        to["member_bias"] += x.sum(0)
                        to["member"][at] += x
        for k in w:
            if seen[k].any() or due[k].any():
                # what no cell of this part touches is zero and packs well; observed counts never change
                yield pd.DataFrame({"name": [k], "seen": [_pack(seen[k]) if first else None], "due": [_pack(due[k])]})

    seen = {k: np.zeros_like(v) for k, v in w.items()}
    for number in range(spec.rounds):
        shared = spark.sparkContext.broadcast(w)
        due = {k: np.zeros_like(v) for k, v in w.items()}
        parts_of = shaped.mapInPandas(lambda frames, shared=shared, first=number == 0: sums(shared, first, frames), "name string, seen binary, due binary")
        for row in parts_of.collect():
            if row["seen"] is not None:
                seen[row["name"]] += _unpack(row["seen"], w[row["name"]].shape)
            due[row["name"]] += _unpack(row["due"], w[row["name"]].shape)
        shared.destroy()
        for k, v in w.items():
            share = spec.step if k in ("member_bias", "member") else spec.step / (len(keys) / 2)
            v += share * np.clip((seen[k] - due[k] - spec.prior * v) / (due[k] + spec.prior), -1.5, 1.5)
    at = np.arange(spec.previous * spec.skipped)
    members = (w["member_bias"] + w["member"]).reshape(spec.previous, spec.classes, spec.members)
    return Softmax(log_softmax(class_scores(w, at, spec)), log_softmax(members).reshape(spec.previous, -1))


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.astype("<f8").tobytes(), 1)


def _unpack(data: bytes, shape: tuple) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<f8").reshape(shape)


SCORED = ("doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, learns: Column, spec: ModelSpec | None = None) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text) where ``learns`` holds, then score every row.

    Returns SCORED: the base score of smoothed word counts and the model's log10
    probability of the whole text with its end.  A null or empty text is its end
    alone, a null condition means not to learn from a row; repeated rows count as
    often as they come; other columns are ignored.  Where nothing is learned, the
    softmaxes are uniform and every word is unknown.  An empty table has no rows.

    Counts of a word meet in one shuffle, a row per block that holds it, and go
    back to their blocks in a second one.  Blocks of texts are joined with their
    words only; no task sees the vocabulary.
    """
    spec = spec or ModelSpec()
    rows = materialize(gather(docs, learns, spec), "gathered")
    by_word = Window.partitionBy("word")
    words = rows.where("kind = 1").select("block", "item", "word", "bucket", "train")
    words = words.withColumn("c", F.sum("train").over(by_word)).withColumn(
        "head", F.row_number().over(by_word.orderBy("block")) == 1)
    counts = materialize(words.select("block", "item", "bucket", "c", "head"), "word-counts")
    model = train(count_table(rows), spec)

    spark = docs.sparkSession
    blocks = rows.where("kind = 0").select("block", "data", "more")

    totals = counts.where("head AND c > 0").groupBy("bucket").agg(F.sum("c").alias("n"), F.count("*").alias("v")).toPandas()
    n, v = np.zeros(spec.buckets), np.zeros(spec.buckets)
    n[totals["bucket"].astype(int)], v[totals["bucket"].astype(int)] = totals["n"], totals["v"]
    shared = spark.sparkContext.broadcast((model.classes / np.log(10), model.members / np.log(10), n, v))

    def rate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({c.split()[0]: [] for c in SCORED.split(", ")})
        classes, members, n, v = shared.value
        head = block_head(left["more"].iloc[0])
        bucket, previous, skipped = block_features(left["more"].iloc[0], spec)
        c = np.zeros(len(bucket))
        c[right["item"].to_numpy()] = right["c"].to_numpy()
        sizes = np.array(head["sizes"], np.int64)
        tokens = unpacked(left["data"].iloc[0], int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        one, two = histories(tokens, sizes, previous, skipped)
        base = np.log10(c + 1) - np.log10(n.sum() + v.sum() + 1)
        inner = np.log10(c + 1) - np.log10(n + v + 1)[bucket]
        target = bucket[tokens]
        full = classes[one * spec.skipped + two, target // spec.members] + members[one, target] + inner[tokens]
        return pd.DataFrame({
            "doc_id": pd.array(head["doc_ids"], "Int64"), "learned": head["learns"], "n_tokens": sizes,
            "n_known": np.add.reduceat((c > 0)[tokens].astype(np.int64), starts), "train_tokens": int(n.sum()),
            "base_score": np.add.reduceat(base[tokens], starts), "score": np.add.reduceat(full, starts)})

    return blocks.groupBy("block").cogroup(counts.select("block", "item", "c").groupBy("block")).applyInPandas(rate, SCORED)


def block_head(more: bytes) -> dict:
    return json.loads(more[:more.index(b"\0")])


def block_features(more: bytes, spec: ModelSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers = np.frombuffer(more[more.index(b"\0") + 1:], "<i4")
    rest, skipped = np.divmod(numbers, spec.skipped)
    return *np.divmod(rest, spec.previous), skipped
