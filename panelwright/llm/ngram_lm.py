"""Maximum-entropy language model over hashed n-gram and skip features, with a class-factored softmax.

log P(word | history) = log P(class | history) + log P(word | class).  A word's
class is a hash of it, one of 65,536.  Every token has hashed features of three
kinds: (previous word, class), (skipped word, class), of the word before the
previous one, and (both words, class).  The class softmax of a previous word, of
a skipped word or of a pair has a bias per class and its features; P(class |
history) is the mean of the three, weighted by kind and by how much each was
learned from.  The last factor is a count share with one unknown word per class.
All probabilities of a history sum to one.

Features are rows of a partitioned table: one row per previous word, skipped
word or pair, its classes and counts within.  Rows do not share a softmax, so a
row holds all that the gradient of its weights needs: the rounds of all rows run
at the same time, in the tasks that hold them, and no weight passes the driver.
The table grows with the distinct n-grams of the corpus.

A frequent word or pair has up to 65,536 classes in every block of text.  Its softmax
is factored once more, P(group | history) P(class | group, history), and each
group is a row of its own, dealt to its own task.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import give_back_memory, in_slices
from panelwright.llm.maxent_lm import text_blocks, tokenised, word_codes
from panelwright.session import materialize


@dataclass(frozen=True)
class NgramSpec:
    """Classes (at most 65,536), groups of a frequent history, training and sizes of what a task holds.

    ``discount`` is taken off every observed count: the gradient of an
    exponential prior on the weights.  Every token has features of the previous
    word, of the skipped one and of both; ``shares`` weigh these kinds, and a
    history has half its share when it was learned from ``trust`` tokens.

    With a number in ``frequent``, only that smaller model: no features of both
    words, and of the skipped word only after a word that is not among the
    ``frequent`` commonest of all training texts; it takes the place of a previous
    word with fewer than ``least`` training tokens.

    A word or pair with more than ``hot_share`` of the training tokens is split.
    ``sample_rows`` has no effect any more; callers may still pass it.
    """

    classes: int = 1 << 16
    groups: int = 64
    discount: float = 0.75
    least: int = 2
    rounds: int = 12
    tolerance: float = 1e-9
    frequent: int | None = None
    sample_rows: int = 2000
    hot_share: float = 0.001
    block_chars: int = 6_000_000
    part_chars: int = 5_000_000
    shares: tuple[float, float, float] = (0.2, 0.1, 0.7)
    trust: tuple[float, float, float] = (10.0, 10.0, 1.0)


# Arrays in bytes


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed run of byte planes."""
    raw = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() if len(x) else b"" for x in arrays)
    head = b"".join(struct.pack("<cI", x.dtype.char.encode(), len(x)) for x in arrays)
    return struct.pack("<BQ", len(arrays), len(raw)) + head + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    number, size = struct.unpack_from("<BQ", data)
    head = [struct.unpack_from("<cI", data, 9 + 5 * i) for i in range(number)]
    raw = np.frombuffer(pa.decompress(data[9 + 5 * number:], size, codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for char, count in head:
        kind = np.dtype(char.decode())
        planes = raw[at:at + count * kind.itemsize].reshape(kind.itemsize, count)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += count * kind.itemsize
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Histories and their features

#: Kinds of histories: the previous word, the skipped word before it, both together.
BIGRAM, SKIP, BOTH = range(3)


@dataclass(frozen=True)
class Frequent:
    """Codes of the frequent words, ascending (None: no word loses features), and of those whose histories are split.

    ``pairs`` are the split histories of both words, numbers of (previous, skipped) among ``hot``.
    """

    codes: np.ndarray | None
    hot: np.ndarray
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def slots(self) -> int:
        """Number of split histories: the hot words as previous, then as skipped words, then the pairs."""
        return 2 * len(self.hot) + len(self.pairs)

    def is_tail(self, codes: np.ndarray) -> np.ndarray:
        return np.ones(len(codes), bool) if self.codes is None else ~np.isin(codes, self.codes)

    def hot_number(self, codes: np.ndarray) -> np.ndarray:
        """Position among the split ones, -1 for others."""
        return position(self.hot, codes)

    def slot(self, kind: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Number of each history among the split ones, -1 for others; ``one`` and ``two`` are hot numbers of its words."""
        if kind == BOTH:
            at = position(self.pairs, np.where((one >= 0) & (two >= 0), one * len(self.hot) + two, -1))
            return np.where(at >= 0, 2 * len(self.hot) + at, -1)
        return one if kind == BIGRAM else np.where(two >= 0, len(self.hot) + two, -1)


def position(names: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Position of each value in ascending names, -1 where it is none."""
    if not len(names):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(names, values), len(names) - 1)
    return np.where(names[at] == values, at, -1)


def before(tokens: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the word before each token and of the one before that; the end stands for what is before a text."""
    one, two = np.full(len(tokens), end, np.int64), np.full(len(tokens), end, np.int64)
    one[1:], two[2:] = tokens[:-1], tokens[:-2]
    starts = np.cumsum(sizes) - sizes
    one[starts] = end
    two[starts] = end
    two[(starts + 1)[sizes > 1]] = end
    return one, two


def tokens_with(kind: int, one: np.ndarray, tail: np.ndarray, frequent: Frequent) -> slice | np.ndarray:
    """The tokens that have a feature of a kind: all, unless ``frequent`` names words; ``tail`` is by word number."""
    if kind == BIGRAM or frequent.codes is None:
        return slice(None)
    return np.flatnonzero(tail[one]) if kind == SKIP else np.zeros(0, np.int64)


def block_items(tokens: np.ndarray, sizes: np.ndarray, codes: np.ndarray, frequent: Frequent, spec: NgramSpec) -> dict[str, np.ndarray | slice]:
    """The features of a block, a row per history and a class per feature, by kind.

    ``which`` is the item of each token that has a feature of a kind, those of the
    first kind before the others; ``some`` are the tokens that have one of the
    skipped word.  Of each row: its first item (firsts) and number of items
    (lengths), kind, word before (BOTH: -1), group (0: not split), number among
    the split histories (slot), and a 64-bit name that holds over all blocks
    (keys), the same for a word as the previous and as the skipped one.
    """
    one, two = before(tokens, sizes, len(codes) - 1)
    hot, tail = frequent.hot_number(codes), frequent.is_tail(codes)
    # classes in the order of their groups
    per = -(-spec.classes // spec.groups)
    group, rest = (codes % np.uint64(spec.classes)).astype(np.int64) % spec.groups, (codes % np.uint64(spec.classes)).astype(np.int64) // spec.groups
    cell, cells = group * per + rest, per * spec.groups
    out, begin = [], 0
    for kind in (BIGRAM, SKIP, BOTH):
        at = tokens_with(kind, one, tail, frequent)
        history, names = one[at] if kind == BIGRAM else two[at], None
        if kind == BOTH:
            history = one[at] * len(codes) + history
            if len(codes) ** 2 * cells >= 1 << 63:
                names, history = np.unique(history, return_inverse=True)
        items, which = np.unique(history * cells + cell[tokens[at]], return_inverse=True)
        which = (which + begin).astype(np.int32)
        history, items = np.divmod(items, cells)
        if kind == BOTH:
            words = np.divmod(history if names is None else names[history], len(codes))
            slot = frequent.slot(kind, hot[words[0]], hot[words[1]])
        else:
            words = (history, history)
            slot = frequent.slot(kind, hot[history], hot[history])
        group, rest = np.divmod(items, per)
        firsts = np.flatnonzero((np.diff(history, prepend=-1) != 0) | (slot >= 0) & (np.diff(group, prepend=-1) != 0))
        slot = slot[firsts].astype(np.int32)
        of = np.where(slot >= 0, 1 + group[firsts], 0)
        name = codes[words[0][firsts]]
        if kind == BOTH:
            name = mixed(mixed(name) + codes[words[1][firsts]])
        salt = ((kind // BOTH) * (spec.groups + 1) + of).astype(np.uint64)
        out.append({"classes": (rest * spec.groups + group).astype(np.uint16), "which": which, "firsts": (firsts + begin).astype(np.int32),
                    "lengths": np.diff(firsts, append=len(items)).astype(np.int32), "kind": np.full(len(firsts), kind, np.uint8),
                    "word": np.full(len(firsts), -1, np.int32) if kind == BOTH else words[0][firsts].astype(np.int32),
                    "group": of.astype(np.int32), "slot": slot, "keys": mixed(name + salt * np.uint64(0x9E3779B97F4A7C15))})
        if kind == SKIP:
            some = at
        begin += len(items)
    return {k: np.concatenate([x.pop(k) for x in out]) for k in list(out[0])} | {"some": some}


GATHERED = "block long, data binary, more binary"


def gather(docs: DataFrame, spec: NgramSpec) -> DataFrame:
    """``docs`` (doc_id, text, learns) as blocks of texts: word numbers and the words' codes (data) with their documents (more)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, texts in enumerate(text_blocks(in_slices(batches, 2000), spec.block_chars)):
            tokens, sizes, words = tokenised(texts.column("text").combine_chunks())
            codes = word_codes(words)
            head = {"doc_ids": texts.column("doc_id").to_pylist(), "sizes": sizes.tolist(), "learns": texts.column("learns").to_pylist()}
            del words, texts
            yield arrow([(task << 24) + number], [pack(tokens.astype(np.uint32), codes)], [json.dumps(head).encode()], schema=GATHERED)

    return docs.mapInArrow(run, GATHERED)


def arrow(*columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[kind]) for x, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, codes, sizes, True for the tokens learned from) of each block."""
    for batch in in_slices(batches, 1):
        tokens, codes = unpack(batch.column("data")[0].as_py())
        head = json.loads(batch.column("more")[0].as_py())
        sizes = np.array(head["sizes"], np.int64)
        yield tokens.astype(np.int64), codes, sizes, np.repeat(np.array(head["learns"], bool), sizes)


def frequent_words(docs: DataFrame, spec: NgramSpec) -> Frequent:
    """Frequent words of the training texts; ``docs`` has doc_id, text and learns."""
    return frequent_codes(gather(docs, spec), spec)


def frequent_codes(blocks: DataFrame, spec: NgramSpec) -> Frequent:
    """Frequent words by their training counts over all blocks.

    At most ``frequent`` codes reach the driver, without that limit the codes of the split histories only.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, codes, _, used in unpacked(batches):
            n = np.bincount(tokens[used], minlength=len(codes))
            yield arrow(codes[n > 0].view(np.int64), n[n > 0], schema="code long, n long")
            yield arrow([None], [int(n.sum())], schema="code long, n long")

    counted = blocks.select("data", "more").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    if spec.frequent is None:
        # the row without a code counts all tokens, and fewer words than this have a larger share
        top = materialize(counted.orderBy(F.desc("n"), "code").limit(2 + int(1 / spec.hot_share)), "frequent").collect()
        least = spec.hot_share * max([r["n"] for r in top if r["code"] is None], default=0)
        hot = np.sort(np.array([r["code"] for r in top if r["code"] is not None and r["n"] > least], np.int64).view(np.uint64))
        return Frequent(None, hot, hot_pairs(blocks, Frequent(None, hot), least))
    # written, not collected: collecting sends the driver that many words of every partition
    top = materialize(counted.where("code IS NOT NULL AND n > 1").orderBy(F.desc("n"), "code").limit(spec.frequent), "frequent").toPandas()
    codes, n = top["code"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    # the end stands before every text, and is always there
    end = word_codes(["\n"])
    return Frequent(np.unique(np.append(codes, end)), np.sort(codes[n > spec.hot_share * max(1, n.sum())]))


def hot_pairs(blocks: DataFrame, frequent: Frequent, least: float) -> np.ndarray:
    """Pairs of hot words that stand before more than ``least`` training tokens."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, codes, sizes, used in unpacked(batches):
            hot = frequent.hot_number(codes)
            one, two = (hot[x[used]] for x in before(tokens, sizes, len(codes) - 1))
            pairs, n = np.unique((one * len(frequent.hot) + two)[(one >= 0) & (two >= 0)], return_counts=True)
            yield arrow(pairs, n, schema="pair long, n long")

    counted = blocks.select("data", "more").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return np.sort(counted.where(F.col("n") > least).toPandas()["pair"].to_numpy(np.int64))


TOTALS = "block long, totals binary"


def task_totals(blocks: DataFrame, frequent: Frequent, spec: NgramSpec) -> DataFrame:
    """For each task (block: its number) the training counts of classes and of groups after split histories."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(spec.classes, np.int64)
        after = np.zeros(frequent.slots * spec.groups, np.int64)
        for tokens, codes, sizes, used in unpacked(batches):
            target = (codes % np.uint64(spec.classes)).astype(np.int64)[tokens[used]]
            totals += np.bincount(target, minlength=spec.classes)
            tail, hot = frequent.is_tail(codes), frequent.hot_number(codes)
            one, two = (x[used] for x in before(tokens, sizes, len(codes) - 1))
            for kind in (BIGRAM, SKIP, BOTH):
                at = tokens_with(kind, one, tail, frequent)
                slot = frequent.slot(kind, hot[one[at]], hot[two[at]])
                cell = (slot * spec.groups + target[at] % spec.groups)[slot >= 0]
                after += np.bincount(cell, minlength=len(after)).astype(np.int64)
        yield arrow([TaskContext.get().partitionId()], [pack(totals, after)], schema=TOTALS)

    return blocks.select("data", "more").mapInArrow(run, TOTALS)


@dataclass
class Block:
    """A block of texts and the rows of features in it, as ``block_items`` has them; the same wherever it is worked out."""

    tokens: np.ndarray
    sizes: np.ndarray
    codes: np.ndarray
    which: np.ndarray
    some: np.ndarray | slice
    classes: np.ndarray  # of each item
    firsts: np.ndarray
    lengths: np.ndarray
    kind: np.ndarray
    word: np.ndarray
    group: np.ndarray
    slot: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, data: bytes, sizes: list[int], frequent: Frequent, spec: NgramSpec) -> Block:
        tokens, codes = unpack(data)
        sizes = np.array(sizes, np.int64)
        return cls(tokens, sizes, codes, **block_items(tokens, sizes, codes, frequent, spec))

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and items as their packets hold them: by key, and so by part, then by kind."""
        rows = np.argsort(self.keys, kind="stable")
        lengths = self.lengths[rows]
        shift = self.firsts[rows] - (np.cumsum(lengths, dtype=np.int32) - lengths)
        return rows, np.repeat(shift, lengths) + np.arange(len(self.classes), dtype=np.int32)


PACKETS = "block long, part int, data binary"


def packets(blocks: DataFrame, frequent: Frequent, parts: int, spec: NgramSpec) -> DataFrame:
    """Features of the blocks, a packet for each part that has any: keys, flags and lengths of rows, classes and training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            number, data, more = (batch.column(i)[0].as_py() for i in range(3))
            head = json.loads(more)
            b = Block.of(data, head["sizes"], frequent, spec)
            used = np.repeat(np.array(head["learns"], bool), b.sizes)
            both = used if frequent.codes is None else used[:0]
            n = np.bincount(b.which[np.concatenate([used, used[b.some], both])], minlength=len(b.classes)).astype(np.uint32)
            by_row, by_item = b.order()
            keys = b.keys[by_row]
            again = np.append(False, keys[1:] == keys[:-1])
            flags = (b.kind * 2 + (b.group > 0))[by_row] + np.uint8(8) * again
            # a part is a range of keys
            part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
            there, row_at = np.unique(part, return_index=True)
            row_at = np.append(row_at, len(by_row))
            item_at = np.append(0, np.cumsum(b.lengths[by_row]))[row_at]
            out = []
            for i in range(len(there)):
                r, t = slice(row_at[i], row_at[i + 1]), by_item[item_at[i]:item_at[i + 1]]
                names = np.diff(keys[r][~again[r]], prepend=np.uint64(0))
                out.append(pack(names, flags[r], b.lengths[by_row[r]].astype(np.uint32), b.classes[t], n[t]))
            del b, n, by_row, by_item, keys, again, flags, part
            give_back_memory()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), number)), pa.array(there, pa.int32()), pa.array(out, pa.binary())],
                                             names=[c.split()[0] for c in PACKETS.split(", ")])

    return blocks.select("block", "data", "more").mapInArrow(run, PACKETS)


def add_totals(rows: DataFrame, spec: NgramSpec, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(training count of each class, of each group after each split history); 32 tasks at a time."""
    def some(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        each = [unpack(d) for d in frame["totals"]]
        return pd.DataFrame({"block": [key[0]], "totals": [pack(*(np.sum(x, axis=0) for x in zip(*each, strict=True)))]})

    left = rows
    last = left.agg(F.max("block")).first()[0] or 0
    while last > 0:
        left = left.groupBy(F.floor(F.col("block") / 32).alias("block")).applyInPandas(some, "block long, totals binary")
        last //= 32
    totals, after = np.zeros(spec.classes, np.int64), np.zeros(slots * spec.groups, np.int64)
    for row in left.collect():
        t, a = unpack(row["totals"])
        totals, after = totals + t, after + a
    return totals, after.reshape(slots, spec.groups)


# Training


def fit_rows(row: np.ndarray, n: np.ndarray, base: np.ndarray, possible: np.ndarray, spec: NgramSpec) -> tuple[np.ndarray, np.ndarray]:
    """(natural-log probability of each item, training count of each row) of softmaxes with a bias and a weight per item.

    ``row`` and ``n`` are the row and the training count of an item, ``base`` its
    probability by the bias alone, ``possible`` the number of items a row can
    have, listed or not.  Weights start at what each would be alone in its row; a
    round moves every weight along its gradient, observed less ``discount`` minus
    expected count, and then the weight that a row's seen items share to where
    its own gradient vanishes.  What the discount takes goes to unseen items; in
    a row without any it stays in proportion.
    """
    rows = len(possible)
    total = np.bincount(row, n, minlength=rows)
    logs = np.log(base)
    seen = np.flatnonzero(n > 0)
    if not len(seen):
        return logs, total
    r, b = row[seen], base[seen]
    target = n[seen] - spec.discount
    wanted = np.bincount(r, target, minlength=rows)
    full = np.bincount(r, minlength=rows) >= possible
    target *= np.where(full[r], (total / np.maximum(wanted, 1e-300))[r], 1.0)
    rest = np.where(full, 0.0, np.maximum(1 - np.bincount(r, b, minlength=rows), 1e-12))
    trained = total > 0
    free = trained & ~full
    odds = wanted[free] / (total - wanted)[free]
    weight = np.log(target / total[r] / b)
    for _ in range(spec.rounds):
        pull = b * np.exp(weight)
        z = rest + np.bincount(r, pull, minlength=rows)
        expected = total[r] * pull / z[r]
        gap = target - expected
        if np.max(np.abs(gap) / total[r]) < spec.tolerance:
            break
        weight += gap / np.maximum(expected, target)
        mass = np.bincount(r, b * np.exp(weight), minlength=rows)
        shift = np.zeros(rows)
        shift[free] = np.log(odds * rest[free] / mass[free])
        weight += shift[r]
    z = rest + np.bincount(r, b * np.exp(weight), minlength=rows)
    logs[seen] += weight
    logs -= np.log(np.where(trained, z, 1.0))[row]
    return logs, total


ANSWERS = "block long, part int, data binary, known long"


def coded(logs: np.ndarray) -> list[np.ndarray]:
    """Log probabilities as (distinct values that come again, codes into them, the others in order); code 0 is an other."""
    values, which, times = np.unique(np.round(logs, 6).astype(np.float32), return_inverse=True, return_counts=True)
    again = np.flatnonzero(times > 1)[:65535]
    codes = np.zeros(len(values), np.uint16)
    codes[again] = np.arange(1, len(again) + 1)
    codes = codes[which]
    return [values[again], codes, values[which[codes == 0]]]


def decoded(values: np.ndarray, codes: np.ndarray, others: np.ndarray) -> np.ndarray:
    out = np.append(np.float32(0), values)[codes]
    out[codes == 0] = others
    return out


def answer_part(frame: pd.DataFrame, bias: np.ndarray, spec: NgramSpec) -> pd.DataFrame:
    """Train the rows of a part and answer its packets: training count of each row, log probability of each item.

    One more row, of a block that is none, counts the distinct words known here.
    """
    held = [unpack(d) for d in frame["data"]]
    sizes = [(len(p[1]), len(p[3])) for p in held]
    for p in held:
        # a key for each row, by kind
        p[0] = mixed(np.cumsum(p[0])[np.cumsum(p[1] < 8) - 1] + (p[1] >> 1 & 3).astype(np.uint64))
    keys, flags, lengths, target, n = (np.concatenate(x) for x in zip(*held, strict=True))
    del held
    names, first, at = np.unique(keys, return_index=True, return_inverse=True)
    flag = flags[first] & 7
    items, which = np.unique(np.repeat(at, lengths) * spec.classes + target, return_inverse=True)
    counts = np.bincount(which, n, minlength=len(items))
    row, of = np.divmod(items, spec.classes)
    del keys, flags, lengths, target, n, items
    split = (flag & 1).astype(bool)[row]
    group = np.arange(spec.classes) % spec.groups
    mass, members = np.bincount(group, bias), np.bincount(group)
    base = bias[of] / np.where(split, mass[of % spec.groups], 1.0)
    possible = np.full(len(names), spec.classes)
    possible[row[split]] = members[of[split] % spec.groups]
    logs, total = fit_rows(row, counts, base, possible, spec)
    # these have no weight where nothing is learned
    logs[(np.isin(flag, (2 * SKIP, 2 * BOTH)) & (total == 0))[row]] = 0
    data, r, i = [], 0, 0
    for in_rows, in_items in sizes:
        data.append(pack(total[at[r:r + in_rows]].astype(np.int64), *coded(logs[which[i:i + in_items]])))
        r, i = r + in_rows, i + in_items
    part = int(frame["part"].iloc[0])
    return pd.DataFrame({"block": [*frame["block"], -1 - part], "part": [part] * (len(data) + 1), "data": [*data, None],
                         "known": pd.array([None] * len(data) + [int(((flag == 0) & (total > 0)).sum())], "Int64")})


# Scoring

SCORED = ("doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
RATED = "doc_id long, learned boolean, n_tokens long, n_known long, log_counts double, score double, known long"


def rate_block(left: pd.DataFrame, right: pd.DataFrame, totals: np.ndarray, after: np.ndarray, group_logs: np.ndarray,
               frequent: Frequent, spec: NgramSpec) -> pd.DataFrame:
    """Scores of a block's documents from the answers of all parts."""
    head = json.loads(left["more"].iloc[0])
    b = Block.of(left["data"].iloc[0], head["sizes"], frequent, spec)
    by_row, by_item = b.order()
    answers = [unpack(d) for d in right.sort_values("part")["data"]]
    count, logs = np.zeros(len(b.firsts), np.int64), np.zeros(len(b.classes))
    count[by_row] = np.concatenate([a[0] for a in answers])
    logs[by_item] = np.concatenate([decoded(*a[1:]) for a in answers])
    del answers, by_row, by_item
    split = b.slot >= 0
    # a split history counts as often as all its groups, also those that this block has no row of
    count[split] = after.sum(1)[b.slot[split]]
    add = np.zeros(len(count))
    add[split] = group_logs[b.slot[split], b.group[split] - 1]
    logs += np.repeat(add, b.lengths)
    words = np.zeros(len(b.codes), np.int64)
    words[b.word[b.kind == BIGRAM]] = count[b.kind == BIGRAM]

    if frequent.codes is None:
        best = joined(b, logs, count, spec)
    else:
        count_of_item = np.repeat(count, b.lengths)
        best, skipped = logs[b.which[:len(b.tokens)]], b.which[len(b.tokens):]
        leaves = (count_of_item[b.which[:len(b.tokens)]][b.some] < spec.least) & (count_of_item[skipped] > 0)
        best[b.some[leaves]] = logs[skipped[leaves]]
    classes = (b.codes % np.uint64(spec.classes)).astype(np.int64)
    inner = np.log(np.maximum(words, 1)) - np.log(totals + 1)[classes]
    starts = np.cumsum(b.sizes) - b.sizes
    return pd.DataFrame({
        "doc_id": pd.array(head["doc_ids"], "Int64"), "learned": head["learns"], "n_tokens": b.sizes,
        "n_known": np.add.reduceat((words > 0)[b.tokens].astype(np.int64), starts),
        "log_counts": np.add.reduceat(np.log10(words + 1)[b.tokens], starts),
        "score": np.add.reduceat(best + inner[b.tokens], starts) / np.log(10), "known": pd.array([None] * len(b.sizes), "Int64")})


def joined(b: Block, logs: np.ndarray, count: np.ndarray, spec: NgramSpec) -> np.ndarray:
    """Log probability of each token from those of its items and the training counts of its rows: the weighted mean of the kinds."""
    weight = np.repeat(np.array(spec.shares)[b.kind] * count / (count + np.array(spec.trust)[b.kind]), b.lengths)
    known, best = np.zeros(len(b.tokens)), np.zeros(len(b.tokens))
    p = weight * np.exp(logs)
    for which in b.which.reshape(3, -1):
        known += weight[which]
        best += p[which]
    # where no history is known, that of the previous word is the bias
    none = known == 0
    best[none], known[none] = np.exp(logs[b.which[:len(b.tokens)][none]]), 1
    return np.log(best / known)


def score(docs: DataFrame, learns: Column, spec: NgramSpec | None = None) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text) where ``learns`` holds, then score every row.

    Returns SCORED: the base score of smoothed word counts and the model's log10
    probability of the whole text with its end.  A null or empty text is its end
    alone, a null condition means not to learn from a row; repeated rows count as
    often as they come; other columns are ignored.  Where nothing is learned, all
    classes are equally likely and every word is unknown.  An empty table has no
    rows.  Words count as equal if their 64-bit hashes are.

    A block of texts sends each distinct feature once, in packets by part, and
    gets a probability for it back, to six decimals; texts go to their answers as
    word numbers.  Disk: about 6.6 times the documents as Parquet.
    """
    spec = spec or NgramSpec()
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(learns, F.lit(False)).alias("learns"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + chars // spec.part_chars
    blocks = materialize(gather(rows, spec), "blocks")
    frequent = frequent_codes(blocks, spec)
    totals, after = add_totals(materialize(task_totals(blocks, frequent, spec), "totals"), spec, frequent.slots)
    bias = (totals + 1) / (totals.sum() + spec.classes)
    mass = np.bincount(np.arange(spec.classes) % spec.groups, bias)
    group_logs = fit_rows(np.repeat(np.arange(len(after)), spec.groups), after.ravel(), np.tile(mass, len(after)), np.full(len(after), spec.groups), spec)[0]
    shared = spark.sparkContext.broadcast((totals, after, group_logs.reshape(after.shape), bias))

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        out = answer_part(frame, shared.value[3], spec)
        give_back_memory()
        return out

    def rate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            empty = pd.DataFrame({c.split()[0]: [None] * len(right) for c in RATED.split(", ")})
            return empty.assign(known=right["known"].to_numpy())
        out = rate_block(left, right, *shared.value[:3], frequent, spec)
        give_back_memory()
        return out

    answers = packets(blocks, frequent, parts, spec).groupBy("part").applyInPandas(answer, ANSWERS)
    rated = materialize(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(rate, RATED), "rated")

    known = int((after[:len(frequent.hot)].sum(1) > 0).sum()) + (rated.agg(F.sum("known")).first()[0] or 0)
    seen = int(totals.sum())
    base = F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(seen + known + 1)))
    return rated.where("known IS NULL").select("doc_id", "learned", "n_tokens", "n_known", F.lit(seen).cast("long").alias("train_tokens"),
                                               base.alias("base_score"), "score")
