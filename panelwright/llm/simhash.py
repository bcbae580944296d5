"""SimHash fingerprints and the groups of those that differ in few bits, by multi-index hashing.

A fingerprint is cut into segments.  Two that differ in at most r bits differ in
few bits of at least one segment, so each looks up the small Hamming ball around
its own segment values in tables of all segment values, and whole distances
verify what it meets.  Equal fingerprints are one class from the start, and a
table entry is never expanded into rows of pairs: every visitor is first compared
with one leader, and what that leaves apart is compared in blocks inside tasks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import in_slices
from panelwright.llm.graph import star_components
from panelwright.llm.tokens import slices, spread
from panelwright.session import materialize

BITS = 64
#: Seed of the shingle hash (fixed by the contract).
SEED = 42
#: Shingles hashed together.
CHUNK = 1 << 16
#: Bytes of a long text looked at together.
LONG = 4_000_000
#: Pairs compared together.
PAIRS = 1 << 21


@dataclass(frozen=True)
class SimhashSpec:
    """Parameters.

    Fingerprints over shingles of ``words`` words link at ``distance`` or fewer
    differing bits.  ``segments`` None: about 64 / log2 of the number of distinct
    fingerprints, so that a table entry holds few of them, between 2 and 4; results
    do not depend on it.  A block of a large entry holds about ``block_rows``.
    """

    words: int = 4
    distance: int = 4
    segments: int | None = None
    block_rows: int = 1024


# fingerprints


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Texts (bytes side by side, starts in ``at``) as words with one blank between.

    Returns the bytes, A-Z lower-cased, where each word starts and ends there, and
    how many words lie before each text (and in all).
    """
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    opens, closes = np.empty(len(data), bool), np.empty(len(data), bool)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    opens[:1], closes[-1:] = True, True
    opens[1:] = blank[:-1] | edge[1:-1]
    closes[:-1] = blank[1:] | edge[1:-1]
    opens &= ~blank
    closes &= ~blank
    kept = np.flatnonzero(~blank)
    upper = (data >= 65) & (data <= 90)
    lowered = data + upper.astype(np.uint8) * np.uint8(32)
    nth = np.cumsum(opens, dtype=np.int64)  # number of the word a byte is in, from 1
    place = np.arange(len(kept)) + nth[kept] - 1  # a blank before each word but the first
    out = np.full(int(place[-1]) + 1 if len(kept) else 0, 32, np.uint8)
    out[place] = lowered[kept]
    starts, ends = place[opens[kept]], place[closes[kept]] + 1
    return out.tobytes(), starts, ends, np.append(0, nth)[at]


def set_bits(data: np.ndarray, at: np.ndarray, spec: SimhashSpec) -> tuple[np.ndarray, np.ndarray]:
    """(how often each bit is set in the shingles' hashes, number of shingles) of each text.

    No words: no shingle; fewer words than a shingle has: all of them as one.
    """
    text, starts, ends, before = word_spans(data, at)
    n = np.diff(before)
    shingles = np.where(n >= spec.words, n - spec.words + 1, np.minimum(n, 1))
    first = np.repeat(before[:-1], shingles) + np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = np.minimum(first + spec.words, np.repeat(before[1:], shingles)) - 1
    begin, end = starts[first], ends[last]
    owner = np.repeat(np.arange(len(n)), shingles)
    ones = np.zeros((len(n), BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(begin), CHUNK):
        a, b = begin[i:i + CHUNK].tolist(), end[i:i + CHUNK].tolist()
        h = np.fromiter((digest(text[x:y], SEED) for x, y in zip(a, b, strict=True)), np.uint64, len(a))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        who = owner[i:i + CHUNK]
        cuts = np.flatnonzero(np.diff(who, prepend=-1))
        ones[who[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    return ones, shingles


def set_bits_of_long(data: np.ndarray, spec: SimhashSpec) -> tuple[np.ndarray, np.ndarray]:
    """``set_bits`` of one very long text, part by part; a part starts with the last words of the one before."""
    ones, shingles, carried, at = np.zeros((1, BITS), np.int64), np.zeros(1, np.int64), b"", 0
    while at < len(data):
        to = at + LONG
        while to < len(data) and not (data[to] == 32 or 9 <= data[to] <= 13):
            to += 1
        part = np.frombuffer(carried + b" " + data[at:to].tobytes(), np.uint8)
        text, starts, ends, _ = word_spans(part, np.array([0, len(part)]))
        if len(starts) >= spec.words:
            more, n = set_bits(part, np.array([0, len(part)]), spec)
            ones, shingles = ones + more, shingles + n
        carried = text[starts[-spec.words + 1:][0]:] if len(starts) >= spec.words else text
        at = to
    return (ones, shingles) if shingles[0] else set_bits(np.frombuffer(carried, np.uint8), np.array([0, len(carried)]), spec)


def fingerprint_rows(data: np.ndarray, at: np.ndarray, spec: SimhashSpec) -> np.ndarray:
    """The fingerprint of each text: a bit is set if it is in over half of the hashes; no words: zero."""
    ones, shingles = set_bits_of_long(data, spec) if len(at) == 2 and len(data) > LONG else set_bits(data, at, spec)
    return np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, spec: SimhashSpec = SimhashSpec()) -> DataFrame:
    """(doc_id, fp long) for every row of ``docs`` (doc_id, text); a null text counts as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1000):
            texts = batch.column("text")
            for a, b in slices(texts):
                part = texts.slice(a, b - a)
                at = np.frombuffer(part.buffers()[1], np.int32, len(part) + 1, part.offset * 4).astype(np.int64)
                whole = part.buffers()[2]
                data = np.frombuffer(whole, np.uint8)[at[0]:at[-1]] if whole is not None else np.zeros(0, np.uint8)
                fp = fingerprint_rows(data, at - at[0], spec)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def hex_of(fp: F.Column) -> F.Column:
    """16 lower-case hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# segment tables


@dataclass(frozen=True)
class Segment:
    """Bits [low, low + width) of a fingerprint, searched within ``radius``."""

    low: int
    width: int
    radius: int

    def masks(self) -> np.ndarray:
        """Changes to the value of the segment that its Hamming ball allows, none first."""
        flips = [sum(1 << b for b in bits) for r in range(self.radius + 1) for bits in itertools.combinations(range(self.width), r)]
        return np.array(flips, dtype=np.uint64)


def segments_of(distance: int, count: int) -> list[Segment]:
    """Segments of which one is met within its radius by every two fingerprints ``distance`` bits apart.

    With distance = a * count + b, either one of the first b + 1 segments differs in
    at most a bits, or one of the others in at most a - 1: else more bits differ.
    """
    a, b = divmod(distance, count)
    edges = [round(BITS * k / count) for k in range(count + 1)]
    out = [Segment(lo, hi - lo, a if k <= b else a - 1) for k, (lo, hi) in enumerate(itertools.pairwise(edges))]
    return [s for s in out if s.radius >= 0]


def chosen_segments(distinct: int, spec: SimhashSpec) -> int:
    if spec.segments:
        return spec.segments
    return min(4, max(2, round(BITS / math.log2(max(2, distinct)))))


LOOKUPS = "bucket long, rep long, fp long, home boolean"


def lookups(classes: DataFrame, segments: list[Segment]) -> DataFrame:
    """LOOKUPS for every class (rep, fp): home rows fill the tables, the others visit them.

    Of two values in each other's ball only the smaller visits the larger.
    """
    masks = [s.masks() for s in segments]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, max(1, 200_000 // sum(map(len, masks)))):
            rep, fp = batch.column("rep").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            for k, (s, flips) in enumerate(zip(segments, masks, strict=True)):
                value = (fp >> np.uint64(s.low)) & np.uint64((1 << s.width) - 1)
                seen = value[:, None] ^ flips[None, :]
                who, which = np.nonzero(seen >= value[:, None])
                bucket = seen[who, which] | np.uint64(k << 48)
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(rep[who]), pa.array(fp[who].view(np.int64)),
                                                  pa.array(which == 0)], names=["bucket", "rep", "fp", "home"])

    return classes.select("rep", "fp").mapInArrow(run, LOOKUPS)


def differing(x: str, y: str) -> F.Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y)))


def links(classes: DataFrame, spec: SimhashSpec) -> DataFrame:
    """Edges (a, b) between the reps of classes (rep, fp) that connect all that verified distances can connect."""
    looked = materialize(lookups(classes, segments_of(spec.distance, chosen_segments(classes.count(), spec))), "lookups")
    leader = looked.where("home").groupBy("bucket").agg(F.min(F.struct("rep", "fp")).alias("l"))
    leader = leader.select("bucket", F.col("l.rep").alias("leader"), F.col("l.fp").alias("leader_fp"))
    first = looked.join(leader, "bucket").where((F.col("rep") != F.col("leader")) & (differing("fp", "leader_fp") <= spec.distance))
    first = materialize(first.select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct(), "links")
    grouped = star_components(first).withColumnRenamed("node", "rep")
    known = looked.join(grouped, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    rest = materialize(in_blocks(materialize(open_blocks(known, spec), "blocks"), spec), "links")
    return first.unionByName(rest)


GROUP = ("bucket", "low", "high")


def open_blocks(known: DataFrame, spec: SimhashSpec) -> DataFrame:
    """Rows of the entries whose homes and visitors are still of several components, dealt into blocks.

    Every two blocks of an entry, and each with itself, are one group; ``block``
    says whose a row is.
    """
    known = materialize(known, "known")
    several = known.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("home").alias("homes"),
                                          F.ceil(F.count("*") / spec.block_rows).cast("int").alias("blocks"))
    rows = known.join(several.where("x < y AND homes").select("bucket", "blocks"), "bucket")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                       "block", "fp", "component", "home")


def in_blocks(rows: DataFrame, spec: SimhashSpec) -> DataFrame:
    """Verified links (a, b) between components, found by comparing the rows of each group with its homes.

    Ranges of groups are partitions of about equal rows; a group is never cut.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *GROUP).sortWithinPartitions(*GROUP, "block", F.desc("home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            a, b = compared(table, spec.distance)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch], least: int = 50_000) -> Iterator[pa.Table]:
    """The rows of a sorted partition in tables that hold whole groups, of ``least`` rows or one group more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = np.stack([table.column(c).to_numpy() for c in GROUP])
        cut = int(np.flatnonzero((keys != keys[:, -1:]).any(0)).max(initial=-1)) + 1
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def compared(table: pa.Table, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components with a row and a home of one group within ``distance``, each once.

    A group's rows stand by block, homes first; a row meets the homes of the other
    block, or of its own where the group has one.
    """
    bucket, low, high, block, fp, component = (table.column(c).to_numpy() for c in (*GROUP, "block", "fp", "component"))
    home, fp = table.column("home").to_numpy(zero_copy_only=False), fp.view(np.uint64)
    keys = np.stack([bucket, low, high, block])
    starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
    run = np.cumsum(np.bincount(starts, minlength=len(fp))) - 1
    homes = np.add.reduceat(home.astype(np.int64), starts)
    group = np.stack([bucket, low, high])[:, starts]
    same = np.append((group[:, 1:] == group[:, :-1]).all(0), False)  # the next run is of this group
    meets = np.where(low[starts] == high[starts], np.arange(len(starts)),
                     np.where(same, np.arange(len(starts)) + 1, np.arange(len(starts)) - 1))
    alone = (low[starts] != high[starts]) & ~same & ~np.append(False, same[:-1])
    size = np.where(alone[run], 0, homes[meets[run]])
    first = starts[meets[run]]
    found, at = [], 0
    ends = np.cumsum(size)
    while at < len(fp):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        left, right = np.repeat(np.arange(at, to), size[at:to]), spread(first[at:to], size[at:to])
        apart = component[left] != component[right]
        left, right = left[apart], right[apart]
        near = np.bitwise_count(fp[left] ^ fp[right]) <= distance
        x, y = component[left[near]], component[right[near]]
        if len(x):
            found.append(np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)]), axis=1))
        at = to
    every = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return every[0], every[1]


def components(docs: DataFrame, spec: SimhashSpec = SimhashSpec()) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over links.  Null, empty and blank
    texts have fingerprint zero, which is linked like any other.  Rows that share a
    doc_id are one document with several texts, so their fingerprints are linked.
    A row without doc_id takes no part: its component_id is null.  Other columns are
    ignored; an empty table gives no rows.
    """
    marked = materialize(fingerprints(docs, spec), "fingerprints")
    named = marked.where("doc_id IS NOT NULL")
    classes = materialize(named.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    several = named.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("doc_id")
    again = named.join(several, "doc_id").join(classes, "fp").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = star_components(links(classes, spec).unionByName(again)).select(F.col("node").alias("rep"), "component")
    named_classes = classes.join(found, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = marked.join(named_classes, "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
