"""Near-duplicate groups: MinHash bands propose pairs, whole shingle sets confirm them, stars connect them.

A document is the set of its distinct 5-word shingles.  Equal sets are one class
from the start.  Classes that agree in a band of minima share a bucket.  A bucket
is never expanded into rows of pairs: each class is first compared with one
leader, which connects large groups.  Buckets that still hold several components
are compared in blocks inside tasks, which return links only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import fresh, in_slices
from panelwright.llm.graph import star_components
from panelwright.llm.tokens import slices
from panelwright.session import materialize

SHINGLE = 5


@dataclass
class DedupSpec:
    """Parameters.

    Pairs of at least ``similarity`` per cent are linked.  With 25 bands of 5
    minima a pair at 85 per cent shares no bucket once in two million times.
    Pairs whose signatures agree in less than ``signature_percent`` of all minima
    (more than 5 standard deviations below 85) are not read in full.  A block holds
    about ``block_rows`` sets and ``block_shingles`` shingles; a larger bucket
    becomes more blocks.
    """

    similarity: int = 85
    bands: int = 25
    rows: int = 5
    signature_percent: int = 67
    block_rows: int = 2048
    block_shingles: int = 2_000_000
    seed: int = 3

    @property
    def minima(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 64-bit shingles of all texts, number of each text's).

    A text of one to four words has one shingle, the sequence of its words; one
    without words has none.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = parts.flatten().dictionary_encode()
    values = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), np.uint64, len(values))
    real = np.fromiter((v != "" for v in values), bool, len(values))
    which = coded.indices.to_numpy(zero_copy_only=False) if len(coded) else np.zeros(0, np.int64)
    keep = real[which] if len(which) else np.zeros(0, bool)
    kept_before = np.append(0, np.cumsum(keep))
    offsets = kept_before[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
    words = hashes[which[keep]] if len(which) else np.zeros(0, np.uint64)
    n = max(0, len(words) - SHINGLE + 1)
    window = np.full(n, np.uint64(SHINGLE))
    for j in range(SHINGLE):
        window = mix(window + words[j:j + n])
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a >= SHINGLE:
            own = np.unique(window[a:b - SHINGLE + 1])
        elif b > a:
            own = np.array([b - a], dtype=np.uint64)
            for w in words[a:b]:
                own = mix(own + w)
        else:
            continue
        out.append(own)
        sizes[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def signatures(sets: np.ndarray, sizes: np.ndarray, spec: DedupSpec, block: int = 8192) -> np.ndarray:
    """Minima of (a x + b) mod 2^32 over each non-empty set, one row per set."""
    rng = np.random.default_rng(spec.seed)
    a = (rng.integers(0, 1 << 31, spec.minima, dtype=np.uint64).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
    b = rng.integers(0, 1 << 32, spec.minima, dtype=np.uint64).astype(np.uint32)
    x = (sets >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), spec.minima), dtype=np.uint32)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + block)))
        low, high = int(starts[i]), int(starts[j - 1] + sizes[j - 1])
        best = None
        for at in range(low, high, 1 << 16) if j == i + 1 else (low,):  # a very long set goes in pieces
            part = x[at:min(high, at + (1 << 16))] if j == i + 1 else x[low:high]
            values = part[None, :] * a[:, None] + b[:, None]
            least = np.minimum.reduceat(values, starts[i:j] - low if j > i + 1 else [0], axis=1)
            best = least if best is None else np.minimum(best, least)
        out[i:j] = best.T
        i = j
    return out


def band_keys(minima: np.ndarray, spec: DedupSpec) -> np.ndarray:
    """One 64-bit bucket name per band, the band's number mixed in."""
    parts = minima.reshape(len(minima), spec.bands, spec.rows).astype(np.uint64)
    keys = mix(np.broadcast_to(np.arange(1, spec.bands + 1, dtype=np.uint64), parts.shape[:2]))
    for r in range(spec.rows):
        keys = mix(keys + parts[:, :, r])
    return keys.view(np.int64)


SKETCH_SCHEMA = "doc_id long, n_shingles long, key_a long, key_b long, signature binary, bands array<long>"


def sketches(docs: DataFrame, spec: DedupSpec) -> DataFrame:
    """Size, identity, signature and buckets of the set of each row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1000):
            texts = batch.column("text")
            for a, b in slices(texts):
                sets, sizes = shingle_sets(texts.slice(a, b - a))
                some = sizes > 0
                starts = (np.cumsum(sizes) - sizes)[some]
                minima = signatures(sets, sizes[some], spec)
                keys, small = band_keys(minima, spec), (minima & np.uint32(0xFFFF)).astype("<u2")
                both = [np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)]
                for k, key in enumerate(both):
                    if len(starts):
                        key[some] = np.add.reduceat(mix(sets + np.uint64(k + 1)), starts).view(np.int64)
                at = np.cumsum(some) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(sizes), pa.array(both[0]), pa.array(both[1]),
                     pa.array([small[at[i]].tobytes() if some[i] else b"" for i in range(b - a)], pa.binary()),
                     pa.array([keys[at[i]] if some[i] else [] for i in range(b - a)], pa.list_(pa.int64()))],
                    names=[c.split()[0] for c in SKETCH_SCHEMA.split(", ")])

    return rows.mapInArrow(run, SKETCH_SCHEMA)


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, shingles): the whole sets of the documents that ``ids`` (rep) names, as sorted 8-byte numbers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(ids, "rep", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1000):
            texts = pc.fill_null(batch.column("text"), "")
            for a, b in slices(texts):
                sets, sizes = shingle_sets(texts.slice(a, b - a))
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").slice(a, b - a),
                     pa.array([sets[e - s:e].tobytes() for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary())],
                    names=["rep", "shingles"])

    return rows.mapInArrow(run, "rep long, shingles binary")


def confirmed(pairs: DataFrame, signature: DataFrame, sets: DataFrame, spec: DedupSpec) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar enough; signatures sort out the rest before.

    Sets travel with a pair only once its signatures agree.
    """
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 5000):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, spec.minima) for c in ("x", "y"))
            good = (x == y).sum(1) * 100 >= spec.signature_percent * spec.minima
            yield batch.filter(pa.array(good)).select(["a", "b"])

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 200):
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= spec.similarity * (len(x) + len(y) - both))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    def joined(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
        one = values.select(F.col("rep").alias("a"), F.col(name).alias("x"))
        two = values.select(F.col("rep").alias("b"), F.col(name).alias("y"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")

    likely = materialize(joined(pairs, signature, "signature").mapInArrow(near, "a long, b long"), "likely")
    return joined(likely, sets, "shingles").mapInArrow(full, "a long, b long")


def components(docs: DataFrame, spec: DedupSpec | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over links, kept marks it.
    Texts without words have no shingles and are linked with nothing, equal
    sets of any size are linked.  Rows that share a doc_id are one document with
    several texts.  A row without doc_id takes no part: its component_id is null
    and it is kept.  Other columns are ignored; an empty table gives no rows.
    Shingles are compared by 64-bit hashes.
    """
    spec = spec or DedupSpec()
    sketched = materialize(sketches(docs, spec), "sketches")
    identity = ["key_a", "key_b", "n_shingles"]
    light = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = materialize(light.groupBy(*identity).agg(F.min("doc_id").alias("rep")), "classes")
    reps = light.join(classes.withColumnRenamed("rep", "doc_id"), [*identity, "doc_id"], "left_semi")
    reps = materialize(reps.select(F.col("doc_id").alias("rep"), "n_shingles", "signature", "bands"), "reps")
    edges = linked(docs, reps, spec)
    same = light.select(*identity, "doc_id").join(classes, identity).where("doc_id <> rep")
    edges = edges.unionByName(same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = star_components(edges).select(F.col("node").alias("doc_id"), "component")
    out = sketched.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def linked(docs: DataFrame, reps: DataFrame, spec: DedupSpec) -> DataFrame:
    """Confirmed links (a, b) that connect all classes which confirmed links can connect.

    First each class is compared with the smallest class of its buckets, one pair
    per class.  Then every pair of a bucket that these links leave unconnected is
    compared, in blocks.
    """
    member = reps.select(F.explode("bands").alias("bucket"), "rep").distinct()
    shared = member.groupBy("bucket").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last")
    live = materialize(member.join(shared.select("bucket", "leader"), "bucket"), "buckets")
    active = live.select("rep").distinct()
    sets = materialize(full_sets(docs, active), "sets")
    marks = materialize(reps.join(active, "rep", "left_semi"), "marks")
    first = live.groupBy("rep").agg(F.min("leader").alias("leader")).where("leader < rep")
    first = confirmed(first.select(F.col("rep").alias("a"), F.col("leader").alias("b")), marks, sets, spec)
    first = materialize(first, "links")
    rest = blocks(live.select("bucket", "rep"), star_components(first), reps, spec)
    rest = in_blocks(rest.join(marks.select("rep", "signature", "bands"), "rep"), "near", spec)
    rest = in_blocks(materialize(rest, "near").join(marks.select("rep", "signature", "bands"), "rep").join(sets, "rep"), "links", spec)
    return first.unionByName(materialize(rest, "links"))


BLOCK = ("bucket", "low", "high")


def blocks(live: DataFrame, component: DataFrame, reps: DataFrame, spec: DedupSpec) -> DataFrame:
    """(bucket, low, high, block, rep, component) for the members of buckets with several components.

    A bucket's members are dealt into blocks by hash, and every two blocks (and
    each with itself) are one group.
    """
    known = live.join(component.withColumnRenamed("node", "rep"), "rep", "left").join(
        reps.groupBy("rep").agg(F.max("n_shingles").alias("n")), "rep")
    known = known.select("bucket", "rep", "n", F.coalesce("component", "rep").alias("component"))
    known = materialize(known, "members")
    size = F.greatest(F.count("*") / spec.block_rows, F.sum("n") / spec.block_shingles)
    open_ = known.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                        F.ceil(size).cast("int").alias("blocks")).where("x < y")
    rows = known.join(open_.select("bucket", "blocks"), "bucket")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                       "block", "rep", "component")


def in_blocks(rows: DataFrame, want: str, spec: DedupSpec) -> DataFrame:
    """Compare the members of each group (bucket, low, high).

    ``near`` returns the members that have a partner of another component with an
    agreeing signature, ``links`` the confirmed links of these.  A pair is
    compared in the first of its common buckets only, and not once it is
    connected within its group.  Groups lie side by side in sorted partitions and
    are read one at a time.
    """
    near_schema = "bucket long, low int, high int, block int, rep long, component long"
    schema = near_schema if want == "near" else "a long, b long"
    names = [c.split()[0] for c in schema.split(", ")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, *BLOCK).sortWithinPartitions(*BLOCK)

    def answer(group: pa.Table) -> pa.RecordBatch | None:
        if group.num_rows < 2:
            return None
        if want == "near":
            hit = near_members(group, spec)
            return pa.RecordBatch.from_arrays([group.column(c).combine_chunks().filter(pa.array(hit)) for c in names], names=names)
        found = group_links(group, spec)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches):
            out = answer(group)
            if out is not None and out.num_rows:
                yield out

    return rows.mapInArrow(run, schema)


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each key of a sorted partition, holding one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in BLOCK])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(keys[:, a].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def partners(group: pa.Table, spec: DedupSpec) -> Iterator[tuple[int, np.ndarray]]:
    """For each member in turn: the members to compare it with whose signatures agree.

    Pairs lie across the two blocks of the group, or in order within its one
    block; they differ in component and share no earlier band.
    """
    block, rep, component = (group.column(c).to_numpy() for c in ("block", "rep", "component"))
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    marks = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u2").reshape(-1, spec.minima)
    bands = np.array(group.column("bands").to_pylist(), dtype=np.int64)
    own = int(np.argmax(bands[0] == group.column("bucket")[0].as_py()))
    left = np.flatnonzero(block == low)
    right = np.flatnonzero(block == high)
    for i in left.tolist():
        other = right[rep[right] > rep[i]] if low == high else right
        other = other[component[other] != component[i]]
        other = other[~(bands[other, :own] == bands[i, :own]).any(1)]
        if len(other):
            other = other[(marks[other] == marks[i]).sum(1) * 100 >= spec.signature_percent * spec.minima]
        if len(other):
            yield i, other


def near_members(group: pa.Table, spec: DedupSpec) -> np.ndarray:
    hit = np.zeros(group.num_rows, dtype=bool)
    for i, other in partners(group, spec):
        hit[i] = True
        hit[other] = True
    return hit


def group_links(group: pa.Table, spec: DedupSpec) -> np.ndarray:
    """Confirmed links of a group, without those between members that others already connect."""
    rep = group.column("rep").to_numpy()
    sizes = np.array([len(x) // 8 for x in group.column("shingles").to_pylist()], dtype=np.int64)
    flat = np.frombuffer(b"".join(group.column("shingles").to_pylist()), np.uint64)
    values, flat = np.unique(flat, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    marked = np.zeros(len(values), dtype=bool)
    label = np.arange(len(rep))
    found = []
    for i, other in partners(group, spec):
        other = other[label[other] != label[i]]
        if not len(other):
            continue
        own = flat[starts[i]:starts[i] + sizes[i]]
        marked[own] = True
        size = sizes[other]
        both = np.add.reduceat(marked[flat[np.repeat(starts[other] - np.cumsum(size) + size, size) + np.arange(size.sum())]].astype(np.int64),
                               np.cumsum(size) - size)
        marked[own] = False
        for j in other[100 * both >= spec.similarity * (sizes[i] + size - both)].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                found.append((rep[i], rep[j]))
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def keep_one(docs: DataFrame, spec: DedupSpec | None = None) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id, all columns kept.

    Rows that repeat a kept doc_id go too; rows without a doc_id stay.
    """
    one, nth = fresh(docs, "kept_id"), fresh(docs, "nth")
    kept = components(docs, spec).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(one)).distinct()
    named = docs.where("doc_id IS NOT NULL")
    rows = named.join(kept, named["doc_id"].cast("long") == kept[one]).drop(one)
    order = Window.partitionBy("doc_id").orderBy("text")
    rows = rows.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(nth)
    return rows.unionByName(docs.where("doc_id IS NULL"))
