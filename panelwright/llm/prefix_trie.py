"""The trie of conversation prefixes: what conversations share, with counts, leaves and savings per node.

A prefix is known by two 64-bit digests, running sums of scrambled (turn, depth)
numbers.  A count-min sketch over all digests screens them: an estimate of one
proves that a prefix belongs to one conversation, and so do all that extend it.
Those tails are answered where they are; only prefixes that may be shared, and the
first proven single one of each conversation, are shuffled and grouped exactly.
Running numbers along conversations are sums over sorted ranges, carried from range
to range, so a conversation of any length is spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.near_dup import mix
from panelwright.session import materialize

NODE = ("depth", "a", "b")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: What :func:`rebuilt` takes over from another conversation at most: one turn less than these.
FAMILY, TAKEN = 5, 9


@dataclass(frozen=True)
class TrieSpec:
    """Size of the screen: ``rows`` hash rows of about ``cells_per_prefix`` cells for every prefix.

    ``most_cells`` (a power of two) bounds a row, and so the broadcast: rows *
    most_cells / 8 bytes, 24 MiB as it stands.  Beyond it more prefixes pass the
    screen and are grouped exactly: more is shuffled, results stay the same.
    ``piece_bytes`` is the size in which partial sketches and lists of ids travel.
    """

    rows: int = 3
    cells_per_prefix: int = 4
    least_cells: int = 1 << 16
    most_cells: int = 1 << 26
    piece_bytes: int = 1 << 16
    fan_in: int = 32

    def cells(self, prefixes: int) -> int:
        wanted = max(1, self.cells_per_prefix * prefixes)
        return min(self.most_cells, max(self.least_cells, 1 << (wanted - 1).bit_length()))


def tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


# running numbers over sorted ranges


def carried(rows: DataFrame, key: str, order: str, sums: list[str]) -> dict[int, tuple[int, tuple[int, ...]]]:
    """For each range (``pid``): the key that goes on from the range before, and its sums there.

    ``rows`` is sorted by (key, order) within ascending ranges, with running
    ``sums`` that start afresh in each.  One row per range comes to the driver.
    """
    last = rows.groupBy("pid").agg(F.max(F.struct(key, order, *sums)).alias("last")).collect()
    out, going = {}, None
    for pid, end in sorted((r["pid"], r["last"]) for r in last):
        total = [end[s] for s in sums]
        if going:
            out[pid] = going
            if going[0] == end[key]:
                total = [x + y for x, y in zip(total, going[1], strict=True)]
        going = (end[key], tuple(total))
    return out


def of_range(carry: dict, pid: int, keys: np.ndarray, k: int) -> np.ndarray:
    """What the k-th sum of each row takes over, as an unsigned number."""
    key, sums = carry.get(pid, (None, ()))
    out = np.zeros(len(keys), np.uint64)
    if sums:
        out[keys == key] = np.uint64(sums[k] % 2**64)
    return out


def running(values: np.ndarray, keys: np.ndarray, key: int | None, before: np.ndarray) -> np.ndarray:
    """Running sums (by column) of rows sorted by key; ``before`` holds those of ``key`` so far."""
    total = np.cumsum(values, axis=0, dtype=values.dtype)
    opens = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    base = np.repeat(total[opens] - values[opens], np.diff(opens, append=len(keys)), axis=0)
    total -= base
    if key is not None:
        total[keys == key] += before
    return total


# conversations


def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, nbytes): the turns of each conversation numbered from 1.

    Order: turn, null first, then the MD5 that stands for role and text.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.md5(whole)).alias("digest"),
        F.octet_length(text).cast("long").alias("nbytes"), F.monotonically_increasing_id().alias("nth"))
    order = ["conv_id", "turn", "digest", "nth"]  # nth only lets equal rows fall into several ranges
    rows = rows.repartitionByRange(tasks(rows), *order).sortWithinPartitions(*order)
    schema = "pid int, conv_id long, place long, digest binary, nbytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, key, before = TaskContext.get().partitionId(), None, np.zeros(1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("conv_id").to_numpy()
            place = running(np.ones((len(keys), 1), np.int64), keys, key, before)
            key, before = int(keys[-1]), place[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), pid, np.int32)), batch.column("conv_id"), pa.array(place[:, 0]),
                                              batch.column("digest"), batch.column("nbytes")], names=columns(schema))

    local = materialize(rows.mapInArrow(run, schema), "turns")
    carry = carried(local, "conv_id", "place", ["place"])
    more = local.sparkSession.createDataFrame([(p, k, s[0]) for p, (k, s) in carry.items()], "pid int, conv_id long, more long")
    rows = local.join(F.broadcast(more), ["pid", "conv_id"], "left")  # a row per range at most
    return rows.select("conv_id", (F.col("place") + F.coalesce("more", F.lit(0))).alias("pos"), "digest", "nbytes")


def own_start(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % TAKEN


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, length, digest, nbytes) of the rebuilt conversations' turns, and (conv_id, length) of all.

    Conversation c has the first h turns of c - c % 5, then its own behind its
    first h; h is crc32(c) % 9.
    """
    counts = materialize(turns.groupBy("conv_id").agg(F.max("pos").alias("n")), "counts")
    own = counts.select("conv_id", "n", own_start(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    base = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    own = own.join(base, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    own = own.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = materialize(own.select("conv_id", "base", "h", "k", "length"), "conversations")
    tail = turns.join(own.where("length > k"), "conv_id").where("pos > h")
    tail = tail.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "length", "digest", "nbytes")
    head = turns.where(F.col("pos") < TAKEN).withColumnRenamed("conv_id", "base")
    head = head.join(own.where("k > 0"), "base").where("pos <= k")
    head = head.select("conv_id", F.col("pos").alias("depth"), "length", "digest", "nbytes")
    return tail.unionByName(head), own.select("conv_id", "length")


PREFIX = "pid int, conv_id long, depth long, length long, nbytes long, a long, b long, pa long, pb long"


def prefixes(rows: DataFrame) -> DataFrame:
    """PREFIX for every turn: digests (a, b) of the prefix it ends and (pa, pb) of the one before, within its range."""
    rows = rows.repartitionByRange(tasks(rows), "conv_id", "depth").sortWithinPartitions("conv_id", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, key, before = TaskContext.get().partitionId(), None, np.zeros(2, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("conv_id").to_numpy()
            turn = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8").reshape(-1, 2)
            depth = batch.column("depth").to_numpy().astype(np.uint64)
            term = mix(turn + mix(depth)[:, None])
            total = running(term, keys, key, before)
            key, before = int(keys[-1]), total[-1]
            digests = [x.view(np.int64) for x in (*np.ascontiguousarray(total.T), *np.ascontiguousarray((total - term).T))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), pid, np.int32)), *[batch.column(c) for c in columns(PREFIX)[1:5]],
                                              *map(pa.array, digests)], names=columns(PREFIX))

    return materialize(rows.mapInArrow(run, PREFIX), "prefixes")


def whole_digests(batch: pa.RecordBatch, carry: dict) -> list[np.ndarray]:
    """a, b, pa, pb with what their range takes over."""
    keys, pids = batch.column("conv_id").to_numpy(), batch.column("pid").to_numpy()
    out = [batch.column(c).to_numpy().view(np.uint64).copy() for c in ("a", "b", "pa", "pb")]
    for pid in np.unique(pids).tolist():
        here = pids == pid
        for k, values in enumerate(out):
            values[here] += of_range(carry, pid, keys[here], k % 2)
    return out


# the screen


def cell_of(a: np.ndarray, b: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(a + b * np.uint64(2 * row + 1)) & np.uint64(cells - 1)


def count_in(once: np.ndarray, more: np.ndarray, cell: np.ndarray) -> None:
    """Count cells into bit planes: those met, and those met again."""
    cell, times = np.unique(cell, return_counts=True)
    byte, bit = (cell >> np.uint64(3)).astype(np.int64), np.uint8(1) << (cell & np.uint64(7)).astype(np.uint8)
    again = (times > 1) | ((once[byte] & bit) != 0)
    np.bitwise_or.at(more, byte[again], bit[again])
    np.bitwise_or.at(once, byte, bit)


SKETCH = "piece int, task int, once binary, more binary"


def screen(rows: DataFrame, carry: dict, spec: TrieSpec) -> np.ndarray:
    """A count-min sketch of all prefixes, cut off at two: per hash row, the bits of the cells counted more than once.

    Tasks count into bit planes of their own and send the pieces that are not
    empty; pieces are added up in rounds of a bounded number each.
    """
    cells = spec.cells(rows.count())
    size = cells // 8
    piece = min(size, 1 << (spec.piece_bytes.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = (np.zeros((spec.rows, size), np.uint8) for _ in range(2))
        for batch in batches:
            a, b, _, _ = whole_digests(batch, carry)
            for r in range(spec.rows):
                count_in(once[r], more[r], cell_of(a, b, r, cells))
        once, more = once.reshape(-1, piece), more.reshape(-1, piece)
        some = np.flatnonzero(once.any(1))
        pid = TaskContext.get().partitionId()
        for i in some.tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pid], pa.int32()), pa.array([once[i].tobytes()], pa.binary()),
                                              pa.array([more[i].tobytes()], pa.binary())], names=columns(SKETCH))

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        once, more = (np.zeros(piece, np.uint8) for _ in range(2))
        for x, y in zip(parts.column("once").to_pylist(), parts.column("more").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            more |= y | (once & x)
            once |= x
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([once.tobytes()], pa.binary()),
                         pa.array([more.tobytes()], pa.binary())], names=columns(SKETCH))

    counted = materialize(rows.mapInArrow(count, SKETCH), "sketch")
    left = (counted.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        left = -(-left // spec.fan_in)
        grouped = counted.withColumn("task", F.floor(F.col("task") / spec.fan_in).cast("int")).groupBy("piece", "task")
        counted = materialize(grouped.applyInArrow(add, SKETCH), "sketch")
        if left <= 1:
            break
    out = np.zeros((spec.rows * size // piece, piece), np.uint8)
    for r in counted.select("piece", "more").collect():
        out[r["piece"]] = np.frombuffer(r["more"], np.uint8)
    return out.reshape(spec.rows, size)


MAYBE, FIRST, TAIL = 0, 1, 2
SCREENED = "conv_id long, depth long, length long, nbytes long, a long, b long, pa long, pb long, kind int"


def screened(rows: DataFrame, carry: dict, more: Broadcast, spec: TrieSpec) -> DataFrame:
    """SCREENED: every prefix as one that may be shared, the first proven single one of a run, or the tail behind it.

    Where a range starts within a conversation, its past isn't known; a single
    prefix counts as the first there, which costs a row and changes nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, pa_, pb = whole_digests(batch, carry)
            shared = np.ones(len(a), bool)
            for r, plane in enumerate(more.value):
                cell = cell_of(a, b, r, 8 * len(plane))
                shared &= (plane[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
            conv, depth = batch.column("conv_id").to_numpy(), batch.column("depth").to_numpy()
            opens = np.append((conv[0], depth[0] - 1) != last[:2], (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1] + 1))
            singles = np.append(0, np.cumsum(~shared))
            start = np.maximum.accumulate(np.where(opens, np.arange(len(conv)), 0))
            before = singles[:-1] > singles[start]
            if last[2] and not opens[0]:
                before[start == 0] = True
            alone = before | ~shared
            last = (conv[-1], depth[-1], bool(alone[-1]))
            kind = np.where(before, TAIL, np.where(alone, FIRST, MAYBE)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns(SCREENED)[:4]],
                                              *[pa.array(x.view(np.int64)) for x in (a, b, pa_, pb)], pa.array(kind)], names=columns(SCREENED))

    return materialize(rows.mapInArrow(run, SCREENED), "screened")


# exact groups


def ends_digests(ends: DataFrame, spec: TrieSpec) -> DataFrame:
    """(depth, a, b, ends_sha256): the hash over the ascending conv_ids that end at each node, comma-joined.

    Ids are sorted by ranges; a list inside a range is hashed there.  One that
    crosses ranges, or is long, goes on as pieces of text, which one task streams
    through the hash: it is sequential, but needs no list in memory.
    """
    rows = ends.select(*NODE, "conv_id")
    rows = rows.repartitionByRange(tasks(rows), *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    schema = "depth long, a long, b long, pid int, nth long, piece string, sha string"

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, nth = TaskContext.get().partitionId(), 0
        key, held, size, whole, sent = None, [], 0, False, False  # whole: the list began inside this range

        def row(piece: str | None, sha: str | None) -> tuple:
            return (*key, pid, nth, piece, sha)

        for batch in batches:
            out = []
            nodes = np.stack([batch.column(c).to_numpy() for c in NODE])
            ids = batch.column("conv_id").to_pylist()
            cuts = [0, *(np.flatnonzero((nodes[:, 1:] != nodes[:, :-1]).any(0)) + 1).tolist(), len(ids)] if ids else []
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                own = tuple(nodes[:, x].tolist())
                if own != key:
                    if key is not None:
                        text = ",".join(held)
                        out.append(row(None, hashlib.sha256(text.encode()).hexdigest()) if whole and not sent else row(text, None))
                    whole, sent, held, size, key, nth = key is not None, False, [], 0, own, nth + 1
                held.append(",".join(map(str, ids[x:y])))
                size += len(held[-1])
                if size >= spec.piece_bytes:
                    out.append(row(",".join(held), None))
                    held, size, sent, nth = [], 0, True, nth + 1
            yield pa.RecordBatch.from_pylist([dict(zip(columns(schema), r, strict=True)) for r in out], schema=arrow)
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(columns(schema), row(",".join(held), None), strict=True))], schema=arrow)

    arrow = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t]) for c, t in (x.split() for x in schema.split(", "))])
    listed = materialize(rows.mapInArrow(lists, schema), "ends")
    done = listed.where("sha IS NOT NULL").select(*NODE, F.col("sha").alias("ends_sha256"))
    pieces = listed.where("sha IS NULL AND piece <> ''")
    pieces = pieces.repartition(tasks(rows), *NODE).sortWithinPartitions(*NODE, "pid", "nth")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        names = [*NODE, "ends_sha256"]

        def answer() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, (*key, digest.hexdigest()), strict=True))])

        for batch in batches:
            for *own, piece in zip(*[batch.column(c).to_pylist() for c in (*NODE, "piece")], strict=True):
                if own != key:
                    if key is not None:
                        yield answer()
                    key, digest = own, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
        if key is not None:
            yield answer()

    return done.unionByName(pieces.mapInArrow(stream, "depth long, a long, b long, ends_sha256 string"))


def subtree_sums(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, a, b, leaves, saved) of every node: sums over its subtree.

    What a node adds is put down at its smallest member.  Sums along each
    conversation from its end up to a prefix, added over the members of the
    prefix, are the sums of the subtree.
    """
    adds = nodes.where("leaf > 0 OR own_saved > 0").select(
        "conv_id", (-F.col("depth")).alias("up"), F.lit(0).alias("member"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"),
        F.col("leaf").cast("long").alias("leaves"), F.col("own_saved").alias("saved"))
    rows = members.select("conv_id", (-F.col("depth")).alias("up"), F.lit(1).alias("member"), "a", "b",
                          F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")).unionByName(adds)
    rows = rows.repartitionByRange(tasks(rows), "conv_id", "up", "member").sortWithinPartitions("conv_id", "up", "member")
    schema = "pid int, conv_id long, up long, member int, a long, b long, leaves long, saved long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, key, before = TaskContext.get().partitionId(), None, np.zeros(2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("conv_id").to_numpy()
            total = running(np.stack([batch.column(c).to_numpy() for c in ("leaves", "saved")], axis=1), keys, key, before)
            key, before = int(keys[-1]), total[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), pid, np.int32)), *[batch.column(c) for c in columns(schema)[1:6]],
                                              pa.array(np.ascontiguousarray(total[:, 0])), pa.array(np.ascontiguousarray(total[:, 1]))], names=columns(schema))

    local = materialize(rows.mapInArrow(run, schema), "sums")
    carry = carried(local.withColumn("place", F.struct("up", "member")), "conv_id", "place", ["leaves", "saved"])
    more = local.sparkSession.createDataFrame([(p, k, *s) for p, (k, s) in carry.items()], "pid int, conv_id long, more_leaves long, more_saved long")
    whole = local.where("member = 1").join(F.broadcast(more), ["pid", "conv_id"], "left")  # a row per range at most
    zero = F.lit(0)
    return whole.groupBy((-F.col("up")).alias("depth"), "a", "b").agg(
        F.sum(F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"), F.sum(F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"))


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes_of(rows: DataFrame, conversations: DataFrame, spec: TrieSpec) -> DataFrame:
    """RESULT for every prefix of the conversations in ``rows`` (conv_id, depth, length, digest, nbytes).

    ``conversations`` (conv_id, length) names all, those without turns too.
    """
    spark = rows.sparkSession
    every = prefixes(rows)
    carry = carried(every, "conv_id", "depth", ["a", "b"])
    more = spark.sparkContext.broadcast(screen(every, carry, spec))  # bounded by the spec
    seen = screened(every, carry, more, spec)
    zero = F.lit(0).cast("long")
    root = conversations.select("conv_id", zero.alias("depth"), "length", *[zero.alias(c) for c in ("nbytes", "a", "b", "pa", "pb")],
                                F.lit(MAYBE).alias("kind"))
    members = seen.where(F.col("kind") != TAIL).unionByName(root)
    tail = F.max(((F.col("kind") == FIRST) & (F.col("depth") < F.col("length"))).cast("long"))
    groups = materialize(members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("nbytes").alias("nbytes"), F.max("pa").alias("pa"),
        F.max("pb").alias("pb"), tail.alias("tail")), "groups")
    up = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")]
    below = groups.where("depth > 0").groupBy(*up).agg(F.count("*").alias("below"))
    above = groups.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                          F.col("conv_id").alias("above_id"), F.col("n_convs").alias("above_convs"))
    nodes = groups.join(above, ["depth", "pa", "pb"], "left").join(below, [*NODE], "left")
    single = F.col("n_convs") == 1
    leaf = F.when(single, F.coalesce(F.col("above_convs") > 1, F.lit(False))).otherwise(F.col("below").isNull())
    nodes = nodes.select(
        *NODE, "conv_id", "n_convs", F.when(F.col("depth") > 0, F.coalesce("above_id", "conv_id")).alias("parent_conv_id"),
        F.greatest(F.coalesce("below", zero), "tail").alias("n_children"), leaf.cast("int").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("nbytes")).alias("own_saved"))
    nodes = materialize(nodes, "nodes")
    ends = ends_digests(members.where(F.col("depth") == F.col("length")), spec)
    found = nodes.join(subtree_sums(members, nodes), [*NODE], "left").join(ends, [*NODE], "left")
    found = found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.when(single, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"),
        F.when(single, zero).otherwise(F.col("saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    one = F.lit(1).cast("long")
    alone = seen.where(F.col("kind") == TAIL).select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        (F.col("depth") < F.col("length")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"))
    return found.select(*RESULT).unionByName(alone.select(*RESULT))


def trie(conversations: DataFrame, spec: TrieSpec = TrieSpec()) -> DataFrame:
    """RESULT for every distinct prefix of the rebuilt conversations in (conv_id, turn, role, text).

    Turns stand in order of turn, null first, those of one turn number in order of
    an MD5 of role and text; repeated rows are turns of their own.  Null role or
    text is empty.  Rows without conv_id belong to no conversation.  The root is the
    prefix without turns, its parent is null; an empty table has no nodes.  Other
    columns are ignored.  Prefixes are told apart by 128 bits of digests.
    """
    turns, every = rebuilt(materialize(ordered_turns(conversations), "ordered"))
    return nodes_of(turns, every, spec)


def plain_trie(conversations: DataFrame, spec: TrieSpec = TrieSpec()) -> DataFrame:
    """The same over the conversations as they stand, without rebuilding them."""
    turns = materialize(ordered_turns(conversations), "ordered")
    counts = materialize(turns.groupBy("conv_id").agg(F.max("pos").alias("length")), "counts")
    rows = turns.join(counts, "conv_id").select("conv_id", F.col("pos").alias("depth"), "length", "digest", "nbytes")
    return nodes_of(rows, counts, spec)
