"""Token ids in ORC files: run-length encoded, ordered by document id, pruned by row index and Bloom filter."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm.common import in_slices
from panelwright.llm.tokens import encoder, crc_of_lists, id_lists, slices

FILE_SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, ids array<int>"


def encode(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Rows of FILE_SCHEMA in ascending doc_id order over ascending partitions.

    doc_id null comes first, repeated ids stand together in the order of a hash of
    their texts.  A null text is empty and has the end id alone.  shard is the
    partition, shard_start the ids of all documents before it there.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shard, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in in_slices(batches, 2000):
            texts = batch.column("text")
            for a, b in slices(texts):
                ids, sizes = known.encode(texts.slice(a, b - a), end_id)
                before = start + sizes.cumsum() - sizes
                start += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([shard] * (b - a), pa.int32()),
                     pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), id_lists(ids, sizes)],
                    names=["doc_id", "shard", "shard_start", "n_tokens", "ids"])

    return rows.mapInArrow(run, FILE_SCHEMA)


def write(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
          stripe_bytes: int = 16 << 20, index_rows: int = 1000) -> None:
    """Encode ``docs`` (doc_id, text) and write one ORC file per range of ids.

    Integers are run-length encoded by the format.  Each stripe is a unit of
    parallel reading; a row index entry per ``index_rows`` rows and a Bloom filter
    on doc_id let a reader skip what it doesn't ask for.
    """
    (encode(docs, tokenizer, end_id).write
     .option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", index_rows)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
     .option("compression", "zstd").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; start counts the ids of all before it.

    The shards' totals come from a scan of two narrow columns; their number is the
    number of partitions that wrote the files.
    """
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    totals = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(totals), "shard").select(
        "doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """The rows of some documents; the filter goes to the reader, which prunes by its metadata."""
    return spark.read.schema(FILE_SCHEMA).orc(path).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "n_tokens", "ids")


def crc_for_ids(batch: pa.RecordBatch, name: str = "ids_crc32") -> pa.RecordBatch:
    """The batch with a crc32 of its column ids in that column's place, last."""
    keep = [c for c in batch.schema.names if c != "ids"]
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], crc_of_lists(batch.column("ids"))], names=[*keep, name])


def with_crc(rows: DataFrame, name: str = "ids_crc32") -> DataFrame:
    """``rows`` with a crc32 of the column ids in its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1000):
            yield crc_for_ids(batch, name)

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns if c != "ids")
    return rows.mapInArrow(run, f"{schema}, `{name}` long")
