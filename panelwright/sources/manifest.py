"""File manifests: content hash, size and time of data files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.sources.files import path_exists

CHUNK = 8 << 20
MANIFEST_SCHEMA = ("path string, hash string, size_bytes bigint, last_modified timestamp, "
                   "source string, description string")


def open_file(path: str):
    """An input stream on a file as Spark names it, through pyarrow's file systems."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/") if found else path)
    authority, _, inner = rest.lstrip("/").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system.open_input_stream(f"{base.rstrip('/')}/{inner}")


def hash_of(path: str) -> str:
    digest = hashlib.sha256()
    with open_file(path) as stream:
        while chunk := stream.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def build_manifest(spark: SparkSession, paths: list[str], source: str | None = None,
                   description: str | None = None) -> DataFrame:
    """SHA-256, size, modification time of every file below ``paths``; absent paths are skipped.

    Spark's binary source lists the files, without their content, and packs them
    into tasks by size.  A task reads its files in chunks, so a file may be of any
    size; it must be on a file system that pyarrow reaches too (local, HDFS, S3, GCS).
    Spark's file sources pass over files without content.
    """
    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pa.array([hash_of(p) for p in batch.column("path").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, hashes], names=[*batch.schema.names, "hash"])

    hashed = files.select("path", "length", "modificationTime").mapInArrow(
        run, "path string, length bigint, modificationTime timestamp, hash string")
    return hashed.select(
        "path", "hash", F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
        F.lit(source).cast("string").alias("source"),
        F.lit(description).cast("string").alias("description"),
    )


def verify_manifest(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Status of each stored file: ``ok``, ``changed`` or ``missing``; valid only when ok."""
    now = current.select("path", F.col("hash").alias("current_hash"))
    status = (F.when(F.col("current_hash").isNull(), "missing")
              .when(F.col("current_hash") == F.col("hash"), "ok").otherwise("changed"))
    return stored.join(now, "path", "left").select(
        "path", "hash", "current_hash", status.alias("status"), (status == "ok").alias("is_valid"))


def save_manifest(manifest: DataFrame, path: str) -> None:
    (manifest.withColumn("saved_at", F.current_timestamp())
     .write.mode("overwrite").parquet(path))


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no manifest at {path}")
    return spark.read.schema(MANIFEST_SCHEMA + ", saved_at timestamp").parquet(path)


def stored_hash(manifest: DataFrame, path: str) -> str | None:
    row = manifest.filter(F.col("path") == path).select("hash").first()
    return row["hash"] if row else None
