"""From raw documents to packed sequences: the stages in order, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet to the shared folder and hands what is read back to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import mixing, near_dup, packing, quality_rules, rule_classifier, token_files
from panelwright.llm.common import fresh, held, small_batches, table
from panelwright.session import materialize


#: Pieces as packing cuts them, a checksum instead of the ids.
DIGESTED = packing.PIECE_SCHEMA.replace("ids array<int>", "ids_crc32 long")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the learning part of ``labels``, does not reject."""
    labels = table(spark, sf_dir, "labels").where(~held(F.col("doc_id"), 3, 1))
    model = rule_classifier.fit(docs, labels)
    predicted = fresh(docs, "predicted")
    return rule_classifier.score(docs, model).where(F.col(predicted) == 1).select(*docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their boilerplate lines."""
    small_batches(spark)
    return quality_rules.strip_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return near_dup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixing.emit(mixing.mix(docs), fresh(docs, "mixed"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a sequence and a checksum of their ids."""
    small_batches(spark)
    spec = packing.PackSpec()
    cut = packing.pieces(docs, spec, then=token_files.crc_for_ids, schema=DIGESTED)
    return packing.place(cut, spec).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
                                           "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]
#: SQL has no tokenizer and no trees; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
