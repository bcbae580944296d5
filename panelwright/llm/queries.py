"""The numbered queries over the sample tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import (
    fill_in_middle,
    mixing,
    near_dup,
    ngram_lm,
    packing,
    prefix_trie,
    quality_rules,
    rule_classifier,
    simhash,
    token_files,
    url_filter,
    vectors,
    warc,
)
from panelwright.llm.common import held, table
from panelwright.llm.oracles import ORACLES
from panelwright.session import scratch_path

URL_RULES = [
    url_filter.Rule("com/", "allow"),
    url_filter.Rule("example.com/en/", "block"),
    url_filter.Rule("www.example.com/en/", "allow"),
    url_filter.Rule("net/es/", "block"),
    url_filter.Rule("net/fr/", "block"),
]


#: Pieces as packing cuts them, a checksum instead of the ids.
DIGESTED = packing.PIECE_SCHEMA.replace("ids array<int>", "ids_crc32 long")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.with_crc(token_files.read(spark, path))


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vectors.nearest(rows, rows.where("vec_id % 20 = 0"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "mixed.size", "mixed.source_size", "mixed.target",
                        (F.col("mixed.size") * F.col("mixed.copies")).alias("taken"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = packing.PackSpec()
    cut = packing.pieces(table(spark, sf_dir, "documents"), spec, then=token_files.crc_for_ids, schema=DIGESTED)
    return packing.place(cut, spec).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
                                           "ids_crc32", "sequence_id", "offset")


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_lm.score(table(spark, sf_dir, "documents"), ~held(F.col("doc_id"), 7, 2))
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, archives = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    warc.write_monolithic(warc.with_revisits(table(spark, sf_dir, "pages")), raw)
    warc.normalise(spark, raw, archives).write.parquet(f"{archives}-index")
    read = warc.read_records(spark.read.schema(warc.INDEX_SCHEMA).parquet(f"{archives}-index"))
    revisit = F.col("record_type") == "revisit"
    return read.select(
        warc.page_number(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.when(revisit, F.col("payload_digest")).otherwise(warc.base32(F.sha1("payload"))).alias("payload_digest"),
        "record_type", warc.page_number(F.col("refers_to")).alias("refers_to"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held(F.col("doc_id"), 3, 1))
    model = rule_classifier.fit(docs, labels)
    return rule_classifier.score(docs, model).select(
        "doc_id", held(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_rules.STATS, "base_failed", "kept", "left_words")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    arranged = fill_in_middle.arrange(table(spark, sf_dir, "documents"))
    facts = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return fill_in_middle.restore(arranged, facts, texts=False)


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_token_files, op3_vector_search, op4_mixing, op5_packing, op6_maxent_lm, op7_near_dup, op8_warc, op9_quality_classifier,
                                   op10_quality_rules, op11_simhash, op12_prefix_trie, op13_fill_in_middle)}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
