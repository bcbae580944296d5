"""The pipeline's stages, each on all that its predecessor kept."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_cases import awkward_docs, no_docs  # noqa: E402
from test_llm_text_ops import check_packing, groups_by_hand, rules_by_hand, shares_by_hand, words  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
import corpus_pipeline  # noqa: E402
from panelwright.llm.quality_rules import RuleSpec  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages_match_brute_force(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append(docs.collect())
        assert i == 4 or docs.columns == names
    classified, ruled, unique, mixed, packed = seen
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    every = [r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    kept = {r["doc_id"] for r in classified}
    assert sum(labels[d] == 1 for d in every if d in labels and d in kept) >= 0.97 * sum(labels.get(d) == 1 for d in every)
    assert sum(labels[d] == 0 for d in every if d in labels and d in kept) <= 0.2 * sum(labels.get(d) == 0 for d in every)
    hand = rules_by_hand([(r["source"], r["text"]) for r in classified], RuleSpec())
    assert {r["doc_id"]: r["text"] for r in ruled} == {r["doc_id"]: t for r, (_, k, t) in zip(classified, hand, strict=True) if k}
    component, _ = groups_by_hand([(r["doc_id"], r["text"]) for r in ruled])
    assert {r["doc_id"] for r in unique} == {d for d, c in component.items() if c == d}
    sizes, largest = Counter(), Counter()
    for r in unique:
        sizes[r["source"]] += len(words(r["text"]))
        largest[r["source"]] = max(largest[r["source"]], len(words(r["text"])))
    taken = Counter()
    for r in mixed:
        taken[r["source"]] += len(words(r["text"]))
    assert all(abs(taken[s] - t) <= largest[s] + 1e-6 for s, t in shares_by_hand(sizes).items())
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    bins, tokens = check_packing(packed, [(r["doc_id"], r["text"]) for r in mixed])
    assert bins <= 1.01 * tokens / 1024 + 2


@pytest.mark.parametrize("make", [awkward_docs, no_docs])
def test_awkward_rows_pass_every_stage(spark, make):
    docs = make(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.schema.simpleString() == docs.schema.simpleString()
            docs = spark.createDataFrame(out.collect(), docs.schema)
        else:
            assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            out.collect()


def test_registered():
    names = entry_points.queries()
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {x if x == "pipeline" else x[:x.index("_") + 1] for x in names if x.startswith(("op", "pipe"))}
    assert "pipeline" not in entry_points.oracle_sql()
