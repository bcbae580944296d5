"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Trees are grown on labelled rows, every path from a root is a rule (a
conjunction of thresholds), a lasso logistic regression keeps a few of them, and
the kept rules are compiled into one Spark column expression.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import fresh, in_slices
from panelwright.session import materialize

STATISTICS = ("log_words", "mean_word", "upper_share", "digit_share", "symbol_share", "mark_share", "lone_share",
              "distinct_share", "again_share", "top_share", "capital_words", "words_per_line", "repeat_lines")


@dataclass
class FitSpec:
    """Parameters of the fit.

    ``sample_rows`` bounds the labelled rows that are used: all of them up to
    that number, beyond it those with the smallest hash of their id.
    """

    sample_rows: int = 20_000
    trees: int = 12
    depth: int = 3
    penalty: float = 0.002
    max_rules: int = 400
    seed: int = 11


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool  # above the threshold, else at or below it
    threshold: float

    def holds(self, stats: Column) -> Column:
        value = stats[self.statistic]
        return value > self.threshold if self.above else value <= self.threshold


@dataclass
class RuleModel:
    """score = logistic(intercept + sum of the weights of the rules that hold)."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            total = total + F.when(conjunction(conditions, stats), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def to_json(self) -> str:
        return json.dumps({"intercept": self.intercept, "rules": [[[asdict(c) for c in cs], w] for cs, w in self.rules]})

    @classmethod
    def from_json(cls, text: str) -> RuleModel:
        raw = json.loads(text)
        return cls(raw["intercept"], [(tuple(Condition(**c) for c in cs), w) for cs, w in raw["rules"]])


def conjunction(conditions: Sequence[Condition], stats: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.holds(stats)
    return out


def statistics_of(text: bytes) -> tuple[float, ...]:
    """The values of STATISTICS for one whole text; an empty one has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    raw = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    string = text.decode()
    letters = sum(map(len, words))
    upper = sum(map(str.isupper, string)) if not text.isascii() else int(raw[65:91].sum())
    counts = Counter(words)
    again = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.split()]
    return (
        float(np.log10(n)), letters / n, upper / letters, raw[48:58].sum() / letters,
        (raw[list(b"#*$%&|<>@^~=+_\\{}[]")].sum()) / letters, (raw[33] + raw[63]) / letters,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n, len(counts) / n, again / n,
        max(counts.values()) / n, sum(map(bytes.isupper, words)) / n, n / len(lines), 1.0 - len(set(lines)) / len(lines),
    )


def with_statistics(docs: DataFrame, name: str = "stats") -> DataFrame:
    """``docs`` with a struct of the statistics of its ``text`` (null: empty)."""
    stats_type = "struct<" + ", ".join(f"{s}: double" for s in STATISTICS) + ">"
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` {stats_type}"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 500):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            table = np.array([statistics_of((t or "").encode()) for t in texts], dtype=np.float64).reshape(-1, len(STATISTICS))
            struct = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(STATISTICS))], names=list(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, name])

    return docs.mapInArrow(measure, out)


def tree_rules(model, names: Sequence[str]) -> list[tuple[Condition, ...]]:
    """Every path from the root of every tree, as conditions; equal paths once."""
    found: dict[tuple[Condition, ...], None] = {}

    def walk(node, path: dict) -> None:
        if path:
            found[tuple(Condition(*k, v) for k, v in sorted(path.items()))] = None
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, at = names[split.featureIndex()], float(split.threshold())
        low, high = path.get((name, False)), path.get((name, True))
        walk(node.leftChild(), path | {(name, False): at if low is None else min(low, at)})
        walk(node.rightChild(), path | {(name, True): at if high is None else max(high, at)})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def labelled_sample(labels: DataFrame, spec: FitSpec) -> DataFrame:
    """(doc_id, quality) of the labelled rows to learn from, at most ``sample_rows``.

    Null ids and labels other than 0 and 1 are left out; an id labelled both ways
    counts as 1 only if no row says 0.
    """
    rows = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return rows.orderBy(F.xxhash64(F.lit(spec.seed), "doc_id"), "doc_id").limit(spec.sample_rows)


def fit(docs: DataFrame, labels: DataFrame, spec: FitSpec | None = None) -> RuleModel:
    """Learn from the texts of ``docs`` whose doc_id ``labels`` (doc_id, quality) holds.

    The sample is bounded, so it is broadcast to the scan of the documents.  Where
    no labelled text or only one class is found, the model is that class's share.
    """
    spec = spec or FitSpec()
    sample = materialize(labelled_sample(labels, spec), "labelled")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = materialize(with_statistics(rows).select("quality", "stats.*").where("quality IS NOT NULL"), "train").coalesce(4)
    share = rows.agg(F.avg("quality").alias("p"), F.count("*").alias("n")).first()
    p = (share["p"] * share["n"] + 0.5) / (share["n"] + 1) if share["n"] else 0.5
    if not share["n"] or share["p"] in (0.0, 1.0):
        return RuleModel(float(np.log(p / (1 - p))), [])
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows).withColumn(
        "label", F.col("quality").cast("double")).withColumn(
        "weight", F.when(F.col("label") == 1, 0.5 / share["p"]).otherwise(0.5 / (1 - share["p"])))
    rows = rows.cache()
    forest = RandomForestClassifier(numTrees=spec.trees, maxDepth=spec.depth, seed=spec.seed, weightCol="weight",
                                    featureSubsetStrategy="onethird", subsamplingRate=0.8).fit(rows)
    rules = tree_rules(forest, STATISTICS)
    if len(rules) > spec.max_rules:
        raise ValueError(f"{len(rules)} rules, more than max_rules={spec.max_rules}: use fewer or shallower trees")
    if not rules:
        rows.unpersist()
        return RuleModel(float(np.log(p / (1 - p))), [])
    stats = {s: F.col(s) for s in STATISTICS}
    held = F.array(*[conjunction(r, stats).cast("double") for r in rules])
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=spec.penalty, weightCol="weight", featuresCol="held",
                               maxIter=40, standardization=False)
    fitted = lasso.fit(rows.select("label", "weight", array_to_vector(held).alias("held")))
    rows.unpersist()
    weights = fitted.coefficients.toArray()
    return RuleModel(float(fitted.intercept), [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w != 0.0])


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with columns score and predicted (renamed ``score_1``... where a table has them).

    Every row is scored by its whole text alone; null and empty texts get the
    score of all-zero statistics.  Repeated rows and nulls in other columns change
    nothing; an empty table stays empty.
    """
    stats, out, label = fresh(docs, "stats"), fresh(docs, "score"), fresh(docs, "predicted")
    rows = with_statistics(docs, stats)
    rows = rows.withColumn(out, model.score(F.col(stats))).drop(stats)
    return rows.withColumn(label, (F.col(out) >= 0.5).cast("int"))
