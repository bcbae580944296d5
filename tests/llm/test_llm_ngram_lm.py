"""The n-gram language model against dictionaries of counts on small tables, and on held-out rows."""

import math
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_cases import LOWER, awkward_docs, no_docs, prose, words  # noqa: E402

from panelwright.llm import ngram_lm as lm  # noqa: E402

END = "\n"
SMALL = lm.NgramSpec(classes=256, groups=4, frequent=12, sample_rows=10_000, hot_share=0.09, block_chars=3000, part_chars=4000)


def code(word):
    return xxhash.xxh3_64_intdigest(word)


def tokens_of(text):
    return [*words((text or "").translate(LOWER)), END]


def softmax_at_optimum(counts, base, discount):
    """Probabilities of a history: where gradients vanish a seen item has its discounted share, others share the rest by the bias, if there are any."""
    total = sum(counts.values())
    if not total:
        return dict(base)
    left = sum(base[i] for i in base if not counts.get(i))
    share = {i: (counts[i] - discount) / total for i in base if counts.get(i)}
    if len(share) == len(base):
        return {i: p / sum(share.values()) for i, p in share.items()}
    rest = 1 - sum(share.values())
    return {i: share[i] if i in share else rest * base[i] / left for i in base}


def scores_by_hand(rows, spec, frequent, hot):
    """(doc_id, learned) -> score, with dictionaries; rows are (doc_id, text, learns)."""
    cls = lambda w: code(w) % spec.classes
    count, totals, follow = Counter(), Counter(), defaultdict(Counter)
    for _, text, learns in rows:
        ts = tokens_of(text)
        for i, t in enumerate(ts if learns else []):
            one, two = (ts[i - k] if i >= k else END for k in (1, 2))
            count[t] += 1
            totals[cls(t)] += 1
            follow["bigram", one][cls(t)] += 1
            if one not in frequent:
                follow["skip", two][cls(t)] += 1
    all_tokens = sum(count.values())
    bias = {c: (totals[c] + 1) / (all_tokens + spec.classes) for c in range(spec.classes)}

    def by_class(kind, word):
        counts = follow[kind, word]
        if word not in hot:
            return softmax_at_optimum(counts, bias, spec.discount)
        group = lambda c: c % spec.groups
        mass, seen = Counter(), Counter()
        for c in bias:
            mass[group(c)] += bias[c]
            seen[group(c)] += counts[c]
        outer, out = softmax_at_optimum(seen, mass, spec.discount), {}
        for g in mass:
            inner = softmax_at_optimum({c: n for c, n in counts.items() if group(c) == g},
                                       {c: b / mass[g] for c, b in bias.items() if group(c) == g}, spec.discount)
            out |= {c: outer[g] * p for c, p in inner.items()}
        return out

    tables, out = {}, []
    for doc_id, text, learns in rows:
        ts, score = tokens_of(text), 0.0
        for i, t in enumerate(ts):
            one, two = (ts[i - k] if i >= k else END for k in (1, 2))
            key = ("bigram", one)
            if one not in frequent and sum(follow[key].values()) < spec.least and sum(follow["skip", two].values()):
                key = ("skip", two)
            if key not in tables:
                tables[key] = by_class(*key)
                assert math.isclose(sum(tables[key].values()), 1)
            score += math.log10(tables[key][cls(t)] * max(count[t], 1) / (totals[cls(t)] + 1))
        out.append((doc_id, learns, len(ts), score))
    return out


def check(docs, learns, spec):
    prepared = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    rows = [tuple(r) for r in prepared.collect()]
    known = lm.frequent_words(prepared, spec)
    every = {t for _, text, _ in rows for t in tokens_of(text)}
    frequent = {t for t in every if code(t) in set(known.codes.tolist())}
    hot = {t for t in every if code(t) in set(known.hot.tolist())}
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["learned"], r["n_tokens"], r["score"]) for r in lm.score(docs, learns, spec).collect()))
    want = sorted((d is None, d or 0, learned, n, s) for d, learned, n, s in scores_by_hand(rows, spec, frequent, hot))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-5, atol=1e-4)
    return frequent, hot


def test_scores_match_dictionaries(spark):
    texts = [prose(i % 5, 30 + 7 * i) + " the end of the line the " * (i % 4) + f" only{i} the rare{i} x only{i + 1}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    frequent, hot = check(docs, F.col("doc_id") % 4 != 0, SMALL)
    assert 1 < len(frequent) <= 13 and "the" in hot and "only1" not in frequent


def whole_scores_by_hand(rows, spec):
    """(doc_id, learned) -> score where every token has features of the previous word, the skipped one and both, with dictionaries."""
    cls, group = lambda w: code(w) % spec.classes, lambda c: c % spec.groups
    count, totals, follow = Counter(), Counter(), defaultdict(Counter)

    def histories(ts, i):
        one, two = (ts[i - k] if i >= k else END for k in (1, 2))
        return ("bigram", one), ("skip", two), ("both", one, two)

    for _, text, learns in rows:
        ts = tokens_of(text)
        for i, t in enumerate(ts if learns else []):
            count[t] += 1
            totals[cls(t)] += 1
            for h in histories(ts, i):
                follow[h][cls(t)] += 1
    least = spec.hot_share * sum(count.values())
    bias = {c: (totals[c] + 1) / (sum(count.values()) + spec.classes) for c in range(spec.classes)}
    mass = {g: sum(b for c, b in bias.items() if group(c) == g) for g in range(spec.groups)}

    def is_split(h):
        return all(count[w] > least for w in h[1:]) and (h[0] != "both" or sum(follow[h].values()) > least)

    def by_class(h):
        counts = follow[h]
        if not is_split(h):
            return softmax_at_optimum(counts, bias, spec.discount)
        outer, out = softmax_at_optimum({g: sum(n for c, n in counts.items() if group(c) == g) for g in mass}, mass, spec.discount), {}
        for g in mass:
            inner = softmax_at_optimum({c: n for c, n in counts.items() if group(c) == g},
                                       {c: b / mass[g] for c, b in bias.items() if group(c) == g}, spec.discount)
            out |= {c: outer[g] * p for c, p in inner.items()}
        return out

    tables, out = {}, []
    for doc_id, text, learns in rows:
        ts, score = tokens_of(text), 0.0
        for i, t in enumerate(ts):
            hs = histories(ts, i)
            if hs[2] not in tables:
                n = [sum(follow[h].values()) for h in hs]
                weights = [s * n / (n + k) for s, n, k in zip(spec.shares, n, spec.trust, strict=True)]
                weights = weights if sum(weights) else [1, 0, 0]
                each = [by_class(h) for h in hs]
                tables[hs[2]] = {c: sum(w * p[c] for w, p in zip(weights, each, strict=True)) / sum(weights) for c in bias}
                assert math.isclose(sum(tables[hs[2]].values()), 1)
            score += math.log10(tables[hs[2]][cls(t)] * max(count[t], 1) / (totals[cls(t)] + 1))
        out.append((doc_id, learns, len(ts), score))
    return out, {h for h in follow if is_split(h)}


WHOLE = lm.NgramSpec(classes=256, groups=4, hot_share=0.01, block_chars=3000, part_chars=4000)


def check_whole(docs, learns, spec=WHOLE):
    rows = [tuple(r) for r in docs.select("doc_id", "text", F.coalesce(learns, F.lit(False))).collect()]
    want, split = whole_scores_by_hand(rows, spec)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(key((r["doc_id"], r["learned"], r["n_tokens"], r["score"])) for r in lm.score(docs, learns, spec).collect())
    want = sorted(map(key, want))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-5, atol=1e-4)
    return split


def test_every_token_has_all_features(spark):
    """By default no word is too frequent for features of the skipped word and of both words."""
    texts = [prose(i % 5, 30 + 7 * i) + " the end of the line the " * (i % 4) + f" only{i} the rare{i} x only{i + 1}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    split = check_whole(docs, F.col("doc_id") % 4 != 0)
    assert {"bigram", "skip", "both"} == {h[0] for h in split}
    awkward = awkward_docs(spark).unionByName(awkward_docs(spark).where("doc_id = 8").withColumn("doc_id", F.lit(70).cast("long")))
    check_whole(awkward, F.col("doc_id") % 3 != 0)
    check_whole(awkward, F.lit(False))


def test_skipped_word_after_frequent_words(spark):
    """What follows "the" is told by the word before it; all words are frequent."""
    texts = ["red the apple", "green the pear"] * 40 + ["red the pear", "red the apple"]
    docs = spark.createDataFrame([(i, x, i < 80) for i, x in enumerate(texts)], "doc_id long, text string, learns boolean")
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, F.col("learns")).collect()}
    assert got[81] > got[80] + 0.5


def test_frequent_words_are_counted_in_all_training_texts(spark):
    """The commonest word stands in one text; texts not learned from don't count."""
    texts = [f"a b c w{i}" for i in range(60)] + ["zz " * 500] + ["held " * 900]
    docs = spark.createDataFrame([(i, x, not x.startswith("held")) for i, x in enumerate(texts)], "doc_id long, text string, learns boolean")
    counts = Counter(t for x in texts[:-1] for t in tokens_of(x))
    for block_chars in (100, 6_000_000):
        found = lm.frequent_words(docs.repartition(3, "doc_id"), lm.NgramSpec(frequent=5, sample_rows=5, hot_share=0.3, block_chars=block_chars))
        assert set(found.codes.tolist()) == {code(t) for t, n in counts.most_common(5)}
        assert found.hot.tolist() == [code("zz")]


def test_awkward_rows_and_base_scores(spark):
    docs = awkward_docs(spark).unionByName(awkward_docs(spark).where("doc_id = 8").withColumn("doc_id", F.lit(70).cast("long")))
    learns = F.col("doc_id") % 3 != 0
    check(docs, learns, SMALL)
    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in lm.score(docs, learns, SMALL).collect())
    rows = [(r["doc_id"], tokens_of(r["text"])) for r in docs.collect()]
    c = Counter(t for d, ts in rows if d is not None and d % 3 for t in ts)
    n, v = sum(c.values()), len(c)
    assert got == Counter((d, len(ts), sum(c[t] > 0 for t in ts), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), 6)) for d, ts in rows)


def test_nothing_learned_and_no_rows(spark):
    assert lm.score(no_docs(spark), F.lit(True), SMALL).count() == 0
    rows = lm.score(awkward_docs(spark), F.lit(None).cast("boolean"), SMALL).collect()
    assert len(rows) == awkward_docs(spark).count()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows)
    assert all(math.isclose(r["score"], -r["n_tokens"] * math.log10(SMALL.classes), rel_tol=1e-5) for r in rows)


def test_blocks_and_parts_do_not_change_scores(spark):
    """Every block a text of its own and many parts, against one block and one part."""
    docs = awkward_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    learns = F.col("doc_id") % 3 != 0
    small = {**SMALL.__dict__, "block_chars": 1, "part_chars": 100}
    large = {**SMALL.__dict__, "block_chars": 10**9, "part_chars": 10**9}
    one, two = ({r["doc_id"]: r["score"] for r in lm.score(docs, learns, lm.NgramSpec(**s)).collect()} for s in (small, large))
    assert one.keys() == two.keys() and all(math.isclose(one[k], two[k], rel_tol=1e-5) for k in one)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 19), st.integers(0, 2000), min_size=1), min_size=1, max_size=6), st.randoms(use_true_random=False))
def test_gradients_vanish_and_rows_are_distributions(tables, rnd):
    spec = lm.NgramSpec(rounds=40)
    base = np.array([rnd.random() + 0.01 for _ in range(20)])
    base /= base.sum()
    row = np.repeat(np.arange(len(tables)), 20)
    n = np.array([t.get(i, 0) for t in tables for i in range(20)])
    logs, total = lm.fit_rows(row, n, np.tile(base, len(tables)), np.full(len(tables), 20), spec)
    for k, t in enumerate(tables):
        p = np.exp(logs[row == k])
        assert math.isclose(p.sum(), 1, rel_tol=1e-6) and total[k] == sum(t.values())
        want = softmax_at_optimum({i: v for i, v in t.items() if v}, dict(enumerate(base)), spec.discount)
        assert np.allclose(p, [want[i] for i in range(20)], rtol=1e-4)


def test_held_out_words_are_predicted(spark):
    """Held-out rows of the sample table: far above the counts of single words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).where("NOT learned")
    base, score = out.agg(F.sum("base_score") / F.sum("n_tokens"), F.sum("score") / F.sum("n_tokens")).first()
    assert score > base + 0.2
