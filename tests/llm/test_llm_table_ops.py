"""URL rules, WARC, vector search, language model and classifier against brute force on small tables."""

import base64
import gzip
import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_cases import LOWER, awkward_docs, no_docs, prose, words  # noqa: E402

from panelwright.llm import maxent_lm, rule_classifier, url_filter, vectors, warc  # noqa: E402
from panelwright.llm.graph import star_components  # noqa: E402
from panelwright.llm.queries import URL_RULES  # noqa: E402

SF = "/root/testdata/sf0.001"
PAGE_SCHEMA = "page_id long, url string, html string, verdict string, path int"


# components


@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(200, i) for i in range(201, 240)]
    edges += [(None, 3), (5, 5), *edges[:4]]
    got = {r["node"]: r["component"] for r in star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {x: root(x) for x in parent}
    assert star_components(spark.createDataFrame([], "a string, b string")).count() == 0


# url filter


def page(i, url, html=""):
    return (i, url, html, "x", 1)


def canonical(url):
    return f'<html><HEAD><link href="{url}" rel=canonical></head>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; url={url}'>"


def test_urls(spark):
    rows = [
        page(1, "https://x.example.com/en/1"), page(2, "http://WWW.Example.COM/en/2?q#f"), page(3, "http://a.net/es/3"), page(4, None),
        page(5, "no scheme example.com/en/"), page(6, ""), page(7, "http://example.com"), page(8, "http://notexample.com/en/"),
        page(9, "http://b.org/old", refresh("http://a.net/es/3#part")), page(10, "http://b.org/older", canonical("/old")),
        page(11, "http://c.example.com/fr/9", canonical("http://b.org/old")), page(12, "http://b.org/free"),
        page(13, "https://b.org/older#x"), page(14, "http://d.org/x", canonical("http://gone.example.com/en/404")),
        page(15, "http://e.org/a/b", canonical("c")), page(16, "http://e.org/a/c.html"), page(17, "http://net/es/q", None), page(3, "http://a.net/es/3"),
        page(None, "http://b.org/old"), page(18, "http://a.net/es", ""), page(19, "x://y://net/fr/", ""),
    ]
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(rows, PAGE_SCHEMA), URL_RULES).collect()}
    verdicts = {i: (r["rule"], r["verdict"]) for i, r in got.items()}
    assert verdicts == {
        1: ("example.com/en/", "block"), 2: ("www.example.com/en/", "allow"), 3: ("net/es/", "block"), 4: (None, "allow"), 5: (None, "allow"),
        6: (None, "allow"), 7: (None, "allow"), 8: ("com/", "allow"), 9: (None, "block"), 10: (None, "block"), 11: ("com/", "allow"),
        12: (None, "allow"), 13: (None, "block"), 14: (None, "block"), 15: (None, "allow"), 16: (None, "allow"), 17: ("net/es/", "block"),
        None: (None, "block"), 18: (None, "allow"), 19: (None, "allow")}
    assert (got[2]["host"], got[2]["path"]) == ("www.example.com", "/en/2") and (got[4]["host"], got[4]["path"]) == ("", "")
    assert (got[7]["host"], got[7]["path"]) == ("example.com", "") and got[19]["host"] == "y:"
    assert url_filter.judge_urls(spark.createDataFrame([], PAGE_SCHEMA), URL_RULES).count() == 0


def url_answers(spark, rows, syntactic=False):
    return {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(rows, PAGE_SCHEMA), URL_RULES, syntactic).collect()}


def test_tracking_names_are_whole_names(spark):
    rows = [page(1, "http://b.org/p?pref=a", canonical("http://a.net/es/1")), page(2, "http://b.org/p?pref=b"), page(3, "http://b.org/p?x=1&href=c"),
            page(4, "http://c.org/p?ref=a&x=1&gclid=2", canonical("http://a.net/es/1")), page(5, "http://c.org/p?x=1&utm_source=b&ref=c"), page(6, "http://c.org/p?x=2&ref=a")]
    assert url_answers(spark, rows, True) == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow"}
    assert url_answers(spark, rows) == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow"}


DECLARED = [
    # a scheme inside a target isn't one at its start
    page(1, "http://clean.org/a", canonical("/go?u=http://example.com/en/x")), page(2, "http://clean.org/b", canonical("go?u=http://example.com/en/x")),
    # dot segments
    page(3, "http://d.org/q"), page(4, "http://d.org/dir/x", canonical("../q")), page(5, "http://d.org/y", refresh("http://a.net/es/3")),
    page(6, "http://d.org/e/f/g", canonical(".././../../y")), page(7, "http://d.org/h", canonical("http://a.net/fr/../es/./1")),
    # comments, also open ones
    page(8, "http://c.org/a", f"<!-- {canonical('http://example.com/en/x')} -->"), page(9, "http://c.org/b", f"<!-- x {refresh('http://example.com/en/x')}"),
    page(10, "http://c.org/c", f"<!--a--><!----->{canonical('http://a.net/es/3')}<!-- b -->"),
    # the first base address counts, also a relative one
    page(11, "http://e.org/a", f"<base target=x href='http://a.net/es/'><base href='http://clean.org/'>{canonical('1')}"),
    page(12, "http://f.net/x", f"<BASE HREF=\"/es/\">{refresh('2')}"), page(13, "http://f.net/es/2"), page(14, "http://f.org/x", f"<base href='/es/'>{refresh('2')}"),
    # arguments, entities, a page's own query, odd schemes
    page(15, "http://g.org/p", canonical("?a=1&amp;b=2")), page(16, "http://g.org/p?a=1&b=2", canonical("//a.net/es/1")), page(17, "http://g.org", canonical("?z")),
    page(18, "http://g.org/?z", refresh("svn+x://a.net/es/1")), page(19, "http://g.org/m", canonical("mailto:a@example.com/en/")), page(20, None, canonical("http://a.net/es/1")),
    page(21, "no scheme", canonical("http://a.net/es/1")), page(22, "http://h.org/e?x=../y", canonical("?x=/../a")),
]


def test_declared_targets(spark):
    got = url_answers(spark, DECLARED)
    block = {4: False, 5: True, 6: True, 7: True, 10: True, 11: True, 12: True, 13: True, 15: True, 16: True, 17: True, 18: True}
    assert {i for i, v in got.items() if v == "block"} == {i for i, b in block.items() if b}


def test_declared_targets_in_sql(spark, tmp_path):
    """The query's SQL states the same rules: the fixture and, as pages, the urls of the test before."""
    import duckdb

    from panelwright.llm.oracles import ORACLES

    rows = spark.createDataFrame(DECLARED, PAGE_SCHEMA)
    rows.coalesce(1).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    want = Counter(con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op1_url_filter']})").fetchall())
    got = url_filter.judge_urls(rows, URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    assert Counter(tuple(r) for r in got) == want


def test_escaped_ampersands_name_the_same_page(spark):
    rows = [page(1, "http://b.org/p", canonical("http://b.org/q?a=1&amp;b=2")), page(2, "http://b.org/q?a=1&b=2", refresh("http://c.org/?x=1&AMP;y=2")),
            page(3, "http://c.org/?x=1&y=2", canonical("http://a.net/es/1"))]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(rows, PAGE_SCHEMA), URL_RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block"}


def test_many_aliases_of_one_page(spark):
    rows = [page(i, f"http://s{i}.org/p", canonical("http://hub.org/")) for i in range(300)] + [page(999, "http://x.net/fr/", canonical("http://hub.org/"))]
    out = url_filter.judge_urls(spark.createDataFrame(rows, PAGE_SCHEMA), URL_RULES)
    assert {r["verdict"] for r in out.collect()} == {"block"} and out.count() == 301


def test_url_plan_has_no_python(spark):
    plan = url_filter.judge_urls(spark.read.parquet(f"{SF}/pages.parquet"), URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# warc


def archive(spark, pages, folder, **kw):
    warc.write_monolithic(warc.with_revisits(pages, **kw), f"{folder}/raw")
    index = warc.normalise(spark, f"{folder}/raw", f"{folder}/out")
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(warc.INDEX_SCHEMA).parquet(f"{folder}/index")


@pytest.mark.parametrize("least", [0, 3])
def test_warc_round_trip(spark, tmp_path, least):
    rows = [page(1, "http://a/ \r\nb", "same"), page(2, "http://b", "same"), page(3, None, None), page(4, "http://d", ""), page(5, "u", "Ünï\r\n\r\nWARC/1.1\r\n"),
            page(6, "u", "x" * 3_000_000), page(None, "u", "same"), page(None, "u", "alone"), page(7, "u", "twice"), page(7, "u", "twice"), page(8, "u", "ab"), page(9, "u", "ab")]
    index = archive(spark, spark.createDataFrame(rows, PAGE_SCHEMA), str(tmp_path), min_bytes=least)
    got = Counter((warc_id(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] and warc_id(r["refers_to"]),
                   None if r["payload"] is None else bytes(r["payload"])) for r in warc.read_records(index).collect())
    largest = defaultdict(lambda: None)
    for i, _, html, *_ in rows:
        if i is not None:
            largest[html or ""] = max(i, largest[html or ""] or i)
    want = Counter()
    for i, _, html, *_ in rows:
        body, top = (html or "").encode(), largest[html or ""]
        again = len(body) >= least and top is not None and i != top
        want[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", top if again else None, None if again else body] += 1
    assert got == want


def warc_id(text):
    inner = text.removeprefix("<urn:page:").removesuffix(">")
    return None if inner == "null" else int(inner)


def test_members_stand_alone_and_make_up_the_stream(spark, tmp_path):
    index = archive(spark, spark.read.parquet(f"{SF}/pages.parquet"), str(tmp_path)).toPandas().sort_values(["archive", "offset"])
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "raw").glob("*.gz")))
    for path in (tmp_path / "raw").glob("*.gz"):
        first = zlib.decompressobj(wbits=31)
        first.decompress(path.read_bytes())
        assert first.eof and not first.unused_data  # one stream for the whole file
    parts = b""
    for name, own in index.groupby("archive"):
        data = Path(name.removeprefix("file:")).read_bytes()
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() == len(data)
        for at, n in zip(own["offset"], own["length"], strict=True):
            record = gzip.decompress(data[at:at + n])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            parts += record
    assert sorted(parts.split(b"WARC/1.1")) == sorted(raw.split(b"WARC/1.1"))


def test_no_pages_and_broken_streams(spark, tmp_path):
    assert warc.read_records(archive(spark, spark.createDataFrame([], PAGE_SCHEMA), str(tmp_path))).count() == 0
    with pytest.raises(ValueError, match="block"):
        list(warc.records_of([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"]))
    with pytest.raises(ValueError, match="not a WARC"):
        list(warc.records_of([b"HTTP/1.1 200\r\n\r\n"]))
    with pytest.raises(ValueError, match="header"):
        list(warc.records_of([b"WARC/1.1\r\nContent"]))


# vectors


def exact(rows, queries, k):
    """[(query_id, rank, vec_id)] by comparing all."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    out = []
    for q, v in queries:
        s = x @ np.array(v, dtype=np.float64)
        keep = ids != q
        order = np.lexsort((ids[keep], -np.round(s[keep], 12)))[:k]
        out += [(q, r + 1, int(i)) for r, i in enumerate(ids[keep][order])]
    return out


def test_all_leaves_give_exact_answers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # ties
    bad = [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2004, [float("nan")] * 6), (2005, [float("inf")] * 6), (2006, [1.0] * 5), (None, [1.0] * 6)]
    table = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id long, embedding array<float>, score string")
    spec = vectors.SearchSpec(neighbours=7, leaf_rows=16, recall=1.1, chunk_rows=10, sample_rows=200)
    got = vectors.nearest(table, table.where("vec_id % 20 = 0"), spec).collect()
    want = exact(rows, [r for r in rows if r[0] % 20 == 0], 7)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted(want)
    spec.query_rows = 2  # blocks of few queries find the same
    blocked = vectors.nearest(table, table.where("vec_id % 20 = 0"), spec).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in blocked) == sorted(want)
    few = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert vectors.nearest(few, few, vectors.SearchSpec()).count() == 20
    assert vectors.nearest(few.limit(0), few.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in vectors.nearest(same, same.where("vec_id = 3"), vectors.SearchSpec(neighbours=4)).orderBy("rank").collect()] == [0, 1, 2, 4]


def test_recall_of_the_calibrated_search(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    spec = vectors.SearchSpec(leaf_rows=64)
    index = vectors.build_index(table, spec)
    got = {(r["query_id"], r["vec_id"]) for r in vectors.search(index, vectors.usable(table.where("vec_id % 20 = 0")), spec).collect()}
    want = {(q, v) for q, _, v in exact(rows, [r for r in rows if r[0] % 20 == 0], 20)}
    assert len(got & want) / len(want) >= 0.9 and index.recall >= 0.97


def test_recall_over_some_thousand_leaves(spark):
    """Clustered vectors in a tree of over two thousand leaves: few visits, recall as calibrated."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(300, 16))
    points = (centres[rng.integers(0, 300, 12_000)] + 0.3 * rng.normal(size=(12_000, 16))).astype(np.float32)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    spec = vectors.SearchSpec(leaf_rows=4, chunk_rows=500, query_rows=50)
    index = vectors.build_index(table, spec)
    assert index.tree.leaves > 2000 and index.visits < index.tree.leaves / 4 and index.recall >= 0.97
    got = {(r["query_id"], r["vec_id"]) for r in vectors.search(index, vectors.usable(table.where("vec_id % 20 = 0")), spec).collect()}
    want = {(q, v) for q, _, v in exact(rows, [r for r in rows if r[0] % 20 == 0], 20)}
    assert len(got & want) / len(want) >= 0.9
    print("visits", index.visits, "of", index.tree.leaves, "calibrated", index.recall, "measured", len(got & want) / len(want))


# language model


SMALL = maxent_lm.ModelSpec(classes=4, members=4, previous=16, skipped=8, trigrams=64, rounds=6, cells=64, block_chars=3000)


def test_base_scores_match_brute_force(spark):
    docs = awkward_docs(spark).unionByName(awkward_docs(spark).where("doc_id = 8").withColumn("doc_id", F.lit(70).cast("long")))
    learns = (F.col("doc_id") % 3 != 0)
    got = Counter((r["doc_id"], r["learned"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in maxent_lm.score(docs, learns, SMALL).collect())
    rows = [(r["doc_id"], [*words((r["text"] or "").translate(LOWER)), None]) for r in docs.collect()]
    c = Counter(t for d, ts in rows if d is not None and d % 3 for t in ts)
    n, v = sum(c.values()), len(c)
    want = Counter((d, d is not None and d % 3 != 0, len(ts), sum(c[t] > 0 for t in ts), n,
                    round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), 6)) for d, ts in rows)
    assert got == want
    assert maxent_lm.score(no_docs(spark), F.lit(True), SMALL).count() == 0


def test_model_is_a_distribution_and_learns(spark):
    """Every next word's probability, unseen ones taken together, adds up to one; fixed pairs of words are learnt."""
    texts = [("left right " * 40).strip() if i % 2 else ("up down " * 40).strip() for i in range(20)]
    vocabulary = ["left", "right", "up", "down"]
    probes = [*[f"left {w}" for w in vocabulary], "left", "left unseen"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(probes)], "doc_id long, text string")
    scored = {r["doc_id"]: r for r in maxent_lm.score(docs, F.col("doc_id") < 100, maxent_lm.ModelSpec(prior=0.1)).collect()}
    assert all(scored[i]["score"] > scored[i]["base_score"] for i in range(20))
    assert scored[101]["score"] > max(scored[i]["score"] for i in (100, 102, 103))
    rows = maxent_lm.gather(docs, F.col("doc_id") < 100, SMALL)
    soft = maxent_lm.train(maxent_lm.count_table(rows), SMALL)
    assert np.allclose(np.exp(soft.classes).sum(1), 1) and np.allclose(np.exp(soft.members).reshape(16, 4, 4).sum(2), 1)


def test_histories_stop_at_text_starts():
    tokens, sizes = np.array([0, 1, 2, 3, 3, 0, 3]), np.array([4, 1, 2])
    one, two = maxent_lm.histories(tokens, sizes, np.array([10, 11, 12, 13]), np.array([20, 21, 22, 23]))
    assert one.tolist() == [0, 10, 11, 12, 0, 0, 10] and two.tolist() == [0, 0, 20, 21, 0, 0, 0]


# classifier


def test_classifier_refuses_more_rules_than_allowed(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    with pytest.raises(ValueError, match="max_rules=1:"):
        rule_classifier.fit(docs, labels, rule_classifier.FitSpec(max_rules=1))


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = rule_classifier.fit(docs, labels.where("doc_id % 2 = 0"))
    assert 0 < len(model.rules) < 200
    out = rule_classifier.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(F.avg("predicted").alias("p"), F.count("*")).collect()
    share = {r["quality"]: r["p"] for r in out}
    assert share[1] > 0.97 and share[0] < 0.2
    again = rule_classifier.RuleModel.from_json(model.to_json())
    assert again == model


def test_compiled_rules_score_as_by_hand(spark):
    model = rule_classifier.RuleModel(0.3, [((rule_classifier.Condition("upper_share", True, 0.5),), -2.0),
                                            ((rule_classifier.Condition("log_words", True, 0.5), rule_classifier.Condition("again_share", False, 0.1)), 1.5)])
    docs = awkward_docs(spark)
    rows = rule_classifier.score(docs, model).collect()
    assert rule_classifier.score(docs, model).columns == [*docs.columns, "score_1", "predicted"]
    for r in rows:
        s = dict(zip(rule_classifier.STATISTICS, rule_classifier.statistics_of((r["text"] or "").encode()), strict=True))
        total = 0.3 - 2.0 * (s["upper_share"] > 0.5) + 1.5 * (s["log_words"] > 0.5 and s["again_share"] <= 0.1)
        assert r["score_1"] == pytest.approx(1 / (1 + math.exp(-total))) and r["predicted"] == (total >= 0)
    assert rule_classifier.score(no_docs(spark), model).count() == 0


def test_fit_without_labels_or_with_one_class(spark):
    docs = awkward_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert rule_classifier.fit(docs, none).rules == [] and rule_classifier.fit(no_docs(spark), none).rules == []
    ones = spark.createDataFrame([(1, 1), (5, 1), (None, 0), (8, None), (99, 0)], "doc_id long, quality int")
    model = rule_classifier.fit(docs, ones)
    assert model.rules == [] and model.intercept > 0


def test_statistics():
    s = dict(zip(rule_classifier.STATISTICS, rule_classifier.statistics_of(b"A!! B!! | c c\nA!! B!! | c c\n"), strict=True))
    assert s["upper_share"] == pytest.approx(4 / 18) and s["lone_share"] == pytest.approx(2 / 10) and s["repeat_lines"] == 0.5
    assert prose(1, 5) == prose(1, 5)
