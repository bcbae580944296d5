"""Quality rules, near duplicates, mixing and packing against brute force on small tables."""

import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_cases import LOWER, awkward_docs, no_docs, prose, words  # noqa: E402

from panelwright.llm import mixing, near_dup, packing, quality_rules, token_files  # noqa: E402
from panelwright.llm.tokens import Encoder  # noqa: E402

SF = "/root/testdata/sf0.001"


# quality rules


def rule_base(text):
    w = words(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def line_key(line):
    return " ".join(words(line.translate(LOWER)))


def rules_by_hand(rows, spec):
    """[(kept, left lines)] for rows (source, text)."""
    per_line = defaultdict(set)
    texts = {(s, t or "") for s, t in rows if words(t)}
    for s, t in texts:
        for x in {line_key(x) for x in t.split("\n") if words(x)}:
            per_line[s, x].add(t)
    bad = {k for k, v in per_line.items() if len(v) > spec.max_line_documents}
    out = []
    for s, t in rows:
        n, *_, again = rule_base(t)
        lost = sum(len(words(x)) for x in (t or "").split("\n") if (s, line_key(x)) in bad)
        failed = n < spec.min_words or 100 * again > spec.max_repeat_percent * n
        whole = not lost or (100 * (n - lost) >= spec.min_left_percent * n and n - lost >= spec.min_left_words)
        left = "\n".join(x for x in (t or "").split("\n") if not words(x) or (s, line_key(x)) not in bad)
        out.append((failed, not failed and whole, left))
    return out


def hosts(spark):
    """Menus that five documents share, a group of near copies, and documents that are little but menu."""
    menu = "home about contact imprint"
    rows = [(i, f"{menu}\n{prose(i, 30)}\nall rights reserved by us", "h") for i in range(5)]
    rows += [(10 + i, f"{menu}\nall rights reserved by us\n{prose(90 + i, 3)}", "h") for i in range(2)]
    body = [prose(40 + j, 12) for j in range(6)]
    rows += [(20 + i, "\n".join([*body[:i], prose(70 + i, 12), *body[i + 1:]]), "h") for i in range(6)]
    rows += [(30, f"Home  ABOUT contact imprint\n{prose(50, 30)}", "other"), (31, None, None), (32, prose(3, 40), None), (0, rows[0][1], "h")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("make", [awkward_docs, hosts])
def test_rules_match_brute_force(spark, make):
    docs, spec = make(spark), quality_rules.RuleSpec(max_line_documents=3)
    got = Counter((r["doc_id"], r["source"], *(r[s] for s in quality_rules.STATS), r["base_failed"], r["kept"])
                  for r in quality_rules.judge(docs, spec).collect())
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    want = Counter((i, s, *rule_base(t), f, k) for (i, s, t), (f, k, _) in zip(rows, rules_by_hand([r[1:] for r in rows], spec), strict=True))
    assert got == want


def test_rules_cut_menus_and_reject_what_is_little_but_shared_lines(spark):
    docs, spec = hosts(spark), quality_rules.RuleSpec(max_line_documents=3)
    kept = {r["doc_id"]: r["text"] for r in quality_rules.strip_lines(docs, spec).collect()}
    assert set(kept) == {*range(5), 30, 32}
    assert "imprint" not in kept[1] and prose(1, 30) in kept[1] and "imprint" in kept[30]


@pytest.mark.parametrize("own, kept", [(40, True), (20, False), (8, False)])
def test_rules_count_pages_that_are_mostly_menu(spark, own, kept):
    """60 words of menu and footer on each of 60 pages whose other words differ; and 60 copies of one text, which count once."""
    menu = "\n".join(prose(500 + j, 10) for j in range(6))
    body = "\n".join(prose(600 + j, 10) for j in range(12))
    rows = [(i, f"{menu}\n{prose(1000 + i, own)}", "h") for i in range(60)]
    rows += [(100 + i, body, "copies") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in quality_rules.strip_lines(docs).collect()}
    assert {i: t for i, t in got.items() if i < 100} == ({i: prose(1000 + i, own) for i in range(60)} if kept else {})
    assert {i: t for i, t in got.items() if i >= 100} == {i: t for i, t, _ in rows if i >= 100}


def test_rules_count_menus_that_lack_a_page_s_own_entry(spark):
    """60 distinct pages, each with 11 of 12 menu lines and ten words of its own: every line is on 55 of them."""
    menu = [prose(700 + j, 5) for j in range(12)]
    rows = [(i, "\n".join([*menu[:i % 12], *menu[i % 12 + 1:], prose(3000 + i, 10)]), "h") for i in range(60)]
    judged = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {(r["left_words"], r["kept"]) for r in judged} == {(10, False)} and all(len(r["removed"]) == 11 for r in judged)


def test_rules_need_few_shuffles(spark):
    plan = quality_rules.judge(awkward_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 30


def test_rules_keep_columns(spark):
    docs = awkward_docs(spark)
    out = quality_rules.strip_lines(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert {r["n_chars"] for r in out.collect()} == {len(r["text"]) for r in out.collect()}
    assert quality_rules.judge(no_docs(spark)).count() == 0 and quality_rules.strip_lines(no_docs(spark)).count() == 0


# near duplicates


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups_by_hand(docs):
    """{doc_id: component} by comparing all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}, {d: len(s) for d, s in sets.items()}


def chain(spark, steps=12):
    """Each text differs from the next in one word: ends are linked through the middle only."""
    base, rows = prose(77, 200).split(), []
    for i in range(steps):
        rows.append((100 - i, " ".join(base)))
        base[10 + 12 * i] = f"step{i}"
        base[16 + 12 * i] = f"stop{i}"
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_dup_matches_brute_force(spark):
    sample = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    awkward = awkward_docs(spark).where("doc_id IS NOT NULL").selectExpr("doc_id + 100000 AS doc_id", "text")
    docs = sample.unionByName(awkward).unionByName(chain(spark).selectExpr("doc_id + 200000 AS doc_id", "text"))
    for spec in (near_dup.DedupSpec(), near_dup.DedupSpec(block_rows=2)):
        got = {r["doc_id"]: (r["component_id"], r["n_shingles"], r["kept"]) for r in near_dup.components(docs, spec).collect()}
        component, size = groups_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])
        assert got == {d: (c, size[d], c == d) for d, c in component.items()}


def test_near_dup_keeps_one_with_all_columns(spark):
    docs = awkward_docs(spark)
    out = near_dup.keep_one(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    ids = [r["doc_id"] for r in out.collect()]
    assert Counter(ids) == Counter([1, 2, 3, 4, 5, 7, 8, 10, 11, 13, 14, None])  # 9 goes with 8 (111 of 121 shingles)
    assert near_dup.keep_one(no_docs(spark)).count() == 0


# mixing


def shares_by_hand(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s] * (1 + 1e-12)]
        if not over:
            return fixed | share
        fixed |= {s: float(most * sizes[s]) for s in over}


def test_mix_reaches_targets(spark):
    for docs in (awkward_docs(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        mixed = mixing.mix(docs)
        name = mixed.columns[-1]
        got = mixed.select("doc_id", "source", "text", f"{name}.*").collect()
        sizes, taken, largest = Counter(), Counter(), Counter()
        for r in got:
            assert r["size"] == len(words(r["text"])) and 0 <= r["copies"] <= 3
            sizes[r["source"]] += r["size"]
            taken[r["source"]] += r["size"] * r["copies"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        want = shares_by_hand(sizes)
        assert len(got) == docs.count()
        for r in got:
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
        again = sorted(map(str, mixing.mix(docs).select("doc_id", f"{name}.*").collect()))
        assert again == sorted(str(r) for r in mixed.select("doc_id", f"{name}.*").collect())


def test_emit_repeats_rows(spark):
    docs = awkward_docs(spark)
    mixed = mixing.mix(docs)
    out = mixing.emit(mixed, mixed.columns[-1])
    assert out.columns == docs.columns
    assert out.count() == mixed.agg(F.sum(f"{mixed.columns[-1]}.copies")).first()[0]
    assert mixing.mix(no_docs(spark)).count() == 0


@given(st.lists(st.integers(0, 500), min_size=1, max_size=12))
@settings(max_examples=15, deadline=None)
def test_targets_by_water_level(spark, sizes):
    table = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    want = shares_by_hand({f"s{i:02}": n for i, n in enumerate(sizes)})
    assert all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


# tokens, token files and packing


def whole_ids(file, texts, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(file))
    return [e.ids + [end] for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@given(st.lists(st.text(st.sampled_from(list("aB's,.! \n\t\r\x0b\x1c\x85  　éÉΣσßİ12٣|<>%́\x00\x01漢")), max_size=40), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_parts_give_the_ids_of_the_whole(file, texts):
    import pyarrow as pa

    ids, sizes = Encoder(file).encode(pa.array(texts), 9)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == whole_ids(file, texts, 9)


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_with_special_strings_and_a_small_memory(file, monkeypatch):
    """Strings of special tokens in any case, parts forgotten all the time, long words."""
    import pyarrow as pa

    from panelwright.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 30)
    known = Encoder(file)
    texts = ["a <|endoftext|> b", "<|ENDOFTEXT|>", "x<|startoftext|>y", "<|endoftext", "plain", "", "a <|endoftext|><|endoftext|>.", "w" * 5000 + "!!"]
    texts += [prose(i, 40) + "### Δx. Σς, İstanbul... don't" for i in range(12)]
    for at in range(0, len(texts), 3):
        ids, sizes = known.encode(pa.array(texts[at:at + 3] + ["common words come again"]), 9)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == whole_ids(file, texts[at:at + 3] + ["common words come again"], 9)
        assert all(len(w) <= tokens.LONGEST for w in known.place) or len(known.place) <= 60


def test_token_files_of_a_very_long_text(spark, tmp_path):
    """Over one slice of four million bytes, beside short ones."""
    text = "\n".join(prose(i % 90, 900) for i in range(1400))
    assert len(text) > 4_000_000
    docs = spark.createDataFrame([(1, "short"), (2, text), (3, None), (4, "<|endoftext|>" + text[:1000])], "doc_id long, text string")
    token_files.write(docs, str(tmp_path / "orc"))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_files.with_crc(token_files.read(spark, str(tmp_path / "orc"))).collect()}
    ids = whole_ids("word_bpe_49k.json", ["short", text, "", "<|endoftext|>" + text[:1000]], 1)
    assert got == {i + 1: (len(x), crc(x)) for i, x in enumerate(ids)}


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files_round_trip(spark, tmp_path):
    docs = awkward_docs(spark)
    token_files.write(docs, str(tmp_path / "orc"))
    got = token_files.with_crc(token_files.read(spark, str(tmp_path / "orc"))).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    ids = whole_ids("word_bpe_49k.json", [t for _, t in rows], 1)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((d, len(x), crc(x)) for (d, _), x in zip(rows, ids, strict=True))
    order = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert [r["start"] for r in order] == [0, *np.cumsum([r["n_tokens"] for r in order])[:-1].tolist()]
    one = token_files.lookup(spark, str(tmp_path / "orc"), [5, 99])
    assert [r["doc_id"] for r in one.collect()] == [5]
    assert "doc_id" in one._jdf.queryExecution().toString().split("PushedFilters")[-1]
    token_files.write(no_docs(spark), str(tmp_path / "none"))
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def check_packing(rows, texts, most=1024):
    """rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset) against the texts' ids."""
    ids = whole_ids("byte_bpe_50k.json", [t for _, t in texts], 2)
    want = Counter()
    for (d, _), x in zip(texts, ids, strict=True):
        first = len(x) % most
        edges = ([0] if first else []) + list(range(first, len(x), most)) + [len(x)]
        want.update((d, i, a, b - a, crc(x[a:b])) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts[:-1], parts[1:], strict=True))
        assert sum(n for _, n in parts) <= most
    return len(bins), sum(map(len, ids))


@pytest.mark.parametrize("name", ["awkward", "sample"])
def test_packing(spark, name):
    docs = awkward_docs(spark) if name == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    placed = packing.place(packing.pieces(docs, packing.PackSpec()), packing.PackSpec())
    rows = token_files.with_crc(placed).collect()
    bins, tokens = check_packing(rows, [(r["doc_id"], r["text"] or "") for r in docs.collect()])
    assert bins <= 1.01 * tokens / 1024 + 2
    whole = packing.sequences(placed)
    assert whole.count() == bins and whole.agg(F.sum(F.size("ids"))).first()[0] == tokens


def test_mixture_of_rows_that_share_an_id_does_not_depend_on_their_order(spark):
    rows = [(i % 3, f"word{i} " * (1 + i % 2), "ab"[i % 5 > 0]) for i in range(40)]
    one, two = (Counter(tuple(r) for r in mixing.emit(mixing.mix(spark.createDataFrame(x, "doc_id long, text string, source string").repartition(p))).collect())
                for x, p in ((rows, 1), (rows[::-1], 5)))
    assert one == two and sum(one.values()) > 0


def test_packing_keeps_clashing_columns(spark):
    spec = packing.PackSpec()
    cut = packing.pieces(awkward_docs(spark), spec)
    wider = cut.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce("doc_id", F.lit(0)).cast("string")).alias(c)
                              for c in ("rank", "Base", "n", "sequence_id", "offset", "first", "each")])
    placed = packing.place(wider, spec)
    assert len(set(placed.columns)) == len(placed.columns) and dict(placed.dtypes)["sequence_id"] == "bigint"
    rows = placed.collect()
    assert all(r[c] == f"{c} of {r['doc_id'] or 0}" for r in rows for c in ("rank", "Base", "n", "first", "each"))
    check_packing(token_files.with_crc(placed).collect(), [(r["doc_id"], r["text"] or "") for r in awkward_docs(spark).collect()])


def test_packing_nothing(spark):
    assert packing.place(packing.pieces(no_docs(spark), packing.PackSpec()), packing.PackSpec()).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=30), st.sampled_from(["norm", "dot"]),
       st.integers(2, 64), st.sampled_from([None, 5000]))
@settings(max_examples=80, deadline=None)
def test_plan_keeps_every_capacity(counts, choose, documents, attention):
    spec = packing.PackSpec(tokens=64, documents=documents, attention=attention, choose=choose)
    slots = packing.plan(counts, spec)
    bins = defaultdict(list)
    for length, n in counts.items():
        own = slots[slots.length == length]
        for rank in range(n):
            s = own[own["first"] <= rank].iloc[-1]
            nth = rank - s["first"]
            bins[s["sequence"] + nth // s["each"]].append((s["offset"] + nth % s["each"] * length, length))
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts[:-1], parts[1:], strict=True))
        assert sum(n for _, n in parts) <= 64 and len(parts) <= documents and sum(n * n for _, n in parts) <= (attention or 64 * 64)


def test_plan_refuses_what_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan({65: 1}, packing.PackSpec(tokens=64))
