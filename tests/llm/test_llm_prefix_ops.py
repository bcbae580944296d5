"""SimHash groups, the conversation trie and fill-in-middle against brute force on small tables."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_cases import LOWER, awkward_docs, no_docs, prose, words  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from panelwright.llm import fill_in_middle as fim  # noqa: E402
from panelwright.llm import prefix_trie, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


# SimHash


def mark_by_hand(text, k=4):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def groups_of_marks(rows, distance=4):
    """{doc_id: smallest doc_id reachable} for (doc_id, mark) rows; rows of one doc_id belong together."""
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(rows, 2):
        if (x ^ y).bit_count() <= distance:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in parent}


def check_simhash(docs, spec=simhash.SimhashSpec()):
    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.components(docs, spec).select(
        "doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id").collect())
    rows = [(r["doc_id"], mark_by_hand(r["text"])) for r in docs.select("doc_id", "text").collect()]
    group = groups_of_marks([r for r in rows if r[0] is not None])
    assert got == Counter((i, f"{m:016x}", group.get(i)) for i, m in rows)
    return group


@pytest.mark.parametrize("make", [awkward_docs, no_docs, lambda s: s.read.parquet(f"{SF}/documents.parquet")])
def test_simhash_matches_brute_force(spark, make):
    check_simhash(make(spark))


def test_simhash_query(spark):
    rows = entry_points.queries()["op11_simhash"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    group = groups_of_marks([(i, mark_by_hand(t)) for i, t in texts.items()])
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {(i, f"{mark_by_hand(t):016x}", group[i]) for i, t in texts.items()}
    assert len(set(group.values())) < len(group)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=list("aB é\t\n.　"), max_size=60), max_size=8))
def test_fingerprints_of_any_texts(texts):
    column = pa.array([""] + texts, pa.string())
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[:at[-1]]
    spec = simhash.SimhashSpec()
    want = [mark_by_hand(t) for t in [""] + texts]
    assert simhash.fingerprint_rows(data, at, spec).tolist() == want
    before, simhash.LONG = simhash.LONG, 7
    try:
        parts = [simhash.fingerprint_rows(data[x:y], np.array([0, y - x]), spec)[0] for x, y in itertools.pairwise(at.tolist())]
    finally:
        simhash.LONG = before
    assert [int(x) for x in parts] == want


def test_fingerprint_of_a_very_long_text(spark):
    text = " ".join(prose(i, 2000) for i in range(700))
    assert len(text) > simhash.LONG
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, text + " more")], "doc_id long, text string")
    check_simhash(docs)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5])
def test_every_close_pair_meets_in_a_segment(count):
    """All positions of up to 4 flips for small cases, random ones else: some segment is within its radius."""
    segments = simhash.segments_of(4, count)
    draw = random.Random(count)
    flips = [draw.sample(range(64), r) for r in (1, 2, 3, 4) for _ in range(2000)]
    for s in simhash.segments_of(4, count):
        flips += [list(range(s.low, s.low + r)) for r in (1, 2, 3, 4)]
    for bits in flips:
        assert any(sum(s.low <= b < s.low + s.width for b in bits) <= s.radius for s in segments)


@pytest.mark.parametrize("segments, block", [(2, 1024), (3, 16), (4, 8), (None, 32)])
def test_links_of_planted_marks(spark, segments, block):
    """Chains, a dense cluster larger than a block, pairs at 4 and 5 bits, random marks."""
    draw = random.Random(7)
    marks = {draw.getrandbits(64) for _ in range(150)}
    for base in draw.sample(sorted(marks), 40):
        for r in (1, 2, 3, 4, 5):
            marks.add(base ^ sum(1 << b for b in draw.sample(range(64), r)))
    centre = draw.getrandbits(64)
    for _ in range(120):
        marks.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.choice((3, 4, 5, 6)))))
    chain = draw.getrandbits(64)
    for k in range(12):
        marks.add(chain ^ ((1 << 4 * k) - 1))
    rows = list(enumerate(draw.sample(sorted(marks), len(marks))))
    classes = spark.createDataFrame([(i, m - (m >> 63 << 64)) for i, m in rows], "rep long, fp long")
    edges = simhash.links(classes, simhash.SimhashSpec(segments=segments, block_rows=block)).collect()
    value = dict(rows)
    parent = groups_of_marks(rows)
    seen = {i: i for i, _ in rows}

    def top(x):
        while seen[x] != x:
            x = seen[x]
        return x

    for a, b in edges:
        assert parent[a] == parent[b]
        a, b = top(a), top(b)
        seen[max(a, b)] = min(a, b)
    assert {i: top(i) for i in value} == parent


# conversations


def rebuilt_by_hand(rows):
    """{conv_id: [(role, text)]} for rows (conv_id, turn, role, text)."""
    def mark(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, mark(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def trie_by_hand(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(conversations[c]) == len(p))
        out[(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def odd_conversations(spark):
    """Null and repeated turns, null roles and texts, repeated rows, copies, a family without its first, a long one, clashing columns."""
    draw = random.Random(3)
    rows = []
    for c in [*range(0, 23), 31, 32, 47, -3, -5, -4]:
        topic = draw.randrange(3)
        for t in range(draw.randrange(1, 12)):
            same = t < 3
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"opening {topic} {t}" if same else f"{c} says {t} é"))
    rows += [(40 + k, t, "user", f"copy {t}") for k in range(5) for t in range(10)]
    rows += [(60, None, None, None), (60, None, "user", "a"), (60, 1, "user", "b"), (60, 1, "user", "b"), (60, 1, "assistant", None), (60, 1, "", "")]
    rows += [(61, 0, "user", ""), (None, 0, "user", "no id"), (65, 3, "ab", "c"), (65, 3, "a", "bc")]
    rows += [(70, t, "user", f"long {t}") for t in range(400)] + [(71, t, "user", f"long {t}") for t in range(200)]
    draw.shuffle(rows)
    return spark.createDataFrame([(*r, 7, None) for r in rows], "conv_id long, turn long, role string, text string, depth int, a string")


@pytest.mark.parametrize("parts, spec", [(30, prefix_trie.TrieSpec(piece_bytes=16, fan_in=2)), (1, prefix_trie.TrieSpec(least_cells=1 << 20)),
                                         (7, prefix_trie.TrieSpec(rows=1, least_cells=64, most_cells=64))])
def test_trie_matches_brute_force(spark, spec, parts):
    """Also with ranges that cut conversations, a screen that lets nearly all pass, and one that stops nearly all."""
    rows = odd_conversations(spark)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = Counter(tuple(r) for r in prefix_trie.trie(rows, spec).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == trie_by_hand(rebuilt_by_hand([tuple(r)[:4] for r in rows.collect()]))


def test_plain_trie_and_hot_nodes(spark):
    """Many conversations with one and the same turns: their ids are hashed in order over several ranges."""
    rows = spark.range(3000).select(F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("turn"))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("say "), "turn").alias("text"))
    spec = prefix_trie.TrieSpec(piece_bytes=100)
    got = Counter(tuple(r) for r in prefix_trie.plain_trie(rows, spec).collect())
    assert got == trie_by_hand({c: [("user", f"say {t}") for t in range(3)] for c in range(3000)})


def test_screen_keeps_single_tails_out_of_the_groups(spark):
    """Of conversations that share their first two turns, one prefix more each is grouped exactly."""
    rows = [(c, t, "user", f"common {t}" if t < 2 else f"{c} {t}") for c in range(50) for t in range(20)]
    turns, every = prefix_trie.rebuilt(prefix_trie.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    spec = prefix_trie.TrieSpec(cells_per_prefix=64)
    made = prefix_trie.prefixes(turns)
    carry = prefix_trie.carried(made, "conv_id", "depth", ["a", "b"])
    more = spark.sparkContext.broadcast(prefix_trie.screen(made, carry, spec))
    kinds = Counter(r["kind"] for r in prefix_trie.screened(made, carry, more, spec).collect())
    hand = rebuilt_by_hand(rows)
    count = Counter(tuple(t[:d]) for t in hand.values() for d in range(1, len(t) + 1))
    single = sum(1 for v in count.values() if v == 1)
    assert kinds[prefix_trie.MAYBE] <= sum(count.values()) - single + 5
    assert kinds[prefix_trie.TAIL] >= single - kinds[prefix_trie.FIRST] - 5 and kinds[prefix_trie.FIRST] <= 50 + 4


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# fill in the middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def arranged_by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted(v % (n + 1) for v in h[:2])
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_docs(spark):
    texts = ["", None, "x", "é", "one two", "<P> here", "a<M", "<<S", "S>P>M>", "<", "a\r\nb\x00c", "日本 語", "<|endoftext|>", prose(2, 300), "end<S>"]
    texts += [t + " " + str(i) for i, t in enumerate(["<P", "P>", "<S <M", "wörd"] * 20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "é"), (-4, "minus")]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, form int, output string")


@pytest.mark.parametrize("make", [awkward_docs, no_docs, fim_docs])
def test_arrangements_match_brute_force_and_come_back(spark, make):
    docs = make(spark)
    out = fim.arrange(docs)
    got = Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["output_sha256"]) for r in out.collect())
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    hand = [(i, *arranged_by_hand(i, t)) for i, t in rows]
    assert got == Counter((*h, hashlib.sha256(h[-1].encode()).hexdigest()) for h in hand)
    back = Counter((r["doc_id"], r["text"], r["restored_sha256"]) for r in fim.restore(out, ["doc_id"]).collect())
    assert back == Counter((i, t or "", hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


def test_descriptors_describe_the_output(spark):
    docs = fim_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in fim.arrange(docs).collect():
        buffers = (texts[r["doc_id"]], fim.SENTINELS)
        assert b"".join(buffers[p["buffer"]][p["start"]:p["start"] + p["length"]] for p in r["pieces"]) == r["output"].encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=list("aZ<>PSM é\n"), max_size=30), st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm"]))
def test_any_cut_is_undone(text, p, q, form):
    raw = memoryview(text.encode())
    if any(s in text for s in ("<P>", "<S>", "<M>")):
        return
    p, q = sorted((p % (len(raw) + 1), q % (len(raw) + 1)))
    table = fim.PieceTable(raw)
    table.cut(0, p)
    table.cut(1, q - p)
    out = table.arranged(fim.ORDERS[form])
    written = b"".join(out.parts())
    assert out.sha256() == hashlib.sha256(written).hexdigest() and len(out) == len(written)
    assert b"".join(fim.parse(memoryview(written), form).parts()) == bytes(raw)


def test_cut_of_a_very_long_text(spark):
    text = " ".join(prose(i, 3000) for i in range(450)) + "ß"
    assert len(text) > 4 * fim.BLOCK
    docs = spark.createDataFrame([(i, text[i:]) for i in range(5)], "doc_id long, text string")
    want = {(i, *arranged_by_hand(i, text[i:])) for i in range(5)}
    assert {(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in fim.arrange(docs).collect()} == want


@pytest.mark.parametrize("name", ["op12_prefix_trie", "op13_fill_in_middle"])
def test_new_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = entry_points.queries()[name](spark, SF)
    want = con.sql(entry_points.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    picked = sorted(want.columns)
    assert Counter(tuple(r) for r in got.select(*picked).collect()) == Counter(con.sql(f"SELECT {', '.join(picked)} FROM want").fetchall())
