"""Tables with the awkward rows that every operator must take."""

import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, mixed int, stats int, removed string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall(text or "")


def prose(seed, n):
    """n words that look like a language of their own."""
    out, state = [], seed * 7919 + 1
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append("".join(chr(97 + (state >> s) % 26) for s in (3, 7, 11, 15)[: 2 + state % 3]))
    return " ".join(out)


def awkward_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, clashing extra columns."""
    long = prose(5, 30_000)
    base = prose(9, 120).split()
    near = [*base[:60], "changed", *base[61:]]
    rows = [
        (1, "One two three four five six. Seven eight nine ten", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
        (4, " \t\n\x0b\x0c\r ", "en", "b"), (5, long, "en", "a"), (6, "One two three four five six. Seven eight nine ten", "fr", "b"),
        (6, "One two three four five six. Seven eight nine ten", "fr", "b"), (7, "Ünï cödé wörd x", None, "b"),
        (8, " ".join(base), "en", "a"), (9, " ".join(near), "en", None), (10, "\n".join(["same line here", "Same  line here", "same line here", "x"]), "en", "a"),
        (11, "three words only", "en", "a"), (12, "Three Words ONLY", "en", "b"), (None, "no id here at all, but words enough to count", "en", "a"),
        (13, "a b c d e a b c d e", "en", "b"), (14, "<|endoftext|> # * $ % & | < >", "en", "b"),
    ]
    return spark.createDataFrame([(*r, None, "kept as it is", 7, None, "x") for r in rows], DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
