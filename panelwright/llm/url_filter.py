"""URL rules with redirect equivalence, in DataFrame functions only.

A page without a rule of its own takes the block of any address that the site
itself declares to be the same: redirect and canonical-link edges are connected
into components, and a component with one blocked address blocks its members,
except those that a rule allows by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import lower_ascii
from panelwright.llm.graph import star_components
from panelwright.session import materialize


@dataclass(frozen=True)
class Rule:
    """``text`` is host, then path from its first slash, as in ``example.com/en/``."""

    text: str
    verdict: str  # "allow" or "block"

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


#: Query arguments that name a visitor's way to a page, not the page.
TRACKING = r"(?i)(?:^|&)(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does.

    One CASE per rule: the list is configuration, of the size a person writes.
    """
    chain_rule, chain_verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chain_rule = F.when(fits, rule.text).otherwise(chain_rule)
        chain_verdict = F.when(fits, rule.verdict).otherwise(chain_verdict)
    return chain_rule, chain_verdict


def address(url: Column) -> Column:
    """The name of a page as a node: no scheme, no fragment, lower-case host.

    Null without ``://``: such a url names no page.
    """
    host, _ = host_and_path(url)
    tail = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host, tail))


def canonical_address(node: Column) -> Column:
    """The same address without tracking arguments, ``.html`` and a last slash."""
    path = F.regexp_extract(node, r"(?s)^([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"\.html?$", ""), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(node, r"(?s)\?(.*)$", 1), TRACKING, "")
    query = F.regexp_replace(F.regexp_replace(query, "&{2,}", "&"), "^&|&$", "")
    return F.concat(path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


#: A scheme and two slashes at the start: an absolute target.
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments worked out; ``..`` never leaves the root."""
    segments = F.split(F.regexp_replace(path, r"(/\.{1,2})$", "$1/"), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"),
                       lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
                       .when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    return F.when(path.contains("/."), F.array_join(kept, "/")).otherwise(path)


def resolve(rows: DataFrame, target: str, base: str, out: str) -> DataFrame:
    """``rows`` with the declared ``target`` as an absolute url: as it is with a scheme, else against ``base``.

    Column by column: each step stands on the one before, without repeating it.
    """
    t, host, path, folder = (F.col(c) for c in (target, "_host", "_path", "_folder"))
    of_base = host_and_path(F.col(base))
    rows = rows.withColumns({"_host": of_base[0], "_path": of_base[1]})
    rows = rows.withColumn("_folder", F.regexp_extract("_path", r"(?s)^(.*/)", 1))
    root = F.concat(F.lit("http://"), host)
    whole = (F.when(t.rlike(ABSOLUTE), t)
             .when(t.startswith("//"), F.concat(F.lit("http:"), t))
             .when(t.startswith("/"), F.concat(root, t))
             .when(t.startswith("?"), F.concat(root, F.when(path == "", "/").otherwise(path), t))
             .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), t)))
    rows = rows.withColumn("_whole", whole)
    rows = rows.withColumns({"_front": F.regexp_extract("_whole", r"(?s)^(.*?://[^/?#]*)", 1),
                             "_inner": F.regexp_extract("_whole", r"(?s)^.*?://[^/?#]*([^?#]*)", 1),
                             "_rest": F.regexp_extract("_whole", r"(?s)^.*?://[^?#]*(.*)$", 1)})
    rows = rows.withColumn(out, F.concat(F.col("_front"), without_dots(F.col("_inner")), F.col("_rest")))
    return rows.drop("_host", "_path", "_folder", "_whole", "_front", "_inner", "_rest")


def declared_targets(pages: DataFrame) -> DataFrame:
    """(url, target): the absolute urls that pages (url, html) declare by canonical links and refresh redirects.

    Whole pages are searched, every such tag outside comments counts.  ``&amp;`` in a
    target is ``&``.  Relative targets are resolved against the page's first base
    address, or else its own, and ``.`` and ``..`` in their paths are worked out.
    """
    html = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<!--.*?(?:-->|$)", "")
    rows = pages.where(F.col("url").contains("://")).select("url", html.alias("html"))
    links = F.regexp_extract_all("html", F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))
    metas = F.regexp_extract_all("html", F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    hrefs = F.transform(links, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    jumps = F.transform(metas, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*['\"]?([^\"'\s>]+)", 1))
    named = F.regexp_extract("html", r"(?is)<base\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    plain = lambda t: F.regexp_replace(t, "(?i)&amp;", "&")
    found = F.filter(F.concat(hrefs, jumps), lambda t: (t != "") & ~t.startswith("#"))
    rows = rows.select("url", plain(named).alias("named"), found.alias("found")).where(F.size("found") > 0)
    rows = rows.select("url", "named", F.explode("found").alias("found")).withColumn("found", plain(F.col("found")))
    rows = resolve(rows, "named", "url", "base").withColumn("base", F.when(F.col("named") == "", F.col("url")).otherwise(F.col("base")))
    return resolve(rows, "found", "base", "target").select("url", "target")


def alias_edges(pages: DataFrame, syntactic: bool = False) -> DataFrame:
    """Edges (a, b) between addresses of ``pages`` (url, html) that name the same page.

    Redirects and canonical links found in the html; with ``syntactic`` also the
    canonical form that each address (page or target) has by its spelling.
    """
    targets = declared_targets(pages).select(address(F.col("url")).alias("a"), address(F.col("target")).alias("b"))
    if not syntactic:
        return targets
    named = pages.where(F.col("url").contains("://")).select(address(F.col("url")).alias("a")).unionByName(targets.select(F.col("b").alias("a")))
    return targets.unionByName(named.select("a", canonical_address(F.col("a")).alias("b")).where("a <> b"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], syntactic: bool = False) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, alias_blocked) for every row of ``pages``.

    ``pages`` needs page_id, url and html; other columns are ignored whatever
    their names.  The longest fitting rule decides.  Without one the verdict is
    block if the page's component of redirect and canonical-link edges holds a
    blocked address, else allow; a page that a rule allows stays allowed.  A null
    url, or one without ``://``, has empty host and path, no alias and is allowed
    unless a rule fits.  Repeated rows are judged alike; an empty table gives an
    empty result.  ``syntactic`` also takes addresses of one canonical spelling for
    one page, which no page declares.

    Edges, not pages, go through the component rounds, and only blocked addresses
    come back to be joined; adaptive execution splits a very frequent address.
    """
    pages = pages.select("page_id", "url", "html")
    edges = materialize(alias_edges(pages, syntactic).distinct(), "alias-edges")
    members = star_components(edges)
    host, path = host_and_path(F.concat(F.lit("://"), F.col("node")))
    _, verdict = matching_rule(host, path, rules)
    members = members.withColumn("blocked", F.coalesce(verdict == "block", F.lit(False)))
    bad = members.groupBy("component").agg(F.max("blocked").alias("any_blocked")).where("any_blocked")
    blocked = members.join(bad, "component", "left_semi").select(F.col("node").alias("address"), F.lit(True).alias("hit"))

    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"),
                          address(F.col("url")).alias("address"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", rule).withColumn("own", verdict)
    judged = judged.join(blocked, "address", "left")
    hit = F.coalesce(F.col("hit"), F.lit(False))
    return judged.select("page_id", "url", "host", "path", "rule",
                         F.coalesce("own", F.when(hit, "block").otherwise("allow")).alias("verdict"),
                         hit.alias("alias_blocked"))
