"""Operator 7: URL rules whose block decisions reach the aliases of a blocked URL. DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, components

RULES_SCHEMA = "rule_host string, rule_path string, rule_verdict string"
_CANONICAL = (r"""(?is)<link\b(?=[^>]*\brel\s*=\s*(?:"[^">]*\bcanonical\b|'[^'>]*\bcanonical\b|canonical\b))"""
              r"""[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""")
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*['"]?([^"'\s>]+)"""


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES_SCHEMA)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def _authority(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*", 0)


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments; an empty one is the root."""
    parts = F.split(path, "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(
        x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    ended = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path == "", "/").when(F.contains(path, F.lit("/.")), F.array_join(ended, "/")).otherwise(path)


def node_of(url: Column) -> Column:
    """A URL as a node of redirect equivalence: scheme and host in lower case, dot segments resolved, without
    the fragment (a ``#`` before ``://`` begins none). Null without ``://``."""
    scheme = F.lower(F.substring_index(url, "://", 1))
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    node = F.concat(scheme, F.lit("://"), F.lower(_authority(url)), _without_dots(path_of(url)), query)
    return F.when(F.instr(url, "://") > 0, node)


def _resolved(url: Column, ref: Column) -> Column:
    """A link's target as an absolute URL."""
    scheme = F.substring_index(url, "://", 1)
    base = F.concat(scheme, F.lit("://"), _authority(url))
    folder = F.regexp_replace(F.concat(F.lit("/"), F.ltrim(path_of(url), F.lit("/"))), r"[^/]*$", "")
    return (F.when(F.instr(ref, "://") > 0, ref).when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
            .when(ref.startswith("/"), F.concat(base, ref)).when(ref.startswith("#"), url)
            .when(ref.startswith("?"), F.concat(base, path_of(url), ref)).otherwise(F.concat(base, folder, ref)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): nodes of a page's URL and of the target of each of its canonical links and refresh redirects."""
    none = F.array().cast("array<string>")
    refs = lambda p, word: F.when(F.col("html").ilike(f"%{word}%"), F.regexp_extract_all("html", F.lit(p), F.lit(1))).otherwise(none)
    links = F.concat(refs(_CANONICAL, "canonical"), refs(_REFRESH, "refresh"))
    found = pages.where(F.instr("url", "://") > 0).select("url", F.explode(links).alias("ref")).where("ref <> ''")
    target = _resolved(F.col("url"), F.replace("ref", F.lit("&amp;"), F.lit("&")))
    return found.select(node_of(F.col("url")).alias("a"), node_of(target).alias("b"))


def rule_of(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the ``places (host, path)`` that a rule fits: the longest one. Hosts meet the rules of
    their own name and of each parent domain by an equi-join, so rules may be many."""
    labels = F.split("host", r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cand = places.select("host", "path", F.explode(parents).alias("rule_host"))
    fit = cand.join(rules.distinct(), "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    # of equally long ones (the same rule with two verdicts) allow wins
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("rule_verdict") == "allow").alias("a"),
                          rule.alias("rule"), F.col("rule_verdict").alias("verdict")))
    return fit.groupBy("host", "path").agg(best.alias("m")).select("host", "path", "m.rule", "m.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """A verdict for every page: page_id, host, path, rule, verdict.

    A page's own longest rule decides, by host and path of its whole URL. Pages without one take part in redirect
    equivalence: URLs (see ``node_of``) are joined by canonical links (of any ``rel`` list) and refresh redirects, all of
    a page's, targets that are no pages included; in a component with a blocked URL and no explicitly
    allowed one, they are blocked. All others are allowed.

    Null URLs and URLs without ``://`` have empty host and path, fit no rule, have no alias and are allowed. Null html has no
    links. Long URLs and pages are read whole. Repeated rows are judged alike. Other columns are ignored. An empty table of
    pages gives no rows; one of rules allows all.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    edges = scratch.table(alias_edges(pages).where("a <> b").distinct())
    linked = components(edges, scratch)
    url, node = F.col("url"), F.col("node")
    here = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    linked = linked.select("node", "root", host_of(node).alias("host"), path_of(node).alias("path"))
    places = here.select("host", "path").union(linked.select("host", "path")).where("host <> ''").distinct()
    ruled = scratch.table(rule_of(places, rules))
    tone = linked.join(ruled, ["host", "path"]).groupBy("root").agg(
        (F.max(F.col("verdict") == "block") & ~F.max(F.col("verdict") == "allow")).alias("blocked"))
    blocked = linked.join(tone.where("blocked"), "root").select("node", "blocked")
    out = here.join(ruled, ["host", "path"], "left").join(blocked, "node", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("verdict", F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict"))
