"""URL filter by rules and redirect equivalence.

A rule decides for its host, all subdomains and every path under its own; the longest rule that fits wins.  Pages without a rule get
the decision of their aliases: connected components over redirect and canonical-link edges.  An explicitly allowed member
allows the component's pages without a rule, otherwise an explicitly blocked one blocks them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import written
from gridclear.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\??[^#]*)"
REFRESH = r"""(?is)<meta\s[^>]*http-equiv=["']?refresh["']?[^>]*[;\s]url=\s*["']?([^"'>\s]+)"""
CANONICAL = r"""(?is)<link\s[^>]*rel=["']?canonical["']?[^>]*\shref=["']?([^"'>\s]+)"""
CANONICAL_LATER = r"""(?is)<link\s[^>]*href=["']?([^"'>\s]+)["']?[^>]*\srel=["']?canonical\b"""


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str  # begins with a slash

    @property
    def name(self) -> str:
        return self.host + self.path


def part(url: Column, k: int) -> Column:
    """Scheme, host, path or query of an address; empty for null and without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, k)
    return F.translate(found, UPPER, LOWER) if k < 3 else found


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (name, action) of the longest rule that fits; of equal ones an allowing one; null if none fits.

    The rules are configuration and become one expression of the plan.
    """
    if not rules:
        return F.lit(None).cast("struct<name: string, action: string>")
    longest_first = sorted(rules, key=lambda r: (-len(r.name), r.action))
    chosen = F.when(F.lit(False), struct_of(longest_first[0]))
    for rule in longest_first:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = chosen.when(fits, struct_of(rule))
    return chosen


def struct_of(rule: Rule) -> Column:
    return F.struct(F.lit(rule.name).alias("name"), F.lit(rule.action).alias("action"))


def node_of(url: Column) -> Column:
    """The address without what never reaches a server: fragment, letter case of scheme and host, an empty path."""
    path = part(url, 3)
    return F.when(
        F.coalesce(url, F.lit("")).contains("://"),
        F.concat(part(url, 1), F.lit("://"), part(url, 2), F.when(path == "", "/").otherwise(path), part(url, 4)),
    )


def resolved(target: Column, url: Column) -> Column:
    """A link's target as a whole address."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    origin = F.concat(part(url, 1), F.lit("://"), part(url, 2))
    folder = F.regexp_replace(part(url, 3), r"[^/]*$", "")
    return (
        F.when(target == "", None)
        .when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(part(url, 1), F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): each page's address and the one that its refresh or its canonical link names."""
    html, url = F.coalesce(F.col("html"), F.lit("")), F.col("url")
    targets = F.array(*(resolved(F.regexp_extract(html, p, 1), url) for p in (REFRESH, CANONICAL, CANONICAL_LATER)))
    return (
        pages.select(node_of(url).alias("a"), F.explode(F.array_distinct(F.array_compact(targets))).alias("target"))
        .select("a", node_of(F.col("target")).alias("b"))
        .filter("a <> b")
    )


def judge_urls(pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, by) of each row of ``pages`` (page_id, url, html), whatever else it has.

    ``edges`` (a, b) are further redirects.  ``by`` tells what decided: ``rule``, ``alias`` or ``default``.  A null url, or one
    without ``://``, has empty host and path, fits no rule and has no alias; null html has no links.  Repeated rows are
    judged each for itself; an empty table gives no rows.
    """
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    links = alias_edges(pages)
    if edges is not None:
        links = links.unionAll(edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    members = connected_components(links)
    decided = members.withColumn("own", fitting_rule(part(F.col("node"), 2), part(F.col("node"), 3), rules)["action"])
    verdicts = decided.groupBy("component").agg(
        F.when(F.max(F.coalesce(F.col("own") == "allow", F.lit(False))), "allow")
        .when(F.max(F.coalesce(F.col("own") == "block", F.lit(False))), "block")
        .alias("alias")
    )
    aliases = written(members.join(verdicts, "component").filter("alias IS NOT NULL").select("node", "alias"), "aliases")
    found = pages.select(
        "page_id", part(F.col("url"), 2).alias("host"), part(F.col("url"), 3).alias("path"), node_of(F.col("url")).alias("node")
    ).withColumn("own", fitting_rule(F.col("host"), F.col("path"), rules))
    joined = found.join(aliases, "node", "left")
    return joined.select(
        "page_id", "host", "path", F.col("own.name").alias("rule"),
        F.coalesce(F.col("own.action"), F.col("alias"), F.lit(default)).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("alias").isNotNull(), "alias").otherwise("default").alias("by"),
    )
