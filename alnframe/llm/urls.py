"""URL filters with SQL functions alone: host and path rules, and blocks that follow redirect and canonical links.

Urls that a redirect or a canonical link connects stand for one page. Their connected components take over a block from
any member; an allow rule on any member comes before that, and a url's own rule before both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .words import exchanged, fresh

#: (verdict, host, path)
Rule = tuple[str, str, str]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRACKING = r"(?i)(?<=[?&])(utm_[a-z]+|gclid|fbclid)=[^&]*&?"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>;]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def page_key(url: Column) -> Column:
    """Host, path and query without tracking parameters; null without a host. Scheme and fragment don't count."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, _TRACKING, ""), r"[?&]+$", "")
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), kept))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (host and path as text) and its verdict; null without one. A rule fits its host and
    all subdomains, if the path starts with the rule's. The list is a parameter of the job, not data."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) of canonical links and refresh redirects in the pages; relative targets are resolved."""
    found = pages.select(F.col(url).alias("url"), F.explode(F.array(
        F.regexp_extract(F.coalesce(F.col(html), F.lit("")), _CANONICAL, 1),
        F.regexp_extract(F.coalesce(F.col(html), F.lit("")), _REFRESH, 1))).alias("target")).filter("target <> '' AND url IS NOT NULL")
    t, site = F.col("target"), F.regexp_extract("url", r"(?s)^.*?://[^/?#]*", 0)
    return found.select("url", F.when(t.contains("://"), t).when(t.startswith("//"), F.concat(F.lit("http:"), t))
                        .when(t.startswith("/"), F.concat(site, t))
                        .otherwise(F.concat(F.regexp_extract("url", r"(?s)^.*?://[^/?#]*/?([^?#]*/)?", 0), t)).alias("target"))


def judge(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict (replacing columns of these names).

    ``edges`` (url, target) defaults to the links in the pages' html. The rule's verdict holds where one fits. Else a
    page whose component holds a url that a rule allows is allowed; else one whose component holds a blocked url is
    blocked; else ``default``. A null url, or one without ``://``, has empty host and path and no rule.
    """
    edges = links(pages, url) if edges is None else edges
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    name, own = fitting_rule(F.col("host"), F.col("path"), rules)
    pages = pages.withColumns({"rule": name, "verdict": own})
    ends = edges.select(page_key(F.col("url")).alias("u"), page_key(F.col("target")).alias("v"))
    member = components(ends)  # a key tells host and path, so a member's own rule needs no look at the pages
    spot = F.regexp_extract("node", r"(?s)^([^/?#]*)([^?#]*)", 1), F.regexp_extract("node", r"(?s)^([^/?#]*)([^?#]*)", 2)
    _, said = fitting_rule(*spot, rules)
    by = (member.withColumn("said", said).groupBy("component")
          .agg(F.max(F.when(F.col("said") == "allow", 2).when(F.col("said") == "block", 1).otherwise(0)).alias("_said")).filter("_said > 0"))
    key, said = fresh(pages, "_key"), fresh(pages, "_said")
    alias = exchanged(member.join(exchanged(by), "component").select(F.col("node").alias(key), F.col("_said").alias(said)))
    settled = pages.filter("verdict IS NOT NULL OR host = ''")
    open_ = pages.filter("verdict IS NULL AND host <> ''").withColumn(key, page_key(F.col(url))).join(alias, key, "left")
    open_ = open_.withColumn("verdict", F.when(F.col(said) == 2, "allow").when(F.col(said) == 1, "block")).drop(key, said)
    return settled.unionByName(open_).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
