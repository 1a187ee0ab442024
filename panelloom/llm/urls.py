"""URL filters with redirect equivalence, in DataFrame functions only.

Redirects (refresh headers in a page) and canonical links make urls aliases of each other.  Connected
components of these links carry a block decision to every alias that no rule names itself; an explicit
allow rule always wins for the urls that it names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.components import components
from panelloom.sources.sinks import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # host, path, "allow" or "block"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(url: Column) -> Column:
    """What two urls of one page share: host, path and query; null without a host."""
    query = F.regexp_extract(url, r"://[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def decide(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, allow first among equals; null where none fits."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "allow")):
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        best = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def absolute(href: Column, base: Column) -> Column:
    """A link as it stands in the page `base`: absolute, without scheme, from the root, or beside the page."""
    scheme = F.regexp_extract(base, "^([^:/?#]*)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(path_of(base), "^(.*/)", 1)
    return (F.when(href.contains("://"), href).when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(root, href))
            .when(href != "", F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), href)))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, quoted or not; empty if it has none."""
    found = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.trim(F.replace(F.regexp_replace(found, "^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&")))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): keys of a page and of its canonical link or its redirect, where they differ."""
    low = F.lower(html)
    rows = pages.select(F.col(url).alias("u"), F.col(html).alias("h")).where(low.contains("canonical") | low.contains("refresh"))
    tags = rows.select("u", F.explode(F.regexp_extract_all("h", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0)).alias("tag"))
    # Pages declare few links: written once, so that conditions on them are not pushed into the patterns.
    named = stage(tags.select("u", *[_attribute(F.col("tag"), name).alias(name) for name in ("rel", "href", "http-equiv", "content")]))
    canonical = F.when(F.array_contains(F.split(F.lower("rel"), r"\s+"), "canonical"), F.col("href"))
    refresh = F.when(F.lower("http-equiv") == "refresh", F.trim(F.regexp_extract("content", r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1)))
    targets = named.select("u", F.coalesce(canonical, refresh).alias("href")).where("href is not null")
    targets = stage(targets.select("u", absolute(F.col("href"), F.col("u")).alias("target")))
    return targets.select(key_of(F.col("u")).alias("a"), key_of(F.col("target")).alias("b")).where("a <> b")


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, alias) for every page.

    A rule fits its host and all subdomains, if the path starts with the rule's; the longest wins and `rule`
    names it.  Without a rule the page is blocked if any alias of its url is blocked by a rule (`alias` is the
    component's name), else allowed.  `redirects` (source, target) are more edges, as from a crawl's log.
    `rules` is a parameter, not data: it becomes part of the plan.

    A null url, or one without ://, has an empty host and path, fits no rule and has no alias: allow.  Null
    html has no links.  Repeated rows give repeated rows; other columns are ignored; an empty table gives no rows.
    """
    found = links(pages, url, html)
    if redirects is not None:
        found = found.unionByName(redirects.select(key_of(F.col("source")).alias("a"), key_of(F.col("target")).alias("b")).where("a <> b"))
    aliases = components(found)
    node_host, node_path = F.regexp_extract("node", "^([^/?#]*)", 1), F.regexp_extract("node", "^[^/?#]*([^?#]*)", 1)
    blocked = aliases.where(decide(node_host, node_path, rules)["verdict"] == "block").select("component").distinct()
    named = stage(aliases.join(blocked, "component", "left_semi").select("node", F.col("component").alias("alias")))
    own = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), key_of(F.col(url)).alias("node"))
    own = own.withColumn("own", decide(F.col("host"), F.col("path"), rules))
    return own.join(named, "node", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", F.when(F.col("alias").isNotNull(), F.lit("block")), F.lit("allow")).alias("verdict"), "alias")
