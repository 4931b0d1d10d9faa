"""URL filters by redirect equivalence (DataFrame functions only).

A page's url is first judged by the rule list: a rule fits its host and all subdomains when
the path starts with the rule's path, and the longest fitting rule wins.  Urls that no rule
fits take the verdict of their aliases.  Aliases are urls tied by

* a redirect: ``<meta http-equiv="refresh" content="0; url=...">``,
* a canonical link: ``<link rel="canonical" href="...">``,
* the same address but for the fragment, which never reaches a server.

Components of that graph are found with distributed large-star / small-star steps.  A
component in which some url (page or link target) is blocked by a rule is blocked, unless
one of its urls is explicitly allowed by a rule: allow has precedence.  A component no rule
touches is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsmith.llm.common import connected_components, stored

#: (action, host, path)
Rule = tuple[str, str, str]

RULES: list[Rule] = [("block", "net", "/"), ("allow", "example.net", "/en/"),
                     ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*'?([^\"'>\s]+)"
_CANONICAL = (r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*"
              r"[\"']?([^\"'>\s]+)")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_matches(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as struct(rule, action), or null.  Ties go to the earlier rule."""
    ordered = sorted(enumerate(rules), key=lambda r: (-len(r[1][1] + r[1][2]), r[0]))
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for _, (action, rule_host, rule_path) in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(action).alias("action"))).otherwise(found)
    return found


def _address(url: Column) -> Column:
    """The url without its fragment, with a lower-case scheme and host: the node of the graph."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?#]*)", 1)
    return F.concat(F.translate(head, _UPPER, _LOWER), F.substr(bare, F.length(head) + 1))


def _without_dots(path: Column) -> Column:
    """A path that begins with ``/`` without its ``.`` and ``..`` segments."""
    step = F.split(path, "/", -1)
    last = F.element_at(step, -1)
    kept = F.aggregate(F.slice(step, 2, F.size(step) - 1), F.array().cast("array<string>"), lambda done, x: F.when(
        x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(
        F.concat(done, F.array(x))))
    # a path that ends in a dot segment names a folder
    end = F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), end)


def resolved(url: Column, target: Column) -> Column:
    """The target of a link as seen from the page at ``url``; null where the page has no address.

    A target is absolute (``scheme://``, or another scheme, which is no address and gives null),
    or begins with ``//`` (the page's scheme), ``/`` (its host), ``?`` (its path) or ``#`` (the page), or is
    relative to the page's folder.  Dot segments are resolved in relative targets alone.
    """
    page = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    scheme = F.regexp_extract(page, r"(?s)^(.*?:)//", 1)
    head = F.regexp_extract(page, r"(?s)^(.*?://[^/?]*)", 1)
    path = F.regexp_extract(page, r"(?s)^.*?://[^/?]*([^?]*)", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    own = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.substr(target, F.length(own) + 1)
    inside = (F.when(target.startswith("//"), F.concat(scheme, target))
              .when(own.startswith("/"), F.concat(head, _without_dots(own), rest))
              .when(target.startswith("?"), F.concat(head, path, target))
              .when(own == "", F.concat(page, target))
              .otherwise(F.concat(head, _without_dots(F.concat(folder, own)), rest)))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(~target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") & (scheme != ""), inside))


def link_edges(pages: DataFrame) -> DataFrame:
    """(source, target) addresses of the redirects and canonical links that pages declare.

    Relative targets are resolved against the page; a page may declare several.
    """
    targets = F.array_distinct(F.concat(*[
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(p), 1) for p in (_REFRESH, _CANONICAL)]))
    # most pages declare nothing: a plain search for the words comes before the patterns
    declares = F.lower("html").contains("canonical") | F.lower("html").contains("refresh")
    return (pages.where(F.col("url").isNotNull() & declares)
            .select("url", F.explode(targets).alias("target"))
            .select("url", resolved(F.col("url"), F.regexp_replace("target", "&amp;", "&")).alias("target"))
            .where(F.col("target").isNotNull())
            .select(_address(F.col("url")).alias("source"), _address(F.col("target")).alias("target"))
            .where("source != target").distinct())


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has empty host and path, fits no rule, has no alias
    and is allowed.  Null html declares no link.  Repeated rows give repeated results; an
    empty table gives no rows; columns other than page_id, url and html are ignored.  Pages
    outside any declared link never enter a shuffle of the graph: only addresses that some
    link names do.
    """
    links = stored(link_edges(pages.select("url", "html")), "url-links")
    ends = links.select(F.col("source").alias("address")).union(
        links.select(F.col("target").alias("address"))).distinct()
    # 64-bit ids of the linked addresses; equal addresses share one
    nodes = ends.withColumn("node", F.xxhash64("address")).withColumn(
        "hit", rule_matches(host_of(F.col("address")), path_of(F.col("address")), rules))
    ids = links.select(F.xxhash64("source").alias("a"), F.xxhash64("target").alias("b"))
    parts = connected_components(ids)
    verdicts = (nodes.join(parts, "node").groupBy("component")
                .agg(F.max(F.col("hit.action") == "allow").alias("allows"),
                     F.max(F.col("hit.action") == "block").alias("blocks")))
    inherited = stored(parts.join(verdicts, "component").select(
        "node", F.when(F.coalesce("allows", F.lit(False)), "allow")
        .when(F.coalesce("blocks", F.lit(False)), "block").alias("alias_verdict")), "url-verdicts")

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = (pages.select("page_id", host.alias("host"), path.alias("path"),
                           F.xxhash64(_address(F.col("url"))).alias("node"))
              .withColumn("hit", rule_matches(F.col("host"), F.col("path"), rules)))
    return (judged.join(inherited, "node", "left")
            .select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce("hit.action", "alias_verdict", F.lit("allow")).alias("verdict")))
