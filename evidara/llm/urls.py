"""URL filter: rules on host and path, and block decisions that follow redirects and canonical links.

Pages that redirect to each other or name each other as canonical are aliases.  The components of
the alias graph carry a block decision to every alias; an explicit allow goes before it.  All
of it is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.graph import components
from evidara.llm.common import ascii_lower, split_by_ids, stash

#: rules are sent to every task only up to this many
BROADCAST_RULES = 200_000

_TAG = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*"
_TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """Host and what follows it without the fragment: the node of a url in the alias graph; null without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest == "", F.lit("/")).otherwise(rest)
    return F.when(F.contains(url, F.lit("://")), F.concat(host(url), rest))


def without_dots(path: Column) -> Column:
    """A path from the root with its segments ``.`` and ``..`` worked off."""
    def step(done: Column, segment: Column) -> Column:
        return (F.when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
                .when(segment == ".", done).otherwise(F.concat(done, F.array(segment))))

    segments = F.split(path, "/")
    segments = F.when(path.rlike(r"/\.\.?$"), F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    worked = F.array_join(F.aggregate(segments, F.array().cast("array<string>"), step), "/")
    return F.when(F.contains(path, F.lit("/.")), worked).otherwise(path)


def absolute(link: Column, base: Column) -> Column:
    """A link of the page ``base`` as an address: absolute, scheme-relative, from the root of the host, or
    relative to the page's folder; null for a mere fragment and other schemes (``mailto:``)."""
    named = F.regexp_extract(link, r"(?s)^[^?#]*", 0)
    query = F.regexp_extract(link, r"(?s)^[^?#]*(\?[^#]*)", 1)
    here = F.when(path(base) == "", F.lit("/")).otherwise(path(base))
    target = (F.when(named.startswith("/"), named).when(named == "", here)
              .otherwise(F.concat(F.regexp_extract(here, "(?s)^.*/", 0), named)))
    return (F.when(link.rlike(_SCHEME + "//"), address(link))
            .when(link.startswith("//"), address(F.concat(F.lit("http:"), link)))
            .when(~link.rlike(_SCHEME) & ~link.startswith("#"), address(F.concat(F.lit("http://"), host(base), without_dots(target), query))))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): addresses that a page (url, html) ties together by a canonical link or a refresh, all of its tags."""
    tagged = pages.where(F.contains(ascii_lower(F.col("html")), F.lit("canonical")) | F.contains(ascii_lower(F.col("html")), F.lit("refresh")))
    links = F.concat(F.transform(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0)), lambda t: F.regexp_extract(t, _HREF, 1)),
                     F.transform(F.regexp_extract_all("html", F.lit(_REFRESH), F.lit(0)), lambda t: F.regexp_extract(t, _TARGET, 1)))
    found = tagged.select("url", F.explode(links).alias("link")).where("link <> ''")
    found = found.withColumn("link", F.regexp_replace("link", "&(?:amp|#38|#[xX]26);", "&"))
    found = found.select(address(F.col("url")).alias("a"), absolute(F.col("link"), F.col("url")).alias("b"))
    return found.where("a is not null and b is not null and a <> b").distinct()


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path) with ``rule`` and ``said``: the longest of the rules (host, path, verdict)
    whose host is the url's host or a parent of it and whose path begins the url's path; nulls
    where none is.

    Every distinct host and path asks for its host and the parents of it by name, so the work grows
    with the labels of a host, not with the rules; the answers go back to the rows.
    """
    named = rules.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "verdict").dropDuplicates(["__host", "__path"])
    if named.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        named = F.broadcast(named)
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = urls.select("host", "path").distinct().select("host", "path", F.explode(parents).alias("__host")).join(named, "__host")
    best = asked.where(F.col("path").startswith(F.col("__path"))).groupBy("host", "path").agg(F.max(F.struct(
        (F.length("__host") + F.length("__path")).alias("n"), F.length("__host").alias("h"), F.concat("__host", "__path").alias("rule"), "verdict")).alias("best"))
    return urls.join(best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("said")), ["host", "path"], "left")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages`` (page_id, url, html).

    A page with a rule has the rule's verdict (``allow`` or ``block``; the longest rule wins, of
    two equally long ones that with the longer host).  A page without one is blocked if some
    alias of it, over any number of redirects and canonical links, has a blocking rule and none
    has an allowing one; else it is allowed.  Targets that are no page themselves count as
    aliases and meet the rules too.

    Null urls and urls without ``://`` have empty host and path, no rule and no alias.  Repeated
    rows are judged one by one; null html has no links; further columns are ignored.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", F.lower("verdict").alias("verdict"))
    edges = stash(alias_edges(pages.select("url", "html")))
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), address(F.col("url")).alias("address"))
    judged = match_rules(rows, rules)
    if not edges.isEmpty():
        group = stash(components(edges))
        nodes = group.select("component", F.concat(F.lit("http://"), "node").alias("url")).select("component", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
        said = match_rules(nodes, rules).groupBy("component").agg(
            F.max((F.col("said") == "block").cast("int")).alias("block"), F.max((F.col("said") == "allow").cast("int")).alias("allow"))
        bad = stash(group.join(said.where("block = 1 and coalesce(allow, 0) = 0"), "component").select(F.col("node").alias("address")))
        tied, free = split_by_ids(judged, bad, ["address"])
        judged = tied.withColumn("told", F.lit("block")).unionByName(free.withColumn("told", F.lit("allow")))
    else:
        judged = judged.withColumn("told", F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", "told").alias("verdict"))
