"""URL filters: host and path rules, spread over redirect and canonical equivalence.

A page is one node with all spellings of its URL that sites redirect to one another (scheme,
``www.`` and ``m.``, default ports, fragments, tracking parameters, ``.html`` and closing
slashes). ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` of its HTML are edges to
other nodes. Nodes that reach each other are aliases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfgap.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Parameters that do not change the page, host labels of the same site.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
SAME_SITE = r"^(www|m)\."
DEFAULT_PORT = r":(80|443)$"
SAME_PAGE = r"(/index\.html|\.html|/)$"

_CANONICAL = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' for
    NULL and for text without ``://``."""
    found = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; '' as for ``host``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_key(url: Column) -> Column:
    """One text for all spellings of a URL; NULL for NULL, the text itself without ``://``."""
    rest = _after_scheme(url)
    site = F.regexp_replace(F.regexp_replace(host(url), SAME_SITE, ""), DEFAULT_PORT, "")
    page = F.regexp_replace(path(url), SAME_PAGE, "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING))
    key = F.concat(site, page, F.when(F.size(kept) > 0, F.lit("?")).otherwise(""), F.array_join(kept, "&"))
    return F.coalesce(key, url)


def links(pages: DataFrame) -> DataFrame:
    """``url`` and ``target`` for every canonical link and redirect in ``html``; targets are
    resolved against the page's URL."""
    html = F.coalesce(F.col("html"), F.lit(""))
    tags = F.concat(
        F.transform(
            F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(0)),
            lambda tag: F.regexp_extract(tag, _HREF, 1),
        ),
        F.transform(
            F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(0)),
            lambda tag: F.regexp_extract(tag, _REFRESH_URL, 1),
        ),
    )
    # A page without such words is not searched tag by tag.
    tags = F.when(html.rlike(r"(?i)canonical|http-equiv"), tags).otherwise(F.array().cast("array<string>"))
    found = pages.where(F.col("url").contains("://")).select("url", F.explode(tags).alias("href"))
    href = F.replace(F.col("href"), F.lit("&amp;"), F.lit("&"))
    scheme = F.substring_index("url", "://", 1)
    folder = F.regexp_replace(path(F.col("url")), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    target = (
        F.when(href.contains("://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.col("url"))
        .when(href.startswith("?"), F.concat(scheme, F.lit("://"), host(F.col("url")), path(F.col("url")), href))
        .when(href.startswith("/"), F.concat(scheme, F.lit("://"), host(F.col("url")), href))
        .otherwise(F.concat(scheme, F.lit("://"), host(F.col("url")), folder, href))
    )
    return found.where(F.col("href") != "").select("url", target.alias("target"))


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (action, host, path)."""
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def _labels(site: Column) -> Column:
    return F.length(site) - F.length(F.replace(site, F.lit("."), F.lit(""))) + 1


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url``, ``rule`` (host and path) and ``action`` of the longest rule that fits, for the
    distinct URLs that one fits.

    A rule fits its host and all subdomains, if the URL's path starts with the rule's. Of two
    equally long ones the allowing one wins. The joins are on (host suffix) and (host suffix, path
    prefix), so a host with many rules and many pages makes no pairs. A host is cut to as many
    labels as some rule has and no others, so the work grows with its length alone; the driver gets
    these few numbers of labels.
    """
    rules = rules.select("action", F.col("host").alias("at"), F.col("path").alias("prefix"))
    rules = rules.where(F.col("at").isNotNull() & F.col("prefix").isNotNull())
    lengths = rules.groupBy("at").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    depths = [r[0] for r in rules.select(_labels(F.col("at"))).distinct().collect()]
    site = host(F.col("url"))
    suffixes = F.array(
        *[F.when(_labels(site) >= n, F.substring_index(site, ".", -n)) for n in sorted(depths)]
    ).cast("array<string>")
    parts = urls.select("url").where(F.col("url").contains("://")).distinct()
    parts = parts.select("url", path(F.col("url")).alias("whole"), F.explode(suffixes).alias("at"))
    prefixes = parts.join(lengths, "at").select("url", "at", "whole", F.explode("lengths").alias("n"))
    prefixes = prefixes.where(F.col("n") <= F.length("whole")).select(
        "url", "at", F.expr("left(whole, n)").alias("prefix")
    )
    fitting = prefixes.join(rules, ["at", "prefix"])
    rule = F.concat("at", "prefix")
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("action") == ALLOW).alias("first"), rule.alias("rule"), "action"))
    return fitting.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.action")


def judge_pages(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    The verdict of a page that a rule fits is the rule's. A page without a rule is blocked if one
    of its aliases is blocked by a rule and none is allowed by one: an explicit allow goes first.
    Rules also judge link targets that are no pages themselves. Rows with a NULL url, or one
    without ``://``, have an empty host and path, no rule and no links, and are allowed unless an
    equal text is blocked. Hosts may have any number of labels. Repeated rows get the same verdict each; other columns are ignored.
    """
    pages = pages.select("page_id", "url", "html")
    found = links(pages)
    edges = found.select(
        canonical_key(F.col("url")).alias("a"), canonical_key(F.col("target")).alias("b")
    )
    aliases = connected_components(edges)
    targets = found.select(F.col("target").alias("url"))
    decided = match_rules(pages.select("url").unionAll(targets), rules)
    # What rules say of each class of aliases.
    classes = (
        decided.withColumn("node", canonical_key(F.col("url")))
        .join(aliases, "node", "left")
        .groupBy(F.coalesce("component", "node").alias("class"))
        .agg(F.min("action").alias("spread"))
    )  # 'allow' sorts before 'block'
    judged = pages.select("page_id", "url").join(decided, "url", "left")
    judged = judged.withColumn("node", canonical_key(F.col("url"))).join(aliases, "node", "left")
    judged = judged.withColumn("class", F.coalesce("component", "node")).join(classes, "class", "left")
    return judged.select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        "rule",
        F.coalesce("action", "spread", F.lit(ALLOW)).alias("verdict"),
    )
