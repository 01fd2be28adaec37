"""URL filters: rules by host and path, and decisions propagated over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import named
from corpusloom.llm.components import components
from corpusloom.session import materialise

#: verdict, host, path
Rule = tuple[str, str, str]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?i)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def same_page(url: Column) -> Column:
    """The url without what never changes the page served: fragment, tracking parameters, case of the host."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    query = F.regexp_extract(bare, r"(?s)\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(?i:utm_\w+|gclid|fbclid)(=|$)")), "&")
    scheme = F.lower(F.substring_index(bare, "://", 1))
    page = F.concat(scheme, F.lit("://"), host(bare), path(bare), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(F.contains(bare, F.lit("://")), page).otherwise(bare)


def decoded(target: Column) -> Column:
    """A link as written in HTML without the entities that urls contain; ``&amp;`` last, so that nothing is decoded twice."""
    for entity, mark in ((r"&(?:quot|#34|#[xX]22);", '"'), (r"&(?:#39|#[xX]27|apos);", "'"), (r"&(?:lt|#60|#[xX]3[cC]);", "<"), (r"&(?:gt|#62|#[xX]3[eE]);", ">")):
        target = F.regexp_replace(target, entity, mark)
    return F.regexp_replace(target, r"&(?:amp|#38|#[xX]26);", "&")


def without_dots(whole: Column) -> Column:
    """A path in which ``.`` and ``..`` are resolved."""
    steps = F.split(whole, "/")
    last = F.element_at(steps, -1)
    ended = F.when(last.isin(".", ".."), F.array_append(steps, F.lit(""))).otherwise(steps)
    none = F.array().cast("array<string>")
    up = lambda done: F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
    walked = F.aggregate(ended, none, lambda done, x: F.when(x == ".", done).when(x == "..", up(done)).otherwise(F.array_append(done, x)))
    return F.array_join(walked, "/")


def resolved(target: Column, url: Column) -> Column:
    """The url that a link on the page ``url`` means; null if it is empty, a fragment, or no link to a page."""
    scheme = F.concat(F.substring_index(url, "://", 1), F.lit(":"))
    site = F.concat(scheme, F.lit("//"), host(url))
    own = F.when(path(url) == "", "/").otherwise(path(url))
    bare, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(own, r"(?s)^(.*/)", 1)
    full = (
        F.when((target == "") | target.startswith("#"), F.lit(None).cast("string"))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(site, without_dots(bare), rest))
        .when(target.startswith("?"), F.concat(site, own, rest))
        .otherwise(F.concat(site, without_dots(F.concat(folder, bare)), rest))
    )
    return F.when(F.contains(url, F.lit("://")), full)


def alias_edges(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", redirects: DataFrame | None = None
) -> DataFrame:
    """``a, b``: every url and its plain form, and every url and the targets of its page's canonical links and refresh redirects.

    ``redirects`` (``source, target``: urls, the target as the server sent it) adds an edge per row. Entities are
    decoded, and relative targets completed from the page's url. Null urls, and targets that are empty,
    fragments or no pages (``mailto:``), give no edge; neither do relative targets of a url without ``://``.
    """
    url, html = named(url_col).cast("string"), F.coalesce(named(html_col).cast("string"), F.lit(""))
    declared = F.concat(*[F.regexp_extract_all(html, F.lit(pattern), 1) for pattern in (CANONICAL, REFRESH)])
    links = pages.select(url.alias("a"), F.transform(declared, decoded).alias("targets"))
    if redirects is not None:
        sent = redirects.select(named("source").cast("string").alias("a"), F.array(named("target").cast("string")).alias("targets"))
        links = links.unionByName(sent)
    a = F.col("a")
    targets = F.array_append(F.transform("targets", lambda t: same_page(resolved(t, a))), same_page(a))
    found = links.select("a", F.explode(targets).alias("b"))
    return found.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def best_rule(url: Column, rules: list[Rule]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, an allowing one first among equals; null fields if none does."""
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    result = none
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow"))
    for verdict, rule_host, rule_path in order:
        own = host(url)
        fits = ((own == rule_host) | own.endswith(f".{rule_host}")) & path(url).startswith(rule_path)
        chosen = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        result = F.when(fits, chosen).otherwise(result)
    return result


def url_verdicts(
    pages: DataFrame, edges: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row.

    The longest rule that fits a url decides it. All other urls take the decision of their
    component over ``edges`` (``a, b``: redirects and canonical links, undirected): allow if a rule
    allows any url of it, else block if a rule blocks one, else allow. Rules judge the ends of
    edges too, whether or not they are pages.

    Null urls have an empty host and path, no rule and the verdict allow. Repeated rows are each
    returned; empty edges leave the rules alone; other columns are ignored.
    """
    found = components(edges)
    judged = found.select("component", best_rule(F.col("node"), rules)["verdict"].alias("verdict")).dropna()
    decided = judged.groupBy("component").agg(F.min("verdict").alias("spread"))
    blocked = decided.where("spread = 'block'")
    spread = materialise(found.join(blocked, "component").select(F.col("node").alias("url"), "spread"), "verdicts")
    rows = pages.select(named(id_col).alias(id_col), named(url_col).cast("string").alias("url"))
    rows = rows.withColumn("best", best_rule(F.col("url"), rules))
    return rows.join(spread, "url", "left").select(
        id_col,
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "spread", F.lit("allow")).alias("verdict"),
    )
