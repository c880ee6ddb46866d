"""URL filters with redirect equivalence.

A rule (verdict, host, path) fits its host and all subdomains, if the url's path starts with the rule's; the longest
rule that fits wins. Pages without a rule get the decision of their aliases: urls are nodes, a page's canonical link and
its refresh redirect are edges, and distributed connected components carry a block to every alias.

Allow has precedence: a url that a rule allows stays allowed whatever its aliases are, and a component in which a rule
allows some url blocks none of the urls without a rule. Without any decision a page is allowed.

Two urls are the same node if host, path and query agree, after dot segments are removed and with `/` for an empty path:
the scheme and the fragment don't tell pages apart. All canonical and refresh tags of a page count; their links are resolved
by RFC 3986 against the page's url. Link targets are judged by the rules, too, whether or not their page is in the table.
OP6_SQL has a plainer reading of links, the same on pages whose links are absolute or simple paths.

Edge cases: a link of a scheme without `//` (mailto:) is no page; of the character references, `&amp;`, `&lt;`, `&gt;`, `&quot;`,
`&apos;` and ASCII numbers are decoded, the others stay as written; `<base>` isn't read; a null url, or one without `://`, has an empty host and path, no rule and no aliases; null html has no
links; repeated rows are judged each alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.components import components
from tickbars.llm.texts import stored

Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_HREF = r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_URL = r"""(?i)\burl\s*=\s*["']?\s*([^"'\s>]+)"""
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|" + "|".join(_NAMED) + ");"


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, r"^(?s:.*?)://([^/?#]*)"), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return _part(url, r"^(?s:.*?)://[^/?#]*([^?#]*)")


def without_dots(path: Column) -> Column:
    """The path with `/` if empty and its dot segments removed."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    # A path that ends in a dot segment is a folder.
    segments = F.when(path.rlike(r"/\.\.?$"), F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, one: F.when(one == ".", kept)
        .when(one == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .otherwise(F.concat(kept, F.array(one))),
        lambda kept: F.concat(F.lit("/"), F.array_join(kept, "/")),
    )
    return F.when(path == "", F.lit("/")).when(path.rlike(r"/\.\.?(/|$)"), kept).otherwise(path)


def node_of(url: Column) -> Column:
    """Host, path and query; null without a `://`."""
    query = _part(url, r"^(?s:.*?)://[^/?#]*[^?#]*(\?[^#]*)")
    return F.when(url.contains("://"), F.concat(host_of(url), without_dots(path_of(url)), query))


def judged(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, ruled) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule: string, ruled: string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("ruled"))).otherwise(found)
    return found


def unescaped(link: Column) -> Column:
    """The link with its character references decoded."""

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, _REFERENCE, 1)
        code = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7)).try_cast("int")
        char = F.when(code.between(1, 127), F.chr(code))
        for named, letter in _NAMED.items():
            char = F.when(name == named, F.lit(letter)).otherwise(char)
        return F.when(char.isNotNull(), F.concat(char, F.regexp_replace(part, "^[^;]*;", ""))).otherwise(F.concat(F.lit("&"), part))

    parts = F.split(link, "&")
    return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), decoded), ""))


def target_of(url: Column, link: Column) -> Column:
    """The link as an absolute url, its dot segments still in place; null if it leads to no other page."""
    scheme = F.regexp_extract(url, r"^(?s:.*?)://", 0)
    site = F.concat(scheme, _part(url, r"^(?s:.*?)://([^/?#]*)"))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (
        F.when((F.coalesce(link, F.lit("")) == "") | link.startswith("#"), F.lit(None))
        .when(link.rlike(r"^(?i)[a-z][a-z0-9+.-]*://"), link)
        .when(link.rlike(r"^(?i)[a-z][a-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("//"), F.concat(F.regexp_extract(scheme, "^[^/]*", 0), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, path_of(url), link))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def links_of(html: Column) -> Column:
    """The links of all canonical and refresh tags, decoded."""
    canonical = F.transform(F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(0)), lambda tag: F.regexp_extract(tag, _HREF, 1))
    refresh = F.transform(F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(0)), lambda tag: F.regexp_extract(tag, _URL, 1))
    return F.transform(F.concat(canonical, refresh), unescaped)


def filtered(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    url = F.col("url")
    targets = F.transform(links_of(F.col("html")), lambda link: target_of(url, link))
    targets = F.filter(F.transform(targets, node_of), lambda node: node.isNotNull())
    linked = pages.select(node_of(url).alias("u"), F.explode(targets).alias("v")).filter("u is not null and u != v")
    groups = components(linked, "url-filter")
    # A node is host, path and query: put a scheme before it and it is read like a url.
    named = F.concat(F.lit("http://"), F.col("node"))
    ruled = groups.withColumn("ruled", judged(host_of(named), path_of(named), rules)["ruled"])
    verdicts = ruled.groupBy("root").agg(F.bool_or(F.col("ruled") == "block").alias("blocks"), F.bool_or(F.col("ruled") == "allow").alias("allows"))
    blocked = groups.join(verdicts.filter("blocks and not coalesce(allows, false)"), "root").select(F.col("node").alias("alias"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")
    ).withColumn("judged", judged(F.col("host"), F.col("path"), rules))
    rows = rows.join(stored(blocked, "url-filter-blocked"), F.col("node") == F.col("alias"), "left")
    by_alias = F.when(F.col("alias").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", F.col("judged.rule").alias("rule"), F.coalesce("judged.ruled", by_alias).alias("verdict"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


OP6_SQL = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), parts AS (
    SELECT page_id, url, html, instr(url, '://') AS mark, substr(url, instr(url, '://') + 3) AS rest FROM pages
), read AS (
    SELECT page_id, url, html,
           CASE WHEN mark > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN mark > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
           CASE WHEN mark > 0 THEN regexp_extract(rest, '^[^/?#]*([^#]*)', 1) END AS tail
    FROM parts
), links AS (
    SELECT host || tail AS u,
           unnest([regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'i'), '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'i'),
                   regexp_extract(regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'i'), '\burl\s*=\s*["'']?([^"''\s>]+)', 1, 'i')]) AS link,
           host, path
    FROM read WHERE tail IS NOT NULL
), targets AS (
    SELECT u, CASE WHEN instr(link, '://') > 0 THEN substr(link, instr(link, '://') + 3)
                   WHEN link LIKE '//%' THEN link[3:]
                   WHEN link LIKE '/%' THEN host || link
                   ELSE host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || link END AS t
    FROM links WHERE link != ''
), edges AS (
    SELECT u, translate(regexp_extract(t, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(t, '^[^/?#]*([^#]*)', 1) AS v FROM targets
), sides AS (
    SELECT u, v FROM edges UNION SELECT v, u FROM edges
), reach(u, v) AS (
    SELECT u, u FROM sides UNION SELECT reach.u, sides.v FROM reach JOIN sides ON reach.v = sides.u
), verdicts AS (
    SELECT reach.u AS node, first(rules.verdict ORDER BY length(rules.host || rules.path) DESC) AS ruled, reach.v
    FROM reach LEFT JOIN rules
      ON (regexp_extract(reach.v, '^[^/?#]*') = rules.host OR ends_with(regexp_extract(reach.v, '^[^/?#]*'), '.' || rules.host))
     AND starts_with(regexp_extract(reach.v, '^[^/?#]*([^?#]*)', 1), rules.path)
    GROUP BY reach.u, reach.v
), blocked AS (
    SELECT node FROM verdicts GROUP BY node HAVING bool_or(ruled = 'block') AND NOT coalesce(bool_or(ruled = 'allow'), FALSE)
), fits AS (
    SELECT page_id, read.host, read.path, host_rule.verdict, host_rule.host || host_rule.path AS rule, read.host || read.tail AS node,
           row_number() OVER (PARTITION BY page_id ORDER BY length(host_rule.host || host_rule.path) DESC NULLS LAST) AS place
    FROM read LEFT JOIN rules AS host_rule
      ON (read.host = host_rule.host OR ends_with(read.host, '.' || host_rule.host)) AND starts_with(read.path, host_rule.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN node IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE place = 1
"""
