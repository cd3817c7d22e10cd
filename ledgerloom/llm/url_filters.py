"""URL filters: rules by host and path, and block decisions carried over redirects and canonical links."""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, staged

#: (action, host, start of the path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TAGS = r"(?i)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?i)\brel\s*=\s*["']?canonical\b"""
HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
#: As in the SQL text; the operator reads the decoded content attribute by REFRESH_CONTENT.
REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>;]+)"""
#: Seconds, then the address: to the end, or in quotes. Semicolons belong to it.
REFRESH_CONTENT = r"""(?is)^\s*+[\d.]*+[\s;,]*+(?:url\s*=\s*)?+(?:"([^"]*)|'([^']*)|([^"'].*))"""
BASE = r"(?is)<base\b[^>]*>"
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"
REFERENCE = r"(?s)&#0*[0-9]{1,7}(?![0-9]);?|&#[xX]0*[0-9a-fA-F]{1,6}(?![0-9a-fA-F]);?|&[a-zA-Z][a-zA-Z0-9]*;|&amp(?![=a-zA-Z0-9])|&|[^&]+"
NAMED = json.dumps({name[:-1]: text for name, text in html5.items() if name.endswith(";")})


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of action and rule; null if none does. Rules are a parameter that the
    driver holds, some thousands at most."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    chain = [
        F.when(
            ((host == own) | host.endswith("." + own)) & path.startswith(start),
            F.struct(F.lit(action).alias("action"), F.lit(own + start).alias("rule")),
        )
        for action, own, start in longest_first
    ]
    return F.coalesce(*chain, F.lit(None).cast("struct<action:string,rule:string>"))


def address(url: Column) -> Column:
    """What tells a page: host, path without a slash at the end, and query; null without ``://``. Scheme and fragment
    do not count."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), F.rtrim(path_of(url), F.lit("/")), query))


def decoded(text: Column) -> Column:
    """A text with its character references replaced; unknown ones stay."""
    names = F.from_json(F.lit(NAMED), "map<string,string>")

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^&([a-zA-Z][a-zA-Z0-9]*)", 1)
        hexadecimal = piece.rlike("^&#[xX]")
        digits = F.regexp_extract(piece, r"^&#[xX]?([0-9a-fA-F]+)", 1)
        code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(F.regexp_extract(digits, "^[0-9]+", 0), 10, 10)).cast("long")
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return (
            F.when(piece.rlike("^&#[0-9xX]"), character)
            .when(name != "", F.coalesce(F.try_element_at(names, name), piece))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(pieces, one), "")).otherwise(text)


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, its references not yet decoded; empty without one."""
    value = F.regexp_extract(tag, rf"""(?i)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|["']?[^\s"'>]+)""", 1)
    return F.btrim(value, F.lit("\"'"))


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, with its ``.`` and ``..`` segments worked out."""
    parts = F.split(path, "/")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        empty,
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    end = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)


def resolved(link: Column, url: Column) -> Column:
    """An absolute form of a link on a page: relative ones are merged with the page's path or query. Null if the page's
    url has no ``://``."""
    scheme = F.regexp_extract(url, r"^((?s:.*?)://)", 1)
    own = path_of(url)
    path, tail = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*((?s:.*))", 1)
    folder = F.when(own == "", "/").otherwise(F.regexp_extract(own, r"^((?s:.*)/)", 1))
    merged = (
        F.when(path == "", own).when(path.startswith("/"), without_dots(path)).otherwise(without_dots(F.concat(folder, path)))
    )
    query = F.when(link.startswith("#"), F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)).otherwise("")
    return (
        F.when(link.rlike(SCHEME), link)
        .when(F.instr(url, "://") == 0, F.lit(None))
        .when(link.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), link))
        .otherwise(F.concat(scheme, host_of(url), merged, query, tail))
    )


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """These columns, computed once per row: behind a generator the optimiser does not write their expressions into each
    place that uses them, which would make a plan many times its size."""
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(F.explode(F.array(row)).alias("row")).select("row.*")


def link_edges(pages: DataFrame) -> DataFrame:
    """``(url, target)``: redirects by ``<meta http-equiv=refresh>`` and canonical links of every page. Relative ones
    start from the page's first ``<base href>``, else from its url."""
    tags = F.regexp_extract_all("html", F.lit(TAGS), F.lit(0))
    found = F.filter(tags, lambda t: t.rlike(CANONICAL) | t.rlike(REFRESH))
    bases = F.filter(F.regexp_extract_all("html", F.lit(BASE), F.lit(0)), lambda t: t.rlike(HREF))
    rows = pages.select("url", F.when(F.size(found) > 0, F.get(bases, F.lit(0))).alias("base"), F.explode(found).alias("tag"))
    canonical = F.col("tag").rlike(CANONICAL)
    raw = F.when(canonical, attribute(F.col("tag"), "href")).otherwise(attribute(F.col("tag"), "content"))
    both = F.transform(F.array(raw, F.trim(attribute(F.col("base"), "href"))), decoded)
    rows = settled(rows, url=F.col("url"), canonical=canonical, both=both)
    rows = rows.select("url", "canonical", F.col("both")[0].alias("raw"), F.col("both")[1].alias("base"))
    refresh = F.concat(*[F.regexp_extract("raw", REFRESH_CONTENT, i) for i in (1, 2, 3)])
    start = F.when(F.col("base") != "", resolved(F.col("base"), F.col("url"))).otherwise(F.col("url"))
    link = F.btrim(F.when(F.col("canonical"), F.col("raw")).otherwise(refresh), F.lit(" \t\n\f\r"))
    links = settled(rows, url=F.col("url"), start=start, link=link)
    target = F.when(F.col("link") != "", resolved(F.col("link"), F.col("start")))
    return settled(links, url=F.col("url"), target=target).filter("target is not null")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins and decides. Pages
    without a rule take the decision of their aliases: addresses connected by redirects, canonical links or
    ``redirects(url, target)``. If a rule allows any alias, that is ``allow``; else if a rule blocks any, ``block``;
    else ``allow``. Targets that are no page themselves count as aliases too.

    A null url or one without ``://`` has an empty host and path, no rule, no alias and is allowed; null html has no
    links. Repeated rows give repeated results, an empty table an empty result; other columns are not read.
    """
    narrow = pages.select("page_id", "url")
    edges = link_edges(pages.select("url", "html"))
    if redirects is not None:
        edges = edges.union(redirects.select("url", "target"))
    edges = settled(edges, a=address(F.col("url")), b=address(F.col("target")), target=F.col("target"))
    edges = staged(edges.filter("a is not null and b is not null").distinct(), "links")
    parts = components(edges.select("a", "b"))

    def ruled(df: DataFrame, url: str) -> DataFrame:
        both = df.select(address(F.col(url)).alias("node"), host_of(F.col(url)).alias("h"), path_of(F.col(url)).alias("p"))
        return both.select("node", rule_of(F.col("h"), F.col("p"), rules)["action"].alias("action")).filter("action is not null")

    decided = ruled(narrow, "url").union(ruled(edges, "target"))
    by_part = (
        parts.join(decided.groupBy("node").agg(F.min("action").alias("action")), "node")
        .groupBy("component")
        .agg(F.min("action").alias("alias_action"))  # allow sorts before block
    )
    carried = parts.join(by_part, "component").select(F.col("node").alias("_node"), "alias_action")
    own = narrow.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address(F.col("url")).alias("_address")
    ).withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    return own.join(carried, F.col("_address") == F.col("_node"), "left").select(
        "page_id",
        "host",
        "path",
        F.col("_rule")["rule"].alias("rule"),
        F.coalesce(F.col("_rule")["action"], F.col("alias_action"), F.lit("allow")).alias("verdict"),
    )


def _sql_text(text: str) -> str:
    return text.replace("'", "''")


def _sql_rule(part: int) -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    cases = " ".join(
        f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(a, h + p)[part]}'" for a, h, p in ordered
    )
    return f"CASE {cases} END"


ORACLE = rf"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(coalesce(html, ''), '{TAGS}')) AS tag FROM pages),
links AS (
  SELECT url, replace(CASE WHEN regexp_matches(tag, '{_sql_text(CANONICAL)}') THEN regexp_extract(tag, '{_sql_text(HREF)}', 1)
                           ELSE regexp_extract(tag, '{_sql_text(REFRESH_URL)}', 1) END, '&amp;', '&') AS link
  FROM tags WHERE regexp_matches(tag, '{_sql_text(CANONICAL)}') OR regexp_matches(tag, '{_sql_text(REFRESH)}')),
targets AS (
  SELECT url, CASE WHEN contains(link, '://') THEN link
                   WHEN starts_with(link, '//') THEN regexp_extract(url, '^((?s:.*?):)//', 1) || link
                   WHEN starts_with(link, '/') THEN regexp_extract(url, '^((?s:.*?)://[^/?#]*)', 1) || link END AS target
  FROM links WHERE link <> ''),
urls AS (SELECT url FROM pages UNION SELECT target FROM targets WHERE target IS NOT NULL),
parts AS (
  SELECT url, lower(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM urls),
known AS (
  SELECT *, CASE WHEN contains(url, '://')
                 THEN host || rtrim(path, '/') || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) END AS node,
         {_sql_rule(0)} AS action, {_sql_rule(1)} AS rule
  FROM parts),
edges AS (
  SELECT DISTINCT a.node AS a, b.node AS b FROM targets t JOIN known a ON t.url = a.url JOIN known b ON t.target = b.url
  WHERE a.node <> b.node),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (
  SELECT a AS node, a AS other FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
carried AS (
  SELECT r.node, min(k.action) AS action FROM reach r JOIN known k ON r.other = k.node WHERE k.action IS NOT NULL GROUP BY r.node)
SELECT p.page_id, k.host, k.path, k.rule, coalesce(k.action, c.action, 'allow') AS verdict
FROM pages p JOIN known k ON p.url IS NOT DISTINCT FROM k.url LEFT JOIN carried c ON k.node = c.node
"""
