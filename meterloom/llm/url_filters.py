"""URL filters whose block decisions reach a page's aliases through redirects and canonical links.

Rules name a host, with all its subdomains, and the beginning of a path; the longest rule that fits a url decides about it. A url
that no rule fits is judged by its aliases. Nodes are urls without what never names another page (scheme, default port, fragment,
utm_ parameters); edges are the canonical links and refresh redirects in pages' html, and any redirects given beside them. In
each connected component an explicit allow of any member takes precedence over blocks; else one block blocks all members that have no
rule of their own; else they are allowed. A target that is no page itself counts too, by the rule that fits it.

All is native: rules of a short list are one expression on each url, rules of a table are joined on the host's suffixes; edges are
read only from html that names them; components are distributed, and pages of a hot url meet their verdict through
`bounded_join`, by a checked broadcast or salted.

Edge cases: a null url, or one without ://, has an empty host and path, fits no rule, has no alias and is allowed. A path is empty if the url has
none: rules begin with / there, so none fits. Null html has no links. Comments and scripts are not read for links. Relative links
are resolved against the page's url; dot segments stay as written; links of other schemes (mailto:, data:) and to the page itself
are no edges. Very long texts are only searched. Ties between rules of one length go to allow. Repeated pages are rows of
their own, null or repeated ids too. An empty table gives no rows. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import columns, read_table, stored
from meterloom.llm.components import components
from meterloom.operators.spread import bounded_join

#: The query's rules: verdict, host, beginning of the path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Rules in an expression; more come as a table.
LISTED = 500

TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
UNREAD = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
CANONICAL = r"(?is)^<link\b[^>]*\srel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"
REFRESH = r"(?is)^<meta\b[^>]*\shttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?is)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
CONTENT = r"(?is)\scontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
TARGET = r"(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"']*)"
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """urls with host (A-Z lower-cased), path and query, empty where there is none.

    Steps are projections of their own here and below, and some are stored, so that no expression grows beyond what Spark compiles."""
    at = F.locate("://", F.col(url))
    after = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    stepped = urls.withColumn("after", F.coalesce(after, F.lit("")))
    host = F.regexp_extract("after", "^([^/?#]*)", 1)
    return stepped.select(
        *urls.columns,
        F.translate(host, string.ascii_uppercase, string.ascii_lowercase).alias("host"),
        F.regexp_extract("after", "^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract("after", r"^[^?#]*\?([^#]*)", 1).alias("query"),
    )


def with_node(parsed: DataFrame, name: str = "node") -> DataFrame:
    """parsed (host, path, query and others) with the url's node, null without a host, instead of the query."""
    bare = F.regexp_replace("host", r"\.?(:80|:443)?$", "")
    asked = F.substring(F.regexp_replace(F.concat(F.lit("&"), "query"), "&utm_[^&]*", ""), 2, 1 << 30)
    stepped = parsed.withColumns({"bare": bare, "asked": asked})
    whole = F.concat("bare", F.when(F.col("path") == "", "/").otherwise(F.col("path")), F.when(F.col("asked") == "", "").otherwise(F.concat(F.lit("?"), "asked")))
    kept = [c for c in parsed.columns if c != "query"]
    return stepped.select(*kept, F.when(F.col("bare") != "", whole).alias(name))


def resolved() -> Column:
    """The url that a page's link names (columns link, host, path), null if none or no web address; its scheme doesn't matter."""
    link, page = F.col("link"), F.concat(F.lit("http://"), "host")
    folder = F.coalesce(F.nullif(F.regexp_extract("path", "^(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when((link == "") | link.startswith("#") | (F.col("host") == ""), F.lit(None).cast("string"))
        .when(link.rlike(ABSOLUTE), link)
        .when(link.rlike(SCHEME), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(page, link))
        .when(link.startswith("?"), F.concat(page, "path", link))
        .otherwise(F.concat(page, folder, link))
    )


def decided(urls: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES) -> DataFrame:
    """urls (host, path and others) with rule and decision of the longest rule that fits, null if none does.

    rules: (verdict, host, path) tuples, LISTED at most, or a table of those columns of any size."""
    if isinstance(rules, DataFrame):
        return _joined(urls, rules)
    if len(rules) > LISTED:
        raise ValueError(f"{len(rules)} rules; give more than {LISTED} as a table")
    fits = [
        F.when(
            ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path)),
            F.struct(F.lit(len(host + path)).alias("size"), F.lit(verdict == "allow").alias("allow"), F.lit(host + path).alias("rule"), F.lit(verdict).alias("decision")),
        )
        for verdict, host, path in rules
    ]
    none = F.lit(None).cast("struct<size: int, allow: boolean, rule: string, decision: string>")
    best = F.array_max(F.array(*fits, none)).alias("best")
    return urls.select("*", best).select(*urls.columns, F.col("best.rule").alias("rule"), F.col("best.decision").alias("decision"))


def _joined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    places = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    given = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), "verdict")
    met = bounded_join(places.withColumn("suffix", suffix), given, ["suffix"], salt_by=["host", "path"]).filter(F.startswith("path", F.col("start")))
    rule = F.concat("suffix", "start")
    best = F.max(F.struct(F.length(rule).alias("size"), (F.col("verdict") == "allow").alias("allow"), rule.alias("rule"), F.col("verdict").alias("decision")))
    chosen = stored(met.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.decision"), "url-rules")
    return bounded_join(urls, chosen, ["host", "path"], "left")


def links(pages: DataFrame) -> DataFrame:
    """(url, target): the canonical links and refresh redirects of the pages' html."""
    named = pages.filter(F.col("html").rlike("(?i)canonical|refresh"))
    tag = F.explode(F.regexp_extract_all(F.regexp_replace("html", UNREAD, ""), F.lit(TAGS), F.lit(0)))
    tags = stored(named.select("url", tag.alias("tag")), "url-tags")

    def groups(pattern: str, n: int) -> Column:
        return F.concat(*(F.regexp_extract("tag", pattern, k + 1) for k in range(n)))

    canonical = tags.filter(F.col("tag").rlike(CANONICAL)).select("url", groups(HREF, 3).alias("raw"))
    refresh = tags.filter(F.col("tag").rlike(REFRESH)).select("url", groups(CONTENT, 2).alias("raw"))
    raw = canonical.unionByName(refresh.select("url", F.regexp_extract("raw", TARGET, 1).alias("raw")))
    linked = stored(with_parts(raw.withColumn("link", F.regexp_replace(F.trim("raw"), "(?i)&amp;", "&"))), "url-links")
    return linked.select("url", resolved().alias("target")).filter("target is not null")


def alias_edges(redirects: DataFrame) -> DataFrame:
    """(a, b): distinct pairs of nodes that are one page; redirects: url, target."""
    sources = stored(with_node(with_parts(redirects), "a").select("a", "target"), "url-sources")
    both = with_node(with_parts(sources, "target"), "b").select("a", "b")
    return both.filter("a is not null and b is not null and a != b").distinct()


def blocked_nodes(edges: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES) -> DataFrame:
    """(node) that its component blocks: a rule blocks one of its members and none is allowed."""
    edges = stored(edges, "url-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    judged = decided(with_parts(nodes.withColumn("x", F.concat(F.lit("x://"), "node")), "x").select("node", "host", "path"), rules)
    roots = components(edges)
    judged = judged.join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    labelled = stored(judged.select("node", F.coalesce("root", "node").alias("root"), "decision"), "url-nodes")
    verdicts = labelled.groupBy("root").agg(F.max((F.col("decision") == "allow").cast("int")).alias("allow"), F.max((F.col("decision") == "block").cast("int")).alias("block"))
    blocked = verdicts.filter((F.col("block") == 1) & (F.coalesce("allow", F.lit(0)) == 0)).select("root")
    return bounded_join(labelled, blocked, ["root"], "left_semi", salt_by=["node"]).select("node")


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """A row per page: page_id, host, path, rule, verdict; redirects: known ones beside those in html (url, target)."""
    pages = columns(pages, "page_id", "url", "html")
    found = links(pages)
    if redirects is not None:
        found = found.unionByName(columns(redirects, "url", "target"))
    blocked = stored(blocked_nodes(alias_edges(found), rules), "url-blocked").withColumn("blocked", F.lit(True))
    urls = with_node(with_parts(pages.select("page_id", "url"))).select("page_id", "host", "path", "node")
    judged = bounded_join(decided(urls, rules), blocked, ["node"], "left", salt_by=["page_id", "path"])
    verdict = F.coalesce(F.col("decision"), F.when(F.col("blocked"), "block"), F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op11_url_filters(spark, sf_dir) -> DataFrame:
    return url_verdicts(read_table(spark, sf_dir, "pages"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_parts(url: str, source: str, keep: str) -> str:
    after = f"coalesce(CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) END, '')"
    return f"""SELECT {keep}, translate(regexp_extract(after, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
        regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(after, '^[^?#]*\\?([^#]*)', 1) AS query
    FROM (SELECT *, {after} AS after FROM {source})"""


def _sql_key(source: str, keep: str) -> str:
    return f"""SELECT {keep}, CASE WHEN bare <> '' THEN bare || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN asked = '' THEN '' ELSE '?' || asked END END AS node
    FROM (SELECT *, regexp_replace(host, '\\.?(:80|:443)?$', '') AS bare, substr(regexp_replace('&' || query, '&utm_[^&]*', '', 'g'), 2) AS asked FROM ({source}))"""


def _sql_rule(column: str) -> str:
    return f"""(SELECT {column} FROM rules r WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
        ORDER BY length(r.host || r.path) DESC, r.verdict LIMIT 1)"""


SQL = f"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
parsed AS ({_sql_parts("url", "pages", "page_id, url, html")}),
tags AS (
    SELECT host, path, url, unnest(regexp_extract_all(regexp_replace(html, {_sql_text(UNREAD)}, '', 'g'), {_sql_text(TAGS)})) AS tag
    FROM parsed WHERE regexp_matches(html, '(?i)canonical|refresh')),
named AS (
    SELECT host, path, url, CASE
        WHEN regexp_matches(tag, {_sql_text(CANONICAL)}) THEN regexp_extract(tag, {_sql_text(HREF)}, 1) || regexp_extract(tag, {_sql_text(HREF)}, 2) || regexp_extract(tag, {_sql_text(HREF)}, 3)
        WHEN regexp_matches(tag, {_sql_text(REFRESH)}) THEN
            regexp_extract(regexp_extract(tag, {_sql_text(CONTENT)}, 1) || regexp_extract(tag, {_sql_text(CONTENT)}, 2), {_sql_text(TARGET)}, 1) END AS raw
    FROM tags),
trimmed AS (SELECT *, regexp_replace(trim(raw, ' '), '(?i)&amp;', '&', 'g') AS link FROM named),
found AS (
    SELECT url, CASE WHEN link = '' OR starts_with(link, '#') OR host = '' THEN NULL
        WHEN regexp_matches(link, '{ABSOLUTE}') THEN link
        WHEN regexp_matches(link, '{SCHEME}') THEN NULL
        WHEN starts_with(link, '//') THEN 'http:' || link
        WHEN starts_with(link, '/') THEN 'http://' || host || link
        WHEN starts_with(link, '?') THEN 'http://' || host || path || link
        ELSE 'http://' || host || coalesce(nullif(regexp_extract(path, '^(.*/)', 1), ''), '/') || link END AS target
    FROM trimmed),
sources AS ({_sql_key(_sql_parts("url", "found", "url, target"), "target, host")}),
named_ends AS (SELECT node AS a, target FROM sources WHERE target IS NOT NULL),
ends AS ({_sql_key(_sql_parts("target", "named_ends", "a"), "a")}),
edges AS (SELECT DISTINCT a, node AS b FROM ends WHERE a IS NOT NULL AND node IS NOT NULL AND a <> node),
paired AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, a FROM paired UNION SELECT reach.a, paired.b FROM reach JOIN paired ON reach.b = paired.a),
members AS ({_sql_parts("x", "(SELECT DISTINCT b, 'x://' || b AS x FROM paired)", "b")}),
judged AS (SELECT b, {_sql_rule("r.verdict")} AS decision FROM members u),
aliases AS (
    SELECT reach.a AS node, coalesce(bool_or(decision = 'block'), false) AND NOT coalesce(bool_or(decision = 'allow'), false) AS blocked
    FROM reach JOIN judged ON reach.b = judged.b GROUP BY reach.a),
urls AS ({_sql_key("SELECT * FROM parsed", "page_id, host, path")}),
ruled AS (SELECT page_id, host, path, node, {_sql_rule("r.host || r.path")} AS rule, {_sql_rule("r.verdict")} AS decision FROM urls u)
SELECT page_id, host, path, rule, coalesce(decision, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN aliases USING (node)
"""
