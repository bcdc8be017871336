"""URL rules, and block decisions that spread over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutlight.llm.graph import connected_components
from cutlight.llm.scratch import materialise

#: (verdict, host, path): a rule fits its host and all subdomains where the url's path starts with the rule's.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ://; empty if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def node_of(url: Column) -> Column:
    """The name under which links meet a url: host in lower case, an empty path as /, no fragment."""
    at = F.locate("://", url)
    scheme = F.translate(F.substring(url, F.lit(1), at - 1), _UPPER, _LOWER)
    path = path_of(url)
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(at > 0, F.concat(scheme, F.lit("://"), host_of(url), F.when(path == "", F.lit("/")).otherwise(path), query))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null. Rules are few, so they are part of the plan."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    table = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in ordered])
    return F.get(F.filter(table, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"])), 0)


_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_REL = r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"


def links_in(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): canonical links and meta-refresh redirects that pages state, as names of node_of.

    Links inside comments, scripts and styles don't count. Targets may be absolute, relative to the scheme, to the host or to the page.
    """
    html = F.col(html_col).cast("string")
    some = html.rlike(r"(?i)canonical|http-equiv\s*=\s*[\"']?refresh")
    bare = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)", "")
    tags = pages.where(some & F.col(url_col).contains("://")).select(F.col(url_col).alias("url"), F.explode(F.regexp_extract_all(bare, F.lit(_TAG), F.lit(0))).alias("tag"))
    href = F.regexp_extract("tag", r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", 0)
    href = F.regexp_replace(href, r"(?is)^href\s*=\s*[\"']?|[\"']$", "")
    to = F.regexp_extract("tag", r"(?is)\burl\s*=\s*['\"]?([^'\">]*)", 1)
    target = F.when(F.col("tag").rlike(_REL) & F.col("tag").rlike(r"(?i)^<link"), href).when(F.col("tag").rlike(_REFRESH), to)
    # explode keeps what it makes as a column: written into each other these expressions would grow without end
    tags = tags.select("url", F.explode(F.array(F.trim(F.regexp_replace(target, "&amp;", "&")))).alias("to"))
    scheme, host, path = F.regexp_extract("url", r"^(.*?)://", 1), host_of(F.col("url")), path_of(F.col("url"))
    full = (
        F.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(scheme, F.lit("://"), host, F.col("to")))
        .when(F.col("to") != "", F.concat(scheme, F.lit("://"), host, F.regexp_replace(path, r"[^/]*$", ""), F.when(path == "", F.lit("/")).otherwise(F.lit("")), F.col("to")))
    )
    return tags.select("url", F.explode(F.array(full)).alias("to")).select(node_of(F.col("url")).alias("src"), node_of(F.col("to")).alias("dst")).where("src is not null and dst is not null")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, alias_of.

    A url with a fitting rule takes the longest rule's verdict. Any other url takes that of its aliases, the urls that
    redirects (src, dst) and canonical links connect with it, over any number of steps: allow if a rule allows one of
    them explicitly, else block if a rule blocks one, else allow. alias_of is the component's least url (null without
    links). Null urls and urls without :// have empty host and path, no rule and no aliases: allow. Pages that repeat a url are judged alike.
    """
    spark = pages.sparkSession
    links = links_in(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        given = redirects.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst")).where("src is not null and dst is not null")
        links = given if links is None else links.union(given)
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"), node_of(url).alias("node"))
    rows = rows.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    links = materialise(links.where("src <> dst").distinct(), "links") if links is not None else None
    if links is None or links.isEmpty():
        known = spark.createDataFrame([], "node string, component string, shared string")
    else:
        parts = materialise(connected_components(links, "src", "dst"), "aliases")
        judged = parts.withColumn("own", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules))
        votes = judged.groupBy("component").agg(F.max((F.col("own.verdict") == "allow").cast("int")).alias("a"), F.max((F.col("own.verdict") == "block").cast("int")).alias("b"))
        votes = votes.select("component", F.when(F.col("a") == 1, "allow").when(F.col("b") == 1, "block").otherwise("allow").alias("shared"))
        known = parts.join(votes, "component").select("node", "component", "shared")
    known = known.withColumnRenamed("node", "of")
    out = rows.join(known, F.col("node") == F.col("of"), "left")
    return out.select("page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", "shared", F.lit("allow")).alias("verdict"), F.col("component").alias("alias_of"))


# Links are found with the patterns above; WITH RECURSIVE walks them from each url that a rule decides.
ORACLE = r"""
WITH RECURSIVE p AS (
  SELECT page_id, html, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, html, url, rest,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p
), n AS (
  SELECT *, CASE WHEN strpos(url, '://') > 0 THEN translate(split_part(url, '://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '://' || host
    || CASE WHEN path = '' THEN '/' ELSE path END || regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) END AS node FROM h
), r AS (
  SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) t(v, rh, rp)
), d AS (
  SELECT page_id, max_by(struct_pack(rule := rh || rp, verdict := v), length(rh || rp)) AS own
  FROM n JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
), tag AS (
  SELECT node, host, split_part(url, '://', 1) AS scheme, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?(-->|$)|<script\b.*?(</script\s*>|$)|<style\b.*?(</style\s*>|$)', '', 'g'), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM n WHERE regexp_matches(html, '(?i)canonical|http-equiv\s*=\s*["'']?refresh') AND node IS NOT NULL
), target AS (
  SELECT node, host, scheme, trim(replace(CASE WHEN regexp_matches(tag, '(?is)^<link.*\brel\s*=\s*["'']?[^"''>]*\bcanonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]*)', 1)
    WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)\burl\s*=\s*[''"]?([^''">]*)', 1) END, '&amp;', '&')) AS t FROM tag
), absolute AS (
  SELECT node AS a, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN scheme || ':' || t WHEN starts_with(t, '/') THEN scheme || '://' || host || t END AS u FROM target
), e AS (
  SELECT a, regexp_replace(u, '#.*$', '') AS b FROM absolute WHERE u IS NOT NULL
), twoway AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM twoway UNION SELECT reach.a, twoway.b FROM reach JOIN twoway ON reach.b = twoway.a),
vote AS (
  SELECT reach.a, bool_or(d.own.verdict = 'allow') AS yes, bool_or(d.own.verdict = 'block') AS no FROM reach JOIN n ON n.node = reach.b JOIN d USING (page_id) GROUP BY reach.a
)
SELECT n.page_id, n.host, n.path, d.own.rule AS rule, coalesce(d.own.verdict, CASE WHEN vote.yes THEN 'allow' WHEN vote.no THEN 'block' END, 'allow') AS verdict
FROM n LEFT JOIN d USING (page_id) LEFT JOIN vote ON vote.a = n.node
"""
