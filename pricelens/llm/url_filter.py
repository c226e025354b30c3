"""URL filters by rules and redirect equivalence, in DataFrame functions only.

A rule (verdict, host, path) fits its host and every subdomain when the page's
path starts with the rule's path; the longest host+path wins (ties: allow).
Pages are aliases when a canonical link, a meta refresh or a given redirect
joins them: connected components over those edges. A page with a rule takes the
rule's verdict. Any other page takes its component's: allow if a member has an
allow rule (explicit allow comes first), else block if a member has a block
rule, else allow.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import written
from pricelens.llm.components import components

#: Rules of the query: (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(after: Column) -> Column:
    return F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(after: Column) -> Column:
    return F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """Identity of a page: host, path (``/`` if empty) and query, without scheme and fragment."""
    after = rest(url)
    path = F.coalesce(F.nullif(path_of(after), F.lit("")), F.lit("/"))
    return F.when(after != "", F.concat(host_of(after), path, F.regexp_extract(after, r"^[^?#]*(\?[^#]*)?", 1))).otherwise(F.lit(""))


TAG = r"""(?is)<(?:link|meta)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, quoted or not; empty if there is none."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def plain(text: Column) -> Column:
    """Character references that occur in urls, decoded; blanks at both ends gone."""
    for pattern, sign in ((r"&quot;|&#34;", '"'), (r"&apos;|&#0*39;", "'"), (r"&#0*47;|&#[xX]0*2[fF];|&sol;", "/"), (r"(?i)&amp;|&#0*38;|&#x0*26;", "&")):
        text = F.regexp_replace(text, pattern, sign)
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def linked(html: Column) -> Column:
    """Targets of canonical links and meta refreshes in a page, as written but
    for character references; tags in comments and scripts do not count."""
    near = F.when(F.rlike(html, F.lit(r"(?i)canonical|refresh")), html).otherwise(F.lit(""))
    tags = F.regexp_extract_all(F.regexp_replace(near, NOT_MARKUP, " "), F.lit(TAG), F.lit(0))

    def target(tag):
        canonical = F.rlike(attribute(tag, "rel"), F.lit(r"(?i)(?:^|\s)canonical(?:\s|$)"))
        refresh = F.rlike(attribute(tag, "http-equiv"), F.lit(r"(?i)^\s*refresh\s*$"))
        url = F.regexp_extract(plain(attribute(tag, "content")), r"""(?is)^[\s\d.]*[;,\s]\s*url\s*=\s*["']?([^"']+)""", 1)
        return F.when(canonical, plain(attribute(tag, "href"))).when(refresh, plain(url))

    return F.filter(F.transform(tags, target), lambda t: t.isNotNull() & (t != ""))


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` parts worked off."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done).otherwise(F.concat(done, F.array(part))),
    )
    folder = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.rlike(path, F.lit(r"/\.\.?(/|$)")), F.concat(F.lit("/"), F.array_join(kept, "/"), folder)).otherwise(path)


def absolute(target: Column, host: Column, path: Column) -> Column:
    """A link's target seen from a page: ``//host/x``, ``/x``, ``x``, ``../x`` and
    ``?q`` are completed. Null for other schemes and places within the page."""
    site, page = F.concat(F.lit("http://"), host), F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))
    to_path, query = F.regexp_extract(target, r"^[^?#]*", 0), F.regexp_extract(target, r"^[^?#]*(\?[^#]*)?", 1)
    folder = F.regexp_replace(page, r"[^/]*$", "")
    return (
        F.when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.startswith(target, F.lit("#")) | F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")) | (host == ""), F.lit(None).cast("string"))
        .when(F.startswith(target, F.lit("/")), F.concat(site, without_dots(to_path), query))
        .when(to_path == "", F.concat(site, page, query))
        .otherwise(F.concat(site, without_dots(F.concat(folder, to_path)), query))
    )


def _rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the places that a rule fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    near = places.select("host", "path", F.explode(suffixes).alias("suffix"))
    r = rules.select(
        F.col("host").alias("suffix"),
        F.col("path").alias("rule_path"),
        F.struct(
            F.length(F.concat("host", "path")).alias("n"),
            F.when(F.col("verdict") == "allow", 1).otherwise(0).alias("first"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("verdict"),
        ).alias("r"),
    )
    fits = near.join(r, "suffix").where(F.startswith("path", "rule_path"))
    return fits.groupBy("host", "path").agg(F.max("r").alias("r")).select("host", "path", "r.rule", "r.verdict")


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """page_id, host, path, rule, verdict, one row per row of ``pages``.

    ``redirects``: (from_url, to_url). Null urls, or urls without ``://``: host
    and path empty, no rule, no links, allowed. Repeated rows stay; a null page
    text has no links; other columns are ignored; no pages give no rows.
    """
    cols = [F.col(page_id).alias("page_id"), F.col(url).alias("url")]
    after = rest(F.col("url"))
    base = pages.select(*cols, (F.col(html) if html else F.lit(None).cast("string")).alias("html")).select(
        "page_id", "url", host_of(after).alias("host"), path_of(after).alias("path"), node_of(F.col("url")).alias("node"), "html"
    )
    links = base.select("node", F.explode(linked(F.col("html"))).alias("t"), "host", "path").select(
        F.col("node").alias("a"), node_of(absolute(F.col("t"), F.col("host"), F.col("path"))).alias("b")
    )
    if redirects is not None:
        links = links.union(redirects.select(node_of(F.col("from_url")), node_of(F.col("to_url"))))
    links = written(links.where("a != b and a != '' and b != ''").distinct(), "url-links")

    base = base.drop("html")
    judged = _rules(base.where("host != ''").select("host", "path").distinct(), rules)
    out = base.join(judged, ["host", "path"], "left")
    if links.isEmpty():
        return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))

    comp = written(components(links, "a", "b"), "url-components")
    after = F.col("node")
    places = comp.select("node", "component", host_of(after).alias("host"), path_of(after).alias("path"))
    ruled = places.join(_rules(places.select("host", "path").distinct(), rules), ["host", "path"], "left")
    verdicts = ruled.groupBy("component").agg(
        F.when(F.max(F.col("verdict") == "allow"), "allow").when(F.max(F.col("verdict") == "block"), "block").alias("inherited")
    )
    inherited = comp.join(verdicts, "component").select("node", "inherited").where("inherited is not null")
    return out.join(inherited, "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "inherited", F.lit("allow")).alias("verdict")
    )


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS r(verdict, host, path)")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


def url_aliases(spark, sf_dir: str) -> DataFrame:
    """The operator with redirects from the data: of any three pages in a row
    the second leads to the first and the third to the second."""
    from pricelens.llm.common import table

    pages = table(spark, sf_dir, "pages")
    to = pages.select((F.col("page_id") + 1).alias("page_id"), F.col("url").alias("to_url"))
    redirects = pages.where(F.col("page_id") % 3 != 0).select("page_id", F.col("url").alias("from_url")).join(to, "page_id").drop("page_id")
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return filter_urls(pages, spark.sql(f"SELECT * FROM VALUES {values} AS r(verdict, host, path)"), redirects)


_PAGES_SQL = r"""
WITH RECURSIVE r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS query FROM u),
f AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
n AS (SELECT p.page_id, html, host, path, rule, verdict, CASE WHEN host || path || query = '' THEN '' ELSE host || coalesce(nullif(path, ''), '/') || query END AS node
  FROM p LEFT JOIN f ON f.page_id = p.page_id)"""
# links of the pages themselves: canonical links and refreshes, seen from the page (``..`` parts are worked off four deep)
_LINKS_SQL = r"""
tags AS (SELECT node, host, path, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>', ' ', 'g'),
    '(?is)<(?:link|meta)\b(?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag FROM n),
attr AS (SELECT node, host, path, regexp_extract(tag, '(?is)[\s"''/]rel\s*=\s*(["'']?[^"''>]*)', 1) AS rel,
    regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*"([^"]*)"', 1) || regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*''([^'']*)''', 1)
      || regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*([^\s"''>]+)', 1) AS href,
    regexp_matches(tag, '(?is)http-equiv\s*=\s*["'']?\s*refresh') AS refresh, regexp_extract(tag, '(?is)content\s*=\s*["'']?[\s\d.]*[;,\s]\s*url\s*=\s*["'']?([^"''>]+)', 1) AS url FROM tags),
seen AS (SELECT node, host, path, trim(regexp_replace(CASE WHEN regexp_matches(rel, '(?i)(^|["''\s])canonical($|["''\s])') THEN href WHEN refresh THEN url ELSE '' END, '(?i)&amp;', '&', 'g')) AS t FROM attr),
place AS (SELECT node, host, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN substr(t, instr(t, '://') + 3) WHEN starts_with(t, '//') THEN substr(t, 3)
    WHEN starts_with(t, '#') OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR host = '' THEN NULL
    WHEN starts_with(t, '/') THEN host || t WHEN starts_with(t, '?') THEN host || coalesce(nullif(path, ''), '/') || t
    ELSE host || regexp_replace(coalesce(nullif(path, ''), '/'), '[^/]*$', '') || t END AS rest FROM seen WHERE t <> ''),
flat AS (SELECT node, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(rest, '/\./', '/', 'g'), '/[^/?#]+/\.\./', '/'), '/[^/?#]+/\.\./', '/'), '/[^/?#]+/\.\./', '/'), '/[^/?#]+/\.\./', '/') AS rest FROM place),
own(a, b) AS (SELECT node, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || coalesce(nullif(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), ''), '/') || regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) FROM flat WHERE rest <> '')"""
# a page without a rule takes its component's: allow before block, else allow
_VERDICT_SQL = r"""
pair AS (SELECT a, b FROM link WHERE a <> '' AND b <> '' AND a <> b UNION SELECT b, a FROM link WHERE a <> '' AND b <> '' AND a <> b),
reach AS (SELECT a AS node, b AS other FROM pair UNION SELECT reach.node, pair.b FROM reach JOIN pair ON pair.a = reach.other),
met AS (SELECT DISTINCT other AS node, regexp_extract(other, '^[^/?#]*') AS host, regexp_extract(other, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
ruled AS (SELECT node, arg_max(verdict, length(rhost || rpath)) AS verdict FROM met JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY node),
inherited AS (SELECT reach.node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
  FROM reach JOIN ruled ON ruled.node = reach.other GROUP BY reach.node)
SELECT page_id, host, path, rule, coalesce(n.verdict, i.verdict, 'allow') AS verdict FROM n LEFT JOIN inherited i ON i.node = n.node
"""
OP6_SQL = f"{_PAGES_SQL},{_LINKS_SQL},\nlink AS (SELECT a, b FROM own),{_VERDICT_SQL}"
ALIASES_SQL = f"""{_PAGES_SQL},{_LINKS_SQL},
link AS (SELECT a, b FROM own UNION SELECT x.node, y.node FROM n x JOIN n y ON y.page_id = x.page_id - 1 WHERE x.page_id % 3 <> 0),{_VERDICT_SQL}"""
