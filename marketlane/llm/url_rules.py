"""Allow and block rules for URLs, and their spread over redirects.

A rule names a host, with all its subdomains, and the start of a path; the longest rule
that fits decides. Canonical links and refresh redirects found in pages, and redirects
given from elsewhere, join URLs into components. A URL without a rule of its own takes
its component's: allow if any member is allowed by a rule, else block if any is blocked,
else allow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.llm.common import stored
from marketlane.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: Rules are written into the plan; longer lists belong in a table joined by host.
MOST_RULES = 1000

# Tags that name another URL for a page. Attribute values may be quoted
# with either sign or not at all.
TAG = r"(?i)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?i)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash; A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fitting(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Text of the longest fitting rule, else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} can be written into a plan")
    text = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # the longest stands outermost
        fits = F.endswith(F.concat(F.lit("."), host), F.lit("." + rule.host)) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
    return text


def _verdict(text: str, rules: tuple[Rule, ...]) -> Column:
    """The verdict of a rule by its text; of equal texts the allowing one."""
    told = {r.text: r.verdict for r in sorted(rules, key=lambda r: r.verdict, reverse=True)}
    pairs = [F.lit(x) for pair in told.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(text)) if pairs else F.lit(None).cast("string")


URL_PARTS = r"(?s)^(.*?)://([^/?#]*)([^#]*)"


def same_place(url: Column) -> Column:
    """The URL as a node: scheme and host in lower case, no fragment; null without ``://``."""
    front = F.translate(F.concat(F.regexp_extract(url, URL_PARTS, 1), F.lit("://"), F.regexp_extract(url, URL_PARTS, 2)), _UPPER, _LOWER)
    tail = F.regexp_extract(url, URL_PARTS, 3)
    slash = F.when(F.startswith(tail, F.lit("/")), "").otherwise("/")
    return F.when(F.contains(url, F.lit("://")), F.concat(front, slash, tail))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst``: URLs that pages name as their canonical one or send readers to.

    A link is resolved against its page: absolute, of the same scheme, host or folder.
    """
    tags = F.regexp_extract_all(html, F.lit(TAG), F.lit(0))
    found = pages.select(F.col(url).alias("src"), F.explode(tags).alias("tag"))
    link = F.when(F.regexp_like("tag", F.lit(CANONICAL)), F.regexp_extract("tag", HREF, 1)).when(
        F.regexp_like("tag", F.lit(REFRESH)), F.regexp_extract("tag", REFRESH_URL, 1)
    )
    # Written before they are resolved: each part is then worked out once, in short code.
    found = stored(found.select("src", link.alias("link")).filter("link <> ''"), "raw-links")
    found = found.select(
        "src", F.replace(F.col("link"), F.lit("&amp;"), F.lit("&")).alias("to"),
        F.substring_index("src", "://", 1).alias("scheme"), host_of(F.col("src")).alias("host"), path_of(F.col("src")).alias("path"),
    )
    to, path = F.col("to"), F.col("path")
    root = F.concat("scheme", F.lit("://"), "host")
    folder = F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, r"[^/]*$", "")).otherwise("/")
    dst = (
        F.when(F.contains(to, F.lit("://")), to)
        .when(F.startswith(to, F.lit("//")), F.concat("scheme", F.lit(":"), to))
        .when(F.startswith(to, F.lit("/")), F.concat(root, to))
        .when(F.startswith(to, F.lit("#")), F.col("src"))
        .when(F.startswith(to, F.lit("?")), F.concat(root, path, to))
        .otherwise(F.concat(root, folder, to))
    )
    return stored(found.select("src", dst.alias("dst")), "links")


def judged(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None,
    key: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Every row of ``pages`` with ``page_id, host, path, rule, verdict, spread``.

    ``redirects`` may add edges (src, dst) beside those in the pages. ``spread`` says that
    the verdict came over a component. Null URLs, and URLs without ``://``, have an empty
    host and path, fit no rule and have no aliases: they are allowed. Null html names no
    link. Repeated rows are judged alike; other columns are ignored. A page whose
    component holds an explicit allow is allowed even if other members are blocked.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    text, verdict = _fitting(F.col("host"), F.col("path"), rules), _verdict("rule", rules)
    rows = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"), F.md5(same_place(F.col(url)).cast("binary")).alias("node"))
    rows = rows.withColumn("rule", text).withColumn("own", verdict)
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select("src", "dst"))
    ends = [F.md5(same_place(F.col(c)).cast("binary")).alias(n) for c, n in (("src", "a"), ("dst", "b"))]
    links = links.select("src", "dst", *ends).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = stored(links.distinct(), "url-links")
    groups = components(links)
    # Every named URL votes, whether or not it is a page here.
    named = links.select(F.col("src").alias("u"), F.col("a").alias("node")).union(links.select("dst", "b")).distinct()
    named = named.select("node", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    votes = named.withColumn("rule", text).withColumn("own", verdict).filter("own IS NOT NULL").select("node", "own").distinct()
    told = groups.join(votes, "node").groupBy("root").agg(F.min("own").alias("told"))  # allow < block
    told = stored(groups.join(told, "root").select("node", "told"), "url-verdicts")
    out = rows.join(told, "node", "left")
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", "told", F.lit("allow")).alias("verdict"),
        (F.col("own").isNull() & F.col("told").isNotNull()).alias("spread"),
    )


def _cases(rules: tuple[Rule, ...], pick: str) -> str:
    whens = [
        f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{getattr(r, pick)}'"
        for r in sorted(rules, key=lambda r: -len(r.text))
    ]
    return f"CASE {' '.join(whens)} END"


def _sql_parts(url: str) -> tuple[str, str, str]:
    """Rest, host and path of a URL column in DuckDB."""
    rest = f"CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"
    host = f"coalesce(translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '')"
    path = f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"
    return rest, host, path


def _sql_node(url: str) -> str:
    rest, host, _ = _sql_parts(url)
    scheme = f"translate(substr({url}, 1, strpos({url}, '://') - 1), '{_UPPER}', '{_LOWER}')"
    tail = f"regexp_extract({rest}, '^[^/?#]*([^#]*)', 1)"
    tail = f"CASE WHEN starts_with({tail}, '/') THEN {tail} ELSE '/' || {tail} END"
    return f"CASE WHEN strpos({url}, '://') > 0 THEN {scheme} || '://' || {host} || ({tail}) END"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def judged_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result in DuckDB; components by a recursive walk."""
    _, host, path = _sql_parts("url")
    _, base_host, base_path = _sql_parts("src")
    _, u_host, u_path = _sql_parts("u")
    scheme = "split_part(src, '://', 1)"
    folder = f"CASE WHEN contains({base_path}, '/') THEN regexp_replace({base_path}, '[^/]*$', '') ELSE '/' END"
    return f"""
WITH RECURSIVE tags AS (
  SELECT url AS src, unnest(regexp_extract_all(html, {_quoted(TAG)})) AS tag FROM pages
), named AS (
  SELECT src, CASE WHEN regexp_matches(tag, {_quoted(CANONICAL)}) THEN regexp_extract(tag, {_quoted(HREF)}, 1)
                   WHEN regexp_matches(tag, {_quoted(REFRESH)}) THEN regexp_extract(tag, {_quoted(REFRESH_URL)}, 1) END AS link FROM tags
), targets AS (
  SELECT src, replace(link, '&amp;', '&') AS t FROM named WHERE link <> ''
), links AS (
  SELECT src, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN {scheme} || ':' || t
    WHEN starts_with(t, '/') THEN {scheme} || '://' || {base_host} || t WHEN starts_with(t, '#') THEN src
    WHEN starts_with(t, '?') THEN {scheme} || '://' || {base_host} || {base_path} || t
    ELSE {scheme} || '://' || {base_host} || ({folder}) || t END AS dst FROM targets
), edges AS (
  SELECT DISTINCT src, dst, {_sql_node('src')} AS a, {_sql_node('dst')} AS b FROM links
), pairs AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
), reach AS (
  SELECT a AS node, a AS seen FROM pairs UNION SELECT reach.node, pairs.b FROM reach JOIN pairs ON reach.seen = pairs.a
), votes AS (
  SELECT node, {_cases(rules, 'verdict')} AS own FROM
    (SELECT node, {u_host} AS host, {u_path} AS path FROM
      (SELECT src AS u, a AS node FROM edges WHERE a <> b UNION SELECT dst, b FROM edges WHERE a <> b))
), told AS (
  SELECT reach.node, min(own) AS told FROM reach JOIN votes ON votes.node = reach.seen WHERE own IS NOT NULL GROUP BY reach.node
), rows AS (
  SELECT page_id, host, path, node, {_cases(rules, 'text')} AS rule, {_cases(rules, 'verdict')} AS own FROM
    (SELECT page_id, {host} AS host, {path} AS path, {_sql_node('url')} AS node FROM pages)
)
SELECT page_id, host, path, rule, coalesce(own, told, 'allow') AS verdict, own IS NULL AND told IS NOT NULL AS spread
FROM rows LEFT JOIN told ON rows.node = told.node
"""
