"""URL filter: host and path rules, and redirect equivalence for urls that no rule fits.

Pages name other urls for the same content by canonical links and refresh redirects, all of which count; they are read
on the page's own url (dot segments, queries and entities included). A further table of redirects may be given. Connected components of these edges are sets of aliases. A rule that fits a url
decides it, the longest one first. A url without a rule takes its set's decision: allow if any alias
is explicitly allowed, else block if any is blocked, else allow.

Only DataFrame functions are used. An alias set is a grouped pair of flags, so a set that holds a
third of all pages costs no more than others.

Edge cases: a null url or one without ``://`` has an empty host and path, no rule and no aliases; null
or empty html has no edges; a url on several rows is one node; page_id may be null or repeat; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save
from .components import components

#: verdict, host, path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINKS = r"""(?is)<link\b[^>]*>"""
_METAS = r"""(?is)<meta\b[^>]*>"""
_IS_CANONICAL = r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_IS_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
_TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>;]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def node_of(url: Column) -> Column:
    """The url without scheme and fragment; null where it has no host."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), rest))


def _first(text: Column, pattern: str, groups: int = 1) -> Column:
    """The first group that the first match fills, without entities and white space around it; empty without a match."""
    found = F.concat(*[F.regexp_extract(text, pattern, k + 1) for k in range(groups)])
    return F.regexp_replace(F.regexp_replace(found, r"(?i)&amp;|&#38;|&#x26;", "&"), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def without_dots(path: Column) -> Column:
    """A path without its `.` and `..` segments; the last of them stands for a folder."""
    steps = F.slice(F.split(path, "/"), 2, 1 << 20)
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, step: F.when(step == ".", done).when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, step)))
    plain = F.concat(F.lit("/"), F.array_join(kept, "/"))
    folder = F.element_at(steps, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.when(~path.rlike(r"/\.{1,2}(/|$)"), path).otherwise(F.when(folder, F.concat(plain, F.lit("/"))).otherwise(plain))


def resolved(base: Column, target: Column) -> Column:
    """target as a full url, read on the page base; null where it names no other page: empty, a fragment, or a scheme without a host."""
    scheme, root = F.regexp_extract(base, r"(?s)^(.*?)://", 1), F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    path = path_of(base)
    folder = F.regexp_extract(F.when(path == "", "/").otherwise(path), r"(?s)^.*/", 0)
    own, rest = F.regexp_extract(target, r"(?s)^[^?#]*", 0), F.regexp_extract(target, r"(?s)[?#].*$", 0)
    full = F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target).when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
    clean = F.concat(F.regexp_extract(full, r"(?s)^.*?://[^/?#]*", 0), without_dots(path_of(full)), F.regexp_extract(full, r"(?s)^.*?://[^?#]*([?#].*)$", 1))
    return (
        F.when((target == "") | target.startswith("#") | (root == ""), F.lit(None).cast("string"))
        .when(full.isNotNull(), F.when(full.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"), clean))
        .when(target.startswith("?"), F.concat(root, path, rest))
        .otherwise(F.concat(root, without_dots(F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))), rest))
    )


def links_of(url: Column, html: Column) -> Column:
    """The full urls of all canonical links and refresh redirects of a page."""
    html = F.coalesce(html, F.lit(""))
    links = F.filter(F.regexp_extract_all(html, F.lit(_LINKS), F.lit(0)), lambda tag: tag.rlike(_IS_CANONICAL))
    metas = F.filter(F.regexp_extract_all(html, F.lit(_METAS), F.lit(0)), lambda tag: tag.rlike(_IS_REFRESH))
    targets = F.concat(F.transform(links, lambda tag: _first(tag, _HREF, 3)), F.transform(metas, lambda tag: _first(tag, _TARGET)))
    return F.array_distinct(F.array_compact(F.transform(targets, lambda target: resolved(url, target))))


def fitting_rule(host: Column, path: Column, rules: tuple) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def url_filter(pages: DataFrame, rules: tuple = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """pages: page_id, url, html; redirects: from_url, to_url. Returns page_id, url, host, path, rule, verdict."""
    # The html is read once; what follows needs only urls.
    urls = save(pages.select("page_id", "url", node_of(F.col("url")).alias("node"), links_of(F.col("url"), F.col("html")).alias("links")), "urls")
    edges = urls.select(F.col("url").alias("x"), F.explode("links").alias("y"))
    if redirects is not None:
        edges = edges.union(redirects.select("from_url", "to_url"))
    nodes = edges.select(F.explode(F.array("x", "y")).alias("url")).distinct()
    pairs = edges.select(node_of(F.col("x")).alias("a"), node_of(F.col("y")).alias("b")).dropna().distinct()
    sets = save(components(pairs), "aliases")
    # The urls of a set, in the table or only linked to, decide together.
    _, said = fitting_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    decided = nodes.select(node_of(F.col("url")).alias("node"), said.alias("said")).dropna().distinct().join(sets, "node")
    decided = decided.groupBy("component").agg(F.when(F.bool_or(F.col("said") == "allow"), "allow").otherwise("block").alias("shared"))
    shared = sets.join(decided, "component").select("node", "shared")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    found = urls.join(shared, "node", "left").select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "shared")
    return found.select("page_id", "url", "host", "path", rule.alias("rule"), F.coalesce(verdict, "shared", F.lit("allow")).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("url")


def _sql() -> str:
    def host(x):
        return f"translate(regexp_extract(coalesce({x}, ''), '{_PARTS}', 1), '{_UPPER}', '{_LOWER}')"

    def path(x):
        return f"regexp_extract(coalesce({x}, ''), '{_PARTS}', 2)"

    def node(x):
        return f"CASE WHEN {host(x)} <> '' THEN {host(x)} || regexp_extract({x}, '(?s)^.*?://[^/?#]*([^#]*)', 1) END"

    def rules(h, p, what):
        by = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
        return "CASE " + " ".join(f"WHEN ({h} = '{a}' OR ends_with({h}, '.{a}')) AND starts_with({p}, '{b}') THEN '{a + b if what == 'rule' else k}'" for k, a, b in by) + " END"

    def quoted(x):
        return "'" + x.replace("'", "''") + "'"

    def targets(tags, test, *groups):
        """A row for each target that a tag names."""
        pattern, numbers = groups[0], range(1, groups[1] + 1)
        found = " || ".join(f"coalesce(regexp_extract(tag, {quoted(pattern)}, {k}), '')" for k in numbers)
        return f"SELECT url, trim(regexp_replace({found}, '(?i)&amp;|&#38;|&#x26;', '&', 'g'), chr(9) || chr(10) || chr(13) || ' ') AS target FROM (SELECT url, unnest(regexp_extract_all(coalesce(html, ''), {quoted(tags)})) AS tag FROM pages) WHERE regexp_matches(tag, {quoted(test)})"

    return f"""
WITH RECURSIVE t AS ({targets(_LINKS, _IS_CANONICAL, _HREF, 3)} UNION ALL {targets(_METAS, _IS_REFRESH, _TARGET, 1)}),
k AS (
  SELECT url, target, split_part(url, '://', 1) AS scheme, regexp_extract(url, '(?s)^.*?://[^/?#]*', 0) AS root, {path('url')} AS path, regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') AS named, starts_with(target, '//') AS hosted FROM t),
f AS (
  SELECT *, CASE WHEN named THEN target WHEN hosted THEN scheme || ':' || target WHEN starts_with(target, '?') THEN root || path || target WHEN starts_with(target, '/') THEN root || target
    ELSE root || regexp_extract(CASE path WHEN '' THEN '/' ELSE path END, '(?s)^.*/', 0) || target END AS whole FROM k WHERE root <> '' AND target <> '' AND NOT starts_with(target, '#')),
o AS (SELECT url, whole, string_split({path('whole')}, '/')[2:] AS steps FROM f WHERE regexp_matches(whole, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]')),
c AS (
  SELECT *, list_reduce(list_prepend('', steps), lambda done, step: CASE step WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || step END) AS kept FROM o),
l AS (
  SELECT DISTINCT url AS x, regexp_extract(whole, '(?s)^.*?://[^/?#]*', 0) || CASE WHEN len(steps) = 0 THEN '' WHEN kept = '' THEN '/' WHEN steps[-1] IN ('.', '..') THEN kept || '/' ELSE kept END || regexp_extract(whole, '(?s)^.*?://[^?#]*([?#].*)$', 1) AS y FROM c),
e AS (SELECT DISTINCT x, y, {node('x')} AS a, {node('y')} AS b FROM l WHERE x IS NOT NULL AND y IS NOT NULL),
p AS (SELECT a, b FROM e WHERE a IS NOT NULL AND b IS NOT NULL),
u AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
w(node, other) AS (SELECT a, a FROM u UNION SELECT w.node, u.b FROM w JOIN u ON w.other = u.a),
s AS (SELECT DISTINCT {node('url')} AS other, {rules(host('url'), path('url'), 'verdict')} AS said FROM (SELECT x AS url FROM e UNION SELECT y FROM e)),
d AS (SELECT node, CASE WHEN bool_or(said = 'allow') THEN 'allow' ELSE 'block' END AS shared FROM w JOIN s USING (other) WHERE said IS NOT NULL GROUP BY node),
g AS (SELECT page_id, {host('url')} AS host, {path('url')} AS path, {node('url')} AS node FROM pages)
SELECT page_id, host, path, {rules('host', 'path', 'rule')} AS rule, coalesce({rules('host', 'path', 'verdict')}, shared, 'allow') AS verdict
FROM g LEFT JOIN d USING (node)
"""


SQL = _sql()
