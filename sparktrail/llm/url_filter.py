"""URL filters that follow redirects: a block holds for every alias of a blocked page.

Rules (allow or block, a host, a path prefix) fit the host and all its
subdomains where the URL's path starts with the rule's; of those that fit, the
longest (host and path together) counts.  Pages are nodes, named by host, path
and query (scheme and fragment don't tell pages apart; an empty path is ``/``).
Edges are what makes two URLs one page: ``<link rel=canonical>``, ``<meta
http-equiv=refresh>``, and the rows of a crawl's redirect log.  The connected
components of this graph are classes of aliases.  Where any node of a class,
crawled or only linked to, has a block of its own, the class is blocked: its
pages without a rule of their own are blocked.  A page with a rule of its own
keeps its verdict, so an explicit allow precedes a block that comes by an alias;
an allow is not handed on.

Only DataFrame functions are used.  The HTML is read once; all else works on
hosts, paths and edges.  Components alternate large-star and small-star steps,
each written to the shared folder.  Rules are broadcast if their bytes, which
are summed first, stay under ``MAX_RULE_BYTES``, else joined by a shuffle on the
host; a URL meets the rules of its host's suffixes only.

Edge cases: a null URL or one without ``://`` has an empty host and path, no
node, and is allowed; null HTML has no links; links to other schemes than http
and https, to the page itself or to nowhere are no edges; comments and scripts
are not searched; repeated rows each get their verdict, equal URLs the same one
by rules and the same class; an empty table gives no rows; columns other than
the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, stored
from .simhash import components

#: The contract's rules: verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Rules of more bytes than this are joined by a shuffle.
MAX_RULE_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TAG = r"(?i)<(?:link|meta)[\s/][^>]*>"
_VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of what follows the first ``://``; all empty if there is none."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = rest.substr(F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    query = F.regexp_extract(after.substr(F.length(path) + 1, F.length(after)), r"^\?[^#]*", 0)
    return lower_ascii(host), path, query


def node_of(host: Column, path: Column, query: Column) -> Column:
    """A page's name; null without a host."""
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), query))


def _without(html: Column, opens: str, closes: str) -> Column:
    """``html`` without what stands from each ``opens`` (a pattern) to the next ``closes``, in one pass."""
    def tail(part: Column, i: Column) -> Column:
        end = F.instr(part, closes)
        return F.when(i == 0, part).when(end > 0, part.substr(end + len(closes), F.length(part))).otherwise("")

    return F.array_join(F.transform(F.split(html, opens), tail), " ")


def _attribute(tag: Column, name: str) -> Column:
    found = [F.regexp_extract(tag, rf"(?i)[\s/\"']{name}{_VALUE}", i) for i in (1, 2, 3)]
    return F.concat(*found)


def link_targets(html: Column) -> Column:
    """The URLs, as written, that a page names as its canonical form or refreshes to."""
    def target(tag: Column) -> Column:
        words = F.split(F.lower(_attribute(tag, "rel")), r"\s+")
        refresh = F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh"
        goes = F.regexp_extract(_attribute(tag, "content"), r"(?i)^[\s\d.]*[;,]?\s*url\s*=\s*[\"']?([^\"']*)", 1)
        return F.when(F.array_contains(words, "canonical"), _attribute(tag, "href")).when(refresh, goes).otherwise("")

    shown = _without(_without(html, "<!--", "-->"), "(?i)<script", "</script")
    tags = F.transform(F.regexp_extract_all(shown, F.lit(_TAG), F.lit(0)), target)
    tags = F.transform(tags, lambda t: F.trim(F.replace(t, F.lit("&amp;"), F.lit("&"))))
    # most pages name neither, and need no further search
    return F.when(html.rlike("(?i)canonical|refresh"), F.filter(tags, lambda t: t != "")).otherwise(
        F.array().cast("array<string>"))


def _resolved(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.regexp_replace(path, r"/\.\.?$", "$0/"), "/")
    walked = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    return F.when(path.contains("/."), walked).otherwise(path)


def target_node(target: Column, host: Column, path: Column) -> Column:
    """The node that a link on the page at ``host`` and ``path`` leads to; null if it leads to none."""
    whole = F.when(target.rlike("(?i)^https?://"), target).when(target.startswith("//"), F.concat(F.lit("http:"), target))
    bare = F.regexp_extract(target, r"^[^?#]*", 0)
    query = F.regexp_extract(target.substr(F.length(bare) + 1, F.length(target)), r"^\?[^#]*", 0)
    folder = F.regexp_extract(path, r"(?s)^.*/", 0)
    near = F.when(bare == "", path).when(bare.startswith("/"), bare).otherwise(
        F.concat(F.when(folder == "", "/").otherwise(folder), bare))
    other = target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | target.startswith("#") | (target == "")
    far = split_url(whole)
    return F.when(whole.isNotNull(), node_of(far[0], _resolved(far[1]), far[2])).when(
        ~other, node_of(host, _resolved(near), query))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(place, rule, of): for each of ``urls`` (place, host, path) that rules fit, the longest of them, and its verdict."""
    rules = rules.select("verdict", lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"))
    size, labels = rules.agg(F.sum(F.octet_length("rule_host") + F.octet_length("rule_path") + 32),
                             F.max(F.size(F.split("rule_host", r"\.")))).first()
    if size is None:
        return urls.select("place", F.lit("").alias("rule"), F.lit("").alias("of")).limit(0)
    if size <= MAX_RULE_BYTES:
        rules = F.broadcast(rules)
    # the last 1 to ``labels`` labels of the host; equal ones of a shorter host count once
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in range(1, labels + 1)]))
    near = urls.where("host <> ''").select("place", "path", F.explode(suffixes).alias("rule_host"))
    fits = near.join(rules, "rule_host").where(F.startswith("path", "rule_path"))
    best = F.struct((F.length("rule_host") + F.length("rule_path")).alias("length"), F.length("rule_host").alias("host"),
                    (F.col("verdict") == "allow").alias("allow"), F.concat("rule_host", "rule_path").alias("rule"))
    return fits.groupBy("place").agg(F.max(best).alias("best")).select(
        "place", "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("of"))


def url_verdicts(pages: DataFrame, rules: DataFrame | None = None, links: DataFrame | None = None,
                 id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row for each row of ``pages``: the id, host, path, rule (the one that counts, as host and path), verdict, and
    alias_class (the smallest node of its class; null if it has no alias).

    ``rules`` has verdict, host and path; ``links``, a redirect log, from_url and to_url."""
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    host, path, query = split_url(col(url_col).cast("string"))
    urls = pages.select(F.monotonically_increasing_id().alias("place"), col(id_col).alias("id"), host.alias("host"),
                        path.alias("path"), node_of(host, path, query).alias("node"),
                        link_targets(col(html_col).cast("string")).alias("targets"))
    urls = stored(urls, "urls")
    edges = (urls.where(F.col("node").isNotNull() & (F.size("targets") > 0))
             .select("host", "path", F.col("node").alias("a"), F.explode("targets").alias("target"))
             .select("a", target_node(F.col("target"), F.col("host"), F.col("path")).alias("b")))
    if links is not None:
        ends = [node_of(*split_url(F.col(c).cast("string"))).alias(n) for c, n in (("from_url", "a"), ("to_url", "b"))]
        edges = edges.union(links.select(*ends))
    roots = components(edges.where("a IS NOT NULL AND b IS NOT NULL")).distinct()
    roots = stored(roots.union(roots.select("root", "root")).distinct(), "classes")  # (node, root)
    at = F.regexp_extract("node", "^[^/]*", 0)
    named = roots.select(F.col("node").alias("place"), at.alias("host"),
                         F.regexp_extract(F.expr("substr(node, length(regexp_extract(node, '^[^/]*', 0)) + 1)"),
                                          r"^[^?]*", 0).alias("path"))
    own = _ruled(named, rules)
    blocked = roots.join(own.where("of = 'block'").select(F.col("place").alias("node")), "node").select("root").distinct()
    fate = roots.join(blocked.withColumn("bad", F.lit(True)), "root", "left")
    # an empty path has no rule by its text, but is the page "/"
    as_page = urls.select("place", "host", F.when(F.col("path") == "", "/").otherwise(F.col("path")).alias("path"))
    empty = _ruled(urls.select("place", "host", "path").where("path = ''"), rules)
    ruled = _ruled(as_page, rules)
    out = urls.join(ruled, "place", "left").join(
        empty.select("place", F.col("rule").alias("bare_rule"), F.col("of").alias("bare_of")), "place", "left")
    rule = F.when(F.col("path") == "", F.col("bare_rule")).otherwise(F.col("rule"))
    verdict = F.coalesce(F.when(F.col("path") == "", F.col("bare_of")), "of", F.when(F.col("bad"), "block"), F.lit("allow"))
    out = out.drop("targets").join(fate, "node", "left")
    return out.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"),
                      F.col("root").alias("alias_class"))
