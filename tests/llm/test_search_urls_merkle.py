"""Search by items, URL filters and Merkle proofs against plain Python."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import pytest
from cases import SCHEMA

from sparktrail.llm import registry
from sparktrail.llm.common import table
from sparktrail.llm.lexical_search import top_documents
from sparktrail.llm.merkle import manifest, merkle_proofs, proofs, row_digest
from sparktrail.llm.url_filter import url_verdicts

SF = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")
LOWER = {i: i + 32 for i in range(65, 91)}


# ------------------------------------------------------------- op11
def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def search(docs, items, k=10):
    """[(item place, rank, doc_id, score)]"""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for place, (item, text) in enumerate(items):
        found = []
        for i, c, n in held:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


def found_rows(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_search_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert found_rows(registry.QUERIES["op11_lexical_search"](spark, SF)) == search(docs, items)


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_search_of_edge_cases(spark, edge, edge_rows, block_bytes):
    items = [(1, "Rivers near TOWN7 and mountain13!"), (2, None), (3, ""), (4, "zzz qqq"), (5, "wörds 数字"), (5, "wörds 数字"),
             (6, "one two a b c x same line"), (None, "granaries and neighbours and granaries"), (7, "word5 and77")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, place string").repartition(2)
    got = found_rows(top_documents(edge, asked, block_bytes=block_bytes))
    assert got == search([r[:2] for r in edge_rows], items) and got


def test_search_of_ties_and_empty_tables(spark, nothing):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (99, "other")],
                                 "doc_id long, text string").repartition(7)
    asked = spark.createDataFrame([(1, "here same")], "item_id long, text string")
    got = top_documents(docs, asked).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(1, 11)) and len({r.score for r in got}) == 1
    few = docs.where("doc_id IS NULL OR doc_id > 38")
    assert [r.doc_id for r in top_documents(few, asked).orderBy("rank").collect()] == [39, 40, None]
    for a, b in ((nothing, asked), (docs, asked.limit(0)), (nothing, asked.limit(0))):
        out = top_documents(a, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


# ------------------------------------------------------------- op12
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/")]


def parsed(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    query = re.match(r"(\?[^#]*)?", rest[len(host) + len(path):]).group()
    return host.translate(LOWER), path, query


def rule_of(host, path):
    fits = [(len(h) + len(p), len(h), v == "allow", h + p) for v, h, p in RULES
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=None)


def node(host, path, query):
    return host + (path or "/") + query if host else None


def verdicts(rows, edges):
    """rows: (id, url); edges: pairs of nodes -> (id, host, path, rule, verdict, class)"""
    near = defaultdict(set)
    for a, b in edges:
        if a and b and a != b:
            near[a].add(b)
            near[b].add(a)
    klass = {}
    for start in sorted(near):
        if start not in klass:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in klass:
                    klass[x] = start
                    todo += near[x]
    def own(n):
        host = n.split("/")[0]
        return rule_of(host, n[len(host):].split("?")[0])
    bad = {klass[n] for n in klass if own(n) and not own(n)[2]}
    out = []
    for i, url in rows:
        host, path, query = parsed(url)
        rule, n = rule_of(host, path), node(host, path, query)
        by = rule or (rule_of(host, "/") if host and not path else None)
        verdict = ("allow" if by[2] else "block") if by else "block" if klass.get(n) in bad else "allow"
        out.append((i, host, path, rule and rule[3], verdict, klass.get(n)))
    return Counter(out)


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, node string, place string")


def judged(df):
    return Counter(tuple(r) for r in df.collect())


def test_urls_of_the_table(spark):
    rows = [(r.page_id, r.url) for r in table(spark, SF, "pages").select("page_id", "url").collect()]
    assert judged(registry.QUERIES["op12_url_filters"](spark, SF)) == verdicts(rows, [])


def canonical(url, rel="canonical"):
    return f"<html><head><LINK data-x='1' rel=\"{rel}\" href='{url}'></head></html>"


def test_urls_follow_links(spark):
    refresh = "<meta http-equiv=Refresh content='0; URL=\"{}\"'>"
    rows = [
        (1, "http://a.net/x", canonical("https://b.net/y#top")), (2, "https://B.net/y", refresh.format("//c.com/de/z?q=1&amp;r=2")),
        (3, "http://d.net/one/two", canonical("../y2/./z")), (4, "http://d.net/y2/z", canonical("/es/")),
        (5, "http://e.example.org/es/1", canonical("http://f.net/")), (6, "http://f.net", None), (7, "http://f.net/", ""),
        (8, "http://g.org/ok", canonical("http://f.net/")), (9, "http://h.net/p", "<!-- " + canonical("http://f.net/") + " -->"),
        (10, "http://i.net/p", "<script>'" + canonical("http://f.net/") + "'</script>" + canonical("http://j.net/", "next canonical")),
        (11, "http://j.net/", canonical("mailto:x@f.net")), (12, "http://k.net/a?b", canonical("?b#c")), (13, None, canonical("http://f.net/")),
        (14, "no scheme", canonical("http://f.net/")), (15, "http://org", None), (16, "http://x.com", canonical("http://y.net/")),
        (17, "http://l.net/q/r", canonical("s")), (18, "http://l.net/q/s", canonical("?page=2")), (19, "http://l.net/q/s?page=2", None),
        (20, "http://.org/a", None), (None, "http://a.net/x", None), (1, "http://a.net/x", canonical("https://b.net/y#top")),
        (21, "http://m.net/" + "p/" * 3000, canonical("../" * 50 + "q")), (22, "http://EXAMPLE.org/en/12?x", None),
        (23, "ftp://x.com/de/", None), (24, "http://n.net/", canonical("ftp://x.com/de/"))]
    edges = [("a.net/x", "b.net/y"), ("b.net/y", "c.com/de/z?q=1&r=2"), ("d.net/one/two", "d.net/y2/z"), ("d.net/y2/z", "d.net/es/"),
             ("e.example.org/es/1", "f.net/"), ("g.org/ok", "f.net/"), ("i.net/p", "j.net/"), ("x.com/", "y.net/"),
             ("l.net/q/r", "l.net/q/s"), ("l.net/q/s", "l.net/q/s?page=2"), ("m.net/" + "p/" * 3000, "m.net/" + "p/" * 2950 + "q")]
    want = verdicts([r[:2] for r in rows], edges)
    got = judged(url_verdicts(pages_of(spark, rows).repartition(3)))
    assert got == want
    by = {r[0]: r for r in got}
    assert by[1][4] == by[2][4] == "block"  # through two links to a page that isn't there
    assert by[3][4] == "allow" and by[6][4] == by[7][4] == "block"  # a block comes by an alias
    assert by[8][4] == "allow" and by[8][3] == "org/"  # but not over an allow of its own
    assert by[13][1:5] == ("", "", None, "allow")


def test_urls_of_a_redirect_log_a_hub_and_other_rules(spark):
    n = 400
    rows = [(i, f"http://s{i}.net/", None) for i in range(n)] + [(n, "http://hub.net/", None)]
    links = spark.createDataFrame([(f"http://s{i}.net", "http://hub.net/") for i in range(0, n, 2)]
                                  + [("http://hub.net/#x", "http://bad.com/de/"), (None, "http://hub.net/"), ("x", "http://hub.net/")],
                                  "from_url string, to_url string")
    got = {r.page_id: r for r in url_verdicts(pages_of(spark, rows), links=links).collect()}
    assert all(got[i].verdict == ("block" if i % 2 == 0 or i == n else "allow") for i in range(n + 1))
    assert all((got[i].alias_class == "bad.com/de/") == (i % 2 == 0 or i == n) for i in range(n + 1))
    other = spark.createDataFrame([("block", "S3.net", "/"), ("allow", "s3.net", "/"), ("block", "net", "")],
                                  "verdict string, host string, path string")
    got = {r.page_id: r for r in url_verdicts(pages_of(spark, rows), other).collect()}
    assert got[3].verdict == "allow" and got[4].verdict == "block" and got[4].rule == "net"
    none = url_verdicts(pages_of(spark, rows), other.limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert url_verdicts(pages_of(spark, rows).limit(0)).count() == 0


# ------------------------------------------------------------- op13
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))


def climb(leaves):
    """[levels], each a list of digests, up to one."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i:i + 8])) for i in range(0, len(now), 8)])
    return levels


def merkle(rows):
    """rows: (doc_id, text, lang, source, n_chars) -> what op13 returns"""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append(climb([leaf_of(r) for r in groups[g]]))
    top = climb([t[-1][0] for t in trees])
    out = []
    for at, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                changed = (r[0], r[1].translate(LOWER), *r[2:])
            proof, now = "", leaf_of(changed)
            for levels, place in ((trees[at], i), (top, at)):
                for level in levels[:-1]:
                    first = place // 8 * 8
                    left, right = level[first:place], level[place + 1:first + 8]
                    proof += "".join(left + right)
                    now = sha("".join([*left, now, *right]))
                    place //= 8
            root = top[-1][0]
            out.append((r[0], leaf_of(r), trees[at][-1][0], root, sha(proof), now, now == root))
    return Counter(out)


def proved(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


def tampered(df):
    from pyspark.sql import functions as F

    from sparktrail.llm.url_filter import lower_ascii
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle_proofs(df, claims={"text": F.when(third, lower_ascii(F.col("text"))).otherwise(F.col("text"))})


def rows_in(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_proofs_of_the_table(spark):
    rows = rows_in(table(spark, SF, "documents"))
    got = proved(registry.QUERIES["op13_merkle"](spark, SF))
    assert got == merkle(rows) and {r[-1] for r in got} == {True, False}


def test_proofs_of_edge_cases(edge):
    assert proved(tampered(edge)) == merkle(rows_in(edge))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_proofs_of_small_trees(spark, n):
    """Also many groups, so that the tree over subroots has several heights."""
    extra = ("x",) * 11
    one = spark.createDataFrame([(i, f"Text {i}", "en", "s", i, *extra) for i in range(n)], SCHEMA)
    assert proved(tampered(one)) == merkle(rows_in(one))
    many = spark.createDataFrame([(i, f"Text {i}", f"l{i % 70}" if i % 5 else None, None, i, *extra) for i in range(n * 2)], SCHEMA)
    assert proved(tampered(many.repartition(3))) == merkle(rows_in(many))


def test_proofs_of_nothing_and_of_some_leaves(spark, nothing, edge):
    assert tampered(nothing).count() == 0
    from pyspark.sql import functions as F
    leaves = edge.select(F.col("doc_id").alias("id"), F.col("lang").alias("group"), row_digest([F.col("text")]).alias("leaf"))
    m = manifest(leaves)
    some = m.rows.where("rank % 7 = 3").select("g", "rank", "leaf")
    got = proofs(m, some).collect()
    assert len(got) == some.count() and all(r.found == r.leaf for r in got)
    assert proofs(m, some.limit(0)).count() == 0


def test_proofs_write_few_tables(spark, monkeypatch):
    """The way down writes every second height, and a height of few nodes is one file, whatever partitions a shuffle has."""
    from sparktrail.llm import merkle as operator
    written, write = [], operator.stored

    def noted(df, name):
        out = write(df, name)
        written.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(operator, "stored", noted)
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    rows = spark.createDataFrame([(i, f"Text {i}", f"l{i % 2}", "s", i, *("x",) * 11) for i in range(600)], SCHEMA)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert proved(tampered(rows)) == merkle(rows_in(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    heights = [w for w in written if w[0].startswith(("tree", "top", "asked", "below"))]
    assert heights == [("tree1", 1), ("tree2", 1), ("tree3", 1), ("top1", 1), ("asked", 1), ("below", 1)]
    assert len(written) == 8 + len(heights)
