"""What the corpus queries return, in DuckDB's SQL, for those that it can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')"


SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS place, doc_id, {_terms('text')} AS ts FROM documents),
n AS (SELECT place, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM n),
asked AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_terms('text')}) AS ts FROM benchmark),
q AS (SELECT item, item_id, unnest(ts) AS term FROM asked),
words AS (SELECT place, unnest(ts) AS term FROM d),
tf AS (SELECT place, term, count(*)::BIGINT AS tf FROM words WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, total GROUP BY term, nn),
m AS (SELECT place, doc_id, 10 + (90 * n * nn) // ll AS m FROM n, total),
s AS (SELECT item, item_id, doc_id, place, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (place) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""

_CRC = ("xor(4294967295::BIGINT, list_reduce(list_transform(range(1, len({0}) + 1), "
        "lambda i: ascii(substr({0}, i, 1))::BIGINT), lambda c, b: list_reduce(range(8), "
        "lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)), xor(c, b)), 4294967295::BIGINT))")


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')"
             for f in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


#: Heights of trees that the SQL goes through: 8^12 rows are enough for any table that it is run on.
_HEIGHTS = 12


def _merkle_sql() -> str:
    third = f"{_CRC.format('doc_id::VARCHAR')} % 3 = 0"
    changed = f"CASE WHEN {third} THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END"
    sql = [f"""WITH leaves AS (SELECT row_number() OVER () AS place, doc_id, lang, {_leaf('text')} AS leaf,
        {_leaf(changed)} AS claim FROM documents),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, place) - 1 AS idx,
        count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaves),
    t0 AS (SELECT g, idx, leaf AS h, n FROM ranked)"""]
    level = """, {p}{k} AS (SELECT g, CASE WHEN n > 1 THEN idx // 8 ELSE idx END AS idx,
        CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE max(h) END AS h,
        CASE WHEN max(n) > 1 THEN (max(n) + 7) // 8 ELSE 1 END AS n FROM {p}{j} GROUP BY g, n, 2)"""
    path = """, {p}p{k} AS (SELECT a.*, b.beside, b.l, b.r FROM {q} a LEFT JOIN LATERAL (
        SELECT coalesce(string_agg(h, '' ORDER BY idx), '') AS beside,
               coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < a.{i}), '') AS l,
               coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > a.{i}), '') AS r
        FROM {p}{j} t WHERE t.g = a.{g} AND t.idx // 8 = a.{i} // 8 AND t.idx <> a.{i} AND t.n > 1) b ON true)
    , {p}q{k} AS (SELECT * EXCLUDE (beside, l, r) REPLACE (proof || beside AS proof,
        CASE WHEN {left} > 1 THEN sha256(l || claim || r) ELSE claim END AS claim,
        CASE WHEN {left} > 1 THEN {i} // 8 ELSE {i} END AS {i},
        CASE WHEN {left} > 1 THEN ({left} + 7) // 8 ELSE 1 END AS {left}) FROM {p}p{k})"""
    sql += [level.format(p="t", j=k - 1, k=k) for k in range(1, _HEIGHTS + 1)]
    sql.append(f""", u0 AS (SELECT 0 AS g, g AS idx, h, count(*) OVER () AS n FROM t{_HEIGHTS})""")
    sql += [level.format(p="u", j=k - 1, k=k) for k in range(1, _HEIGHTS + 1)]
    sql.append(""", tq0 AS (SELECT doc_id, leaf, claim, '' AS proof, g, idx, n, 0 AS zero, g AS turn,
        (SELECT count(*) FROM u0) AS many FROM ranked)""")
    sql += [path.format(p="t", q=f"tq{k - 1}", j=k - 1, k=k, i="idx", g="g", left="n") for k in range(1, _HEIGHTS + 1)]
    sql.append(f", uq0 AS (SELECT * FROM tq{_HEIGHTS})")
    sql += [path.format(p="u", q=f"uq{k - 1}", j=k - 1, k=k, i="turn", g="zero", left="many") for k in range(1, _HEIGHTS + 1)]
    sql.append(f"""SELECT f.doc_id, f.leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256,
        f.claim AS folded_root, f.claim = r.h AS verified
    FROM uq{_HEIGHTS} f JOIN t{_HEIGHTS} s ON f.g = s.g, u{_HEIGHTS} r""")
    return "\n".join(sql)


MERKLE_SQL = _merkle_sql()

_VALUE = r"""\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""


def _attribute(tag: str, name: str) -> str:
    return " || ".join(f"regexp_extract({tag}, '(?i)[\\s/\"''']{name}{_VALUE}', {i})" for i in (1, 2, 3)).replace("'''", "''")


def _without(html: str, opens: str, closes: str) -> str:
    return (f"array_to_string(list_transform(regexp_split_to_array({html}, '{opens}'), lambda p, i: CASE WHEN i = 1 THEN p "
            f"WHEN instr(p, '{closes}') > 0 THEN substr(p, instr(p, '{closes}') + {len(closes)}) ELSE '' END), ' ')")


_PARSE = f"""SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\\?[^#]*)', 1) AS query"""
_REST = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"
_NODE = "CASE WHEN {h} <> '' THEN {h} || CASE WHEN {p} = '' THEN '/' ELSE {p} END || {q} END"
_DOTS = r"""CASE WHEN contains({0}, '/.') THEN array_to_string(list_reduce(list_transform(string_split(
    regexp_replace({0}, '/\.\.?$', '\0/'), '/'), lambda s: [s]), lambda a, b: CASE WHEN b[1] = '..' THEN
    CASE WHEN len(a) > 1 THEN a[1:len(a) - 1] ELSE a END WHEN b[1] = '.' THEN a ELSE list_concat(a, b) END), '/') ELSE {0} END"""
URLS_SQL = f"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
raw AS (SELECT row_number() OVER () AS place, page_id, html, coalesce({_REST.format('url')}, '') AS rest FROM pages),
u AS ({_PARSE} FROM raw),
p AS (SELECT * EXCLUDE (html), {_NODE.format(h='host', p='path', q='query')} AS node,
    CASE WHEN regexp_matches(html, '(?i)canonical|refresh') THEN regexp_extract_all(
        {_without(_without('html', '<!--', '-->'), '(?i)<script', '</script')}, '(?i)<(?:link|meta)[\\s/][^>]*>') END AS tags
    FROM u),
tag AS (SELECT place, host, path, node, unnest(tags) AS tag FROM p WHERE node IS NOT NULL),
said AS (SELECT *, replace(trim(CASE
    WHEN list_contains(regexp_split_to_array(lower({_attribute('tag', 'rel')}), '\\s+'), 'canonical') THEN {_attribute('tag', 'href')}
    WHEN lower(trim({_attribute('tag', 'http-equiv')})) = 'refresh' THEN regexp_extract({_attribute('tag', 'content')},
        '(?i)^[\\s\\d.]*[;,]?\\s*url\\s*=\\s*["'']?([^"'']*)', 1) ELSE '' END), '&amp;', '&') AS t FROM tag),
far AS (SELECT *, CASE WHEN regexp_matches(t, '(?i)^https?://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t END AS whole,
    regexp_extract(t, '^[^?#]*') AS bare, regexp_extract(t, '^[^?#]*(\\?[^#]*)', 1) AS near_query FROM said WHERE t <> ''),
ends AS (SELECT host AS page_host, path AS page_path, node AS a, whole, t, near_query, coalesce({_REST.format('whole')}, '') AS rest,
    CASE WHEN bare = '' THEN path WHEN starts_with(bare, '/') THEN bare
         ELSE CASE WHEN regexp_extract(path, '(?s)^.*/') = '' THEN '/' ELSE regexp_extract(path, '(?s)^.*/') END || bare END AS near
    FROM far),
parsed AS ({_PARSE} FROM ends),
e0 AS (SELECT a, CASE WHEN whole IS NOT NULL THEN {_NODE.format(h='host', p='(' + _DOTS.format('path') + ')', q='query')}
    WHEN NOT regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') AND NOT starts_with(t, '#')
    THEN {_NODE.format(h='page_host', p='(' + _DOTS.format('near') + ')', q='near_query')} END AS b FROM parsed),
e AS (SELECT a, b FROM e0 WHERE b IS NOT NULL AND a <> b UNION SELECT b, a FROM e0 WHERE b IS NOT NULL AND a <> b),
reach(a, b) AS (SELECT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
nodes AS (SELECT DISTINCT a AS node, regexp_extract(a, '^[^/]*') AS host, regexp_extract(a, '^[^/]*([^?]*)', 1) AS path FROM e),
best AS (SELECT k.host, k.path, max_by({{'rule': rhost || rpath, 'verdict': verdict}},
        {{'l': len(rhost) + len(rpath), 'h': len(rhost), 'v': (verdict = 'allow')::INT}}) AS best
    FROM (SELECT host, path FROM nodes UNION SELECT host, path FROM p UNION SELECT host, '/' FROM p WHERE path = '') k, rules
    WHERE (k.host = rhost OR ends_with(k.host, '.' || rhost)) AND starts_with(k.path, rpath) GROUP BY ALL),
bad AS (SELECT DISTINCT reach.a AS node FROM reach JOIN nodes ON reach.b = nodes.node
    JOIN best ON best.host = nodes.host AND best.path = nodes.path WHERE best.best.verdict = 'block'),
low AS (SELECT a AS node, min(b) AS alias_class FROM reach GROUP BY a)
SELECT page_id, p.host, p.path, x.best.rule AS rule, CASE WHEN x.best IS NOT NULL THEN x.best.verdict
    WHEN y.best IS NOT NULL THEN y.best.verdict WHEN bad.node IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, alias_class
FROM p LEFT JOIN best x ON x.host = p.host AND x.path = p.path
LEFT JOIN best y ON p.path = '' AND y.host = p.host AND y.path = '/'
LEFT JOIN bad ON bad.node = p.node LEFT JOIN low ON low.node = p.node
"""
