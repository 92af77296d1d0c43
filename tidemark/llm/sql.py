"""SQL twins of the operators that SQL can express: the definition itself, by comparing all pairs and walking all links."""

from tidemark.llm.substring_dedup import LENGTHS, LONGEST, REACH, SCATTER, SIZE
from tidemark.llm.top_k import OP8_SQL
from tidemark.llm.url_filter import GOAL, HREF, LINK, REFRESH, RULES, TRACKING, rule_parts

WORDS = r"regexp_extract_all(translate(coalesce(%s, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def walk(links: str, nodes: str) -> str:
    """reach(x, y): y can be reached from x. links: (a, b); nodes: (x)."""
    return f"""both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
reach(x, y) AS (SELECT x, x FROM {nodes} UNION SELECT r.x, l.b FROM reach r JOIN both_ways l ON l.a = r.y)"""


OP4_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS % 'text'} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
nodes AS (SELECT doc_id AS x FROM documents),
{walk('links', 'nodes')},
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON c.x = s.doc_id
"""

def place_number() -> str:
    """A place's number (see substring_dedup), from the lengths of the words from there on."""
    digits = " + ".join(f"least(lead(length(word), {j}, 0) OVER d, {LONGEST}) * CAST({(LONGEST + 1) ** j} AS HUGEINT)" for j in range(LENGTHS))
    return f"(({digits}) * {SCATTER} % 18446744073709551616) // 4294967296"


OP10_SQL = f"""
WITH RECURSIVE t AS (SELECT doc_id, {WORDS % 'text'} AS w, list_transform(regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+'), lambda x: length(x)) AS g
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
u AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(g) AS g, generate_subscripts(w, 1) - 1 AS i FROM t WHERE len(w) >= {SIZE}),
v AS (SELECT doc_id, n, i, sum(g) OVER (PARTITION BY doc_id ORDER BY i) AS finish, length(word) AS l, {place_number()} AS number FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
keyed AS (SELECT doc_id, n, i, number * 4294967296 + 4294967295 - i AS key FROM v WHERE i <= n - {SIZE}),
looked AS (SELECT doc_id, n, i, min(key) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {REACH - 1} FOLLOWING) AS key FROM keyed),
anchors AS (SELECT DISTINCT doc_id, CAST(4294967295 - key % 4294967296 AS BIGINT) AS i FROM looked WHERE i <= greatest(n - {SIZE} - {REACH - 1}, 0)),
sets AS (SELECT a.doc_id, a.i, list_sort(list_distinct(list_transform(range(1, {SIZE - 3}),
  lambda j: concat_ws(' ', w[i + j], w[i + j + 1], w[i + j + 2], w[i + j + 3], w[i + j + 4])))) AS sh FROM anchors a JOIN t ON t.doc_id = a.doc_id),
steps AS (SELECT *, CASE WHEN sh = lag(sh) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS step FROM sets),
runs AS (SELECT *, sum(step) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
s AS (SELECT doc_id, min(i) AS a, max(i) + {SIZE} - 1 AS z, any_value(sh) AS sh FROM runs GROUP BY doc_id, run),
kinds AS (SELECT row_number() OVER () AS id, sh FROM (SELECT DISTINCT sh FROM s)),
e AS (SELECT id, len(sh) AS n, unnest(sh) AS x FROM kinds),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY 1, 2),
links AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
nodes AS (SELECT id AS x FROM kinds),
{walk('links', 'nodes')},
c AS (SELECT x, min(y) AS cluster FROM reach GROUP BY x),
o AS (SELECT s.doc_id, CAST(f.finish - f.l AS BIGINT) AS start, CAST(l.finish AS BIGINT) AS finish, CAST(z - a + 1 AS INTEGER) AS n_words, cluster
  FROM s JOIN kinds USING (sh) JOIN c ON c.x = kinds.id JOIN v f ON f.doc_id = s.doc_id AND f.i = a JOIN v l ON l.doc_id = s.doc_id AND l.i = z),
m AS (SELECT *, min(doc_id) OVER k AS first_doc, max(doc_id) OVER k AS last_doc FROM o WINDOW k AS (PARTITION BY cluster)),
h AS (SELECT cluster, min(start) AS first_start FROM m WHERE doc_id = first_doc GROUP BY cluster)
SELECT doc_id, start, finish AS "end", n_words, first_doc, first_start, doc_id <> first_doc AS removed FROM m JOIN h USING (cluster) WHERE last_doc > first_doc
"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


HOST = r"translate(regexp_extract(substr({u}, instr({u}, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PATH = r"regexp_extract(substr({u}, instr({u}, '://') + 3), '^[^/?#]*([^?#]*)', 1)"


def host(u: str) -> str:
    return f"CASE WHEN instr({u}, '://') > 0 THEN {HOST.format(u=u)} ELSE '' END"


def path(u: str) -> str:
    return f"CASE WHEN instr({u}, '://') > 0 THEN {PATH.format(u=u)} ELSE '' END"


def alias(u: str) -> str:
    short = f"regexp_replace(regexp_replace({path(u)}, '(/index)?\\.html?$', ''), '/+$', '')"
    kept = rf"list_sort(list_filter(string_split(regexp_extract({u}, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, {quoted(TRACKING)})))"
    return f"CASE WHEN {host(u)} <> '' THEN concat(regexp_replace({host(u)}, '^www\\.', ''), {short}, '?', array_to_string({kept}, '&')) END"


def link(tag: str, inner: str) -> str:
    x = f"replace(regexp_extract(regexp_extract(html, {quoted(tag)}), {quoted(inner)}, 1), '&amp;', '&')"
    root, folder = "regexp_extract(url, '^[^/?#]*//[^/?#]*')", "regexp_extract(url, '^([^?#]*/)[^/?#]*', 1)"
    return f"""CASE WHEN coalesce({x}, '') = '' THEN NULL WHEN regexp_matches({x}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {x}
  WHEN starts_with({x}, '//') THEN concat(regexp_extract(url, '^([^:]*):', 1), ':', {x}) WHEN starts_with({x}, '/') THEN concat({root}, {x})
  WHEN length({folder}) > length({root}) THEN concat({folder}, {x}) ELSE concat({root}, '/', {x}) END"""


def first_rule(what: int) -> str:
    cases = [f"WHEN (h = {quoted(r[0])} OR ends_with(h, {quoted('.' + r[0])})) AND starts_with(p, {quoted(r[1])}) THEN {quoted(r[what])}" for r in rule_parts(RULES)]
    return f"CASE {' '.join(cases)} END"


OP2_SQL = f"""
WITH RECURSIVE t AS (SELECT page_id, url, {alias('url')} AS k, {host('url')} AS h, {path('url')} AS p, {link(LINK, HREF)} AS l1, {link(REFRESH, GOAL)} AS l2 FROM pages),
d AS (SELECT k AS a, l1 AS dst FROM t WHERE l1 IS NOT NULL UNION ALL SELECT k, l2 FROM t WHERE l2 IS NOT NULL),
links AS (SELECT a, {alias('dst')} AS b, dst FROM d WHERE a IS NOT NULL AND {alias('dst')} IS NOT NULL AND a <> {alias('dst')}),
said AS (SELECT k, h, p FROM t WHERE k IS NOT NULL UNION ALL SELECT b, {host('dst')}, {path('dst')} FROM links),
nodes AS (SELECT DISTINCT k AS x FROM said),
{walk('links', 'nodes')},
verdicts AS (SELECT k, {first_rule(3)} AS v FROM said),
spread AS (SELECT r.x, bool_or(v = 'allow') AS allowed FROM reach r JOIN verdicts s ON s.k = r.y WHERE v IS NOT NULL GROUP BY r.x)
SELECT page_id, h AS host, p AS path, {first_rule(2)} AS rule, coalesce({first_rule(3)}, CASE WHEN NOT allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM t LEFT JOIN spread ON spread.x = t.k
"""

#: The checksum is taken byte by byte with a table; near words share what is left when one letter of each, or of one, is left out.
OP12_SQL = """
WITH RECURSIVE
t AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))) AS tab),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
u AS (SELECT w, hex(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', w)) AS h, count(*) AS m FROM r GROUP BY doc_id, w),
c AS (SELECT w, m, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
  lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) AS crc FROM u, t),
k AS (SELECT CASE WHEN crc % 97 = 0 THEN concat(left(w, crc % length(w)), substr(w, crc % length(w) + 2)) ELSE w END AS word, m FROM c),
v AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM k WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
d AS (SELECT word, n, p, concat(left(word, p), substr(word, p + 2)) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM v)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.rest UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.rest),
b AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n
  FROM v LEFT JOIN b ON b.word = v.word),
chain AS (SELECT word, form AS up FROM f WHERE form IS NOT NULL UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.up WHERE f.form IS NOT NULL),
ends AS (SELECT chain.word, chain.up FROM chain JOIN f ON f.word = chain.up WHERE f.form IS NULL)
SELECT f.word, form, coalesce(up, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN ends ON ends.word = f.word
"""

SQL = {"op2_url_filter": OP2_SQL, "op4_minhash": OP4_SQL, "op8_top_k": OP8_SQL, "op10_substring_dedup": OP10_SQL, "op12_spelling": OP12_SQL}
