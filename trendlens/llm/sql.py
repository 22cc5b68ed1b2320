"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

from trendlens.llm.quality_rules import RuleConfig

_WORD = r"[^\x20\x09-\x0D]+"


def _quantile(m: str, at: float) -> str:
    name = f"q_{m}_{round(at * 1000)}"
    return f"own * o.{name} + (1 - own) * a.{name}"


def _quantiles(m: str, at: float) -> str:
    return f"quantile_disc({m}, {at}) AS q_{m}_{round(at * 1000)}"


_TAILS = RuleConfig().measures
_RANKS = {m: sorted({0.5, t.at, *([1 - t.at] if t.both else [])}) for m, t in _TAILS.items()}
_ALL_QUANTILES = ", ".join(_quantiles(m, at) for m, ranks in _RANKS.items() for at in ranks)
_OWN_LIMITS = ", ".join(
    f"{_quantile(m, 0.5)} AS mid_{m}, {_quantile(m, t.at)} + {t.times} * (({_quantile(m, t.at)})"
    f" - ({_quantile(m, 0.5)})) AS high_{m}, "
    + (f"{_quantile(m, 1 - t.at)} - {t.times} * (({_quantile(m, 0.5)}) - ({_quantile(m, 1 - t.at)}))"
       if t.both else "CAST(NULL AS DOUBLE)") + f" AS low_{m}" for m, t in _TAILS.items())
_HOLDS = ", ".join(
    f"quantile_disc(mid_{m}, 0.5) AS mid_{m}, quantile_disc(high_{m}, {RuleConfig().sources})"
    f" AS high_{m}, quantile_disc(low_{m}, {1 - RuleConfig().sources}) AS low_{m}" for m in _TAILS)
_WITHIN = " AND ".join(
    f"coalesce(m.{m} <= least(l.high_{m}, h.mid_{m} + {RuleConfig().widen} * (h.high_{m} - h.mid_{m}))"
    f" AND coalesce(m.{m} >= greatest(l.low_{m}, h.mid_{m} - {RuleConfig().widen}"
    f" * (h.mid_{m} - h.low_{m})), true), false)" for m in _TAILS)

#: Quantiles are exact here; a sketch is exact while a group has few documents.
QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
      FROM (SELECT doc_id, regexp_extract_all(t, '{_WORD}') AS ws FROM d)),
g AS (SELECT doc_id, p, w || ' ' || lead(w, 1) OVER x || ' ' || lead(w, 2) OVER x AS g FROM w
      WINDOW x AS (PARTITION BY doc_id ORDER BY p)),
dup AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n
                               FROM g WHERE g IS NOT NULL) WHERE n >= 2),
rep AS (SELECT doc_id, count(DISTINCT p + k) AS n
        FROM (SELECT doc_id, p, unnest([0, 1, 2]) AS k FROM dup) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
b AS (SELECT d.doc_id, lang, source,
        CAST(len(regexp_extract_all(t, '{_WORD}')) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(l.n_dup, 0) AS n_dup_lines, l.n_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        word_chars / nullif(n_words, 0) AS word_length,
        n_symbols / nullif(n_words, 0) AS symbol_rate, n_dup_lines / n_lines AS dup_line_rate,
        n_repeat_words / nullif(n_words, 0) AS repeat_rate FROM b),
p AS (SELECT * FROM m WHERE NOT base_failed),
o AS (SELECT lang, source, count(*) / (count(*) + {RuleConfig().half_weight}) AS own,
  {_ALL_QUANTILES} FROM p GROUP BY lang, source),
a AS (SELECT lang, {_ALL_QUANTILES} FROM p GROUP BY lang),
s AS (SELECT o.lang, o.source, {_OWN_LIMITS} FROM o JOIN a ON o.lang IS NOT DISTINCT FROM a.lang),
h AS (SELECT lang, {_HOLDS} FROM s GROUP BY lang)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_WITHIN} AS kept
FROM m LEFT JOIN s l ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source
  LEFT JOIN h ON m.lang IS NOT DISTINCT FROM h.lang
"""


_VECTORS = """
par AS (SELECT k, doc_id, unnest(string_split(t, chr(10))) AS p FROM texts),
dense AS (SELECT k, doc_id, j, sum(CAST('0x' || substr(h, 8 * j + 1, 8) AS BIGINT)) % 4294967296 AS v
  FROM (SELECT k, doc_id, unnest(range(32)) AS j, sha256('0:' || p) || sha256('1:' || p)
        || sha256('2:' || p) || sha256('3:' || p) AS h FROM par) GROUP BY ALL),
mark AS (SELECT k, doc_id, CAST('0x' || substr(md5(unnest(regexp_extract_all(t, '[^.!?\\n]+'))), 1, 2)
                               AS BIGINT) AS c FROM texts),
net AS (SELECT k, doc_id, c % 128 AS j, sum(CASE WHEN c < 128 THEN 1 ELSE -1 END) AS v
        FROM mark GROUP BY ALL),
grid AS (SELECT k, doc_id, unnest(range(128)) AS j FROM texts),
signed AS (SELECT g.k, g.doc_id, g.j, CAST(coalesce(v, 0) AS BIGINT) AS v
           FROM grid g LEFT JOIN net USING (k, doc_id, j)),
fp AS (SELECT k, doc_id, d.hex || s.hex AS f, s.vs FROM
  (SELECT k, doc_id, string_agg(lpad(to_hex(CAST(v AS BIGINT)), 8, '0'), '' ORDER BY j) AS hex
   FROM dense GROUP BY ALL) d JOIN
  (SELECT k, doc_id, string_agg(lpad(to_hex((v + 65536) % 65536), 4, '0'), '' ORDER BY j) AS hex,
     list(v ORDER BY j) AS vs FROM signed GROUP BY ALL) s USING (k, doc_id))"""

_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]))"


def _near(a: str, b: str) -> str:
    dot, aa, bb = (_DOT.format(a=f"{x}.vs", b=f"{y}.vs") for x, y in ((a, b), (a, a), (b, b)))
    cosine = f"CAST({dot} AS DOUBLE) / nullif(sqrt(CAST({aa} AS DOUBLE) * CAST({bb} AS DOUBLE)), 0)"
    return (f"CASE WHEN {a}.f = {b}.f THEN 1.0 ELSE "
            f"greatest(0.0, least(1.0, coalesce({cosine}, 0.0))) END")


FINGERPRINT = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) AS i,
             count(*) OVER () AS n FROM documents),
e AS (SELECT a.doc_id, a.t, b.doc_id AS next_id, CAST(floor(length(a.t) / 4) AS BIGINT) AS c,
        b.t AS next_t FROM d a JOIN d b ON b.i = a.i % a.n + 1),
ed AS (SELECT doc_id, t, next_id, substr(t, 1, length(t) - c) || substr(next_t, 1, c) AS x FROM e),
texts AS (SELECT 0 AS k, doc_id, t FROM ed UNION ALL SELECT 1, doc_id, x FROM ed),
{_VECTORS}
SELECT ed.doc_id, CAST(length(ed.t) AS BIGINT) AS n_chars, sha256(ed.x) AS edited_sha256,
  lower(o.f) AS fingerprint, lower(x.f) AS edited_fingerprint,
  {_near('o', 'x')} AS near_edited, {_near('o', 'nx')} AS near_next
FROM ed JOIN fp o ON o.k = 0 AND o.doc_id = ed.doc_id
  JOIN fp x ON x.k = 1 AND x.doc_id = ed.doc_id
  JOIN fp nx ON nx.k = 0 AND nx.doc_id = ed.next_id
"""


def near_duplicates(docs: str, width: int) -> str:
    """Common table expressions that end in ``near`` (doc_id, n_shingles,
    component_id) over the rows of ``docs`` (doc_id, text)."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
nw AS (SELECT doc_id, regexp_extract_all({lower}, '{_WORD}') AS ws FROM {docs}),
ns AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {width} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {width} + 2),
      lambda i: array_to_string(list_slice(ws, i, i + {width} - 1), ' '))) END AS sh FROM nw),
nu AS (SELECT doc_id, len(sh) AS m, hash(unnest(sh)) AS s FROM ns),
np AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n, any_value(a.m + b.m) AS m
       FROM nu a JOIN nu b ON a.s = b.s AND a.doc_id < b.doc_id
         AND 100 * least(a.m, b.m) >= 80 * greatest(a.m, b.m) GROUP BY ALL),
nk AS (SELECT a, b FROM np WHERE 100 * n >= 80 * (m - n)),
nl AS (SELECT a, b FROM nk UNION ALL SELECT b, a FROM nk),
nr AS (SELECT doc_id AS d, doc_id AS r FROM ns UNION SELECT nl.b, nr.r FROM nr JOIN nl ON nl.a = nr.d),
near AS (SELECT ns.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id
  FROM ns JOIN (SELECT d, min(r) AS component_id FROM nr GROUP BY d) ON d = ns.doc_id)"""


NEAR_DUPLICATES = f"""
WITH RECURSIVE {near_duplicates('documents', 2)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM near
"""


ARCHIVE = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
             sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""


#: Fixed value: the polynomial of crc32, reflected.
_CRC_TABLE = """crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS k
  FROM (SELECT unnest(range(256)) AS i))"""


def _crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes; ``k`` of the table ``crc`` is in reach."""
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(strlen({text})), lambda i:
      CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, k[(xor(c, b) & 255) + 1])))"""


SPELLING_VARIANTS = rf"""
WITH RECURSIVE {_CRC_TABLE},
run AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32('keyed')} AS h FROM run, crc),
cut AS (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
    || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7
  GROUP BY word HAVING sum(n) >= 2),
gap AS (SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS k FROM w)),
pair AS (SELECT a.word AS a, b.word AS b, b.n AS bn FROM gap a JOIN gap b USING (k, rest)
    WHERE a.word <> b.word
  UNION SELECT gap.word, w.word, w.n FROM gap JOIN w ON gap.rest = w.word
  UNION SELECT w.word, gap.word, gap.n FROM gap JOIN w ON gap.rest = w.word),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY bn DESC, b) AS b, max(bn) AS bn
  FROM pair GROUP BY a),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN bn >= 10 * w.n THEN b END AS form, CASE WHEN bn >= 10 * w.n THEN bn END AS form_n
  FROM w LEFT JOIN best ON a = w.word),
step AS (SELECT word, word AS root, form AS up FROM f
  UNION ALL SELECT step.word, f.word, f.form FROM step JOIN f ON f.word = step.up)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN step ON step.word = f.word AND up IS NULL
"""


CONVERSATION_TRIE = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST) AS ts
  FROM t GROUP BY c),
hashed AS (SELECT c, ts, {_crc32('CAST(c AS VARCHAR)')} % 6 AS h FROM conv, crc),
built AS (SELECT a.c, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts
  FROM hashed a LEFT JOIN conv b ON b.c = a.c - a.c % 100),
prefix AS (SELECT c, d, ts[1:d] AS p, d = len(ts) AS ends
  FROM (SELECT c, ts, unnest(range(len(ts) + 1)) AS d FROM built)),
node AS (SELECT d, p, min(c) AS c, count(*) AS n,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS ids,
    CASE WHEN d = 0 THEN 0 ELSE length(p[d].text) END AS size
  FROM prefix GROUP BY d, p),
child AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
own AS (SELECT node.*, coalesce(child.n, 0) AS children FROM node LEFT JOIN child USING (d, p)),
up AS (SELECT k AS d, p[1:k] AS p, count(*) FILTER (WHERE children = 0) AS leaves,
    sum((n - 1) * size) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS k FROM own) GROUP BY ALL)
SELECT own.c AS conv_id, own.d AS depth, par.c AS parent_conv_id, own.n AS n_convs,
  own.children AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(own.ids) AS ends_sha256
FROM own JOIN up USING (d, p) LEFT JOIN node par ON par.d = own.d - 1 AND par.p = own.p[1:own.d - 1]
"""

VECTOR_SEARCH = """
WITH v AS (SELECT vec_id, row_number() OVER () AS r,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS y
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.r, v.vec_id, CAST(list_dot_product(q.y, v.y) AS BIGINT) AS score
  FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM k WHERE k <= 10
"""
