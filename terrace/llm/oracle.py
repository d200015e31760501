"""DuckDB SQL for the queries that SQL can express: plain all-pairs or whole-order versions."""

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) < 2 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(sh) AS sh FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.id)
SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id, min(r.root) = n.doc_id AS kept
FROM n JOIN reach r ON r.id = n.doc_id GROUP BY n.doc_id, n.n
"""

OP4 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
reach AS (
  SELECT vec_id AS id, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN l ON l.a = r.id)
SELECT m.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, min(r.root) AS component_id, min(r.root) = m.vec_id AS kept
FROM embeddings m JOIN reach r ON r.id = m.vec_id LEFT JOIN n ON n.a = m.vec_id
GROUP BY m.vec_id, n.n
"""

OP6 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, (CASE (rank - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS w,
             source_size::DOUBLE * 3.0::DOUBLE AS cap FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY cap / w, rank) AS k FROM w),
g AS (SELECT f.*, ((SELECT sum(source_size) FROM f)::DOUBLE
                   - coalesce((SELECT sum(cap) FROM f b WHERE b.k < f.k), 0::DOUBLE))
                  / (SELECT sum(w) FROM f b WHERE b.k >= f.k) AS level FROM f),
z AS (SELECT level AS final FROM g WHERE level * w <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, rank, source_size, least(cap, coalesce((SELECT final FROM z) * w, cap)) AS target FROM g),
q AS (SELECT d.*, t.rank, t.source_size, t.target,
             sum(size) OVER (PARTITION BY t.rank ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, upto + copy * source_size AS pos, (upto + copy * source_size)::DOUBLE / target AS time
      FROM q, range(3) r(copy) WHERE size > 0),
o AS (SELECT *, sum(size) OVER (ORDER BY time, rank, pos ROWS UNBOUNDED PRECEDING) AS used FROM c),
k AS (SELECT doc_id, count(*) AS copies FROM o WHERE used <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, (coalesce(k.copies, 0) * q.size)::BIGINT AS taken
FROM q LEFT JOIN k USING (doc_id)
"""

#: CRC-32 by its table, over the UTF-8 bytes of a text.
_TAB = """tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc(text: str) -> str:
    octets = (f"list_transform(range(strlen({text})), "
              f"lambda i: ('0x' || substring(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)")
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), "
            f"lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)")


_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP11 = rf"""
WITH {_TAB},
w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_FEATURE}') AS ws FROM documents),
x AS (SELECT doc_id, unnest(ws) AS f FROM w),
y AS (SELECT unnest(regexp_extract_all({_LOWER}, '{_FEATURE}')) AS f FROM benchmark),
b AS (SELECT f, {_crc('f')} % 10000 AS b FROM (SELECT DISTINCT f FROM (SELECT f FROM x UNION ALL SELECT f FROM y)), tab),
s AS (SELECT b, count(*) AS s FROM x JOIN b USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM y JOIN b USING (f) GROUP BY b),
z AS (SELECT (SELECT count(*) FROM x)::DOUBLE AS s_all, (SELECT count(*) FROM y)::DOUBLE AS t_all),
g AS (SELECT r.b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)
                                  / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
      FROM range(10000) r(b) LEFT JOIN s ON s.b = r.b LEFT JOIN t ON t.b = r.b, z),
d AS (SELECT x.doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*)::DOUBLE)::BIGINT AS weight
      FROM x JOIN b USING (f) JOIN g ON g.b = b.b GROUP BY x.doc_id),
e AS (SELECT w.doc_id, len(ws)::BIGINT AS n_features, coalesce(d.weight, 0) AS weight,
             ('0x' || substring(sha256('2024:' || w.doc_id::VARCHAR), 1, 8))::BIGINT AS h
      FROM w LEFT JOIN d ON d.doc_id = w.doc_id),
v AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM e),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM v WHERE n_features >= 20)
SELECT v.doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END AS rank
FROM v LEFT JOIN r ON r.doc_id = v.doc_id
"""

#: Near words: equal after one letter is taken from one of them, or from both at the same place.
OP12 = rf"""
WITH RECURSIVE {_TAB},
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents),
c AS (SELECT doc_id, r, count(*) AS c, doc_id::VARCHAR || ':' || r AS name FROM r GROUP BY doc_id, r),
h AS (SELECT r, c, {_crc('name')} AS h FROM c, tab),
m AS (SELECT CASE WHEN h % 97 = 0 THEN substring(r, 1, (h % length(r))::INT) || substring(r, (h % length(r) + 2)::INT)
             ELSE r END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM m WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
x AS (SELECT word, n, i, substring(word, 1, (i - 1)::INT) || substring(word, (i + 1)::INT) AS cut
      FROM v, unnest(range(1, length(word) + 1)) u(i)),
p AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
      UNION SELECT x.word, v.word FROM x JOIN v ON x.cut = v.word
      UNION SELECT v.word, x.word FROM x JOIN v ON x.cut = v.word),
q AS (SELECT a AS word, count(*) AS n_near, max(v.n) AS top FROM p JOIN v ON v.word = p.b GROUP BY a),
b AS (SELECT p.a AS word, min(p.b COLLATE "C") AS best FROM p JOIN v ON v.word = p.b JOIN q ON q.word = p.a AND q.top = v.n
      GROUP BY p.a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 2 * v.n THEN best END AS form,
             CASE WHEN top >= 2 * v.n THEN top END AS form_n
      FROM v LEFT JOIN q ON q.word = v.word LEFT JOIN b ON b.word = v.word),
w AS (SELECT word, word AS root, 0 AS k FROM f
      UNION ALL SELECT w.word, f.form, k + 1 FROM w JOIN f ON f.word = w.root WHERE f.form IS NOT NULL),
e AS (SELECT word, arg_max(root, k) AS root FROM w GROUP BY word)
SELECT f.word, form, e.root, n, n_near, form_n FROM f JOIN e ON e.word = f.word
"""


def _matches(source: str, text: str, pattern: str, carry: str = "") -> str:
    """Rows (doc_id, v, start, before, after) of a pattern's matches: starts from the lengths between them."""
    return f"""SELECT doc_id, m[i] AS v, right(g[i], 40) AS before, left(g[i + 1], 40) AS after{carry},
      (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1],
       lambda x: length(x))), 0))::BIGINT AS start
    FROM (SELECT *, regexp_extract_all({text}, '{pattern}') AS m, string_split_regex({text}, '{pattern}') AS g FROM {source}),
         unnest(range(1, len(m) + 1)) u(i)"""


def _score(sure: float, words: str, more: float, minus: bool) -> str:
    beside = "lower(before || ' ' || after)"
    less = (f" - CASE WHEN regexp_matches({beside}, '(^|[^a-z])(order|invoice|isbn|tracking|serial|version|part no)([^a-z]|$)')"
            " THEN 0.2 ELSE 0 END" if minus else "")
    return f"round({sure} + CASE WHEN regexp_matches({beside}, '(^|[^a-z])({words})([^a-z]|$)') THEN {more} ELSE 0 END{less}, 2)"


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = (f"length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length({_DIGITS})), lambda i: "
         f"list_sum(list_transform(string_split(((ord(substring({_DIGITS}, (length({_DIGITS}) - i)::INT, 1)) - 48) "
         "* (1 + i % 2))::VARCHAR, ''), lambda x: x::INT)))) % 10 = 0")
_TURNED = "substring(replace(v, ' ', ''), 5) || left(replace(v, ' ', ''), 4)"
_MOD97 = (f"list_reduce(list_concat([0], list_transform(string_split({_TURNED}, ''), "
          "lambda c: CASE WHEN c <= '9' THEN ord(c) - 48 ELSE ord(c) - 55 END)), "
          "lambda r, c: CASE WHEN c < 10 THEN (r * 10 + c) % 97 ELSE (r * 100 + c) % 97 END)")
_OCTETS = "len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR ('0' || left(ltrim(x, '0'), 3))::INT > 255)) = 0"
_IBAN = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
OP13 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
email AS ({_matches("d", "t", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+")}),
ip AS ({_matches("d", "t", "[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)")}),
chain AS (SELECT *, {_LUHN} AS ok FROM ({_matches("d", "t", "[0-9](?:[ -]?[0-9])+")})),
plus AS (SELECT *, length({_DIGITS}) BETWEEN 9 AND 15 AS ok,
                regexp_extract(v, '^[+][0-9]{{1,3}}[ .-]?[(]?[0-9]{{2,4}}[)]?[ .-][0-9]{{3,4}}[ .-][0-9]{{4}}') AS head
         FROM ({_matches("d", "t", "[+][0-9][ ().0-9-]+[0-9]")})),
inner_cards AS ({_matches("(SELECT doc_id, v AS c, start AS s0, before AS b0, after AS a0 FROM chain WHERE NOT ok)", "c",
                          "[0-9]{13,}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}", ", s0, b0, a0")}),
local AS ({_matches("d", "t", "[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}")}),
iban AS ({_matches("d", "t", _IBAN)}),
ssn AS ({_matches("d", "t", "[0-9]{3}-[0-9]{2}-[0-9]{4}")}),
a AS (
  SELECT 1 AS k, 'email' AS kind, doc_id, start, v, TRUE AS base, 1.0 AS score FROM email
  UNION ALL SELECT 2, 'ip', doc_id, start, v, TRUE, 1.0 FROM ip WHERE {_OCTETS}
  UNION ALL SELECT 3, 'card', doc_id, start, v, TRUE, 1.0 FROM chain WHERE ok
  UNION ALL SELECT 3, 'card', doc_id, s0 + start, v, FALSE, {_score(0.7, "card|visa|mastercard|amex|credit|debit|payment|cvv", 0.2, True)}
    FROM (SELECT doc_id, v, start, s0, before AS b1, after AS a1, b0 AS before, a0 AS after FROM inner_cards)
    WHERE {_LUHN} AND regexp_matches(v, '^[3-6]') AND NOT regexp_matches(b1, '[0-9]$') AND NOT regexp_matches(a1, '^[0-9]')
  UNION ALL SELECT 4, 'phone', doc_id, start, v, TRUE, 1.0 FROM plus WHERE ok
  UNION ALL SELECT 4, 'phone', doc_id, start, head, FALSE, {_score(0.7, "phone|telephone|tel|call|mobile|cell|fax|whatsapp", 0.2, True)}
    FROM plus WHERE NOT ok AND head <> '' AND NOT regexp_matches(substring(v, length(head) + 1, 1), '[0-9]')
  UNION ALL SELECT 4, 'phone', doc_id, start, v, FALSE, {_score(0.3, "phone|telephone|tel|call|mobile|cell|fax|whatsapp", 0.4, True)}
    FROM local WHERE NOT regexp_matches(before, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]')
      AND NOT regexp_matches(before, '[+][0-9 ().-]*$')
  UNION ALL SELECT 5, 'iban', doc_id, start, v, FALSE, {_score(0.9, "iban|account|bank|transfer|bic", 0.1, False)}
    FROM iban WHERE NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AND {_MOD97} = 1
  UNION ALL SELECT 6, 'ssn', doc_id, start, v, FALSE, {_score(0.3, "ssn|social security", 0.5, True)}
    FROM ssn WHERE NOT regexp_matches(before, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]')
      AND NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')),
z AS (SELECT *, kind || ':' || start || ':' || (start + length(v)) AS x FROM a WHERE base OR score >= 0.6),
g AS (SELECT doc_id, count(*) FILTER (base AND k = 1) AS n_email, count(*) FILTER (base AND k = 2) AS n_ip,
             count(*) FILTER (base AND k = 3) AS n_card, count(*) FILTER (base AND k = 4) AS n_phone,
             string_agg(x, ',' ORDER BY k, start, start + length(v)) FILTER (base) AS b,
             string_agg(x, ',' ORDER BY k, start, start + length(v)) AS spans
      FROM z GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""

ORACLE = {"op1_minhash_dedup": OP1, "op4_embedding_dedup": OP4, "op6_mix_sources": OP6, "op11_resample": OP11,
          "op12_spelling_variants": OP12, "op13_pii": OP13}
