"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from strata.llm.pii import IBAN_LENGTH, NEAR

TOP_K = """WITH c AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings),
ok AS (SELECT vec_id FROM c GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))),
q AS (SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c JOIN ok USING (vec_id)),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
      FROM q a JOIN q b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": "(?:" + "|".join(f"{c}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for c, n in IBAN_LENGTH.items()) + ")",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"


def _luhn(digits: str) -> str:
    terms = []
    for i in range(1, 20):
        d = f"CAST(substr(lpad({digits}, 19, '0'), {i}, 1) AS INTEGER)"
        terms.append(d if i % 2 else f"(2 * {d} - CASE WHEN {d} > 4 THEN 9 ELSE 0 END)")
    return "(" + " + ".join(terms) + ") % 10 = 0"


def _mod97(iban: str) -> str:
    turned = f"(substr({iban}, 5) || substr({iban}, 1, 4))"
    for n in range(26):
        turned = f"replace({turned}, '{chr(65 + n)}', '{10 + n}')"
    rest = "''"
    for at in range(1, 76, 15):
        rest = f"CAST(CAST({rest} || substr({turned}, {at}, 15) || '' AS HUGEINT) % 97 AS VARCHAR)" if at == 1 else \
            f"CAST(CAST({rest} || substr({turned}, {at}, 15) AS HUGEINT) % 97 AS VARCHAR)"
    return f"{rest} = '1'"


_NEAR = f"lower(right(gap, {NEAR}) || ' ' || left(after, {NEAR}))"
_OK = {
    "email": "true",
    "ip": f"regexp_matches(hit, '^{_PART}\\.{_PART}\\.{_PART}\\.{_PART}$')",
    "card": "length(regexp_replace(hit, '[ -]', '', 'g')) BETWEEN 12 AND 19 AND "
            + _luhn("regexp_replace(hit, '[ -]', '', 'g')"),
    "phone": "length(regexp_replace(hit, '[^0-9]', '', 'g')) BETWEEN 9 AND 15",
    "iban": "NOT regexp_matches(gap, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AND "
            + _mod97("replace(hit, ' ', '')"),
    "ssn": "NOT regexp_matches(gap, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]') AND "
           "NOT regexp_matches(hit, '^(000|666|9)') AND NOT regexp_matches(hit, '-00-|-0000$') AND "
           f"regexp_matches({_NEAR}, '\\b(ssn|social security|social insurance)\\b') AND "
           f"NOT regexp_matches({_NEAR}, '\\b(version|invoice|order no|isbn|serial)\\b')",
}


def _personal() -> str:
    parts = []
    for k, (kind, pattern) in enumerate(_PATTERNS.items()):
        parts.append(f"""h{k} AS (SELECT doc_id, unnest(m) AS hit, generate_subscripts(m, 1) AS i FROM
 (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m FROM d)),
g{k} AS (SELECT doc_id, unnest(m) AS gap, generate_subscripts(m, 1) AS i FROM
 (SELECT doc_id, string_split_regex(text, '{pattern}') AS m FROM d WHERE doc_id IN (SELECT doc_id FROM h{k}))),
a{k} AS (SELECT g.doc_id, g.i, gap, hit, lead(gap) OVER w AS after, sum(length(gap)) OVER w
 + coalesce(sum(length(hit)) OVER (PARTITION BY g.doc_id ORDER BY g.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            0) AS start
 FROM g{k} g LEFT JOIN h{k} h ON g.doc_id = h.doc_id AND g.i = h.i WINDOW w AS (PARTITION BY g.doc_id ORDER BY g.i)),
s{k} AS (SELECT doc_id, {k} AS k, '{kind}' AS kind, CAST(start AS BIGINT) AS a, CAST(start + length(hit) AS BIGINT) AS b
 FROM a{k} WHERE hit IS NOT NULL AND {_OK[kind]})""")
    union = " UNION ALL ".join(f"SELECT * FROM s{k}" for k in range(len(_PATTERNS)))
    told = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k)"
    return ("WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),\n" + ",\n".join(parts)
            + f",\ns AS ({union}),\nt AS (SELECT doc_id, "
            + ", ".join(f"count(*) FILTER (WHERE k = {k}) AS n{k}" for k in range(4))
            + f", {told} FILTER (WHERE k < 4) AS base, {told} AS spans FROM s GROUP BY doc_id)\nSELECT d.doc_id, "
            + ", ".join(f"coalesce(n{k}, 0) AS n_{kind}" for k, kind in enumerate(list(_PATTERNS)[:4]))
            + ", sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans"
              " FROM d LEFT JOIN t ON d.doc_id = t.doc_id")


PERSONAL = _personal()

_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

CONTAMINATION = f"""WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM
 (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM
  (SELECT item, w, least(10, len(w)) AS n FROM iw WHERE len(w) > 0))),
ns AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS t FROM
 (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, ns WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.s, d.n, win.item FROM dwin d JOIN win ON d.n = win.n AND d.t = win.t),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
 (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS told FROM
 (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(told, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN held ON dw.doc_id = held.doc_id"""

HARD_NEGATIVES = """WITH c AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings),
ok AS (SELECT c.vec_id FROM c GROUP BY c.vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))),
e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings
      JOIN ok USING (vec_id) WHERE label IS NOT NULL),
q AS (SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c JOIN e USING (vec_id)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, CAST(sum(a.x * b.x) AS BIGINT) AS score
      FROM q a JOIN q b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2),
t AS (SELECT s.*, a.label = b.label AS same FROM s JOIN e a ON a.vec_id = anchor_id JOIN e b ON b.vec_id = other),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM t WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
      CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
      FROM p JOIN t ON p.anchor_id = t.anchor_id AND NOT same
       AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

_TERMS = (r"regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

LEXICAL = f"""WITH dt AS (SELECT doc_id, n, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
 FROM (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_TERMS} AS w FROM documents)) WHERE n > 0),
c AS (SELECT count(DISTINCT doc_id) AS nn, count(*) AS ll FROM dt),
tf AS (SELECT doc_id, any_value(n) AS n, t, count(*) AS tf FROM dt GROUP BY doc_id, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, c),
it AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id,
 translate(unnest({_TERMS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark) GROUP BY 1, 2),
s AS (SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS BIGINT)
 AS score FROM it JOIN w USING (t) JOIN tf USING (t), c GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s
 WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
