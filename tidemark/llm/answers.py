"""The answers of :mod:`tidemark.llm.queries` in SQL, where SQL can express them."""

from __future__ import annotations

ANSWERS: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ANSWERS["op4_substring_dedup"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT r, unnest(range(1, len(w) - 33)) AS p, w FROM docs WHERE len(w) >= 35),
marked AS (SELECT r, p, array_to_string(w[p:p+34], ' ') AS m FROM windows),
repeated AS (SELECT r, p FROM marked QUALIFY count(*) OVER (PARTITION BY m) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i FROM repeated),
kept AS (
  SELECT r, list(word ORDER BY i) AS k
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs) ANTI JOIN gone USING (r, i)
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(len(k), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

ANSWERS["op7_url_filters"] = """
WITH rules(verdict, h, p) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (
  SELECT page_id, regexp_replace(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END,
    '[?#].*$', '', 's') AS r FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(split_part(coalesce(r, ''), '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(coalesce(r, ''), length(split_part(coalesce(r, ''), '/', 1)) + 1) AS path
  FROM rest),
fitting AS (
  SELECT n, h || p AS rule, verdict FROM parts JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
best AS (SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fitting GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)"""



def _linked(k: int, percent: int) -> str:
    """Documents with the least doc_id that they reach by similar sets of ``k``-word shingles."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + {k - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b
  ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= {percent} * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, seen) AS (
  SELECT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen),
least AS (SELECT node, min(seen) AS component FROM reach GROUP BY node),
found AS (
  SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id
  FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.node = d.doc_id)"""


ANSWERS["op3_minhash_near_dedup"] = _linked(4, 80) + " SELECT *, doc_id = component_id AS kept FROM found"

ANSWERS["op11_jaccard_join"] = _linked(3, 90) + " SELECT * FROM found"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ANSWERS["op13_lexical_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
totals AS (SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM docs),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs) GROUP BY ALL),
items AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS t FROM benchmark),
asked AS (SELECT DISTINCT i, item_id, unnest(t) AS term FROM items),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals WHERE term IN (SELECT term FROM asked) GROUP BY term),
factors AS (SELECT r, doc_id, 10 + (90 * len(t) * docs) // terms AS m FROM docs, totals WHERE len(t) > 0),
scores AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN factors USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) AS INT) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10"""

ANSWERS["op12_phrase_collocations"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS s FROM documents),
worded AS (SELECT lang, regexp_extract_all(s, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM worded, range(1, 5) AS sizes(size))),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, size, phrase, f AS a FROM counted WHERE size >= 2),
kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates x WHERE x.lang = c.lang AND x.size > c.size
    AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * x.a >= 80 * c.a)),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM kept)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts JOIN counted x ON x.lang = cuts.lang AND x.phrase = first
  JOIN counted y ON y.lang = cuts.lang AND y.phrase = rest),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
