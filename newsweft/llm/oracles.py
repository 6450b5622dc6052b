"""DuckDB SQL for the queries that SQL can express on whole tables.

The others have none: op2 and op9 are language models whose scores are sums of
logarithms in an order that SQL leaves open, op3, op5 and op7 need a tokenizer,
op8 a compressor and op10 Spark's hash; tests/llm compares them with brute force.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id, w.doc_id = min(r.b) AS kept
FROM words w LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.a = w.doc_id
GROUP BY w.doc_id
"""

OP4 = rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)),
lows AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM wins),
gone AS (SELECT DISTINCT doc_id, i + k AS at FROM lows, range(13) t(k) WHERE low < doc_id),
each_word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM words),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.at) AS text, count(*) AS n
  FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.at = g.at GROUP BY e.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

_BITS = "array_to_string(list_transform(string_split(h, ''), lambda x: list_extract(['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'], strpos('0123456789abcdef', x))), '')"
_FIVE = "16 * b[1 + 5 * i]::INT + 8 * b[2 + 5 * i]::INT + 4 * b[3 + 5 * i]::INT + 2 * b[4 + 5 * i]::INT + b[5 + 5 * i]::INT"

OP6 = f"""
WITH pages_ AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first, {_BITS} AS b FROM pages_)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM firsts
"""

_PHRASE = "array_to_string(p.w[{}:{}], ' ')"


def _cut(k: int) -> str:
    """The count of a phrase's first ``k`` words and of its rest."""
    return f"""
  SELECT p.lang, p.phrase, {k} AS k, x.f AS l, y.f AS r FROM found p
  JOIN counts x ON x.lang = p.lang AND x.phrase = {_PHRASE.format(1, k)} JOIN counts y ON y.lang = p.lang AND y.phrase = {_PHRASE.format(k + 1, 4)}
  WHERE p.size > {k}"""


OP11 = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
counts AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, any_value(w[i:i + k - 1]) AS w, k AS size, count(*) AS f
  FROM places, range(1, 5) t(k) WHERE i + k - 1 <= len(w) GROUP BY lang, phrase, k),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
found AS (SELECT * FROM counts WHERE size > 1 AND f >= 30),
cuts AS ({_cut(1)} UNION ALL {_cut(2)} UNION ALL {_cut(3)}),
worst AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS turn
  FROM (SELECT c.*, p.f AS a, 2000000::HUGEINT * p.f // (c.l + c.r) AS score FROM cuts c JOIN found p USING (lang, phrase))),
inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS most
  FROM found, range(2, 4) t(k), range(1, 4) u(i) WHERE k < size AND i + k - 1 <= size GROUP BY ALL),
kept AS (
  SELECT x.lang, x.phrase, x.a, x.l, x.r, t.n, x.score
  FROM worst x JOIN totals t USING (lang) LEFT JOIN inside s ON s.lang = x.lang AND s.phrase = x.phrase
  WHERE x.turn = 1 AND (s.most IS NULL OR 100::HUGEINT * s.most < 80::HUGEINT * x.a))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""

OP13 = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, r.vec_id AS b, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
pos AS (SELECT a, b, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS nth FROM s WHERE same),
neg AS (
  SELECT p.a, p.b AS p, n.b, p.score AS ps, n.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS rank
  FROM pos p JOIN s n ON n.a = p.a AND NOT n.same AND 50::HUGEINT * p.score <= 100::HUGEINT * n.score AND 100::HUGEINT * n.score <= 95::HUGEINT * p.score
  WHERE p.nth <= 5)
SELECT a AS anchor_id, p AS positive_id, rank::INTEGER AS rank, b AS negative_id, ps AS positive_score, ns AS negative_score
FROM neg WHERE rank <= 3
"""

ORACLE_SQL = {"op11_collocations": OP11, "op13_hard_negatives": OP13, "op1_near_dedup": OP1, "op4_substring_dedup": OP4, "op6_warc": OP6}
