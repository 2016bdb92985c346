"""SQL for the queries that SQL can express."""

from dialogue_engine.llm.secret_scan import BASE_RULES, RULES

ORACLES: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(order: int) -> str:
    """Spans of one rule: a list of (start, order, end, kind)."""
    rule = RULES[order]
    pattern = _quoted(rule.pattern)
    return f"""
    SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
        s := begins[i], o := {order}, e := begins[i] + length(m[i]), kind := {_quoted(rule.kind)},
        size := length(g[i])))) AS x
    FROM (
        SELECT doc_id, m, g, list_transform(range(1, len(m) + 1), lambda i:
            list_sum(list_transform(gaps[1:i], lambda p: length(p)))::BIGINT
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda p: length(p))), 0)::BIGINT) AS begins
        FROM (
            SELECT doc_id, regexp_extract_all(t, {pattern}) AS m,
                   regexp_extract_all(t, {pattern}, {rule.group}) AS g,
                   regexp_split_to_array(t, {pattern}) AS gaps
            FROM texts WHERE regexp_matches(t, {pattern})
        )
    )"""


ORACLES["op6_secret_scan"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(map(_spans, range(len(RULES))))}),
wanted AS (
    SELECT doc_id, x FROM found
    WHERE x.size >= CASE x.o {' '.join(f'WHEN {i} THEN {r.least}' for i, r in enumerate(RULES))} END
),
listed AS (
    SELECT doc_id,
           {', '.join(f"count(*) FILTER (x.kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)},
           string_agg(x.kind || ':' || x.s || ':' || x.e, ',' ORDER BY x.s, x.o)
               FILTER (x.o < {len(BASE_RULES)}) AS base,
           string_agg(x.kind || ':' || x.s || ':' || x.e, ',' ORDER BY x.s, x.o) AS spans
    FROM wanted GROUP BY doc_id
)
SELECT d.doc_id,
       {', '.join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed USING (doc_id)
"""

# Words end at the six white-space characters; a document's shingles are compared as texts.
ORACLES["op4_ngram_jaccard_join"] = """
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM split
),
classes AS (SELECT min(doc_id) AS rep, len(s) AS n, s FROM (
    SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
tokens AS (SELECT rep, n, unnest(s) AS token FROM classes),
links AS (
    SELECT a.rep AS x, b.rep AS y FROM tokens a JOIN tokens b ON a.token = b.token AND a.rep <> b.rep
    GROUP BY a.rep, b.rep, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (
    SELECT rep AS x, rep AS y FROM classes
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
),
lowest AS (SELECT x AS rep, min(y) AS component_id FROM reach GROUP BY x)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles,
       coalesce(component_id, sets.doc_id)::BIGINT AS component_id
FROM sets
LEFT JOIN classes ON list_sort(sets.s) = classes.s
LEFT JOIN lowest ON lowest.rep = classes.rep
"""

# Two neighbouring lines are a chunk where md5(md5(first) || md5(second)) starts with a digit below f
# and they have ten words; both go if the same two stand at an earlier place.
ORACLES["op5_line_dedup"] = """
WITH cut AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
),
pairs AS (
    SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM cut
),
judged AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, i) > 1 AS again
    FROM pairs
    WHERE substr(md5(md5(line) || md5(following)), 1, 1) < 'f'
      AND len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))
          + len(regexp_extract_all(following, '[^\\x20\\x09-\\x0D]+')) >= 10
),
gone AS (
    SELECT doc_id, i FROM judged WHERE again
    UNION SELECT doc_id, i + 1 FROM judged WHERE again
),
cleaned AS (
    SELECT cut.doc_id, count(*)::BIGINT AS n_lines, count(gone.i)::BIGINT AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY cut.i) FILTER (gone.i IS NULL), '') AS rest
    FROM cut LEFT JOIN gone ON cut.doc_id = gone.doc_id AND cut.i = gone.i GROUP BY cut.doc_id
)
SELECT d.doc_id, CASE WHEN n_removed > 0 THEN rest ELSE d.text END AS text, d.lang, d.source,
       CASE WHEN n_removed > 0 THEN length(rest) ELSE d.n_chars END AS n_chars,
       n_lines, n_removed
FROM documents d JOIN cleaned USING (doc_id)
"""

# The largest page_id of a group of equal payloads of 1000 bytes or more is the response.
ORACLES["op11_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS body
  FROM pages
), g AS (SELECT body, max(page_id) AS response FROM p GROUP BY body)
SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
       CASE WHEN p.payload_bytes >= 1000 AND p.page_id < g.response
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.payload_bytes >= 1000 AND p.page_id < g.response THEN g.response END AS refers_to
FROM p JOIN g ON p.body = g.body
"""

# crc32 by its table of 256 remainders, over the bytes of doc_id:run (one byte below U+0080, else
# C3 and a second one). Near words share a key of deletion neighbourhoods: the word less a letter.
ORACLES["op13_spelling_variants"] = """
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl
), runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
                      ELSE [195::BIGINT, (unicode(ch) - 64)::BIGINT] END))),
    lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, t
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0
           THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
           ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT DISTINCT a.word, a.n, w.word, w.n FROM cut a JOIN words w ON a.less = w.word
  UNION SELECT DISTINCT w.word, w.n, a.word, a.n FROM cut a JOIN words w ON a.less = w.word
), best AS (
  SELECT word, n, count(*) AS n_near,
         first(other ORDER BY other_n DESC, encode(other)) AS form, max(other_n) AS form_n
  FROM near GROUP BY word, n
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN b.form_n >= 2 * w.n THEN b.form END AS form,
         CASE WHEN b.form_n >= 2 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), walk AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL
  SELECT walk.word, f.form, steps + 1 FROM walk JOIN forms f ON walk.root = f.word WHERE f.form IS NOT NULL
), ends AS (SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON f.word = e.word
"""
