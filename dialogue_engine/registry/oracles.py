"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark code.

``format('{:.2f}', x)`` rounds the binary value of a double, as Python does.
"""

import re

from dialogue_engine import constants as C
from dialogue_engine.registry.views import KEYWORDS, TEMPLATES, TEST_TYPES

BLANKS = "'" + C.BLANK_CHARS + "'"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rounded(value: str, digits: int) -> str:
    return f"CAST(format('{{:.{digits}f}}', CAST({value} AS DOUBLE)) AS DOUBLE)"


def hits(column: str) -> str:
    return "(" + " + ".join(
        f"CAST(contains(lower(coalesce({column}, '')), {lit(k)}) AS BIGINT)" for k in KEYWORDS
    ) + ")"


def size(column: str) -> str:
    return f"CAST(length(coalesce({column}, '')) AS BIGINT)"


CASES = """cases AS (
  SELECT d.doc_id AS case_id, d.lang || ' ' || d.source || ' ' || d.n_chars AS instruction,
         d.text AS response, d.lang AS category, d.source AS intent,
         CASE WHEN l.doc_id IS NULL THEN NULL ELSE l.quality || '-' || l.toxic END AS flags
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

RESPONSES = """responses AS (
  SELECT conv_id % 4 AS run_id, conv_id || ':' || (turn // 4) AS prompt_id,
         CASE WHEN turn % 4 < 2 THEN 'base' ELSE 'fine_tuned' END AS model, text AS output
  FROM conversations WHERE role = 'assistant')"""

DOCUMENT_RESPONSES = """responses AS (
  SELECT lang AS run_id, doc_id AS prompt_id,
         CASE WHEN doc_id % 2 = 0 THEN 'base' ELSE 'fine_tuned' END AS model, text AS output
  FROM documents)"""

WIDE = RESPONSES + """, wide AS (
  SELECT run_id, prompt_id,
         max(CASE WHEN model = 'base' THEN output END) AS base_output,
         max(CASE WHEN model = 'fine_tuned' THEN output END) AS fine_tuned_output
  FROM responses GROUP BY run_id, prompt_id)"""

LONG = WIDE + """, long AS (
  SELECT run_id, prompt_id, 'base' AS model, base_output AS output FROM wide
  UNION ALL SELECT run_id, prompt_id, 'fine_tuned', fine_tuned_output FROM wide)"""


def scored(source: str, columns: str) -> str:
    return f"""scored AS (
  SELECT {columns}, {size('output')} AS n, {hits('output')} AS k,
         length(trim(coalesce(output, ''), {BLANKS})) AS inner_size FROM {source})"""


METRICS = f"""count(*) AS num_prompts, min(n) AS length_min, max(n) AS length_max,
  {rounded('avg(n)', 1)} AS length_avg,
  coalesce({rounded('stddev_samp(n)', 1)}, 0.0) AS length_std,
  {rounded('avg(CASE WHEN k > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)', 2)} AS relevance_score,
  {rounded('avg(k)', 1)} AS keyword_count_avg,
  count(*) FILTER (WHERE inner_size = 0) AS empty_responses,
  count(*) FILTER (WHERE inner_size BETWEEN 1 AND {C.SHORT_REPLY_CHARS - 1}) AS short_responses"""

PAIRS = """pairs AS (
  SELECT conv_id, turn, text AS instruction, next_text AS response, conv_id || ':' || turn AS case_id
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""


def header(role: str) -> str:
    begin = C.BEGIN_MARK if role == "system" else ""
    return f"{begin}<|start_header_id|>{role}<|end_header_id|>\n\n"


def rendered(role: str, content: str) -> str:
    return f"{lit(header(role))} || {content} || '<|eot_id|>'"


TRAINING_TEXT = " || ".join(
    [
        rendered("system", lit(C.SYSTEM_PROMPT)),
        rendered("user", "instruction"),
        rendered("assistant", "response"),
    ]
)


def context(frame: str) -> str:
    return f"""WITH history AS (
  SELECT conv_id, turn, role, text, CASE role
    WHEN 'user' THEN {rendered('user', 'text')} ELSE {rendered('assistant', 'text')} END AS piece
  FROM conversations WHERE role IN ('user', 'assistant')),
full_text AS (
  SELECT conv_id, turn, role, {rendered('system', lit(C.SYSTEM_PROMPT))}
    || coalesce(string_agg(piece, '') OVER (PARTITION BY conv_id ORDER BY turn {frame}), '')
    || piece || {lit(header('assistant'))} AS text FROM history)
SELECT conv_id, turn, md5(text) AS digest, CAST(length(text) AS BIGINT) AS chars
FROM full_text WHERE role = 'user'"""


OPEN = """ends AS (
  SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role FROM conversations GROUP BY conv_id),
open AS (SELECT c.conv_id, c.turn, c.text AS message FROM conversations c
  JOIN ends e ON c.conv_id = e.conv_id AND c.turn = e.turn WHERE e.role = 'user')"""

SPLIT_RANK = f"""row_number() OVER (ORDER BY md5('{C.SEED}:' || case_id), case_id)"""
SHARE = f"CAST({C.TEST_SIZE} AS DECIMAL(9,6))"

LOG = """log AS (
  SELECT user_id AS run_id, event_id AS seq, CASE WHEN event_id % 3 <> 0 THEN event_id END AS step,
         CASE WHEN event_type = 'view' THEN value END AS loss FROM events),
losses AS (
  SELECT run_id, seq, step, row_number() OVER (PARTITION BY run_id ORDER BY seq) - 1 AS position, """ + rounded(
    "loss", 4
) + """ AS loss FROM log WHERE loss IS NOT NULL)"""

TPL = f"""tpl AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE o_orderkey % {len(TEMPLATES)} {' '.join(f'WHEN {i} THEN {lit(t)}' for i, t in enumerate(TEMPLATES))} END
      || ' ' || o_orderpriority || ' {{{{Field ' || o_custkey % 5 || '}}}}'
      || repeat(' {{{{Status}}}}', o_custkey % 4)
      || CASE WHEN o_custkey % 3 = 0 THEN ' {{{{Order Number' ELSE '' END AS text
  FROM orders)"""

# every name the texts have, each replaced on its own: no value holds a token
_NAMES = sorted({n for t in TEMPLATES for n in re.findall(r"\{\{([^{}]+)\}\}", t)} | {f"Field {i}" for i in range(5)})


def _generic(column: str) -> str:
    for name in _NAMES:
        phrase = C.PLACEHOLDER_PHRASES.get(name, name.lower())
        column = f"replace({column}, {lit('{{' + name + '}}')}, {lit(phrase)})"
    return column


# The files of the queries on stored evaluations: 40 conversations each, in three shapes.
FILES = """entries AS (
  SELECT conv_id // 40 AS run, (conv_id // 40) % 3 AS shape, conv_id || ':' || turn AS prompt, text,
    CASE WHEN (conv_id // 40) % 3 <> 1 AND turn % 3 <> 0 THEN text || '!' END AS tuned,
    row_number() OVER (PARTITION BY conv_id // 40 ORDER BY conv_id, turn) - 1 AS pos
  FROM conversations WHERE role = 'assistant')"""

# Run statistics: the events of 25 users are a run.
STATS = """entries AS (
  SELECT user_id // 25 AS run, event_id, user_id, event_type, value, event_id % 1000 + 4294967296 AS size,
    CASE WHEN event_type = 'click' THEN event_id % 1000 + 4294967296 ELSE 0 END AS trainable,
    row_number() OVER (PARTITION BY user_id // 25 ORDER BY event_id) - 1 AS pos
  FROM events)"""

FORMAT_BLANKS = f"'[{C.BLANK_CHARS}]+'"


def normal(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), {FORMAT_BLANKS}, ' ', 'g'), ' ')"


RECORDS = LONG + ", " + scored("long", "run_id, model") + f""",
m AS (SELECT run_id, model, {METRICS} FROM scored GROUP BY run_id, model),
records AS (
  SELECT b.run_id, b.num_prompts, b.length_avg AS avg_length_base, f.length_avg AS avg_length_fine_tuned,
    b.relevance_score AS relevance_score_base, f.relevance_score AS relevance_score_fine_tuned,
    f.length_min, f.length_max, f.length_std, f.empty_responses, f.short_responses,
    f.keyword_count_avg
  FROM m b JOIN m f ON b.run_id = f.run_id AND b.model = 'base' AND f.model = 'fine_tuned')"""

_KIND = "CASE conv_id % 5 " + " ".join(
    f"WHEN {i} THEN {lit(t)}" for i, t in enumerate(TEST_TYPES)
) + " END"


def overlap(prompts: str, n: int) -> str:
    """Share of the prompts' n-grams in the documents, compared as texts."""
    grams = f"""unnest(list_transform(range(1, greatest(len(w) - {n - 1}, 1) + 1),
    lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS g"""
    return f"""WITH prompts AS ({prompts}),
words AS (SELECT prompt_id, string_split({normal('text')}, ' ') AS w FROM prompts),
data AS (SELECT string_split({normal('text')}, ' ') AS w FROM documents),
grams AS (SELECT DISTINCT prompt_id, {grams} FROM words WHERE w[1] <> ''),
known AS (SELECT DISTINCT {grams} FROM data WHERE w[1] <> ''),
counted AS (SELECT prompt_id, count(*) AS ngrams, count(known.g) AS found
  FROM grams LEFT JOIN known USING (g) GROUP BY prompt_id)
SELECT prompt_id, coalesce(ngrams, 0) AS ngrams, coalesce(found, 0) AS found,
  {rounded('coalesce(found / nullif(ngrams, 0), 0)', 4)} AS share
FROM prompts LEFT JOIN counted USING (prompt_id)"""


def _single_metrics() -> str:
    """Metrics of the record query: even runs with two models, odd ones with one."""
    return LONG + f""", replies AS (
  SELECT run_id, model, output FROM long WHERE run_id % 2 = 0
  UNION ALL SELECT run_id, 'single', base_output FROM wide WHERE run_id % 2 = 1
  UNION ALL SELECT run_id + 10, 'single', NULL FROM wide
  UNION ALL SELECT run_id + 20, 'base', base_output FROM wide
  UNION ALL SELECT run_id + 20, 'fine_tuned', NULL FROM wide),
{scored('replies', 'run_id, model')},
m AS (SELECT run_id, model, {METRICS} FROM scored GROUP BY run_id, model)"""


def _pick(column: str, model: str) -> str:
    return f"max(CASE WHEN model = '{model}' THEN {column} END)"


_STORED = {"base": "base", "fine_tuned": "fine_tuned", "single": "ollama"}
_RECORD_COLUMNS = ",\n  ".join(
    [f"{_pick('length_avg', m)} AS avg_length_{s}" for m, s in _STORED.items()]
    + [f"{_pick('relevance_score', m)} AS relevance_score_{s}" for m, s in _STORED.items()]
    + [
        f"{_pick('length_' + p, m)} AS length_stats_{s}_{p}"
        for m, s in _STORED.items()
        for p in ("min", "max", "avg", "std")
    ]
    + [
        f"coalesce({_pick(c, 'fine_tuned')}, {_pick(c, 'single')}) AS {c}"
        for c in ("empty_responses", "short_responses", "keyword_count_avg")
    ]
)

ORACLES: dict[str, str] = {
    "evaluation_metrics": f"""WITH {LONG}, {scored('long', 'run_id, model')}
SELECT run_id, model, {METRICS} FROM scored GROUP BY run_id, model""",
    "evaluation_metrics_documents": f"""WITH {DOCUMENT_RESPONSES}, {scored('responses', 'run_id, model')}
SELECT run_id, model, {METRICS} FROM scored GROUP BY run_id, model""",
    "evaluation_record": f"""WITH {_single_metrics()}
SELECT run_id, max(num_prompts) AS num_prompts, {_RECORD_COLUMNS},
  {_pick('keyword_count_avg', 'base')} AS keyword_count_avg_base
FROM m GROUP BY run_id""",
    "reply_scores": f"""WITH {DOCUMENT_RESPONSES}, {scored('responses', 'prompt_id, model')}
SELECT prompt_id, model, n AS chars, k AS keywords,
  CASE WHEN inner_size = 0 THEN 'empty' WHEN inner_size < 20 THEN 'short' ELSE 'ok' END AS reply_class
FROM scored""",
    "result_mode": f"""WITH {WIDE}
SELECT prompt_id AS run_id, CASE WHEN fine_tuned_output IS NOT NULL THEN 'two' ELSE 'single' END AS mode
FROM wide""",
    "side_by_side": f"""WITH {WIDE}
SELECT *, 'Base: ' || {size('base_output')} || ' chars. Fine-tuned: ' || {size('fine_tuned_output')}
  || ' chars. Fine-tuned should be more specific and professional.' AS commentary FROM wide""",
    "ab_delta": f"""WITH {WIDE}
SELECT run_id, prompt_id, {size('fine_tuned_output')} - {size('base_output')} AS length_delta,
  {hits('fine_tuned_output')} - {hits('base_output')} AS keyword_delta,
  CAST({hits('fine_tuned_output')} > 0 AS BIGINT) - CAST({hits('base_output')} > 0 AS BIGINT) AS relevance_delta
FROM wide""",
    "ab_summary": f"""WITH {WIDE}, d AS (
  SELECT run_id, {size('fine_tuned_output')} - {size('base_output')} AS l,
    {hits('fine_tuned_output')} - {hits('base_output')} AS k,
    CAST({hits('fine_tuned_output')} > 0 AS BIGINT) - CAST({hits('base_output')} > 0 AS BIGINT) AS r
  FROM wide)
SELECT run_id, count(*) AS num_prompts, {rounded('avg(l)', 1)} AS length_delta_avg,
  {rounded('avg(k)', 1)} AS keyword_delta_avg, {rounded('avg(r)', 2)} AS relevance_delta_avg,
  count(*) FILTER (WHERE k > 0) AS gained, count(*) FILTER (WHERE k < 0) AS lost
FROM d GROUP BY run_id""",
    "comparison_table": f"""WITH {WIDE}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY prompt_id) AS shown,
    count(*) OVER (PARTITION BY run_id) AS total FROM wide)
SELECT run_id, shown, prompt_id, substr(coalesce(base_output, ''), 1, 300) AS base_output,
  substr(coalesce(fine_tuned_output, ''), 1, 300) AS fine_tuned_output, total
FROM numbered WHERE shown <= 15""",
    "metrics_by_test_type": f"""WITH {RESPONSES}, catalog AS (
  SELECT DISTINCT conv_id || ':' || (turn // 4) AS prompt_id, {_KIND} AS test_type
  FROM conversations WHERE role = 'user'),
typed AS (SELECT c.test_type, r.model, r.output FROM responses r LEFT JOIN catalog c USING (prompt_id)),
{scored('typed', 'test_type, model')}
SELECT test_type, model, {METRICS} FROM scored GROUP BY test_type, model""",
    "weak_intents": f"""WITH replies AS (SELECT source AS intent, text AS output FROM documents),
{scored('replies', 'intent')}, m AS (SELECT intent, {METRICS} FROM scored GROUP BY intent)
SELECT * FROM m ORDER BY relevance_score, short_responses / num_prompts DESC, intent LIMIT 10""",
    "metrics_by_lang": f"""WITH replies AS (SELECT lang, source, text AS output FROM documents),
{scored('replies', 'lang, source')} SELECT lang, source, {METRICS} FROM scored GROUP BY lang, source""",
    "metrics_or_recompute": f"""WITH {RECORDS}
SELECT run_id, CASE WHEN run_id >= 2 THEN num_prompts + 1000 ELSE num_prompts END AS num_prompts,
  CASE WHEN run_id < 2 THEN avg_length_base END AS avg_length_base,
  CASE WHEN run_id < 2 THEN relevance_score_base ELSE 0.0 END AS relevance_score_base,
  CASE WHEN run_id < 2 THEN short_responses END AS short_responses,
  CASE WHEN run_id < 2 THEN 'computed' ELSE 'stored' END AS source
FROM records""",
    "report_cards": f"""WITH {RECORDS}, cards AS (
  SELECT run_id, unnest(['relevance_base', 'relevance_fine_tuned', 'avg_length_base',
    'avg_length_fine_tuned', 'prompts', 'length_min', 'length_max', 'length_std', 'keyword_density',
    'empty_replies', 'short_replies']) AS card,
    unnest([coalesce(nullif(relevance_score_base, 0), NULL), relevance_score_fine_tuned,
      nullif(avg_length_base, 0), avg_length_fine_tuned, num_prompts, length_min, length_max,
      length_std, keyword_count_avg, empty_responses, short_responses]::DOUBLE[]) AS value
  FROM records WHERE run_id < 2
  UNION ALL
  SELECT run_id, unnest(['relevance_base', 'prompts', 'empty_replies', 'short_replies']),
    unnest([0.5, num_prompts + 1000, 0, 0]::DOUBLE[]) FROM records WHERE run_id >= 2)
SELECT * FROM cards WHERE value IS NOT NULL""",
    "invalid_comparison": f"""WITH {WIDE}, modes AS (
  SELECT prompt_id AS run_id, CASE WHEN fine_tuned_output IS NOT NULL THEN 'two' ELSE 'single' END AS mode
  FROM wide),
configs AS (SELECT DISTINCT conv_id || ':' || (turn // 4) AS run_id,
  CASE conv_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS adapter_loaded FROM conversations)
SELECT run_id, mode, adapter_loaded, mode = 'two' AND adapter_loaded IS NOT DISTINCT FROM false AS invalid
FROM modes LEFT JOIN configs USING (run_id)""",
    "excerpts": """SELECT conv_id, turn,
  CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END AS progress,
  substr(text, 1, 200) AS cell FROM conversations""",
    "extract_reply": f"""SELECT conv_id, turn, CASE WHEN turn % 3 = 0
  THEN trim(string_split(trim(string_split('x assistant' || chr(10) || chr(10) || ' ' || text
         || ' <|end|> y', 'assistant')[-1], {BLANKS}), '<|')[1], {BLANKS})
  ELSE ' ' || text END AS reply FROM conversations""",
    "reply_json": """SELECT event_id, CASE WHEN event_id % 3 = 0
    THEN json_extract_string('{"message":{"role":"assistant","content":"' || replace(props, '"', '''') || '"}}',
                             '$.message.content') ELSE '' END AS content,
  event_id % 3 = 2 AS bad_json FROM events""",
    "pair_turns": f"WITH {PAIRS} SELECT conv_id, turn, instruction, response FROM pairs",
    "pair_turns_with_gaps": f"""WITH {PAIRS}
SELECT conv_id, (turn - 2) * 1000003 AS turn, instruction, response FROM pairs""",
    "number_turns": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn,
  role, text FROM conversations""",
    "chat_rendered": f"""WITH {PAIRS}, texts AS (SELECT case_id, {TRAINING_TEXT} AS text FROM pairs)
SELECT case_id, md5(text) AS digest, CAST(length(text) AS BIGINT) AS chars FROM texts""",
    "messages_exploded": f"""WITH {PAIRS}
SELECT case_id, 0::INTEGER AS position, 'system' AS role, {lit(C.SYSTEM_PROMPT)} AS content FROM pairs
UNION ALL SELECT case_id, 1, 'user', instruction FROM pairs
UNION ALL SELECT case_id, 2, 'assistant', response FROM pairs""",
    "length_band": f"""WITH {CASES} SELECT case_id, category, intent FROM cases
WHERE length(response) BETWEEN 57 AND 2470""",
    "in_scope": f"WITH {CASES} SELECT case_id, category, intent FROM cases WHERE category IN ('de', 'fr')",
    "dedupe": f"""WITH {CASES} SELECT min(case_id) AS case_id, flags, category,
  arg_min(intent, case_id) AS intent FROM cases GROUP BY flags, category""",
    "cap_per_template": f"""WITH {CASES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY response ORDER BY md5('{C.SEED}:' || case_id), case_id) AS r
  FROM cases)
SELECT case_id, md5(response) AS response, intent FROM ranked WHERE r <= 2""",
    "fallback_union": f"""WITH {CASES}
SELECT case_id, instruction, md5(response) AS response, category, intent, flags FROM cases
UNION ALL SELECT -1 - item_id, text, md5({lit(C.FALLBACK_REPLY)}), NULL, 'out_of_scope', NULL FROM benchmark""",
    "random_split": f"""WITH {CASES}
SELECT case_id, {SPLIT_RANK} <= ceil({SHARE} * (SELECT count(*) FROM cases)) AS is_eval FROM cases""",
    "random_split_approx": f"""WITH {CASES}
SELECT case_id, CAST('0x' || substr(md5('{C.SEED}:' || case_id), 1, 8) AS BIGINT)
  < {int(C.TEST_SIZE * 2**32)} AS is_eval FROM cases""",
    "stratified_split": f"""WITH {CASES}
SELECT case_id, intent, row_number() OVER (PARTITION BY intent ORDER BY md5('{C.SEED}:' || case_id), case_id)
  <= ceil({SHARE} * count(*) OVER (PARTITION BY intent)) AS is_eval FROM cases""",
    "subset": f"""WITH {CASES}, ranked AS (
  SELECT case_id, {SPLIT_RANK} AS r, ceil({SHARE} * (SELECT count(*) FROM cases)) AS k FROM cases)
SELECT case_id, CASE WHEN r <= k THEN 'eval' ELSE 'train' END AS part FROM ranked
WHERE r <= least(50, k) OR (r > k AND r <= k + 100)""",
    "split_examples": f"""WITH {PAIRS}, texts AS (
  SELECT case_id, {TRAINING_TEXT} AS text,
    {SPLIT_RANK} <= ceil({SHARE} * (SELECT count(*) FROM pairs)) AS is_eval FROM pairs)
SELECT case_id, md5(text) AS digest, CAST(length(text) AS BIGINT) AS chars,
  CASE WHEN is_eval THEN 'eval' ELSE 'train' END AS part FROM texts""",
    "eval_coverage": f"""WITH {CASES}, flagged AS (
  SELECT category || '/' || intent AS intent,
    {SPLIT_RANK} <= ceil({SHARE} * (SELECT count(*) FROM cases)) AS is_eval FROM cases)
SELECT DISTINCT intent FROM flagged WHERE NOT is_eval
  AND intent NOT IN (SELECT intent FROM flagged WHERE is_eval)""",
    "review_sample": f"""WITH {CASES} SELECT case_id, md5(response) AS response FROM cases
ORDER BY md5('{C.SEED}:' || case_id), case_id LIMIT 30""",
    "chat_context": context("ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"),
    "chat_context_shifted": context("ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING").replace(
        "SELECT conv_id, turn, md5(text)", "SELECT conv_id, turn * 101 - 150 AS turn, md5(text)"
    ),
    "chat_context_last4": context("ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING"),
    "append_reply": f"""WITH {OPEN}
SELECT conv_id, turn, role, text FROM conversations
UNION ALL SELECT conv_id, turn + 1, 'assistant', 'Re: ' || message FROM open
UNION ALL SELECT conv_id, turn + 2, 'user', 'And?' FROM open
UNION ALL SELECT conv_id, turn + 3, 'assistant', 'Re: ' || message FROM open""",
    "request_context": f"""WITH {OPEN}, asked AS (
  SELECT o.conv_id, {rendered('system', lit(C.SYSTEM_PROMPT))} || string_agg(
      CASE c.role WHEN 'user' THEN {rendered('user', 'c.text')}
                  WHEN 'assistant' THEN {rendered('assistant', 'c.text')} ELSE '' END, '' ORDER BY c.turn)
    || {lit(header('assistant'))} AS text
  FROM open o JOIN conversations c ON c.conv_id = o.conv_id GROUP BY o.conv_id)
SELECT conv_id, md5(text) AS digest, CAST(length(text) AS BIGINT) AS chars FROM asked""",
    "request_gate": """SELECT conv_id, turn, md5(text) AS message,
  CAST(CASE WHEN conv_id % 3 = 0 THEN 192 ELSE (conv_id % 3) * 64 END AS BIGINT) AS max_tokens
FROM conversations WHERE role = 'user'""",
    "request_json": """SELECT conv_id, turn, 'm1' AS model, 'false' AS stream, md5(text) AS content,
  CAST(CASE WHEN conv_id % 2 <> 0 THEN NULL WHEN conv_id % 3 = 0 THEN 192 ELSE (conv_id % 3) * 64 END
    AS BIGINT) AS num_predict,
  conv_id % 2 = 0 AS has_options
FROM conversations WHERE role = 'user'""",
    "fan_out_generate": """SELECT conv_id, turn, model,
  CASE WHEN turn % 3 > 0 THEN 9007199254740993 + conv_id END AS large,
  CASE WHEN length(text) % 7 <> 0 THEN prefix || ' 2: ' || text END AS output,
  CASE WHEN length(text) % 7 = 0 THEN 'ValueError: seven' END AS error
FROM conversations, (VALUES ('base', 'b'), ('fine_tuned', 'f')) AS models(model, prefix)
WHERE role = 'user'""",
    "placeholder_inventory": f"""WITH {TPL}, names AS (
  SELECT o_orderkey, unnest(regexp_extract_all(text, '\\{{\\{{([^{{}}]+)\\}}\\}}', 1)) AS placeholder FROM tpl)
SELECT placeholder, count(*) AS occurrences, count(DISTINCT o_orderkey) AS texts
FROM names GROUP BY placeholder""",
    "placeholder_generic": f"""WITH {TPL}
SELECT o_orderkey, {_generic('text')} AS text FROM tpl""",
    "placeholder_strip": f"""WITH {TPL}
SELECT o_orderkey, regexp_replace(text, '\\{{\\{{[^{{}}]+\\}}\\}}', '', 'g') AS text FROM tpl""",
    "placeholder_keep": f"WITH {TPL} SELECT o_orderkey, text FROM tpl",
    "token_counts": f"""SELECT doc_id,
  CAST(len(regexp_extract_all(text, '[^{C.BLANK_CHARS}]+')) AS BIGINT) AS tokens FROM documents""",
    "mapped_rows": "SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS chars FROM conversations",
    "cases_with_ids": f"""WITH {CASES}
SELECT instruction, md5(response) AS response, category, intent, flags, 1::BIGINT AS uses FROM cases""",
    "placeholder_fill": f"""WITH {TPL}
SELECT o_orderkey, replace(replace(replace(text, '{{{{Order Number}}}}', o_orderkey::VARCHAR),
  '{{{{Customer}}}}', c_name), '{{{{Status}}}}', o_orderstatus) AS text
FROM tpl JOIN customer ON o_custkey = c_custkey""",
    "held_out": f"""WITH prompts AS (
  SELECT -1 - item_id AS prompt_id, text AS prompt FROM benchmark
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 2 = 0
    THEN ' ' || replace(text, ' ', chr(10) || ' ') || chr(9) ELSE text || ' new' END FROM documents),
known AS (SELECT DISTINCT {normal('text')} AS t FROM documents)
SELECT prompt_id, md5(prompt) AS prompt FROM prompts p
WHERE NOT EXISTS (SELECT 1 FROM known WHERE t = {normal('p.prompt')})""",
    "held_out_overlap": overlap(
        """SELECT -1 - item_id AS prompt_id, text FROM benchmark
  UNION ALL SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, 'an', 'on')
    WHEN 1 THEN 'New ' || replace(text, ' ', '  ') || chr(9) || 'new' ELSE text END FROM documents""",
        8,
    ),
    "held_out_overlap_items": overlap("SELECT item_id AS prompt_id, text FROM benchmark", 13),
    "loss_series": f"WITH {LOG} SELECT run_id, seq, coalesce(step, position) AS step, loss FROM losses",
    "loss_scaled": f"""WITH {LOG}, bounds AS (
  SELECT run_id, count(*) AS n, min(loss) AS mn, CASE WHEN max(loss) = 0 THEN 1 ELSE max(loss) END AS mx
  FROM losses GROUP BY run_id)
SELECT run_id, seq, position / greatest(n - 1, 1) AS x,
  (loss - mn) / CASE WHEN mx - mn = 0 THEN 1 ELSE mx - mn END AS y
FROM losses JOIN bounds USING (run_id)""",
    "loss_summary": f"""WITH {LOG}
SELECT run_id, arg_max(loss, seq) AS final_loss, min(loss) AS min_loss FROM losses GROUP BY run_id""",
    "trainable_share": f"""WITH p AS (
  SELECT p_brand AS model_name,
    CAST(coalesce(sum(p_size) FILTER (WHERE p_partkey % 7 = 0), 0) AS BIGINT) AS trainable_params,
    CAST(sum(p_size) AS BIGINT) AS total_params FROM part GROUP BY p_brand)
SELECT *, {rounded('100 * trainable_params / total_params', 2)} AS trainable_pct FROM p""",
    "cost_proxy": f"""WITH t AS (
  SELECT user_id AS run_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds,
    CAST(count(*) FILTER (WHERE event_type = 'view') * (user_id % 3) * 1000000 AS BIGINT) AS trainable_params
  FROM events GROUP BY user_id)
SELECT run_id, trainable_params,
  CASE WHEN trainable_params <> 0 THEN {rounded('seconds * trainable_params / 1e9', 2)} END AS cost_proxy
FROM t""",
    "distribution": f"""WITH {CASES}
SELECT category, intent, count(*) AS cases, count(DISTINCT instruction) AS instructions,
  count(DISTINCT response) AS templates, count(DISTINCT flags) AS flags,
  {rounded('count(*) / (SELECT count(*) FROM cases)', 4)} AS share
FROM cases GROUP BY category, intent""",
    "length_profile": f"""WITH {CASES}, l AS (
  SELECT 'instruction' AS "column", length(instruction) AS n FROM cases
  UNION ALL SELECT 'response', length(response) FROM cases)
SELECT "column", CAST(min(n) AS BIGINT) AS length_min, CAST(max(n) AS BIGINT) AS length_max,
  {rounded('quantile_cont(n, 0.5)', 1)} AS p50, {rounded('quantile_cont(n, 0.95)', 1)} AS p95,
  {rounded('quantile_cont(n, 0.99)', 1)} AS p99
FROM l GROUP BY "column\"""",
    "longest_cases": """SELECT doc_id AS case_id, source AS intent, CAST(length(text) AS BIGINT) AS chars
FROM documents ORDER BY length(text) DESC, doc_id LIMIT 20""",
    "truncation_monitor": f"""WITH t AS (
  SELECT source AS intent, CAST(len(regexp_extract_all({TRAINING_TEXT}, '[^{C.BLANK_CHARS}]+')) AS BIGINT) AS n
  FROM (SELECT source, lang || ' ' || source || ' ' || n_chars AS instruction, text AS response FROM documents))
SELECT intent, count(*) AS cases, max(n) AS tokens_max, count(*) FILTER (WHERE n > 1024) AS truncated,
  {rounded('avg(CASE WHEN n > 1024 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)', 4)} AS truncated_share
FROM t GROUP BY intent""",
    "table_profile": f"""WITH {CASES}, c AS (SELECT count(*) AS rows, count(flags) AS flagged FROM cases)
SELECT CAST(position AS BIGINT) AS position, name AS "column", type, rows,
  CASE WHEN name = 'flags' THEN flagged ELSE rows END AS filled
FROM c, (VALUES (0, 'case_id', 'bigint'), (1, 'instruction', 'string'), (2, 'response', 'string'),
  (3, 'category', 'string'), (4, 'intent', 'string'), (5, 'flags', 'string')) AS v(position, name, type)""",
    "preview": "SELECT * FROM documents ORDER BY doc_id LIMIT 3 OFFSET 5",
    "preview_far": """SELECT o_orderkey, o_custkey, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 12000""",
    "in_scope_table": f"""WITH {CASES}, chosen AS (
  SELECT category FROM cases GROUP BY category HAVING count(*) % 2 = 0)
SELECT case_id, category, md5(response) AS response FROM cases WHERE category IN (SELECT category FROM chosen)""",
    "distribution_totals": f"""WITH {CASES}
SELECT CAST(2 - grouping(category) - grouping(intent) AS INTEGER) AS level, category, intent,
  count(*) AS cases, count(DISTINCT instruction) AS instructions,
  count(DISTINCT response) AS templates, count(DISTINCT flags) AS flags,
  {rounded('count(*) / (SELECT count(*) FROM cases)', 4)} AS share
FROM cases GROUP BY ROLLUP (category, intent)""",
    "cases_from_csv": f"""WITH {CASES}
SELECT instruction, md5(response) AS response, category, intent, flags, 1::BIGINT AS uses FROM cases""",
    "resumed_answers": """SELECT conv_id || ':' || turn AS prompt_id, 'again 2: ' || text AS output, NULL::VARCHAR AS error
FROM conversations WHERE role = 'user' AND conv_id % 3 > 0
UNION ALL SELECT conv_id || ':' || turn, 'first 2: ' || text, NULL
FROM conversations WHERE role = 'user' AND conv_id % 3 = 0""",
    "results_written": f"""WITH {RESPONSES}
SELECT run_id::VARCHAR AS run_id, prompt_id, model, md5(CASE WHEN run_id % 2 = 0 THEN 'new ' || output ELSE output END) AS output
FROM responses""",
    "evaluation_files": f"""WITH {FILES}
SELECT run, shape, CAST(pos AS BIGINT) AS prompt_id, prompt,
  md5(CASE WHEN shape <> 1 THEN text END) AS base_output, md5(tuned) AS fine_tuned_output,
  md5(CASE WHEN shape = 1 THEN text END) AS ollama_output, coalesce(shape <> 1 AND tuned IS NOT NULL, false) AS has_two
FROM entries""",
    "evaluation_file_metrics": f"""WITH {FILES}
SELECT run, count(*) AS num_prompts, CASE WHEN shape = 0 THEN CAST(max(length(text)) AS DOUBLE) END AS avg_length_base,
  CASE WHEN shape = 1 THEN CAST(max(length(text)) AS DOUBLE) END AS avg_length_ollama,
  CAST(min(length(text)) AS BIGINT) AS shortest
FROM entries WHERE shape < 2 GROUP BY run, shape""",
    "evaluation_file_configs": f"""WITH {FILES}
SELECT DISTINCT run, CASE WHEN shape = 0 THEN 'm' || run END AS base_model,
  CASE WHEN shape = 0 AND run % 2 = 0 THEN 'a' || run END AS adapter_path,
  CASE WHEN shape = 0 THEN run % 2 = 0 END AS adapter_loaded FROM entries""",
    "run_stats_files": f"""WITH {STATS}
SELECT run, 'm' || run AS model_name, sum(trainable)::BIGINT AS trainable_params, sum(size)::BIGINT AS total_params,
  max(event_id)::DOUBLE AS duration_seconds, max(user_id)::VARCHAR AS batch_size,
  CASE WHEN run % 2 = 0 THEN 'true' ELSE 'false' END AS used_4bit
FROM entries GROUP BY run""",
    "run_stats_log": f"""WITH {STATS}
SELECT run, CAST(pos AS BIGINT) AS seq, CASE WHEN event_id % 3 <> 0 THEN event_id END AS step,
  CASE WHEN event_type = 'view' THEN value END AS loss FROM entries""",
}
