"""The expected result of each query as SQL over the same tables.

Written from the meaning of the operators and not from their code: where Spark
uses one form (an array filter, a digest join, a stream), the SQL uses another.
"""

from __future__ import annotations

from transqa.config import (
    BACK_TRANSLATE_PROMPT,
    DETECT_PROMPT,
    TRANSLATE_PROMPT,
    TRANSLATION_GUIDELINES,
)
from transqa.functions.detect import STOP_WORDS

_STOP = ", ".join(f"('{code}', '{word}')" for code, words in STOP_WORDS.items() for word in words)

# Stop words joined to the words of each text's prefix, counted and ranked.
_DETECT = rf"""
stop(lang, word) AS (VALUES {_STOP}),
words AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}]+')) AS word
  FROM documents),
hits AS (SELECT doc_id, lang, count(*) AS n FROM words JOIN stop USING (word) GROUP BY ALL),
best AS (
  SELECT doc_id, lang FROM hits
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) = 1),
detected AS (
  SELECT d.doc_id, d.text, coalesce(b.lang, 'und') AS detected_language
  FROM documents d LEFT JOIN best b USING (doc_id))
"""


_DETECT_CHARS, _TRANSLATE_CHARS, _BACK_CHARS = (
    len(prompt.replace("${text}", "").replace("${lang}", ""))
    for prompt in (DETECT_PROMPT, TRANSLATE_PROMPT, BACK_TRANSLATE_PROMPT)
)


def _made(parts: int) -> str:
    return f"left(text, (length(text) * (length(text) % {parts})) // {parts})"


# Documents with made translations.
_DOUBLE = f"""
tr AS (
  SELECT doc_id, text, lang AS detected_language,
         {_made(10)} AS english, {_made(7)} AS back
  FROM documents),
ev AS (
  SELECT doc_id, detected_language, text AS original,
         english AS english, back AS back
  FROM tr)
"""


def _double_detect(text: str) -> str:
    head = f"{text}"
    return (
        f"CASE WHEN contains({head}, ' the ') OR contains({head}, ' and ') THEN 'en' "
        f"WHEN contains({head}, ' der ') OR contains({head}, ' und ') THEN 'de' "
        f"WHEN contains({head}, ' que ') OR contains({head}, ' los ') THEN 'es' "
        f"WHEN contains({head}, ' le ') OR contains({head}, ' et ') THEN 'fr' ELSE 'xx' END"
    )


def _double_translate(text: str, endpoint_chars: int | str) -> str:
    n = f"length({text})"
    return (
        f"CASE WHEN {n} % 97 = 0 THEN NULL "
        f"ELSE left({text}, ({n} * (({n} + {endpoint_chars}) % 10)) // 10) END"
    )


# What the double client makes of a full run; its endpoint 'standard' has 8 letters.
_PHASE_ONE = f"""
one AS (
  SELECT doc_id, text, {_double_detect("text")} AS detected_language,
         {_double_translate("text", 8)} AS english
  FROM documents),
two AS (
  SELECT *, CASE WHEN detected_language = 'en' THEN english
                 ELSE '[' || detected_language || '] ' || english END AS back
  FROM one)
"""
_TRANSLATED = """
SELECT doc_id, detected_language, english AS english_translation, back AS back_translation
FROM two"""

_RATIO = "length(english) / greatest(length(original), 1)"
_PERCENT = f"CAST(CAST(round_even(({_RATIO}) * 100, 0) AS BIGINT) AS VARCHAR) || '%'"


def _completeness(source: str) -> str:
    return f"""
complete AS (
  SELECT doc_id,
    CASE WHEN detected_language = 'en' THEN true
         WHEN english IS NULL THEN NULL
         ELSE {_RATIO} >= 0.3 END AS value,
    CASE WHEN detected_language = 'en' THEN 'Document already in English.'
         WHEN english IS NULL THEN NULL
         WHEN {_RATIO} < 0.3 THEN 'Translation is only ' || {_PERCENT}
              || ' the length of original — likely content omitted.'
         ELSE 'Translation length ratio: ' || {_PERCENT} || ' — within acceptable range.'
    END AS rationale,
    CASE WHEN detected_language <> 'en' AND english IS NULL THEN 'null_input' END AS error
  FROM {source})"""


def _semantic(source: str) -> str:
    n = "length(original)"
    good = f"({n} % 5 NOT IN (2, 3))"
    return f"""
semantic AS (
  SELECT doc_id,
    CASE WHEN detected_language = 'en' THEN true
         WHEN back IS NULL THEN NULL WHEN {good} THEN {n} % 3 <> 0 END AS value,
    CASE WHEN detected_language = 'en' THEN 'Document already in English, no translation needed.'
         WHEN back IS NULL THEN NULL WHEN {good} THEN 'read ' || {n} END AS rationale,
    CASE WHEN detected_language = 'en' THEN NULL
         WHEN back IS NULL THEN 'null_input' WHEN NOT {good} THEN 'judge_json' END AS error
  FROM {source})"""


def _guidelines(source: str) -> str:
    """All rules in one call, of as many characters as the joined rules have."""
    rule = len("\n".join(TRANSLATION_GUIDELINES))
    kept = f"({rule} + length(original)) % 11 <> 0"
    return f"""
guided AS (
  SELECT *, {kept} AS value,
    CASE WHEN {kept} THEN 'All guidelines are met.' ELSE 'rule of {rule}' END AS rationale,
    CAST(NULL AS VARCHAR) AS error
  FROM {source})"""


def _rule_by_rule(source: str) -> str:
    chars = ", ".join(str(len(rule)) for rule in TRANSLATION_GUIDELINES)
    return f"""
ruled AS (
  SELECT doc_id, coalesce(bool_and((rule + length(original)) % 11 <> 0), true) AS value,
    coalesce(
      string_agg(CASE WHEN (rule + length(original)) % 11 = 0 THEN 'rule of ' || rule END, '; '
                 ORDER BY number),
      'All guidelines are met.') AS rationale,
    CAST(NULL AS VARCHAR) AS error
  FROM {source},
       (SELECT unnest([{chars}]) AS rule, unnest(range({len(TRANSLATION_GUIDELINES)})) AS number)
  GROUP BY doc_id)"""


_SCORED = f"WITH {_DOUBLE}, {_semantic('ev')}, {_completeness('ev')}, {_guidelines('ev')}"
_TIDY = """
tidy AS (
  SELECT doc_id, 'semantic_preservation' AS scorer, value, rationale, error FROM semantic
  UNION ALL SELECT doc_id, 'completeness_check', value, rationale, error FROM complete
  UNION ALL SELECT doc_id, 'translation_quality', value, rationale, error FROM guided)"""
_METRICS = (
    "avg(CAST(value AS INT)) AS pass_rate, count(value) AS scored, "
    "count(*) FILTER (WHERE value) AS passed, count(error) AS errors"
)

_STATUS = """
CASE WHEN s0.detected_language = 'en' THEN 'SKIPPED'
     WHEN coalesce(semantic.value, false) AND coalesce(complete.value, false) THEN 'APPROVED'
     WHEN NOT coalesce(semantic.value, false) AND NOT coalesce(complete.value, false) THEN 'REJECTED'
     ELSE 'NEEDS_REVIEW' END"""


def _routed(source: str) -> str:
    return f"""
routed AS (
  SELECT doc_id, s0.detected_language, {_STATUS} AS status,
         semantic.rationale AS semantic_preservation_rationale,
         complete.rationale AS completeness_rationale
  FROM {source} s0 JOIN semantic USING (doc_id) JOIN complete USING (doc_id))"""


_ROUTED = f"WITH {_DOUBLE}, {_semantic('ev')}, {_completeness('ev')}, {_routed('ev')}"

_COMPARED = f"""
WITH endpoints(endpoint) AS (VALUES ('mini'), ('standard'), ('premium')),
pairs AS (
  SELECT endpoint, doc_id, text, {_double_translate("text", "length(endpoint)")} AS english
  FROM documents, endpoints),
usage AS (
  SELECT endpoint, count(*) AS num_documents,
         sum(50 + length(text) // 4)::BIGINT AS estimated_input_tokens,
         sum(length(coalesce(english, '')) // 4)::BIGINT AS estimated_output_tokens
  FROM pairs GROUP BY endpoint),
tokens AS (
  SELECT *, estimated_input_tokens + estimated_output_tokens AS estimated_total_tokens FROM usage)
"""

_THROUGHPUT = """
WITH spans AS (
  SELECT event_type AS endpoint, epoch_us(ts) // 1000 AS started, epoch_us(ts) // 1000 + floor(value)::BIGINT AS ended,
         length(props) AS chars
  FROM events),
used AS (
  SELECT endpoint, count(*) AS num_documents, sum(chars)::BIGINT AS estimated_total_tokens,
         sum(ended - started)::BIGINT / 1000 AS seconds
  FROM spans GROUP BY endpoint),
speed AS (
  SELECT endpoint, num_documents, estimated_total_tokens,
         round_even(seconds, 1) AS translation_duration_s,
         round_even(seconds / greatest(num_documents, 1), 1) AS avg_duration_per_doc_s,
         round_even(estimated_total_tokens / greatest(seconds, 0.1), 0) AS tokens_per_second
  FROM used)
"""

_CASES = """
cases AS (
  SELECT doc_id, text AS original, lang AS detected_language,
         lang AS expected_language, lang <> 'en' AS should_translate
  FROM documents)"""
_FLAT_CASES = (
    "doc_id, md5(original) AS original_md5, detected_language, expected_language, should_translate"
)

_TURNS = """
WITH turns AS (
  SELECT conv_id::VARCHAR AS trace_id, role, length(text) AS chars,
         (1704067200 + conv_id * 3600 + turn * 60) * 1000 AS started
  FROM conversations)
"""


def _trend(period: str, by: str = "") -> str:
    return f"""
trend AS (
  SELECT time_bucket(INTERVAL '{period}', ts) AS period_start,
         time_bucket(INTERVAL '{period}', ts) + INTERVAL '{period}' AS period_end,
         event_type AS monitor{', ' + by if by else ''}, count(value) AS scored,
         count(*) FILTER (WHERE value < 10.0) AS passed,
         count(*) FILTER (WHERE value < 10.0) / count(value) AS pass_rate
  FROM events GROUP BY ALL)"""


def _sampled(monitor: str, key: str, rate: float) -> str:
    point = f"('0x' || left(md5('{monitor}|' || {key}), 8))::BIGINT"
    return f"{point} < {int(rate * 2**32)}"


_MONITORS = (
    ("translation_semantic_preservation", "semantic_preservation", 1.0, "semantic"),
    ("translation_completeness", "completeness_check", 1.0, "complete"),
    ("translation_guidelines_monitor", "translation_quality", 0.5, "guided"),
)

_VISIBLE = (
    r"regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>|<!--.*?-->', '', 'g')"
)
_ELEMENT = r"(?is)<(title|h1|p|li)(?:\s[^>]*)?>(.*?)</(?:title|h1|p|li)>"


def _unescaped(text: str) -> str:
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{character}')"
    return text


ORACLES: dict[str, str] = {
    "file_scan": r"SELECT md5(html || chr(10)) AS content_md5, (strlen(html) + 1)::INT AS bytes FROM pages",
    "parse_pages": rf"""
WITH visible AS (SELECT url, {_VISIBLE} AS html FROM pages),
found AS (
  SELECT url, unnest(regexp_extract_all(html, '{_ELEMENT}', 1)) AS tag,
         unnest(regexp_extract_all(html, '{_ELEMENT}', 2)) AS body,
         unnest(range(len(regexp_extract_all(html, '{_ELEMENT}', 1)))) AS number
  FROM visible),
kept AS (
  SELECT url, number,
         trim({_unescaped("regexp_replace(body, '(?s)<[^>]*>', '', 'g')")}, E' \t\n\r ') AS content
  FROM found WHERE lower(tag) IN ('title', 'h1', 'p'))
SELECT url AS source_path, regexp_extract(url, '([^/]+)$', 1) AS file_name,
       coalesce(t.extracted_text, '') AS extracted_text, 1 AS num_pages
FROM pages LEFT JOIN (
  SELECT url, string_agg(content, E'\n\n' ORDER BY number) AS extracted_text FROM kept GROUP BY url
) t USING (url)""",
    "extract_elements": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, E'\n')) AS line,
         unnest(range(len(string_split(text, E'\n')))) AS number
  FROM documents),
kept AS (SELECT * FROM lines WHERE number = 0 OR NOT contains(line, ' | '))
SELECT d.doc_id, string_agg(line, E'\n\n' ORDER BY number) AS extracted_text,
       ceil(length(any_value(d.text)) / 1000)::INT AS num_pages
FROM documents d JOIN kept USING (doc_id) GROUP BY d.doc_id""",
    "stage_tables": "SELECT doc_id, length(text)::INT AS chars FROM documents",
    "text_scalars": r"""
WITH d AS (SELECT *, len(string_split(text, ' ')) AS words, length(text) AS chars FROM documents)
SELECT doc_id, doc_id || '.pdf' AS file_name, (chars + 5)::INT AS trimmed_chars,
       chars::INT AS stripped_chars, left(text, 40) AS head, chars // 4 AS tokens,
       round_even(chars / words, 1) AS chars_per_word,
       CAST(CAST(round_even((words / chars) * 100, 0) AS BIGINT) AS VARCHAR) || '%' AS words_share,
       lang = 'en' AS english
FROM d""",
    "document_count": "SELECT count(*) AS num_documents FROM documents WHERE length(text) > 0",
    "first_documents": """
SELECT doc_id, lang, left(text, 80) AS head FROM documents ORDER BY doc_id LIMIT 10""",
    "detect_languages": f"WITH {_DETECT} SELECT doc_id, detected_language FROM detected",
    "translation_worklist": f"""
WITH {_DETECT}
SELECT detected_language, count(*) AS docs, count(DISTINCT text) AS distinct_texts,
       (SELECT sum(length(text) // 4) FROM (
          SELECT DISTINCT text, detected_language AS lang FROM detected) x
        WHERE x.lang = detected.detected_language)::BIGINT AS input_tokens,
       detected_language <> 'en' AS should_translate
FROM detected GROUP BY detected_language""",
    "translate_two_phases": f"WITH {_PHASE_ONE} {_TRANSLATED}",
    "translate_skip_english": f"""
WITH one AS (SELECT doc_id, text, {_double_detect("text")} AS detected_language FROM documents)
SELECT doc_id, detected_language,
       CASE WHEN detected_language = 'en' THEN text
            ELSE {_double_translate("text", 8)} END AS english_translation,
       CASE WHEN detected_language = 'en' THEN text
            ELSE '[' || detected_language || '] ' || {_double_translate("text", 8)}
       END AS back_translation
FROM one""",
    "translate_first_documents": f"WITH {_PHASE_ONE} {_TRANSLATED} ORDER BY doc_id LIMIT 5",
    "translate_one_document": f"""
SELECT doc_id, text AS extracted_text, {_double_translate("text", 8)} AS english_translation
FROM documents ORDER BY doc_id LIMIT 1""",
    "model_calls": f"""
WITH {_PHASE_ONE}, texts AS (
  SELECT DISTINCT text, english, back, detected_language FROM two),
heads AS (SELECT DISTINCT text AS head FROM documents),
backs AS (
  SELECT DISTINCT detected_language, english, back FROM two
  WHERE detected_language <> 'en' AND english IS NOT NULL)
SELECT 'detect_language' AS task, 'fast' AS endpoint, count(*) AS calls, 0 AS errors,
       sum({_DETECT_CHARS} + length(head))::BIGINT AS in_chars,
       sum(length({_double_detect("head")}) + CASE {_double_detect("head")}
           WHEN 'de' THEN 2 WHEN 'fr' THEN 1 ELSE 0 END)::BIGINT AS out_chars
FROM heads
UNION ALL
SELECT 'translate_to_english', 'standard', count(*), count(*) FILTER (WHERE english IS NULL),
       sum({_TRANSLATE_CHARS} + length(text))::BIGINT, sum(length(english))::BIGINT FROM texts
UNION ALL
SELECT 'back_translate', 'standard', count(*), 0,
       sum({_BACK_CHARS} + length(english) + 2)::BIGINT, sum(length(back))::BIGINT FROM backs""",
    "evaluation_records": f"""
WITH {_DOUBLE}
SELECT doc_id, detected_language, md5(original) AS original_md5, md5(english) AS english_md5,
       md5(back) AS back_md5 FROM ev""",
    "completeness": f"WITH {_DOUBLE}, {_completeness('ev')} SELECT * FROM complete",
    "semantic_preservation": f"WITH {_DOUBLE}, {_semantic('ev')} SELECT * FROM semantic",
    "translation_guidelines": f"""
WITH {_DOUBLE}, {_guidelines('ev')} SELECT doc_id, value, rationale, error FROM guided""",
    "guidelines_per_rule": f"WITH {_DOUBLE}, {_rule_by_rule('ev')} SELECT * FROM ruled",
    "judge_replies": """
SELECT doc_id,
  CASE WHEN doc_id % 10 IN (2, 4, 8) THEN NULL
       WHEN doc_id % 10 IN (5, 6, 7) THEN false ELSE quality = 1 END AS value,
  CASE WHEN doc_id % 10 IN (2, 4, 8) THEN NULL
       WHEN doc_id % 10 = 9 THEN 'No rationale provided' ELSE 'toxic ' || toxic END AS rationale,
  CASE WHEN doc_id % 10 IN (2, 4, 8) THEN 'judge_json' END AS error
FROM labels""",
    "evaluate_all": f"{_SCORED}, {_TIDY} SELECT * FROM tidy",
    "scorer_metrics": f"{_SCORED}, {_TIDY} SELECT scorer, {_METRICS} FROM tidy GROUP BY scorer",
    "scorer_results_wide": f"""{_SCORED}
SELECT doc_id, s.value AS "semantic_preservation/value",
       s.rationale AS "semantic_preservation/rationale",
       c.value AS "completeness_check/value", c.rationale AS "completeness_check/rationale",
       g.value AS "translation_quality/value", g.rationale AS "translation_quality/rationale"
FROM semantic s JOIN complete c USING (doc_id) JOIN guided g USING (doc_id)""",
    "custom_scorers": f"""
WITH {_DOUBLE}
SELECT doc_id, 'not_empty' AS scorer, length(english) > 0 AS value,
       length(english) || ' characters' AS rationale, NULL AS error FROM ev
UNION ALL
SELECT doc_id, 'ends_alike',
       CASE WHEN english <> '' THEN right(english, 1) = right(original, 1) END,
       CASE WHEN english <> '' THEN 'ends in ' || unicode(right(english, 1)) END,
       CASE WHEN english = '' THEN 'IndexError: string index out of range' END
FROM ev""",
    "document_status": f"{_ROUTED} SELECT * FROM routed",
    "status_counts": f"{_ROUTED} SELECT status, count(*) AS count FROM routed GROUP BY status",
    "documents_for_review": f"""{_ROUTED}
SELECT doc_id, status, semantic_preservation_rationale, completeness_rationale
FROM routed WHERE status IN ('REJECTED', 'NEEDS_REVIEW')""",
    "review_queue": f"""{_ROUTED}
SELECT doc_id, status, semantic_preservation_rationale, completeness_rationale
FROM routed WHERE status IN ('REJECTED', 'NEEDS_REVIEW') ORDER BY doc_id LIMIT 10""",
    "final_results": f"""
WITH {_PHASE_ONE}, cut AS (
  SELECT doc_id, detected_language, text AS original,
         english AS english, back AS back FROM two),
{_semantic('cut')}, {_completeness('cut')}, {_routed('cut')}
SELECT * FROM routed""",
    "comparison_sample": """
SELECT doc_id, text AS extracted_text FROM documents ORDER BY doc_id LIMIT 3""",
    "endpoint_tokens": f"{_COMPARED} SELECT * FROM tokens",
    "endpoint_side_by_side": f"""{_COMPARED}
SELECT metric, max(value) FILTER (WHERE endpoint = 'mini') AS mini,
       max(value) FILTER (WHERE endpoint = 'standard') AS standard,
       max(value) FILTER (WHERE endpoint = 'premium') AS premium
FROM (UNPIVOT (SELECT endpoint, num_documents::DOUBLE AS num_documents,
                      estimated_input_tokens::DOUBLE AS estimated_input_tokens,
                      estimated_output_tokens::DOUBLE AS estimated_output_tokens,
                      estimated_total_tokens::DOUBLE AS estimated_total_tokens FROM tokens)
      ON COLUMNS(* EXCLUDE endpoint) INTO NAME metric VALUE value)
GROUP BY metric""",
    "endpoint_quality": f"""{_COMPARED}, cut AS (
  SELECT endpoint, doc_id, 'unknown' AS detected_language, text AS original,
         coalesce(english, '') AS english FROM pairs),
{_guidelines('cut')},
scores AS (
  SELECT endpoint, 'completeness_check' AS scorer, {_RATIO} >= 0.3 AS value, NULL AS error FROM cut
  UNION ALL SELECT endpoint, 'translation_quality', value, NULL FROM guided)
SELECT endpoint, scorer, {_METRICS} FROM scores GROUP BY endpoint, scorer""",
    "endpoint_throughput": f"{_THROUGHPUT} SELECT * FROM speed",
    "evalset_cases": f"WITH {_CASES} SELECT {_FLAT_CASES} FROM cases",
    "evalset_upsert": f"""
WITH {_CASES}, merged AS (
  SELECT c.doc_id, original, detected_language,
         CASE WHEN l.doc_id IS NULL THEN 'stale' ELSE expected_language END AS expected_language,
         l.doc_id IS NOT NULL AND should_translate AS should_translate
  FROM cases c LEFT JOIN labels l USING (doc_id)
  UNION ALL
  SELECT -1 - item_id, text, 'en', 'en', false FROM benchmark)
SELECT {_FLAT_CASES} FROM merged""",
    "evalset_check": f"""
WITH {_DETECT}
SELECT count(*) AS cases, 0::BIGINT AS missing, avg(CAST(detected_language = lang AS INT)) AS language_match,
       avg(CAST((detected_language <> 'en') = (lang <> 'en') AS INT)) AS action_match
FROM detected JOIN documents USING (doc_id)""",
    "call_spans": f"""
WITH {_PHASE_ONE}, spans AS (
  SELECT doc_id, 'detect_language' AS name, 'fast' AS endpoint,
         {_DETECT_CHARS} + length(text) AS in_chars,
         length(detected_language) + CASE detected_language
           WHEN 'de' THEN 2 WHEN 'fr' THEN 1 ELSE 0 END AS out_chars, NULL AS error FROM one
  UNION ALL
  SELECT doc_id, 'translate_to_english', 'standard', {_TRANSLATE_CHARS} + length(text), length(english),
         CASE WHEN english IS NULL THEN 'RuntimeError: overloaded' END FROM one)
SELECT doc_id::VARCHAR AS trace_id, 'translation_pipeline' AS parent, name, 'LLM' AS span_type,
       endpoint, in_chars::INT AS in_chars, out_chars::INT AS out_chars, error, 'v2' AS pipeline_version FROM spans""",
    "trace_roots": f"""{_TURNS}
SELECT trace_id, 'translation_pipeline' AS name, 'CHAIN' AS span_type, min(started) AS started_ms,
       max(started + chars) - min(started) AS duration_ms, sum(chars)::BIGINT AS busy_ms,
       count(*) AS children, sum(chars)::BIGINT AS in_chars,
       count(*) FILTER (WHERE chars = 0) AS errors
FROM turns GROUP BY trace_id""",
    "span_tree": f"""{_TURNS}
SELECT 'LLM' AS span_type, role AS name, 'translation_pipeline' AS parent, count(*) AS spans,
       sum(chars)::BIGINT AS in_chars FROM turns GROUP BY role
UNION ALL
SELECT 'CHAIN', 'translation_pipeline', NULL, count(DISTINCT trace_id), sum(chars)::BIGINT FROM turns""",
    "run_metrics": f"""{_THROUGHPUT}
SELECT 'run' AS run_id, 'comparison_' || endpoint AS run_name, 'metric' AS kind, key, value
FROM (UNPIVOT (SELECT endpoint, num_documents::DOUBLE AS num_documents, translation_duration_s,
                      tokens_per_second FROM speed)
      ON num_documents, translation_duration_s, tokens_per_second INTO NAME key VALUE value)""",
    "stage_elapsed": """
WITH e AS (
  SELECT event_type, epoch_us(ts) // 1000 - epoch_us(date_trunc('day', ts)) // 1000 AS ms FROM events)
SELECT event_type, sum(ms)::BIGINT AS elapsed_ms,
       629.0::DOUBLE / greatest(max(ms) / 1000, 1) AS speedup
FROM e GROUP BY event_type""",
    "monitor_sampling": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS name, count(*) AS traces, "
        f"count(*) FILTER (WHERE {_sampled(name, 'doc_id', rate)}) AS sampled, "
        f"'{scorer}' AS scorer, {rate}::DOUBLE AS sample_rate FROM documents"
        for name, scorer, rate, _ in _MONITORS
    ),
    "monitor_new_traces": _SCORED + "\n" + "\nUNION ALL\n".join(
        f"SELECT doc_id AS trace_id, '{name}' AS monitor, value, rationale, error FROM {source} "
        f"WHERE {_sampled(name, 'doc_id', rate)}"
        for name, _, rate, source in _MONITORS
    ),
    "quality_trend": f"WITH {_trend('1 day')} SELECT * FROM trend",
    "quality_trend_by_version": f"""
WITH {_trend('1 day', "'v' || (user_id % 2) AS pipeline_version")} SELECT * FROM trend""",
    "pass_rate_alerts": f"WITH {_trend('1 hour')} SELECT * FROM trend WHERE pass_rate < 0.1",
    "quality_trend_stream": f"WITH {_trend('1 day')} SELECT * FROM trend",
    "pass_rate_alerts_stream": f"WITH {_trend('1 hour')} SELECT * FROM trend WHERE pass_rate < 0.1",
    "registered_monitors": _SCORED + f"""
SELECT doc_id AS trace_id, 'translation_completeness' AS monitor, value, rationale, error FROM complete
UNION ALL
SELECT doc_id, 'translation_guidelines_monitor', value, rationale, error FROM guided
WHERE {_sampled('translation_guidelines_monitor', 'doc_id', 0.25)}""",
    "evaluation_run": f"""{_SCORED}, {_TIDY},
m AS (SELECT 'evaluation_' || scorer AS run_name, {_METRICS} FROM tidy GROUP BY scorer),
long AS (
  SELECT run_name, 'pass_rate' AS key, pass_rate::DOUBLE AS metric FROM m
  UNION ALL SELECT run_name, 'scored', scored FROM m
  UNION ALL SELECT run_name, 'passed', passed FROM m
  UNION ALL SELECT run_name, 'errors', errors FROM m)
SELECT 'evaluation' AS run_name, 'param' AS kind, 'llm_endpoint' AS key, 'standard' AS param, NULL::DOUBLE AS metric
UNION ALL SELECT 'evaluation', 'param', 'num_documents', (SELECT count(*) FROM documents)::VARCHAR, NULL
UNION ALL SELECT 'evaluation', 'param', 'pipeline_version', 'v2', NULL
UNION ALL SELECT run_name, 'metric', key, NULL, metric FROM long""",
}
