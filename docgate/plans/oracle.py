"""The same results in plain SQL, to check the registered queries against.

Written from the definition of each query, with a different engine in mind, on the same tables.
"""

from __future__ import annotations

from docgate.plans.catalog import QUERY, RUN, TRACE

_MESSAGES = r"""
base AS (
  SELECT doc_id, doc_id % 20 AS k, doc_id % 40 AS odd, doc_id::VARCHAR AS ident, source,
    replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'),
      chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS esc
  FROM documents
),
parts AS (
  SELECT *, CASE WHEN k = 11
      THEN replace(replace(esc, chr(233), 'e' || chr(769)), chr(241), 'n' || chr(771))
      ELSE esc END AS content,
    '"source_url":"src://' || source || '/' || ident || '"' AS url
  FROM base
),
built AS (
  SELECT *, '{"event_type":"'
    || CASE WHEN k IN (4, 14) THEN 'unknown_event' ELSE 'data_ingest' END
    || '","payload":'
    || CASE k WHEN 8 THEN '[]'
              WHEN 16 THEN '{' || url || '}'
              WHEN 17 THEN '{"content":' || ident || ',' || url || '}'
              ELSE '{"content":"' || content || '",' || url || '}' END
    || CASE k WHEN 12 THEN ''
              WHEN 15 THEN ',"trace_id":' || ident
              ELSE ',"trace_id":"doc-' || ident || '"' END
    || CASE WHEN k IN (3, 14) THEN ''
            WHEN k = 5 THEN ',"version":1'
            WHEN k = 6 THEN ',"version":"v1"'
            WHEN k = 18 THEN ',"version":"1.0\n"'
            ELSE ',"version":"1.0"' END
    || CASE WHEN k IN (7, 14) THEN ',"unknown_field":"oops"' ELSE '' END
    || '}' AS whole
  FROM parts
),
bodies AS (
  SELECT *, CASE k WHEN 0 THEN 'this is not json ' || ident
                   WHEN 1 THEN 'null'
                   WHEN 2 THEN ''
                   WHEN 10 THEN whole || ' x'
                   WHEN 13 THEN '[1]'
                   ELSE whole END AS body
  FROM built
),
messages AS (
  SELECT 'm' || ident AS message_id,
    CASE WHEN odd = 9 THEN '\xFF\xFE'::BLOB || encode(body) ELSE encode(body) END AS data,
    CASE WHEN odd = 29 THEN 'no-such' ELSE 'utf-8' END AS charset
  FROM bodies
),
decoded AS (
  SELECT *, CASE WHEN charset = 'utf-8' THEN nfc_normalize(try(decode(data))) END AS canonical
  FROM messages
),
syntax AS (
  SELECT *, CASE WHEN canonical IS NULL THEN 'ENCODING_UNDECODABLE'
                 WHEN NOT json_valid(canonical) THEN 'SYNTAX_NOT_JSON'
                 WHEN json_type(canonical) = 'NULL' THEN 'SYNTAX_EMPTY' END AS early
  FROM decoded
),
docs AS (
  SELECT message_id, canonical AS j, json_type(canonical) = 'OBJECT' AS is_object,
    CASE WHEN json_type(canonical) = 'OBJECT' THEN json_keys(canonical) END AS ks,
    json_type(canonical, '$.event_type') AS t_event, json_extract_string(canonical, '$.event_type') AS v_event,
    json_type(canonical, '$.payload') AS t_payload, json_type(canonical, '$.timestamp') AS t_time,
    json_type(canonical, '$.trace_id') AS t_trace, json_type(canonical, '$.version') AS t_version,
    json_extract_string(canonical, '$.version') AS v_version
  FROM syntax WHERE early IS NULL
),
extras AS (
  SELECT message_id, string_agg(key, ', ' ORDER BY key) AS names
  FROM (SELECT message_id, unnest(ks) AS key FROM docs)
  WHERE key NOT IN ('event_type', 'payload', 'timestamp', 'trace_id', 'version')
  GROUP BY message_id
),
found AS (
  SELECT message_id, 1 AS rule, '$' AS path, 'is not of type ''object''' AS message FROM docs WHERE NOT is_object
  UNION ALL SELECT message_id, 2, '$', '''event_type'' is a required property' FROM docs
    WHERE is_object AND NOT list_contains(ks, 'event_type')
  UNION ALL SELECT message_id, 3, '$', '''payload'' is a required property' FROM docs
    WHERE is_object AND NOT list_contains(ks, 'payload')
  UNION ALL SELECT message_id, 4, '$', '''version'' is a required property' FROM docs
    WHERE is_object AND NOT list_contains(ks, 'version')
  UNION ALL SELECT message_id, 5, '$', 'additional properties not allowed: ' || names FROM extras
  UNION ALL SELECT message_id, 6, '$.event_type', 'is not of type ''string''' FROM docs
    WHERE is_object AND t_event <> 'VARCHAR'
  UNION ALL SELECT message_id, 7, '$.event_type', 'is not one of the allowed values' FROM docs
    WHERE is_object AND (t_event <> 'VARCHAR'
      OR v_event NOT IN ('llm_request', 'llm_response', 'eval_result', 'data_ingest'))
  UNION ALL SELECT message_id, 8, '$.payload', 'is not of type ''object''' FROM docs
    WHERE is_object AND t_payload <> 'OBJECT'
  UNION ALL SELECT message_id, 9, '$.timestamp', 'is not of type ''string''' FROM docs
    WHERE is_object AND t_time <> 'VARCHAR'
  UNION ALL SELECT message_id, 10, '$.trace_id', 'is not of type ''string''' FROM docs
    WHERE is_object AND t_trace <> 'VARCHAR'
  UNION ALL SELECT message_id, 11, '$.version', 'is not of type ''string''' FROM docs
    WHERE is_object AND t_version <> 'VARCHAR'
  UNION ALL SELECT message_id, 12, '$.version', 'does not match the pattern' FROM docs
    WHERE is_object AND t_version = 'VARCHAR'
      AND NOT regexp_matches(v_version, '^\p{Nd}+\.\p{Nd}+\n?\z')
),
errors AS (
  SELECT message_id, rule, path, 'CONTRACT_VIOLATION' AS code, message FROM found
  UNION ALL
  SELECT message_id, 0, '$', early, CASE early
      WHEN 'ENCODING_UNDECODABLE' THEN 'payload is not valid ' || charset
      WHEN 'SYNTAX_NOT_JSON' THEN 'payload is not a single JSON value'
      ELSE 'payload contained no JSON value' END
  FROM syntax WHERE early IS NOT NULL
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY path, rule) - 1 AS pos FROM errors
),
summed AS (
  SELECT message_id, count(*) AS n_errors,
    max(CASE WHEN pos = 0 THEN code END) AS first_code,
    max(CASE WHEN pos = 0 THEN path END) AS first_path,
    string_agg(code || '[' || path || ']: ' || message, '; ' ORDER BY pos) AS listed
  FROM numbered GROUP BY message_id
),
gated AS (
  SELECT s.message_id, CASE WHEN e.message_id IS NULL THEN s.canonical END AS canonical,
    CASE WHEN e.message_id IS NULL THEN 'ACCEPTED' ELSE 'REJECTED' END AS status,
    coalesce(e.n_errors, 0)::INT AS n_errors, e.first_code, e.first_path, e.listed
  FROM syntax s LEFT JOIN summed e ON s.message_id = e.message_id
),
ingest AS (
  SELECT message_id,
    CASE WHEN json_type(canonical, '$.payload.content') <> 'VARCHAR'
      THEN 'CONTENT_NOT_STRING[$.payload.content]: is not of type ''string''' END AS bad_content,
    CASE WHEN json_type(canonical, '$.payload.source_url') <> 'VARCHAR'
      THEN 'SOURCE_URL_NOT_STRING[$.payload.source_url]: is not of type ''string''' END AS bad_source,
    json_extract_string(canonical, '$.trace_id') AS trace_id,
    coalesce(json_extract_string(canonical, '$.trace_id'),
      json_extract_string(canonical, '$.event_type'), 'unknown') AS doc_id,
    coalesce(json_extract_string(canonical, '$.payload.content'), '') AS content,
    coalesce(json_extract_string(canonical, '$.payload.source_url'), '') AS source_url
  FROM gated WHERE status = 'ACCEPTED'
),
accepted AS (
  SELECT *, greatest(1, ceil((length(content) - 64) / 448.0))::BIGINT AS n_chunks
  FROM ingest WHERE bad_content IS NULL AND bad_source IS NULL
),
event_chunks AS (
  SELECT message_id, doc_id, source_url, (start // 448)::INT AS chunk_no,
    substring(content, start + 1, 512) AS chunk_text
  FROM (SELECT *, unnest(range(0, greatest(1, length(content) - 64), 448)) AS start FROM accepted)
)
"""

_CHUNKS = """
chunks AS (
  SELECT doc_id, source_url, (start // 448)::INT AS chunk_no,
    substring(text, start + 1, 512) AS chunk_text
  FROM (
    SELECT doc_id::VARCHAR AS doc_id, 'src://' || source || '/' || doc_id AS source_url, text,
      unnest(range(0, greatest(1, length(text) - 64), 448)) AS start
    FROM documents
  )
)
"""

_QUESTIONS = r"""
questions AS (
  SELECT item_id AS question_id, text AS question FROM benchmark
)
"""

_WORDS = r"""
words AS (
  SELECT doc_id, chunk_no, source_url, chunk_text,
    regexp_extract_all(lower(chunk_text), '[\p{L}\p{N}]+') AS ws
  FROM chunks
),
wanted AS (
  SELECT DISTINCT question_id, unnest(regexp_extract_all(lower(question), '[\p{L}\p{N}]+')) AS term
  FROM questions
)
"""

_HITS = """
present AS (SELECT DISTINCT doc_id, chunk_no, unnest(ws) AS term FROM words),
counted AS (SELECT *, count(*) OVER (PARTITION BY question_id) AS n FROM wanted),
met AS (
  SELECT question_id, doc_id, chunk_no FROM present JOIN counted USING (term)
  GROUP BY question_id, doc_id, chunk_no HAVING count(*) = max(n)
),
hits AS (
  SELECT question_id, doc_id, chunk_no, (row_number() OVER (
    PARTITION BY question_id ORDER BY doc_id, chunk_no))::INT AS rank
  FROM met QUALIFY rank <= 5
)
"""

_ANSWERS = """
answers AS (
  SELECT q.conv_id, q.text AS question, a.text AS answer,
    CASE WHEN q.conv_id % 10 = 0 THEN []::VARCHAR[] ELSE string_split(q.text, ' ') END AS terms
  FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
  WHERE q.role = 'user' AND a.role = 'assistant'
),
checked AS (
  SELECT *, list_filter(terms, lambda t: contains(lower(answer), lower(t))) AS matched FROM answers
),
evaluated AS (
  SELECT *, CASE WHEN len(terms) = 0 THEN 1.0::DOUBLE ELSE len(matched)::DOUBLE / len(terms) END AS score
  FROM checked
)
"""

_HTML = r"""
page_text AS (
  SELECT page_id, url, trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
        '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
        '(?is)<style[^>]*>.*?</style>', ' ', 'g'),
        '(?s)<!--.*?-->', ' ', 'g'),
        '<[^>]*>', ' ', 'g'),
      '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
    '[ \t\n\r\f]+', ' ', 'g')) AS text
  FROM pages
)
"""


def _with(*parts_and_query: str) -> str:
    *parts, query = parts_and_query
    return "WITH " + ",".join(part.strip() + "\n" for part in parts) + query.strip()


def _on_messages(query: str) -> str:
    return _with(_MESSAGES, query)


def _word_match(test: str) -> str:
    return _with(
        _CHUNKS,
        f"SELECT doc_id, chunk_no, chunk_text, source_url FROM chunks WHERE {test} "
        "ORDER BY doc_id, chunk_no LIMIT 5",
    )


ORACLE: dict[str, str] = {
    "mime_type": r"""
        SELECT name, CASE WHEN page_id % 3 = 0 THEN 'text/html'
            WHEN lower(name) LIKE '%.pdf' THEN 'application/pdf'
            WHEN lower(name) LIKE '%.html' OR lower(name) LIKE '%.htm' THEN 'text/html'
            ELSE 'application/octet-stream' END AS mime
        FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS name FROM pages)""",
    "extract_html_text": _with(
        _HTML, "SELECT page_id, md5(text) AS text_md5, length(text)::BIGINT AS text_len FROM page_text"
    ),
    "document_events": _with(
        _HTML, "SELECT url AS trace_id, url AS source_url, md5(text) AS content_md5, "
        "'data_ingest' AS event_type, '1.0' AS version, "
        "'2024-01-01T00:00:00.000000+00:00' AS timestamp, 'utf-8' AS charset FROM page_text"
    ),
    "published_documents": "SELECT count(DISTINCT url) AS documents FROM pages WHERE html IS NOT NULL",
    "chunks": _with(_CHUNKS, "SELECT doc_id, chunk_no, chunk_text FROM chunks"),
    "chunks_from_events": _on_messages(
        "SELECT message_id, doc_id, chunk_no, chunk_text, source_url, '{}' AS embedding FROM event_chunks"
    ),
    "batch_ingest": _on_messages("""
        SELECT g.message_id, CASE WHEN a.message_id IS NULL THEN 'REJECTED' ELSE 'ACCEPTED' END AS status,
          coalesce(g.first_code, CASE WHEN i.bad_content IS NOT NULL THEN 'CONTENT_NOT_STRING'
            WHEN i.bad_source IS NOT NULL THEN 'SOURCE_URL_NOT_STRING' END) AS code,
          coalesce(a.n_chunks, 0) AS n_chunks
        FROM gated g LEFT JOIN ingest i ON g.message_id = i.message_id
          LEFT JOIN accepted a ON g.message_id = a.message_id"""),
    "ingest_summary": _on_messages(
        "SELECT message_id, 'ok' AS status, count(*) AS chunk_count, min(doc_id) AS doc_id "
        "FROM event_chunks GROUP BY message_id"
    ),
    "gate_encoding": _on_messages("SELECT message_id, canonical IS NOT NULL AS decodable FROM decoded"),
    "nfc_canonical": _on_messages(
        "SELECT message_id, md5(canonical) AS canonical_md5 FROM decoded WHERE canonical IS NOT NULL"
    ),
    "gate_syntax": _on_messages(
        "SELECT message_id, early AS code FROM syntax WHERE canonical IS NOT NULL"
    ),
    "gate_contract_errors": _on_messages(
        "SELECT message_id, pos::INT AS pos, path, code, message FROM numbered WHERE rule > 0"
    ),
    "gate_validate": _on_messages("""
        SELECT message_id, status, md5(canonical) AS canonical_md5, n_errors, first_code, first_path
        FROM gated"""),
    "gate_reasons": _on_messages("""
        SELECT message_id, CASE WHEN status = 'ACCEPTED' THEN 'ACCEPTED (enqueued)'
          ELSE 'REJECTED — ' || listed END AS rendered FROM gated"""),
    "gate_tally": _on_messages(
        "SELECT status, first_code AS code, count(*) AS n FROM gated GROUP BY status, first_code"
    ),
    "classify_outcomes": """
        SELECT 'e' || event_id AS message_id,
          CASE event_id % 4 WHEN 0 THEN 'ACCEPTED' WHEN 1 THEN 'TRANSIENT'
            WHEN 2 THEN 'FUNCTIONAL_REJECT' ELSE 'UNKNOWN' END AS outcome,
          CASE WHEN event_id % 2 = 0 THEN 'ack' ELSE 'nack' END AS action,
          event_id % 4 = 2 AS quarantined
        FROM events""",
    "quarantine": _on_messages("""
        SELECT message_id, 'REJECTED — ' || listed AS reason FROM gated WHERE status = 'REJECTED'
        UNION ALL
        SELECT message_id, 'REJECTED — ' || concat_ws('; ', bad_content, bad_source) FROM ingest
        WHERE bad_content IS NOT NULL OR bad_source IS NOT NULL"""),
    "find_by_trace": _on_messages(
        "SELECT message_id, json_extract_string(canonical, '$.trace_id') AS trace_id FROM syntax "
        f"WHERE early IS NULL AND json_extract_string(canonical, '$.trace_id') = '{TRACE}'"
    ),
    "stream_ingest": _on_messages("SELECT message_id, doc_id, chunk_no, chunk_text FROM event_chunks"),
    "chunk_counts": _with(
        _CHUNKS, "SELECT doc_id, count(*) AS chunk_count FROM chunks GROUP BY doc_id"
    ),
    "search_all_terms": _word_match(
        " AND ".join(
            rf"list_contains(regexp_extract_all(lower(chunk_text), '[\p{{L}}\p{{N}}]+'), '{w}')"
            for w in QUERY.split()
        )
    ),
    "search_any_word": _word_match(
        " OR ".join(f"contains(lower(chunk_text), '{w}')" for w in QUERY.split())
    ),
    "search_batch": _with(
        _CHUNKS, _QUESTIONS, _WORDS, _HITS, "SELECT question_id, rank, doc_id, chunk_no FROM hits"
    ),
    "search_ranked": _with(
        _CHUNKS,
        _QUESTIONS,
        _WORDS,
        """
tf AS (
  SELECT doc_id, chunk_no, term, count(*) AS tf
  FROM (SELECT doc_id, chunk_no, unnest(ws) AS term FROM words) GROUP BY ALL
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
corpus AS (SELECT count(*) AS n, avg(len(ws)) AS mean FROM words),
scored AS (
  SELECT question_id, doc_id, chunk_no, round(sum(ln(1.0 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
    / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean))), 6) AS score
  FROM tf JOIN wanted USING (term) JOIN df USING (term) JOIN words USING (doc_id, chunk_no), corpus
  GROUP BY question_id, doc_id, chunk_no
)""",
        """
SELECT question_id, (row_number() OVER (PARTITION BY question_id
    ORDER BY score DESC, doc_id, chunk_no))::INT AS rank, doc_id, chunk_no, score
FROM scored QUALIFY rank <= 5""",
    ),
    "rag_prompts": _with(
        _CHUNKS,
        _QUESTIONS,
        _WORDS,
        _HITS,
        """
contexts AS (
  SELECT question_id, string_agg('[' || source_url || ']' || chr(10) || chunk_text,
    chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits JOIN chunks USING (doc_id, chunk_no) GROUP BY question_id
),
prompted AS (
  SELECT question_id, 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || question
    AS prompt
  FROM questions LEFT JOIN contexts USING (question_id)
)""",
        """
SELECT question_id, md5(prompt) AS prompt_md5, length(prompt)::BIGINT AS prompt_len,
  CASE WHEN prompt IS NULL
    THEN 'I don''t have enough information — no relevant chunks found.' END AS fixed_answer
FROM prompted""",
    ),
    "evaluate_answers": _with(
        _ANSWERS,
        "SELECT question, array_to_string(matched, '|') AS matched, len(terms)::INT AS n_expected, score "
        "FROM evaluated",
    ),
    "suggest_improvements": _with(
        _ANSWERS,
        "SELECT 'Improve answer coverage for: ' || question AS title, 'Missing terms: ' || "
        "array_to_string(list_filter(terms, lambda t: NOT list_contains(matched, t)), ', ') AS detail "
        "FROM evaluated WHERE score < 0.8",
    ),
    "metric_records": _with(
        _ANSWERS, f"SELECT '{RUN}' AS run_id, question, score FROM evaluated"
    ),
    "retraining_signals": _with(
        _ANSWERS,
        """
signals AS (
  SELECT 'score below threshold' AS reason, question AS source, score FROM evaluated WHERE score < 0.8
  UNION ALL
  SELECT DISTINCT 'new documents', source, NULL::DOUBLE FROM documents
)""",
        "SELECT reason, source, score, "
        "json_object('reason', reason, 'source', source, 'score', score)::VARCHAR AS body FROM signals",
    ),
    "search_any_word_batch": _with(
        _CHUNKS,
        _QUESTIONS,
        r"""
asked AS (
  SELECT DISTINCT question_id, lower(unnest(string_split_regex(question, '\s+'))) AS word FROM questions
),
found AS (
  SELECT DISTINCT word, doc_id, chunk_no
  FROM (SELECT DISTINCT word FROM asked WHERE word <> '') JOIN chunks ON contains(lower(chunk_text), word)
),
first AS (
  SELECT * FROM found
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY doc_id, chunk_no) <= 5
),
met AS (SELECT DISTINCT question_id, doc_id, chunk_no FROM asked JOIN first USING (word))""",
        """
SELECT question_id, (row_number() OVER (PARTITION BY question_id
    ORDER BY doc_id, chunk_no))::INT AS rank, doc_id, chunk_no
FROM met QUALIFY rank <= 5""",
    ),
    "redelivered_messages": _on_messages("""
        SELECT message_id,
          CASE WHEN n % 27 = 13 THEN 'dead' WHEN ok THEN 'accepted' ELSE 'quarantine' END AS fate,
          CASE WHEN n % 27 = 13 OR n % 9 = 1 THEN 3 WHEN n % 9 = 4 THEN 2 ELSE 1 END AS attempts
        FROM (SELECT m.message_id, substring(m.message_id, 2)::BIGINT AS n, a.message_id IS NOT NULL AS ok
          FROM messages m LEFT JOIN accepted a ON m.message_id = a.message_id)"""),
    "fresh_sources": """
WITH fresh AS (
  SELECT source, doc_id % 10 = 4 AS new, doc_id % 7 = 3 AND text IS NOT NULL AS changed FROM documents
)
SELECT source, count(*) FILTER (new) AS n_new, count(*) FILTER (changed AND NOT new) AS n_changed
FROM fresh WHERE new OR changed GROUP BY source""",
}
# The same message, whether all are searched or only as many as it takes.
ORACLE["bounded_pull"] = ORACLE["find_by_trace"]
# The same hits, from stored postings.
ORACLE["search_stored"] = ORACLE["search_ranked"]
