"""DuckDB SQL for every registered query, on the same tables.

Shared steps are common table expressions; ``sql`` puts the ones a statement names, and the
ones those need, in front of it.
"""

from __future__ import annotations

import re

STEPS: dict[str, str] = {}

STEPS["msg"] = """
SELECT e.*, CASE WHEN event_type = 'signup' AND value < 10 THEN '   ' ELSE coalesce(d.text,
  CASE event_type
    WHEN 'view' THEN 'check http://shop.example/u' || user_id || ' now'
    WHEN 'click' THEN 'Kappa ' || props
    WHEN 'purchase' THEN repeat('W', CAST(floor(value / 20) AS INTEGER)) || ' LUL'
    WHEN 'error' THEN CASE WHEN value < 100 THEN 'FeelsBadMan 4Head!' ELSE 'broken :(' END
    ELSE 'Hello' || chr(10) || 'ñandú ' || user_id END) END AS message
FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id"""

STEPS["whole"] = """
SELECT *, '{"ingestion_ts":' || CASE WHEN event_type = 'click' AND value < 5
    THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
    ELSE '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"' END
  || CASE WHEN event_type = 'view' AND value < 5 THEN '' ELSE
    ',"source":{"platform":"Twitch","protocol":"irc","server":"irc.example.org","channel":"#' || upper(event_type) || '"}' END
  || ',"raw":{"username":"  User' || user_id || '","message":' || CAST(to_json(message) AS VARCHAR) || '}'
  || ',"metadata":{"event_kind":"chat_message","producer_env":"test","schema_version":"1.0.0"}'
  || CASE WHEN event_type = 'purchase' AND value >= 100 THEN ',"client_info":' || CAST(to_json(props) AS VARCHAR) ELSE '' END
  || '}' AS whole
FROM msg"""


def _capture(source: str) -> str:
    return f"""
SELECT event_id, event_type, value, user_id, CAST(user_id % 4 AS INTEGER) AS part, ts,
  CASE WHEN event_type = 'error' AND value < 10 THEN substr(whole, 1, length(whole) // 2) ELSE whole END AS payload,
  ts + to_seconds(CASE WHEN event_type = 'click' AND value >= 100 THEN 10800 ELSE 2 END) + to_seconds(delay) AS arrival
FROM (SELECT *, unnest(CASE WHEN event_type = 'purchase' AND value >= 100 THEN [0, 60] ELSE [0] END) AS delay FROM {source})"""


STEPS["log"] = _capture("whole")

STEPS["bron"] = """
SELECT *, TRY_CAST(payload AS JSON) AS j, CAST(floor(epoch(ts) / 3600) AS BIGINT) - 473352 AS hour FROM log"""

# Text between one pair of spaces-only trims; '' becomes NULL.
STEPS["cls"] = """
SELECT *, CASE WHEN j IS NULL THEN 'PARSE_ERROR'
    WHEN channel IS NULL OR chatter_id IS NULL OR message_text IS NULL THEN 'CONTRACT_ERROR' ELSE 'VALID' END AS outcome
FROM (SELECT 'chat_raw:' || part || ':' || event_id AS event_id, 'chat_raw' AS source_topic, part AS source_partition,
    event_id AS source_offset, ts AS event_ts, arrival AS bronze_ingestion_ts, hour, j, payload AS raw_payload,
    to_timestamp_utc(hour, 0, 'run_a') - INTERVAL 5 SECOND AS silver_processed_ts,
    nullif(lower(trim(j->>'$.source.channel', ' ')), '') AS channel,
    nullif(lower(trim(j->>'$.raw.username', ' ')), '') AS chatter_id,
    nullif(trim(j->>'$.raw.message', ' '), '') AS message_text,
    nullif(lower(trim(j->>'$.raw.message', ' ')), '') AS message_text_normalized,
    CAST(length(nullif(trim(j->>'$.raw.message', ' '), '')) AS INTEGER) AS message_length,
    coalesce(nullif(lower(trim(j->>'$.source.platform', ' ')), ''), 'twitch') AS source_platform
  FROM bron)"""

STEPS["good"] = """
SELECT * EXCLUDE (outcome, j, raw_payload) FROM cls WHERE outcome = 'VALID'
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY bronze_ingestion_ts) = 1"""

STEPS["runs"] = """
SELECT 'run_a' AS run UNION ALL SELECT 'run_b'"""

STEPS["par"] = """
SELECT * REPLACE (_batch_processed_ts - INTERVAL 5 SECOND AS silver_processed_ts) FROM (
  SELECT good.* EXCLUDE (hour), run AS _run_id, 'silver_parse' AS _job_name, hour AS _batch_id,
    to_timestamp_utc(hour, 0, run) AS _batch_processed_ts
  FROM good JOIN runs ON run = 'run_a' OR event_ts >= TIMESTAMP '2024-01-20')"""


def _feature_columns(when: str) -> str:
    """Feature columns over rows with message_text, message_length and event_ts."""
    return f"""
    CAST(CASE WHEN n > 0 THEN len(regexp_extract_all(t, '[ \\t\\n\\x0B\\f\\r]+')) + 1 ELSE 0 END AS INTEGER) AS token_count,
    CAST(length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS INTEGER) AS alpha_char_count,
    CAST(length(regexp_replace(t, '[^0-9]', '', 'g')) AS INTEGER) AS numeric_char_count,
    CAST(len(regexp_extract_all(lower(t), 'http')) AS INTEGER) AS link_count,
    CAST(len(regexp_extract_all(t, '[A-Za-z0-9_]+')) AS INTEGER) AS candidate_emote_token_count,
    CASE WHEN n > 0 THEN CAST(repeats AS DOUBLE) / n ELSE 0.0 END AS repeat_char_ratio,
    CASE WHEN n > 0 THEN CAST(length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS DOUBLE) / n ELSE 0.0 END AS text_complexity_proxy,
    CAST(floor(epoch({when})) - floor(epoch(event_ts)) AS INTEGER) AS event_to_feature_latency_seconds,
    CASE WHEN n > 0 THEN CAST(repeats AS DOUBLE) / n ELSE 0.0 END >= 0.7 OR five AS has_repeat_spam_pattern,
    message_length >= 2 AND length(regexp_replace(t, '[^A-Za-z]', '', 'g')) >= 0.3 * n
      AND CASE WHEN n > 0 THEN CAST(repeats AS DOUBLE) / n ELSE 0.0 END < 0.7 AS engagement_signal,
    {when} AS feature_processed_ts"""


def _measured(source: str) -> str:
    """Adds trimmed text, its length, equal neighbours, and whether five equal ones (any case) follow."""
    return f"""(SELECT *, length(t) AS n,
      len(list_filter(list_zip(c[:-2], c[2:]), lambda p: p[1] = p[2])) AS repeats,
      len(list_filter(list_zip(l, l[2:], l[3:], l[4:], l[5:]),
        lambda p: p[1] = p[2] AND p[2] = p[3] AND p[3] = p[4] AND p[4] = p[5])) > 0 AS five
    FROM (SELECT *, trim(message_text, ' ') AS t, string_split(trim(message_text, ' '), '') AS c,
      string_split(lower(trim(message_text, ' ')), '') AS l FROM {source}))"""


STEPS["feat"] = f"""
SELECT event_id, {_feature_columns("silver_processed_ts + INTERVAL 64 SECOND")} FROM {_measured("good")}"""

STEPS["fea"] = f"""
SELECT event_id, {_feature_columns("_batch_processed_ts + INTERVAL 58 SECOND")},
  _run_id, 'silver_features' AS _job_name, _batch_id, _batch_processed_ts + INTERVAL 60 SECOND AS _batch_processed_ts
FROM {_measured("par")} WHERE NOT (_run_id = 'run_a' AND channel = '#click' AND source_partition = 3)"""

DEAD = """
  outcome AS error_category,
  CASE outcome WHEN 'PARSE_ERROR' THEN 'JSON_PARSE_FAILURE' ELSE 'CONTRACT_REQUIRED_FIELDS_MISSING' END AS error_code,
  CASE outcome WHEN 'PARSE_ERROR' THEN 'Raw payload could not be parsed'
    ELSE 'Required parsed fields missing or invalid' END AS error_detail,
  outcome = 'PARSE_ERROR' AS retryable, raw_payload, source_topic, source_partition, source_offset,
  event_ts AS source_event_ts, 'silver_parse' AS pipeline_stage"""

STEPS["dead"] = f"""
SELECT silver_processed_ts AS dlq_ingestion_ts, {DEAD} FROM cls WHERE outcome <> 'VALID'"""

STEPS["dlq"] = f"""
SELECT to_timestamp_utc(hour, 0, run) - INTERVAL 3 SECOND AS dlq_ingestion_ts, {DEAD},
  run AS _run_id, 'silver_parse' AS _job_name, hour AS _batch_id, to_timestamp_utc(hour, 0, run) AS _batch_processed_ts
FROM cls JOIN runs ON run = 'run_a' OR event_ts >= TIMESTAMP '2024-01-20' WHERE outcome <> 'VALID'"""

STEPS["met"] = """
SELECT run_id, job_name, batch_id, batch_processed_ts, CAST(row_count AS BIGINT) AS row_count, target_table
FROM (SELECT run AS run_id, hour AS batch_id, count(*) AS n_raw,
    count(DISTINCT event_id) FILTER (outcome = 'VALID') AS n_valid,
    count(*) FILTER (outcome <> 'VALID') AS n_dead,
    count(DISTINCT event_id) FILTER (outcome = 'VALID'
      AND NOT (run = 'run_a' AND channel = '#click' AND source_partition = 3)) AS n_feat
  FROM cls JOIN runs ON run = 'run_a' OR event_ts >= TIMESTAMP '2024-01-20' GROUP BY ALL),
LATERAL (VALUES
  ('bronze_ingest', n_raw, 'lake.bronze.bronze_chat_raw', to_timestamp_utc(batch_id, -30, run_id)),
  ('silver_parse', n_valid, 'lake.silver.silver_chat_parsed', to_timestamp_utc(batch_id, 0, run_id)),
  ('silver_parse', n_dead, 'lake.silver.chat_dlq', to_timestamp_utc(batch_id, 0, run_id)),
  ('silver_features', n_feat, 'lake.silver.silver_chat_features', to_timestamp_utc(batch_id, 60, run_id))
) v(job_name, row_count, target_table, batch_processed_ts)
WHERE NOT (run_id = 'run_b' AND job_name = 'bronze_ingest')"""

STEPS["newpar"] = """
SELECT * EXCLUDE (_run_id, _job_name, _batch_id, _batch_processed_ts) FROM par
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _batch_processed_ts DESC, _batch_id DESC, _run_id DESC) = 1"""

STEPS["newfea"] = """
SELECT * EXCLUDE (_run_id, _job_name, _batch_id, _batch_processed_ts) FROM fea
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _batch_processed_ts DESC, _batch_id DESC, _run_id DESC) = 1"""

STEPS["joined"] = """
SELECT p.*, f.* EXCLUDE (event_id) FROM newpar p LEFT JOIN newfea f ON f.event_id = p.event_id"""

# --- first generation ----------------------------------------------------------------------

STEPS["v1whole"] = """
SELECT *, '{"user":"user' || user_id || '","message":' || CAST(to_json(message) AS VARCHAR)
  || ',"sentiment":{"neg":' || greatest(-s, 0) || ',"neu":' || CAST(1 - abs(s) AS DECIMAL(6, 4)) || ',"pos":' || greatest(s, 0)
  || ',"compound":' || s || '}}' AS whole
FROM (SELECT *, CAST(round(least(value / 245 - 1, 1.0), 4) AS DECIMAL(6, 4)) AS s FROM msg)"""

STEPS["v1log"] = _capture("v1whole")

STEPS["v1par"] = """
SELECT *, j IS NOT NULL AS parse_ok, j->>'$.user' AS "user", j->>'$.message' AS message,
  CAST(j->>'$.sentiment.neg' AS DOUBLE) AS sent_neg, CAST(j->>'$.sentiment.neu' AS DOUBLE) AS sent_neu,
  CAST(j->>'$.sentiment.pos' AS DOUBLE) AS sent_pos, CAST(j->>'$.sentiment.compound' AS DOUBLE) AS sent_compound
FROM (SELECT *, TRY_CAST(payload AS JSON) AS j FROM v1log)"""


def _text_stats(source: str) -> str:
    """Character statistics and emote tokens of ``message`` per row."""
    return f"""
SELECT *, CASE WHEN n = 0 THEN 0.0 ELSE -list_sum(list_transform(counts, lambda k: (k / n) * log2(k / n))) END AS entropy,
  CASE WHEN n = 0 THEN 0.0 ELSE (1 + coalesce(list_max(list_transform(string_split(same, '0'), lambda r: length(r))), 0))
    / CAST(n AS DOUBLE) END AS run_ratio,
  CASE WHEN n = 0 THEN 0.0 ELSE CAST(length(regexp_replace(message, '[^\\p{{L}}]', '', 'g')) AS DOUBLE) / n END AS alpha,
  list_filter(list_transform(regexp_split_to_array(message, '[ \\t\\n\\x0B\\f\\r]+'),
    lambda w: regexp_replace(regexp_replace(w, '^[^\\p{{L}}\\p{{N}}_]+', ''), '[^\\p{{L}}\\p{{N}}_]+$', '')), lambda w: w <> '') AS toks
FROM (SELECT *, length(message) AS n, map_values(list_histogram(string_split(message, ''))) AS counts,
    array_to_string(list_transform(list_zip(string_split(message, '')[:-2], string_split(message, '')[2:]),
      lambda p: CASE WHEN p[1] = p[2] THEN '1' ELSE '0' END), '') AS same
  FROM {source})"""


EMOTES = "['Kappa','PogChamp','OMEGALUL','LUL','Kreygasm','4Head','FeelsBadMan','FeelsGoodMan']"
SCORES = (
    "MAP {'Kappa': -0.2, 'PogChamp': 0.8, 'OMEGALUL': 0.7, 'LUL': 0.6, 'Kreygasm': 0.7, '4Head': 0.1, "
    "'FeelsBadMan': -0.6, 'FeelsGoodMan': 0.6}"
)

STEPS["stats"] = _text_stats("msg")

STEPS["v1one"] = """
SELECT * FROM v1par WHERE parse_ok QUALIFY row_number() OVER (PARTITION BY part, event_id ORDER BY arrival) = 1"""

STEPS["v1stats"] = _text_stats("v1one")

STEPS["v1sil"] = f"""
SELECT "user", message, sent_neg, sent_neu, sent_pos, sent_compound, ts AS kafka_timestamp, 'chat_enriched' AS topic,
  part AS partition, event_id AS "offset", CAST(length(trim(message, ' ')) AS INTEGER) AS message_length, entropy,
  run_ratio AS repeat_char_ratio, alpha AS alpha_ratio,
  len(toks) > 0 AND len(list_filter(toks, lambda w: list_contains({EMOTES}, w))) = len(toks) AS is_emote_only,
  CAST(len(list_filter(toks, lambda w: list_contains({EMOTES}, w))) AS INTEGER) AS emote_count,
  length(trim(message, ' ')) >= 2 AND round(entropy, 9) >= 1.0 AND run_ratio < 0.7 AS engagement_flag,
  ts AS ingest_ts
FROM v1stats"""

STEPS["fact"] = """
SELECT *, md5(topic || '-' || partition || '-' || "offset") AS message_id,
  CASE WHEN is_emote_only THEN 'EMOTE_ONLY' WHEN message_length < 3 OR round(entropy, 9) < 0.8 THEN 'LOW_EFFORT'
    WHEN repeat_char_ratio >= 0.7 THEN 'REPETITIVE_SPAM' WHEN engagement_flag THEN 'ENGAGED_CHAT' ELSE 'OTHER' END AS message_type
FROM v1sil"""

STEPS["kinds"] = """
SELECT * FROM (VALUES ('EMOTE_ONLY', 'Messages containing only emotes'),
  ('LOW_EFFORT', 'Very short or low-entropy messages'),
  ('REPETITIVE_SPAM', 'Messages with excessive repeated characters'),
  ('ENGAGED_CHAT', 'Messages showing meaningful engagement'),
  ('OTHER', 'Messages not fitting other categories')) k(message_type, description)"""

STEPS["v1raw"] = """
SELECT payload AS json_payload, ts AS kafka_timestamp, 'chat_enriched' AS topic, part AS partition, event_id AS "offset",
  arrival AS ingest_ts, CAST(NULL AS VARCHAR) AS parse_status, CAST(NULL AS VARCHAR) AS parse_error FROM v1log"""

STEPS["v1target"] = """
SELECT * FROM v1raw WHERE CAST(kafka_timestamp AS DATE) < DATE '2024-01-16'
QUALIFY row_number() OVER (PARTITION BY topic, partition, "offset" ORDER BY ingest_ts) = 1"""

# --- chat lines ----------------------------------------------------------------------------

STEPS["lines"] = """
SELECT event_id, ts, '#room' || (user_id % 4) AS channel, CASE
  WHEN event_type = 'error' THEN CASE WHEN value < 100 THEN 'PING :server' ELSE '  ' || chr(13) || chr(10) END
  WHEN event_type = 'signup' THEN who || 'JOIN #room' || (user_id % 4)
  WHEN event_type = 'view' THEN who || 'PRIVMSG #room' || (user_id % 4)
  ELSE who || 'PRIVMSG #room' || (user_id % 4) || ' :' || message || chr(13) || chr(10) END AS raw
FROM (SELECT *, ':User' || user_id || '!user' || user_id || '@host ' AS who FROM msg)"""

BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

STEPS["live"] = f"""
SELECT event_id, ts, channel, trim(raw, {BLANKS}) AS line FROM lines
WHERE length(trim(raw, {BLANKS})) > 0 AND NOT starts_with(trim(raw, {BLANKS}), 'PING')"""

STEPS["said"] = f"""
SELECT *, CASE WHEN chat THEN ltrim(split_part(line, '!', 1), ':') END AS username,
  CASE WHEN chat THEN trim(substr(tail, strpos(tail, ':') + 1), {BLANKS}) END AS message
FROM (SELECT *, strpos(line, 'PRIVMSG') > 0 AND strpos(tail, ':') > 0 AS chat
  FROM (SELECT *, substr(line, strpos(line, 'PRIVMSG') + 7) AS tail FROM live))"""

# --- health --------------------------------------------------------------------------------

STEPS["opsmin"] = """
SELECT run_id, date_trunc('minute', batch_processed_ts) AS event_minute, job_name AS pipeline_stage,
  count(*) AS batch_count, count(*) FILTER (row_count = 0) AS zero_row_batch_count,
  CAST(sum(row_count) AS BIGINT) AS total_rows_written, avg(row_count) AS avg_rows_per_batch,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%bronze_chat_raw'), 0) AS BIGINT) AS bronze_row_count,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%silver_chat_parsed'), 0) AS BIGINT) AS valid_event_count,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%silver_chat_features'), 0) AS BIGINT) AS feature_row_count,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%chat_dlq'), 0) AS BIGINT) AS dlq_row_count_from_sink,
  min(batch_processed_ts) AS first_batch_processed_ts, max(batch_processed_ts) AS last_batch_processed_ts
FROM met GROUP BY ALL"""

STEPS["dlqmin"] = """
SELECT _run_id AS run_id, date_trunc('minute', dlq_ingestion_ts) AS event_minute, pipeline_stage, count(*) AS dlq_count,
  count(*) FILTER (retryable) AS retryable_dlq_count,
  count(*) FILTER (error_category = 'PARSE_ERROR') AS parse_error_count,
  count(*) FILTER (error_category = 'CONTRACT_ERROR') AS contract_error_count,
  count(DISTINCT error_code) AS distinct_error_code_count
FROM dlq GROUP BY ALL"""

STEPS["freshmin"] = """
SELECT _run_id AS run_id, date_trunc('minute', _batch_processed_ts) AS event_minute, _job_name AS pipeline_stage,
  avg(floor(epoch(bronze_ingestion_ts)) - floor(epoch(event_ts))) AS avg_event_time_to_ingest_lag_seconds,
  avg(floor(epoch(silver_processed_ts)) - floor(epoch(bronze_ingestion_ts))) AS avg_bronze_to_silver_latency_seconds,
  CAST(NULL AS DOUBLE) AS avg_event_to_feature_latency_seconds
FROM par GROUP BY ALL
UNION ALL BY NAME
SELECT _run_id AS run_id, date_trunc('minute', _batch_processed_ts) AS event_minute, _job_name AS pipeline_stage,
  avg(event_to_feature_latency_seconds) AS avg_event_to_feature_latency_seconds FROM fea GROUP BY ALL"""

STEPS["health"] = """
SELECT o.run_id, o.event_minute AS minute_ts, o.pipeline_stage, o.* EXCLUDE (run_id, event_minute, pipeline_stage),
  coalesce(dlq_count, 0) AS dlq_count, coalesce(retryable_dlq_count, 0) AS retryable_dlq_count,
  coalesce(parse_error_count, 0) AS parse_error_count, coalesce(contract_error_count, 0) AS contract_error_count,
  coalesce(distinct_error_code_count, 0) AS distinct_error_code_count,
  avg_event_time_to_ingest_lag_seconds, avg_bronze_to_silver_latency_seconds, avg_event_to_feature_latency_seconds,
  coalesce(dlq_count, 0) / nullif(CAST(valid_event_count + coalesce(dlq_count, 0) AS DOUBLE), 0) AS dlq_rate
FROM opsmin o
LEFT JOIN freshmin f ON f.run_id = o.run_id AND f.event_minute = o.event_minute AND f.pipeline_stage = o.pipeline_stage
LEFT JOIN dlqmin d ON d.run_id = o.run_id AND d.event_minute = o.event_minute AND d.pipeline_stage = o.pipeline_stage"""

STEPS["summary"] = """
SELECT run_id,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%bronze_chat_raw'), 0) AS BIGINT) AS bronze_row_count,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%silver_chat_parsed'), 0) AS BIGINT) AS valid_event_count,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%silver_chat_features'), 0) AS BIGINT) AS feature_row_count,
  CAST(coalesce(sum(row_count) FILTER (target_table LIKE '%chat_dlq'), 0) AS BIGINT) AS dlq_row_count_from_sink,
  count(*) AS batch_count, avg(row_count) AS avg_rows_per_batch, max(row_count) AS max_rows_per_batch,
  dlq_row_count_from_sink / nullif(CAST(valid_event_count + dlq_row_count_from_sink AS DOUBLE), 0) AS dlq_rate
FROM met GROUP BY run_id"""

# --- quality and drift ---------------------------------------------------------------------

STEPS["recs"] = """
SELECT event_id, message, kind_ok, value, event_type, CAST(CASE WHEN event_type = 'signup' THEN
    '{"user":"u' || user_id || '"' || CASE WHEN value >= 20 THEN ',"message":' || CAST(to_json(message) AS VARCHAR) ELSE '' END || '}'
  ELSE '{' || CASE WHEN event_type = 'view' AND value < 5 THEN '' ELSE '"channel":"#' || event_type || '",' END
    || '"chatter_id":"user' || user_id || '","message_text":' || CAST(to_json(body) AS VARCHAR) || ',"message_length":'
    || CASE WHEN kind_ok THEN CAST(length(body) AS VARCHAR) ELSE '"' || length(body) || '"' END
    || ',"source_partition":' || (user_id % 4) || ',"source_offset":' || event_id || '}' END AS JSON) AS r
FROM (SELECT *, NOT (event_type = 'click' AND value < 20) AS kind_ok,
  CASE WHEN event_type = 'error' AND value >= 100 THEN chr(7) || message ELSE message END AS body FROM msg)"""

STEPS["assessed"] = f"""
SELECT *, list_transform(missing, lambda f: 'missing_' || f) || typed || sized || warned AS codes,
  len(missing) + len(typed) + len(sized) = 0 AS accepted
FROM (SELECT event_id,
    list_filter(CASE WHEN json_exists(r, '$.channel') OR json_exists(r, '$.chatter_id') OR json_exists(r, '$.message_text')
      THEN ['channel', 'chatter_id', 'message_text'] ELSE ['user', 'message'] END,
      lambda f: coalesce(json_extract_string(r, '$.' || f), '') = '') AS missing,
    list_filter(['message_length', 'source_partition', 'source_offset'],
      lambda f: json_exists(r, '$.' || f) AND json_type(r, '$.' || f) NOT IN ('BIGINT', 'UBIGINT', 'BOOLEAN')) AS typed0,
    list_transform(typed0, lambda f: f || '_type_invalid') AS typed,
    CASE WHEN length(trim(coalesce(r->>'$.message_text', ''), {BLANKS})) BETWEEN 1 AND 500 THEN []
      ELSE ['message_size_out_of_range'] END AS sized,
    CASE WHEN regexp_matches(coalesce(r->>'$.message_text', ''), '[\\x00-\\x08]') THEN ['message_has_control_chars']
      ELSE [] END AS warned
  FROM recs)"""

STEPS["drift"] = """
SELECT *, CASE WHEN missing <> '' OR retyped <> '' THEN 'FAIL_FAST' WHEN extra <> '' THEN 'WARN_AND_CONTINUE' ELSE 'ACCEPT' END AS action
FROM (SELECT event_id, arrival,
  array_to_string(list_filter(['ingestion_ts', 'raw', 'source'],
    lambda f: j IS NULL OR coalesce(json_type(j, '$.' || f), 'NULL') = 'NULL'), ',') AS missing,
  array_to_string(list_sort(list_filter(coalesce(json_keys(j), []),
    lambda f: f NOT IN ('ingestion_ts', 'source', 'raw', 'metadata'))), ',') AS extra,
  array_to_string(list_filter(['ingestion_ts', 'metadata', 'raw', 'source'], lambda f: coalesce(json_type(j, '$.' || f)
    NOT IN ('NULL', CASE f WHEN 'ingestion_ts' THEN 'VARCHAR' ELSE 'OBJECT' END), false)), ',') AS retyped
  FROM bron)"""

STEPS["nested"] = """
SELECT event_id, arrival, TRY_CAST(p AS JSON) AS j FROM (SELECT event_id, arrival,
  CASE WHEN event_id % 7 = 0 THEN replace(p, '"protocol":"irc"', '"protocol":6667') ELSE p END AS p
  FROM (SELECT event_id, arrival, CASE WHEN event_id % 5 = 0
    THEN replace(payload, '"raw":{', '"raw":{"badges":{"vip":true,"level":3},') ELSE payload END AS p FROM log))"""
NESTED_OBJECTS = {
    "": ("ingestion_ts", "metadata", "raw", "source"),
    "source": ("channel", "platform", "protocol", "server"),
    "raw": ("irc_line", "message", "username"),
    "metadata": ("event_kind", "producer_env", "schema_version"),
}


def _nested_extra() -> str:
    parts = []
    for parent, children in NESTED_OBJECTS.items():
        place, prefix = ("$." + parent, parent + ".") if parent else ("$", "")
        keys = f"CASE WHEN json_type(j, '{place}') = 'OBJECT' THEN json_keys(j, '{place}') ELSE [] END"
        parts.append(f"list_transform(list_filter({keys}, lambda k: k NOT IN {children}), lambda k: '{prefix}' || k)")
    return f"list_sort(list_concat({parts[0]}, {parts[1]}, {parts[2]}, {parts[3]}))"


def _nested_retyped() -> str:
    paths = [(f"{p}.{c}" if p else c, "VARCHAR" if p or c == "ingestion_ts" else "OBJECT") for p, cs in NESTED_OBJECTS.items() for c in cs]
    tests = [f"CASE WHEN coalesce(json_type(j, '$.{p}'), 'NULL') NOT IN ('NULL', '{k}') THEN '{p}' END" for p, k in paths]
    return f"list_sort(list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL))"


STEPS["nesteddrift"] = f"""
SELECT *, CASE WHEN missing <> '' OR retyped <> '' THEN 'FAIL_FAST' WHEN extra <> '' THEN 'WARN_AND_CONTINUE' ELSE 'ACCEPT' END AS action
FROM (SELECT event_id, arrival,
  array_to_string(list_filter(['ingestion_ts', 'raw', 'source'],
    lambda f: j IS NULL OR coalesce(json_type(j, '$.' || f), 'NULL') = 'NULL'), ',') AS missing,
  array_to_string({_nested_extra()}, ',') AS extra, array_to_string({_nested_retyped()}, ',') AS retyped
  FROM nested)"""
STEPS["nestedsum"] = """
SELECT kind AS drift_kind, field, action, count(*) AS records FROM (
  SELECT 'missing' AS kind, unnest(string_split(missing, ',')) AS field, action FROM nesteddrift UNION ALL
  SELECT 'unexpected', unnest(string_split(extra, ',')), action FROM nesteddrift UNION ALL
  SELECT 'type', unnest(string_split(retyped, ',')), action FROM nesteddrift) WHERE field <> '' GROUP BY ALL"""
STEPS["paths"] = """
SELECT j, unnest(json_keys(j)) AS path FROM nested WHERE json_type(j) = 'OBJECT' UNION ALL
SELECT j, 'source.' || unnest(json_keys(j, '$.source')) FROM nested WHERE json_type(j, '$.source') = 'OBJECT' UNION ALL
SELECT j, 'raw.' || unnest(json_keys(j, '$.raw')) FROM nested WHERE json_type(j, '$.raw') = 'OBJECT' UNION ALL
SELECT j, 'raw.badges.' || unnest(json_keys(j, '$.raw.badges')) FROM nested WHERE json_type(j, '$.raw.badges') = 'OBJECT' UNION ALL
SELECT j, 'metadata.' || unnest(json_keys(j, '$.metadata')) FROM nested WHERE json_type(j, '$.metadata') = 'OBJECT'"""

STEPS["lagged"] = """
SELECT *, greatest(epoch_us(bronze_ingestion_ts) - epoch_us(event_ts), 0) / 1e6 AS lag,
  greatest(epoch_us(silver_processed_ts) - epoch_us(bronze_ingestion_ts), 0) / 1e6 AS latency FROM par"""

STEPS["snapshot"] = """
SELECT _run_id AS run_id, avg(lag) AS avg_event_to_ingest_lag_seconds, max(lag) AS max_event_to_ingest_lag_seconds,
  avg(latency) AS avg_bronze_to_silver_lag_seconds, max(latency) AS max_bronze_to_silver_lag_seconds,
  any_value(age) AS last_successful_batch_age_seconds
FROM lagged JOIN (SELECT run_id, greatest(epoch_us(TIMESTAMP '2024-03-15') - epoch_us(max(batch_processed_ts)), 0) / 1e6 AS age
  FROM met GROUP BY run_id) m ON m.run_id = _run_id GROUP BY _run_id"""

STEPS["volumes"] = """
SELECT run_id, job_name, target_table, batch_id, greatest(row_count, 0) AS records_in_micro_batch, expected_records,
  row_count AS actual_records, row_count - expected_records AS delta_records,
  CASE WHEN expected_records > 0 THEN abs(row_count - expected_records) / CAST(expected_records AS DOUBLE) > 0.25 ELSE false END
    AS is_spike_or_drop
FROM (SELECT *, CAST(round(avg(row_count) OVER (PARTITION BY job_name, target_table)) AS BIGINT) AS expected_records FROM met)"""

STEPS["uptime"] = """
SELECT run_id, count(DISTINCT slot) AS successful_intervals, max(slot) - min(slot) + 1 AS expected_intervals,
  round(round(successful_intervals / CAST(expected_intervals AS DOUBLE) * 100, 9), 2) AS uptime_proxy_pct
FROM (SELECT run_id, CAST(floor(epoch(batch_processed_ts) / 3600) AS BIGINT) AS slot FROM met) GROUP BY run_id"""

STEPS["triage"] = """
SELECT _run_id AS run_id, error_category, error_code, count(*) AS dlq_count, count(*) FILTER (retryable) AS retryable_count,
  min(dlq_ingestion_ts) AS first_seen_ts, max(dlq_ingestion_ts) AS last_seen_ts FROM dlq GROUP BY ALL"""

STEPS["driftsum"] = """
SELECT kind AS drift_kind, field, action, count(*) AS records FROM (
  SELECT 'missing' AS kind, unnest(string_split(missing, ',')) AS field, action FROM drift UNION ALL
  SELECT 'unexpected', unnest(string_split(extra, ',')), action FROM drift UNION ALL
  SELECT 'type', unnest(string_split(retyped, ',')), action FROM drift) WHERE field <> '' GROUP BY ALL"""

# Batch time of an hour: forty seconds after it ends, plus a lag; run_b ran thirty days later.
BATCH_TIME = re.compile(r"to_timestamp_utc\(([^,()]+), ([^,()]+), ([^,()]+)\)")


def _expand(text: str) -> str:
    return BATCH_TIME.sub(
        r"make_timestamp(((\1 + 473353) * 3600 + 40 + \2 + CASE WHEN \3 = 'run_b' THEN 2592000 ELSE 0 END) * 1000000)",
        text,
    )


def _needed(text: str, found: set[str]) -> None:
    for name, body in STEPS.items():
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            found.add(name)
            _needed(body, found)


def sql(statement: str) -> str:
    found: set[str] = set()
    _needed(statement, found)
    steps = ",\n".join(f"{name} AS ({_expand(STEPS[name])})" for name in STEPS if name in found)
    return f"WITH {steps}\n{_expand(statement)}"


ORACLE_SQL: dict[str, str] = {}


def _add(name: str, statement: str) -> None:
    ORACLE_SQL[name] = sql(statement)


# --- sources, sinks, merges ----------------------------------------------------------------

BRONZE_COLUMNS = (
    "'chat_raw' AS source_topic, part AS source_partition, event_id AS source_offset, ts AS kafka_timestamp, "
    "CAST(0 AS INTEGER) AS kafka_timestamp_type, CAST(user_id AS VARCHAR) AS raw_key"
)
TWO_BATCHES = """payload AS raw_payload, arrival AS bronze_ingestion_ts, 'run_a' AS _run_id, 'bronze_ingest' AS _job_name,
  CAST(day(ts) >= 16 AS BIGINT) AS _batch_id, TIMESTAMP '2024-03-15' AS _batch_processed_ts, CAST(ts AS DATE) AS event_date"""
_add("bronze_projection", f"SELECT {BRONZE_COLUMNS}, payload AS raw_payload, arrival AS bronze_ingestion_ts FROM log")
_add("staging_scan", "SELECT * FROM met")
_add(
    "batch_metrics_row",
    """SELECT 'run_a' AS run_id, 'bronze_ingest' AS job_name, CAST(CASE WHEN day(ts) >= 16 THEN 1 ELSE 0 END AS BIGINT) AS batch_id,
  TIMESTAMP '2024-03-15' AS batch_processed_ts, count(*) AS row_count FROM log GROUP BY ALL""",
)
_add("v1_raw_projection", "SELECT * FROM v1raw")
_add(
    "append_with_batch_metadata",
    f"SELECT {BRONZE_COLUMNS}, {TWO_BATCHES} FROM log",
)
_add(
    "schema_evolution_append",
    f"SELECT {BRONZE_COLUMNS}, {TWO_BATCHES}, CASE WHEN day(ts) >= 16 THEN CAST(length(payload) AS INTEGER) END AS payload_length FROM log",
)
_add(
    "merge_insert_new",
    """SELECT * FROM v1raw
WHERE CAST(kafka_timestamp AS DATE) < DATE '2024-01-16' OR CAST(kafka_timestamp AS DATE) >= DATE '2024-01-14'
QUALIFY row_number() OVER (PARTITION BY topic, partition, "offset" ORDER BY ingest_ts) = 1""",
)
_add(
    "merge_update_status",
    """SELECT t.* REPLACE (CASE WHEN ok THEN 'OK' ELSE 'PARSE_ERROR' END AS parse_status,
  CASE WHEN NOT ok THEN 'PARSE_ERROR' END AS parse_error)
FROM (SELECT * FROM v1raw QUALIFY row_number() OVER (PARTITION BY topic, partition, "offset" ORDER BY ingest_ts) = 1) t
JOIN (SELECT part, event_id, bool_and(parse_ok) AS ok FROM v1par GROUP BY ALL) u ON u.part = t.partition AND u.event_id = t."offset\"""",
)
_add(
    "enriched_topic_sink",
    """SELECT "user", message, sent_neg AS neg, sent_neu AS neu, sent_pos AS pos, sent_compound AS compound, 'user,message,sentiment' AS fields FROM v1sil""",
)
_add(
    "warehouse_sink_projection",
    """SELECT "user" AS "USERNAME", message AS "MESSAGE", sent_compound AS "COMPOUND_SCORE",
  sent_neg AS "SENTIMENT_NEG", sent_neu AS "SENTIMENT_NEU", sent_pos AS "SENTIMENT_POS", sent_compound AS "SENTIMENT_COMPOUND" FROM v1sil""",
)
_add("staging_scan_parsed", "SELECT * FROM par")
_add("staging_scan_dlq", "SELECT * FROM dlq")
_add("materialize_ephemeral", "SELECT run_id, job_name, CAST(sum(row_count) AS BIGINT) AS row_count FROM met GROUP BY ALL")
_add("materialize", "SELECT run_id, target_table, CAST(sum(row_count) AS BIGINT) AS row_count FROM met GROUP BY ALL")

# --- chat lines ----------------------------------------------------------------------------

_add("irc_filter", "SELECT event_id, line FROM live")
_add("irc_parse", "SELECT event_id, username, message FROM said")
_add(
    "envelope_build",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingestion_ts, 'twitch' AS platform, channel,
  line AS irc_line, username, message, CASE WHEN message IS NULL THEN 'non_chat_event' ELSE 'chat_message' END AS event_kind,
  '1.0.0' AS schema_version FROM said""",
)

# --- parse, validate, route ----------------------------------------------------------------

_add(
    "envelope_parse",
    """SELECT part AS source_partition, event_id AS source_offset, arrival AS bronze_ingestion_ts, j IS NOT NULL AS parse_ok,
  j->>'$.ingestion_ts' AS ingestion_ts, j->>'$.source.platform' AS platform, j->>'$.source.protocol' AS protocol,
  j->>'$.source.server' AS server, j->>'$.source.channel' AS channel, j->>'$.raw.irc_line' AS irc_line,
  j->>'$.raw.username' AS username, j->>'$.raw.message' AS message, j->>'$.metadata.event_kind' AS event_kind,
  j->>'$.metadata.producer_env' AS producer_env, j->>'$.metadata.schema_version' AS schema_version FROM bron""",
)
_add(
    "parse_split",
    """SELECT CASE WHEN j IS NULL THEN 'failed' ELSE 'parseable' END AS branch, part AS source_partition, count(*) AS row_count
FROM bron GROUP BY ALL""",
)
_add(
    "blank_to_null",
    "SELECT event_id, nullif(trim(message, ' '), '') AS message_text, lower(event_type) AS kind FROM msg",
)
_add("parsed_projection", "SELECT * EXCLUDE (hour, j, raw_payload) FROM cls")
_add(
    "event_key",
    """SELECT 'chat_raw:' || part || ':' || event_id AS event_id, 'chat_raw' AS topic, part AS partition, event_id AS "offset" FROM log""",
)
_add("valid_filter", "SELECT * EXCLUDE (hour, j, raw_payload, outcome) FROM cls WHERE outcome = 'VALID'")
_add("contract_failures", "SELECT * EXCLUDE (raw_payload) FROM dead WHERE error_category = 'CONTRACT_ERROR'")
_add("parse_failures", "SELECT * EXCLUDE (raw_payload) FROM dead WHERE error_category = 'PARSE_ERROR'")
_add("dlq_union", "SELECT * FROM dead")
_add(
    "dlq_union_literal",
    """SELECT * REPLACE ('CONTRACT_ERROR' AS error_category, 'CONTRACT_REQUIRED_FIELDS_MISSING' AS error_code,
  'Required parsed fields missing or invalid' AS error_detail, false AS retryable) FROM dead""",
)
_add(
    "dlq_record",
    """SELECT TIMESTAMP '2024-03-15' AS dlq_ingestion_ts, coalesce(code, 'UNKNOWN_ERROR') AS error_category, code AS error_code,
  CASE code WHEN 'CONTRACT_ERROR' THEN 'Required fields missing after parse/normalize'
    WHEN 'TYPE_ERROR' THEN array_to_string(list_filter([CASE WHEN list_contains(codes, 'message_length_type_invalid') THEN 'message_length must be int' END,
      CASE WHEN list_contains(codes, 'message_size_out_of_range') THEN 'Message is empty or too long' END], lambda x: x IS NOT NULL), '; ')
    ELSE 'Unknown processing error' END AS error_detail,
  false AS retryable, CAST(NULL AS VARCHAR) AS source_topic, CAST(NULL AS INTEGER) AS source_partition,
  event_id AS source_offset, CAST(NULL AS TIMESTAMP) AS source_event_ts, 'silver_parse' AS pipeline_stage
FROM (SELECT *, CASE WHEN len(typed) > 0 THEN 'TYPE_ERROR' WHEN len(missing) > 0 THEN 'CONTRACT_ERROR' END AS code
  FROM assessed WHERE NOT accepted)""",
)
_add("stream_dedupe", "SELECT * EXCLUDE (hour) FROM good")
SQUEEZED = "regexp_replace(trim(coalesce(j->>'$.{0}', ''), " + BLANKS + "), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')"
_add(
    "text_contract",
    f"""SELECT 'chat_raw:' || part || ':' || event_id AS event_id, 'chat_raw' AS source_topic, part AS source_partition,
  event_id AS source_offset, made AS event_ts, made AS bronze_ingestion_ts, TIMESTAMP '2024-03-15' AS silver_processed_ts,
  {SQUEEZED.format('source.channel')} AS channel, coalesce(nullif({SQUEEZED.format('source.platform')}, ''), 'twitch') AS source_platform,
  lower({SQUEEZED.format('raw.username')}) AS chatter_id, {SQUEEZED.format('raw.message')} AS message_text,
  lower({SQUEEZED.format('raw.message')}) AS message_text_normalized,
  CAST(length({SQUEEZED.format('raw.message')}) AS INTEGER) AS message_length
FROM (SELECT *, CASE WHEN NOT (event_type = 'click' AND value < 5) THEN ts END AS made FROM bron WHERE j IS NOT NULL)""",
)
_add(
    "json_object_check",
    """SELECT event_id AS source_offset, arrival AS bronze_ingestion_ts, CASE WHEN j IS NULL THEN 'invalid_json' END AS failure_code,
  CASE WHEN j IS NULL THEN 'invalid_json' ELSE 'payload_not_object' END AS failure_code_in_list FROM bron""",
)
_add(
    "v1_parse",
    """SELECT "user", message, sent_neg, sent_neu, sent_pos, sent_compound, ts AS kafka_timestamp, 'chat_enriched' AS topic,
  part AS partition, event_id AS "offset", parse_ok FROM v1par""",
)

# --- scalar features -----------------------------------------------------------------------

ROUNDED_FEATURES = (
    "* REPLACE (round(repeat_char_ratio, 6) AS repeat_char_ratio, round(text_complexity_proxy, 6) AS text_complexity_proxy)"
)
_add("message_features", f"SELECT {ROUNDED_FEATURES} FROM feat")
_add("staging_scan_features", f"SELECT {ROUNDED_FEATURES} FROM fea")
_add(
    "message_features_literal",
    """SELECT * EXCLUDE (message_length) REPLACE (0.0::DOUBLE AS repeat_char_ratio, round(text_complexity_proxy, 6) AS text_complexity_proxy,
  false AS has_repeat_spam_pattern, message_length >= 2 AND text_complexity_proxy >= 0.3 AS engagement_signal)
FROM (SELECT feat.*, g.message_length FROM feat JOIN good g USING (event_id))""",
)
for _name in (
    "token_count",
    "alpha_char_count",
    "numeric_char_count",
    "link_count",
    "candidate_emote_token_count",
    "event_to_feature_latency_seconds",
    "has_repeat_spam_pattern",
    "engagement_signal",
    "feature_processed_ts",
):
    _add(_name, f"SELECT event_id, {_name} FROM feat")
for _name in ("repeat_char_ratio", "text_complexity_proxy"):
    _add(_name, f"SELECT event_id, round({_name}, 6) AS {_name} FROM feat")

STEPS["prof"] = f"""
SELECT event_id, CAST(n AS INTEGER) AS profile_message_length, CAST(len(toks) AS INTEGER) AS profile_tokens,
  CAST(len(list_filter(toks, lambda t: regexp_full_match(t, '[A-Za-z0-9_]{{2,24}}\\n?') AND regexp_matches(t, '[A-Z]'))) AS INTEGER)
    AS profile_emote_count,
  len(toks) > 0 AND len(list_filter(toks, lambda t: NOT regexp_full_match(t, '[A-Za-z0-9_]{{2,24}}\\n?'))) = 0 AS profile_is_emote_only,
  share AS frequent_char_share, proxy AS entropy_proxy,
  regexp_matches(message, '(?i)https?://[^ \\t\\n\\x0B\\f\\r]') AS contains_link,
  four OR share >= 0.35 AS profile_spam, n >= 2 AND proxy >= 1.0 AND share < 0.7 AS profile_engagement
FROM (SELECT *, CASE WHEN n > 0 THEN round(coalesce(list_sum(list_filter(counts, lambda k: k > 2)), 0) / n, 4) ELSE 0.0 END AS share,
    CASE WHEN n > 0 THEN round(log2(len(counts)), 4) ELSE 0.0 END AS proxy,
    list_filter(string_split(body, ' '), lambda t: t <> '') AS toks
  FROM (SELECT *, length(body) AS n, map_values(list_histogram(string_split(body, ''))) AS counts,
      len(list_filter(list_zip(c, c[2:], c[3:], c[4:]),
        lambda p: p[1] = p[2] AND p[2] = p[3] AND p[3] = p[4] AND p[1] <> chr(10))) > 0 AS four
    FROM (SELECT *, trim(message, {BLANKS}) AS body, string_split(message, '') AS c FROM msg)))"""

_add("text_profile", "SELECT * FROM prof")
for _name in (
    "profile_message_length",
    "profile_emote_count",
    "profile_is_emote_only",
    "frequent_char_share",
    "entropy_proxy",
    "contains_link",
    "profile_spam",
    "profile_engagement",
):
    _add(_name, f"SELECT event_id, {_name} FROM prof")

_add(
    "profile_tokens",
    f"""SELECT event_id, array_to_string(list_filter(string_split(trim(message, {BLANKS}), ' '), lambda t: t <> ''), chr(31)) AS profile_tokens
FROM msg""",
)

V1_ROUNDED = (
    "* REPLACE (round(entropy, 6) AS entropy, round(repeat_char_ratio, 6) AS repeat_char_ratio, "
    "round(alpha_ratio, 6) AS alpha_ratio)"
)
_add("v1_enrich", f"SELECT {V1_ROUNDED} FROM v1sil")
_add("engagement_flag", 'SELECT topic, partition, "offset", engagement_flag FROM v1sil')
_add("shannon_entropy", "SELECT event_id, round(entropy, 6) AS shannon_entropy FROM stats")
_add("max_run_ratio", "SELECT event_id, round(run_ratio, 6) AS max_run_ratio FROM stats")
_add("alpha_ratio", "SELECT event_id, round(alpha, 6) AS alpha_ratio FROM stats")
_add("emote_tokens", "SELECT event_id, coalesce(array_to_string(toks, '|'), '') AS emote_tokens FROM stats")
_add(
    "dict_is_emote_only",
    f"""SELECT event_id, len(toks) > 0 AND len(list_filter(toks, lambda w: list_contains({EMOTES}, w))) = len(toks)
  AS dict_is_emote_only FROM stats""",
)
_add(
    "dict_emote_count",
    f"""SELECT event_id, CAST(len(list_filter(toks, lambda w: list_contains({EMOTES}, w))) AS INTEGER) AS dict_emote_count FROM stats""",
)
_add(
    "emote_sentiment",
    f"""SELECT event_id, round(CAST(coalesce(list_sum(list_transform(toks, lambda w: coalesce(({SCORES})[w], 0))), 0) AS DOUBLE), 6)
  AS emote_sentiment FROM stats""",
)
_add(
    "lexicon_sentiment",
    f"""SELECT event_id, coalesce(round(neg / nullif(neg + neu + pos, 0), 3), 0.0) AS neg,
  coalesce(round(neu / nullif(neg + neu + pos, 0), 3), 0.0) AS neu, coalesce(round(pos / nullif(neg + neu + pos, 0), 3), 0.0) AS pos,
  round(total / sqrt(total * total + 15), 4) AS compound
FROM (SELECT event_id, coalesce(list_sum(list_transform(scores, lambda s: CASE WHEN s > 0 THEN s + 1 ELSE 0.0 END)), 0.0) AS pos,
    coalesce(list_sum(list_transform(scores, lambda s: CASE WHEN s < 0 THEN 1 - s ELSE 0.0 END)), 0.0) AS neg,
    CAST(len(list_filter(scores, lambda s: s = 0)) AS DOUBLE) AS neu, coalesce(list_sum(scores), 0.0) AS total
  FROM (SELECT event_id, list_transform(toks, lambda w: CAST(coalesce(({SCORES})[w], 0) AS DOUBLE)) AS scores FROM stats))""",
)

# --- versions and joins --------------------------------------------------------------------

_add("latest_parsed", "SELECT * FROM newpar")
_add("latest_features", f"SELECT {ROUNDED_FEATURES} FROM newfea")
_add("parsed_left_features", f"SELECT {ROUNDED_FEATURES} FROM joined")
_add(
    "ops_left_freshness_dlq",
    """SELECT run_id, event_minute, pipeline_stage, batch_count, dlq_count,
  round(avg_bronze_to_silver_latency_seconds, 6) AS avg_bronze_to_silver_latency_seconds
FROM opsmin o LEFT JOIN freshmin f USING (run_id, event_minute, pipeline_stage)
LEFT JOIN dlqmin d USING (run_id, event_minute, pipeline_stage)""",
)
_add("message_type_dim_join", "SELECT message_id, message_type, description FROM fact JOIN kinds USING (message_type)")
_add(
    "message_type_dim",
    """SELECT message_type, any_value(description) AS description, count(message_id) AS message_count
FROM kinds LEFT JOIN fact USING (message_type) GROUP BY message_type""",
)

# --- roll-ups and marts --------------------------------------------------------------------


def _rollup(grain: str, column: str) -> str:
    means = ", ".join(
        f"round(avg({c}), 6) AS avg_{c}"
        for c in (
            "message_length",
            "token_count",
            "alpha_char_count",
            "numeric_char_count",
            "repeat_char_ratio",
            "text_complexity_proxy",
            "event_to_feature_latency_seconds",
        )
    )
    return f"""SELECT CAST(date_trunc('{grain}', event_ts) AS TIMESTAMP) AS {column}, channel, count(*) AS total_messages,
  count(DISTINCT chatter_id) AS unique_chatters, count(token_count) AS feature_enriched_message_count, {means},
  CAST(sum(link_count) AS BIGINT) AS link_count_sum,
  CAST(sum(candidate_emote_token_count) AS BIGINT) AS candidate_emote_token_count_sum,
  count(*) FILTER (has_repeat_spam_pattern) AS repeat_spam_count,
  round(avg(CAST(has_repeat_spam_pattern AS INTEGER)), 6) AS repeat_spam_rate,
  count(*) FILTER (engagement_signal) AS engagement_signal_count,
  round(avg(CAST(engagement_signal AS INTEGER)), 6) AS engagement_signal_rate FROM joined GROUP BY ALL"""


STEPS["byminute"] = _rollup("minute", "event_minute")
STEPS["byday"] = _rollup("day", "event_date")
_add("engagement_minute", "SELECT * FROM byminute")
_add("engagement_daily", "SELECT * FROM byday")
MART = (
    "round(total_messages / CAST(unique_chatters AS DOUBLE), 6) AS avg_messages_per_chatter, "
    "round(feature_enriched_message_count / CAST(total_messages AS DOUBLE), 6) AS feature_enrichment_rate"
)
_add(
    "channel_engagement_minute",
    f"SELECT event_minute AS minute_ts, * EXCLUDE (event_minute), {MART} FROM byminute",
)
_add("channel_engagement_daily", f"SELECT event_date AS date_day, * EXCLUDE (event_date), {MART} FROM byday")
ORACLE_SQL["materialize_table"] = ORACLE_SQL["parsed_left_features"]
ORACLE_SQL["engagement_minute_state"] = ORACLE_SQL["engagement_minute"]
ORACLE_SQL["engagement_daily_state"] = ORACLE_SQL["engagement_daily"]
ORACLE_SQL["channel_engagement_daily_refresh"] = ORACLE_SQL["channel_engagement_daily"]
ORACLE_SQL["channel_engagement_minute_refresh"] = ORACLE_SQL["channel_engagement_minute"]
_add("ops_metrics_minute", "SELECT * REPLACE (round(avg_rows_per_batch, 6) AS avg_rows_per_batch) FROM opsmin")
_add("dlq_minute", "SELECT * FROM dlqmin")
ROUNDED_LAGS = """round(avg_event_time_to_ingest_lag_seconds, 6) AS avg_event_time_to_ingest_lag_seconds,
  round(avg_bronze_to_silver_latency_seconds, 6) AS avg_bronze_to_silver_latency_seconds,
  round(avg_event_to_feature_latency_seconds, 6) AS avg_event_to_feature_latency_seconds"""
_add("freshness_minute", f"SELECT * REPLACE ({ROUNDED_LAGS}) FROM freshmin")
_add(
    "health_minute",
    f"SELECT * REPLACE ({ROUNDED_LAGS}, round(dlq_rate, 6) AS dlq_rate, round(avg_rows_per_batch, 6) AS avg_rows_per_batch) FROM health",
)
SENTIMENT = """count(*) FILTER (sent_compound > 0.05) AS positive_messages,
  count(*) FILTER (sent_compound < -0.05) AS negative_messages,
  count(*) FILTER (abs(sent_compound) <= 0.05) AS neutral_messages"""
_add(
    "chat_metrics_minute",
    f"""SELECT date_trunc('minute', kafka_timestamp) AS minute, count(*) AS message_count,
  round(avg(sent_compound), 6) AS avg_sentiment, {SENTIMENT}, count(*) FILTER (engagement_flag) AS engaged_messages,
  round(avg(CAST(engagement_flag AS INTEGER)), 6) AS engagement_rate, count(*) FILTER (is_emote_only) AS emote_only_messages,
  round(avg(message_length), 6) AS avg_message_length FROM v1sil GROUP BY ALL""",
)
_add(
    "sentiment_summary",
    f"""SELECT topic, CAST(kafka_timestamp AS DATE) AS message_date, count(*) AS total_messages, {SENTIMENT},
  round(positive_messages / CAST(total_messages AS DOUBLE), 4) AS pct_positive,
  round(negative_messages / CAST(total_messages AS DOUBLE), 4) AS pct_negative FROM fact GROUP BY ALL""",
)
_add("chat_messages_fact", f"SELECT {V1_ROUNDED} FROM fact")

# --- streams -------------------------------------------------------------------------------

def _delivery(arrival: str, ts: str) -> str:
    """Deliveries by day of capture; what came an hour late or more waits ten days longer."""
    waits = f"CASE WHEN floor(epoch({arrival})) - floor(epoch({ts})) > 3600 THEN 10 ELSE 0 END"
    return f"least((date_diff('day', DATE '2024-01-01', CAST({arrival} AS DATE)) + {waits}) // 8, 3)"


STEPS["dlv"] = f"""
SELECT *, {_delivery("bronze_ingestion_ts", "event_ts")} AS d FROM cls"""
# The parse stream is started again after the second delivery, which leaves a batch without rows behind. A
# batch drops rows behind the watermark that was in force in the batch before it.
STEPS["marks"] = """
SELECT d, lag(mark) OVER (ORDER BY b) AS mark FROM (
  SELECT b, d, max(top) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000 AS mark
  FROM (SELECT d, d + CASE WHEN d >= 2 THEN 1 ELSE 0 END AS b, max(epoch_us(event_ts) // 1000) FILTER (outcome = 'VALID') AS top
    FROM dlv GROUP BY d UNION ALL SELECT NULL, 2, NULL))"""
STEPS["streamed"] = """
SELECT dlv.* REPLACE (event_ts AS bronze_ingestion_ts, event_ts AS silver_processed_ts), outcome = 'VALID' AS good,
  outcome = 'VALID' AND coalesce(epoch_us(event_ts) <= mark * 1000, FALSE) AS late,
  'run_a' AS _run_id, 'silver_parse' AS _job_name, CAST(d + CASE WHEN d >= 2 THEN 1 ELSE 0 END AS BIGINT) AS _batch_id
FROM dlv JOIN marks USING (d)"""
STEPS["kept"] = """
SELECT * FROM streamed WHERE good AND NOT late QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY d) = 1"""

BRONZE_STREAM = f"""SELECT {BRONZE_COLUMNS}, payload AS raw_payload, ts AS bronze_ingestion_ts, 'run_a' AS _run_id, 'bronze_ingest' AS _job_name,
  CAST({_delivery("arrival", "ts")} AS BIGINT) AS _batch_id FROM log"""
_add("kafka_to_bronze_stream", BRONZE_STREAM)
_add("stream_table_scan", f"SELECT * EXCLUDE (_run_id, _job_name, _batch_id) FROM ({BRONZE_STREAM})")
_add("stream_append", f"SELECT *, count(*) OVER (PARTITION BY _batch_id) AS row_count FROM ({BRONZE_STREAM})")
_add("dlq_sink", "SELECT * REPLACE (TIMESTAMP '2024-03-15' AS dlq_ingestion_ts) FROM dead")
_add(
    "idempotent_batch_write",
    f"""SELECT {BRONZE_COLUMNS}, payload AS raw_payload, arrival AS bronze_ingestion_ts, 'run_a' AS _run_id, 'bronze_ingest' AS _job_name,
  CAST(3 AS BIGINT) AS _batch_id, CAST(ts AS DATE) AS event_date FROM log""",
)
_add(
    "skip_empty_batch",
    "SELECT 'run_a' AS run_id, 'dlq_router' AS job_name, CAST(1 AS BIGINT) AS batch_id, count(*) AS row_count FROM dead",
)
_add(
    "bronze_to_silver_stream",
    """SELECT 'parsed' AS target, source_topic, source_partition, source_offset, _batch_id, message_text,
  CAST(NULL AS VARCHAR) AS error_code, CAST(NULL AS VARCHAR) AS raw_payload FROM kept
UNION ALL SELECT 'dlq', source_topic, source_partition, source_offset, _batch_id, NULL,
  CASE outcome WHEN 'PARSE_ERROR' THEN 'JSON_PARSE_FAILURE' ELSE 'CONTRACT_REQUIRED_FIELDS_MISSING' END, raw_payload
FROM streamed WHERE NOT good""",
)
_add("watermark_dedupe_stream", "SELECT * EXCLUDE (hour, j, raw_payload, outcome, d, good, late) FROM kept")
STEPS["inline"] = """
SELECT * FROM kept"""
_add(
    "silver_to_features_stream",
    f"SELECT {ROUNDED_FEATURES} FROM (SELECT event_id, {_feature_columns('silver_processed_ts')} FROM {_measured('inline')})",
)
_add(
    "v1_foreach_batch",
    """SELECT 'chat_enriched' AS topic, l.part AS partition, l.event_id AS "offset", l.payload AS json_payload,
  CASE WHEN ok THEN 'OK' ELSE 'PARSE_ERROR' END AS parse_status, CASE WHEN NOT ok THEN 'PARSE_ERROR' END AS parse_error,
  s."user", s.message_length, s.emote_count, s.engagement_flag
FROM (SELECT part, event_id, bool_and(parse_ok) AS ok, min(payload) AS payload FROM v1par GROUP BY part, event_id) l
LEFT JOIN v1sil s ON s.partition = l.part AND s."offset" = l.event_id""",
)
_add(
    "replay",
    """SELECT * EXCLUDE (hour) REPLACE (bronze_ingestion_ts AS silver_processed_ts), 'run_b' AS _run_id, 'silver_parse' AS _job_name,
  CAST(0 AS BIGINT) AS _batch_id, TIMESTAMP '2024-03-15' AS _batch_processed_ts
FROM good WHERE event_ts >= TIMESTAMP '2024-01-20' AND event_ts < TIMESTAMP '2024-01-25'""",
)
_add(
    "late_row_audit",
    """SELECT count(*) AS bronze_rows, (SELECT count(*) FROM kept) AS valid_rows, count(*) FILTER (NOT good) AS dlq_rows,
  count(*) FILTER (good AND NOT late) - (SELECT count(*) FROM kept) AS duplicate_rows, count(*) FILTER (late) AS late_rows,
  CAST(0 AS BIGINT) AS unaccounted_rows,
  count(DISTINCT event_id) FILTER (late AND event_id NOT IN (SELECT event_id FROM kept)) AS lost_events,
  (SELECT count(*) FROM kept WHERE epoch_us(event_ts) + 600000000 > 1000 * (SELECT max(epoch_us(event_ts) // 1000) - 600000 FROM streamed WHERE good))
    AS remembered_keys,
  CAST(0 AS BIGINT) AS expired_keys, epoch_ms(max(epoch_us(event_ts) // 1000) FILTER (good) - 600000) AS final_watermark_ts
FROM streamed""",
)
_add(
    "late_row_audit_of_tables",
    """SELECT count(*) AS bronze_rows, count(DISTINCT event_id) FILTER (outcome = 'VALID' AND kept) AS valid_rows,
  count(*) FILTER (outcome <> 'VALID') AS dlq_rows,
  count(*) FILTER (outcome = 'VALID' AND kept) - valid_rows AS duplicate_rows,
  count(*) FILTER (outcome = 'VALID' AND NOT kept) AS late_rows
FROM (SELECT *, min(floor(epoch(bronze_ingestion_ts)) - floor(epoch(event_ts))) OVER (PARTITION BY event_id) <= 7200 AS kept FROM cls)""",
)

# --- observability -------------------------------------------------------------------------

_add("event_ingest_lag", "SELECT event_id, _run_id, round(lag, 6) AS event_time_to_ingest_lag_seconds FROM lagged")
_add("bronze_silver_latency", "SELECT event_id, _run_id, round(latency, 6) AS bronze_to_silver_latency_seconds FROM lagged")
_add(
    "last_batch_age",
    """SELECT job_name, max(batch_processed_ts) AS last_success_ts,
  greatest(epoch_us(TIMESTAMP '2024-03-15') - epoch_us(max(batch_processed_ts)), 0) / 1e6 AS last_successful_batch_age_seconds
FROM met GROUP BY job_name""",
)
_add("freshness_snapshot", "SELECT run_id, round(COLUMNS(* EXCLUDE (run_id)), 6) FROM snapshot")
_add("volume_snapshot", "SELECT * FROM volumes")
_add(
    "schema_drift",
    """SELECT event_id AS source_offset, arrival AS bronze_ingestion_ts, missing AS missing_required_fields,
  extra AS unexpected_fields, retyped AS type_drift_fields, action FROM drift""",
)
_add("schema_drift_summary", "SELECT * REPLACE (replace(action, 'FAIL_FAST', 'DLQ') AS action) FROM driftsum")
_add(
    "schema_drift_paths",
    """SELECT event_id AS source_offset, arrival AS bronze_ingestion_ts, missing AS missing_required_fields,
  extra AS unexpected_fields, retyped AS type_drift_fields, action FROM nesteddrift""",
)
_add("schema_drift_paths_summary", "SELECT * REPLACE (replace(action, 'FAIL_FAST', 'DLQ') AS action) FROM nestedsum")
_add(
    "schema_union",
    """SELECT path, CASE json_type(j, '$.' || path) WHEN 'VARCHAR' THEN 'STRING' WHEN 'OBJECT' THEN 'OBJECT' WHEN 'BOOLEAN' THEN 'BOOLEAN'
  ELSE 'BIGINT' END AS kind, count(*) AS records FROM paths GROUP BY ALL""",
)
_add(
    "slo_breached",
    "SELECT run_id, minute_ts, pipeline_stage, round(dlq_rate, 6) AS dlq_rate, dlq_rate > 0.01 AS slo_breached FROM health",
)
_add(
    "micro_batch_success_ratio",
    """SELECT run_id, job_name, count(*) AS attempted_batches, count(*) FILTER (row_count > 0) AS successful_batches,
  round(round(successful_batches / CAST(attempted_batches AS DOUBLE), 9), 4) AS success_ratio FROM met GROUP BY ALL""",
)
_add(
    "healthy_run_pct",
    """SELECT count(*) AS total_runs, count(*) FILTER (coalesce(dlq_rate, 0) <= 0.01) AS healthy_runs,
  round(healthy_runs / CAST(total_runs AS DOUBLE) * 100, 2) AS healthy_run_pct FROM summary""",
)
_add("uptime_proxy_pct", "SELECT * FROM uptime")
_add(
    "healthy_interval_pct",
    """SELECT run_id, pipeline_stage, count(dlq_rate) AS observed_intervals, count(*) FILTER (dlq_rate <= 0.01) AS healthy_intervals,
  round(round(healthy_intervals / CAST(observed_intervals AS DOUBLE) * 100, 9), 2) AS healthy_interval_pct
FROM health WHERE dlq_rate IS NOT NULL GROUP BY ALL""",
)

# --- quality and contracts -----------------------------------------------------------------

_add("required_fields_check", "SELECT event_id, coalesce(array_to_string(missing, ','), '') AS missing_fields FROM assessed")
_add(
    "message_size_check",
    f"SELECT event_id, length(trim(message, {BLANKS})) BETWEEN 1 AND 500 AS size_ok FROM msg",
)
_add("type_sanity_check", "SELECT event_id, coalesce(array_to_string(typed, ','), '') AS type_issues FROM assessed")
_add("suspicious_chars_check", "SELECT event_id, coalesce(array_to_string(warned, ','), '') AS warnings FROM assessed")
_add("assess_records", "SELECT event_id, accepted, coalesce(array_to_string(codes, ','), '') AS issue_codes FROM assessed")
_add(
    "contract_check",
    """SELECT 'silver_chat_parsed' AS dataset, 'required_fields_present' AS rule,
  count(*) FILTER (channel IS NULL OR chatter_id IS NULL OR message_text IS NULL) AS violations FROM cls
UNION ALL SELECT 'silver_chat_parsed', 'message_length_positive', count(*) FILTER (coalesce(message_length, 0) <= 0) FROM cls
UNION ALL SELECT 'chat_dlq', 'dlq_rows_must_include_raw_payload', count(*) FILTER (raw_payload IS NULL) FROM dlq
UNION ALL SELECT 'chat_dlq', 'dlq_rows_must_include_error_context', count(*) FILTER (error_category IS NULL OR error_detail IS NULL) FROM dlq
UNION ALL SELECT 'chat_dlq', 'parse_failures_marked_retryable', count(*) FILTER (error_code = 'JSON_PARSE_FAILURE' AND NOT retryable) FROM dlq
UNION ALL SELECT 'streaming_batch_metrics', unnest(['run_id_present', 'job_name_present', 'batch_id_present', 'row_count_non_negative']),
  unnest([count(*) FILTER (run_id IS NULL), count(*) FILTER (job_name IS NULL), count(*) FILTER (batch_id IS NULL),
    count(*) FILTER (row_count < 0)]) FROM met""",
)
PARSED_TYPES = (
    ("event_id", "string", True),
    ("source_topic", "string", True),
    ("source_partition", "int", True),
    ("source_offset", "bigint", True),
    ("event_ts", "timestamp", True),
    ("bronze_ingestion_ts", "timestamp", True),
    ("silver_processed_ts", "timestamp", True),
    ("channel", "string", True),
    ("chatter_id", "string", True),
    ("message_text", "string", True),
    ("message_text_normalized", "string", False),
    ("message_length", "int", False),
    ("source_platform", "string", False),
)
STEPS["broken"] = """
SELECT _run_id, event_id, CASE WHEN source_offset % 70 <> 0 THEN channel END AS channel, chatter_id, message_text,
  CASE WHEN source_offset % 90 = 0 THEN 0 ELSE message_length END AS message_length
FROM par, range(2) AS copies(k) WHERE k = 0 OR source_offset % 50 = 0
UNION ALL SELECT _run_id, source_topic || ':' || source_partition || ':' || source_offset, NULL, NULL, 'late', 4
FROM dlq WHERE error_category = 'CONTRACT_ERROR' AND source_offset % 3 = 0"""


def _parsed_rules(relation: str, rows: str) -> str:
    failed = "SELECT _run_id, source_topic || ':' || source_partition || ':' || source_offset AS event_id FROM dlq WHERE error_category = 'CONTRACT_ERROR'"
    return f"""SELECT '{relation}' AS relation, 'required_fields_present' AS rule,
  count(*) FILTER (channel IS NULL OR chatter_id IS NULL OR message_text IS NULL) AS violations FROM {rows}
UNION ALL SELECT '{relation}', 'message_length_positive', count(*) FILTER (coalesce(message_length, 0) <= 0) FROM {rows}
UNION ALL SELECT '{relation}', 'event_id_unique_within_contract_output', count(*) - count(DISTINCT (_run_id, event_id)) FROM {rows}
UNION ALL SELECT '{relation}', 'contract_failures_routed_to_dlq', count(DISTINCT (r._run_id, r.event_id))
  FROM {rows} r JOIN ({failed}) f ON f._run_id = r._run_id AND f.event_id = r.event_id"""


_add("parsed_contract_check", f"{_parsed_rules('published', 'par')}\nUNION ALL {_parsed_rules('broken', 'broken')}")


def _not_null(model: str, source: str, columns: tuple[str, ...]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, 'not_null' AS test, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS violations FROM {source}" for c in columns
    )


def _unique(model: str, source: str, column: str) -> str:
    return f"SELECT '{model}', 'unique', '{column}', count({column}) - count(DISTINCT {column}) FROM {source}"


_add(
    "model_tests",
    "\nUNION ALL ".join(
        [
            _not_null("parsed_broken", "broken", ("event_id", "channel", "chatter_id")), _unique("parsed_broken", "broken", "event_id"),
            _not_null("parsed", "par", ("event_id", "channel", "chatter_id")), _not_null("features", "fea", ("event_id",)),
            _not_null("parsed_left_features", "joined", ("event_id",)), _unique("parsed_left_features", "joined", "event_id"),
            _not_null("batch_metrics", "met", ("run_id", "job_name", "batch_id")),
            _not_null("engagement_minute", "byminute", ("event_minute", "channel")),
            _not_null("engagement_daily", "byday", ("event_date", "channel")),
            _not_null("ops_metrics_minute", "opsmin", ("pipeline_stage", "event_minute")),
            _not_null("dlq_minute", "dlqmin", ("pipeline_stage", "event_minute")),
            _not_null("freshness_minute", "freshmin", ("pipeline_stage", "event_minute")),
            _not_null("channel_engagement_minute", "(SELECT event_minute AS minute_ts, channel FROM byminute)", ("minute_ts", "channel")),
            _not_null("channel_engagement_daily", "(SELECT event_date AS date_day, channel FROM byday)", ("date_day", "channel")),
            _not_null("health_minute", "health", ("minute_ts", "pipeline_stage")),
        ]
    ),
)


def _contract_rows(dataset: str, source: str, columns: tuple[tuple[str, str, bool], ...]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS column_name, '{kind}' AS expected_type, '{kind}' AS actual_type, {str(required).lower()} AS is_required, "
        f"count(*) FILTER ({name} IS NULL) AS null_count, {str(required).lower()} AND count(*) FILTER ({name} IS NULL) > 0 AS is_violation FROM {source}"
        for name, kind, required in columns
    )


DLQ_TYPES = (
    ("dlq_ingestion_ts", "timestamp", True), ("error_category", "string", True), ("error_code", "string", False),
    ("error_detail", "string", True), ("retryable", "boolean", True), ("raw_payload", "string", True), ("source_topic", "string", False),
    ("source_partition", "int", False), ("source_offset", "bigint", False), ("source_event_ts", "timestamp", False),
    ("pipeline_stage", "string", True),
)
METRICS_TYPES = (
    ("run_id", "string", True), ("job_name", "string", True), ("batch_id", "bigint", True), ("batch_processed_ts", "timestamp", True),
    ("row_count", "bigint", True), ("target_table", "string", True),
)
_add(
    "schema_contract_check_published",
    "\nUNION ALL ".join(
        [
            _contract_rows("silver_chat_parsed", "par", PARSED_TYPES),
            _contract_rows("chat_dlq", "dlq", DLQ_TYPES),
            _contract_rows("streaming_batch_metrics", "met", METRICS_TYPES),
        ]
    ),
)
_add(
    "schema_contract_check",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS expected_type, '{kind}' AS actual_type, {str(required).lower()} AS is_required, "
        f"count(*) FILTER ({name} IS NULL) AS null_count, {str(required).lower()} AND count(*) FILTER ({name} IS NULL) > 0 AS is_violation FROM cls"
        for name, kind, required in PARSED_TYPES
    ),
)
_add(
    "check_not_null",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS violations FROM cls"
        for name, _kind, _required in PARSED_TYPES
    ),
)
_add(
    "check_unique",
    """SELECT count(*) AS key_count, count(*) FILTER (n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows,
  'appended' AS relation FROM (SELECT event_id, count(*) AS n FROM par GROUP BY ALL)
UNION ALL SELECT count(DISTINCT event_id), 0, 0, 'latest' FROM par""",
)
_add(
    "check_unique_combination",
    """SELECT count(*) AS key_count, count(*) FILTER (n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
FROM (SELECT part, event_id, count(*) AS n FROM v1log GROUP BY ALL)""",
)
_add(
    "check_expression",
    """SELECT unnest(['sent_compound_range', 'sent_pos_range', 'sent_neg_range', 'sent_neu_range', 'message_length_positive']) AS expression,
  unnest([count(*) FILTER (abs(sent_compound) > 1), count(*) FILTER (sent_pos < 0 OR sent_pos > 1),
    count(*) FILTER (sent_neg < 0 OR sent_neg > 1), count(*) FILTER (sent_neu < 0 OR sent_neu > 1),
    count(*) FILTER (message_length <= 0)]) AS violations FROM v1sil""",
)
_add(
    "check_accepted_values",
    """SELECT 'error_category' AS column_name, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'outcome', count(*) FILTER (outcome = 'VALID') FROM cls""",
)

# --- operational analyses ------------------------------------------------------------------

_add(
    "dlq_triage",
    """SELECT _run_id AS run_id, error_category, error_code, count(*) AS dlq_count, count(*) FILTER (retryable) AS retryable_count,
  min(dlq_ingestion_ts) AS first_seen_ts, max(dlq_ingestion_ts) AS last_seen_ts
FROM dlq WHERE dlq_ingestion_ts >= TIMESTAMP '2024-01-10' GROUP BY ALL""",
)
_add(
    "dlq_hotspots",
    """SELECT * , round(dlq_count / CAST(sum(dlq_count) OVER (PARTITION BY run_id) AS DOUBLE), 6) AS share_of_run
FROM (SELECT _run_id AS run_id, source_topic, source_partition, count(*) AS dlq_count, count(DISTINCT source_offset) AS distinct_offsets,
  min(source_offset) AS first_offset, max(source_offset) AS last_offset FROM dlq GROUP BY ALL)""",
)
_add(
    "dlq_vs_batches",
    """SELECT run_id, batch_id, coalesce(reported_dlq_rows, 0) AS reported_dlq_rows, coalesce(reported_valid_rows, 0) AS reported_valid_rows,
  coalesce(dlq_count, 0) AS dlq_count, coalesce(dlq_count, 0) - coalesce(reported_dlq_rows, 0) AS unexplained_rows
FROM (SELECT run_id, batch_id, CAST(sum(row_count) FILTER (target_table LIKE '%chat_dlq') AS BIGINT) AS reported_dlq_rows,
    CAST(sum(row_count) FILTER (target_table LIKE '%silver_chat_parsed') AS BIGINT) AS reported_valid_rows
  FROM met WHERE job_name = 'silver_parse' GROUP BY ALL) m
FULL JOIN (SELECT _run_id AS run_id, _batch_id AS batch_id, count(*) AS dlq_count FROM dlq GROUP BY ALL) d USING (run_id, batch_id)""",
)
_add(
    "latest_batch_by_job",
    """SELECT run_id, job_name, max(batch_processed_ts) AS last_batch_processed_ts, max(batch_id) AS last_batch_id,
  (epoch_us(TIMESTAMP '2024-03-15') - epoch_us(max(batch_processed_ts))) / 1e6 AS age_seconds, age_seconds > 20 * 86400 AS is_stale
FROM met GROUP BY ALL""",
)
_add(
    "row_count_by_job",
    """SELECT run_id, bronze_row_count, valid_event_count, feature_row_count, dlq_row_count_from_sink,
  CASE WHEN bronze_row_count > 0 AND abs(valid_event_count - bronze_row_count) / CAST(bronze_row_count AS DOUBLE) > 0.25 THEN 'silver_parse'
    WHEN valid_event_count > 0 AND abs(feature_row_count - valid_event_count) / CAST(valid_event_count AS DOUBLE) > 0.25 THEN 'silver_features'
    ELSE 'none' END AS anomaly_start_stage FROM summary""",
)
_add(
    "batch_shape",
    """SELECT run_id, job_name, target_table, count(*) AS batch_count, min(row_count) AS min_rows, max(row_count) AS max_rows,
  round(avg(row_count), 6) AS avg_rows, round(quantile_cont(row_count, 0.5), 6) AS p50, round(quantile_cont(row_count, 0.95), 6) AS p95
FROM met GROUP BY ALL""",
)
_add(
    "run_comparison",
    """SELECT measure, round(max(v) FILTER (run_id = 'run_a'), 6) AS run_a, round(max(v) FILTER (run_id = 'run_b'), 6) AS run_b
FROM (UNPIVOT (SELECT run_id, CAST(COLUMNS(* EXCLUDE (run_id)) AS DOUBLE) FROM summary)
  ON COLUMNS(* EXCLUDE (run_id)) INTO NAME measure VALUE v) GROUP BY measure""",
)
_add(
    "run_reconciliation",
    """SELECT 'run_a' AS run_id, b.n AS bronze_rows, b.n - b.k AS repeated_rows, v.n AS valid_rows, f.n AS feature_rows, d.n AS dlq_rows,
  b.k - v.n - d.n AS unaccounted_rows, f.n = v.n AS features_match_valid
FROM (SELECT count(*) AS n, count(DISTINCT (part, event_id)) AS k FROM log) b, (SELECT count(*) AS n FROM good) v,
  (SELECT count(*) AS n FROM fea WHERE _run_id = 'run_a') f, (SELECT count(*) AS n FROM dead) d""",
)
_add(
    "cost_per_million",
    """SELECT run_id, round(batch_count * CAST(0.05 AS DOUBLE), 6) AS total_cost_usd, bronze_row_count,
  round(batch_count * CAST(0.05 AS DOUBLE) / nullif(CAST(bronze_row_count AS DOUBLE), 0) * 1e6, 6) AS cost_per_million_messages_usd,
  round(dlq_rate, 6) AS dlq_rate FROM summary""",
)
_add(
    "metric_long_format",
    """SELECT metric, run_id, label, round(CAST(value AS DOUBLE), 6) AS value FROM (
SELECT 'stream_event_time_to_ingest_lag_seconds' AS metric, run_id, 'bronze' AS label, avg_event_to_ingest_lag_seconds AS value FROM snapshot
UNION ALL SELECT 'stream_bronze_to_silver_latency_seconds', run_id, 'silver', avg_bronze_to_silver_lag_seconds FROM snapshot
UNION ALL SELECT 'stream_records_per_micro_batch', run_id, job_name, avg(records_in_micro_batch) FROM volumes GROUP BY ALL
UNION ALL SELECT 'stream_expected_vs_actual_delta', run_id, job_name, sum(delta_records) FROM volumes GROUP BY ALL
UNION ALL SELECT 'stream_dlq_records_total', run_id, error_code, dlq_count FROM triage
UNION ALL SELECT 'stream_schema_drift_events_total', 'all', drift_kind || ':' || field, records FROM driftsum
UNION ALL SELECT 'pipeline_uptime_proxy_percent', run_id, 'all', uptime_proxy_pct FROM uptime)""",
)
