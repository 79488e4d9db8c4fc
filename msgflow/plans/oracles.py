"""The registered queries in SQL, for comparison."""

from __future__ import annotations

_LOG = """
log AS (
  SELECT event_id, event_type, user_id, ts, props AS content, epoch_us(ts) AS us,
         'events.' || event_type || '.' || user_id AS subject,
         'EV-' || (user_id % 4) AS stream,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS streamSeq,
         count(*) OVER (PARTITION BY user_id % 4) AS head,
         CASE WHEN event_id % 5 <> 0 THEN event_type || ',' || user_id END AS header_type,
         CASE WHEN event_id % 5 <> 0 THEN event_id::VARCHAR END AS header_id
  FROM events)
"""

_ENVELOPE = """
envelope AS (
  SELECT *, 1 + streamSeq % 3 AS delivered, streamSeq AS consumerSeq, head - streamSeq AS pending,
         us // 1000 * 1000 AS timestamp_us,
         '$JS.ACK.dom.acct.' || stream || '.cons.' || (1 + streamSeq % 3) || '.' || streamSeq || '.' || streamSeq
           || '.' || (us * 1000) || '.' || (head - streamSeq) AS replyTo,
         strftime(make_timestamp(us // 1000 * 1000), '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
         strftime(ts, '%m/%d/%Y - %H:%M:%S') || ' +0000' AS received,
         CASE WHEN event_id % 5 <> 0
              THEN '{ "type": "' || event_type || ',' || user_id || '", "id": "' || event_id || '" }' END AS headers_json
  FROM log),
meta AS (
  SELECT *, '{"jsMetaData": {"stream" : "' || stream || '", "streamSeq" :  ' || streamSeq || ', "consumerSeq" : '
    || consumerSeq || ', "delivered" : ' || delivered || ', "pending" : ' || pending || ', "timestamp" : "' || iso
    || '"}}' AS meta_json
  FROM envelope)
"""

_DELIVERY = """
deliveries AS (
  SELECT 'cons' AS consumer, stream, streamSeq, a AS attempt, us + (a - 1) * 90000000 AS delivered_us
  FROM (SELECT *, unnest(generate_series(1, 1 + streamSeq % 3)) AS a FROM log)),
acks AS (
  SELECT 'cons' AS consumer, stream, streamSeq,
         CASE WHEN streamSeq % 17 = 0 THEN epoch_us(TIMESTAMP '2024-01-21 12:00:00')
              WHEN streamSeq % 13 = 0 THEN us + 1000000
              ELSE us + (streamSeq % 3) * 90000000 + (streamSeq % 7) * 20000000 END AS acked_us
  FROM log WHERE streamSeq % 11 <> 0)
"""

_NOW = "epoch_us(TIMESTAMP '2024-01-20 12:00:00')"


def _log(sql: str) -> str:
    return f"WITH {_LOG} {sql}"


def _env(sql: str) -> str:
    return f"WITH {_LOG}, {_ENVELOPE} {sql}"


def _del(sql: str) -> str:
    return f"WITH {_LOG}, {_DELIVERY} {sql}"


_PULLED = """
SELECT streamSeq % 2 AS listener, stream, streamSeq, content,
       row_number() OVER (PARTITION BY streamSeq % 2 ORDER BY streamSeq, stream) AS r
FROM log
"""

_DOC_ASCII = (
    "regexp_replace(regexp_replace(regexp_replace(text, '[\\x{10000}-\\x{10FFFF}]', chr(1)||chr(1)||chr(1)||chr(1), 'g'),"
    " '[\\x{800}-\\x{FFFF}]', chr(1)||chr(1)||chr(1), 'g'), '[\\x{80}-\\x{7FF}]', chr(1)||chr(1), 'g')"
)

_ALL_ONCE = "SELECT stream, streamSeq FROM log"

_ONE = (
    "SELECT {columns} FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS streamSeq,"
    " count(*) OVER () AS total FROM events)"
)

ORACLES = {
    "relay_rewrite": _log(
        "SELECT 'done.' || subject AS subject, content AS data, header_type FROM log WHERE event_type = 'purchase'"
    ),
    "relay_partition_subject": _log(
        "SELECT stream, streamSeq, 'subject.' || (user_id % 4) AS subject, 'done.' || (user_id % 4) AS relayed FROM log"
    ),
    "envelope_full": _env(
        "SELECT subject, replyTo, content, header_type, header_id, 'dom' AS domain, stream, 'cons' AS consumer,"
        " delivered, streamSeq, consumerSeq, timestamp_us, pending FROM envelope"
    ),
    "reply_metadata": _env(
        "SELECT replyTo, split_part(replyTo, '.', 3) AS domain, split_part(replyTo, '.', 5) AS stream,"
        " split_part(replyTo, '.', 6) AS consumer, split_part(replyTo, '.', 7)::BIGINT AS delivered,"
        " split_part(replyTo, '.', 8)::BIGINT AS streamSeq, split_part(replyTo, '.', 9)::BIGINT AS consumerSeq,"
        " split_part(replyTo, '.', 10)::BIGINT // 1000000 * 1000 AS timestamp_us,"
        " split_part(replyTo, '.', 11)::BIGINT AS pending FROM envelope"
    ),
    "envelope_text5": _env(
        "SELECT subject, received AS dateTime, content, headers_json AS headers, meta_json AS jsMetadata FROM meta"
    ),
    "envelope_text3": _env("SELECT subject, iso AS dateTime, content FROM envelope"),
    "headers_map": (
        "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN 'type,id' END AS names,"
        " CASE WHEN event_id % 5 <> 0 THEN event_type || ',' || user_id END AS header_type,"
        " CASE WHEN event_id % 5 <> 0 THEN event_id::VARCHAR END AS header_id, event_id % 5 = 0 AS absent FROM events"
    ),
    "headers_json": _env("SELECT stream, streamSeq, headers_json AS headers FROM envelope"),
    "meta_json": _env("SELECT stream, streamSeq, meta_json AS metadata FROM meta"),
    "message_json": _env(
        "SELECT stream, streamSeq, '{\"subject\": \"' || subject || '\", \"Datetime\": \"' || received"
        " || '\", \"payload\": \"' || replace(content, '\"', '\\\"') || '\", \"headers\": '"
        " || coalesce(headers_json, 'null') || ', \"js-metadata\": ' || meta_json || '}' AS message FROM meta"
    ),
    "time_formats": _env(
        "SELECT stream, streamSeq, received, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, timestamp_us AS event_us"
        " FROM envelope"
    ),
    "text_codecs": (
        f"SELECT doc_id, text AS utf8, replace({_DOC_ASCII}, chr(1), chr(65533)) AS ascii_read,"
        " regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') AS ascii_written FROM documents"
    ),
    "origin_header": _log(
        "SELECT stream, streamSeq, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 3 END::BIGINT AS n_headers,"
        " strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS origin, header_type FROM log"
    ),
    "legacy_sink": _env(
        "SELECT subject, content AS data, received AS origin, NULL::VARCHAR AS header_type FROM envelope"
    ),
    "constant_columns": _log("SELECT 'out.all' AS subject, 'payload' AS data, header_id FROM log"),
    "subject_exact": _log(
        "SELECT subject, stream, streamSeq FROM log WHERE subject IN ('events.click.1', 'events.view.2', 'events.error.3')"
    ),
    "subject_wildcard": _log(
        "SELECT subject, stream, streamSeq FROM log"
        " WHERE regexp_full_match(subject, 'events\\.[^.]+\\.7') OR regexp_full_match(subject, 'events\\.purchase\\..+')"
    ),
    "subject_patterns_join": _log(
        "SELECT subject, stream, streamSeq, unnest(['events.*.' || user_id, 'events.' || event_type || '.>', 'events.>'])"
        " AS pattern FROM log"
    ),
    "stream_selection": _log(
        "SELECT 'name' AS how, stream, streamSeq FROM log WHERE stream IN ('EV-1', 'EV-3')"
        " UNION ALL SELECT 'prefix', stream, streamSeq FROM log"
    ),
    "non_null_messages": _log("SELECT stream, streamSeq, header_id AS msg_id FROM log WHERE header_id IS NOT NULL"),
    "route_partitions": (
        "SELECT event_id, 'app.' || (user_id % 4) || '.log' AS subject, 'PART-' || (user_id % 4) AS stream,"
        " (user_id % 4)::INTEGER AS partition, 'log' AS tail FROM events"
    ),
    "fanout_subjects": _log(
        "SELECT unnest(['subject1', 'subject2', 'subject3']) AS subject, stream, streamSeq, content FROM log"
    ),
    "stream_guard": _log(
        "SELECT subject, stream, streamSeq FROM log WHERE event_type NOT IN ('purchase', 'view')"
    ),
    "latest_offsets": _log("SELECT stream, max(streamSeq) AS last_seq FROM log GROUP BY stream"),
    "range_scan": _log(
        "SELECT stream, streamSeq, subject, content FROM log WHERE (stream = 'EV-0' AND streamSeq > 30 AND streamSeq <= 60)"
        " OR (stream = 'EV-1' AND streamSeq <= 45) OR (stream = 'EV-2' AND streamSeq > 100)"
    ),
    "clamped_range": _log(
        "SELECT stream, streamSeq, subject FROM log WHERE streamSeq <= least(head,"
        " CASE stream WHEN 'EV-0' THEN 1000000000000 WHEN 'EV-1' THEN 77 WHEN 'EV-3' THEN 1000000000 ELSE 0 END)"
    ),
    "reset_start": _log(
        "SELECT s.start, stream, streamSeq FROM log, (VALUES ('first', 0), ('resume', 1), ('reset', 0), ('after_reset', 1))"
        " s(start, used) WHERE streamSeq > s.used * CASE stream WHEN 'EV-0' THEN 20 WHEN 'EV-1' THEN 21"
        " WHEN 'EV-2' THEN 22 ELSE 23 END"
    ),
    "batch_slices": _log(
        "SELECT stream, (streamSeq - o - 1) // 64 AS slice, count(*) AS n, min(streamSeq) AS lo, max(streamSeq) AS hi"
        " FROM (SELECT *, CASE stream WHEN 'EV-0' THEN 17 WHEN 'EV-2' THEN 5 ELSE 0 END AS o FROM log)"
        " WHERE streamSeq > o GROUP BY ALL"
    ),
    "listener_shares": _log("SELECT streamSeq % 3 AS listener, stream, streamSeq FROM log"),
    "next_fetch": _log(
        "SELECT stream, streamSeq, subject FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY streamSeq) AS r"
        " FROM log WHERE streamSeq > CASE stream WHEN 'EV-0' THEN 10 WHEN 'EV-2' THEN 33 ELSE 0 END) WHERE r <= 40"
    ),
    "pending": _del("SELECT stream, streamSeq, subject FROM log ANTI JOIN acks USING (stream, streamSeq)"),
    "pending_counts": _del(
        "SELECT stream, count(*) AS pending FROM log ANTI JOIN acks USING (stream, streamSeq) GROUP BY stream"
    ),
    "ack_floor": _del(
        "SELECT stream, min(streamSeq) - 1 AS ack_floor FROM log ANTI JOIN acks USING (stream, streamSeq) GROUP BY stream"
    ),
    "consumer_lag": _log(
        "SELECT stream, head - head // 10 AS ack_floor, head, head // 10 AS lag FROM log GROUP BY stream, head"
    ),
    "delivery_counts": _del(
        "SELECT consumer, stream, streamSeq, count(*) AS delivered FROM deliveries GROUP BY ALL"
    ),
    "repeated_messages": _del(
        "SELECT stream, streamSeq, count(*) AS seen FROM deliveries GROUP BY ALL HAVING count(*) > 1"
    ),
    "distinct_messages": _del("SELECT DISTINCT stream, streamSeq FROM deliveries"),
    "redelivery_due": _del(
        "SELECT consumer, stream, streamSeq, max(delivered_us) AS delivered_at_us, count(*) AS attempts FROM deliveries d"
        f" WHERE delivered_us <= {_NOW} AND NOT EXISTS (SELECT 1 FROM acks a WHERE a.consumer = d.consumer"
        f" AND a.stream = d.stream AND a.streamSeq = d.streamSeq AND a.acked_us <= {_NOW})"
        f" GROUP BY ALL HAVING max(delivered_us) + 90000000 <= {_NOW}"
    ),
    "inflight_capped": _del(
        "SELECT stream, streamSeq, subject FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY streamSeq) AS r"
        " FROM log ANTI JOIN acks USING (stream, streamSeq)) WHERE r <= 12"
    ),
    "idle_gaps": _log(
        "SELECT stream, streamSeq, gap_us FROM (SELECT *, us - lag(us) OVER (PARTITION BY stream ORDER BY streamSeq)"
        " AS gap_us FROM log) WHERE gap_us > 1800000000"
    ),
    "pull_batch": _log(
        "SELECT listener, stream, streamSeq, 1::BIGINT AS attempt, content FROM"
        f" ({_PULLED}) WHERE r > 60 AND r <= 120"
    ),
    "pull_fair": _log(
        "SELECT 1::INTEGER AS pull, stream, streamSeq FROM log WHERE stream = 'EV-0' AND streamSeq <= 10 UNION ALL"
        " SELECT CAST(2 + (row_number() OVER (ORDER BY streamSeq, stream) - 1) // 10 AS INTEGER), stream, streamSeq FROM log"
        " WHERE stream <> 'EV-0' AND streamSeq > head // 2 AND streamSeq <= head // 2 + 10"
    ),
    "subject_search": _log(
        "SELECT stream, streamSeq, subject FROM log WHERE subject IN ('events.click.11', 'events.view.7', 'events.none.0')"
    ),
    "commit_batch": _log(
        f"SELECT stream, streamSeq, {_NOW} AS acked_at_us, count(*) OVER () AS committed, 0::BIGINT AS unknown"
        f" FROM ({_PULLED}) WHERE r <= 60"
    ),
    "no_ack": _log(
        f"SELECT listener, stream, streamSeq, 0::BIGINT AS committed FROM ({_PULLED}) WHERE r > 60 AND r <= 120"
    ),
    "inflate_strict": "SELECT doc_id, text FROM documents",
    "inflate_lenient": "SELECT doc_id, text, doc_id % 10 <> 0 AS decoded_ok FROM documents",
    "codec_none": "SELECT doc_id, text FROM documents",
    "sink_sequence": _log(
        "SELECT stream, row_number() OVER (PARTITION BY stream ORDER BY"
        " CASE WHEN event_type IN ('purchase', 'view') THEN 0 ELSE 1 END, event_id) AS streamSeq,"
        " subject, content, us AS timestamp_us FROM log"
    ),
    "publish_batch": _log(
        "SELECT 'OUT' AS stream, subject, content, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS origin,"
        " count(*) OVER () AS total FROM log"
    ),
    "publish_texts": (
        "SELECT 'CHAT' AS stream, 'chat.text' AS subject, text AS content, 0::BIGINT AS n_headers FROM conversations"
    ),
    "stream_replay": _env("SELECT subject, stream, streamSeq, content, pending, timestamp_us FROM envelope"),
    "stream_listeners": _log("SELECT stream, streamSeq, 1::BIGINT AS takers, 3::BIGINT AS listeners FROM log"),
    "stream_consumer_default": _log("SELECT stream, streamSeq, head AS ack_floor FROM log"),
    "stream_consumer_filtered": _ONE.format(columns="streamSeq, total AS ack_floor") + " WHERE 2 * event_id >= total",
    "stream_empty_batch": _log(
        "SELECT stream, streamSeq, 2::BIGINT AS runs FROM log"
    ),
    "stream_bind": _log("SELECT stream, streamSeq FROM log WHERE event_type = 'click'"),
    "stream_processing_time": _log(_ALL_ONCE),
    "format_table_scan": _log("SELECT stream, streamSeq, subject, content, head - streamSeq AS pending FROM log"),
    "publish_routed": (
        "WITH r AS (SELECT *, CASE WHEN user_id % 4 <> 1 THEN 'PART-' || (user_id % 4) END AS stream FROM events)"
        " SELECT stream, row_number() OVER (PARTITION BY stream ORDER BY event_id) AS streamSeq, props AS content,"
        " (SELECT count(*) FROM r WHERE stream IS NULL) AS unroutable FROM r WHERE stream IS NOT NULL"
    ),
    "stream_filtered": _log(
        "SELECT subject, stream, streamSeq FROM log WHERE event_type = 'purchase' OR user_id = 7"
    ),
    "stream_text5": _env(
        "SELECT subject, received AS dateTime, content, headers_json AS headers,"
        " regexp_replace(meta_json, '\"delivered\" : [0-9]+', '\"delivered\" : 1') AS jsMetadata FROM meta"
    ),
    "stream_text3": _env("SELECT subject, iso AS dateTime, content FROM envelope"),
    "stream_inflate": "SELECT 'doc.' || doc_id AS subject, text FROM documents",
    "stream_resume": _log(
        "SELECT stream, row_number() OVER (PARTITION BY stream ORDER BY"
        " CASE WHEN event_type IN ('purchase', 'view') THEN 0 ELSE 1 END, event_id) AS streamSeq, subject FROM log"
    ),
    "stream_durable": _log("SELECT 'done.' || subject AS subject, content FROM log"),
    "stream_reset": _log(
        "SELECT stream, streamSeq, CASE WHEN streamSeq <= count(*) FILTER (event_type IN ('purchase', 'view'))"
        " OVER (PARTITION BY stream) THEN 2 ELSE 1 END::BIGINT AS seen FROM log"
    ),
    "stream_relay": _log("SELECT 'DONE' AS stream, 'done.' || subject AS subject, content, header_type FROM log"),
    "stream_sink": (
        "SELECT 'COPY' AS stream, row_number() OVER (ORDER BY event_id) AS streamSeq FROM events WHERE event_type = 'click'"
    ),
    "stream_acks": _log("SELECT stream, count(*) AS acked, max(streamSeq) AS ack_floor FROM log GROUP BY stream"),
    "stream_watermark": _log(
        "SELECT start_us, key, count(*) AS messages FROM"
        " (SELECT us - us % 21600000000 AS start_us, event_type AS key FROM log)"
        " WHERE start_us + 21600000000 <= (SELECT max(us) // 1000 * 1000 - 60000000 FROM log) GROUP BY ALL"
    ),
    "stream_dedupe": _log(_ALL_ONCE),
    "stream_bounded": _log("SELECT stream, streamSeq, 1::BIGINT AS seen, true AS within, 7::BIGINT AS batches FROM log"),
    "stream_redelivery": _del(
        "SELECT stream, streamSeq, attempt, delivered_us FROM (SELECT stream, streamSeq, attempt, delivered_us FROM deliveries"
        " UNION ALL SELECT stream, streamSeq, 9::BIGINT, us + 40 * 86400000000 FROM log WHERE streamSeq % 19 = 0) d"
        " WHERE NOT EXISTS (SELECT 1 FROM acks a WHERE a.stream = d.stream AND a.streamSeq = d.streamSeq"
        " AND a.acked_us <= d.delivered_us + 90000000)"
    ),
    "stream_resend": _del(
        "SELECT stream, streamSeq, k + 1 AS attempt, us + k * 90000000 AS delivered_us"
        " FROM log, generate_series(1, 4) g(k) WHERE NOT EXISTS (SELECT 1 FROM acks a WHERE a.stream = log.stream"
        " AND a.streamSeq = log.streamSeq AND a.acked_us <= us + k * 90000000)"
    ),
}
