"""DuckDB oracle SQL for the registered queries (same output column names).

Written independently of the Spark plans: they state the expected answer in
plain SQL over the same parquet tables.
"""

from __future__ import annotations

# Python ``str(datetime)`` text of ``ts``: six fractional digits, or none.
_PY_TS = """CASE WHEN microsecond(ts) % 1000000 = 0
            THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END"""

FIXED = """
SELECT time_bucket(INTERVAL 10 SECOND, ts) AS window_start,
       time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND AS window_end,
       count(*) AS n
FROM events GROUP BY 1, 2
"""

SLIDING = """
SELECT window_start, window_start + INTERVAL 20 SECOND AS window_end, count(*) AS n
FROM (SELECT time_bucket(INTERVAL 10 SECOND, ts) AS window_start FROM events
      UNION ALL
      SELECT time_bucket(INTERVAL 10 SECOND, ts) - INTERVAL 10 SECOND FROM events)
GROUP BY 1, 2
"""

RECORD_JSON = f"""
SELECT event_id,
       to_json({{'event_id': event_id, 'timestamp': {_PY_TS}, 'user_id': user_id,
                'event_type': event_type, 'value': value, 'props': json(props)}})::VARCHAR AS payload
FROM events
"""

QUOTES = r"""
SELECT conv_id, turn, replace(trim(text, '''<>() '), '''', '"') AS text_norm
FROM conversations
"""

ORACLE_SQL: dict[str, str] = {
    "fixed_window_count": FIXED,
    "sliding_window_count": SLIDING,
    "json_array_length":
        "SELECT doc_id, len(string_split(text, ' '))::BIGINT AS n_items FROM documents",
    "json_object_length":
        "SELECT event_id, len(json_keys(props))::BIGINT AS n_keys FROM events",
    "json_object_repeated_keys":
        "SELECT doc_id, (SELECT count(DISTINCT w) FROM (SELECT unnest(string_split(text, ' ')) AS w))::BIGINT AS n_keys FROM documents",
    "json_string_length":
        "SELECT doc_id, length(text)::BIGINT AS text_len FROM documents",
    "global_count": "SELECT count(*) AS n FROM documents HAVING count(*) > 0",
    "global_window_count": "SELECT count(*) AS n FROM documents HAVING count(*) > 0",
    "record_to_json": RECORD_JSON,
    "utf8_encode": "SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes FROM documents",
    "utf8_round_trip": "SELECT doc_id, text FROM documents",
    "iso_parse": f"SELECT event_id, {_PY_TS} AS ts_text, ts FROM events",
    "stamp_jitter": """
SELECT event_id,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds((event_id * 7919) % 20) AS "timestamp"
FROM events""",
    "quote_normalize": QUOTES,
}

_RECORD_TEXT = f"""to_json({{'event_id': event_id, 'timestamp': {_PY_TS}, 'user_id': user_id,
                'event_type': event_type, 'value': value, 'props': json(props)}})::VARCHAR"""

ORACLE_SQL.update({
    "stream_fixed_window": FIXED,
    "stream_sliding_window": SLIDING,
    "stream_sliding_window_slices": SLIDING,
    "stream_count_after_watermark": f"SELECT n::VARCHAR AS value FROM ({FIXED})",
    "stream_count_default_trigger": f"SELECT n::VARCHAR AS value FROM ({FIXED})",
    "stream_passthrough": f"SELECT {_RECORD_TEXT} AS payload FROM events",
    "stream_message_tap": "SELECT ts AS publish_time FROM events",
    "stream_message_tap_data": f"SELECT ts AS publish_time, {_RECORD_TEXT} AS data FROM events",
    "stream_arrival_fixed_window": FIXED,
})


def first_pane_windows_sql(size_s: int, delay_s: int) -> str:
    """Per arrival window, rows that arrived before its first arrival + delay."""
    return f"""
WITH k AS (SELECT time_bucket(INTERVAL {size_s} SECOND, ts) AS window_start, ts FROM events),
     f AS (SELECT window_start, min(ts) AS first_ts FROM k GROUP BY 1)
SELECT k.window_start, k.window_start + INTERVAL {size_s} SECOND AS window_end, count(*) AS n
FROM k JOIN f USING (window_start)
WHERE k.ts < f.first_ts + INTERVAL {delay_s} SECOND
GROUP BY 1, 2
"""


ORACLE_SQL.update({
    "global_pane_once": """
SELECT count(*) AS n FROM events
WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 10 SECOND
HAVING count(*) > 0""",
    "window_pane_once": first_pane_windows_sql(10, 30),
})

ORACLE_SQL["publish_stamped"] = """
SELECT to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'value': value, 'props': json(props),
                'timestamp': strftime(TIMESTAMP '2024-01-01 00:00:00'
                                      + to_seconds((event_id * 7919) % 20), '%Y-%m-%d %H:%M:%S')
               })::VARCHAR AS payload
FROM events
"""

ORACLE_SQL.update({
    "typed_tap": """
SELECT doc_id, len(string_split(text, ' '))::BIGINT AS length,
       'bigint' AS doc_id_type, 'bigint' AS length_type
FROM documents""",
    "text_file_lengths":
        "SELECT len(string_split(text, ' '))::BIGINT AS length FROM documents",
    "text_file_count": "SELECT count(*) AS n FROM documents HAVING count(*) > 0",
    "document_elements": "SELECT conv_id, turn, role, text FROM conversations",
    "document_elements_lines": "SELECT conv_id, turn, role, text FROM conversations",
})

# Processing-time panes over the replay: every message arrives in the first
# micro-batch, before any pane fires, so each first pane holds all its rows.
ORACLE_SQL.update({
    "stream_global_pane": "SELECT count(*) AS n FROM events HAVING count(*) > 0",
    "stream_window_panes": FIXED,
})

# Fifths of the time range in the order 2, 3, 0, 4, 1: fifths 0 and 1 are late.
_FIFTH = """(SELECT *, (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * 5
                       // (SELECT max(epoch_us(ts)) - min(epoch_us(ts)) + 1 FROM events) AS fifth FROM events)"""
_BUCKET = "time_bucket(INTERVAL 10 SECOND, ts)"

ORACLE_SQL.update({
    "window_pane_part": first_pane_windows_sql(3600, 1800),
    "print_tap_lengths": "SELECT doc_id, len(string_split(text, ' '))::BIGINT AS length FROM documents",
    "stream_fan_out": f"""
SELECT 'counts' AS branch, window_start, n, NULL::VARCHAR AS payload
FROM ({FIXED})
UNION ALL
SELECT 'records', NULL, NULL, {_RECORD_TEXT} FROM events""",
    "stream_late_rows": f"""
SELECT {_BUCKET} AS window_start, {_BUCKET} + INTERVAL 10 SECOND AS window_end, count(*) AS n
FROM {_FIFTH} WHERE fifth >= 2 GROUP BY 1, 2""",
    "stream_window_panes_closed": f"""
WITH k AS (SELECT {_BUCKET} AS window_start, event_id % 2 AS half FROM events),
     f AS (SELECT window_start, min(half) AS first_half FROM k GROUP BY 1)
SELECT k.window_start, k.window_start + INTERVAL 10 SECOND AS window_end, count(*) AS n
FROM k JOIN f ON k.window_start = f.window_start AND k.half = f.first_half GROUP BY 1, 2""",
    "stream_global_pane_closed": "SELECT count(*) AS n FROM events WHERE event_id % 2 = 0 HAVING count(*) > 0",
})

# Publish time is ``ts``, a fifth of its range a micro-batch; the payload's time lies 0 to 19 hundredths of the range
# before it.  A row is late if its window ends by the last publish time of the fifths before.
_DELAYED = f"""
WITH span AS (SELECT max(epoch_us(ts)) - min(epoch_us(ts)) AS us FROM events),
     sent AS (SELECT *, make_timestamp(epoch_us(ts) - (event_id * 7919) % 20 * ((SELECT us FROM span) // 100)) AS named FROM {_FIFTH}),
     marks AS (SELECT a.fifth, max(b.ts) AS mark FROM (SELECT DISTINCT fifth FROM sent) a JOIN sent b ON b.fifth < a.fifth GROUP BY 1),
     held AS (SELECT sent.*, time_bucket(INTERVAL 10 SECOND, named) AS window_start,
                     coalesce(time_bucket(INTERVAL 10 SECOND, named) + INTERVAL 10 SECOND <= mark, false) AS late
              FROM sent LEFT JOIN marks ON sent.fifth = marks.fifth)"""
_NAMED_TEXT = _PY_TS.replace("(ts)", "(named)").replace("(ts,", "(named,")

ORACLE_SQL["stream_publish_watermark"] = f"""
{_DELAYED}
SELECT 'count' AS kind, window_start, count(*) AS n, NULL::VARCHAR AS payload, NULL::TIMESTAMP AS publish_time
FROM held WHERE NOT late GROUP BY window_start
UNION ALL
SELECT 'late', window_start, 1, to_json({{'event_id': event_id, 'timestamp': {_NAMED_TEXT}}})::VARCHAR, ts FROM held WHERE late
"""

ORACLE_SQL["stream_one_read"] = f"""
WITH sent AS (SELECT ts, fifth, event_id % 10 = 3 AS broken, {_RECORD_TEXT} AS payload FROM {_FIFTH})
SELECT 'counts' AS branch, {_BUCKET} AS window_start, count(*) AS n, NULL::VARCHAR AS payload
FROM sent WHERE NOT broken AND fifth >= 2 GROUP BY 2
UNION ALL
SELECT 'records', NULL, NULL, payload FROM sent WHERE NOT broken
UNION ALL
SELECT 'rejects', NULL, NULL, left(payload, length(payload) - 1) FROM sent WHERE broken
UNION ALL
SELECT 'late', {_BUCKET}, NULL, payload FROM sent WHERE NOT broken AND fifth < 2
"""

ORACLE_SQL["document_elements_ranges"] = r"""
SELECT conv_id, turn, role, '[{"' || text || '\\"}],\' AS text FROM conversations
"""

ORACLE_SQL["sliding_day_count"] = f"""
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, CAST(sum(c) AS BIGINT) AS n
FROM (SELECT slot - to_seconds(10 * unnest(range(8640))) AS window_start, c
      FROM (SELECT {_BUCKET} AS slot, count(*) AS c FROM events GROUP BY 1) AS slices(slot, c))
GROUP BY 1
"""

_TOP = "array_to_string(list_slice(list(event_id ORDER BY event_id DESC), 1, 3), ',')"

ORACLE_SQL.update({
    "user_combiner": f"""
SELECT event_type, count(*) AS n, count(*) FILTER (value > 100) AS over, {_TOP} AS top FROM events GROUP BY event_type
UNION ALL
SELECT 'all', count(*), count(*) FILTER (value > 100), {_TOP} FROM events HAVING count(*) > 0""",
    "generated_elements": """
SELECT doc_id, CAST(unnest(range(len(string_split(text, ' ')))) AS INTEGER) AS pos, unnest(string_split(text, ' ')) AS element FROM documents""",
    "stream_pane_state": f"""
SELECT 'open, first batch' AS state, window_start, n FROM ({FIXED})
UNION ALL
SELECT 'fired, at the end', window_start, NULL FROM ({FIXED})""",
    "stream_run_metrics": """
SELECT 'rows read' AS metric, count(*) AS total FROM events
UNION ALL SELECT 'rows dropped', 0
UNION ALL SELECT 'events.n', count(*) FROM events
UNION ALL SELECT 'events.errors', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'events.last', CAST(coalesce(sum(event_id), 0) AS BIGINT) FROM events""",
})

ORACLE_SQL["stream_messages_once"] = ORACLE_SQL["stream_passthrough"]
