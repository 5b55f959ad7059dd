"""The queries of ``plans.queries`` as plain SQL over the given tables."""

from __future__ import annotations

from logfreight.model import PackOptions
from logfreight.plans.queries import (
    DOCUMENT_PACKS,
    EVENT_PACKS,
    HOUR_MS,
    LIST_PACKS,
    MAX_GROUP_LOGS,
    MAX_REQUEST_BYTES,
    MAX_VALUE_BYTES,
    NOW_MS,
    RETRIES,
    TAGS,
)
from logfreight.plans.sample_tables import LIST_TURNS

ORACLES: dict[str, str] = {}
ID_FIELD = 43


def vint(x: str) -> str:
    return f"((length(bin(({x})::BIGINT)) + 6) // 7)"


def field(n: str) -> str:
    return f"(1 + {vint(n)} + ({n}))"


def text_field(t: str) -> str:
    return f"(CASE WHEN {t} IS NULL THEN 0 ELSE {field(f'strlen({t})')} END)"


def pair_size(key: str, value: str) -> str:
    return f"({text_field(key)} + {text_field(value)})"


def optional_pair(key: str, value: str) -> str:
    return f"(CASE WHEN {value} IS NULL THEN 0 ELSE {field(pair_size(key, value))} END)"


def accounting(*pairs: tuple[str, str]) -> str:
    terms = [
        f"(CASE WHEN {v} IS NULL THEN 0 ELSE strlen({k}) + strlen({v}) END)" for k, v in pairs
    ]
    return f"(4 + {' + '.join(terms)})"


def wire(time: str, *pairs: tuple[str, str]) -> str:
    return f"(1 + {vint(time)} + {' + '.join(optional_pair(k, v) for k, v in pairs)})"


def package_id(topic: str, seq: str, run_secs: int = 0) -> str:
    return named_id(topic, f"lpad(to_hex({seq}), 16, '0')", run_secs)


def named_id(topic: str, counter: str, run_secs: int = 0) -> str:
    name = f"'4:main' || {topic}"
    return f"upper(substr(md5({name}), 1, 16) || '{run_secs:08x}' || '-' || {counter})"


def name_in_id(*parts: str) -> str:
    return f"substr(md5(concat_ws('/', {', '.join(parts)})), 1, 16)"


EVENT_PAIRS = (("'user_id'", "user_id::VARCHAR"), ("'props'", "props"))
DOCUMENT_PAIRS = (("'text'", "text"), ("'source'", "source"))
PAGE_PAIRS = (("'url'", "url"), ("'html'", "html"))
TEXT_PAIRS = (("'role'", "role"), ("'text'", "text"))

EVENTS = f"""e AS (
  SELECT event_type AS topic_id, event_id AS seq, epoch_us(ts) // 1000 AS arrival_ms,
         epoch_us(ts) // 1000000 AS time, user_id::VARCHAR AS user_id, props,
         {accounting(*EVENT_PAIRS)} AS size_bytes,
         {wire("epoch_us(ts) // 1000000", *EVENT_PAIRS)} AS log_bytes
  FROM events)"""
DOCUMENTS = f"""d AS (
  SELECT lang AS topic_id, doc_id AS seq, doc_id * 100 AS arrival_ms, doc_id AS time,
         text, source, {accounting(*DOCUMENT_PAIRS)} AS size_bytes,
         {wire("doc_id", *DOCUMENT_PAIRS)} AS log_bytes,
         doc_id // 50 AS request_no, (doc_id // 10) % 5 AS group_no
  FROM documents)"""


def packing(source: str, limits: PackOptions, n_logs: str = "1", inside: str | None = None) -> str:
    """CTEs ``labels`` (per row) and ``packages``, packing the rows of ``source`` by a walk."""
    inside = inside or field("log_bytes")
    metadata = ID_FIELD + sum(
        2 + len(t.encode()) for t in (limits.source, limits.hostname)
    )
    opens_by_time = f"n.arrival_ms >= w.create_ms + {limits.linger_ms}"
    count_ok = f"w.held + 1 <= {limits.max_logs}"
    total = "w.total + n.size_bytes"
    joins = f"{total} <= {limits.max_bytes} AND {count_ok}"
    joins_last = f"{total} > {limits.max_bytes} AND {total} < {limits.cap_bytes} AND {count_ok}"
    stays = f"NOT w.closed AND NOT ({opens_by_time}) AND (({joins}) OR ({joins_last}))"
    return f"""
numbered AS (
  SELECT topic_id, seq, arrival_ms, size_bytes::BIGINT AS size_bytes, ({n_logs})::BIGINT AS n_logs,
         ({inside})::BIGINT AS inside,
         row_number() OVER (PARTITION BY topic_id ORDER BY arrival_ms, seq) AS rn
  FROM {source}),
walk AS (
  SELECT topic_id, seq, arrival_ms, size_bytes, n_logs, inside, rn,
         1::BIGINT AS package_seq, arrival_ms AS create_ms, inside + {metadata} AS total,
         n_logs AS held, false AS closed, NULL::VARCHAR AS cause
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.topic_id, n.seq, n.arrival_ms, n.size_bytes, n.n_logs, n.inside, n.rn,
         CASE WHEN {stays} THEN w.package_seq ELSE w.package_seq + 1 END,
         CASE WHEN {stays} THEN w.create_ms ELSE n.arrival_ms END,
         CASE WHEN {stays} THEN {total} ELSE n.inside + {metadata} END,
         CASE WHEN {stays} THEN w.held + n.n_logs ELSE n.n_logs END,
         {stays} AND ({joins_last}),
         CASE WHEN {stays} OR w.closed THEN NULL
              WHEN {opens_by_time} THEN 'linger'
              WHEN NOT ({count_ok}) THEN 'count' ELSE 'overflow' END
  FROM walk w JOIN numbered n ON n.topic_id = w.topic_id AND n.rn = w.rn + 1),
packages AS (
  SELECT p.topic_id, p.package_seq, p.create_ms, p.n_logs, p.size_bytes, p.wire_bytes,
         CASE WHEN p.closed THEN 'size' ELSE coalesce(o.cause, 'flush') END AS close_reason,
         CASE WHEN p.closed OR o.cause IS NULL THEN p.last_ms
              WHEN o.cause = 'linger' THEN p.create_ms + {limits.linger_ms}
              ELSE o.arrival_ms END AS close_ms
  FROM (SELECT topic_id, package_seq, min(create_ms) AS create_ms, bool_or(closed) AS closed,
               max(arrival_ms) AS last_ms, sum(n_logs)::BIGINT AS n_logs,
               sum(size_bytes)::BIGINT AS size_bytes,
               (sum(inside) + {metadata})::BIGINT AS wire_bytes
        FROM walk GROUP BY ALL) p
  LEFT JOIN walk o ON o.topic_id = p.topic_id AND o.package_seq = p.package_seq + 1
                  AND o.create_ms = o.arrival_ms AND o.cause IS NOT NULL),
labels AS (
  SELECT w.topic_id, w.seq, w.arrival_ms, w.package_seq, p.create_ms, p.close_ms, p.close_reason
  FROM walk w JOIN packages p USING (topic_id, package_seq))"""


def with_packing(source_cte: str, source: str, limits: PackOptions, select: str, **how: str) -> str:
    return f"WITH RECURSIVE {source_cte}, {packing(source, limits, **how)}\n{select}"


def event_packing(select: str) -> str:
    return with_packing(EVENTS, "e", EVENT_PACKS, select)


def document_packing(select: str) -> str:
    return with_packing(DOCUMENTS, "d", DOCUMENT_PACKS, select)


REQUEST_BYTES = field("wire_bytes")

ATTEMPTS = """a0 AS (
  SELECT event_id, event_type AS topic_id, epoch_us(ts) // 1000 AS first_ms,
         unnest(range(1, 2 + event_id % 12)) AS k FROM events),
a1 AS (
  SELECT *, [200, 429, 500, 401, 404, 413, 400, 403, -1, 302][(event_id * 7 + k) % 10 + 1] AS http_code
  FROM a0),
a2 AS (
  SELECT *, coalesce(max(CASE WHEN http_code IN (200, 401, 404, 413) THEN 1 ELSE 0 END) OVER (
           PARTITION BY event_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over
  FROM a1),
a AS (
  SELECT event_id::VARCHAR AS package_id, event_id, topic_id, k::INTEGER AS attempt_no, http_code,
         first_ms + k * 1000 AS ts_ms,
         CASE event_id % 3 WHEN 0 THEN 'Denied' WHEN 1 THEN 'Partial' ELSE 'BadRequest' END AS body_code,
         CASE event_id % 3 WHEN 0 THEN 'not allowed' WHEN 1 THEN '' ELSE 'bad request' END AS body_message,
         CASE event_id % 3 WHEN 0 THEN '{"errorcode": "Denied", "errormessage": "not allowed"}'
              WHEN 1 THEN '{"errorcode": "Partial"}' ELSE 'oops' END AS body
  FROM a2 WHERE over = 0),
c AS (
  SELECT package_id, event_id, topic_id, attempt_no, ts_ms, http_code = 200 AS success,
         CASE WHEN http_code = 200 THEN 'success' WHEN http_code IN (401, 404, 413) THEN 'terminal'
              ELSE 'retry' END AS outcome,
         CASE WHEN http_code = 200 THEN '' WHEN http_code IN (400, 401, 403, 404, 413) THEN body_code
              WHEN http_code = -1 THEN 'BadRequest' WHEN http_code = 429 THEN 'WriteQuotaExceed'
              WHEN http_code >= 500 THEN 'InternalError' ELSE 'UnknownError' END AS error_code,
         CASE WHEN http_code = 200 THEN '' WHEN http_code IN (400, 401, 403, 404, 413) THEN body_message
              WHEN http_code = -1 THEN body WHEN http_code = 429 THEN 'write quota exceed'
              WHEN http_code >= 500 THEN 'server internal error' ELSE 'unknown error' END AS error_message,
         CASE WHEN http_code = 200 THEN '' ELSE 'req-' || package_id || '-' || attempt_no END AS request_id
  FROM a)"""
RESULTS = f"""{ATTEMPTS},
r AS (
  SELECT package_id, arg_max(success, attempt_no) AS successful,
         arg_max(error_code, attempt_no) AS error_code,
         arg_max(error_message, attempt_no) AS error_message,
         arg_max(request_id, attempt_no) AS request_id, max(ts_ms) AS ts_ms,
         count(*) FILTER (NOT success) AS failures, bool_or(outcome = 'terminal') AS terminal
  FROM c GROUP BY package_id),
s AS (
  SELECT *, CASE WHEN successful THEN 'success' WHEN terminal OR failures > {RETRIES.retries} THEN 'failed'
                 ELSE 'retrying' END AS state FROM r),
q AS (
  SELECT package_id, failures, ts_ms,
         least({RETRIES.backoff_ms} * pow(2, failures - 1), {RETRIES.max_backoff_ms})::BIGINT AS wait_ms
  FROM s WHERE state = 'retrying')"""

ORACLES["logs_from_columns"] = f"""WITH {EVENTS}
SELECT topic_id, 'main' AS producer, seq, arrival_ms, time,
       ((user_id IS NOT NULL)::INTEGER + (props IS NOT NULL)::INTEGER) AS n_contents,
       'user_id' AS first_key, user_id AS first_value, props AS second_value FROM e"""
ORACLES["logs_from_map"] = """
SELECT lang AS topic_id, doc_id AS seq, 0 AS position, 'chars' AS key, n_chars::VARCHAR AS value FROM documents
UNION ALL SELECT lang, doc_id, 1, 'lang', lang FROM documents
UNION ALL SELECT lang, doc_id, 2, 'source', source FROM documents"""
ORACLES["read_payloads"] = document_packing(
    f"""SELECT d.seq AS doc_id, md5(d.text) AS text_md5, d.source, (-1)::BIGINT AS collect_time,
       '' AS _corrupt, {package_id("l.topic_id", "l.package_seq")} AS package_id
FROM labels l JOIN d ON d.seq = l.seq"""
)
ORACLES["contents_long"] = f"""WITH {EVENTS}
SELECT topic_id, seq, 0 AS position, 'user_id' AS key, user_id AS value FROM e
UNION ALL SELECT topic_id, seq, 1, 'props', props FROM e"""
ORACLES["contents_wide"] = f"""WITH {EVENTS}
SELECT topic_id, seq, props, user_id, 'none' AS absent FROM e"""
_read_back = f"""SELECT {package_id("p.topic_id", "p.package_seq")} AS package_id, p.topic_id,
       {{codec}} AS compress_type, {REQUEST_BYTES} AS raw_bytes, t.texts_md5{{more}}
FROM packages p JOIN (
  SELECT l.topic_id, l.package_seq, md5(string_agg(md5(d.text), ',' ORDER BY d.arrival_ms, d.seq)) AS texts_md5
  FROM labels l JOIN d ON d.seq = l.seq GROUP BY ALL) t USING (topic_id, package_seq)"""
ORACLES["encode_packages"] = document_packing(
    _read_back.format(codec="codec", more="")
    + ", (VALUES ('none'), ('lz4'), ('zstd'), ('deflate')) AS kinds(codec)"
)
ORACLES["write_outbox"] = document_packing(
    _read_back.format(codec="'deflate'", more=", 7::BIGINT AS batch_id")
)
ORACLES["without_resent"] = ORACLES["read_payloads"]
ORACLES["outbox_source"] = ORACLES["write_outbox"]
SENT = f"""sent AS (
  SELECT {package_id("topic_id", "package_seq")} AS package_id, topic_id, {REQUEST_BYTES} AS raw_bytes,
         CASE WHEN topic_id = 'es' THEN -1
              ELSE [200, 429, 413][{REQUEST_BYTES} % 3 + 1] END AS http_code FROM packages)"""
ORACLES["deliver"] = (
    with_packing(DOCUMENTS, "d", DOCUMENT_PACKS, "")
    + f""", {SENT}
SELECT package_id, topic_id, 1 AS attempt_no, http_code,
       CASE WHEN topic_id = 'es' THEN '--No RequestId--' ELSE 'r' || raw_bytes END AS request_id,
       CASE WHEN topic_id = 'es' THEN 'no answer' WHEN http_code = 200 THEN ''
            ELSE '{{"errorcode": "E", "errormessage": "m"}}' END AS body FROM sent"""
)
ORACLES["payload_stats"] = document_packing(
    f"""SELECT topic_id, compress_type, count(*) AS packages, sum({REQUEST_BYTES})::BIGINT AS raw_bytes,
       compress_type = 'zstd' AS smaller
FROM packages, (VALUES ('zstd'), ('none')) AS kinds(compress_type) GROUP BY ALL"""
)
ORACLES["log_size"] = f"WITH {DOCUMENTS} SELECT seq, size_bytes FROM d"
ORACLES["varint_size"] = f"""
SELECT event_id, {vint("event_id * event_id * 1000003 * (1 - 2 * (event_id % 2))")} AS n_bytes FROM events"""
ORACLES["content_wire_size"] = f"""
SELECT page_id AS seq, 0 AS position, {pair_size("'url'", "url")} AS wire_bytes FROM pages
UNION ALL SELECT page_id, 1, {pair_size("'html'", "html")} FROM pages"""
ORACLES["tag_wire_size"] = f"""
SELECT doc_id, {pair_size("lang", "source")} AS wire_bytes FROM documents"""
ORACLES["log_wire_size"] = f"""WITH {DOCUMENTS}
SELECT seq, log_bytes + CASE WHEN seq % 3 = 0 THEN 1 + {vint("arrival_ms")} ELSE 0 END AS wire_bytes FROM d"""
_tag_bytes = " + ".join(field(pair_size(f"'{k}'", f"'{v}'")) for k, v in TAGS.items())
ORACLES["group_wire_size"] = document_packing(
    f"""SELECT {package_id("topic_id", "package_seq")} AS package_id, topic_id,
       wire_bytes + {text_field("'a.log'")} + {_tag_bytes} AS wire_bytes FROM packages"""
)
ORACLES["request_wire_size"] = document_packing(
    f"""SELECT topic_id, package_seq // 4 AS request_no, sum({REQUEST_BYTES})::BIGINT AS request_bytes
FROM packages GROUP BY ALL"""
)
ORACLES["with_defaults"] = f"""WITH {EVENTS}
SELECT seq, 0::BIGINT AS collect_time, CASE WHEN seq % 2 = 1 THEN topic_id ELSE '' END AS source,
       CASE WHEN seq % 2 = 1 THEN (user_id IS NOT NULL)::INTEGER + (props IS NOT NULL)::INTEGER
            ELSE 0 END AS n_contents FROM e"""
ORACLES["ns_to_ms"] = """
SELECT event_id, trunc((event_id - 500) * 1500001 / 1000000.0)::BIGINT AS ms FROM events"""
ORACLES["stamp_group"] = f"""
SELECT 'queued' AS mode, page_id AS seq, '10.0.0.1' AS source, '' AS hostname,
       NULL::VARCHAR AS filename, {len(TAGS)} AS n_tags FROM pages
UNION ALL SELECT 'direct', page_id, NULL, 'web-1', NULL, 0 FROM pages"""
ORACLES["package_id"] = f"""
SELECT event_id, {package_id("event_type", "event_id + 1", 1_700_000_000)} AS package_id FROM events"""
ORACLES["reject_oversize"] = f"""
SELECT doc_id AS seq, CASE WHEN strlen(text) > {MAX_VALUE_BYTES} OR strlen(source) > {MAX_VALUE_BYTES}
       THEN 'value_too_large' END AS reason FROM documents"""
ORACLES["reject_incomplete"] = """
SELECT event_id AS seq, CASE event_id % 7 WHEN 1 THEN 'missing_time' WHEN 2 THEN 'missing_key'
       WHEN 3 THEN 'missing_value' END AS reason FROM events"""
ORACLES["classify_response"] = f"""WITH {ATTEMPTS}
SELECT package_id, attempt_no, outcome, success, error_code, error_message, request_id FROM c"""
ORACLES["parse_error_body"] = f"""WITH {ATTEMPTS}
SELECT package_id, attempt_no, body_code, body_message FROM a"""
ORACLES["log_list_size"] = f"""WITH {DOCUMENTS}
SELECT request_no, sum(size_bytes)::BIGINT AS size_bytes FROM d GROUP BY 1"""
ORACLES["check_requests"] = f"""WITH {DOCUMENTS}, m AS (
  SELECT topic_id, request_no, sum(size_bytes)::BIGINT AS size_bytes, count(*) AS n_logs,
         bool_or(strlen(text) > 40000 OR strlen(source) > 40000) AS oversize
  FROM d GROUP BY ALL), j AS (
  SELECT *, CASE WHEN oversize THEN 'value_too_large'
                 WHEN size_bytes > {MAX_REQUEST_BYTES // 2} OR n_logs > 20 THEN 'request_too_large'
            END AS reason FROM m)
SELECT topic_id, request_no, size_bytes, n_logs, reason IS NULL AS accepted, reason FROM j"""
ORACLES["assemble_groups"] = event_packing(
    f"""SELECT {package_id("l.topic_id", "l.package_seq")} AS package_id, l.topic_id, count(*) AS n_logs,
       string_agg(e.time::VARCHAR, ',' ORDER BY e.arrival_ms, e.seq) AS times, '' AS source,
       {package_id("l.topic_id", "l.package_seq")} AS context_flow
FROM labels l JOIN e ON e.seq = l.seq GROUP BY l.topic_id, l.package_seq"""
)
GROUPS = f"""g AS (
  SELECT request_no, group_no, sum(size_bytes)::BIGINT AS size_bytes, count(*) AS n_logs,
         sum({field("log_bytes")})::BIGINT + {2 + len("10.0.0.1")} AS wire_bytes,
         bool_or(strlen(text) > 40000 OR strlen(source) > 40000) AS oversize
  FROM d GROUP BY ALL),
t AS (
  SELECT *, sum(size_bytes) OVER (PARTITION BY request_no ORDER BY group_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM g)"""
ORACLES["assemble_requests"] = f"""WITH {DOCUMENTS}, {GROUPS}
SELECT request_no, count(*) AS n_groups,
       CASE WHEN max(running) <= {MAX_REQUEST_BYTES} THEN sum({REQUEST_BYTES})::BIGINT ELSE -1 END AS raw_bytes
FROM t GROUP BY request_no"""
ORACLES["send_requests"] = f"""WITH {DOCUMENTS}, {GROUPS}, r AS (
  SELECT request_no, max(running) > {MAX_REQUEST_BYTES} AS over, sum({REQUEST_BYTES})::BIGINT AS raw_bytes
  FROM t GROUP BY request_no)
SELECT request_no, CASE WHEN over THEN 0 ELSE 1 END AS sends,
       CASE WHEN over THEN 0 ELSE [200, 429, 413][raw_bytes % 3 + 1] END AS http_code,
       CASE WHEN over THEN 'request_too_large' END AS reason FROM r"""
ORACLES["package_summary"] = event_packing(
    f"""SELECT {package_id("topic_id", "package_seq")} AS package_id, 'main' AS producer, topic_id,
       package_seq, create_ms, close_ms, close_reason, n_logs, size_bytes, wire_bytes FROM packages"""
)
ORACLES["attempt_history"] = f"""WITH {ATTEMPTS}
SELECT 'first' AS kept, package_id, attempt_no, success, error_code, ts_ms FROM c
QUALIFY row_number() OVER (PARTITION BY package_id ORDER BY attempt_no) <= 3
UNION ALL (SELECT 'last', package_id, attempt_no, success, error_code, ts_ms FROM c
QUALIFY row_number() OVER (PARTITION BY package_id ORDER BY attempt_no DESC) <= 3)"""
ORACLES["delivery_result"] = f"""WITH {RESULTS}
SELECT p.package_id, coalesce(successful, false) AS successful,
       coalesce(error_code, '') AS error_code, coalesce(error_message, '') AS error_message,
       coalesce(request_id, '') AS request_id, coalesce(s.ts_ms, 0) AS ts_ms,
       coalesce(failures, 0) AS failures, coalesce(terminal, false) AS terminal,
       coalesce(state, 'pending') AS state
FROM (SELECT event_id::VARCHAR AS package_id FROM events
      UNION ALL SELECT 'doc-' || doc_id FROM documents) p LEFT JOIN s USING (package_id)"""
ORACLES["merge_tallies"] = f"""WITH {RESULTS}
SELECT package_id, successful, error_code, error_message, request_id, ts_ms, failures, terminal, state FROM s"""
ORACLES["check_request_groups"] = f"""WITH {DOCUMENTS}, {GROUPS}, b AS (
  SELECT *, oversize OR running > {MAX_REQUEST_BYTES} OR n_logs > {MAX_GROUP_LOGS + 1} AS bad FROM t),
f AS (
  SELECT request_no, sum(size_bytes)::BIGINT AS size_bytes, sum(n_logs)::BIGINT AS n_logs,
         count(*) AS n_groups, min(group_no) FILTER (bad) AS first_bad,
         min(group_no) FILTER (oversize) AS value_bad FROM b GROUP BY 1)
SELECT request_no, size_bytes, n_logs, n_groups, coalesce(first_bad, -1) AS first_bad,
       CASE WHEN value_bad = first_bad THEN 'value_too_large'
            WHEN first_bad IS NOT NULL THEN 'request_too_large' END AS reason,
       first_bad IS NULL AS accepted FROM f"""
ORACLES["split_segments"] = f"""WITH {EVENTS}, p AS (
  SELECT topic_id, seq, arrival_ms,
         lag(arrival_ms) OVER (PARTITION BY topic_id ORDER BY arrival_ms, seq) AS previous_ms FROM e)
SELECT topic_id, seq, arrival_ms, coalesce(previous_ms, -1) AS previous_ms,
       (sum(CASE WHEN arrival_ms - previous_ms >= {HOUR_MS} THEN 1 ELSE 0 END) OVER (
         PARTITION BY topic_id ORDER BY arrival_ms, seq))::BIGINT AS segment FROM p"""
ORACLES["in_flight_bytes"] = f"""WITH {RESULTS}, {EVENTS}, m AS (
  SELECT topic_id, arrival_ms AS ts_ms, seq::VARCHAR AS package_id, size_bytes AS delta FROM e
  UNION ALL
  SELECT e.topic_id, s.ts_ms, s.package_id, -e.size_bytes
  FROM e JOIN s ON s.package_id = e.seq::VARCHAR AND s.state IN ('success', 'failed')),
i AS (
  SELECT *, (sum(delta) OVER (PARTITION BY topic_id ORDER BY ts_ms, package_id, delta
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS in_flight FROM m)
SELECT topic_id, ts_ms, package_id, delta, in_flight, in_flight > {RETRIES.total_bytes} AS over FROM i"""
ORACLES["pack_logs"] = event_packing(
    f"""SELECT l.topic_id, l.seq, l.package_seq, {package_id("l.topic_id", "l.package_seq")} AS package_id,
       l.create_ms, l.close_ms, l.close_reason, coalesce(e.user_id, e.props) AS first_value
FROM labels l JOIN e ON e.seq = l.seq"""
)
LISTS = f"""turns AS (
  SELECT conv_id, turn, {accounting(*TEXT_PAIRS)} AS size_bytes,
         {field(wire("turn", *TEXT_PAIRS))} AS inside,
         conv_id * 1000 + turn // {LIST_TURNS} AS seq,
         row_number() OVER (PARTITION BY conv_id, turn // {LIST_TURNS} ORDER BY turn) - 1 AS position
  FROM conversations),
lists AS (
  SELECT 'chat' || (conv_id % 3) AS topic_id, seq, seq AS arrival_ms,
         sum(size_bytes) AS size_bytes, sum(inside) AS inside_bytes, count(*) AS n_turns
  FROM turns GROUP BY conv_id, seq)"""
ORACLES["pack_log_lists"] = with_packing(
    LISTS,
    "lists",
    LIST_PACKS,
    """SELECT l.topic_id, l.seq, t.position, l.package_seq, l.create_ms, l.close_ms, l.close_reason,
       t.size_bytes FROM labels l JOIN turns t ON t.seq = l.seq""",
    n_logs="n_turns",
    inside="inside_bytes",
)
ORACLES["pack_logs_grid"] = f"""WITH {EVENTS}, b AS (
  SELECT *, arrival_ms // {EVENT_PACKS.linger_ms} AS bucket FROM e), w AS (
  SELECT *, sum(size_bytes) OVER o - size_bytes AS before, row_number() OVER o - 1 AS rank FROM b
  WINDOW o AS (PARTITION BY topic_id, bucket ORDER BY arrival_ms, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT topic_id, seq, bucket, by_bytes, by_count,
       {named_id("topic_id", name_in_id("bucket", "by_bytes", "by_count"))} AS package_id
FROM (SELECT topic_id, seq, bucket, (before // {EVENT_PACKS.max_bytes})::BIGINT AS by_bytes,
             rank // {EVENT_PACKS.max_logs} AS by_count FROM w)"""
ORACLES["log_status"] = f"""WITH {RESULTS}, {EVENTS}
SELECT e.seq, e.topic_id,
       CASE state WHEN 'success' THEN 'delivered' WHEN 'failed' THEN 'failed' ELSE 'pending' END AS status,
       coalesce(error_code, '') AS error_code, coalesce(error_message, '') AS error_message,
       coalesce(s.ts_ms, 0) AS ts_ms
FROM e LEFT JOIN s ON s.package_id = e.seq::VARCHAR
UNION ALL SELECT doc_id, lang, 'pending', '', '', 0 FROM documents"""
ORACLES["unsent"] = f"""WITH {RESULTS}, {EVENTS}
SELECT seq::VARCHAR AS package_id, topic_id, arrival_ms AS close_ms, size_bytes FROM e
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.package_id = e.seq::VARCHAR AND state IN ('success', 'failed'))"""
ORACLES["retry_schedule"] = f"""WITH {RESULTS}
SELECT package_id, failures, ts_ms, wait_ms, ts_ms + wait_ms AS next_retry_ms FROM q"""
ORACLES["pending_retries"] = ORACLES["retry_schedule"]
ORACLES["retry_stream"] = f"""WITH {RESULTS}
SELECT package_id, CAST(failures + 1 AS INTEGER) AS attempt_no, failures, ts_ms, wait_ms,
       ts_ms + wait_ms AS next_retry_ms FROM q"""
ORACLES["retry_due"] = f"""WITH {RESULTS}
SELECT false AS closing, package_id, ts_ms + wait_ms AS next_retry_ms FROM q WHERE ts_ms + wait_ms < {NOW_MS}
UNION ALL SELECT true, package_id, ts_ms + wait_ms FROM q"""
ORACLES["dead_letters"] = f"""WITH {RESULTS}
SELECT package_id, failures, error_code, error_message, ts_ms,
       CASE WHEN terminal THEN 'terminal' ELSE 'retries_exhausted' END AS reason FROM s WHERE state = 'failed'"""
ORACLES["pack_stream_microbatch"] = event_packing(
    "SELECT topic_id, seq, package_seq, create_ms, close_ms, close_reason FROM labels"
)
ORACLES["pack_stream"] = event_packing(
    f"""SELECT topic_id, seq, package_seq, {package_id("topic_id", "package_seq")} AS package_id,
       create_ms, close_ms, close_reason FROM labels"""
)
_opener = named_id("topic_id", name_in_id("first_value(arrival_ms) OVER p", "first_value(seq) OVER p"))
ORACLES["pack_stream_carried"] = event_packing(
    f"""SELECT topic_id, seq, {_opener} AS package_id, create_ms FROM labels
WINDOW p AS (PARTITION BY topic_id, package_seq ORDER BY arrival_ms, seq)"""
)
ORACLES["flush_open"] = event_packing(
    """SELECT topic_id, package_seq, n_logs, close_ms FROM packages WHERE close_reason = 'flush'"""
)
ORACLES["retry_pass"] = (
    with_packing(DOCUMENTS, "d", DOCUMENT_PACKS, "")
    + f""", {SENT}
SELECT package_id, topic_id, attempt_no, http_code FROM sent, (VALUES (1), (2), (3)) AS n(attempt_no)
WHERE attempt_no = 1 OR http_code IN (-1, 429)"""
)
