"""SQL counterparts of the queries, written independently of the operators."""

from __future__ import annotations

MESSAGES = """
messages AS (
  SELECT event_id AS msg_id, ts AS arrival, 'conv:' || user_id AS pid, 'T' || (event_id % 4) AS raw_dsid,
    CASE WHEN event_type = 'signup' THEN 'ingest'
         WHEN event_type = 'view' THEN 'getObjectXML'
         WHEN event_type = 'click' THEN 'modifyDatastreamByValue'
         WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'addDatastream'
         WHEN event_type = 'purchase' THEN 'modifyObject'
         WHEN event_type = 'error' AND event_id % 8 = 0 THEN 'purgeObject'
         WHEN event_type = 'error' THEN 'purgeDatastream' END AS method_name
  FROM events)"""

JOBS = MESSAGES + """,
rules(method_name, idx, kind, op, keep, days) AS (VALUES
  ('ingest', 0, 'object', 'CREATE', false, 1),
  ('addDatastream', 0, 'datastream', 'CREATE', true, 1),
  ('purgeObject', 0, 'object', 'DELETE', false, 0),
  ('purgeDatastream', 0, 'datastream', 'DELETE', true, 0),
  ('modifyObject', 0, 'object', 'UPDATE', false, 5),
  ('modifyDatastreamByValue', 0, 'object', 'UPDATE', true, 1),
  ('modifyDatastreamByValue', 1, 'datastream', 'UPDATE', true, 5)),
jobs AS (
  SELECT kind, op, pid, CASE WHEN keep THEN raw_dsid ELSE '' END AS dsid,
    CASE WHEN kind = 'datastream' THEN pid || ':' || raw_dsid ELSE pid END AS doc_id,
    arrival, days * 86400 AS delay_s, arrival + to_days(days) AS ready_at, msg_id * 16 + idx AS seq
  FROM messages JOIN rules USING (method_name))"""

KEY = {"reference": "op, pid, dsid", "corrected": "kind, op, doc_id"}


def settled(mode: str, source: str = "jobs", name: str = "settled") -> str:
    """CTE ``name``: jobs of ``source`` that are neither replaced nor, in corrected mode, cancelled."""
    cancelled = ""
    if mode == "corrected":
        cancelled = f"""
  AND NOT EXISTS (SELECT 1 FROM {source} d WHERE d.op = 'DELETE' AND d.kind = 'object' AND d.pid = q.pid
    AND (d.arrival > q.arrival OR (d.arrival = q.arrival AND d.seq > q.seq)) AND d.arrival < q.ready_at)
  AND NOT EXISTS (SELECT 1 FROM {source} d WHERE d.op = 'DELETE' AND d.kind = 'datastream' AND q.kind = 'datastream'
    AND d.doc_id = q.doc_id
    AND (d.arrival > q.arrival OR (d.arrival = q.arrival AND d.seq > q.seq)) AND d.arrival < q.ready_at)"""
    return f"""
{name} AS (
  SELECT kind, op, pid, dsid, doc_id, arrival, delay_s, ready_at, seq FROM (
    SELECT *, lead(arrival) OVER (PARTITION BY {KEY[mode]} ORDER BY arrival, seq) AS next_arrival FROM {source}) q
  WHERE (next_arrival IS NULL OR next_arrival >= ready_at){cancelled})"""


OBJECTS = """
profiles AS (
  SELECT 'conv:' || conv_id AS pid, CASE WHEN conv_id % 5 = 0 THEN 'I' ELSE 'A' END AS state,
    'conversation opened by ' || arg_min(role, turn) AS label, 'archive' AS owner_id,
    TIMESTAMP '2024-01-01' + to_seconds(conv_id % 86400) AS create_date,
    TIMESTAMP '2024-01-01' + to_seconds(conv_id % 86400 + max(turn)) AS last_modified_date
  FROM conversations GROUP BY conv_id)"""

DATASTREAMS = """
streams AS (
  SELECT 'conv:' || conv_id AS pid, 'T' || turn AS dsid, 'conv:' || conv_id || ':T' || turn AS doc_id, role AS label,
    TIMESTAMP '2024-01-01' + to_seconds(turn) AS created, strlen(text) AS size, turn % 2 = 0 AS versionable, text,
    CASE WHEN (conv_id + turn) % 13 = 0 THEN 404 ELSE 200 END AS status
  FROM conversations)"""

SEEDS = """
seed_turns AS (SELECT conv_id, turn FROM (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations) WHERE turn < last),
seed_objects AS (SELECT DISTINCT 'conv:' || conv_id AS pid FROM seed_turns),
seed_streams AS (SELECT 'conv:' || conv_id AS pid, 'conv:' || conv_id || ':T' || turn AS doc_id FROM seed_turns),
seed_errors AS (
  SELECT 'conv:' || user_id || CASE WHEN user_id % 2 = 1 THEN ':T1' ELSE '' END AS doc_id, 'conv:' || user_id AS pid,
    CASE WHEN user_id % 2 = 1 THEN 'T1' ELSE '' END AS dsid,
    '[UPDATE] [conv:' || user_id || CASE WHEN user_id % 2 = 1 THEN ':T1' ELSE '' END || ']' AS job, 'seed' AS message,
    min(ts) - to_days(user_id % 60) AS at_time
  FROM events GROUP BY user_id)"""

NO_SEEDS = """
seed_objects AS (SELECT NULL::VARCHAR AS pid WHERE false),
seed_streams AS (SELECT NULL::VARCHAR AS pid, NULL::VARCHAR AS doc_id WHERE false),
seed_errors AS (SELECT NULL::VARCHAR AS doc_id, NULL::VARCHAR AS pid, NULL::VARCHAR AS dsid, NULL::VARCHAR AS job,
  NULL::VARCHAR AS message, NULL::TIMESTAMP AS at_time WHERE false)"""


def apply_sql(mode: str, seeds: str = SEEDS) -> str:
    """End state of the index: fan-out written out job by job, then positions compared per document."""
    own_removes = "true" if mode == "corrected" else "false"
    return f"""
WITH {JOBS},{settled(mode, name="round1")},{OBJECTS},{DATASTREAMS},{seeds},
fan AS (
  SELECT 'datastream' AS kind, 'CREATE' AS op, r.pid, s.dsid, s.doc_id, r.ready_at AS arrival, 0 AS delay_s,
    r.ready_at AS ready_at, r.seq + 4611686018427387904 AS seq
  FROM round1 r JOIN streams s ON s.pid = r.pid WHERE r.kind = 'object' AND r.op = 'CREATE'),
again AS (
  SELECT kind, op, pid, dsid, doc_id, arrival, delay_s, ready_at, seq FROM round1 WHERE kind = 'datastream' AND op = 'CREATE'
  UNION ALL SELECT kind, op, pid, dsid, doc_id, arrival, delay_s, ready_at, seq FROM fan),
{settled("corrected" if mode == "corrected" else "reference", "again", "round2")},
ops AS (
  SELECT kind, op, pid, dsid, doc_id, ready_at, seq FROM round1 WHERE NOT (kind = 'datastream' AND op = 'CREATE')
  UNION ALL SELECT kind, op, pid, dsid, doc_id, ready_at, seq FROM round2),
object_deletes AS (SELECT pid, max(row(ready_at, seq)) AS pos FROM ops WHERE kind = 'object' AND op = 'DELETE' GROUP BY pid),
stream_deletes AS (SELECT doc_id, max(row(ready_at, seq)) AS pos FROM ops WHERE kind = 'datastream' AND op = 'DELETE' GROUP BY doc_id),
writes AS (
  SELECT o.*, row(o.ready_at, o.seq) AS pos, od.pos AS od_pos, sd.pos AS sd_pos,
    (od.pos IS NULL OR row(o.ready_at, o.seq) > od.pos)
      AND (NOT {own_removes} OR o.kind = 'object' OR sd.pos IS NULL OR row(o.ready_at, o.seq) > sd.pos) AS alive
  FROM ops o LEFT JOIN object_deletes od ON od.pid = o.pid LEFT JOIN stream_deletes sd ON sd.doc_id = o.doc_id
  WHERE o.op <> 'DELETE'),
written AS (
  SELECT w.kind, w.doc_id, any_value(w.pid) AS pid, count(*) FILTER (WHERE w.alive) AS n, max(w.pos) AS last_pos,
    arg_max(w.op, w.pos) AS last_op, arg_max(w.dsid, w.pos) AS last_dsid, arg_max(w.ready_at, w.pos) AS last_at,
    any_value(w.od_pos) AS od_pos, any_value(w.sd_pos) AS sd_pos
  FROM writes w GROUP BY w.kind, w.doc_id),
judged AS (
  SELECT w.*, CASE
      WHEN w.kind = 'object' AND p.pid IS NULL THEN 'no profile of object ' || w.pid
      WHEN w.kind = 'datastream' AND s.doc_id IS NULL THEN 'no profile of datastream ' || w.last_dsid || ' of object ' || w.pid
      WHEN w.kind = 'datastream' AND s.status <> 200 THEN 'content not available, status ' || s.status END AS failure,
    CASE WHEN w.kind = 'object' THEN p.label ELSE s.label END AS label
  FROM written w LEFT JOIN profiles p ON w.kind = 'object' AND p.pid = w.pid
  LEFT JOIN streams s ON w.kind = 'datastream' AND s.doc_id = w.doc_id),
objects_left AS (SELECT pid FROM seed_objects WHERE pid NOT IN (SELECT pid FROM object_deletes)),
streams_left AS (SELECT doc_id FROM seed_streams WHERE pid NOT IN (SELECT pid FROM object_deletes)
  AND NOT ({own_removes} AND doc_id IN (SELECT doc_id FROM stream_deletes))),
good AS (
  SELECT j.*, coalesce(o.pid, s.doc_id) IS NULL AS created FROM judged j
  LEFT JOIN objects_left o ON j.kind = 'object' AND o.pid = j.doc_id
  LEFT JOIN streams_left s ON j.kind = 'datastream' AND s.doc_id = j.doc_id
  WHERE j.failure IS NULL AND j.n > 0),
bad AS (
  SELECT * FROM judged WHERE failure IS NOT NULL AND (od_pos IS NULL OR last_pos > od_pos) AND (sd_pos IS NULL OR last_pos > sd_pos))
SELECT 'objects' AS tbl, doc_id, n + CASE WHEN created THEN 0 ELSE 1 END AS version, label AS detail, NULL::TIMESTAMP AS at_time
  FROM good WHERE kind = 'object'
UNION ALL SELECT 'objects', pid, 1, 'seed', NULL FROM objects_left WHERE pid NOT IN (SELECT doc_id FROM good WHERE kind = 'object')
UNION ALL SELECT 'datastreams', doc_id, n + CASE WHEN created THEN 0 ELSE 1 END, label, NULL FROM good WHERE kind = 'datastream'
UNION ALL SELECT 'datastreams', doc_id, 1, 'seed', NULL FROM streams_left
  WHERE doc_id NOT IN (SELECT doc_id FROM good WHERE kind = 'datastream')
UNION ALL SELECT 'errors', doc_id, NULL, '[' || last_op || '] [' || doc_id || '] ' || failure, last_at FROM bad
UNION ALL SELECT 'errors', doc_id, NULL, job || ' ' || message, at_time FROM seed_errors e
  WHERE pid NOT IN (SELECT pid FROM object_deletes) AND doc_id NOT IN (SELECT doc_id FROM stream_deletes)
  AND doc_id NOT IN (SELECT doc_id FROM bad)
  AND doc_id NOT IN (SELECT doc_id FROM good WHERE kind = 'object' OR created OR {own_removes})"""


PAGES = """
pages_of AS (SELECT source, doc_id // 500 AS page_no, doc_id,
  (substr(source, 4)::BIGINT + doc_id // 500) % 7 = 3 AS lost FROM documents)"""

LAST_RUN = """
latest AS (SELECT o_custkey AS k, max(o_orderdate) AS d, max(o_orderkey) AS o FROM orders GROUP BY o_custkey),
last_run AS (SELECT k, 'cust:' || k AS source,
  CASE WHEN k % 6 = 0 OR k % 10 < 2 THEN NULL ELSE d + to_seconds((k * 977) % 86400) END AS ts,
  CASE WHEN k % 6 < 3 THEN NULL ELSE d + to_days((k % 900)::INTEGER) END AS expiration_date,
  CASE WHEN k % 6 = 0 OR k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN '' ELSE 'tok:' || o END AS resumption_token
  FROM latest)"""

NOW = "TIMESTAMP '2002-06-01 00:00:00'"
VALID = f"(coalesce(resumption_token, '') <> '' AND (expiration_date IS NULL OR expiration_date > {NOW}))"


def _plan(mode: str) -> str:
    fmt = "'%Y-%m-%dT%H:%M:%SZ'" if mode == "corrected" else "'%Y-%m-%dT%I:%M:%S'"
    read = "'%Y-%m-%dT%H:%M:%SZ'" if mode == "corrected" else "'%Y-%m-%dT%H:%M:%S'"
    bound = f"CASE WHEN NOT {VALID} AND ts IS NOT NULL THEN strftime(ts, {fmt}) END"
    return f"""SELECT '{mode}' AS mode, source,
  CASE WHEN {VALID} THEN 'RESUME' WHEN ts IS NOT NULL THEN 'INCREMENTAL' ELSE 'FULL' END AS action,
  CASE WHEN {VALID} THEN resumption_token END AS token, {bound} AS from_text,
  strptime({bound}, {read}) AS from_ts FROM last_run"""


HARVEST_PLAN = f"""
WITH {LAST_RUN.replace("last_run AS", "known AS")},
last_run AS (SELECT 'cust:' || c_custkey AS source, ts, expiration_date, resumption_token
  FROM customer LEFT JOIN known ON known.source = 'cust:' || c_custkey)
{_plan('reference')} UNION ALL {_plan('corrected')}"""

CHANGED_SINCE_PLAN = f"""
WITH {LAST_RUN}, plan AS ({_plan('corrected')})
SELECT o_orderkey, o_orderdate FROM orders JOIN plan ON plan.source = 'cust:' || o_custkey
WHERE from_ts IS NULL OR o_orderdate >= from_ts"""

NEXT_RUN = f"""
WITH {LAST_RUN} SELECT source, CASE WHEN ts > TIMESTAMP '2001-03-01' THEN ts
  WHEN coalesce(resumption_token, '') <> '' THEN TIMESTAMP '2001-03-01 00:00:01'
  ELSE TIMESTAMP '2001-03-01 00:05:00' END AS next_run_at FROM last_run"""

MERGE = f"""
WITH {LAST_RUN},
state AS (SELECT * FROM last_run WHERE k % 3 <> 0),
run AS (SELECT k, source, {NOW} + to_seconds(k) AS request_at, k % 5 = 0 AS failed,
  CASE WHEN k % 4 = 1 THEN 'next:' || k ELSE '' END AS token,
  CASE WHEN k % 4 = 1 AND k % 2 = 1 THEN {NOW} + to_days(1) END AS expires FROM last_run WHERE k % 3 <> 1),
both_sides AS (SELECT coalesce(r.source, s.source) AS source, r.source IS NOT NULL AS ran, failed, request_at, token, expires,
  ts, expiration_date, resumption_token,
  coalesce(resumption_token, '') <> '' AND (expiration_date IS NULL OR expiration_date > request_at) AND ts IS NOT NULL AS goes_on
  FROM state s FULL JOIN run r ON r.source = s.source)
SELECT 'reference' AS mode, source,
  CASE WHEN NOT ran THEN ts WHEN NOT failed THEN request_at END AS ts,
  CASE WHEN NOT ran THEN expiration_date WHEN NOT failed THEN expires END AS expiration_date,
  CASE WHEN NOT ran THEN resumption_token WHEN NOT failed THEN nullif(token, '') END AS resumption_token
FROM both_sides
UNION ALL SELECT 'corrected', source,
  CASE WHEN NOT ran OR failed THEN ts WHEN goes_on THEN ts ELSE request_at END,
  CASE WHEN NOT ran OR failed THEN expiration_date ELSE expires END,
  CASE WHEN NOT ran OR failed THEN resumption_token ELSE nullif(token, '') END
FROM both_sides"""

OAI_IDENTIFIERS = f"""
WITH {PAGES} SELECT source, page_no, 'oai:' || source || ':doc:' || doc_id AS identifier, doc_id % 10 = 0 AS deleted
FROM pages_of WHERE NOT lost"""

OAI_LOCAL_ID = f"""
WITH {PAGES} SELECT 'oai:' || source || ':doc:' || doc_id AS identifier, 'doc:' || doc_id AS pid FROM pages_of WHERE NOT lost"""

OAI_STATE = f"""
WITH {PAGES}, p AS (SELECT DISTINCT source, page_no, lost FROM pages_of)
SELECT source, page_no, lost AS failed,
  CASE WHEN NOT lost AND page_no % 4 < 2 THEN 'tok-' || source || '-' || page_no ELSE '' END AS resumption_token,
  CASE WHEN NOT lost AND page_no % 4 = 1 THEN TIMESTAMP '2024-02-01 01:00:00' + to_seconds(page_no * 60) END AS expiration_date
FROM p"""

UNION_FEEDS = f"""
WITH {JOBS}, {PAGES}
SELECT kind, op, pid, dsid, doc_id, arrival, delay_s, ready_at, 0 AS generation, 0 AS feed, '' AS source, seq // 16 AS number, seq % 16 AS position FROM jobs
UNION ALL SELECT 'object', 'CREATE', 'doc:' || doc_id, '', 'doc:' || doc_id, TIMESTAMP '2024-02-01' + to_seconds(page_no * 60), 0,
  TIMESTAMP '2024-02-01' + to_seconds(page_no * 60), 0, 1, source, page_no, row_number() OVER (PARTITION BY source, page_no ORDER BY doc_id) - 1
FROM pages_of WHERE NOT lost"""

FAN_OUT = f"""
WITH {JOBS},{settled("reference")},{DATASTREAMS}
SELECT s.pid, s.dsid, s.doc_id, j.ready_at AS arrival, j.seq + 4611686018427387904 AS seq
FROM settled j JOIN streams s ON s.pid = j.pid WHERE j.kind = 'object' AND j.op = 'CREATE'"""

FAN_OUT_LARGE = """
SELECT 'order:' || o_orderkey AS pid, 'L' || l_linenumber AS dsid, 'order:' || o_orderkey || ':L' || l_linenumber AS doc_id,
  o_orderdate AS arrival FROM orders JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON l_orderkey = o_orderkey"""

FAN_OUT_COUNTED = """
SELECT 'order:' || p.l_orderkey || ':L' || c.l_linenumber AS doc_id, count(*) AS n, max(p.l_shipdate)::TIMESTAMP AS last_arrival,
  arg_max(p.l_linenumber, row(p.l_shipdate, p.l_linenumber))::BIGINT AS last_position
FROM lineitem p JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) c ON c.l_orderkey = p.l_orderkey GROUP BY p.l_orderkey, c.l_linenumber"""

JOB_COLUMNS = "kind, op, pid, dsid, doc_id, arrival, delay_s, ready_at, seq"


def jobs_where(condition: str) -> str:
    return f"WITH {JOBS} SELECT seq, kind, op, pid, dsid FROM jobs WHERE {condition}"


KEEP_LATEST = f"""
WITH {JOBS} SELECT {JOB_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY op, pid, dsid ORDER BY arrival DESC, seq DESC) AS rn FROM jobs) WHERE rn = 1"""

UPSERTS = f"{JOBS},{settled('reference')}"

OBJECT_DOCS = f"""
WITH {UPSERTS},{OBJECTS}
SELECT j.seq, p.pid, state, label, owner_id, create_date, last_modified_date FROM settled j JOIN profiles p ON p.pid = j.pid
WHERE j.kind = 'object' AND j.op <> 'DELETE'"""

OBJECT_FAILURES = f"""
WITH {UPSERTS},{OBJECTS}
SELECT j.seq, j.pid, 'no profile of object ' || j.pid AS error_message FROM settled j LEFT JOIN profiles p ON p.pid = j.pid
WHERE j.kind = 'object' AND j.op <> 'DELETE' AND p.pid IS NULL"""

WANTED_STREAMS = "wanted AS (SELECT DISTINCT pid, dsid, doc_id FROM settled WHERE kind = 'datastream' AND op <> 'DELETE')"

DATASTREAM_DOCS = f"""
WITH {UPSERTS},{DATASTREAMS}, {WANTED_STREAMS}
SELECT s.doc_id, s.dsid, s.label, s.created, s.size, s.versionable FROM wanted w JOIN streams s ON s.doc_id = w.doc_id"""

CONTENT_DOCS = f"""
WITH {UPSERTS},{DATASTREAMS}, {WANTED_STREAMS}
SELECT w.doc_id, CASE WHEN s.doc_id IS NOT NULL THEN 'objects/' || w.pid || '/datastreams/' || w.dsid || '/content' END AS uri,
  CASE WHEN s.status = 200 THEN s.text END AS content,
  CASE WHEN s.doc_id IS NULL THEN 'no profile of datastream ' || w.dsid || ' of object ' || w.pid
       WHEN s.status <> 200 THEN 'content not available, status ' || s.status END AS error_message
FROM wanted w LEFT JOIN streams s ON s.doc_id = w.doc_id"""

EXTRACT_TEXT = r"""
WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?(?:-->|\z)', '', 'g') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(t, '(?is)<head(?:\s[^>]*)?>.*?(?:</head\s*>|\z)', '', 'g') AS t FROM a),
c AS (SELECT page_id, regexp_replace(t, '(?is)<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)', '', 'g') AS t FROM b),
d AS (SELECT page_id, regexp_replace(t, '(?is)<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)', '', 'g') AS t FROM c),
e AS (SELECT page_id, regexp_replace(t, '(?i)</?(?:a|abbr|b|big|cite|code|em|font|i|mark|small|span|strong|sub|sup|tt|u)(?:\s[^>]*)?>', '', 'g') AS t FROM d),
f AS (SELECT page_id, regexp_replace(t, '(?s)<[!/?A-Za-z][^>]*>', ' ', 'g') AS t FROM e),
g AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'),
  '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS t FROM f)
SELECT page_id, trim(regexp_replace(t, '[ \t\r\n\f\x{00A0}]+', ' ', 'g')) AS content FROM g"""

XML_TEXT = f"WITH {MESSAGES} SELECT msg_id, method_name || ' ' || pid AS content FROM messages"

DISSEMINATION = f"""
WITH {OBJECTS},
latest AS (SELECT user_id, arg_max(props, row(ts, event_id)) AS props FROM events GROUP BY user_id),
judged AS (
  SELECT 'conv:' || user_id AS pid, user_id % 7 <> 0 AND user_id % 17 <> 3 AS answered, p.pid IS NOT NULL AS known, props,
    CASE WHEN p.pid IS NULL THEN 'no profile of object conv:' || user_id
         WHEN user_id % 7 <> 0 AND user_id % 17 = 3 THEN 'dissemination request failed'
         WHEN user_id % 7 <> 0 AND user_id % 11 = 0 THEN 'dissemination is not valid JSON' END AS error_message
  FROM latest LEFT JOIN profiles p ON p.pid = 'conv:' || user_id)"""

DISSEMINATION_DOCS = f"""{DISSEMINATION}
SELECT pid, CASE WHEN answered AND error_message IS NULL THEN 'demo:SDef' END AS sdef,
  CASE WHEN answered AND error_message IS NULL THEN json_extract(props, '$.k')::BIGINT END AS k, error_message
FROM judged"""

TYPED_PROPERTIES = f"""{DISSEMINATION}
SELECT pid, CASE WHEN answered THEN json_extract(props, '$.k')::BIGINT END AS k,
  CASE WHEN answered THEN json_extract_string(props, '$.k') END AS k_text, NULL::VARCHAR AS missing
FROM judged WHERE error_message IS NULL"""

UPSERT = f"""
WITH {SEEDS},{DATASTREAMS}, changes AS (SELECT * FROM streams WHERE status = 200)
SELECT coalesce(c.doc_id, s.doc_id) AS doc_id, CASE WHEN c.doc_id IS NULL THEN 'seed' ELSE c.label END AS label,
  CASE WHEN c.doc_id IS NOT NULL AND s.doc_id IS NOT NULL THEN 2 ELSE 1 END AS version,
  CASE WHEN c.doc_id IS NOT NULL THEN s.doc_id IS NULL END AS created
FROM seed_streams s FULL JOIN changes c ON c.doc_id = s.doc_id"""

DELETE_CASCADE = f"""
WITH {JOBS},{SEEDS}, gone AS (SELECT DISTINCT pid FROM jobs WHERE kind = 'object' AND op = 'DELETE')
SELECT 'objects' AS tbl, pid AS doc_id FROM seed_objects WHERE pid NOT IN (SELECT pid FROM gone)
UNION ALL SELECT 'datastreams', doc_id FROM seed_streams WHERE pid NOT IN (SELECT pid FROM gone)
UNION ALL SELECT 'errors', doc_id FROM seed_errors WHERE pid NOT IN (SELECT pid FROM gone)"""

DELETE_DATASTREAMS = f"""
WITH {JOBS},{SEEDS}, gone AS (SELECT DISTINCT doc_id FROM jobs WHERE kind = 'datastream' AND op = 'DELETE')
SELECT 'reference' AS mode, 'datastreams' AS tbl, doc_id FROM seed_streams
UNION ALL SELECT 'reference', 'errors', doc_id FROM seed_errors WHERE doc_id NOT IN (SELECT doc_id FROM gone)
UNION ALL SELECT 'corrected', 'datastreams', doc_id FROM seed_streams WHERE doc_id NOT IN (SELECT doc_id FROM gone)
UNION ALL SELECT 'corrected', 'errors', doc_id FROM seed_errors WHERE doc_id NOT IN (SELECT doc_id FROM gone)"""

CLEAR_ERRORS = f"""
WITH {SEEDS},{DATASTREAMS},
done AS (SELECT pid AS doc_id, true AS clears FROM streams
  UNION ALL SELECT doc_id, doc_id NOT IN (SELECT doc_id FROM seed_streams) FROM streams)
SELECT 'reference' AS mode, doc_id FROM seed_errors WHERE doc_id NOT IN (SELECT doc_id FROM done WHERE clears)
UNION ALL SELECT 'corrected', doc_id FROM seed_errors WHERE doc_id NOT IN (SELECT doc_id FROM done)"""

WRITE_ERRORS = f"""
WITH {UPSERTS},{OBJECTS},{SEEDS},
bad AS (SELECT j.doc_id, arg_max(j.pid, row(ready_at, seq)) AS pid, arg_max(j.dsid, row(ready_at, seq)) AS dsid,
    '[' || arg_max(op, row(ready_at, seq)) || '] [' || j.doc_id || ']' AS job, 'no profile of object ' || j.doc_id AS message,
    max(ready_at) AS at_time
  FROM settled j LEFT JOIN profiles p ON p.pid = j.pid
  WHERE j.kind = 'object' AND j.op <> 'DELETE' AND p.pid IS NULL GROUP BY j.doc_id)
SELECT doc_id, pid, dsid, job, message, at_time FROM bad
UNION ALL SELECT doc_id, pid, dsid, job, message, at_time FROM seed_errors WHERE doc_id NOT IN (SELECT doc_id FROM bad)"""

EXPIRE_ERRORS = f"WITH {SEEDS} SELECT doc_id, at_time FROM seed_errors WHERE at_time > TIMESTAMP '2024-01-20' - INTERVAL 42 DAY"

POSTINGS = r"""
SELECT 'text' AS field, term, doc_id, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents)
WHERE term <> '' GROUP BY term, doc_id"""

USER_TRANSFORM = f"""
WITH {OBJECTS}, counts AS (SELECT 'conv:' || user_id AS pid, count(*) AS n FROM events GROUP BY user_id)
SELECT p.pid, n AS events FROM profiles p LEFT JOIN counts USING (pid)"""

# One kind more, beside the others; kinds share error rows, so a later visit of an object clears its error.
ACCESS_JOBS = JOBS.replace("('ingest', 0,", "('getObjectXML', 0, 'access', 'UPDATE', false, 1),\n  ('ingest', 0,")
CUSTOM_KIND = apply_sql("corrected", NO_SEEDS).replace(JOBS, ACCESS_JOBS).replace(
    "judged AS (", """visits AS (SELECT doc_id, pid, count(*) AS n, max(row(ready_at, seq)) AS pos FROM round1 WHERE kind = 'access' GROUP BY doc_id, pid),
judged AS (""").replace("WHERE o.op <> 'DELETE')", "WHERE o.op <> 'DELETE' AND o.kind <> 'access')").replace(
    "(sd_pos IS NULL OR last_pos > sd_pos))", "(sd_pos IS NULL OR last_pos > sd_pos)\n    AND NOT EXISTS (SELECT 1 FROM visits v WHERE v.doc_id = judged.doc_id AND v.pos > last_pos))") + """
UNION ALL SELECT 'access', doc_id, n, 'seen ' || pid, NULL FROM visits"""


# Messages whose bodies are whole; the others are kept aside.
WHOLE = "FROM events WHERE event_id % 97 <> 0)"
RETENTION_DAYS = 14
STREAMED = apply_sql("reference", NO_SEEDS).replace("FROM events)", WHOLE)

STREAM_BATCHES = f"""
SELECT * FROM ({STREAMED}) WHERE tbl <> 'errors'
  OR at_time > (SELECT max(arrival) FROM (WITH {JOBS.replace("FROM events)", WHOLE)} SELECT arrival FROM jobs)) - INTERVAL {RETENTION_DAYS} DAY
UNION ALL SELECT 'malformed', msg_id::VARCHAR, NULL, 'body is not well-formed', arrival FROM (WITH {MESSAGES} SELECT * FROM messages WHERE msg_id % 97 = 0)"""

STREAM_POSTINGS = rf"""
WITH docs AS (SELECT * FROM ({STREAMED}) WHERE tbl <> 'errors'),
texts AS (
  SELECT tbl || '.LABEL' AS field, doc_id, detail AS text FROM docs
  UNION ALL SELECT 'datastreams.CONTENT', doc_id, text FROM docs JOIN (WITH {DATASTREAMS} SELECT doc_id, text FROM streams) USING (doc_id) WHERE tbl = 'datastreams')
SELECT field, term, doc_id, count(*) AS n FROM (
  SELECT field, doc_id, unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS term FROM texts)
WHERE term <> '' GROUP BY field, term, doc_id"""
