"""The same results as SQL for DuckDB, keyed like the queries."""

from __future__ import annotations

# Common table expressions: lineitem as sequenced messages, then the sequencing rules step by step.
_TRADES = """
m AS (
  SELECT l_orderkey AS channel, CAST(l_linenumber AS BIGINT) AS sequence, l_shipdate AS came_at, l_partkey, l_suppkey,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey) AS arr
  FROM lineitem
),
k AS (SELECT channel, sequence, min(arr) AS arr, min(came_at) AS came_at, count(*) AS copies FROM m GROUP BY channel, sequence),
b AS (SELECT channel, arg_min(sequence, arr) AS base, min(came_at) AS base_at FROM m GROUP BY channel)
"""
_RUNS = (
    _TRADES
    + """,
e AS (
  SELECT k.channel, min(k.sequence) AS run_end
  FROM k JOIN b ON b.channel = k.channel
  LEFT JOIN k n ON n.channel = k.channel AND n.sequence = k.sequence + 1
  WHERE k.sequence >= b.base AND n.sequence IS NULL
  GROUP BY k.channel
)
"""
)
_RELEASES = (
    _RUNS
    + """,
i AS (
  SELECT k.channel, k.sequence, k.arr, k.came_at, b.base, b.base_at,
         max(k.arr) OVER w AS release, max(k.came_at) OVER w AS release_at
  FROM k JOIN b ON b.channel = k.channel JOIN e ON e.channel = k.channel
  WHERE k.sequence > b.base AND k.sequence <= e.run_end
  WINDOW w AS (PARTITION BY k.channel ORDER BY k.sequence)
)
"""
)
_EVENTS = """
ev AS (
  SELECT event_id, ts, event_type AS group_key, props,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS sequence
  FROM events
)
"""
# Events of which some have lost their key; they are numbered together.
_HOLED = """
ev AS (
  SELECT event_id, ts, CASE WHEN event_id % 37 > 0 THEN event_type END AS group_key,
         row_number() OVER (PARTITION BY CASE WHEN event_id % 37 > 0 THEN event_type END ORDER BY ts, event_id) - 1 AS sequence
  FROM events
)
"""
_ORDER_TEXT = """
o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, o_orderkey AS number
  FROM orders
)
"""
_CUSTOMER_BATCHES = """
n AS (
  SELECT c_mktsegment, c_custkey, c_name,
         (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 25 AS batch_no
  FROM customer
)
"""
_MILLIS = "'%Y-%m-%d %H:%M:%S.%g'"
_CLOCK = "'%H:%M:%S.%g'"
_STAMP = "'2024-01-01 00:00:00.000'"


def _window_group(width: str, seconds: int) -> str:
    return f"""
  SELECT '{width}' AS width, strftime(start, {_MILLIS}) AS window_start, group_key, list_no, count(*) AS items,
         string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS event_ids
  FROM (
    SELECT *, (row_number() OVER (PARTITION BY start, group_key ORDER BY event_id) - 1) // 50 AS list_no
    FROM (SELECT event_id, event_type AS group_key,
                 make_timestamp(epoch_us(ts) // {seconds}000000 * {seconds}000000) AS start FROM events))
  GROUP BY start, group_key, list_no"""


WINDOW_GROUP = _window_group("5 seconds", 5) + "\n  UNION ALL" + _window_group("1 day", 86400)

WINDOW_SUMMARY = f"""
WITH {_EVENTS},
w AS (SELECT *, date_trunc('day', ts) AS start FROM ev),
l AS (
  SELECT *, (row_number() OVER g - 1) // 50 AS list_no, count(*) OVER (PARTITION BY group_key, start) AS total,
         min(ts) OVER (PARTITION BY group_key, start) AS low, max(ts) OVER (PARTITION BY group_key, start) AS high
  FROM w WINDOW g AS (PARTITION BY group_key, start ORDER BY sequence)
)
SELECT group_key, strftime(CAST(start AS TIMESTAMP), {_MILLIS}) AS window_start, list_no, count(*) AS items,
       CASE WHEN list_no = 0 THEN min(total) END AS group_items,
       CASE WHEN list_no = 0 THEN strftime(min(low), {_CLOCK}) END AS data_from,
       CASE WHEN list_no = 0 THEN strftime(max(high), {_CLOCK}) END AS data_to,
       CASE WHEN list_no = 0 THEN '00:00:00.000' END AS window_from,
       CASE WHEN list_no = 0 THEN '00:00:00.000' END AS window_to,
       string_agg(CAST(sequence AS VARCHAR), ',' ORDER BY sequence) AS sequences, 'ON_TIME' AS timing
FROM l GROUP BY group_key, start, list_no
"""

EVENT_BATCHES = f"""
WITH n AS (
  SELECT event_id, event_type, date_trunc('day', ts) AS day,
         (row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY event_id) - 1) // 25 AS batch_no
  FROM events
)
SELECT event_type AS group_key, strftime(CAST(day AS TIMESTAMP), {_MILLIS}) AS window_start, batch_no, count(*) AS size,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS items
FROM n GROUP BY event_type, day, batch_no"""

SEQ_EMISSIONS = f"""
WITH {_RELEASES}
SELECT channel, max(sequence) AS sequence, min(epoch_ms(base_at)) AS trade_date,
       CAST(0.01 * (max(sequence) - min(base)) AS DECIMAL(38,2)) AS price,
       count(*) AS released, strftime(max(release_at), '%Y-%m-%d') AS released_at
FROM i GROUP BY channel, release
"""

SEQ_TICKS = f"""
WITH {_RELEASES},
t AS (
  SELECT k.channel, b.base, k.sequence,
         CAST(floor(epoch(k.came_at - b.base_at) / 2592000) AS BIGINT) + 1 AS came,
         CAST(floor(epoch(i.release_at - b.base_at) / 2592000) AS BIGINT) + 1 AS done
  FROM k JOIN b ON b.channel = k.channel LEFT JOIN i ON i.channel = k.channel AND i.sequence = k.sequence
  WHERE k.sequence > b.base
),
x AS (SELECT DISTINCT channel, base, came AS tick FROM t)
SELECT x.channel, x.tick,
       greatest(x.base, coalesce(max(t.sequence) FILTER (WHERE t.done <= x.tick), x.base)) AS book_sequence,
       count(*) FILTER (WHERE t.came = x.tick) AS arrived,
       count(*) FILTER (WHERE t.done = x.tick) AS calculated,
       min(t.sequence) FILTER (WHERE t.done = x.tick) AS calc_from,
       max(t.sequence) FILTER (WHERE t.done = x.tick) AS calc_to,
       min(t.sequence) FILTER (WHERE t.came <= x.tick AND coalesce(t.done, x.tick) >= x.tick) AS pending_first,
       max(t.sequence) FILTER (WHERE t.came <= x.tick) AS pending_last,
       count(*) FILTER (WHERE t.came <= x.tick AND coalesce(t.done, x.tick) >= x.tick) AS pending_size,
       count(*) FILTER (WHERE t.came <= x.tick AND coalesce(t.done, x.tick + 1) > x.tick) AS remaining,
       min(t.sequence) FILTER (WHERE t.came <= x.tick AND coalesce(t.done, x.tick + 1) > x.tick) AS remaining_first
FROM x JOIN t ON t.channel = x.channel GROUP BY x.channel, x.base, x.tick"""

LOAD_APPEND = f"""
SELECT id, name, {_STAMP} AS df_ts, true AS created FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier
  UNION ALL SELECT * FROM (VALUES ('Stephen', 'Stephen'), ('Kamal', 'Kamal'), ('Paul', 'Paul')) v
)
"""

CSV_QUOTED = "SELECT doc_id, text, lang, source, n_chars, 'main' AS tag FROM documents"

BATCH: dict[str, str] = {
    "scan_project": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    "literal_rows": """
SELECT * FROM (VALUES ('John'), ('Andrew'), ('Steve'), ('John')) v(name) UNION ALL SELECT c_name FROM customer""",
    "sequence_source": f"""
SELECT o_orderkey, n, 'number ' || CAST(n AS VARCHAR) AS name,
       strftime(make_timestamp((n - 1) // 3 * 10000000), {_MILLIS}) AS ts
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)""",
    "message_source": f"""
WITH {_EVENTS}
SELECT event_id, props AS payload, CASE WHEN event_id % 41 > 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS publish_ts, group_key,
       CAST(sequence AS VARCHAR) AS sequence FROM ev""",
    "notification_paths": """
SELECT CASE WHEN n_chars >= 200 THEN 'gs://' || source || '/' || lang || '/part-' || CAST(n_chars % 100 AS VARCHAR) || '.csv' END AS path,
       CASE WHEN n_chars >= 200 THEN 'main' ELSE 'error' END AS tag,
       CASE WHEN n_chars >= 200 THEN NULL ELSE 'no objectId' END AS reason
FROM documents""",
    "text_lines": "SELECT unnest(string_split(text, chr(10))) AS line FROM documents",
    "text_lines_keyed": f"""
WITH {_ORDER_TEXT}
SELECT true AS keyed, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM o""",
    "csv_quoted": CSV_QUOTED,
    "csv_quoted_split": CSV_QUOTED,
    "csv_strict": f"""
WITH {_ORDER_TEXT}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM o WHERE number % 10 <> 0""",
    "csv_naive": f"""
WITH {_ORDER_TEXT}
SELECT CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'main' END AS tag,
       concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                 CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END) AS record,
       o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority
FROM o""",
    "csv_json": """
SELECT 'main' AS tag, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, NULL AS s_name, NULL AS s_suppkey, NULL AS s_nationkey,
       NULL AS s_acctbal FROM customer
UNION ALL
SELECT 'main', NULL, NULL, NULL, NULL, NULL, s_name, CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR),
       CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM supplier""",
    "csv_malformed": f"""
WITH {_ORDER_TEXT}
SELECT 'main' AS tag, NULL AS reason, NULL AS record, o_orderkey,
       CASE WHEN number % 7 = 0 THEN '5"' || o_orderpriority
            WHEN number % 11 = 0 THEN 'a "b",' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority,
       o_orderstatus
FROM o
UNION ALL
SELECT 'main', NULL, NULL, o_orderkey, o_orderpriority || chr(10) || chr(10) || ',x', 'F' FROM o WHERE number % 1000 = 3
UNION ALL
SELECT 'error', 'unterminated quote', o_orderkey || ',"' || o_orderpriority || chr(10) || chr(10) || ',x', o_orderkey,
       o_orderpriority || chr(10) || chr(10) || ',x', NULL
FROM o WHERE number % 1000 = 1""",
    "ingest_notifications": f"""
WITH {_ORDER_TEXT}, t AS (
  SELECT o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS price,
         CASE WHEN number % 10 = 0 THEN 'short row'
              WHEN CAST(o_totalprice AS DOUBLE) >= 400000 THEN 'price out of range' ELSE '' END AS why
  FROM o, range(2) r WHERE r.range = 0 OR o_orderstatus = 'O')
SELECT CASE WHEN why = '' THEN 'main' ELSE 'error' END AS tag, status, why AS what, count(*) AS rows,
       CASE WHEN why = '' THEN CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) END AS price
FROM t GROUP BY status, why
UNION ALL SELECT 'error', 'P', 'no such file', NULL, NULL WHERE EXISTS (SELECT 1 FROM o WHERE o_orderstatus = 'P')
UNION ALL SELECT 'trace', status, 'start', 0, NULL FROM t GROUP BY status
UNION ALL SELECT 'trace', status, 'end', count(*), NULL FROM t GROUP BY status
UNION ALL SELECT 'trace', 'none', step, 0, NULL FROM (VALUES ('start'), ('end')) v(step)""",
    "row_to_json": "SELECT * FROM orders",
    "route_tags": f"""
WITH {_ORDER_TEXT}, t AS (
  SELECT CASE WHEN number % 10 = 0 THEN 'short row'
              WHEN CAST(o_totalprice AS DOUBLE) >= 400000 THEN 'price out of range' ELSE '' END AS why FROM o)
SELECT CASE WHEN why = '' THEN 'main' ELSE 'error' END AS tag, why, count(*) AS rows FROM t GROUP BY 1, 2""",
    "file_trace": f"""
WITH {_ORDER_TEXT}
SELECT o_orderstatus AS status, 'end' AS step, count(*) FILTER (WHERE number % 10 <> 0) AS rows,
       count(*) FILTER (WHERE number % 10 = 0) AS errors
FROM o GROUP BY o_orderstatus
UNION ALL SELECT DISTINCT o_orderstatus, 'start', 0, 0 FROM o
UNION ALL SELECT * FROM (VALUES ('none', 'start', 0, 0), ('none', 'end', 0, 0)) v""",
    "union_all": f"""
WITH {_ORDER_TEXT}
SELECT DISTINCT 'trace' AS tag, o_orderstatus || ' ' || step AS message FROM o, (VALUES ('start'), ('end')) v(step)
UNION ALL
SELECT 'error', concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice) FROM o WHERE number % 10 = 0""",
    "key_by_attribute": f"""
WITH {_HOLED}
SELECT event_id, CASE WHEN reason IS NULL THEN 'main' ELSE 'error' END AS tag, reason, group_key, sequence,
       CASE WHEN event_id % 41 > 0 THEN epoch_us(ts) // 1000 END AS publish_millis
FROM (SELECT *, CASE WHEN group_key IS NULL THEN 'no groupKey' WHEN event_id % 41 = 0 THEN 'publishTs is not a number' END AS reason
      FROM ev)""",
    "key_guard": f"""
SELECT strftime(CAST(date_trunc('day', ts) AS TIMESTAMP), {_MILLIS}) AS window_start, event_type, count(*) AS items
FROM events GROUP BY date_trunc('day', ts), event_type""",
    "table_name_parts": """
SELECT 'testdata.' || lower(c_mktsegment) || '.' || replace(c_name, '#', '_') AS full_name, 'testdata' AS project,
       lower(c_mktsegment) AS dataset, replace(c_name, '#', '_') AS table_name
FROM customer""",
    "window_group": WINDOW_GROUP,
    "window_summary": WINDOW_SUMMARY,
    "group_into_batches": EVENT_BATCHES,
    "export_manifest": f"""
WITH {_CUSTOMER_BATCHES}
SELECT 'export-run1-' || c_mktsegment || '-' || CAST(batch_no AS VARCHAR) AS job_name,
       string_agg(c_name, ',' ORDER BY c_custkey) AS tables, 'postgres' AS dest_database,
       'org.postgresql.Driver' AS driver
FROM n GROUP BY c_mktsegment, batch_no""",
    "assign_sequence": f"WITH {_HOLED} SELECT event_id, group_key, sequence FROM ev",
    "seq_base": f"""
WITH {_TRADES}
SELECT channel, base AS sequence, epoch_ms(base_at) AS trade_date, CAST(0 AS DECIMAL(38,2)) AS price FROM b""",
    "seq_late": f"""
WITH {_RELEASES}
SELECT m.channel, m.sequence, strftime(m.came_at, '%Y-%m-%d') AS arrival, m.l_partkey, m.l_suppkey,
       CASE WHEN m.arr = 1 THEN 'base'
            WHEN m.sequence <= b.base OR i.release < m.arr THEN 'late'
            WHEN m.arr > k.arr THEN 'duplicate'
            WHEN i.release IS NOT NULL THEN 'in_order'
            ELSE 'pending' END AS class
FROM m JOIN b ON b.channel = m.channel JOIN k ON k.channel = m.channel AND k.sequence = m.sequence
LEFT JOIN i ON i.channel = m.channel AND i.sequence = m.sequence""",
    "seq_dedup": f"""
WITH {_TRADES}
SELECT channel, sequence, strftime(came_at, '%Y-%m-%d') AS arrival, copies FROM k""",
    "seq_in_order": f"""
WITH {_RELEASES}
SELECT channel, sequence, strftime(came_at, '%Y-%m-%d') AS arrival, strftime(release_at, '%Y-%m-%d') AS release FROM i""",
    "seq_pending": f"""
WITH {_RUNS}
SELECT k.channel, k.sequence, strftime(k.came_at, '%Y-%m-%d') AS arrival
FROM k JOIN e ON e.channel = k.channel WHERE k.sequence > e.run_end""",
    "seq_book": f"""
WITH {_RUNS}
SELECT e.channel, e.run_end AS sequence, epoch_ms(b.base_at) AS trade_date,
       CAST(0.01 * (e.run_end - b.base) AS DECIMAL(38,2)) AS price
FROM e JOIN b ON b.channel = e.channel""",
    "seq_emissions": SEQ_EMISSIONS,
    "seq_ticks": SEQ_TICKS,
    "seq_idle_ticks": f"""
SELECT channel, tick + 1 AS tick_from, following - 1 AS tick_to, remaining AS pending_size,
       remaining_first AS pending_first, pending_last
FROM (SELECT *, lead(tick) OVER (PARTITION BY channel ORDER BY tick) AS following FROM ({SEQ_TICKS}))
WHERE remaining > 0 AND (following IS NULL OR following > tick + 1)""",
    "seq_gaps": f"""
WITH {_TRADES},
g AS (
  SELECT k.channel, k.sequence, lead(k.sequence) OVER (PARTITION BY k.channel ORDER BY k.sequence) AS following
  FROM k JOIN b ON b.channel = k.channel WHERE k.sequence >= b.base
)
SELECT channel, sequence + 1 AS gap_from, following - 1 AS gap_to, following - sequence - 1 AS missing
FROM g WHERE following > sequence + 1""",
    "seq_backfill": f"""
WITH {_RUNS}
SELECT k.channel, min(e.run_end) + 1 AS first, max(k.sequence) AS last
FROM k JOIN e ON e.channel = k.channel WHERE k.sequence > e.run_end GROUP BY k.channel""",
    "distinct_books": f"""
WITH {_RELEASES}
SELECT channel, max(sequence) AS sequence, min(epoch_ms(base_at)) AS trade_date,
       CAST(0.01 * (max(sequence) - min(base)) AS DECIMAL(38,2)) AS price
FROM i GROUP BY channel, release""",
    "bind_types": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "copy_tables": """
SELECT 'testdata.sf.orders' AS source, CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS name FROM orders UNION ALL
SELECT 'testdata.sf.nation' AS source, CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation
UNION ALL SELECT 'testdata.sf.region', CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT 'testdata.sf.customer', CAST(c_custkey AS VARCHAR), c_name FROM customer
UNION ALL SELECT 'testdata.sf.supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
    "load_truncate": f"""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, {_STAMP} AS df_ts, true AS created FROM customer""",
    "load_append": LOAD_APPEND,
    "default_columns": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS df_ts, true AS created FROM customer""",
    "scalar_functions": f"""
SELECT event_id, 'events_' || CAST(event_id AS VARCHAR) AS table_name,
       event_type || ',' || CAST(user_id AS VARCHAR) AS joined, event_type AS first_part, event_type = 'click' AS is_click,
       CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS not_a_number,
       epoch_us(ts) // 1000 AS millis, strftime(ts, {_MILLIS}) AS ts_text, strftime(ts, {_CLOCK}) AS clock,
       CAST(0.01 * event_id AS DECIMAL(38,2)) AS price, event_id + 1 = user_id AS follows, event_type AS map_value,
       CAST(event_id AS VARCHAR) AS json_id, props AS decoded, md5(CAST(event_id AS VARCHAR)) AS row_id
FROM events""",
}


def _overflow(jump_to_pending: bool, exceeded: str = "len(pending) > 2") -> str:
    """The overflow rule one arrival at a time: step n handles the n-th arrival of every channel."""
    if jump_to_pending:
        target = "list_min(waiting)"
        reached = "coalesce(list_min(list_filter(range(list_min(waiting) + 1, list_max(waiting) + 2), lambda x: NOT list_contains(waiting, x))), 0) - 1"
        left = "list_filter(waiting, lambda x: x > reached)"
    else:
        target = "sequence"
        reached = "sequence"
        left = "list_filter(waiting, lambda x: false)"
    return f"""
WITH RECURSIVE {_TRADES},
s AS (
  SELECT channel, 1 AS arr, sequence AS book, CAST([] AS BIGINT[]) AS pending, CAST(0 AS BIGINT) AS trades,
         '' AS kind, CAST(0 AS BIGINT) AS released, came_at, came_at AS advanced_at, CAST(NULL AS BIGINT) AS skipped_from, CAST(NULL AS BIGINT) AS skipped_to
  FROM m WHERE arr = 1
  UNION ALL
  SELECT channel, arr, CASE kind WHEN 'book' THEN run_end WHEN 'overflow' THEN reached ELSE book END,
         CASE kind WHEN 'book' THEN list_filter(waiting, lambda x: x > run_end) WHEN 'overflow' THEN left_over ELSE waiting END,
         trades + released, kind, released, came_at, CASE WHEN kind = '' THEN advanced_at ELSE came_at END,
         CASE WHEN kind = 'overflow' THEN book + 1 END, CASE WHEN kind = 'overflow' THEN target - 1 END
  FROM (
    SELECT *, CASE kind WHEN 'book' THEN run_end - book WHEN 'overflow' THEN reached - target + 1 ELSE 0 END AS released,
           {left} AS left_over
    FROM (
      SELECT *, {target} AS target, {reached} AS reached,
             CASE WHEN NOT fresh THEN '' WHEN sequence = book + 1 THEN 'book' WHEN {exceeded} THEN 'overflow' ELSE '' END AS kind,
             list_min(list_filter(range(book + 1, list_max(list_append(waiting, book)) + 2), lambda x: NOT list_contains(waiting, x))) - 1 AS run_end
      FROM (
        SELECT s.channel, m.arr, s.book, s.pending, s.trades, m.sequence, m.came_at, s.advanced_at,
               m.sequence > s.book AND NOT list_contains(s.pending, m.sequence) AS fresh,
               CASE WHEN m.sequence > s.book AND NOT list_contains(s.pending, m.sequence)
                    THEN list_append(s.pending, m.sequence) ELSE s.pending END AS waiting
        FROM s JOIN m ON m.channel = s.channel AND m.arr = s.arr + 1
      )
    )
  )
)
SELECT channel, kind, book AS sequence, CAST(0.01 * trades AS DECIMAL(38,2)) AS price, released,
       strftime(came_at, '%Y-%m-%d') AS at, skipped_from, skipped_to, list_max(pending) AS pending_last,
       CAST(len(pending) AS BIGINT) AS remaining
FROM s WHERE kind <> ''
"""


STREAM: dict[str, str] = {
    "stream_seq_book": SEQ_EMISSIONS,
    "seq_overflow": _overflow(jump_to_pending=False),
    "seq_overflow_pending": _overflow(jump_to_pending=True),
    "seq_overflow_age": _overflow(jump_to_pending=True, exceeded="came_at - advanced_at > INTERVAL 360 DAY"),
    "stream_window_summary": WINDOW_SUMMARY,
    "stream_window_group": WINDOW_GROUP,
    "stream_group_into_batches": EVENT_BATCHES,
    "stream_load_append": f"""
SELECT id, name, {_STAMP} AS df_ts, true AS created FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier
)""",
}
