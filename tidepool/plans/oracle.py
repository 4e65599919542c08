"""DuckDB SQL equal to each query of ``plans.queries`` (the correctness oracle).

Written independently as plain SQL over the driver's tables: window
functions where the Spark side uses chunked scans, direct sliding windows
where it uses panes, and so on.  Column names match the Spark output.
"""

EV = """ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                 CAST(round(value * 100) AS BIGINT) AS cents FROM events)"""

ARR = """arr AS (SELECT event_id, ts, user_id, event_type,
                   ts + to_seconds(CAST((event_id * 37) % 3600 AS BIGINT)) AS arrival FROM events)"""

LI_W = "PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey"

TRACE = f"""{ARR},
 tr AS (SELECT *, row_number() OVER (ORDER BY arrival, event_id) AS arrival_pos,
          max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mx,
          max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mxb
        FROM arr),
 tw AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
          time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
          coalesce(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND
                   + INTERVAL 20 MINUTE <= mxb - INTERVAL 10 MINUTE, false) AS is_late
        FROM tr)"""

ORACLE = {
    "word_count": """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
toks AS (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM lines
         WHERE NOT (length(line) > 0 AND length(replace(line, ' ', '')) = 0))
SELECT word, CAST(count(*) AS BIGINT) AS count FROM toks GROUP BY word""",

    "word_count_rolling": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS line_no
  FROM documents),
toks AS (
  SELECT doc_id, line_no, unnest(string_split(rtrim(line, ' '), ' ')) AS word,
         CAST(generate_subscripts(string_split(rtrim(line, ' '), ' '), 1) AS BIGINT) AS token_pos
  FROM lines WHERE NOT (length(line) > 0 AND length(replace(line, ' ', '')) = 0))
SELECT doc_id, line_no, token_pos, word,
       row_number() OVER (PARTITION BY word ORDER BY doc_id, line_no, token_pos) AS count
FROM toks""",

    "page_views_flatmap": """
SELECT 'view' AS event_type, CAST(count(*) AS BIGINT) AS count FROM events WHERE event_type = 'view'""",

    "page_views": """
SELECT 'view' AS event_type, count(*) AS count FROM events WHERE event_type = 'view'""",

    "page_views_rolling": """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS count
FROM events WHERE event_type = 'view'""",

    "page_views_hourly": """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS count
FROM events WHERE event_type = 'view' GROUP BY 1, 2""",

    "unique_visitors": """
SELECT count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view'""",

    "unique_visitors_rolling": """
WITH v AS (SELECT event_id, ts, user_id,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
           FROM events WHERE event_type = 'view')
SELECT event_id, CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END)
         OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS uv
FROM v""",

    "unique_visitors_hourly": """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1, 2""",

    "app_marketing": f"""
WITH {EV}
SELECT 'ch' || CAST(k % 4 AS VARCHAR) || '_' || event_type AS key, count(*) AS count
FROM ev GROUP BY 1""",

    "app_marketing_no_channel": """
SELECT event_type AS key, count(*) AS count FROM events GROUP BY 1""",

    "ad_clicks": """
SELECT c.c_mktsegment || '_' || CAST(c.c_nationkey AS VARCHAR) AS key, count(*) AS count
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""",

    "hot_items": f"""
WITH {EV},
agg AS (SELECT k AS item_id, time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL '5 minutes'
                 + INTERVAL 1 HOUR AS window_end, count(*) AS item_count
        FROM ev, range(12) t(i) WHERE event_type = 'view' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY item_count DESC, item_id) AS rank
      FROM agg)
SELECT window_end, item_id, item_count, rank FROM r WHERE rank <= 3""",

    "hot_pages": f"""
WITH {EV},
lg AS (SELECT '/' || event_type || '/' || CAST(k AS VARCHAR) AS url,
              time_bucket(INTERVAL 5 SECOND, ts) AS pane FROM ev),
agg AS (SELECT url, pane - i * INTERVAL '5 seconds' + INTERVAL 10 MINUTE AS window_end,
               count(*) AS view_count
        FROM lg, range(120) t(i) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, url) AS rank
      FROM agg)
SELECT window_end, url, view_count, rank FROM r WHERE rank <= 3""",

    "rolling_sum": f"""
SELECT l_suppkey, row_number() OVER w AS pos, first_value(l_orderkey) OVER w AS l_orderkey,
       first_value(l_shipdate) OVER w AS l_shipdate, sum(l_quantity) OVER w AS l_quantity
FROM lineitem WINDOW w AS ({LI_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",

    "rolling_max": f"""
SELECT l_suppkey, row_number() OVER w AS pos, first_value(l_orderkey) OVER w AS l_orderkey,
       first_value(l_shipdate) OVER w AS l_shipdate, max(l_quantity) OVER w AS l_quantity
FROM lineitem WINDOW w AS ({LI_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",

    "rolling_min": f"""
SELECT l_suppkey, row_number() OVER w AS pos, first_value(l_orderkey) OVER w AS l_orderkey,
       first_value(l_shipdate) OVER w AS l_shipdate, min(l_quantity) OVER w AS l_quantity
FROM lineitem WINDOW w AS ({LI_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",

    "rolling_reduce": f"""
WITH r AS (SELECT l_suppkey, row_number() OVER w AS pos, l_orderkey, l_quantity,
             sum(l_quantity) OVER w AS acc
           FROM lineitem WINDOW w AS ({LI_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT l_suppkey, pos,
       CASE WHEN pos = 1 THEN 'supp_' || CAST(l_suppkey AS VARCHAR) ELSE 'aaa' END AS sid,
       CASE WHEN pos = 1 THEN l_orderkey ELSE 123 END AS code,
       CASE WHEN pos = 1 THEN l_quantity ELSE acc END AS qty
FROM r""",

    "rolling_count": f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER ({LI_W}) AS count
FROM lineitem""",

    "rolling_distinct": f"""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey
                      ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn FROM lineitem)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey,
       CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END)
            OVER ({LI_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS distinct_count
FROM f""",

    "filter_project": """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(1 AS BIGINT) AS one
FROM lineitem WHERE l_returnflag = 'R'""",

    "explode_map": """
SELECT l_orderkey, l_linenumber, l_partkey, -x + 10 + 1 AS value
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
             unnest([CAST(l_quantity AS INTEGER), l_linenumber]) AS x FROM lineitem)""",

    "connect_map": """
SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS value, 'left' AS source
FROM lineitem
UNION ALL
SELECT CAST(p_size + 10 AS VARCHAR) AS value, 'right' AS source FROM part""",

    "union_all": """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R'""",

    "label_split": """
WITH lab AS (SELECT CASE WHEN l_quantity < 10 THEN ['small', 'cheap']
                         WHEN l_quantity < 40 THEN ['medium'] ELSE ['large'] END AS labels
             FROM lineitem)
SELECT label, count(*) AS count FROM (SELECT unnest(labels) AS label FROM lab) GROUP BY label""",

    "select_label": """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity < 10 OR l_quantity >= 40""",

    "side_output": """
SELECT 'main' AS stream, l_orderkey, l_linenumber, CAST(NULL AS VARCHAR) AS message FROM lineitem
UNION ALL
SELECT 'side', l_orderkey, l_linenumber,
       'quantity ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' above 45'
FROM lineitem WHERE l_quantity > 45""",

    "redistribute": """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem""",

    "tumbling": f"""
WITH {EV}
SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS count, CAST(sum(cents) AS BIGINT) AS cents
FROM ev GROUP BY 1, 2, 3""",

    "sliding": f"""
WITH {EV}
SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) - i * INTERVAL '30 minutes' AS window_start,
       time_bucket(INTERVAL 30 MINUTE, ts) - i * INTERVAL '30 minutes' + INTERVAL 2 HOUR AS window_end,
       count(*) AS count, CAST(sum(cents) AS BIGINT) AS cents
FROM ev, range(4) t(i) GROUP BY 1, 2, 3""",

    "sliding_distinct": """
SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL '5 minutes' AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL '5 minutes' + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT user_id) AS uv, count(*) AS count
FROM events, range(12) t(i) GROUP BY 1, 2, 3""",

    "sliding_extrema": f"""
WITH {EV},
w AS (SELECT event_type, time_bucket(INTERVAL 5 SECOND, ts) - i * INTERVAL '5 seconds' AS ws,
             max(cents) AS high, min(cents) AS low, sum(cents) AS cents
      FROM ev, range(120) t(i) GROUP BY 1, 2)
SELECT event_type, date_trunc('hour', ws) AS hour, count(*) AS windows, CAST(sum(high) AS BIGINT) AS high,
       CAST(sum(low) AS BIGINT) AS low, CAST(sum(cents) AS BIGINT) AS cents
FROM w GROUP BY 1, 2""",

    "read_lines": """
SELECT concat_ws(',', event_id, user_id, event_type) AS value FROM events""",

    "read_records": f"""
WITH {EV} SELECT 'user_' || user_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, CAST(k AS INTEGER) AS vc FROM ev""",

    "upsert_hash": f"""
WITH {EV} SELECT CAST(user_id AS VARCHAR) AS field, last(cents ORDER BY ts, event_id) AS cents FROM ev GROUP BY user_id""",

    "index_docs": """
SELECT concat_ws(',', o_orderkey, o_custkey) AS data FROM orders""",

    "fan_out": f"""
WITH {EV}
SELECT 'errors' AS output, event_id FROM ev WHERE event_type = 'error'
UNION ALL SELECT 'large', event_id FROM ev WHERE cents >= 5000
UNION ALL SELECT 'all', event_id FROM ev""",

    "rolling_fold": f"""
WITH {EV},
s AS (SELECT user_id, event_id, ts, sum(CASE event_type WHEN 'purchase' THEN cents WHEN 'error' THEN -cents ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM ev)
SELECT user_id, event_id, CAST(s - least(0, min(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
       AS BIGINT) AS balance FROM s""",

    "window_reduce": f"""
WITH {EV}
SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       string_agg(event_type[1], '' ORDER BY ts, event_id) AS kinds, last(cents ORDER BY ts, event_id) AS cents, count(*) AS count
FROM ev GROUP BY 1, 2""",

    "session": f"""
WITH {EV},
g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM ev),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
          OVER (PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end,
       count(*) AS count, CAST(sum(cents) AS BIGINT) AS cents
FROM s GROUP BY user_id, sid""",

    "count_window": f"""
WITH {EV},
r AS (SELECT user_id, row_number() OVER w AS pos,
             sum(cents) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS s
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, pos, least(pos, 5) AS n, CAST(s AS BIGINT) AS sum FROM r WHERE pos % 3 = 0""",

    "count_window_tumbling": f"""
WITH {EV},
r AS (SELECT user_id, row_number() OVER w AS pos,
             sum(cents) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS s
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, pos, least(pos, 5) AS n, CAST(s AS BIGINT) AS sum FROM r WHERE pos % 5 = 0""",

    "window_all": f"""
WITH {EV}
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       count(*) AS count, CAST(sum(cents) AS BIGINT) AS cents
FROM ev GROUP BY 1, 2""",

    "window_all_count": f"""
WITH {EV},
r AS (SELECT row_number() OVER w AS pos,
             sum(cents) OVER (w ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS s
      FROM ev WINDOW w AS (ORDER BY ts, event_id))
SELECT pos, least(pos, 1000) AS n, CAST(s AS BIGINT) AS sum FROM r WHERE pos % 1000 = 0""",

    "window_distinct": """
SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(DISTINCT user_id) AS uv
FROM events GROUP BY 1, 2, 3""",

    "window_with_end": """
SELECT event_type,
       time_bucket(INTERVAL 15 MINUTE, ts) - i * INTERVAL '15 minutes' + INTERVAL 1 HOUR AS window_end,
       count(*) AS count
FROM events, range(4) t(i) GROUP BY 1, 2""",

    "watermark_trace": f"""
WITH {TRACE}
SELECT event_id, arrival_pos, mxb - INTERVAL 10 MINUTE AS wm_before, mx - INTERVAL 10 MINUTE AS wm_after
FROM tr""",

    "late_side_output": f"""
WITH {TRACE}
SELECT event_id, window_start, mxb - INTERVAL 10 MINUTE AS wm_before FROM tw WHERE is_late""",

    "window_firings": f"""
WITH {TRACE},
acc AS (SELECT * FROM tw WHERE NOT is_late),
wins AS (SELECT DISTINCT window_start, window_end FROM acc),
fire AS (SELECT w.window_start, w.window_end, min(t.arrival_pos) AS fire_pos
         FROM wins w LEFT JOIN tr t
           ON t.mx - INTERVAL 10 MINUTE >= w.window_end - INTERVAL 1 MILLISECOND
         GROUP BY 1, 2),
j AS (SELECT acc.*, fire.fire_pos FROM acc JOIN fire USING (window_start, window_end)),
on_time AS (SELECT window_start, window_end, 'on_time' AS kind, fire_pos, count(*) AS count
            FROM j WHERE fire_pos IS NOT NULL AND arrival_pos <= fire_pos
            GROUP BY window_start, window_end, fire_pos),
late AS (SELECT window_start, window_end, 'late' AS kind, arrival_pos AS fire_pos, cnt AS count
         FROM (SELECT *, count(*) OVER (PARTITION BY window_start ORDER BY arrival_pos) AS cnt
               FROM j WHERE fire_pos IS NOT NULL)
         WHERE arrival_pos > fire_pos),
ends AS (SELECT window_start, window_end, 'end' AS kind, CAST(NULL AS BIGINT) AS fire_pos,
                count(*) AS count FROM j WHERE fire_pos IS NULL GROUP BY 1, 2)
SELECT * FROM on_time UNION ALL SELECT * FROM late UNION ALL SELECT * FROM ends""",

    "previous_value": f"""
WITH {EV}
SELECT event_id, user_id, cents, lag(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous
FROM ev""",

    "one_shot_timer": """
SELECT user_id, min(ts) + INTERVAL 5 SECOND AS fire_time FROM events GROUP BY user_id""",

    "timer_each": """
SELECT DISTINCT user_id, ts + INTERVAL 5 SECOND AS fire_time FROM events""",

    "reconcile": """
WITH o AS (SELECT o_orderkey AS orderkey, o_orderdate,
             row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate) AS n FROM orders),
l AS (SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, l_suppkey,
        row_number() OVER (PARTITION BY l_orderkey
                           ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem)
SELECT coalesce(o.orderkey, l.orderkey) AS orderkey, coalesce(o.n, l.n) AS n,
       CASE WHEN o.orderkey IS NULL THEN 'right_only' WHEN l.orderkey IS NULL THEN 'left_only'
            ELSE 'matched' END AS status,
       o.o_orderdate, l.l_linenumber, l.l_partkey, l.l_suppkey
FROM o FULL OUTER JOIN l ON o.orderkey = l.orderkey AND o.n = l.n""",

    "interval_join": """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_partkey, l.l_shipdate
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
 AND l.l_shipdate >= o.o_orderdate - INTERVAL 5 DAY AND l.l_shipdate <= o.o_orderdate + INTERVAL 15 DAY""",

    "pattern_where_or": """
SELECT event_id, user_id, event_type FROM events
WHERE (event_type = 'purchase' AND value >= 400) OR event_type = 'signup'""",

    "pattern_next": """
WITH s AS (SELECT user_id, event_id, event_type,
             lead(event_id) OVER w AS nid, lead(event_type) OVER w AS ntype
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id AS first_event_id, nid AS second_event_id FROM s
WHERE event_type = 'click' AND ntype = 'click'""",

    "pattern_followed_by": """
WITH s AS (SELECT user_id, event_id, event_type,
             first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
               OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nid
           FROM events)
SELECT user_id, event_id AS first_event_id, nid AS second_event_id FROM s
WHERE event_type = 'view' AND nid IS NOT NULL""",

    "pattern_followed_by_any": """
SELECT a.user_id, a.event_id AS first_event_id, b.event_id AS second_event_id
FROM events a JOIN events b ON a.user_id = b.user_id
 AND (b.ts > a.ts OR (b.ts = a.ts AND b.event_id > a.event_id))
 AND b.ts < a.ts + INTERVAL 6 HOUR
WHERE a.event_type = 'click' AND b.event_type = 'purchase'""",

    "pattern_times": """
WITH e AS (SELECT user_id, event_id, ts, event_type,
             lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nid,
             lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ntype
           FROM events),
r AS (SELECT user_id, event_id, ts,
        lead(event_id, 1) OVER w AS id2, lead(ts, 1) OVER w AS ts2,
        lead(event_id, 2) OVER w AS id3, lead(ts, 2) OVER w AS ts3
      FROM events WHERE event_type = 'error'
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT s.user_id, s.event_id AS first_event_id, s.ts AS t0, r.event_id AS id1, r.ts AS ts1,
             r.id2, r.ts2, r.id3, r.ts3
      FROM e s JOIN r ON r.event_id = s.nid
      WHERE s.event_type = 'error' AND s.ntype = 'error')
SELECT user_id, first_event_id, CAST(1 AS BIGINT) AS k, id1 AS last_event_id FROM m
 WHERE ts1 < t0 + INTERVAL 12 HOUR
UNION ALL
SELECT user_id, first_event_id, 2, id2 FROM m WHERE id2 IS NOT NULL AND ts2 < t0 + INTERVAL 12 HOUR
UNION ALL
SELECT user_id, first_event_id, 3, id3 FROM m WHERE id3 IS NOT NULL AND ts3 < t0 + INTERVAL 12 HOUR""",

    "login_fail_alert": """
WITH s AS (SELECT user_id, event_id, ts, event_type,
             lead(event_id) OVER w AS nid, lead(ts) OVER w AS nts, lead(event_type) OVER w AS ntype
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id AS first_event_id, nid AS second_event_id FROM s
WHERE event_type = 'error' AND ntype = 'error' AND nts < ts + INTERVAL 1 HOUR""",

    "order_pay": """
WITH s AS (SELECT user_id, event_id, ts, event_type,
             first_value(CASE WHEN event_type = 'purchase' THEN struct_pack(id := event_id, t := ts) END
                         IGNORE NULLS)
               OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx
           FROM events)
SELECT user_id, event_id AS view_event_id, nx.id AS purchase_event_id,
       epoch_us(nx.t) - epoch_us(ts) AS elapsed_us
FROM s WHERE event_type = 'view' AND nx IS NOT NULL AND nx.t < ts + INTERVAL 6 HOUR""",

    "order_timeout": """
WITH s AS (SELECT user_id, event_id, ts, event_type,
             first_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS)
               OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nt
           FROM events)
SELECT user_id, event_id AS view_event_id FROM s
WHERE event_type = 'view' AND (nt IS NULL OR nt >= ts + INTERVAL 6 HOUR)""",

    # the timer rule stepped row by row per user (state: due time, last value)
    "rising_alert": """
WITH RECURSIVE s AS (
  SELECT user_id, ts, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS pv
  FROM events),
r(user_id, rn, timer, fired_t, fired_v, lastv) AS (
  SELECT user_id, rn, CASE WHEN value > pv THEN ts + INTERVAL 6 HOUR END,
         CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), value
  FROM s WHERE rn = 1
  UNION ALL
  SELECT s.user_id, s.rn,
         CASE WHEN r.timer IS NOT NULL AND r.timer >= s.ts
              THEN CASE WHEN s.value > s.pv THEN r.timer END
              ELSE CASE WHEN s.value > s.pv THEN s.ts + INTERVAL 6 HOUR END END,
         CASE WHEN r.timer IS NOT NULL AND r.timer < s.ts THEN r.timer END,
         CASE WHEN r.timer IS NOT NULL AND r.timer < s.ts THEN r.lastv END,
         s.value
  FROM r JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1)
SELECT user_id, fired_t AS fire_time, fired_v AS last_value FROM r WHERE fired_t IS NOT NULL
UNION ALL
SELECT r.user_id, r.timer, r.lastv FROM r
JOIN (SELECT user_id, max(rn) AS mr FROM s GROUP BY 1) m ON r.user_id = m.user_id AND r.rn = m.mr
WHERE r.timer IS NOT NULL""",
}


_LATER = """first_value(CASE WHEN event_type = '{0}' THEN struct_pack(id := event_id, t := ts) END IGNORE NULLS)
               OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""

ORACLE.update({
    "pattern_steps": f"""
WITH s AS (SELECT user_id, event_id, ts, event_type, {_LATER.format('purchase')} AS p, {_LATER.format('error')} AS e
           FROM events)
SELECT a.user_id, a.event_id AS view_event_id, a.p.id AS purchase_event_id, b.e.id AS error_event_id
FROM s a JOIN s b ON b.event_id = a.p.id
WHERE a.event_type = 'view' AND b.e IS NOT NULL AND b.e.t < a.ts + INTERVAL 12 HOUR""",

    "count_window_double": f"""
WITH {EV},
r AS (SELECT user_id, row_number() OVER w AS pos,
             max(CASE WHEN event_id % 3 <> 0 THEN value END) OVER (w ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS highest
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, pos, least(pos, 2) AS n, highest FROM r WHERE pos % 2 = 0""",

    "aggregate_null_keys": f"""
WITH {EV}
SELECT CASE WHEN event_id % 4 <> 0 THEN 9007199254740993 + user_id % 3 END AS key, count(*) AS count,
       CAST(sum(cents) AS BIGINT) AS cents FROM ev GROUP BY 1""",

    "assign_event_time": """
SELECT event_id, date_trunc('milliseconds', ts) AS event_time FROM events""",

    "access_log": f"""
WITH {EV}
SELECT 'GET' AS method, '/' || event_type || '/' || CAST(k AS VARCHAR) AS url,
       date_trunc('hour', ts) AS window_start, count(*) AS views, count(DISTINCT user_id) AS visitors
FROM ev GROUP BY 1, 2, 3""",

    "stream_reconcile": """
WITH o AS (SELECT o_orderkey AS orderkey, o_orderkey AS left_id,
             row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate) AS n FROM orders),
l AS (SELECT l_orderkey AS orderkey, l_linenumber * 1000000000::BIGINT + l_partkey AS right_id,
        row_number() OVER (PARTITION BY l_orderkey
                           ORDER BY l_shipdate, l_linenumber * 1000000000::BIGINT + l_partkey) AS n FROM lineitem)
SELECT coalesce(o.orderkey, l.orderkey) AS orderkey, coalesce(o.n, l.n) AS n, left_id, right_id,
       CASE WHEN o.orderkey IS NULL THEN 'right_only' WHEN l.orderkey IS NULL THEN 'left_only'
            ELSE 'matched' END AS status
FROM o FULL OUTER JOIN l ON o.orderkey = l.orderkey AND o.n = l.n""",

    "stream_rolling_sum": f"""
WITH {EV}
SELECT user_id, row_number() OVER w AS pos, first_value(event_id) OVER w AS first_event_id, event_id,
       CAST(sum(cents) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cents
FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
})

# streaming twins compute the batch twin's result
# micro-batches of five days of arrivals; "before" is what a batch knows of the
# stream's newest event, "cut" the watermark that its late records meet
_LATE = f"""{EV},
arr AS (SELECT event_id, ts, event_type, cents, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
               CAST(floor((epoch(ts) + CASE WHEN (event_id * 7919) % 17 = 0 THEN (event_id * 37) % 15 ELSE 0 END * 86400)
                          / 432000) AS BIGINT) AS b FROM ev),
mx AS (SELECT b, max(ts) AS mx FROM arr GROUP BY b),
mark AS (SELECT b, max(mx) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
                max(mx) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 6 DAY AS cut FROM mx)"""

ORACLE["stream_allowed_lateness"] = f"""
WITH {_LATE},
hit AS (SELECT event_type, window_start, b, before, sum(n) OVER w AS count, sum(cents) OVER w AS cents
        FROM (SELECT event_type, window_start, b, any_value(before) AS before, count(*) AS n, sum(cents) AS cents
              FROM arr JOIN mark USING (b) WHERE cut IS NULL OR window_start + INTERVAL 1 DAY > cut GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY event_type, window_start ORDER BY b ROWS UNBOUNDED PRECEDING)),
st AS (SELECT *, before IS NULL OR before - INTERVAL 1 DAY < window_start + INTERVAL 1 DAY AS open FROM hit),
num AS (SELECT *, row_number() OVER (PARTITION BY event_type, window_start, open ORDER BY b DESC) AS back,
               row_number() OVER (PARTITION BY event_type, window_start, open ORDER BY b) AS nth FROM st)
SELECT event_type, window_start, window_start + INTERVAL 1 DAY AS window_end,
       CASE WHEN open THEN 0 ELSE nth END AS revision, CAST(count AS BIGINT) AS count, CAST(cents AS BIGINT) AS cents
FROM num WHERE NOT open OR back = 1"""

ORACLE["stream_late_split"] = f"""
WITH {_LATE}
SELECT event_id FROM arr JOIN mark USING (b) WHERE window_start + INTERVAL 7 DAY <= before"""

ORACLE["stream_keyed_state"] = """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS times_seen,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS records FROM events"""

ORACLE["stream_processing_time"] = "SELECT event_type, count(*) AS count FROM events GROUP BY event_type"

for _s, _b in {"stream_tumbling": "tumbling", "stream_session": "session",
               "stream_unique_visitors_hourly": "unique_visitors_hourly",
               "stream_hot_items": "hot_items", "stream_word_count": "word_count",
               "stream_rising_alert": "rising_alert", "window_aggregate": "tumbling",
               "stream_interval_join": "interval_join", "stream_previous_value": "previous_value",
               "stream_order_pay": "order_pay", "stream_order_timeout": "order_timeout",
               "stream_one_shot_timer": "one_shot_timer", "stream_hot_pages": "hot_pages",
               "stream_pattern_times": "pattern_times",
               "stream_pattern_followed_by_any": "pattern_followed_by_any", "stream_timer_each": "timer_each",
               "stream_unique_visitors": "unique_visitors_rolling",
               "stream_login_fail_alert": "login_fail_alert", "stream_count_window": "count_window"}.items():
    ORACLE[_s] = ORACLE[_b]
