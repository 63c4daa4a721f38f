"""The catalogue's queries as plain SQL over the benchmark tables."""

from __future__ import annotations

BRANCHES = """
    SELECT CAST(s_suppkey AS VARCHAR) AS branch, CAST(s_nationkey % 3 AS VARCHAR) AS company
    FROM supplier WHERE s_suppkey % 10 <> 7
"""

MOVEMENTS = """
    SELECT CAST(l_suppkey AS VARCHAR) AS branch, CAST(l_partkey AS VARCHAR) AS sku,
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value,
           CAST(epoch_ms(l_shipdate) AS BIGINT) AS ts_ms
    FROM lineitem
"""

ENRICHED = f"""
    SELECT m.branch, b.company, m.sku, m.value, m.ts_ms
    FROM ({MOVEMENTS}) m JOIN ({BRANCHES}) b ON m.branch = b.branch
"""

COUNTERS = f"""
    SELECT branch || '|' || company || '|' || sku AS counter_key, CAST(sum(CAST(value AS BIGINT)) AS BIGINT) AS total
    FROM ({ENRICHED}) WHERE company = '1' GROUP BY 1
"""

EVENTS = """
    SELECT user_id AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS experiment_id,
           event_type AS variant, ts AS timestamp, date_trunc('minute', ts) AS minute
    FROM events
"""

AXIS = """
    SELECT (SELECT date_trunc('minute', max(ts)) FROM events) - to_minutes(i) AS timestamp FROM range(1, 1441) r(i)
"""


def _report(metric: str) -> str:
    return f"""
        SELECT a.timestamp, CAST(COALESCE(m.metric, 0) AS DOUBLE) AS metric
        FROM ({AXIS}) a LEFT JOIN (SELECT minute, {metric} AS metric FROM ({EVENTS}) GROUP BY 1) m
        ON a.timestamp = m.minute
    """


SETS = """
    SELECT DISTINCT 'set_var_' || o_orderpriority AS set_key, CAST(o_custkey AS VARCHAR) AS member FROM orders
"""

VARIANTS = "SELECT DISTINCT o_orderpriority AS variant FROM orders"

PAIRS = f"""
    SELECT a.variant AS dim_a, b.variant AS dim_b FROM ({VARIANTS}) a JOIN ({VARIANTS}) b ON a.variant < b.variant
"""

MEMBERS = f"""
    SELECT substr(a.set_key, 9) AS dim_a, substr(b.set_key, 9) AS dim_b, a.member
    FROM ({SETS}) a JOIN ({SETS}) b ON a.member = b.member AND a.set_key < b.set_key
"""


def _overlap(pairs: str, members: str) -> str:
    return f"""
        SELECT p.dim_a, p.dim_b, CAST(count(m.member) AS DOUBLE) AS metric
        FROM ({pairs}) p LEFT JOIN ({members}) m ON p.dim_a = m.dim_a AND p.dim_b = m.dim_b GROUP BY 1, 2
    """


OVERLAP = _overlap(PAIRS, MEMBERS)

EVENT_VARIANTS = "SELECT DISTINCT event_type AS variant FROM events"
EVENT_PAIRS = f"""
    SELECT a.variant AS dim_a, b.variant AS dim_b
    FROM ({EVENT_VARIANTS}) a JOIN ({EVENT_VARIANTS}) b ON a.variant < b.variant
"""
EVENT_MEMBERS = """
    WITH users AS (SELECT DISTINCT event_type AS variant, user_id AS member FROM events)
    SELECT a.variant AS dim_a, b.variant AS dim_b, a.member
    FROM users a JOIN users b ON a.member = b.member AND a.variant < b.variant
"""

# The variants of the orders table, which are the columns of the matrix.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
MATRIX_COLUMNS = ", ".join(f"max(CASE WHEN dim_b = '{p}' THEN metric END) AS \"{p}\"" for p in PRIORITIES)

WINDOW = "time_bucket(INTERVAL 10 HOUR, ts, TIMESTAMP '1970-01-01')"


def _snapshots(which: str) -> str:
    return f"""
        WITH moves AS (SELECT event_id, CAST(user_id % 10 AS VARCHAR) AS branch, {WINDOW} AS w FROM events),
        numbered AS (SELECT DISTINCT branch, w, CAST(epoch(w) AS BIGINT) // 36000 AS n FROM moves WHERE branch <> '9'),
        snapshots AS (SELECT branch, w, CAST((CAST(branch AS BIGINT) + n) % 3 AS VARCHAR) AS company
                      FROM numbered WHERE {which})
    """


SQL = {
    "event_source": """
        SELECT CASE l_linenumber % 3 WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'r' END AS op, count(*) AS n
        FROM lineitem GROUP BY 1
    """,
    "cdc_parse": f"SELECT branch, '' AS company, sku, value, ts_ms FROM ({MOVEMENTS})",
    "cdc_rejects": """
        SELECT CASE WHEN l_orderkey % 10 < 2 THEN 'malformed' WHEN l_orderkey % 10 = 2 THEN 'unknown_field'
                    WHEN l_orderkey % 10 < 5 THEN 'missing_field' ELSE 'bad_value' END AS reason, count(*) AS n
        FROM lineitem WHERE l_orderkey % 10 < 6 GROUP BY 1
    """,
    "web_event_parse": f"""
        SELECT uid, experiment_id, variant, date_trunc('second', timestamp) AS timestamp FROM ({EVENTS})
    """,
    "lookup_scan": BRANCHES,
    "lookup_duplicates": """
        SELECT CAST(s_nationkey % 3 AS VARCHAR) AS branch, count(*) AS n FROM supplier GROUP BY 1 HAVING count(*) > 1
    """,
    "enrich_company": ENRICHED,
    "enrich_company_shuffled": ENRICHED,
    "enrich_company_bucketed": ENRICHED,
    "lookup_misses": f"""
        SELECT branch, sku, value, ts_ms FROM ({MOVEMENTS}) m
        WHERE NOT EXISTS (SELECT 1 FROM ({BRANCHES}) b WHERE b.branch = m.branch)
    """,
    "tumbling_10h": f"SELECT {WINDOW} AS window_start, count(*) AS n FROM events GROUP BY 1",
    "enrich_windowed_snapshot": f"""
        {_snapshots("true")}
        SELECT m.event_id, m.branch, s.company FROM moves m JOIN snapshots s ON m.branch = s.branch AND m.w = s.w
    """,
    "enrich_previous_snapshot": f"""
        {_snapshots("n % 5 < 3")},
        resolved AS (SELECT e.w, max(s.w) AS taken
                     FROM (SELECT DISTINCT w FROM moves) e JOIN (SELECT DISTINCT w FROM snapshots) s ON s.w <= e.w
                     GROUP BY 1)
        SELECT m.event_id, m.branch, s.company
        FROM moves m JOIN resolved r ON m.w = r.w JOIN snapshots s ON m.branch = s.branch AND s.w = r.taken
    """,
    "enrich_branch_asof": f"""
        {_snapshots("(CAST(branch AS BIGINT) + n) % 5 < 3")}
        SELECT m.event_id, m.branch, s.company FROM moves m ASOF JOIN snapshots s ON m.branch = s.branch AND m.w >= s.w
    """,
    "route_by_company": f"""
        SELECT CASE WHEN company = '1' THEN 0 ELSE 1 END AS route, count(*) AS n FROM ({ENRICHED}) GROUP BY 1
    """,
    "stock_movement": COUNTERS,
    "stock_movement_shuffled": COUNTERS,
    "counter_merge": COUNTERS,
    "counter_lookup": f"""
        SELECT CAST(place AS INTEGER) AS place, k AS counter_key, coalesce(total, 0) AS total
        FROM (SELECT row_number() OVER (ORDER BY k) - 1 AS place, k
              FROM (SELECT DISTINCT l_suppkey || '|1|' || l_partkey AS k FROM lineitem) ORDER BY k LIMIT 100)
        LEFT JOIN ({COUNTERS}) ON counter_key = k
    """,
    "minute_keys": """
        SELECT event_id, date_trunc('minute', ts) AS minute, strftime(ts, 'visitCounter_%Y_%m_%dT%H_%M') AS visits_key,
               strftime(ts, 'hll_dthr_%Y_%m_%dT%H_%M') AS users_key,
               strftime(ts, 'set_experiments_experiments_%Y_%m_%dT%H_%M') AS experiments_key
        FROM events
    """,
    "trailing_spine": AXIS,
    "nil_to_zero": """
        SELECT event_id, CAST(CASE WHEN event_id % 3 = 2 THEN user_id ELSE 0 END AS INTEGER) AS metric FROM events
    """,
    "visits_per_minute": _report("count(*)"),
    "users_per_minute": _report("count(DISTINCT uid)"),
    "experiments_per_minute": _report("count(DISTINCT experiment_id)"),
    "experiments_bitmap_per_minute": _report("count(DISTINCT experiment_id)"),
    "users_per_day_approx": """
        SELECT date_trunc('day', ts) AS day, count(DISTINCT user_id) AS exact, true AS within_3pct
        FROM events GROUP BY 1
    """,
    "metric_partials": f"""
        SELECT minute, 'visits' AS family, count(*) AS n FROM ({EVENTS}) GROUP BY 1
        UNION ALL SELECT minute, 'users', count(DISTINCT uid) FROM ({EVENTS}) GROUP BY 1
        UNION ALL SELECT minute, 'experiments', count(DISTINCT experiment_id) FROM ({EVENTS}) GROUP BY 1
    """,
    "fold_merge": f"SELECT minute, count(*) AS visits FROM ({EVENTS}) GROUP BY 1",
    "variant_users": SETS,
    "variant_discovery": VARIANTS,
    "variant_pairs": PAIRS,
    "variant_overlap": OVERLAP,
    "variant_intersect": f"""
        SELECT member FROM ({SETS}) WHERE set_key = 'set_var_1-URGENT'
        INTERSECT SELECT member FROM ({SETS}) WHERE set_key = 'set_var_5-LOW'
    """,
    "overlap_members": f"""
        SELECT 'overlap_-set_var_' || dim_a || '-set_var_' || dim_b AS overlap_key, member FROM ({MEMBERS})
    """,
    "overlap_dimensions": f"SELECT dim_a AS dimension FROM ({OVERLAP}) UNION SELECT dim_b FROM ({OVERLAP})",
    "overlap_matrix": f"SELECT dim_a AS variant, {MATRIX_COLUMNS} FROM ({OVERLAP}) GROUP BY 1",
    "variant_overlap_sketch": f"SELECT *, true AS within_5pct FROM ({OVERLAP})",
    "conversion_ordered": f"""
        WITH f AS (SELECT experiment_id, uid, variant, min(timestamp) AS first, max(timestamp) AS last FROM ({EVENTS})
                   WHERE uid IS NOT NULL AND variant IS NOT NULL GROUP BY ALL),
        g AS (SELECT experiment_id, uid, last FROM f WHERE variant = 'purchase')
        SELECT f.experiment_id, variant, count(*) AS users, count(*) FILTER (g.last > f.first) AS converted,
               count(*) FILTER (g.last > f.first) / count(*) AS rate
        FROM f LEFT JOIN g ON f.experiment_id IS NOT DISTINCT FROM g.experiment_id AND f.uid = g.uid
        WHERE variant <> 'purchase' GROUP BY 1, 2
    """,
    "experiment_conversion": f"""
        SELECT experiment_id, count(DISTINCT uid) AS users,
               count(DISTINCT CASE WHEN variant = 'purchase' THEN uid END) AS converted,
               count(DISTINCT CASE WHEN variant = 'purchase' THEN uid END) / count(DISTINCT uid) AS rate
        FROM ({EVENTS}) GROUP BY 1
    """,
    "stream_stock_movement": COUNTERS,
    "stream_visits_per_minute": _report("count(*)"),
    "stream_users_per_minute": _report("count(DISTINCT uid)"),
    "stream_experiments_per_minute": _report("count(DISTINCT experiment_id)"),
    "stream_variant_overlap": _overlap(EVENT_PAIRS, EVENT_MEMBERS),
    "stream_overlap_incremental": OVERLAP,
    "stream_counters_stateful": COUNTERS,
    "stream_redelivered": COUNTERS,
    "stream_late_rows": """
        WITH e AS (SELECT ts, date_trunc('minute', ts) AS minute,
                   CASE WHEN event_id % 10 = 3 THEN 2 WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS part FROM events),
        before AS (SELECT p.part, max(ts) AS newest FROM (SELECT DISTINCT part FROM e) p LEFT JOIN e ON e.part < p.part GROUP BY 1),
        told AS (SELECT minute, coalesce(minute + INTERVAL 1 MINUTE <= newest - INTERVAL 1 HOUR, false) AS late FROM e JOIN before USING (part))
        SELECT minute, count(*) FILTER (NOT late) AS on_time, count(*) FILTER (late) AS late FROM told GROUP BY 1
    """,
    "users_approx_large": """
        SELECT l_linestatus AS status, count(DISTINCT l_orderkey) AS exact, true AS within_3pct FROM lineitem GROUP BY 1
    """,
    "overlap_points": f"SELECT dim_a || '|' || dim_b AS dimensions, metric FROM ({OVERLAP})",
    "stream_visits_newest_first": f"""
        SELECT row_number() OVER (ORDER BY timestamp DESC) - 1 AS place, timestamp, metric FROM ({_report("count(*)")})
    """,
    "stream_rejects": """
        SELECT 'malformed' AS reason, CASE l_orderkey % 10 WHEN 0 THEN 'order ' || l_orderkey || ' ' || l_linenumber ELSE '' END AS message
        FROM lineitem WHERE l_orderkey % 10 < 2
    """,
    "stream_lookup_refresh": f"""
        SELECT m.branch || '|1|' || m.sku AS counter_key, CAST(sum(CAST(m.value AS BIGINT)) AS BIGINT) AS total
        FROM ({MOVEMENTS}) m JOIN (
            SELECT branch, company FROM ({BRANCHES})
            UNION ALL SELECT branch, CAST((CAST(company AS INTEGER) + 1) % 3 AS VARCHAR) FROM ({BRANCHES})
        ) b ON m.branch = b.branch WHERE b.company = '1' GROUP BY 1
    """,
    "stream_closed_minutes": f"""
        SELECT minute, count(*) AS visits FROM ({EVENTS}) GROUP BY 1
        HAVING minute + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
    """,
}
