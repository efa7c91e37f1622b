"""DuckDB SQL with the same meaning as each query of the catalog, over the same tables."""

from __future__ import annotations

USAGE = """
WITH ev AS (
    SELECT event_id, ts, CAST(ts AS DATE) AS event_date, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CASE WHEN user_id % 4 = 0 THEN 3 + (7 * user_id) % 25 END AS churn_day
    FROM events
), st AS (
    SELECT *,
           CASE WHEN event_type <> 'error' THEN 200
                WHEN k % 6 = 0 THEN 429 WHEN k % 6 = 1 THEN 401 WHEN k % 6 = 2 THEN 400
                WHEN k % 6 = 3 THEN 500 WHEN k % 6 = 4 THEN 504 ELSE 503 END AS status_code,
           CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
                WHEN 'signup' THEN 3 ELSE k % 4 END AS e
    FROM ev
), usage AS (
    SELECT event_id, ts AS "timestamp", event_date, user_id,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'enterprise' WHEN 'MACHINERY' THEN 'pro'
                ELSE 'free' END AS user_tier,
           CASE e WHEN 0 THEN '/v1/completions' WHEN 1 THEN '/v1/chat'
                WHEN 2 THEN '/v1/embeddings' ELSE '/v1/classify' END AS endpoint,
           10 * k + 50 AS input_tokens, 4 * k + 50 AS output_tokens, 14 * k + 100 AS total_tokens,
           value AS latency_ms, CAST(status_code AS BIGINT) AS status_code,
           status_code >= 400 AS is_error,
           CASE status_code WHEN 429 THEN 'RateLimitError' WHEN 401 THEN 'AuthenticationError'
                WHEN 400 THEN 'InvalidRequestError' WHEN 500 THEN 'InternalServerError'
                WHEN 504 THEN 'TimeoutError' WHEN 503 THEN 'APIError' END AS error_type,
           status_code = 429 AS rate_limited, r_name AS region,
           churn_day, churn_day IS NOT NULL AS will_churn
    FROM st
    LEFT JOIN customer ON user_id = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
)"""


# The same columns made of the orders.
ORDERS_USAGE = """
WITH placed AS (
    SELECT *, CAST(o_orderdate AS DATE) AS d,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0
                THEN CASE o_orderkey % 6 WHEN 0 THEN 429 WHEN 1 THEN 401 WHEN 2 THEN 400
                     WHEN 3 THEN 500 WHEN 4 THEN 504 ELSE 503 END ELSE 200 END AS code
    FROM orders
), usage AS (
    SELECT o_orderkey AS event_id, CAST(o_orderdate AS TIMESTAMP) AS "timestamp", d AS event_date,
           o_custkey AS user_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'enterprise' WHEN '2-HIGH' THEN 'pro'
                ELSE 'free' END AS user_tier,
           CAST(trunc(o_totalprice / 100) AS BIGINT) AS input_tokens,
           CAST(trunc(o_totalprice / 200) AS BIGINT) AS output_tokens,
           CAST(trunc(o_totalprice / 100) AS BIGINT) + CAST(trunc(o_totalprice / 200) AS BIGINT)
               AS total_tokens,
           o_totalprice / 1000 AS latency_ms, CAST(code AS BIGINT) AS status_code,
           code >= 400 AS is_error, r_name AS region,
           CASE WHEN o_custkey % 4 = 0 THEN 30 + (70 * o_custkey) % 250 END AS churn_day
    FROM placed
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
)"""


def _round(x: str, k: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {k}) AS DOUBLE)"


_ERRORS = "COUNT(*) FILTER (WHERE is_error)"
_PCT = _round(f"CAST({_ERRORS} AS DOUBLE) / COUNT(*) * 100", 2)
_AVG1 = _round("AVG(latency_ms)", 1)
_P95 = _round("quantile_cont(latency_ms, 0.95)", 1)
_LATEST = "WHERE event_date = (SELECT MAX(event_date) FROM usage)"

ORACLES: dict[str, str] = {}


def _usage(name: str, body: str) -> None:
    """Add an oracle over the usage events; a body may go on with further CTEs."""
    body = body.strip()
    ORACLES[name] = f"{USAGE}{body}" if body.startswith(",") else f"{USAGE}\n{body}"


def _orders(name: str, body: str) -> None:
    """The same over the usage made of orders."""
    body = body.strip()
    ORACLES[name] = f"{ORDERS_USAGE}{body}" if body.startswith(",") else f"{ORDERS_USAGE}\n{body}"


_usage("endpoint_metrics", f"""
SELECT endpoint, COUNT(*) AS requests, {_AVG1} AS avg_latency, {_P95} AS p95_latency,
       {_PCT} AS error_pct, COUNT(DISTINCT user_id) AS users
FROM usage GROUP BY endpoint ORDER BY requests DESC, endpoint""")

_usage("current_metrics", f"""
SELECT COUNT(DISTINCT user_id) AS dau, COUNT(*) AS requests,
       {_round(f"CAST({_ERRORS} AS DOUBLE) / COUNT(*)", 4)} AS error_rate,
       {_AVG1} AS avg_latency, {_P95} AS p95_latency, CAST(SUM(total_tokens) AS BIGINT) AS tokens
FROM usage {_LATEST}""")

_usage("narrative_metrics", f"""
SELECT COUNT(DISTINCT user_id) AS dau, COUNT(*) AS total_requests, {_PCT} AS error_rate,
       {_AVG1} AS avg_latency, {_P95} AS p95_latency
FROM usage {_LATEST}""")

_usage("narrative", f"""
, m AS (
SELECT COUNT(DISTINCT user_id) AS dau, COUNT(*) AS n, {_PCT} AS err, {_AVG1} AS av, {_P95} AS p95
FROM usage {_LATEST})
SELECT 'Platform Health Summary:' || chr(10)
    || '- DAU: ' || format('{{:,}}', dau) || chr(10)
    || '- Requests: ' || format('{{:,}}', n) || chr(10)
    || '- Error Rate: ' || printf('%.2f', err) || '%' || chr(10)
    || '- Avg Latency: ' || printf('%.1f', av) || 'ms' || chr(10)
    || '- P95 Latency: ' || printf('%.1f', p95) || 'ms' || chr(10)
    || CASE WHEN err > 5 AND p95 > 1000 THEN 'Above its limit: error rate and P95 latency.'
            WHEN err > 5 THEN 'Above its limit: error rate.'
            WHEN p95 > 1000 THEN 'Above its limit: P95 latency.'
            ELSE 'No figure is above its limit.' END AS narrative
FROM m""")

_TIME_SERIES = f"""
SELECT event_date, COUNT(*) AS requests, COUNT(DISTINCT user_id) AS users, {_AVG1} AS avg_latency,
       {_PCT} AS error_pct, CAST(SUM(total_tokens) AS BIGINT) AS tokens
FROM usage WHERE event_date >= DATE '2024-01-31' - INTERVAL 21 DAY
GROUP BY event_date ORDER BY event_date"""
_usage("time_series", _TIME_SERIES)
_usage("time_series_from_rollup", _TIME_SERIES)

_usage("mark_partial", """
SELECT event_date, COUNT(*) AS requests, event_date >= DATE '2024-01-30' AS is_partial,
       event_date = (SELECT MAX(event_date) FROM usage WHERE event_date < DATE '2024-01-30') AS is_bridge
FROM usage GROUP BY event_date""")

_usage("user_tiers", f"""
SELECT user_tier, COUNT(DISTINCT user_id) AS users, COUNT(*) AS requests, {_AVG1} AS avg_latency,
       {_PCT} AS error_pct
FROM usage GROUP BY user_tier""")

_usage("errors_top", """
SELECT endpoint, error_type, status_code, COUNT(*) AS count, COUNT(DISTINCT user_id) AS users
FROM usage WHERE is_error GROUP BY endpoint, error_type, status_code
ORDER BY count DESC, endpoint, error_type, status_code LIMIT 20""")

_usage("errors_top_5", """
SELECT endpoint, error_type, status_code, COUNT(*) AS count, COUNT(DISTINCT user_id) AS users
FROM usage WHERE is_error GROUP BY endpoint, error_type, status_code
ORDER BY count DESC, endpoint, error_type, status_code LIMIT 5""")

_orders("churn_risk", """
SELECT user_id, user_tier, COUNT(*) AS requests, MAX(event_date) AS last_active
FROM usage GROUP BY user_id, user_tier ORDER BY last_active, user_id, user_tier LIMIT 10""")

_usage("user_day_rollup", f"""
SELECT event_date, user_id, user_tier, region, COUNT(*) AS request_count, {_ERRORS} AS error_count,
       {_round("SUM(latency_ms)", 2)} AS latency_total, COUNT(latency_ms) AS latency_count,
       CAST(SUM(input_tokens) AS BIGINT) AS input_tokens,
       CAST(SUM(output_tokens) AS BIGINT) AS output_tokens,
       CAST(SUM(total_tokens) AS BIGINT) AS total_tokens,
       MAX("timestamp") AS last_timestamp, CAST(MAX(churn_day) AS DOUBLE) AS churn_day
FROM usage GROUP BY event_date, user_id, user_tier, region""")

_usage("dau", "SELECT event_date, COUNT(DISTINCT user_id) AS dau FROM usage GROUP BY event_date")

_usage("token_usage", f"""
SELECT event_date, user_tier, CAST(SUM(input_tokens) AS BIGINT) AS input_tokens,
       CAST(SUM(output_tokens) AS BIGINT) AS output_tokens,
       CAST(SUM(total_tokens) AS BIGINT) AS total_tokens, COUNT(DISTINCT user_id) AS users,
       {_round("CAST(SUM(total_tokens) AS DOUBLE) / COUNT(DISTINCT user_id)", 2)} AS tokens_per_user
FROM usage GROUP BY event_date, user_tier""")

_usage("daily_errors", f"""
SELECT event_date, endpoint, COUNT(*) AS requests, {_ERRORS} AS error_count, {_PCT} AS error_pct
FROM usage GROUP BY event_date, endpoint""")

_usage("daily_tier_panel", """
SELECT event_date, user_tier, COUNT(DISTINCT user_id) AS active_users,
       CAST(SUM(total_tokens) AS BIGINT) AS tokens
FROM usage GROUP BY event_date, user_tier""")

_DAILY = f""", daily AS (
SELECT event_date, AVG(latency_ms) AS avg_latency, {_ERRORS} AS error_count,
       COUNT(*) AS total_requests, CAST({_ERRORS} AS DOUBLE) / COUNT(*) AS error_rate
FROM usage GROUP BY event_date)
"""
_usage("daily_latency_error", f"""{_DAILY}
SELECT event_date, {_round("avg_latency", 6)} AS avg_latency, error_count, total_requests,
       {_round("error_rate", 6)} AS error_rate
FROM daily""")

_ROLLING = f"""{_DAILY}, r AS (
SELECT *, COUNT(*) OVER w AS n, AVG(avg_latency) OVER w AS lm, STDDEV_SAMP(avg_latency) OVER w AS ls,
       AVG(error_rate) OVER w AS em, STDDEV_SAMP(error_rate) OVER w AS es
FROM daily WINDOW w AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
"""
_usage("rolling_features", f"""{_ROLLING}
SELECT event_date, {_round("avg_latency", 6)} AS avg_latency, error_count, total_requests,
       {_round("error_rate", 6)} AS error_rate,
       CASE WHEN n = 7 THEN {_round("lm", 6)} END AS latency_ma7,
       CASE WHEN n = 7 THEN {_round("ls", 6)} END AS latency_std7,
       CASE WHEN n = 7 THEN {_round("em", 6)} END AS error_ma7,
       CASE WHEN n = 7 THEN {_round("es", 6)} END AS error_std7
FROM r""")
_usage("anomaly_features", f"""{_ROLLING}
SELECT event_date, {_round("avg_latency", 6)} AS avg_latency, {_round("error_rate", 6)} AS error_rate,
       {_round("lm", 6)} AS latency_ma7, {_round("em", 6)} AS error_ma7,
       {_round("ls", 6)} AS latency_std7, {_round("es", 6)} AS error_std7
FROM r WHERE n = 7""")

_usage("latest_day", f"SELECT event_id, event_date, user_id FROM usage {_LATEST}")

_usage("newest_sample", """
SELECT event_id, "timestamp", user_id, user_tier, endpoint, latency_ms, status_code,
       input_tokens, output_tokens
FROM usage ORDER BY "timestamp" DESC, event_id DESC LIMIT 10000""")

_usage("newest_100", """
SELECT event_id, "timestamp", user_id FROM usage ORDER BY "timestamp" DESC, event_id DESC LIMIT 100""")

_orders("latest_tier_per_user", """
SELECT user_id, event_date, event_id, user_tier FROM usage
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_date DESC, event_id DESC) = 1""")

_usage("latest_event_per_user", """
SELECT user_id, event_date, "timestamp", event_id, user_tier, endpoint FROM usage
QUALIFY ROW_NUMBER() OVER (
    PARTITION BY user_id ORDER BY event_date DESC, "timestamp" DESC, event_id DESC) = 1""")

_usage("distinct_tiers", "SELECT DISTINCT user_tier FROM usage")

_orders("cohort_retention", """
, f AS (SELECT user_id, CAST(date_trunc('week', MIN(event_date)) AS DATE) AS cohort_week
        FROM usage GROUP BY user_id),
a AS (SELECT user_id, cohort_week,
             date_diff('day', cohort_week, CAST(date_trunc('week', event_date) AS DATE)) // 7
                 AS weeks_since_cohort
      FROM usage JOIN f USING (user_id))
SELECT cohort_week, weeks_since_cohort, COUNT(DISTINCT user_id) AS active_users
FROM a GROUP BY cohort_week, weeks_since_cohort""")

_ORDER_COHORTS = """
WITH f AS (SELECT o_custkey, CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) AS cohort_month
           FROM orders GROUP BY o_custkey),
a AS (SELECT o_custkey, cohort_month,
             date_diff('month', cohort_month, o_orderdate) AS months_since_cohort
      FROM orders JOIN f USING (o_custkey)),
c AS (SELECT cohort_month, months_since_cohort, COUNT(DISTINCT o_custkey) AS active_users
      FROM a WHERE months_since_cohort <= 12 GROUP BY cohort_month, months_since_cohort)
"""
ORACLES["cohort_mart_orders"] = f"{_ORDER_COHORTS.replace('WHERE months_since_cohort <= 12', '')} SELECT * FROM c"
ORACLES["cohort_retention_orders"] = f"{_ORDER_COHORTS} SELECT * FROM c"
ORACLES["cohort_matrix"] = f"{_ORDER_COHORTS} SELECT cohort_month, " + ", ".join(
    f"CAST(MAX(active_users) FILTER (WHERE months_since_cohort = {a}) AS DOUBLE) AS age_{a}"
    for a in range(13)
) + " FROM c GROUP BY cohort_month"

_VISITS = """, v AS (SELECT DISTINCT user_id, event_date, user_tier, region FROM usage),
ret AS (
SELECT *, CASE WHEN EXISTS (
        SELECT 1 FROM v AS n WHERE n.user_id = v.user_id AND n.event_date > v.event_date
        AND n.event_date <= v.event_date + INTERVAL 90 DAY) THEN 1 ELSE 0 END AS retained
FROM v WHERE event_date <= (SELECT MAX(event_date) FROM v) - INTERVAL 90 DAY)
"""
_orders("retained_within", f"""{_VISITS}
SELECT DISTINCT user_id, event_date, CAST(retained AS BIGINT) AS retained FROM ret""")

_usage("conform_events", """
SELECT CAST(event_id AS VARCHAR) AS event_id, "timestamp", CAST(user_id AS VARCHAR) AS user_id,
       user_tier, endpoint, input_tokens, output_tokens, latency_ms, status_code, error_type,
       region, rate_limited, will_churn, CAST(churn_day AS DOUBLE) AS churn_day,
       TRUE AS has_ingested_at
FROM usage""")

_usage("stage_events", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_date, is_error, total_tokens, latency_ms FROM usage""")

ORACLES["wire_rejects"] = """
SELECT CAST(event_id AS VARCHAR) AS sent_id,
       CASE event_id % 10 WHEN 1 THEN 'bad timestamp' WHEN 3 THEN 'no user_id' ELSE 'malformed' END AS reason
FROM events WHERE event_id % 10 < 4"""

_usage("wire_roundtrip", """
SELECT CAST(event_id AS VARCHAR) AS event_id, "timestamp", CAST(user_id AS VARCHAR) AS user_id,
       user_tier, endpoint, CAST(NULL AS VARCHAR) AS model_variant, input_tokens, output_tokens,
       latency_ms, status_code, error_type, '1.3.0' AS sdk_version, region,
       's' || event_id AS session_id, rate_limited, will_churn,
       CAST(churn_day AS DOUBLE) AS churn_day
FROM usage""")

_usage("insert_new", """
SELECT event_id, "timestamp", user_id, latency_ms FROM usage
WHERE "timestamp" >= TIMESTAMP '2024-01-15'""")

_usage("retain_recent", """
SELECT event_id, "timestamp", user_id FROM usage
WHERE "timestamp" >= TIMESTAMP '2024-01-21 12:00:00'""")

_usage("cull_report", """
SELECT COUNT(*) FILTER (WHERE "timestamp" < TIMESTAMP '2024-01-21 12:00:00') AS culled,
       COUNT(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-21 12:00:00') AS kept
FROM usage""")

_SLOTS = """, cal AS (
SELECT UNNEST(generate_series(date_trunc('minute', MIN("timestamp")),
                              date_trunc('minute', MAX("timestamp")), INTERVAL 1 MINUTE)) AS slot
FROM usage),
hit AS (SELECT DISTINCT date_trunc('minute', "timestamp") AS slot FROM usage)
"""
_usage("slot_calendar", f"{_SLOTS} SELECT CAST(slot AS TIMESTAMP) AS slot FROM cal")
_usage("existing_slots", """
SELECT DISTINCT date_trunc('minute', "timestamp") AS slot FROM usage
WHERE "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-20 06:30:00'""")
_usage("missing_slots", f"""{_SLOTS}
SELECT CAST(slot AS TIMESTAMP) AS slot FROM cal WHERE slot NOT IN (SELECT slot FROM hit)
ORDER BY slot""")
_usage("slot_coverage", f"""{_SLOTS}
SELECT COUNT(*) AS expected, COUNT(hit.slot) AS existing, COUNT(*) - COUNT(hit.slot) AS missing
FROM cal LEFT JOIN hit ON cal.slot = hit.slot""")
_usage("slot_event_id", f"""{_SLOTS}, h AS (
SELECT slot, sha1(unhex('a1b2c3d4e5f67890abcdef1234567890') || encode(strftime(slot, '%Y-%m-%d %H:%M'))) AS d
FROM hit)
SELECT slot, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-'
    || CASE WHEN d[17:17] IN ('0','4','8','c') THEN '8' WHEN d[17:17] IN ('1','5','9','d') THEN '9'
            WHEN d[17:17] IN ('2','6','a','e') THEN 'a' ELSE 'b' END
    || d[18:20] || '-' || d[21:32] AS event_id
FROM h""")

_usage("hourly_profile", f"""
, span AS (SELECT UNNEST(generate_series(MIN(event_date), MAX(event_date), INTERVAL 1 DAY)) AS day FROM usage),
kinds AS (SELECT isodow(day) >= 6 AS is_weekend, COUNT(*) AS days FROM span GROUP BY 1),
t AS (SELECT hour("timestamp") AS hour, isodow("timestamp") >= 6 AS is_weekend, COUNT(*) AS n
      FROM usage GROUP BY ALL)
SELECT h.hour, kinds.is_weekend, COALESCE(n, 0) AS requests, days,
       {_round("CAST(COALESCE(n, 0) AS DOUBLE) / days", 6)} AS requests_per_day
FROM kinds CROSS JOIN (SELECT UNNEST(range(24)) AS hour) AS h
LEFT JOIN t ON t.hour = h.hour AND t.is_weekend = kinds.is_weekend""")


def _check(pos: int, name: str, bad: str, of: str = "COUNT(*)", table: str = "usage",
           passed: str | None = None, pct: bool = True) -> str:
    share = f"CAST({bad} AS DOUBLE) / NULLIF({of}, 0) * 100" if pct else "0"
    return (
        f"SELECT {pos} AS position, '{name}' AS expectation, {passed or f'{bad} = 0'} AS passed, "
        f"COALESCE({_round(share, 2)}, 0) AS unexpected_pct, COUNT(*) AS evaluated_count FROM {table}"
    )


def _not_null(pos: int, c: str, table: str = "usage") -> str:
    return _check(pos, f"{c} not null", f"COUNT(*) FILTER (WHERE {c} IS NULL)", table=table)


def _unique(pos: int, c: str, table: str = "usage") -> str:
    dup = f"(SELECT *, COUNT(*) OVER (PARTITION BY {c}) AS copies FROM {table})"
    return _check(pos, f"{c} unique", f"COUNT({c}) FILTER (WHERE copies > 1)", f"COUNT({c})", dup)


def _in_set(pos: int, c: str, values: str, table: str = "usage") -> str:
    return _check(pos, f"{c} in set", f"COUNT(*) FILTER (WHERE {c} NOT IN ({values}))",
                  f"COUNT({c})", table)


def _between(pos: int, c: str, low: int, high: int) -> str:
    return _check(pos, f"{c} in range", f"COUNT(*) FILTER (WHERE {c} NOT BETWEEN {low} AND {high})",
                  f"COUNT({c})")


def _mean(pos: int, c: str, low: int, high: int) -> str:
    return _check(pos, f"{c} mean in range", "0", passed=f"AVG({c}) BETWEEN {low} AND {high}", pct=False)


_TIERS = "'free', 'pro', 'enterprise'"
_PATHS = "'/v1/completions', '/v1/chat', '/v1/embeddings', '/v1/classify'"
_SUITE = " UNION ALL ".join([
    _not_null(1, "event_id"), _unique(2, "event_id"), _not_null(3, "user_id"),
    _in_set(4, "user_tier", _TIERS),
    _in_set(5, "status_code", "200, 400, 401, 403, 429, 500, 503, 504"),
    _between(6, "latency_ms", 0, 30000), _mean(7, "input_tokens", 100, 5000),
    _in_set(8, "endpoint", _PATHS),
])
_CHECK_COLUMNS = "CAST(position AS BIGINT) AS position, expectation, passed, unexpected_pct, evaluated_count"
_usage("dq_suite", f", s AS ({_SUITE}) SELECT {_CHECK_COLUMNS} FROM s")
_usage("dq_violations", ", s AS (" + " UNION ALL ".join([
    _not_null(1, "error_type"), _unique(2, "user_id"), _in_set(3, "user_tier", "'free', 'pro'"),
    _between(4, "latency_ms", 2, 50), _mean(5, "input_tokens", 5000, 9000), _unique(6, "event_id"),
    _in_set(7, "error_type", "'RateLimitError', 'APIError'"),
]) + f") SELECT {_CHECK_COLUMNS} FROM s")
_usage("dq_report", f""", s AS ({_SUITE})
SELECT '2024-01-31' AS run_time, (SELECT MAX(evaluated_count) FROM s) AS row_count,
       (SELECT COUNT(*) FILTER (WHERE passed) FROM s) AS n_passed, (SELECT COUNT(*) FROM s) AS total,
       expectation, passed, unexpected_pct, evaluated_count
FROM s""")


def _mart(name: str, checks: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS mart, * FROM ({c})" for c in checks)


_usage("dq_marts", f"""
, m_dau AS (SELECT event_date, COUNT(DISTINCT user_id) AS dau FROM usage GROUP BY event_date),
m_ep AS (SELECT endpoint FROM usage GROUP BY endpoint),
m_tier AS (SELECT user_tier FROM usage GROUP BY user_tier),
m_days AS (SELECT event_date, user_id, user_tier, region FROM usage GROUP BY ALL),
m_err AS (SELECT event_date, endpoint FROM usage GROUP BY ALL),
m_tok AS (SELECT event_date, user_tier FROM usage GROUP BY ALL),
m_lat AS (SELECT event_date, AVG(latency_ms) AS avg_latency FROM usage GROUP BY event_date),
m_first AS (SELECT user_id, date_trunc('month', MIN(event_date)) AS cohort_month FROM usage GROUP BY user_id),
m_coh AS (SELECT cohort_month, date_trunc('month', event_date) AS period, COUNT(DISTINCT user_id) AS active_users
          FROM usage JOIN m_first USING (user_id) GROUP BY ALL),
s AS (
{_mart("dau", [_not_null(1, "event_date", "m_dau"), _unique(2, "event_date", "m_dau"), _not_null(3, "dau", "m_dau")])}
UNION ALL
{_mart("endpoints", [_not_null(1, "endpoint", "m_ep"), _unique(2, "endpoint", "m_ep"), _in_set(3, "endpoint", _PATHS, "m_ep")])}
UNION ALL
{_mart("user_tiers", [_not_null(1, "user_tier", "m_tier"), _unique(2, "user_tier", "m_tier"), _in_set(3, "user_tier", _TIERS, "m_tier")])}
UNION ALL
{_mart("user_days", [_not_null(1, "event_date", "m_days"), _not_null(2, "user_id", "m_days"), _in_set(3, "user_tier", _TIERS, "m_days")])}
UNION ALL
{_mart("daily_errors", [_not_null(1, "event_date", "m_err"), _in_set(2, "endpoint", _PATHS, "m_err")])}
UNION ALL
{_mart("token_usage", [_not_null(1, "event_date", "m_tok"), _in_set(2, "user_tier", _TIERS, "m_tok")])}
UNION ALL
{_mart("daily_latency_error", [_not_null(1, "event_date", "m_lat"), _unique(2, "event_date", "m_lat"), _not_null(3, "avg_latency", "m_lat")])}
UNION ALL
{_mart("cohort_retention", [_not_null(1, "cohort_month", "m_coh"), _not_null(2, "active_users", "m_coh")])}
) SELECT mart, {_CHECK_COLUMNS} FROM s""")

_ACTIVITY = f""", ua AS (
SELECT user_id, MAX(event_date) AS last_active, COUNT(*) AS total_requests,
       AVG(latency_ms) AS avg_latency, {_ERRORS} AS error_count,
       COUNT(DISTINCT event_date) AS active_days, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens,
       MAX(churn_day) AS churn_day
FROM usage GROUP BY user_id),
ut AS (
SELECT DISTINCT ON (user_id) user_id, user_tier FROM usage
ORDER BY user_id, event_date DESC, "timestamp" DESC, user_tier DESC),
cf AS (
SELECT ua.*, user_tier, date_diff('day', last_active, DATE '2001-08-02') AS days_since_last,
       CASE WHEN churn_day IS NOT NULL
             AND date_diff('day', last_active, DATE '2001-08-02') > churn_day THEN 1 ELSE 0 END AS churned
FROM ua LEFT JOIN ut ON ua.user_id = ut.user_id)
"""
_orders("label_guard", f"""{_ACTIVITY}
SELECT COUNT(*) AS row_count, CAST(SUM(churned) AS BIGINT) AS positives, SUM(churned) >= 10 AS sufficient
FROM cf""")
_usage("user_activity", f"""{_ACTIVITY}
SELECT * REPLACE ({_round("avg_latency", 6)} AS avg_latency, CAST(churn_day AS DOUBLE) AS churn_day)
FROM ua""")
_orders("churn_features", f"""{_ACTIVITY}
SELECT * REPLACE ({_round("avg_latency", 6)} AS avg_latency, CAST(churn_day AS DOUBLE) AS churn_day,
                  CAST(churned AS BIGINT) AS churned),
       CAST(user_tier = 'enterprise' AS BIGINT) AS tier_enterprise,
       CAST(user_tier = 'free' AS BIGINT) AS tier_free, CAST(user_tier = 'pro' AS BIGINT) AS tier_pro
FROM cf""")
_orders("stratified_split", f"""{_ACTIVITY}, o AS (
SELECT user_id, churned,
       ROW_NUMBER() OVER (PARTITION BY churned ORDER BY md5(user_id || '|42'), user_id) AS r,
       COUNT(*) OVER (PARTITION BY churned) AS n
FROM cf)
SELECT user_id, CAST(churned AS BIGINT) AS churned, r <= FLOOR(n * CAST(0.3 AS DOUBLE) + 0.5) AS is_test
FROM o""")

ORACLES["one_hot"] = """
SELECT c_custkey AS user_id,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'enterprise' WHEN 'MACHINERY' THEN 'pro'
            ELSE 'free' END AS user_tier,
       r_name AS region, """ + ", ".join(
    f"CAST(r_name = '{r}' AS BIGINT) AS region_{r.lower().replace(' ', '_')}"
    for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
) + """
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_LIFETIMES = """, lt AS (
SELECT user_id, user_tier, MIN(event_date) AS acquisition_date, MAX(event_date) AS last_active,
       CASE WHEN MAX(event_date) >= DATE '2001-08-02' - INTERVAL 120 DAY THEN 0 ELSE 1 END AS churned,
       date_diff('day', MIN(event_date), MAX(event_date)) + 1 AS lifetime_days
FROM usage GROUP BY user_id, user_tier)
"""
_orders("user_lifetimes", f"""{_LIFETIMES}
SELECT * REPLACE (CAST(churned AS BIGINT) AS churned) FROM lt""")


def _survival(event: str) -> str:
    return f"""{_LIFETIMES}, g AS (
SELECT user_tier, lifetime_days AS t, COUNT(*) AS leaving, SUM({event}) AS events
FROM lt GROUP BY user_tier, lifetime_days),
r AS (
SELECT *, SUM(leaving) OVER (PARTITION BY user_tier) AS size,
       SUM(leaving) OVER (PARTITION BY user_tier ORDER BY t
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk
FROM g),
s AS (
SELECT *, PRODUCT(1 - CAST(events AS DOUBLE) / at_risk) OVER (PARTITION BY user_tier ORDER BY t) AS surv
FROM r WHERE size > 1)
SELECT user_tier, CAST(t AS DOUBLE) AS timeline, CAST(at_risk AS BIGINT) AS at_risk,
       CAST(events AS BIGINT) AS events, {_round("surv", 6)} AS survival_prob
FROM s
UNION ALL
SELECT user_tier, 0, CAST(MAX(size) AS BIGINT), 0, 1 FROM s GROUP BY user_tier"""


_orders("kaplan_meier", _survival("churned"))
_orders("kaplan_meier_inverted", _survival("1 - churned"))


def _did(name: str, table: str, y: str, line: bool = False) -> str:
    cells = {"treated_pre": "treated AND NOT post", "treated_post": "treated AND post",
             "control_pre": "NOT treated AND NOT post", "control_post": "NOT treated AND post"}
    agg = ", ".join(
        f"COUNT(y) FILTER (WHERE {w}) AS {c}_n, AVG(y) FILTER (WHERE {w}) AS {c}_mean, "
        f"VAR_SAMP(y) FILTER (WHERE {w}) AS {c}_var" for c, w in cells.items())
    did = "(treated_post_mean - treated_pre_mean) - (control_post_mean - control_pre_mean)"
    se = "SQRT(" + " + ".join(f"{c}_var / {c}_n" for c in cells) + ")"
    sign = {"treated_pre": "-", "treated_post": "+", "control_pre": "+", "control_post": "-"}
    share = " ".join(f"{sign[c]} COALESCE(SUM(y - {c}_mean) FILTER (WHERE {w}), 0) / {c}_n" for c, w in cells.items())
    rows = " + ".join(f"{c}_n" for c in cells)
    # The probability beyond t is one less the area up to t, by Simpson's rule.
    steps, v = 4000, "(clusters - 1)"
    p = f"""1 - 2 * (SELECT SUM(CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * EXP(LGAMMA(({v} + 1) / 2.0) - LGAMMA({v} / 2.0)) / SQRT(PI() * {v})
        * POWER(1 + POWER(i * ABS(ct) / {steps}, 2) / {v}, -({v} + 1) / 2.0)) * ABS(ct) / {steps} / 3
        FROM range({steps + 1}) AS s(i))"""
    if line:
        shown = f"""printf('- **%s**: treated %.4f -> %.4f, control %.4f -> %.4f, effect %+.4f (%+.2f%%; se %.4f, t %.2f, p %.4f; %d users)',
    '{name}', treated_pre_mean, treated_post_mean, control_pre_mean, control_post_mean, did,
    100 * relative, cse, ct, {p}, clusters) AS line"""
    else:
        shown = f"""'{name}' AS outcome, {", ".join(f"{c}_n" for c in cells)},
       {", ".join(f"{_round(f'{c}_mean', 6)} AS {c}_mean" for c in cells)},
       {_round("did", 6)} AS did, {_round("se", 6)} AS se, {_round("did / se", 6)} AS t_stat, clusters,
       {_round("cse", 6)} AS cluster_se, {_round("ct", 6)} AS cluster_t,
       {_round("relative", 6)} AS relative_effect, {_round(p, 6)} AS p_value"""
    return f"""SELECT {shown}
FROM (SELECT *, did / cse AS ct, did / (treated_post_mean - did) AS relative FROM (
SELECT *, {did} AS did, {se} AS se, SQRT(meat * clusters / (clusters - 1) * ({rows} - 1) / ({rows} - 4)) AS cse
FROM (WITH r AS (
    SELECT user_id, CAST({y} AS DOUBLE) AS y, user_tier = 'enterprise' AND region = 'AMERICA' AS treated,
           event_date >= DATE '1998-06-01' AS post
    FROM {table} WHERE user_tier = 'enterprise' OR region = 'AMERICA'),
m AS (SELECT {agg} FROM r)
SELECT m.*, k.* FROM m, (SELECT COUNT(*) AS clusters, SUM(z * z) AS meat FROM (
    SELECT user_id, {share} AS z FROM r, m GROUP BY user_id, {", ".join(f"{c}_n, {c}_mean" for c in cells)})) AS k)))"""


def _rollout(line: bool) -> str:
    return f"""{_VISITS}, ud AS (
SELECT event_date, user_id, user_tier, region, SUM(total_tokens) AS total_tokens FROM usage GROUP BY ALL)
{_did("retained", "ret", "retained", line)}
UNION ALL
{_did("tokens_per_user_day", "ud", "total_tokens", line)}"""


_orders("diff_in_diff", _rollout(False))
_orders("rollout_report", _rollout(True))

_orders("model_metrics", f"""{_ACTIVITY}, pos AS (SELECT days_since_last AS s FROM cf WHERE churned = 1),
neg AS (SELECT days_since_last AS s FROM cf WHERE churned = 0)
SELECT 'accuracy' AS metric,
       {_round("AVG(CASE WHEN (days_since_last > 150) = (churned = 1) THEN 1.0 ELSE 0.0 END)", 6)} AS value
FROM cf
UNION ALL
SELECT 'roc_auc', {_round("AVG(CASE WHEN pos.s > neg.s THEN 1.0 WHEN pos.s = neg.s THEN 0.5 ELSE 0.0 END)", 6)}
FROM pos CROSS JOIN neg""")

_usage("streaming_metrics", f"""
, w AS (SELECT *, date_trunc('hour', "timestamp") AS window_start FROM usage)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, COUNT(*) AS requests,
       {_ERRORS} AS error_count, {_round(f"CAST({_ERRORS} AS DOUBLE) / COUNT(*)", 6)} AS error_rate,
       {_round("AVG(latency_ms)", 6)} AS avg_latency, CAST(SUM(total_tokens) AS BIGINT) AS tokens,
       COUNT(DISTINCT user_id) AS users
FROM w GROUP BY window_start""")

_usage("stream_dedup", 'SELECT event_id, "timestamp", user_id, endpoint FROM usage')

_usage("ingest_stream", """
SELECT CAST(event_id AS VARCHAR) AS event_id, "timestamp", event_date,
       CAST(user_id AS VARCHAR) AS user_id, user_tier, endpoint, input_tokens, output_tokens,
       latency_ms, status_code, error_type, region, will_churn
FROM usage""")

# The same results by another way, from stored and merged parts.
for _same_as, _name in (
    ("endpoint_metrics", "endpoint_metrics_from_marts"),
    ("current_metrics", "current_metrics_from_marts"),
    ("cohort_mart_orders", "cohort_mart_incremental"),
    ("newest_100", "newest_100_of_days"),
    ("token_usage", "sink_json"), ("daily_errors", "sink_csv"), ("rollout_report", "sink_text"),
    ("endpoint_metrics", "mart_endpoints"),
    ("user_day_rollup", "mart_user_days"),
    *((name, f"mart_{name}") for name in (
        "dau", "token_usage", "user_tiers", "daily_errors", "daily_latency_error")),
):
    ORACLES[_name] = ORACLES[_same_as]

_usage("mart_cohort_retention", """
, a AS (SELECT DISTINCT user_id, date_trunc('month', event_date) AS month FROM usage),
f AS (SELECT user_id, month, MIN(month) OVER (PARTITION BY user_id) AS first FROM a)
SELECT CAST(first AS DATE) AS cohort_month, date_diff('month', first, month) AS months_since_cohort,
       COUNT(*) AS active_users
FROM f GROUP BY 1, 2""")

# The same small forest as the query's, walked by recursion.
_usage("forest_scores", f"""
, n(tree, node, feature, threshold, lo, hi, path) AS (VALUES
    (0, 0, 0, 50.0, 1, 2, 0.0), (0, 1, 1, 700.5, 3, 4, 0.0), (0, 2, -1, 0.0, 2, 2, 1.5),
    (0, 3, -1, 0.0, 3, 3, 2.0), (0, 4, 0, 20.25, 5, 6, 0.0), (0, 5, -1, 0.0, 5, 5, 3.25), (0, 6, -1, 0.0, 6, 6, 3.0),
    (1, 0, 1, 1200.5, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 4.0), (1, 2, 0, 90.125, 3, 4, 0.0),
    (1, 3, -1, 0.0, 3, 3, 2.5), (1, 4, -1, 0.0, 4, 4, 2.0),
    (2, 0, -1, 0.0, 0, 0, 0.75)),
w AS (SELECT * FROM (WITH RECURSIVE walk AS (
    SELECT event_id, latency_ms, total_tokens, tree, 0 AS node FROM usage, (SELECT DISTINCT tree FROM n)
    UNION ALL
    SELECT event_id, latency_ms, total_tokens, walk.tree,
           CASE WHEN CASE n.feature WHEN 0 THEN latency_ms ELSE total_tokens END <= threshold THEN lo ELSE hi END
    FROM walk JOIN n ON walk.tree = n.tree AND walk.node = n.node WHERE n.feature >= 0)
  SELECT event_id, CAST(AVG(n.path) AS DOUBLE) AS path_length
  FROM walk JOIN n ON walk.tree = n.tree AND walk.node = n.node WHERE n.feature < 0 GROUP BY event_id))
SELECT event_id, {_round("path_length", 6)} AS path_length,
       {_round("POWER(2.0, -path_length / (2 * (LN(15) + 0.5772156649015329) - 2 * 15.0 / 16))", 6)} AS anomaly_score
FROM w""")


def _boosted_tree(levels: int = 3, width: int = 8) -> str:
    """Levels of a tree: sums by node, feature and bin, the best split of each node, rows moved on."""
    names = ["total_requests", "avg_latency", "error_count", "active_days", "total_tokens", "days_since_last",
             "tier_enterprise", "tier_free", "tier_pro"]
    values = ", ".join(f"CAST({n} AS DOUBLE)" if not n.startswith("tier_")
                       else f"CAST(user_tier = '{n[5:]}' AS DOUBLE)" for n in names)
    over = " + ".join(f"CASE WHEN lo + (hi - lo) * {k} / {width} < v THEN 1 ELSE 0 END" for k in range(1, width))
    sql = f"""{_ACTIVITY}, x AS (
SELECT user_id, UNNEST(range({len(names)})) AS f, UNNEST([{values}]) AS v FROM cf),
e AS (SELECT f, MIN(v) AS lo, MAX(v) AS hi FROM x GROUP BY f),
b AS (SELECT user_id, f, {over} AS bin FROM x JOIN e USING (f)),
q AS (SELECT user_id, churned - p AS g, p * (1 - p) AS h FROM cf, (SELECT AVG(churned) AS p FROM cf)),
r0 AS (SELECT user_id, 0 AS node FROM cf)"""
    for n in range(levels):
        sql += f""",
c{n} AS (
SELECT *, SUM(g) OVER w AS gl, SUM(h) OVER w AS hl, SUM(n) OVER w AS nl,
       SUM(g) OVER (PARTITION BY node, f) AS gt, SUM(h) OVER (PARTITION BY node, f) AS ht,
       SUM(n) OVER (PARTITION BY node, f) AS nt
FROM (SELECT node, f, bin, SUM(g) AS g, SUM(h) AS h, COUNT(*) AS n
      FROM r{n} JOIN b USING (user_id) JOIN q USING (user_id) GROUP BY node, f, bin)
WINDOW w AS (PARTITION BY node, f ORDER BY bin)),
s{n} AS (
SELECT DISTINCT ON (node) * FROM (
    SELECT *, ROUND(gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1), 6) AS gain
    FROM c{n} WHERE nl < nt)
WHERE gain > 0 ORDER BY node, gain DESC, f, bin),
r{n + 1} AS (
SELECT r{n}.user_id, 2 * r{n}.node + CASE WHEN b.bin > s{n}.bin THEN 2 ELSE 1 END AS node
FROM r{n} JOIN s{n} USING (node) JOIN b ON b.user_id = r{n}.user_id AND b.f = s{n}.f)"""
    every = " UNION ALL ".join(f"SELECT * FROM s{n}" for n in range(levels))
    return f"""{sql}
SELECT CAST(node AS BIGINT) AS node, {names}[f + 1] AS feature,
       {_round(f"lo + (hi - lo) * (bin + 1) / {width}", 6)} AS threshold, {_round("gain", 6)} AS gain,
       CAST(nl AS BIGINT) AS rows_left, CAST(nt - nl AS BIGINT) AS rows_right,
       {_round("gl / (hl + 1)", 6)} AS value_left, {_round("(gt - gl) / (ht - hl + 1)", 6)} AS value_right
FROM ({every}) JOIN e USING (f)"""


_orders("boosted_tree", _boosted_tree())

_usage("events_of_users", """
SELECT CAST(event_id AS VARCHAR) AS event_id, "timestamp", CAST(user_id AS VARCHAR) AS user_id, endpoint
FROM usage WHERE user_id BETWEEN 1 AND 13
  AND "timestamp" >= TIMESTAMP '2024-01-05 06:00:00' AND "timestamp" < TIMESTAMP '2024-01-20 18:30:00'""")

_usage("append_batches", f"""{_SLOTS}, h AS (
SELECT slot, sha1(unhex('a1b2c3d4e5f67890abcdef1234567890') || encode(strftime(slot, '%Y-%m-%d %H:%M'))) AS d
FROM hit WHERE slot >= TIMESTAMP '2024-01-10' AND slot < TIMESTAMP '2024-01-12')
SELECT d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-'
    || CASE WHEN d[17:17] IN ('0','4','8','c') THEN '8' WHEN d[17:17] IN ('1','5','9','d') THEN '9'
            WHEN d[17:17] IN ('2','6','a','e') THEN 'a' ELSE 'b' END
    || d[18:20] || '-' || d[21:32] AS event_id, CAST(slot AS TIMESTAMP) AS "timestamp", CAST(NULL AS VARCHAR) AS user_id
FROM h
UNION ALL
SELECT CAST(event_id AS VARCHAR), "timestamp", CAST(user_id AS VARCHAR) FROM usage""")
