"""The queries of the catalog in ANSI SQL, for an independent engine to run on the same tables."""

from __future__ import annotations

from tidemill.plans.views import EVENT_TYPES, PRIORITIES, SEGMENTS
from tidemill.sources import DEVICES, REGIONS

_LOGGED = ("amount", "session_duration", "page_views")
_NORMALISED = ("amount", "session_duration", "page_views", "items_in_cart")


def _r(expression: str, digits: int, name: str) -> str:
    """Rounding in decimal, half up, with the noise of binary sums shed first."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38, {digits + 5})), {digits}) AS DOUBLE) AS {name}"


def _array(names: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


_TX_EVENTS = f"""
tx AS (
  SELECT event_id AS transaction_id, user_id, ts AS "timestamp", value AS amount, event_type AS category,
         {_array(REGIONS)}[user_id % 5 + 1] AS region, {_array(DEVICES)}[user_id % 3 + 1] AS device_type,
         k * 36 AS session_duration, k AS items_in_cart, CAST(event_type = 'error' AS BIGINT) AS is_returned,
         (event_id % 500) / 1000.0::DOUBLE AS discount_pct, event_id % 50 + 1 AS page_views
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
)"""

_TX_ORDERS = """
tx AS (
  SELECT l_orderkey AS transaction_id, o_custkey AS user_id, o_orderdate AS "timestamp", l_extendedprice AS amount,
         c_mktsegment AS category, r_name AS region, o_orderpriority AS device_type,
         p_retailprice AS session_duration, l_quantity AS items_in_cart,
         CAST(l_returnflag = 'R' AS BIGINT) AS is_returned, l_discount AS discount_pct, p_size AS page_views
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_ARRIVED = """
arrived AS (
  SELECT *, "timestamp" + (transaction_id % 11) * INTERVAL 1 SECOND AS arrival_ts FROM tx
), flagged AS (
  SELECT *, arrival_ts - "timestamp" > INTERVAL 5 SECOND AS is_late FROM arrived
)"""

_USERS = """
users AS (
  SELECT user_id, count(transaction_id) AS user_tx_count, sum(amount) AS user_total_spend,
         avg(amount) AS user_avg_amount, stddev_samp(amount) AS user_std_amount, avg(items_in_cart) AS user_avg_items,
         avg(is_returned) AS user_return_rate, avg(session_duration) AS user_avg_session
  FROM tx GROUP BY user_id
)"""

_STATS = "stats AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std" for c in _NORMALISED
) + " FROM tx)"

_TIME = ", ".join(
    ["CAST(hour AS INTEGER) AS hour", "CAST(day_of_week AS INTEGER) AS day_of_week"]
    + [
        _r(f"{fn}(2 * 3.14159::DOUBLE * {c} / {period})", 6, f"{prefix}_{fn}")
        for prefix, c, period in (("hour", "hour", 24), ("dow", "day_of_week", 7))
        for fn in ("sin", "cos")
    ]
)
_CLOCK = """clock AS (SELECT *, hour("timestamp") AS hour, dayofweek("timestamp") + 1 AS day_of_week FROM tx)"""
_LOGS = ", ".join(_r(f"ln(1 + {c}::DOUBLE)", 6, f"log_{c}") for c in _LOGGED)
_RATIOS = ", ".join(
    [
        _r("amount / nullif(items_in_cart, 0)", 4, "spend_per_item"),
        _r("amount / (page_views + 1)", 4, "spend_per_view"),
        _r("amount * (1 - discount_pct)", 4, "net_amount"),
    ]
)
_USER_COLUMNS = ", ".join(
    [
        "user_tx_count",
        _r("user_total_spend", 2, "user_total_spend"),
        _r("user_avg_amount", 4, "user_avg_amount"),
        _r("user_std_amount", 2, "user_std_amount"),
        _r("user_avg_items", 4, "user_avg_items"),
        _r("user_return_rate", 4, "user_return_rate"),
        _r("user_avg_session", 4, "user_avg_session"),
    ]
)
_ZSCORES = ", ".join(
    _r(f"({c} - (SELECT {c}_mean FROM stats)) / coalesce(nullif((SELECT {c}_std FROM stats), 0), 1)", 6, f"{c}_zscore")
    for c in _NORMALISED
)


def _flags(column: str, prefix: str, values: tuple[str, ...]) -> str:
    return ", ".join(f"CAST({column} = '{v}' AS INTEGER) AS \"{prefix}{v}\"" for v in values)


def _feature_table(tx: str, categories: tuple[str, ...], devices: tuple[str, ...]) -> str:
    return f"""WITH {tx}, {_CLOCK}, {_USERS}, {_STATS}
SELECT user_id, transaction_id, "timestamp", amount, category, region, device_type, session_duration, items_in_cart,
       is_returned, discount_pct, page_views, {_TIME}, {_LOGS}, {_flags("category", "cat_", categories)},
       {_flags("device_type", "dev_", devices)}, {_RATIOS}, {_USER_COLUMNS}, {_ZSCORES}
FROM clock LEFT JOIN users USING (user_id)"""


_HOURLY = """
hourly AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS window_start,
         time_bucket(INTERVAL 1 HOUR, "timestamp") + INTERVAL 1 HOUR AS window_end,
         category, count(*) AS tx_count, sum(amount) AS total_amount
  FROM tx GROUP BY ALL
)"""

# Exact in integers: amounts are whole cents, so the mean of n of them is rounded half up without floating point.
_SLIDING = """
sliding AS (
  SELECT window_start, window_start + INTERVAL 3 HOUR AS window_end, region,
         CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_amount
  FROM (
    SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") - r.k * INTERVAL 1 HOUR AS window_start, region,
           CAST(round(amount * 100) AS HUGEINT) AS cents
    FROM tx CROSS JOIN range(3) r(k)
  ) GROUP BY window_start, region
)"""

_CLOSED = '(SELECT max("timestamp") - INTERVAL 5 SECOND FROM tx)'

_PERCENTS = (1, 25, 50, 75, 95, 99)


#: The third of the feed's time that an event lies in.
_PLACED = """
placed AS (
  SELECT *, (epoch_us("timestamp") - (SELECT min(epoch_us("timestamp")) FROM tx)) * 3
            // (SELECT max(epoch_us("timestamp")) - min(epoch_us("timestamp")) + 1 FROM tx) AS place
  FROM tx
)"""


def _anchored() -> str:
    return f"""WITH RECURSIVE {_TX_EVENTS},
points AS (SELECT DISTINCT user_id, "timestamp" AS t FROM tx),
anchors AS (
  SELECT user_id, min(t) AS t FROM points GROUP BY user_id
  UNION ALL
  SELECT a.user_id, (SELECT min(p.t) FROM points p WHERE p.user_id = a.user_id AND p.t >= a.t + INTERVAL 6 HOUR)
  FROM anchors a
  WHERE EXISTS (SELECT 1 FROM points p WHERE p.user_id = a.user_id AND p.t >= a.t + INTERVAL 6 HOUR)
)
SELECT tx.user_id, a.t AS window_start, count(*) AS tx_count, {_r("sum(amount)", 2, "total_amount")}
FROM tx ASOF JOIN anchors a ON tx.user_id = a.user_id AND tx."timestamp" >= a.t
GROUP BY tx.user_id, a.t"""


ORACLE: dict[str, str] = {
    "time_features": f"WITH {_TX_EVENTS}, {_CLOCK} SELECT transaction_id, {_TIME} FROM clock",
    "log_transforms": f"WITH {_TX_EVENTS} SELECT transaction_id, {_LOGS} FROM tx",
    "categorical_flags": (
        f"WITH {_TX_EVENTS} SELECT transaction_id, {_flags('category', 'cat_', EVENT_TYPES)}, "
        f"{_flags('device_type', 'dev_', DEVICES)} FROM tx"
    ),
    "interaction_features": f"WITH {_TX_EVENTS} SELECT transaction_id, {_RATIOS} FROM tx",
    "user_aggregations": (
        f"WITH {_TX_ORDERS}, {_USERS} SELECT transaction_id, user_id, amount, items_in_cart, {_USER_COLUMNS} "
        "FROM tx LEFT JOIN users USING (user_id)"
    ),
    "global_stats": f"WITH {_TX_ORDERS}, {_STATS} SELECT "
    + ", ".join(_r(f"{c}_{s}", 4, f"{c}_{s}") for s in ("mean", "std") for c in _NORMALISED)
    + " FROM stats",
    "zscore_features": f"WITH {_TX_ORDERS}, {_STATS} SELECT transaction_id, user_id, {_ZSCORES} FROM tx",
    "feature_table": _feature_table(_TX_EVENTS, EVENT_TYPES, DEVICES),
    "order_feature_table": _feature_table(_TX_ORDERS, SEGMENTS, PRIORITIES),
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "iso_timestamp_roundtrip": f"""WITH {_TX_EVENTS}
SELECT transaction_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN microsecond("timestamp") % 1000000 = 0 THEN '' ELSE strftime("timestamp", '.%f') END
         || '+00:00' AS iso,
       "timestamp" AS instant
FROM tx""",
    "late_events_flagged": (
        f'WITH {_TX_EVENTS}, {_ARRIVED} SELECT transaction_id, "timestamp", arrival_ts, is_late FROM flagged'
    ),
    "late_events_dropped": (
        f'WITH {_TX_EVENTS}, {_ARRIVED} SELECT transaction_id, "timestamp", amount FROM flagged WHERE NOT is_late'
    ),
    "late_rate_by_key": f"""WITH {_TX_EVENTS}, {_ARRIVED}
SELECT category, count(*) AS total_events, count(*) FILTER (is_late) AS late_events,
       {_r("count(*) FILTER (is_late)::DOUBLE / count(*)", 6, "late_rate")},
       count(*) FILTER (is_late)::DOUBLE / count(*) > 0.05 AS late_alert
FROM flagged GROUP BY category""",
    "tumbling_category": f"""WITH {_TX_EVENTS}, {_HOURLY}
SELECT window_start, window_end, category, tx_count, {_r("total_amount", 2, "total_amount")} FROM hourly""",
    "sliding_region_avg": f"WITH {_TX_EVENTS}, {_SLIDING} SELECT * FROM sliding",
    "trailing_avg_by_key": f"""WITH {_TX_EVENTS}
SELECT transaction_id, user_id, "timestamp", {_r('''avg(amount) OVER (PARTITION BY user_id ORDER BY "timestamp"
         RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW)''', 4, "trailing_avg")}
FROM tx""",
    "anchored_tumbling_by_user": _anchored(),
    "window_category_pivot": f"WITH {_TX_EVENTS}, {_HOURLY} SELECT window_start, window_end, "
    + ", ".join(
        f"max(tx_count) FILTER (category = '{c}') AS {c}_tx_count, "
        + _r(f"max(total_amount) FILTER (category = '{c}')", 2, f"{c}_total_amount")
        for c in EVENT_TYPES
    )
    + " FROM hourly GROUP BY window_start, window_end",
    "window_category_record": f"""WITH {_TX_EVENTS}, {_HOURLY}
SELECT window_start, window_end, category, tx_count, {_r("total_amount", 2, "total_amount")} FROM hourly""",
    "window_region_record": f"WITH {_TX_EVENTS}, {_SLIDING} SELECT * FROM sliding",
    "latency_percentiles": f"WITH {_TX_EVENTS}, {_ARRIVED}, latency AS ("
    + "SELECT (epoch_us(arrival_ts) - epoch_us(\"timestamp\")) / 1000.0::DOUBLE AS ms FROM arrived) SELECT count(ms) AS n, "
    + ", ".join(f"quantile_cont(ms, {p / 100}) AS p{p}" for p in (50, 95, 99))
    + ", max(ms) AS max FROM latency",
    "amount_percentiles": f"WITH {_TX_ORDERS} SELECT category, count(amount) AS n, "
    + ", ".join(_r(f"quantile_cont(amount, {p / 100})", 4, f"p{p}") for p in _PERCENTS)
    + ", max(amount) AS max FROM tx GROUP BY category",
    "approx_amount_percentiles": f"""WITH {_TX_ORDERS}
SELECT category, count(amount) AS n, true AS p50_within, true AS p95_within, true AS p99_within FROM tx GROUP BY category""",
    "throughput_by_key": f"""WITH {_TX_EVENTS}
SELECT category, count(*) AS event_count,
       {_r('''count(*) / ((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1000000.0::DOUBLE)''', 8, "events_per_second")}
FROM tx GROUP BY category""",
    "dedup_events": f"""WITH {_TX_EVENTS}, twice AS (SELECT * FROM tx UNION ALL SELECT * FROM tx)
SELECT DISTINCT transaction_id, user_id, "timestamp", amount FROM twice""",
    "unprocessed_batches_anti": f"""WITH {_TX_EVENTS}, batched AS (
  SELECT *, strftime("timestamp", 'batch_%Y%m%d%H.jsonl') AS batch FROM tx
), processed AS (
  SELECT batch FROM batched GROUP BY batch HAVING max("timestamp") < TIMESTAMP '2024-01-15 12:30:00'
)
SELECT transaction_id, batch, amount FROM batched WHERE NOT EXISTS (
  SELECT 1 FROM processed WHERE processed.batch = batched.batch)""",
    "partition_pruned_scan": f"""WITH {_TX_EVENTS}
SELECT CAST("timestamp" AS DATE) AS event_date, category, count(*) AS tx_count, {_r("sum(amount)", 2, "total_amount")}
FROM tx WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY ALL""",
    "stream_tumbling_category": f"""WITH {_TX_EVENTS}, {_HOURLY}
SELECT window_start, window_end, category, tx_count, {_r("total_amount", 2, "total_amount")}
FROM hourly WHERE window_end <= {_CLOSED}""",
    "stream_sliding_region_avg": f"WITH {_TX_EVENTS}, {_SLIDING} SELECT * FROM sliding WHERE window_end <= {_CLOSED}",
    "stream_dedup_events": (
        f'WITH {_TX_EVENTS} SELECT transaction_id AS event_id, user_id, "timestamp", amount FROM tx'
    ),
    "stream_restart_windows": f"""WITH {_TX_EVENTS}, {_HOURLY}
SELECT window_start, window_end, category, tx_count, {_r("total_amount", 2, "total_amount")} FROM hourly""",
    "stream_late_accounting": f"""WITH {_TX_EVENTS}, {_ARRIVED}
SELECT count(*) AS total_events, count(*) FILTER (is_late) AS late_events, 0::BIGINT AS rejected_lines FROM flagged""",
    "feed_conservation": """
SELECT 'lines' AS outcome, count(*) AS line_count FROM events
UNION ALL SELECT 'blank', count(*) FROM events WHERE event_id % 10 IN (0, 1)
UNION ALL SELECT 'rejected', count(*) FROM events WHERE event_id % 10 IN (2, 3, 4, 5, 6)
UNION ALL SELECT 'good', count(*) FROM events WHERE event_id % 10 > 6""",
    "corrupt_lines_kept_apart": f"""WITH {_TX_EVENTS}
SELECT CASE WHEN category = 'error' THEN '(rejected)' ELSE category END AS category, count(*) AS line_count,
       {_r("sum(CASE WHEN category <> 'error' THEN amount END)", 2, "total_amount")}
FROM tx GROUP BY 1""",
}

ORACLE["stream_anchored_windows"] = f"SELECT * FROM ({_anchored()}) WHERE window_start + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)"
ORACLE["stream_trailing_avg"] = f"""WITH {_TX_EVENTS}, {_PLACED}
SELECT event_id, user_id, "timestamp", {_r("mean", 4, "trailing_avg")}
FROM (SELECT transaction_id AS event_id, user_id, "timestamp", avg(amount) OVER (PARTITION BY user_id ORDER BY "timestamp"
             RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW) AS mean
      FROM placed WHERE place > 0 OR transaction_id % 50 <> 0)
WHERE "timestamp" <= {_CLOSED}"""
ORACLE["stream_open_windows"] = f"""WITH {_TX_EVENTS}, {_PLACED}
SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS window_start,
       time_bucket(INTERVAL 1 HOUR, "timestamp") + INTERVAL 1 HOUR AS window_end,
       category, count(*) AS tx_count, {_r("sum(amount)", 2, "total_amount")}
FROM placed WHERE place < 2 GROUP BY 1, 2, 3
HAVING window_end > (SELECT max("timestamp") - INTERVAL 5 SECOND FROM placed WHERE place < 2)"""
ORACLE["stream_name_order"] = f"""WITH {_TX_EVENTS}
SELECT strftime("timestamp", 'batch_%Y%m%d.jsonl') AS file, count(*) AS events,
       CAST((row_number() OVER (ORDER BY strftime("timestamp", 'batch_%Y%m%d.jsonl')) - 1) // 5 * 5 AS BIGINT) AS files_before
FROM tx GROUP BY 1"""
ORACLE["merged_percentile_sketches"] = ORACLE["approx_amount_percentiles"]
ORACLE["bucketed_user_features"] = ORACLE["user_aggregations"]
ORACLE["repartitioned_scan"] = f"WITH {_TX_EVENTS} SELECT category, count(*) AS tx_count, 7::BIGINT AS partitions FROM tx GROUP BY category"
ORACLE["overwritten_table"] = f"""WITH {_TX_EVENTS} SELECT transaction_id, category, amount, "timestamp" FROM tx WHERE category <> 'error'"""
ORACLE["divided_percentiles"] = ORACLE["amount_percentiles"]
