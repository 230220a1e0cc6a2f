"""The registered queries as SQL over the same tables, for DuckDB."""

from __future__ import annotations



def _round(expression: str, digits: int = 6) -> str:
    """Rounded off exact halves; see ``bindings.rounded``."""
    return f"round({expression} + 1e-9, {digits})"


K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

READINGS = f"""
  readings AS (
    SELECT user_id AS device, ts AS datetime, value AS sensor1, {K} AS sensor2 FROM events
  )"""

ITEMS = """
  items AS (
    SELECT l_orderkey, l_partkey, l_suppkey AS device, l_shipdate AS datetime,
           l_quantity AS sensor1, l_extendedprice AS sensor2, l_discount AS sensor3,
           l_tax AS sensor4, CAST(l_linenumber AS DOUBLE) AS sensor5
    FROM lineitem
  )"""

DEVICES = """
  devices AS (
    SELECT c_custkey AS device, c_name AS deviceName, n_name AS location
    FROM customer JOIN nation ON c_nationkey = n_nationkey
  )"""

SUPPLIERS = """
  suppliers AS (
    SELECT s_suppkey AS device, s_name AS deviceName, n_name AS location
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  )"""

SILVER = f"""{READINGS},{DEVICES},
  silver AS (
    SELECT CAST(datetime AS DATE) AS CalendarDate, dayname(datetime) AS CalendarDay,
           CAST(hour(datetime) AS INTEGER) AS hourOfDay, datetime, device, deviceName, location,
           sensor1, sensor2, sensor2 - sensor1 AS sensor2Variance
    FROM readings JOIN devices USING (device)
  )"""

GOLD = f"""{SILVER},
  gold AS (
    SELECT time_bucket(INTERVAL '30 seconds', datetime) AS window_start,
           time_bucket(INTERVAL '30 seconds', datetime) + INTERVAL '30 seconds' AS window_end,
           deviceName, avg(sensor1) AS sensor1_avg, avg(sensor2) AS sensor2_avg
    FROM silver GROUP BY ALL
  )"""

LIMITS = f"""{GOLD},
  limits AS (
    SELECT deviceName, max(sensor1_avg) * 0.97 AS Threshold
    FROM gold GROUP BY deviceName
  )"""

WIDE_GOLD = f"""{ITEMS},{SUPPLIERS},
  gold AS (
    SELECT time_bucket(INTERVAL '30 seconds', datetime) AS window_start,
           time_bucket(INTERVAL '30 seconds', datetime) + INTERVAL '30 seconds' AS window_end,
           deviceName, avg(sensor1) AS sensor1_avg, avg(sensor2) AS sensor2_avg,
           avg(sensor3) AS sensor3_avg, avg(sensor4) AS sensor4_avg, avg(sensor5) AS sensor5_avg
    FROM items JOIN suppliers USING (device) GROUP BY ALL
  )"""

SILVER_COLUMNS = (
    "CalendarDate, CalendarDay, hourOfDay, datetime, device, deviceName, location, "
    "sensor1, sensor2, sensor2Variance"
)


def _gold_columns(sensors: int) -> str:
    averages = [f"sensor{i}_avg" for i in range(1, sensors + 1)]
    return ", ".join(
        ["window_start", "window_end", "deviceName", *[f"{_round(a)} AS {a}" for a in averages]]
    )


GOLD_COLUMNS = _gold_columns(2)
WIDE_COLUMNS = _gold_columns(5)
LIMIT = _round("Threshold") + ' AS "Threshold"'
PREDICTION = "3.0 + 0.05 * sensor1 + 0.00002 * sensor2 - 1.5 * sensor3 + 2.0 * sensor4"

DIM_DATE = """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS "dateInt",
       d AS "CalendarDate", CAST(year(d) AS INTEGER) AS "CalendarYear",
       monthname(d) AS "CalendarMonth", CAST(month(d) AS INTEGER) AS "MonthOfYear",
       dayname(d) AS "CalendarDay", CAST(dayofweek(d) + 1 AS INTEGER) AS "DayOfWeek",
       CAST(isodow(d) AS INTEGER) AS "DayOfWeekStartMonday",
       CASE WHEN isodow(d) < 6 THEN 'Y' ELSE 'N' END AS "IsWeekDay",
       CAST(day(d) AS INTEGER) AS "DayOfMonth",
       CASE WHEN d = last_day(d) THEN 'Y' ELSE 'N' END AS "IsLastDayOfMonth",
       CAST(dayofyear(d) AS INTEGER) AS "DayOfYear",
       CAST(weekofyear(d) AS INTEGER) AS "WeekOfYearIso",
       CAST(quarter(d) AS INTEGER) AS "QuarterOfYear"
FROM (
  SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last
        FROM lineitem)
)"""


def _scored(prediction: str, source: str = "items", digits: int = 6) -> str:
    return (
        f"SELECT l_orderkey, l_partkey, device, sensor5, {_round(prediction, digits)} "
        f'AS "sensor5Prediction" FROM {source}'
    )


def _least_squares() -> str:
    """Normal equations of four features, solved by elimination step by step."""
    features = [f"sensor{i}" for i in range(1, 5)]
    every = [*features, "sensor5"]
    moments = [
        f"covar_pop({x}, {y}) AS a{i}{j}"
        for i, x in enumerate(features)
        for j, y in enumerate(every)
    ]
    means = [f"avg({x}) AS m{i}" for i, x in enumerate(every)]
    steps = [f"{ITEMS}, e0 AS (SELECT {', '.join(moments + means)} FROM items)"]
    kept = ", ".join(f"m{i}" for i in range(5))
    for k in range(4):
        cells = []
        for i in range(4):
            for j in range(5):
                new = (
                    f"a{i}{j} / a{k}{k}" if i == k else f"a{i}{j} - a{i}{k} / a{k}{k} * a{k}{j}"
                )
                cells.append(f"{new} AS a{i}{j}")
        steps.append(f"e{k + 1} AS (SELECT {', '.join(cells)}, {kept} FROM e{k})")
    terms = " + ".join(f"a{i}4 * (sensor{i + 1} - m{i})" for i in range(4))
    return f"WITH {', '.join(steps)} " + _scored(f"m4 + {terms}", "items, e4", 4)


_ALERTS = f"""WITH {LIMITS}
SELECT {GOLD_COLUMNS}, {LIMIT}
FROM gold JOIN limits USING (deviceName) WHERE sensor1_avg > Threshold"""

_GOLD = f"WITH {GOLD} SELECT {GOLD_COLUMNS} FROM gold"
_SILVER = f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver"
_READINGS = f"WITH {READINGS} SELECT * FROM readings"
_DEVICES = f'WITH {DEVICES} SELECT device, deviceName AS "deviceName", location FROM devices'

AWAKE = "hourOfDay NOT BETWEEN 2 AND 3"

_METRICS = f"""WITH {SILVER}, totals AS (
  SELECT 'awake' AS rule, 'drop' AS action, {AWAKE} AS holds FROM silver
  UNION ALL SELECT 'notSunday', 'warn', CalendarDay != 'Sunday' FROM silver
  UNION ALL SELECT 'steepness', 'warn', sensor1 / nullif(sensor2, 0) <= 25 FROM silver
), counted AS (
  SELECT rule, action, count(*) FILTER (WHERE holds) AS passed,
         count(*) FILTER (WHERE NOT holds) AS failed,
         count(*) FILTER (WHERE holds IS NULL) AS nulls
  FROM totals GROUP BY rule, action
)"""

ORACLES: dict[str, str] = {
    "alerts_current": _ALERTS,
    "alerts_early": f"""WITH {LIMITS}
SELECT window_start, window_end, deviceName, {LIMIT}
FROM gold JOIN limits USING (deviceName) WHERE sensor1_avg > Threshold""",
    "arrival_stamped": f"WITH {READINGS} SELECT device, sensor1, sensor2, true AS stamped_in_run FROM readings",
    "bi_dates": DIM_DATE.replace("l_shipdate", "ts").replace("lineitem", "events"),
    "alerts_ordered": _ALERTS + " ORDER BY deviceName",
    # Layers in append mode: only windows the watermark has closed.
    "alerts_stream": _ALERTS
    + " AND window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'",
    "alerts_wide": f"""WITH {WIDE_GOLD}, limits AS (
  SELECT deviceName, max(sensor5_avg) * 0.97 AS Threshold
  FROM gold GROUP BY deviceName)
SELECT {WIDE_COLUMNS}, {LIMIT}
FROM gold JOIN limits USING (deviceName) WHERE sensor5_avg > Threshold""",
    "bi_alerts": _ALERTS + " ORDER BY deviceName",
    "bi_device_silver": _SILVER + " WHERE device = 8",
    "bi_gold": _GOLD,
    "bi_sensor_reference": _DEVICES,
    "bi_silver": _SILVER,
    "bi_star_schema": f"""WITH {SILVER}
SELECT location, CalendarDay AS "CalendarDay",
       CASE WHEN isodow(CalendarDate) < 6 THEN 'Y' ELSE 'N' END AS "IsWeekDay",
       count(*) AS readings, {_round("avg(sensor1)")} AS sensor1_avg
FROM silver GROUP BY ALL""",
    "bronze_stream_ingest": _READINGS,
    "compact_partitioned": _READINGS.replace(
        "SELECT * FROM", "SELECT *, CAST(datetime AS DATE) AS stream_date FROM"
    ),
    "compact_table": _READINGS,
    "csv_reference_load": _DEVICES,
    "device_count": f"WITH {GOLD} SELECT count(DISTINCT deviceName) AS device_count FROM gold",
    "device_count_stream": f"WITH {GOLD} SELECT count(DISTINCT deviceName) AS device_count FROM gold",
    "device_drilldown": _READINGS + " WHERE device = 8",
    "dim_date": DIM_DATE,
    "envelope_roundtrip": "SELECT * FROM events",
    "expectation_metrics": _METRICS + " SELECT * FROM counted",
    "flow_lineage": f"""WITH RECURSIVE {SILVER}, parents (child, parent) AS (
  VALUES ('bronze', 'raw'), ('silver', 'device_info'), ('silver', 'dim_date'), ('silver', 'bronze'),
         ('busy_hours', 'silver')
), above AS (
  SELECT child, parent AS ancestor, 1 AS depth FROM parents
  UNION ALL
  SELECT above.child, parent, depth + 1 FROM above JOIN parents ON parents.child = ancestor
), hours AS (
  SELECT location, count(*) AS readings FROM silver WHERE {AWAKE} GROUP BY location, hourOfDay
), counts AS (
  SELECT 'bronze' AS ancestor, count(*) AS ancestor_rows FROM events
  UNION ALL SELECT 'silver', count(*) FROM silver WHERE {AWAKE}
  UNION ALL SELECT 'busy_hours', count(*) FROM (
    SELECT * FROM hours QUALIFY readings = max(readings) OVER (PARTITION BY location))
)
SELECT child, ancestor, depth, ancestor_rows FROM above LEFT JOIN counts USING (ancestor)""",
    "flow_quality": _METRICS + " SELECT rule, passed, failed, nulls FROM counted",
    "flow_silver": _SILVER + f" WHERE {AWAKE}",
    "flow_busy_hours": f"""WITH {SILVER}, hours AS (
  SELECT location, hourOfDay, count(*) AS readings, max(sensor1) AS highest
  FROM silver WHERE {AWAKE} GROUP BY ALL)
SELECT location, hourOfDay AS "hourOfDay", readings, highest FROM hours
QUALIFY readings = max(readings) OVER (PARTITION BY location)""",
    "gold_additive_stream": _GOLD,
    "gold_closed_windows": _GOLD
    + " WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'",
    "gold_corrected": _GOLD,
    "gold_window_batch": _GOLD,
    "gold_window_stream": _GOLD,
    "json_batch_scan": _READINGS,
    "json_schema_merge": f"""
SELECT user_id AS device, ts AS datetime,
       CASE event_id % 3 WHEN 0 THEN floor(value) WHEN 1 THEN value END AS sensor1,
       CASE event_id % 3 WHEN 1 THEN CAST({K} AS BIGINT) END AS sensor2,
       CASE event_id % 3 WHEN 2 THEN event_type END AS kind,
       CASE event_id % 3 WHEN 2 THEN event_id END AS number
FROM events""",
    "json_rejects": """
SELECT event_id, CASE WHEN event_id % 11 > 0 THEN user_id END AS user_id,
       CASE WHEN event_id % 11 > 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 11 > 1 THEN value END AS value,
       CASE event_id % 11 WHEN 1 THEN '{"value":"n/a","was":"' || value || '"}'
                          WHEN 2 THEN '{"firmware":"v2"}' END AS rescued,
       CASE WHEN event_id % 11 = 0 THEN 'not an object' END AS rejected,
       CASE WHEN event_id % 11 = 0 THEN CAST(length('{"user_id":' || user_id || ',"event_type":"' ||
           event_type || '","value":' || value || '}') - 6 AS INTEGER) END AS raw
FROM events""",
    "landing_partitioned": """
SELECT event_id AS "sequenceNumber", CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS value, props, CAST(ts AS DATE) AS stream_date
FROM events""",
    "model_fit_linear": _least_squares(),
    "model_registered_function": _least_squares(),
    "model_score_linear": f"WITH {ITEMS} "
    + _scored(PREDICTION),
    "model_search": f"""WITH {ITEMS} SELECT l_orderkey, l_partkey, device,
       {_round(PREDICTION, 4)} AS "sensor5Prediction" FROM items""",
    "model_stream_score": _least_squares(),
    "sensor_wide_windows": f"WITH {WIDE_GOLD} SELECT {WIDE_COLUMNS} FROM gold",
    "silver_enriched": _SILVER,
    "silver_expect_drop": _SILVER + f" WHERE {AWAKE}",
    "silver_late_device": _SILVER,
    "silver_refreshed_stream": _SILVER,
    "silver_rejected": f"WITH {SILVER} SELECT {SILVER_COLUMNS}, 'awake' AS broken "
    f"FROM silver WHERE NOT ({AWAKE})",
    "silver_scored": f"""WITH {ITEMS},{SUPPLIERS}
SELECT CAST(datetime AS DATE) AS "CalendarDate", dayname(datetime) AS "CalendarDay",
       CAST(hour(datetime) AS INTEGER) AS "hourOfDay", datetime, device,
       deviceName AS "deviceName", location, sensor1, sensor2, sensor3, sensor4, sensor5,
       {_round(PREDICTION)} AS "sensor5Prediction",
       sensor2 - sensor1 AS "sensor2Variance", sensor4 - sensor3 AS "sensor4Variance"
FROM items JOIN suppliers USING (device)""",
    "silver_stream": _SILVER,
    "stream_limit": "SELECT least(500, count(*)) AS row_count FROM events",
    "table_statistics": f"""WITH {GOLD}
SELECT 'device_info' AS table_name, count(*) AS row_count FROM devices
UNION ALL SELECT 'thresholds', count(DISTINCT deviceName) FROM gold
UNION ALL SELECT 'dim_date', CAST(datediff('day', min(l_shipdate), max(l_shipdate)) + 1 AS BIGINT)
FROM lineitem""",
    "threshold_statistics": f"""WITH {GOLD}
SELECT deviceName AS "deviceName", {_round("avg(sensor1_avg)")} AS "sensor1_Avg",
       {_round("max(sensor1_avg)")} AS "sensor1_Max", {_round("stddev(sensor1_avg)")} AS "sensor1_Std"
FROM gold GROUP BY deviceName""",
    "threshold_statistics_stream": f"""WITH {GOLD}
SELECT deviceName AS "deviceName", {_round("avg(sensor1_avg)")} AS "sensor1_Avg",
       {_round("max(sensor1_avg)")} AS "sensor1_Max", {_round("stddev(sensor1_avg)")} AS "sensor1_Std"
FROM gold GROUP BY deviceName""",
    "thresholds": f"""WITH {LIMITS}
SELECT deviceName AS "deviceName", {LIMIT} FROM limits""",
    "training_table_count": "SELECT count(*) AS row_count FROM lineitem",
    "silver_unmatched": f"""WITH {READINGS},{DEVICES}
SELECT device, datetime, sensor1, sensor2 FROM readings
WHERE device IS NULL OR device NOT IN (SELECT device FROM devices WHERE location <> 'NATION_3')""",
    "unmatched_counts": f"""WITH {READINGS},{DEVICES}, days AS (
  SELECT min(CAST(datetime AS DATE)) AS first_day, max(CAST(datetime AS DATE)) AS last_day
  FROM readings
), flagged AS (
  SELECT d.device IS NULL AS stranger,
         CAST(datetime AS DATE) > first_day + CAST((last_day - first_day) // 2 AS INTEGER) AS outside
  FROM readings r CROSS JOIN days LEFT JOIN devices d ON r.device = d.device
)
SELECT count(*) AS readings, count(*) FILTER (WHERE stranger) AS unknown_device,
       count(*) FILTER (WHERE outside) AS date_outside,
       count(*) FILTER (WHERE stranger OR outside) AS dropped
FROM flagged""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
