"""DuckDB SQL that computes the registered queries independently."""

from __future__ import annotations


def _cents(x: str) -> str:
    """Two decimals from the exact binary value, half-even."""
    return f"CAST(format('{{:.2f}}', {x}) AS DOUBLE)"


# The sum of doubles rounded once, as whole multiples of 2^-60: DuckDB's own sums depend on order.
EXACT_SUM = """CAST(CAST(sum(CAST(temperature * 1152921504606846976.0 AS HUGEINT)) AS VARCHAR)
              AS DOUBLE) / 1152921504606846976.0"""

READINGS = """
readings AS (
  SELECT event_id, event_type,
         'device_' || CAST(user_id AS VARCHAR) AS device_id,
         CAST(user_id % 7 AS INTEGER) AS type_id,
         value AS temperature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
         ts AS event_time
  FROM events
)"""

ENRICHED = f"""{READINGS},
enriched AS (
  SELECT device_id, type_id, temperature, humidity, event_time,
         coalesce(r_name, 'Unknown') AS type_name
  FROM readings LEFT JOIN region ON type_id = r_regionkey
)"""


def _groups(unit: str, source: str = "readings") -> str:
    return f"""
groups AS (
  SELECT date_trunc('{unit}', event_time)::TIMESTAMP AS window_start,
         date_trunc('{unit}', event_time)::TIMESTAMP + INTERVAL 1 {unit} AS window_end,
         type_id,
         count(*) AS n_events,
         {EXACT_SUM} / count(*) AS mean_temperature,
         median(humidity) AS middle_humidity
  FROM {source} GROUP BY 1, 2, 3
)"""


def _named(name: str = "coalesce(r_name, 'Unknown')") -> str:
    return f"""
summary AS (
  SELECT window_start, window_end, type_id, n_events,
         strftime(window_start, '%H:%M') AS window_time,
         {name} AS type_name,
         {_cents("mean_temperature")} AS avg_temperature,
         {_cents("middle_humidity")} AS median_humidity
  FROM groups LEFT JOIN region ON type_id = r_regionkey
)"""


def _summary(unit: str) -> str:
    return f"WITH {READINGS},{_groups(unit)},{_named()}\n"


# A stream publishes only the windows its watermark has passed.
CLOSED = """window_end <= (SELECT date_trunc('millisecond', max(event_time)) FROM readings)
                   - INTERVAL 5 SECOND"""

# The function over a window's rows runs when the watermark reaches the last millisecond.
CLOSED_AT_LAST = f"window_end - INTERVAL 1 MILLISECOND {CLOSED.removeprefix('window_end ')}"

LATE_DROP = f"""
WITH {READINGS},
arriving AS (
  SELECT *, CAST(floor((least(day(event_time), 30) - 1) / 10) AS INTEGER)
            + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS arrival
  FROM readings
),
arrivals AS (
  SELECT arrival, max(max(date_trunc('millisecond', event_time))) OVER (
           ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
         ) - INTERVAL 5 SECOND AS watermark
  FROM arriving GROUP BY arrival
),
accepted AS (
  SELECT arriving.* FROM arriving JOIN arrivals USING (arrival)
  WHERE watermark IS NULL
     OR date_trunc('hour', event_time)::TIMESTAMP + INTERVAL 1 HOUR > watermark
),{_groups("hour", "accepted")},{_named()}
SELECT * FROM summary WHERE {CLOSED}
"""

LOOKUP_REFRESH = f"""
WITH {READINGS},{_groups("day")},
latest AS (
  SELECT date_trunc('day', event_time)::TIMESTAMP AS day_start, type_id AS day_type,
         max(event_time) >= TIMESTAMP '2024-01-16 12:00:00' AS renamed
  FROM readings GROUP BY 1, 2
),{_named("coalesce(CASE WHEN renamed THEN n_name ELSE r_name END, 'Unknown')").replace(
    "ON type_id = r_regionkey",
    "ON type_id = r_regionkey "
    "LEFT JOIN nation ON type_id = n_nationkey "
    "JOIN latest ON window_start = day_start AND type_id = day_type",
)}
SELECT * FROM summary WHERE {CLOSED}
"""

JSON_VALUE = """
'{"window_time":"' || window_time || '","type_name":"' || type_name
|| '","avg_temperature":' || CAST(avg_temperature AS VARCHAR)
|| ',"median_humidity":' || CAST(median_humidity AS VARCHAR) || '}'"""

ORACLE: dict[str, str] = {
    "json_event_decode": f"""WITH {READINGS}
        SELECT device_id, type_id, temperature, humidity,
               date_trunc('millisecond', event_time)::TIMESTAMP AS event_time FROM readings""",
    "iso_timestamp_parse": "SELECT event_id, ts AS event_time FROM events",
    "timestamp_to_epoch_ms": "SELECT event_id, epoch_us(ts) // 1000 AS event_time_ms FROM events",
    "epoch_ms_to_timestamp": """
        SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS event_time,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time_text FROM events""",
    "round_half_even_2": f"""
        SELECT event_id, {_cents("value / 8")} AS eighth, {_cents("value / 3")} AS third
        FROM events""",
    "window_time_label": """
        SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS window_start,
               strftime(ts, '%H:%M') AS window_time FROM events""",
    "lookup_join": f"""WITH {ENRICHED}
        SELECT device_id, type_id, event_time, type_name FROM enriched""",
    "lookup_join_frequent": f"""WITH {ENRICHED}
        SELECT device_id, type_id, event_time, type_name FROM enriched""",
    "coalesce_unknown": f"""WITH {ENRICHED}
        SELECT type_id, type_name, count(*) AS n_events FROM enriched GROUP BY 1, 2""",
    "enrich_project": f"WITH {ENRICHED} SELECT * FROM enriched",
    "dimension_insert_ignore": """
        SELECT r_regionkey AS id, r_name AS type_name FROM region
        UNION ALL
        SELECT n_nationkey, n_name FROM nation
        WHERE n_nationkey NOT IN (SELECT r_regionkey FROM region)""",
    "tumbling_window_assign": """
        SELECT date_trunc('minute', ts)::TIMESTAMP AS window_start,
               date_trunc('minute', ts)::TIMESTAMP + INTERVAL 1 MINUTE AS window_end,
               count(*) AS n_events
        FROM events GROUP BY 1, 2""",
    "window_avg_temperature": _summary("hour")
    + "SELECT window_start, type_id, avg_temperature FROM summary",
    "window_median_humidity": _summary("hour")
    + "SELECT window_start, type_id, median_humidity FROM summary",
    "window_latest_type_name": f"""WITH {ENRICHED}
        SELECT date_trunc('hour', event_time)::TIMESTAMP AS window_start, type_id,
               min(type_name) AS type_name
        FROM enriched GROUP BY 1, 2""",
    "window_sensor_summary_minute": _summary("minute") + "SELECT * FROM summary",
    "window_sensor_summary_hour": _summary("hour") + "SELECT * FROM summary",
    "window_sensor_summary_day": _summary("day") + "SELECT * FROM summary",
    "window_sensor_summary_bounded": _summary("day") + "SELECT * FROM summary",
    "sql_window_summary": _summary("hour") + "SELECT * FROM summary",
    "json_sink_encode": _summary("hour")
    + f"SELECT window_start, type_id, {JSON_VALUE} AS value FROM summary",
    "result_readback": _summary("hour")
    + "SELECT window_time, type_name, avg_temperature, median_humidity FROM summary",
    "stream_window_agg": _summary("minute") + f"SELECT * FROM summary WHERE {CLOSED}",
    "stream_window_function": _summary("minute") + f"SELECT * FROM summary WHERE {CLOSED_AT_LAST}",
    "stream_late_drop": LATE_DROP,
    "stream_lookup_refresh": LOOKUP_REFRESH,
    "stream_lookup_live": LOOKUP_REFRESH,
    "stream_lookup_cached": _summary("minute") + f"SELECT * FROM summary WHERE {CLOSED}",
    "stream_readback": _summary("hour")
    + "SELECT window_time, type_name, avg_temperature, median_humidity FROM summary",
}
