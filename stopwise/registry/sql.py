"""Shared SQL of the oracles: the binding of ``FIXTURES.md`` and the star, flat.

Written from the rules, over the given tables only; nothing is nested here, so
the Spark side's nesting and flattening is really compared with something else.
"""

from __future__ import annotations

_RELATIONS = """
ev AS (
  SELECT event_id, ts, user_id AS u, event_type AS kind, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         CAST(ts - INTERVAL 3 HOUR AS DATE) AS d, event_id // 2048 AS slice
  FROM events
),
raw AS (
  SELECT event_id, slice, d AS ingest_date, d AS departure_date, u AS train_number,
         'OP' || (u % 4) AS operator_short_code, 'T' || (u % 7) AS train_type,
         CASE u % 3 WHEN 0 THEN 'Commuter' WHEN 1 THEN 'Long-distance' ELSE 'Cargo' END
           AS train_category,
         CASE WHEN u % 3 = 0 THEN 'R' || (u % 5) ELSE '' END AS commuter_line_id,
         CASE WHEN u % 20 = 0 THEN true WHEN u % 2 <> 0 THEN false END AS train_cancelled,
         CASE WHEN u % 11 = 0 THEN 'ADHOC' ELSE 'REGULAR' END AS timetable_type,
         'S' || k AS station_short_code,
         CASE WHEN kind IN ('click', 'view', 'purchase') THEN 'ARRIVAL' ELSE 'DEPARTURE' END
           AS event_type,
         CASE WHEN k % 5 <> 0 THEN true WHEN k % 10 <> 0 THEN false END AS train_stopping,
         CASE WHEN k % 4 <> 0 THEN true WHEN k % 8 <> 0 THEN false END AS commercial_stop,
         CASE WHEN k % 25 = 1 THEN true WHEN k % 2 <> 0 THEN false END AS row_cancelled,
         ts AS scheduled_time,
         CASE WHEN k % 15 <> 0 THEN ts END AS actual_time,
         CAST(CASE WHEN k % 30 = 0 OR k % 33 = 5 THEN NULL
                   WHEN k % 17 = 0 THEN floor(value / 5) - 70
                   ELSE floor(value / 10) - 4 END AS BIGINT) AS difference_in_minutes,
         CASE WHEN k % 7 = 0 THEN '' ELSE CAST(k % 7 AS VARCHAR) END AS commercial_track,
         CAST(CASE WHEN kind = 'error' THEN 1 WHEN kind = 'signup' AND value > 50 THEN 2
                   ELSE 0 END AS BIGINT) AS n_causes
  FROM ev
),
stg AS (
  SELECT md5(departure_date || '|' || train_number || '|' || station_short_code || '|'
             || event_type || '|' || strftime(scheduled_time, '%Y-%m-%dT%H:%M:%S')) AS event_key,
         departure_date, train_number, operator_short_code, train_type, train_category,
         CASE WHEN commuter_line_id <> '' THEN commuter_line_id END AS commuter_line_id,
         station_short_code, event_type, scheduled_time, actual_time,
         difference_in_minutes AS delay_minutes, timetable_type,
         CASE WHEN commercial_track <> '' THEN commercial_track END AS commercial_track,
         n_causes AS cause_count, ingest_date AS source_ingest_date,
         coalesce(train_cancelled, false) OR coalesce(row_cancelled, false) AS is_cancelled,
         coalesce(train_stopping, false) AS is_stopping,
         coalesce(commercial_stop, false) AS is_commercial_stop,
         actual_time IS NOT NULL AS has_actual_time,
         difference_in_minutes IS NULL OR difference_in_minutes BETWEEN -60 AND 1440
           AS is_plausible_delay
  FROM raw
),
cause_rows AS (
  SELECT s.event_key, c.cause_seq, c.cause_category_code, c.detailed_cause_category_code,
         c.third_cause_category_code, s.source_ingest_date
  FROM stg s
  JOIN (VALUES (1, CAST(1 AS BIGINT), 'E', 'E1', NULL),
               (2, 1, 'L', 'L2', 'L21'),
               (2, 2, 'T', 'T1', NULL))
       AS c(causes, cause_seq, cause_category_code, detailed_cause_category_code,
            third_cause_category_code) ON c.causes = s.cause_count
),
stations AS (
  SELECT 'S' || s_suppkey AS station_short_code, s_name AS station_name,
         s_suppkey + 1000 AS station_uic_code, 'C' || s_nationkey AS country_code,
         s_acctbal / 200 AS latitude, s_suppkey * CAST(0.25 AS DOUBLE) AS longitude,
         s_suppkey % 3 = 0 AS passenger_traffic,
         CASE WHEN s_suppkey % 3 = 0 THEN 'STATION' ELSE 'STOPPING_POINT' END AS station_type
  FROM supplier WHERE s_suppkey % 10 <> 7
),
cause_codes AS (
  SELECT chr(64 + n) AS cause_category_code, 'Brand ' || n AS cause_category_name,
         DATE '2020-01-01' + days AS valid_from
  FROM (SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS n,
               min(p_size) AS days FROM part GROUP BY 1)
  WHERE n % 10 <> 2
),
detailed_codes AS (
  SELECT chr(64 + CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)) || p_partkey
           AS detailed_cause_category_code,
         p_name AS detailed_cause_category_name, DATE '2020-01-01' + p_size AS valid_from
  FROM part
),
dim_station AS (
  SELECT row_number() OVER (ORDER BY station_short_code) AS station_key, station_short_code,
         station_name, country_code, latitude, longitude, passenger_traffic, station_type
  FROM stations
  UNION ALL
  SELECT -1, 'UNKNOWN', 'Unknown station', NULL, NULL, NULL, false, NULL
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
         CAST(dayofweek(d) AS BIGINT) AS day_of_week, dayname(d) AS day_name,
         dayofweek(d) IN (0, 6) AS is_weekend, CAST(month(d) AS BIGINT) AS month,
         CAST(year(d) AS BIGINT) AS year, CAST(week(d) AS BIGINT) AS week_of_year
  FROM (SELECT CAST(unnest(generate_series(
          (SELECT min(departure_date) FROM stg), (SELECT max(departure_date) FROM stg),
          INTERVAL 1 DAY)) AS DATE) AS d)
),
dim_train_type AS (
  SELECT row_number() OVER (ORDER BY train_category, train_type) AS train_type_key,
         train_type, train_category, train_category = 'Long-distance' AS is_long_distance,
         train_category = 'Commuter' AS is_commuter
  FROM (SELECT DISTINCT train_type, train_category FROM stg)
),
dim_cause AS (
  SELECT row_number() OVER (ORDER BY cause_category_code) AS cause_key, cause_category_code,
         cause_category_name, valid_from FROM cause_codes
  UNION ALL
  SELECT -1, 'UNKNOWN', 'Unknown / unmapped cause', NULL
),
fct AS (
  SELECT e.event_key, coalesce(s.station_key, -1) AS station_key, d.date_key,
         t.train_type_key, e.train_number, e.event_type, e.station_short_code,
         e.operator_short_code, e.commuter_line_id, e.scheduled_time, e.actual_time,
         e.delay_minutes, e.cause_count, e.is_cancelled, e.is_stopping, e.is_commercial_stop,
         e.has_actual_time, e.is_plausible_delay, e.source_ingest_date
  FROM stg e
  LEFT JOIN dim_station s ON s.station_short_code = e.station_short_code
  LEFT JOIN dim_train_type t ON t.train_type = e.train_type
       AND t.train_category IS NOT DISTINCT FROM e.train_category
  LEFT JOIN dim_date d ON d.date = e.departure_date
),
fct_causes AS (
  SELECT c.event_key, c.cause_seq, coalesce(d.cause_key, -1) AS cause_key,
         c.cause_category_code, c.detailed_cause_category_code, c.third_cause_category_code,
         c.source_ingest_date
  FROM cause_rows c JOIN fct f ON f.event_key = c.event_key
  LEFT JOIN dim_cause d ON d.cause_category_code = c.cause_category_code
),
punctuality AS (
  SELECT station_key, date_key, count(*) AS scheduled_arrivals,
         count(*) FILTER (WHERE is_cancelled) AS cancelled_arrivals,
         count(*) FILTER (WHERE ok) AS measured_arrivals,
         count(*) FILTER (WHERE ok AND delay_minutes < 5) AS on_time_events,
         round(count(*) FILTER (WHERE ok AND delay_minutes < 5)
               / nullif(count(*) FILTER (WHERE ok), 0), 4) AS on_time_rate,
         round(avg(delay_minutes) FILTER (WHERE ok), 2) AS avg_delay_minutes,
         median(delay_minutes) FILTER (WHERE ok) AS median_delay_minutes,
         max(delay_minutes) FILTER (WHERE ok) AS worst_delay_minutes
  FROM (SELECT *, has_actual_time AND is_plausible_delay AND NOT is_cancelled AS ok FROM fct
        WHERE event_type = 'ARRIVAL' AND is_commercial_stop)
  GROUP BY 1, 2
),
base AS (
  SELECT f.*, t.train_type, t.train_category, d.date, d.is_weekend, s.station_name
  FROM fct f JOIN dim_train_type t USING (train_type_key) JOIN dim_date d USING (date_key)
  LEFT JOIN dim_station s USING (station_key)
  WHERE f.event_type = 'ARRIVAL' AND f.is_commercial_stop AND f.has_actual_time
    AND f.is_plausible_delay
)
"""


def over(query: str, *extra: str) -> str:
    """A self-contained statement: the shared relations, ``extra`` ones, the query."""
    relations = ",\n".join([_RELATIONS.strip(), *(e.strip() for e in extra)])
    return f"WITH {relations}\n{query.strip()}"
