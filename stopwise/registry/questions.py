"""Analysis questions: ANA-*."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions import round_half_away
from stopwise.operators import analysis as ana
from stopwise.operators.analysis import CARGO, PASSENGER
from stopwise.registry.sample import Sample
from stopwise.registry.sql import over

# The stop looked at on the way.
STOP = "S53"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Interpolated percentiles may differ in the last bits between engines."""
    return df.withColumns({c: round_half_away(F.col(c), 6) for c in columns})


def _base(s: Sample) -> DataFrame:
    return ana.described_arrivals(s.star).select(
        "event_key",
        "station_key",
        "station_name",
        "train_category",
        "date",
        "is_weekend",
        "delay_minutes",
    )


def _base_without_cancelled(s: Sample) -> DataFrame:
    return ana.network_totals(s.star, s.settings, exclude_cancelled=True)


def _progression_extremes(s: Sample) -> DataFrame:
    return ana.progression_extremes(ana.delay_progression(s.star), STOP)


def _categories_all(s: Sample) -> DataFrame:
    return _rounded(ana.by_category(s.star, s.settings, floor=-1), "p90")


QUERIES = {
    "ana_0_base": _base,
    "ana_1_network_totals": lambda s: ana.network_totals(s.star, s.settings),
    "ana_2_without_cancelled": _base_without_cancelled,
    "ana_4_station_ranking": lambda s: ana.station_ranking(s.star, s.settings),
    "ana_5_ranking_extremes": lambda s: ana.ranking_extremes(s.star, s.settings),
    "ana_6_stations_below_floor": lambda s: ana.stations_below_floor(s.star, s.settings),
    "ana_7_distinct_stations": lambda s: ana.distinct_stations(s.star),
    "ana_9_by_fixed_offset_hour": lambda s: ana.by_fixed_offset_hour(s.star, s.settings),
    "ana_10_by_zone_hour": lambda s: ana.by_zone_hour(s.star, s.settings),
    "ana_11_hour_extremes": lambda s: ana.hour_extremes(s.star, s.settings),
    "ana_12_causes": lambda s: ana.causes(s.star),
    "ana_13_top_causes": lambda s: ana.top_causes(s.star),
    "ana_14_coded_events": lambda s: ana.coded_events(s.star),
    "ana_15_causes_equal_split": lambda s: ana.causes_equal_split(s.star),
    "ana_16_by_category": lambda s: _rounded(ana.by_category(s.star, s.settings), "p90"),
    "ana_17_delay_progression": lambda s: ana.delay_progression(s.star),
    "ana_18_progression_extremes": _progression_extremes,
    "ana_18_station_progression": lambda s: ana.station_progression(s.star),
    "ana_19_daily_trend": lambda s: ana.daily_trend(s.star, s.settings),
    "ana_20_weekday_weekend": lambda s: ana.weekday_weekend(s.star, s.settings),
    "ana_21_day_extremes": lambda s: ana.day_extremes(s.star, s.settings),
    "ana_22_delay_histogram": lambda s: ana.delay_histogram(s.star, s.settings),
    "ana_23_delay_tails": lambda s: ana.delay_tails(s.star, s.settings),
    "ana_24_delay_quantiles": lambda s: _rounded(
        ana.delay_quantiles(s.star), "median_delay", "p95_delay"
    ),
    "ana_25_busiest_passenger_events": lambda s: ana.busiest_by_events(s.star, PASSENGER),
    "ana_25_busiest_cargo_events": lambda s: ana.busiest_by_events(s.star, CARGO),
    "ana_26_busiest_passenger_visits": lambda s: ana.busiest_by_visits(s.star, PASSENGER),
    "ana_26_busiest_cargo_visits": lambda s: ana.busiest_by_visits(s.star, CARGO),
    "ana_27_all_categories": _categories_all,
    "ana_28_delayed_with_cause": lambda s: ana.delayed_with_cause(s.star, s.settings),
}

_MEASURES = """count(*) AS n, avg(CAST(delay_minutes < 5 AS INTEGER)) AS on_time_rate,
       avg(delay_minutes) AS avg_delay"""

_RANKING = f"""
ranking AS (
  SELECT coalesce(station_name, station_short_code) AS name, station_short_code AS code,
         {_MEASURES}
  FROM base GROUP BY 1, 2 HAVING count(*) >= 50
)
"""

_HOURS = f"""
hours AS (
  SELECT (hour(scheduled_time) + 3) % 24 AS hour, {_MEASURES} FROM base GROUP BY 1
)
"""

_CAUSES = """
late AS (
  SELECT c.event_key, c.cause_key, f.cause_count, greatest(f.delay_minutes, 0) AS late_minutes
  FROM fct_causes c JOIN fct f ON f.event_key = c.event_key
),
cause_totals AS (
  SELECT d.cause_category_code AS code, any_value(d.cause_category_name) AS name,
         count(*) AS freq, CAST(sum(late_minutes) AS BIGINT) AS total_min,
         avg(late_minutes) AS avg_min
  FROM late JOIN dim_cause d USING (cause_key) GROUP BY 1
)
"""

# The labels the answer shows.
_LABELS = """labels(code, label) AS (VALUES
    ('A', 'Timetabling & operations'),
    ('E', 'Running ahead of schedule'),
    ('H', 'Management / administration'),
    ('I', 'Other causes'),
    ('J', 'Delayed train formation'),
    ('K', 'Rolling stock (multiple units & coaches)'),
    ('L', 'Traffic control / dispatching'),
    ('M', 'Passenger services'),
    ('O', 'Accident or incident'),
    ('P', 'Traffic management systems'),
    ('R', 'Trackwork / engineering possessions'),
    ('S', 'Electrification (OLE)'),
    ('T', 'Track & infrastructure'),
    ('V', 'Traction stock (locomotives)'))
"""

_STOPS = """
stops AS (
  SELECT train_number, station_short_code AS scode,
         coalesce(station_name, station_short_code) AS sname,
         delay_minutes,
         row_number() OVER (PARTITION BY train_number, date_key
                            ORDER BY scheduled_time, station_short_code, event_key) AS seq
  FROM base
),
progression AS (
  SELECT train_number, seq, min(scode) AS scode, min(sname) AS sname,
         avg(delay_minutes) AS avg_delay, count(*) AS n
  FROM stops GROUP BY 1, 2
)
"""

_DAYS = """
days AS (
  SELECT date, is_weekend, avg(CAST(delay_minutes < 5 AS INTEGER)) AS on_time_rate,
         count(*) AS n
  FROM base GROUP BY 1, 2
)
"""


def _category_sql(floor: int) -> str:
    return over(
        f"""
        SELECT train_category, count(*) AS n, avg(delay_minutes) AS avg_delay,
               avg(CAST(delay_minutes < 5 AS INTEGER)) AS on_time_rate,
               round(quantile_cont(delay_minutes, 0.9), 6) AS p90
        FROM base GROUP BY 1 HAVING count(*) > {floor}
        """
    )


def _busiest_events_sql(categories: str) -> str:
    return over(
        f"""
        SELECT s.station_name, s.station_short_code, count(*) AS events
        FROM fct f JOIN dim_train_type t USING (train_type_key)
        JOIN dim_station s USING (station_key)
        WHERE f.is_stopping AND t.train_category IN ({categories})
        GROUP BY 1, 2 ORDER BY events DESC, s.station_short_code LIMIT 15
        """
    )


def _busiest_visits_sql(categories: str) -> str:
    return over(
        f"""
        SELECT s.station_name, s.station_short_code, count(*) AS visit_count
        FROM (SELECT DISTINCT f.train_number, f.date_key, f.station_key
              FROM fct f JOIN dim_train_type t USING (train_type_key)
              WHERE f.is_stopping AND t.train_category IN ({categories})) v
        JOIN dim_station s USING (station_key)
        GROUP BY 1, 2 ORDER BY visit_count DESC, s.station_short_code LIMIT 15
        """
    )


_PASSENGER_SQL = "'Commuter', 'Long-distance'"
_CARGO_SQL = "'Cargo'"

ORACLES = {
    "ana_0_base": over(
        """
        SELECT event_key, station_key, station_name, train_category, date, is_weekend,
               delay_minutes
        FROM base
        """
    ),
    "ana_1_network_totals": over(f"SELECT {_MEASURES} FROM base"),
    "ana_2_without_cancelled": over(f"SELECT {_MEASURES} FROM base WHERE NOT is_cancelled"),
    "ana_4_station_ranking": over("SELECT * FROM ranking", _RANKING),
    "ana_5_ranking_extremes": over(
        """
        SELECT *, 'worst' AS side
        FROM (SELECT * FROM ranking ORDER BY on_time_rate NULLS LAST, code LIMIT 15)
        UNION ALL
        SELECT *, 'best'
        FROM (SELECT * FROM ranking ORDER BY on_time_rate DESC NULLS FIRST, code DESC LIMIT 15)
        """,
        _RANKING,
    ),
    "ana_6_stations_below_floor": over(
        """
        SELECT count(*) AS stations_below_floor FROM (
          SELECT station_short_code FROM base GROUP BY 1 HAVING count(*) < 50)
        """
    ),
    "ana_7_distinct_stations": over(
        "SELECT count(DISTINCT station_short_code) AS stations FROM base"
    ),
    "ana_9_by_fixed_offset_hour": over("SELECT * FROM hours", _HOURS),
    # Every given event falls in winter, when the zone is two hours ahead of UTC.
    "ana_10_by_zone_hour": over(
        f"SELECT (hour(scheduled_time) + 2) % 24 AS hour, {_MEASURES} FROM base GROUP BY 1"
    ),
    "ana_11_hour_extremes": over(
        """
        SELECT *, 'peak' AS kind
        FROM (SELECT * FROM hours ORDER BY avg_delay DESC NULLS LAST, hour LIMIT 1)
        UNION ALL
        SELECT *, 'quietest' AS kind
        FROM (SELECT * FROM hours WHERE n > 100 ORDER BY avg_delay, hour LIMIT 1)
        """,
        _HOURS,
    ),
    "ana_12_causes": over("SELECT * FROM cause_totals", _CAUSES),
    "ana_13_top_causes": over(
        """
        SELECT r.*, coalesce(l.label, r.name) AS label
        FROM (
          SELECT *, 'minutes' AS ranking
          FROM (SELECT * FROM cause_totals WHERE total_min > 0
                ORDER BY total_min DESC, code LIMIT 11)
          UNION ALL
          SELECT *, 'frequency'
          FROM (SELECT * FROM cause_totals ORDER BY freq DESC, total_min DESC, code LIMIT 4)
        ) r LEFT JOIN labels l ON l.code = r.code
        """,
        _CAUSES,
        _LABELS,
    ),
    "ana_14_coded_events": over("SELECT count(*) AS cause_rows FROM fct_causes"),
    "ana_15_causes_equal_split": over(
        """
        SELECT d.cause_category_code AS code, d.cause_category_name AS name,
               count(*) AS freq, sum(late_minutes / causes) AS split_min
        FROM (SELECT *, count(*) OVER (PARTITION BY event_key) AS causes FROM late)
        JOIN dim_cause d USING (cause_key)
        GROUP BY 1, 2
        """,
        _CAUSES,
    ),
    "ana_16_by_category": _category_sql(1000),
    "ana_17_delay_progression": over("SELECT * FROM progression", _STOPS),
    "ana_18_progression_extremes": over(
        f"""
        SELECT train_number, max(avg_delay) FILTER (WHERE seq <= 5) AS early_peak,
               min_by(abs(avg_delay), seq) FILTER (WHERE scode = '{STOP}') AS size_at_stop,
               max(avg_delay) AS peak,
               any_value(avg_delay) FILTER (WHERE seq = last_seq) AS last
        FROM (SELECT *, max(seq) OVER (PARTITION BY train_number) AS last_seq FROM progression)
        GROUP BY 1
        """,
        _STOPS,
    ),
    "ana_18_station_progression": over(
        """
        SELECT train_number, station_short_code AS scode,
               min(date_diff('microsecond', CAST(date AS TIMESTAMP), scheduled_time) // 1000000)
                 AS first_offset_seconds,
               avg(delay_minutes) AS avg_delay, count(*) AS n
        FROM base GROUP BY 1, 2
        """
    ),
    "ana_19_daily_trend": over("SELECT * FROM days", _DAYS),
    "ana_20_weekday_weekend": over(f"SELECT is_weekend, {_MEASURES} FROM base GROUP BY 1"),
    "ana_21_day_extremes": over(
        """
        SELECT *, 'worst' AS kind FROM (SELECT * FROM days ORDER BY on_time_rate, date LIMIT 1)
        UNION ALL
        SELECT *, 'best' FROM (SELECT * FROM days ORDER BY on_time_rate DESC, date LIMIT 1)
        """,
        _DAYS,
    ),
    "ana_22_delay_histogram": over(
        """
        SELECT b.delay_minutes, count(base.event_key) AS n
        FROM (SELECT unnest(generate_series(-8, 13)) AS delay_minutes) b
        LEFT JOIN base ON base.delay_minutes = b.delay_minutes
        GROUP BY 1
        """
    ),
    "ana_23_delay_tails": over(
        """
        SELECT count(delay_minutes) AS n, count(*) FILTER (WHERE delay_minutes > 13) AS above,
               count(*) FILTER (WHERE delay_minutes < -8) AS below,
               count(*) FILTER (WHERE delay_minutes > 13) / count(delay_minutes) AS above_share,
               count(*) FILTER (WHERE delay_minutes < -8) / count(delay_minutes) AS below_share,
               max(delay_minutes) AS max_delay
        FROM base
        """
    ),
    "ana_24_delay_quantiles": over(
        """
        SELECT round(quantile_cont(delay_minutes, 0.5), 6) AS median_delay,
               round(quantile_cont(delay_minutes, 0.95), 6) AS p95_delay
        FROM base
        """
    ),
    "ana_25_busiest_passenger_events": _busiest_events_sql(_PASSENGER_SQL),
    "ana_25_busiest_cargo_events": _busiest_events_sql(_CARGO_SQL),
    "ana_26_busiest_passenger_visits": _busiest_visits_sql(_PASSENGER_SQL),
    "ana_26_busiest_cargo_visits": _busiest_visits_sql(_CARGO_SQL),
    "ana_27_all_categories": _category_sql(-1),
    "ana_28_delayed_with_cause": over(
        """
        SELECT count(*) AS late_events, count(*) FILTER (WHERE cause_count > 0) AS with_cause,
               count(*) FILTER (WHERE cause_count > 0) / count(*) AS share
        FROM fct WHERE delay_minutes >= 5
        """
    ),
}
