"""Analysis questions over the star schema (ANA-*).

Every question starts from the same arrivals: filters that reach the fact scan,
then lookups in small dimensions. Counts, sums and averages combine map-side;
percentiles work on (group, delay) counts, so a group that holds most rows costs
one row per distinct delay after the first step.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions import local_hour, number_within, on_time_flag, shifted_hour
from stopwise.operators.facts import with_causes_only
from stopwise.settings import Settings
from stopwise.storage import save

# English names of the cause categories.
CAUSE_LABELS = {
    "A": "Timetabling & operations",
    "E": "Running ahead of schedule",
    "H": "Management / administration",
    "I": "Other causes",
    "J": "Delayed train formation",
    "K": "Rolling stock (multiple units & coaches)",
    "L": "Traffic control / dispatching",
    "M": "Passenger services",
    "O": "Accident or incident",
    "P": "Traffic management systems",
    "R": "Trackwork / engineering possessions",
    "S": "Electrification (OLE)",
    "T": "Track & infrastructure",
    "V": "Traction stock (locomotives)",
}

# The two groups of train categories compared by traffic.
PASSENGER = ("Commuter", "Long-distance")
CARGO = ("Cargo",)


@dataclass(frozen=True)
class Star:
    """The tables the questions read.

    ``base`` is the stored common population, when several questions share it; ``counts`` the
    stored counts of arrivals by minute, from which distributions are read instead of the fact.
    """

    events: DataFrame
    causes: DataFrame
    station: DataFrame
    train_type: DataFrame
    date: DataFrame
    cause: DataFrame
    base: DataFrame | None = None
    counts: DataFrame | None = None

    @classmethod
    def of(cls, warehouse) -> "Star":
        return cls(
            events=warehouse.fct_timetable_events,
            causes=warehouse.fct_delay_causes,
            station=warehouse.dim_station,
            train_type=warehouse.dim_train_type,
            date=warehouse.dim_date,
            cause=warehouse.dim_cause,
            counts=warehouse.delay_counts,
        )

    def with_stored_base(self, path: str) -> "Star":
        """Write the common population once, narrow, for questions to scan instead."""
        return replace(self, base=save(realised_arrivals(self).select(BASE_COLUMNS), path))


BASE_COLUMNS = [
    "event_key",
    "train_number",
    "station_key",
    "station_short_code",
    "date_key",
    "train_type_key",
    "scheduled_time",
    "delay_minutes",
    "is_cancelled",
]


def realised_arrivals(star: Star) -> DataFrame:
    """Realised, plausible arrivals at commercial stops, of a known train type and date.

    A key that is there always has its dimension row: the build assigns keys by
    lookup and checks them. Asking for the keys replaces two joins per row.
    """
    return star.events.filter(
        (F.col("event_type") == "ARRIVAL")
        & F.col("is_commercial_stop")
        & F.col("has_actual_time")
        & F.col("is_plausible_delay")
        & F.col("train_type_key").isNotNull()
        & F.col("date_key").isNotNull()
    )


def arrivals(star: Star, exclude_cancelled: bool = False) -> DataFrame:
    """ANA-0. The population every question starts from, with keys only.

    Questions group by key first and look attributes up afterwards, so a join
    sees one row per group instead of every arrival.
    """
    base = realised_arrivals(star) if star.base is None else star.base
    return base.filter(~F.col("is_cancelled")) if exclude_cancelled else base


def with_train_type(rows: DataFrame, star: Star) -> DataFrame:
    columns = ("train_type_key", "train_type", "train_category")
    return rows.join(star.train_type.select(*columns), "train_type_key")


def with_date(rows: DataFrame, star: Star) -> DataFrame:
    return rows.join(star.date.select("date_key", "date", "is_weekend"), "date_key")


def with_station_name(rows: DataFrame, star: Star) -> DataFrame:
    return rows.join(star.station.select("station_key", "station_name"), "station_key", "left")


def described_arrivals(star: Star) -> DataFrame:
    """ANA-0. The population with the attributes of its dimensions."""
    return with_station_name(with_date(with_train_type(arrivals(star), star), star), star)


def _delay() -> Column:
    return F.col("delay_minutes")


def _on_time(settings: Settings) -> Column:
    return on_time_flag(_delay(), settings.on_time_minutes)


def _measures(settings: Settings) -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.avg(_on_time(settings)).alias("on_time_rate"),
        F.avg(_delay()).alias("avg_delay"),
    ]


def _delay_counts(star: Star, *by: str) -> DataFrame:
    """The population counted by ``by`` and minute of delay, from stored counts where there are any."""
    if star.counts is None:
        return arrivals(star).groupBy(*by, "delay_minutes").agg(F.count("*").alias("rows"))
    realised = star.counts.filter(
        F.col("has_actual_time")
        & F.col("is_plausible_delay")
        & F.col("train_type_key").isNotNull()
        & F.col("date_key").isNotNull()
    )
    return realised.groupBy(*by, "delay_minutes").agg(F.sum("rows").alias("rows"))


def _known_rows() -> Column:
    """Frequency of a delay value; a missing delay carries no weight."""
    return F.when(_delay().isNotNull(), F.col("rows")).otherwise(0)


def network_totals(star: Star, settings: Settings = Settings(), **population) -> DataFrame:
    """ANA-1..3. Size, on-time rate and mean delay of the whole base."""
    return arrivals(star, **population).agg(*_measures(settings))


def station_ranking(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-4. Stations with enough arrivals, least punctual first."""
    by_station = (
        arrivals(star)
        .groupBy("station_key", F.col("station_short_code").alias("code"))
        .agg(*_measures(settings))
        .filter(F.col("n") >= settings.min_arrivals)
    )
    return (
        with_station_name(by_station, star)
        .select(
            F.coalesce("station_name", "code").alias("name"),
            "code",
            "n",
            "on_time_rate",
            "avg_delay",
        )
        .orderBy(F.col("on_time_rate").asc_nulls_last(), "code")
    )


def ranking_extremes(
    star: Star, settings: Settings = Settings(), count: int = 15
) -> DataFrame:
    """ANA-5. Both ends of the ranking, read from either side.

    A station without any known delay ranks last, so it heads the best side.
    """
    ranked = station_ranking(star, settings)
    worst = ranked.orderBy(F.col("on_time_rate").asc_nulls_last(), "code").limit(count)
    best = ranked.orderBy(
        F.col("on_time_rate").desc_nulls_first(), F.col("code").desc()
    ).limit(count)
    return worst.withColumn("side", F.lit("worst")).unionByName(
        best.withColumn("side", F.lit("best"))
    )


def stations_below_floor(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-6. How many stations have too few arrivals to be ranked."""
    return (
        arrivals(star)
        .groupBy("station_short_code")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") < settings.min_arrivals)
        .agg(F.count("*").alias("stations_below_floor"))
    )


def distinct_stations(star: Star) -> DataFrame:
    """ANA-7."""
    return arrivals(star).agg(F.countDistinct("station_short_code").alias("stations"))


def by_hour(star: Star, hour: Column, settings: Settings = Settings()) -> DataFrame:
    """ANA-8. Arrivals, mean delay and on-time rate per hour of day."""
    return arrivals(star).groupBy(hour.alias("hour")).agg(*_measures(settings)).orderBy("hour")


def by_fixed_offset_hour(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-9. Hours under a constant offset from UTC."""
    return by_hour(star, shifted_hour(F.col("scheduled_time"), settings.utc_offset_hours), settings)


def by_zone_hour(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-10. Hours in a real time zone, summer time included."""
    return by_hour(star, local_hour(F.col("scheduled_time"), settings.zone), settings)


def hour_extremes(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-11. The hour with the highest mean delay; the lowest among busy hours."""
    hours = by_fixed_offset_hour(star, settings)
    peak = hours.orderBy(F.col("avg_delay").desc_nulls_last(), "hour").limit(1)
    quiet = (
        hours.filter(F.col("n") > settings.quiet_hour_min_arrivals)
        .orderBy(F.col("avg_delay").asc_nulls_last(), "hour")
        .limit(1)
    )
    return peak.withColumn("kind", F.lit("peak")).unionByName(
        quiet.withColumn("kind", F.lit("quietest"))
    )


def _cause_minutes(star: Star) -> DataFrame:
    """Cause rows with the delay of their event; a missing or negative delay is 0.

    Event keys are unique once the build has passed. Grouping by the key all the
    same shares the join's shuffle and keeps repeated keys from multiplying.
    """
    events = (
        with_causes_only(star.events)
        .groupBy("event_key")
        .agg(
            F.max("delay_minutes").alias("delay_minutes"),
            F.max("cause_count").alias("cause_count"),
        )
    )
    return star.causes.join(events, "event_key").withColumn(
        "late_minutes", F.greatest(_delay(), F.lit(0))
    )


def _named_causes(by_key: DataFrame, star: Star) -> DataFrame:
    names = star.cause.select("cause_key", "cause_category_code", "cause_category_name")
    return by_key.join(names, "cause_key").select(
        F.col("cause_category_code").alias("code"),
        F.col("cause_category_name").alias("name"),
        *[c for c in by_key.columns if c != "cause_key"],
    )


def causes(star: Star) -> DataFrame:
    """ANA-12. Frequency and full delay minutes per cause category."""
    by_key = (
        _cause_minutes(star)
        .groupBy("cause_key")
        .agg(
            F.count("*").alias("freq"),
            F.sum("late_minutes").alias("total_min"),
            F.avg("late_minutes").alias("avg_min"),
        )
    )
    return _named_causes(by_key, star).orderBy(F.col("total_min").desc_nulls_last(), "code")


def cause_label(code: Column, fallback: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in CAUSE_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, code), fallback)


def top_causes(star: Star, by_minutes: int = 11, by_frequency: int = 4) -> DataFrame:
    """ANA-13. Leading causes by minutes (above zero) and by frequency, labelled."""
    ranked = causes(star).withColumn("label", cause_label(F.col("code"), F.col("name")))
    minutes = (
        ranked.filter(F.col("total_min") > 0)
        .orderBy(F.col("total_min").desc(), "code")
        .limit(by_minutes)
    )
    frequency = ranked.orderBy(
        F.col("freq").desc(), F.col("total_min").desc_nulls_last(), "code"
    ).limit(by_frequency)
    return minutes.withColumn("ranking", F.lit("minutes")).unionByName(
        frequency.withColumn("ranking", F.lit("frequency"))
    )


def coded_events(star: Star) -> DataFrame:
    """ANA-14."""
    return star.causes.agg(F.count("*").alias("cause_rows"))


def causes_equal_split(star: Star) -> DataFrame:
    """ANA-15. Delay minutes shared equally among the causes of each event."""
    by_key = (
        _cause_minutes(star)
        .groupBy("cause_key", "cause_count")
        .agg(F.count("*").alias("rows"), F.sum("late_minutes").alias("late"))
        .groupBy("cause_key")
        .agg(
            F.sum("rows").alias("freq"),
            F.sum(F.col("late") / F.col("cause_count")).alias("split_min"),
        )
    )
    return _named_causes(by_key, star)


def by_category(
    star: Star, settings: Settings = Settings(), floor: int | None = None
) -> DataFrame:
    """ANA-16, ANA-27. Train categories: size, means and 90th percentile.

    ``floor`` keeps categories with more arrivals than that; pass -1 for all.
    """
    floor = settings.category_min_arrivals if floor is None else floor
    counts = with_train_type(_delay_counts(star, "train_type_key"), star)
    n, delay = F.col("rows"), _delay()
    known = F.sum(F.when(delay.isNotNull(), n))
    return (
        counts.groupBy("train_category")
        .agg(
            F.sum(n).alias("n"),
            (F.sum(delay * n) / known).alias("avg_delay"),
            (F.sum(_on_time(settings) * n) / known).alias("on_time_rate"),
            F.percentile(delay, 0.9, _known_rows()).alias("p90"),
        )
        .filter(F.col("n") > floor)
        .orderBy(F.col("n").desc(), "train_category")
    )


def _of_train(star: Star, train_number: int | None) -> DataFrame:
    base = arrivals(star)
    return base if train_number is None else base.filter(F.col("train_number") == train_number)


def delay_progression(star: Star, train_number: int | None = None) -> DataFrame:
    """ANA-17. Mean delay per stop position of each train, or of one, over all dates.

    Positions are counted per date, so a stop missing on one date shifts the
    later ones; ``station_progression`` keys by station instead.
    """
    stops = _of_train(star, train_number).select(
        "train_number", "date_key", "scheduled_time", "station_key", "event_key", "delay_minutes",
        F.col("station_short_code").alias("scode"),
    )
    placed = number_within(
        stops, "seq", ["scheduled_time", "scode", "event_key"], ["train_number", "date_key"]
    )
    # Names are looked up once per train, position and station, not per arrival.
    per_station = placed.groupBy("train_number", "seq", "station_key", "scode").agg(
        F.sum("delay_minutes").alias("minutes"),
        F.count("delay_minutes").alias("known"),
        F.count("*").alias("stops"),
    )
    named = with_station_name(per_station, star)
    return (
        named.groupBy("train_number", "seq")
        .agg(
            F.min("scode").alias("scode"),
            F.min(F.coalesce("station_name", "scode")).alias("sname"),
            (F.sum("minutes") / F.nullif(F.sum("known"), F.lit(0))).alias("avg_delay"),
            F.sum("stops").alias("n"),
        )
        .orderBy("train_number", "seq")
    )


def progression_extremes(progression: DataFrame, stop: str, first: int = 5) -> DataFrame:
    """ANA-18. Per train: peak of the first stops, size at one stop, peak, last stop."""
    seq, mean = F.col("seq"), F.col("avg_delay")
    return progression.groupBy("train_number").agg(
        F.max(F.when(seq <= first, mean)).alias("early_peak"),
        F.min_by(F.abs(mean), F.when(F.col("scode") == stop, seq)).alias("size_at_stop"),
        F.max(mean).alias("peak"),
        F.max_by(mean, seq).alias("last"),
    )


def station_progression(star: Star, train_number: int | None = None) -> DataFrame:
    """ANA-18. Mean delay per train and station, in order of earliest scheduled offset."""
    per_day = (
        _of_train(star, train_number)
        .groupBy("train_number", F.col("station_short_code").alias("scode"), "date_key")
        .agg(
            F.min("scheduled_time").alias("first_time"),
            F.sum("delay_minutes").alias("minutes"),
            F.count("delay_minutes").alias("known"),
            F.count("*").alias("n"),
        )
    )
    # A day's offset is least where its time is: dates are looked up on one row per stop and day.
    offset = F.timestamp_diff("SECOND", F.col("date").cast("timestamp_ntz"), F.col("first_time"))
    return (
        with_date(per_day, star)
        .groupBy("train_number", "scode")
        .agg(
            F.min(offset).alias("first_offset_seconds"),
            (F.sum("minutes") / F.nullif(F.sum("known"), F.lit(0))).alias("avg_delay"),
            F.sum("n").alias("n"),
        )
        .orderBy("train_number", "first_offset_seconds", "scode")
    )


def daily_trend(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-19."""
    by_day = (
        arrivals(star)
        .groupBy("date_key")
        .agg(F.avg(_on_time(settings)).alias("on_time_rate"), F.count("*").alias("n"))
    )
    return (
        with_date(by_day, star).select("date", "is_weekend", "on_time_rate", "n").orderBy("date")
    )


def weekday_weekend(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-20. Weekdays against weekends, in one pass."""
    by_day = (
        arrivals(star)
        .groupBy("date_key")
        .agg(
            F.count("*").alias("rows"),
            F.count("delay_minutes").alias("known"),
            F.sum(_on_time(settings)).alias("on_time"),
            F.sum("delay_minutes").alias("minutes"),
        )
    )
    known = F.nullif(F.sum("known"), F.lit(0))
    return (
        with_date(by_day, star)
        .groupBy("is_weekend")
        .agg(
            F.sum("rows").alias("n"),
            (F.sum("on_time") / known).alias("on_time_rate"),
            (F.sum("minutes") / known).alias("avg_delay"),
        )
    )


def day_extremes(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-21. The least and the most punctual day; the earlier one on a tie."""
    days = daily_trend(star, settings).filter(F.col("on_time_rate").isNotNull())
    worst = days.orderBy("on_time_rate", "date").limit(1).withColumn("kind", F.lit("worst"))
    best = days.orderBy(F.col("on_time_rate").desc(), "date").limit(1)
    return worst.unionByName(best.withColumn("kind", F.lit("best")))


def delay_histogram(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-22. Arrivals per whole minute inside the clip, empty minutes included."""
    low, high = settings.histogram_low, settings.histogram_high
    counts = _delay_counts(star).filter(_delay().between(low, high)).withColumnRenamed("rows", "n")
    bins = star.events.sparkSession.range(low, high + 1).withColumnRenamed("id", "delay_minutes")
    return (
        bins.join(counts, "delay_minutes", "left")
        .select("delay_minutes", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("delay_minutes")
    )


def delay_tails(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-23. Arrivals beyond the clip on either side, their shares, the maximum."""
    d = _delay()

    def known(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("rows"))), F.lit(0))

    totals = _delay_counts(star).agg(
        known(d.isNotNull()).alias("n"),
        known(d > settings.histogram_high).alias("above"),
        known(d < settings.histogram_low).alias("below"),
        F.max(d).alias("max_delay"),
    )
    n = F.nullif(F.col("n"), F.lit(0))
    return totals.select(
        "n",
        "above",
        "below",
        (F.col("above") / n).alias("above_share"),
        (F.col("below") / n).alias("below_share"),
        "max_delay",
    )


def delay_quantiles(star: Star) -> DataFrame:
    """ANA-24. Exact median and 95th percentile, interpolated."""
    p = F.percentile(_delay(), F.array(F.lit(0.5), F.lit(0.95)), _known_rows())
    return (
        _delay_counts(star)
        .agg(p.alias("p"))
        .select(F.col("p")[0].alias("median_delay"), F.col("p")[1].alias("p95_delay"))
    )


def _of_categories(rows: DataFrame, star: Star, categories: tuple[str, ...]) -> DataFrame:
    wanted = star.train_type.filter(F.col("train_category").isin(*categories))
    return rows.join(wanted.select("train_type_key"), "train_type_key", "left_semi")


def _busiest(by_station: DataFrame, star: Star, measure: str, count: int) -> DataFrame:
    names = star.station.select("station_key", "station_name", "station_short_code")
    return (
        by_station.join(names, "station_key")
        .groupBy("station_name", "station_short_code")
        .agg(F.sum(measure).alias(measure))
        .orderBy(F.col(measure).desc(), "station_short_code")
        .limit(count)
    )


def busiest_by_events(star: Star, categories: tuple[str, ...], count: int = 15) -> DataFrame:
    """ANA-25. Stations with most stopping events of some train categories."""
    by_type = (
        star.events.filter("is_stopping")
        .groupBy("station_key", "train_type_key")
        .agg(F.count("*").alias("events"))
    )
    wanted = _of_categories(by_type, star, categories)
    by_station = wanted.groupBy("station_key").agg(F.sum("events").alias("events"))
    return _busiest(by_station, star, "events", count)


def busiest_by_visits(star: Star, categories: tuple[str, ...], count: int = 15) -> DataFrame:
    """ANA-26. Stations with most visits: a train on a date counts once per station."""
    stops = _of_categories(star.events.filter("is_stopping"), star, categories)
    visits = stops.select("train_number", "date_key", "station_key").distinct()
    by_station = visits.groupBy("station_key").agg(F.count("*").alias("visit_count"))
    return _busiest(by_station, star, "visit_count", count)


def delayed_with_cause(star: Star, settings: Settings = Settings()) -> DataFrame:
    """ANA-28. Share of late events that carry a cause."""
    return (
        star.events.filter(_delay() >= settings.on_time_minutes)
        .agg(
            F.count("*").alias("late_events"),
            F.count_if(F.col("cause_count") > 0).alias("with_cause"),
        )
        .select(
            "late_events",
            "with_cause",
            (F.col("with_cause") / F.nullif(F.col("late_events"), F.lit(0))).alias("share"),
        )
    )
