"""Overall equipment effectiveness of stations, lines and shifts.

OEE = availability x performance x quality, where each factor is 0 if its denominator is not
positive and missing counters count as 0, so the result is never NULL:

  availability = (window - faulty) / window
  performance  = ideal cycle x (good + scrap) / (window - faulty)
  quality      = good / (good + scrap)

good and scrap are counter deltas (max - min over all writers of a station together), faulty
is the sum of the fault episodes in the window. Times are milliseconds, windows open.

All functions first reduce telemetry per writer, by partial aggregation on the map side, and
only then meet the metadata, so no join ever moves telemetry rows and a writer that holds a
third of them costs no more than another.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.text import matches, not_empty, number, percent
from plantlake.operators.contains import containing
from plantlake.operators.lkv import writers_of
from plantlake.operators.shifts import with_windows
from plantlake.operators.spread import small
from plantlake.operators.timerange import between_open, utc
from plantlake.operators.zones import stored_index
from plantlake.schemas import (
    DEFAULT_SHIFTS,
    DISCARDED,
    FAULTY_TIME,
    MANUFACTURED,
    NON_PRODUCTION_WORKCELLS,
)


#: What tells one shift of one station.
SHIFT_KEYS = ["Site", "Workcell", "shift_day", "shift", "start_ts", "end_ts", "ideal_cycle_ms"]


def _value_of(name: str) -> Column:
    return F.when(F.col("Name") == name, number("Value"))


def counters(telemetry: DataFrame, *keys) -> DataFrame:
    """Per key: extremes of the two product counters and the summed fault time."""
    good, scrap = _value_of(MANUFACTURED), _value_of(DISCARDED)
    return (
        telemetry.where(F.col("Name").isin(MANUFACTURED, DISCARDED, FAULTY_TIME))
        .groupBy(*keys)
        .agg(
            F.max(good).alias("good_max"),
            F.min(good).alias("good_min"),
            F.max(scrap).alias("scrap_max"),
            F.min(scrap).alias("scrap_min"),
            F.sum(_value_of(FAULTY_TIME)).alias("faulty_sum"),
        )
    )


def merge_counters(parts: DataFrame, *keys) -> DataFrame:
    """Combine counters of several writers or minutes into good, scrap and faulty per key."""

    def delta(name: str) -> Column:
        return F.coalesce(F.max(f"{name}_max") - F.min(f"{name}_min"), F.lit(0.0))

    return parts.groupBy(*keys).agg(
        delta("good").alias("good"),
        delta("scrap").alias("scrap"),
        F.coalesce(F.sum("faulty_sum"), F.lit(0.0)).alias("faulty"),
    )


def add_factors(df: DataFrame, window_ms: Column, ideal_cycle_ms: Column) -> DataFrame:
    """Add availability, performance, quality and oee to rows with good, scrap and faulty."""
    window = window_ms.cast("double")
    made = F.col("good") + F.col("scrap")
    running = window - F.col("faulty")

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    return df.withColumns(
        {
            "availability": ratio(running, window),
            "performance": ratio(ideal_cycle_ms.cast("double") * made, running),
            "quality": ratio(F.col("good"), made),
        }
    ).withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))


def _window_ms(start, end) -> Column:
    return F.unix_millis(utc(end)) - F.unix_millis(utc(start))


def oee_station(
    telemetry: DataFrame,
    lkv: DataFrame,
    station: str,
    location: str,
    ideal_cycle_ms: int,
    start,
    end,
    how: str = "like",
) -> DataFrame:
    """One row: the counters, factors and oee of a station in a window."""
    writers = writers_of(lkv, station, location, how)
    readings = between_open(telemetry, start, end)
    wanted = counters(readings, "Subject").join(writers, "Subject", "left_semi")
    return add_factors(merge_counters(wanted), _window_ms(start, end), F.lit(ideal_cycle_ms))


def production_stations(lkv: DataFrame, location: str) -> DataFrame:
    """Distinct workcells of a site that produce; an empty workcell is none."""
    return (
        lkv.where(F.col("Site") == location)
        .where(not_empty("Workcell") & ~F.col("Workcell").isin(*NON_PRODUCTION_WORKCELLS))
        .select(F.col("Workcell").alias("station"))
        .distinct()
    )


def oee_stations_of_line(
    telemetry: DataFrame, lkv: DataFrame, location: str, ideal_cycle_ms: int, start, end, how: str = "like"
) -> DataFrame:
    """One row per production station of a site, all from one pass over telemetry.

    A writer belongs to every station whose name its data set name contains, found through an index of the names.
    """
    stations = production_stations(lkv, location)
    writers = lkv.where(matches("DataSetName", location, how)).select("Subject", "DataSetName").distinct()
    of = containing(writers, "DataSetName", stations, "station", how)
    members = writers.join(of, "DataSetName").select("Subject", "station").distinct()
    members = stations.join(members, "station", "left")
    per_writer = counters(between_open(telemetry, start, end), "Subject")
    totals = merge_counters(members.join(per_writer, "Subject", "left"), "station")
    return add_factors(totals, _window_ms(start, end), F.lit(ideal_cycle_ms))


def oee_line(
    telemetry: DataFrame, lkv: DataFrame, location: str, ideal_cycle_ms: int, start, end, how: str = "like"
) -> DataFrame:
    """One row: the lowest oee among the production stations of a site."""
    stations = oee_stations_of_line(telemetry, lkv, location, ideal_cycle_ms, start, end, how)
    return stations.agg(F.min("oee").alias("oee"))


def minute_counters(telemetry: DataFrame) -> DataFrame:
    """Counters per writer and minute; readings on the full minute stay apart.

    Shifts start and end on full minutes and exclude those instants, so a reading within a
    minute shares its shift with the whole minute, and only one on the boundary may not.
    """
    minute = F.date_trunc("minute", "Timestamp")
    return counters(
        telemetry.where(F.col("Timestamp").isNotNull()).withColumns(
            {"minute": minute, "on_minute": F.col("Timestamp") == minute}
        ),
        "Subject",
        "minute",
        "on_minute",
    )


def production_writers(lkv: DataFrame, sites: DataFrame) -> DataFrame:
    """Subject to (Site, Workcell) and the site's tz and ideal_cycle_ms, production only."""
    writers = (
        lkv.where(not_empty("Site") & not_empty("Workcell"))
        .where(~F.col("Workcell").isin(*NON_PRODUCTION_WORKCELLS))
        .select("Subject", "Site", "Workcell")
        .distinct()
    )
    return writers.join(sites.select("Site", "tz", "ideal_cycle_ms"), "Site")


def shift_counters(telemetry: DataFrame, lkv: DataFrame, sites: DataFrame, shifts=DEFAULT_SHIFTS) -> DataFrame:
    """Counters per writer and minute with the station and the shift they fall into.

    Readings shrink to minutes before the join with the writers; the shift comes from an index of the sites' zones.
    """
    writers = small(production_writers(lkv, sites))
    located = minute_counters(telemetry).join(writers, "Subject")
    until = F.when(F.col("on_minute"), F.col("minute")).otherwise(
        F.col("minute") + F.expr("INTERVAL 1 MINUTE")
    )
    return (
        with_windows(located.withColumn("until", until), "minute", "tz", shifts, stored_index(sites))
        .where(
            F.when(F.col("on_minute"), F.col("start_ts") < F.col("minute")).otherwise(
                F.col("start_ts") <= F.col("minute")
            )
        )
        .where(
            F.when(F.col("on_minute"), F.col("until") < F.col("end_ts")).otherwise(
                F.col("until") <= F.col("end_ts")
            )
        )
    )


def readings_in_shifts(telemetry: DataFrame, writers: DataFrame, zones: DataFrame, shifts=DEFAULT_SHIFTS) -> DataFrame:
    """Counter readings with the station and each shift they fall into, reading by reading, as a stream needs them.

    `writers` as `production_writers` gives them, `zones` an index of their zones.
    """
    named = telemetry.where(F.col("Timestamp").isNotNull() & F.col("Name").isin(MANUFACTURED, DISCARDED, FAULTY_TIME))
    near = with_windows(named.join(writers, "Subject"), "Timestamp", "tz", shifts, zones)
    return near.where((F.col("start_ts") < F.col("Timestamp")) & (F.col("Timestamp") < F.col("end_ts")))


def oee_of_shifts(parts: DataFrame) -> DataFrame:
    """OEE per station and shift from any parts of its counters."""
    keys = SHIFT_KEYS
    window = F.unix_millis("end_ts") - F.unix_millis("start_ts")
    return add_factors(merge_counters(parts, *keys), window, F.col("ideal_cycle_ms"))


def oee_by_shift(
    telemetry: DataFrame, lkv: DataFrame, sites: DataFrame, shifts=DEFAULT_SHIFTS
) -> DataFrame:
    """OEE of every production station in every shift it sent data in, in one job.

    `sites` has Site, tz and ideal_cycle_ms. Each row equals `oee_station` called with that
    shift's bounds.
    """
    return oee_of_shifts(shift_counters(telemetry, lkv, sites, shifts))


def low_oee_alerts(oee: DataFrame, threshold_pct: float = 10) -> DataFrame:
    """Rows whose oee, in percent rounded to two places, is below the threshold."""
    return oee.withColumn("oee_pct", percent("oee")).where(F.col("oee_pct") < threshold_pct)
