"""Shift calendars: windows in UTC, shift of a timestamp, windows joined to rows, breaks."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.operators.zones import INDEX_COLUMNS, instant_of, offset_at, offset_before, stored_index, with_zone
from plantlake.schemas import BREAK_HOURS, DEFAULT_SHIFTS

DAY_MIN, MINUTE = 1440, 60_000_000
DAY = DAY_MIN * MINUTE


def calendar_rows(calendar: DataFrame) -> tuple[tuple[str, int, int], ...]:
    """A calendar table (shift, start_min, end_min) as a parameter; with a `position` column in its order.

    All functions of this module take a calendar as such a tuple or as a table, of any length.
    """
    if "position" in calendar.columns:
        calendar = calendar.orderBy("position")
    return tuple((r["shift"], r["start_min"], r["end_min"]) for r in calendar.collect())


def calendar_table(spark: SparkSession, shifts) -> DataFrame:
    """shift, start_min, end_min, position of a calendar that is given as rows or as a table.

    A table without `position` is ordered by its times and names.
    """
    if isinstance(shifts, DataFrame):
        order = F.col("position") if "position" in shifts.columns else F.struct("start_min", "end_min", "shift")
        return shifts.select("shift", "start_min", "end_min", order.alias("position"))
    rows = [
        F.struct(F.lit(name).alias("shift"), F.lit(start).alias("start_min"), F.lit(end).alias("end_min"), F.lit(k).alias("position"))
        for k, (name, start, end) in enumerate(shifts)
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def longest_shift(spark: SparkSession, shifts=DEFAULT_SHIFTS) -> int:
    """Minutes of the longest shift of a calendar by the wall clock; 0 for none."""
    wraps = F.col("end_min") < F.col("start_min")
    length = F.col("end_min") - F.col("start_min") + F.when(wraps, DAY_MIN).otherwise(0)
    return calendar_table(spark, shifts).agg(F.max(length).alias("m")).first()["m"] or 0


def shifts_of_minutes(calendar: DataFrame) -> DataFrame:
    """tod_min, back, shift, from_min, to_min: for each minute of a day the shifts that hold it, ends included.

    `back` is how many days before the shift's day began; `to_min` counts on past midnight. A calendar of any
    length is looked up by an equality on the minute.
    """
    stop = F.col("end_min") + F.when(F.col("end_min") < F.col("start_min"), DAY_MIN).otherwise(0)
    rows = calendar.select("shift", F.col("start_min").alias("from_min"), stop.alias("to_min"))
    rows = rows.withColumn("at", F.explode(F.sequence("from_min", "to_min")))
    return rows.select(
        F.pmod("at", F.lit(DAY_MIN)).cast("int").alias("tod_min"),
        F.floor(F.col("at") / DAY_MIN).cast("int").alias("back"),
        "shift", "from_min", "to_min",
    )


def first_of_minutes(calendar: DataFrame) -> DataFrame:
    """tod_min, whole, shift, back: the first shift of the calendar at each full minute and within it, one row each.

    Ends belong to a shift, and so does its start unless it runs past midnight.
    """
    wraps = F.col("end_min") < F.col("start_min")
    stop = F.col("end_min") + F.when(wraps, DAY_MIN).otherwise(0)
    full = F.when(F.col("start_min") + wraps.cast("int") <= stop, F.sequence(F.col("start_min") + wraps.cast("int"), stop))
    inner = F.when(F.col("start_min") < stop, F.sequence(F.col("start_min"), stop - 1))
    rows = [
        calendar.select("shift", "position", F.lit(whole).alias("whole"), F.explode(at).alias("at"))
        for whole, at in ((True, full), (False, inner))
    ]
    rows = rows[0].unionByName(rows[1]).select(
        F.pmod("at", F.lit(DAY_MIN)).cast("int").alias("tod_min"), "whole", "position",
        F.struct("shift", F.floor(F.col("at") / DAY_MIN).cast("int").alias("back")).alias("hit"),
    )
    first = rows.groupBy("tod_min", "whole").agg(F.min_by("hit", F.struct("position", F.col("hit.back"))).alias("hit"))
    return first.select("tod_min", "whole", "hit.shift", "hit.back")


def parse_calendar(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines `name,HH:mm,HH:mm` to (shift, start_min, end_min); other part counts are skipped."""
    part = F.split(F.col(line_col), ",")

    def minutes(text: Column) -> Column:
        hour = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int")
        minute = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("int")
        return hour * 60 + minute

    return (
        lines.where(F.size(part) == 3)
        .select(part[0].alias("shift"), part[1].alias("s"), part[2].alias("e"))
        .select("shift", minutes(F.col("s")).alias("start_min"), minutes(F.col("e")).alias("end_min"))
    )


def _instant(day: Column, minute: str) -> Column:
    return F.to_utc_timestamp(day.cast("timestamp") + F.make_dt_interval(mins=F.col(minute)), F.col("tz"))


def shift_windows(sites: DataFrame, first_day: str, last_day: str, shifts=DEFAULT_SHIFTS) -> DataFrame:
    """One row per site, local day and shift, with the shift's bounds in UTC.

    `sites` has Site and tz. Bounds are wall-clock times, so a shift over a clock change
    is an hour shorter or longer.
    """
    days = sites.select(
        "Site",
        "tz",
        F.explode(F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))).alias("shift_day"),
    )
    calendar = calendar_table(sites.sparkSession, shifts)
    # A calendar describes one day; it is one value that every day unfolds.
    rows = calendar.agg(F.collect_list(F.struct("shift", "start_min", "end_min"))).scalar()
    spans = days.select("Site", "tz", "shift_day", F.inline(rows))
    end_day = F.date_add("shift_day", (F.col("end_min") < F.col("start_min")).cast("int"))
    return spans.select(
        "Site", "shift_day", "shift",
        _instant(F.col("shift_day"), "start_min").alias("start_ts"),
        _instant(end_day, "end_min").alias("end_ts"),
    )


def with_windows(df: DataFrame, ts_col: str, zone_col: str = "tz", shifts=DEFAULT_SHIFTS, zones: DataFrame | None = None) -> DataFrame:
    """Rows with the shift windows near them: shift, shift_day, start_ts and end_ts (UTC).

    An index of zone offsets (of `zones.stored_index`; `df` is read for its zones unless it is given) tells the wall clock; the shifts that hold its
    minute are looked up in a table, and the index turns their wall-clock bounds into instants. Where a wall clock has just
    been changed, the one it would show without the change is looked up as well. So a shift of which the instant is part is
    always there, but a caller still compares the instant with the exact bounds. Rows in no shift are left out.
    """
    spark, columns = df.sparkSession, df.columns
    micros = f"unix_micros(`{ts_col}`)"
    index = stored_index(df.select(zone_col), zone_col) if zones is None else zones
    located = with_zone(df, index, micros, zone_col).selectExpr(
        "*", f"{micros} + {offset_at(micros)} AS _own", f"{micros} + {offset_before(micros)} AS _before"
    )
    walls = located.where("_own IS NOT NULL").selectExpr(
        "*", "explode(CASE WHEN _before IS NULL THEN array(_own) ELSE array(_own, _before) END) AS _wall"
    )
    walls = walls.selectExpr("*", f"CAST(pmod(_wall, {DAY}) div {MINUTE} AS INT) AS _tod")
    near = walls.join(shifts_of_minutes(calendar_table(spark, shifts)), F.expr("_tod = tod_min"))
    near = near.selectExpr("*", f"(_wall - pmod(_wall, {DAY})) div {DAY} - back AS _day")
    # What the own wall clock finds is not to be found again.
    minute = f"(_own - _day * {DAY} - pmod(_own - _day * {DAY}, {MINUTE})) div {MINUTE}"
    once = near.where(f"_wall = _own OR NOT ({minute}) BETWEEN from_min AND to_min")

    def bound(at: str) -> str:
        return f"timestamp_micros({instant_of(f'(_day * {DAY} + {at} * {MINUTE}L)')})"

    return once.select(
        *columns, "shift",
        F.expr("date_add(DATE '1970-01-01', CAST(_day AS INT)) AS shift_day"),
        F.expr(f"{bound('from_min')} AS start_ts"),
        F.expr(f"{bound('to_min')} AS end_ts"),
    )


def assign_shift(
    df: DataFrame, zone_col: str = "tz", ts_col: str = "Timestamp", shifts=DEFAULT_SHIFTS, zones: DataFrame | None = None
) -> DataFrame:
    """Add `shift` and `shift_day` (both NULL outside of shifts) from the local wall clock.

    Ends are inclusive. A shift past midnight belongs to the day it starts on; the very
    instant of its start does not count, as the plant's own test has it. The first matching
    shift of the calendar wins. Readings are not shuffled: the offset of the zone (of `zones.stored_index`; `df` is read for
    its zones unless it is given) and the shift of the minute come from two small tables.
    """
    spark, columns = df.sparkSession, df.columns
    micros = f"unix_micros(`{ts_col}`)"
    index = stored_index(df.select(zone_col), zone_col) if zones is None else zones
    located = with_zone(df, index, micros, zone_col).selectExpr("*", f"{micros} + {offset_at(micros)} AS _wall")
    located = located.drop(*INDEX_COLUMNS).selectExpr(
        "*", f"CAST(pmod(_wall, {DAY}) div {MINUTE} AS INT) AS _tod", f"pmod(_wall, {MINUTE}) = 0 AS _whole"
    )
    first = first_of_minutes(calendar_table(spark, shifts)).withColumnsRenamed({"shift": "_shift", "back": "_back"})
    found = located.join(first, F.expr("_tod = tod_min AND _whole = whole"), "left")
    day = f"date_add(DATE '1970-01-01', CAST((_wall - pmod(_wall, {DAY})) div {DAY} - _back AS INT))"
    return found.select(*columns, F.col("_shift").alias("shift"), F.expr(f"{day} AS shift_day"))


def join_windows(
    df: DataFrame, windows: DataFrame, keys: list[str], ts_col: str = "Timestamp"
) -> DataFrame:
    """Rows joined to the windows (start_ts, end_ts) that strictly contain them.

    For window tables no calendar can express. A window is listed once per UTC day it
    touches, so the join is an equality on (keys, day) with the range as a residual; one
    site's rows spread over its days, and adaptive execution splits a day that is still hot.
    """
    day = "_utc_day"
    by_day = windows.withColumn(
        day, F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts")))
    )
    return (
        df.withColumn(day, F.to_date(ts_col))
        .join(by_day, [*keys, day])
        .where((F.col(ts_col) > F.col("start_ts")) & (F.col(ts_col) < F.col("end_ts")))
        .drop(day)
    )


def shift_break(spans: DataFrame, hours=BREAK_HOURS) -> DataFrame:
    """Minute series over each span (start_ts, end_ts, band, offset_min), at the break hours.

    Steps are whole minutes from `start_ts`, the end included; `offset_min` shifts UTC to local
    time. Spans unfold hour by hour, and only the break hours unfold into minutes. A few spans become many rows, so their
    days are dealt over all tasks first.
    """
    step = F.expr("INTERVAL 1 HOUR")
    other = [c for c in spans.columns if c not in ("start_ts", "end_ts")]
    days = spans.where(F.col("start_ts") <= F.col("end_ts")).select(
        *other, "start_ts", "end_ts",
        F.explode(F.sequence("start_ts", "end_ts", F.expr("INTERVAL 1 DAY"))).alias("_day"),
    )
    days = days.repartition(int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    day_end = F.least(F.col("end_ts"), F.col("_day") + F.expr("INTERVAL 1439 MINUTE"))
    chunks = days.withColumn("_hour", F.explode(F.sequence("_day", day_end, step)))
    offset = F.make_dt_interval(mins=F.col("offset_min"))
    # A chunk starts up to 59 minutes into an hour, so it can touch two clock hours.
    first_hour = F.hour(F.col("_hour") + offset)
    last_hour = F.hour(F.col("_hour") + F.expr("INTERVAL 59 MINUTE") + offset)
    near = chunks.where(first_hour.isin(*hours) | last_hour.isin(*hours))
    chunk_end = F.least(F.col("end_ts"), F.col("_hour") + F.expr("INTERVAL 59 MINUTE"))
    minutes = near.withColumn(
        "Timestamp", F.explode(F.sequence("_hour", chunk_end, F.expr("INTERVAL 1 MINUTE")))
    )
    return minutes.where(F.hour(F.col("Timestamp") + offset).isin(*hours)).select(
        *[c for c in other if c not in ("band", "offset_min")],
        "Timestamp",
        F.col("band").alias("Break"),
    )
