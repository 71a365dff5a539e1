"""Counters, cycle statistics, and the use cases built on top of the narrow table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.functions.text import number, whole_number
from plantlake.operators.carry import carry_forward, step_sums
from plantlake.operators.quantile import exact_median
from plantlake.schemas import (
    ACTUAL_CYCLE,
    DISCARDED,
    ENERGY,
    FAULTY_TIME,
    MANUFACTURED,
    SERIAL_NUMBER,
    STATUS,
)


def counter_delta(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Parts made and scrapped per key as max - min, in one pass over both counters."""

    def span(name: str):
        value = F.when(F.col("Name") == name, number("Value"))
        return F.coalesce(F.max(value) - F.min(value), F.lit(0.0))

    return (
        rows.where(F.col("Name").isin(MANUFACTURED, DISCARDED))
        .groupBy(*keys)
        .agg(span(MANUFACTURED).alias("num_prod"), span(DISCARDED).alias("num_scrap"))
    )


def counter_delta_safe(rows: DataFrame, name: str = MANUFACTURED, grain: str = "minute") -> DataFrame:
    """Increase of a counter per writer that survives restarts at 0 (own design).

    Readings of one instant count as their maximum. A step down is a restart: the new reading is
    what was counted since.
    """
    readings = (
        rows.where((F.col("Name") == name) & F.col("Timestamp").isNotNull())
        .groupBy("Subject", "Timestamp")
        .agg(F.max(number("Value")).alias("v"))
        .where(F.col("v").isNotNull())
    )
    step = F.when(F.col("next_v") >= F.col("v"), F.col("next_v") - F.col("v")).otherwise(F.col("next_v"))
    return step_sums(readings, ["Subject"], {"increase": (step, "double")}, grain=grain)


def fault_time(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Summed fault episodes per key, in milliseconds."""
    return (
        rows.where(F.col("Name") == FAULTY_TIME)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(number("Value")), F.lit(0.0)).alias("faulty_ms"))
    )


def cycle_stats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean actual cycle time per key, over whole milliseconds."""
    return (
        rows.where(F.col("Name") == ACTUAL_CYCLE)
        .groupBy(*keys)
        .agg(F.avg(whole_number("Value")).alias("avg_cycle"))
    )


def median_per_bucket(rows: DataFrame, name: str = ACTUAL_CYCLE, grain: str = "day") -> DataFrame:
    """Exact median of a field per time bucket."""
    readings = rows.where(F.col("Name") == name).select(
        F.date_trunc(grain, "Timestamp").alias("bucket"), number("Value").alias("v")
    )
    return exact_median(readings, ["bucket"], "v").withColumnRenamed("median", "median_value")


def throughput(rows: DataFrame, keys: list[str], width: str = "1 hour") -> DataFrame:
    """Counter increase (max - min) per key and tumbling window; works on streams too."""
    value = number("Value")
    return (
        rows.where((F.col("Name") == MANUFACTURED) & F.col("Timestamp").isNotNull())
        .groupBy(*keys, F.window("Timestamp", width).alias("w"))
        .agg((F.max(value) - F.min(value)).alias("produced"), F.count(F.lit(1)).alias("readings"))
        .select(*keys, F.col("w.start").alias("window_start"), "produced", "readings")
    )


def state_durations(rows: DataFrame, grain: str = "minute") -> DataFrame:
    """Milliseconds each writer spent in each status (own design).

    A status lasts until the next reading. Of several readings at one instant the highest
    status counts.
    """
    states = (
        rows.where((F.col("Name") == STATUS) & F.col("Timestamp").isNotNull())
        .groupBy("Subject", "Timestamp")
        .agg(F.max(whole_number("Value")).alias("state"))
        .where(F.col("state").isNotNull())
    )
    millis = F.unix_millis("next_Timestamp") - F.unix_millis("Timestamp")
    return step_sums(states, ["Subject"], {"duration_ms": (millis, "bigint")}, grain=grain, by="state")


def anomaly_zscore(rows: DataFrame, name: str, horizon_s: int = 86_400, min_rows: int = 3) -> DataFrame:
    """Readings with their z-score against the readings of their writer in the horizon before them (own design).

    The score is NULL where fewer than `min_rows` readings or no spread precede. A series is cut into
    pieces of one horizon, each with the piece before it as history, so that no window holds more than two
    horizons of a writer. Sums up to the reading less the sums up to its horizon give the rolling mean and
    variance in one pass; values are taken from the piece's mean, which keeps large values exact.
    """
    horizon = horizon_s * 1_000_000
    readings = (
        rows.where((F.col("Name") == name) & F.col("Timestamp").isNotNull())
        .select("Subject", "Timestamp", number("Value").alias("v"), F.unix_micros("Timestamp").alias("us"))
        .where(F.col("v").isNotNull())
        .withColumn("home", F.floor(F.col("us") / horizon))
    )
    pieces = readings.withColumn("piece", F.explode(F.array("home", F.col("home") + 1)))
    piece = Window.partitionBy("Subject", "piece")
    ordered = piece.orderBy("us")
    upto = ordered.rangeBetween(Window.unboundedPreceding, -1)
    outside = ordered.rangeBetween(Window.unboundedPreceding, -horizon - 1)
    centred = pieces.withColumn("d", F.col("v") - F.avg("v").over(piece))

    def rolling(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(upto), F.lit(0.0)) - F.coalesce(F.sum(value).over(outside), F.lit(0.0))

    sums = centred.select(
        *["Subject", "Timestamp", "v", "d", "home", "piece"],
        rolling(F.lit(1.0)).alias("n"),
        rolling(F.col("d")).alias("s"),
        rolling(F.col("d") * F.col("d")).alias("q"),
    ).where("piece = home")
    mean = F.col("s") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("q") - F.col("s") * mean, F.lit(0.0)) / (F.col("n") - 1))
    enough = F.col("n") >= max(min_rows, 2)
    score = F.when(enough, F.when(spread > 1e-6, (F.col("d") - mean) / spread))
    return sums.select("Subject", "Timestamp", F.col("v").alias("value"), score.alias("zscore"))


def forecast_linear(rows: DataFrame, name: str, keys: list[str], at) -> DataFrame:
    """Least-squares line per series and its value at an instant (own design).

    Slope and intercept come from sums that combine partially; time is in days.
    """
    from plantlake.operators.timerange import utc

    origin = F.lit("2024-01-01T00:00:00Z").cast("timestamp")

    def days(ts):
        return (F.unix_millis(ts) - F.unix_millis(origin)) / F.lit(86_400_000.0)

    x, y = days(F.col("Timestamp")), number("Value")
    return (
        rows.where((F.col("Name") == name) & F.col("Timestamp").isNotNull())
        .groupBy(*keys)
        .agg(
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.regr_count(y, x).alias("n"),
        )
        .withColumn("forecast", F.col("intercept") + F.col("slope") * days(utc(at)))
    )


def forecast_smoothed(rows: DataFrame, name: str, keys: list[str], alpha: float = 0.3, grain: str = "hour") -> DataFrame:
    """Level of simple exponential smoothing per series, which is its forecast, and its number of instants (own design).

    A step takes a level to `alpha * value + (1 - alpha) * level`, an affine map, and steps compose to one map a time piece: a
    factor and an offset that are sums over the piece. Pieces compose the same way, so no series is walked as a whole. The
    first value is the first level; readings of one instant are averaged, and those that are no number are left out.
    """
    from plantlake.operators.carry import PIECE, across_pieces, in_piece, with_piece

    keep = 1 - alpha
    value = number("Value")
    instants = (
        rows.where((F.col("Name") == name) & F.col("Timestamp").isNotNull() & value.isNotNull())
        .groupBy(*keys, "Timestamp")
        .agg(F.avg(value).alias("v"))
    )
    pieces = with_piece(instants, grain=grain)
    later = F.count(F.lit(1)).over(in_piece(keys).rowsBetween(1, Window.unboundedFollowing))
    maps = (
        pieces.withColumn("_weight", F.pow(F.lit(keep), later))
        .groupBy(*keys, PIECE)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.col("v") * F.col("_weight") * alpha).alias("_offset"),
            F.min_by("v", "Timestamp").alias("_first"),
        )
    )
    # What comes after a piece multiplies its offset by the factors of all later pieces.
    after = F.coalesce(F.sum("_n").over(across_pieces(keys).rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    return (
        maps.withColumn("_after", F.pow(F.lit(keep), after))
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("n"),
            F.sum(F.col("_offset") * F.col("_after")).alias("_offset"),
            F.min_by("_first", PIECE).alias("_start"),
        )
        .select(*keys, "n", (F.col("_offset") + F.pow(F.lit(keep), "n") * F.col("_start")).alias("forecast"))
    )


def product_trace(rows: DataFrame, writers: DataFrame, stations=("assembly", "test", "packaging")) -> DataFrame:
    """First and last sighting of each serial number per station, and its lead time (own design).

    `writers` maps Subject to Workcell.
    """
    # One row per writer and serial before the names are joined on.
    sightings = (
        rows.where((F.col("Name") == SERIAL_NUMBER) & F.col("Timestamp").isNotNull())
        .groupBy("Subject", F.col("Value").alias("serial"))
        .agg(F.min("Timestamp").alias("first_ts"), F.max("Timestamp").alias("last_ts"))
        .join(writers.select("Subject", "Workcell").distinct(), "Subject")
    )
    at = {s: F.min(F.when(F.col("Workcell") == s, F.col("first_ts"))) for s in stations}
    seen = sum((at[s].isNotNull().cast("int") for s in stations), F.lit(0))
    lead = F.unix_millis(F.max("last_ts")) - F.unix_millis(F.min("first_ts"))
    return sightings.where(F.col("Workcell").isin(*stations)).groupBy("serial").agg(
        *[first.alias(f"{s}_ts") for s, first in at.items()],
        seen.alias("n_stations"),
        lead.alias("lead_ms"),
    )


def carbon_footprint(
    telemetry: DataFrame, writers: DataFrame, intensity: DataFrame, grain: str = "minute"
) -> DataFrame:
    """Grams of CO2 per product: its energy times the intensity of the site (own design).

    Energy belongs to the serial number last announced by the same writer at or before the reading.
    Sites without an intensity (Site, g_per_kwh) take the average of the known ones. `writers`
    maps Subject to Site.
    """
    kwh = F.when(F.col("Name") == ENERGY, number("Value"))
    serial = F.when(F.col("Name") == SERIAL_NUMBER, F.col("Value"))
    instants = (
        telemetry.where(F.col("Name").isin(ENERGY, SERIAL_NUMBER) & F.col("Timestamp").isNotNull())
        .groupBy("Subject", "Timestamp")
        .agg(F.sum(kwh).alias("kwh"), F.max(serial).alias("serial"))
    )
    aligned = carry_forward(instants, ["Subject"], "serial", grain=grain)
    per_serial = (
        aligned.where(F.col("serial").isNotNull() & F.col("kwh").isNotNull())
        .groupBy("Subject", "serial")
        .agg(F.sum("kwh").alias("kwh"))
    )
    exact = intensity.select("Site", F.col("g_per_kwh").cast("double").alias("g_per_kwh"))
    average = exact.agg(F.avg("g_per_kwh")).scalar()
    site_of = (
        writers.select("Subject", "Site")
        .distinct()
        .join(exact, "Site", "left")
        .select("Subject", F.coalesce("g_per_kwh", average).alias("g"))
    )
    return (
        per_serial.join(site_of, "Subject")
        .groupBy("serial")
        .agg(
            F.sum("kwh").alias("kwh"),
            F.sum(F.col("kwh") * F.col("g")).alias("g_co2"),
        )
    )
