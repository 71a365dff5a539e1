"""Queries over last known values, counters, OEE and alerts."""

from pyspark.sql import functions as F

from plantlake.functions import sqlfuncs, text
from plantlake.operators import analytics, lkv, monitor, oee, shifts
from plantlake.operators.spread import small
from plantlake.operators.zones import stored_index
from plantlake.plans.fixtures import Plant
from plantlake.plans.registry import query
from plantlake.session import scratch
from plantlake.sources.files import read_shift_calendar, read_tag_list

START, END = "2024-01-05T00:00:00Z", "2024-01-12T00:00:00Z"
WINDOW = "Timestamp > TIMESTAMP '2024-01-05 00:00:00' AND Timestamp < TIMESTAMP '2024-01-12 00:00:00'"
STATION = "DataSetName LIKE '%assembly%' AND DataSetName LIKE '%europe%'"
MD = (
    "Subject, Timestamp, DataSetName, MajorVersion, MinorVersion, Name, BuiltInType, DataType, ValueRank, "
    "Type, DisplayName, Workcell, Line, Area, Site, Enterprise, NamespaceUri, NodeId"
)


def _delta(name: str) -> str:
    value = f"CASE WHEN Name = '{name}' THEN TRY_CAST(Value AS DOUBLE) END"
    return f"coalesce(max({value}) - min({value}), 0.0)"


COUNTS = f"""{_delta('NumberOfManufacturedProducts')} AS good, {_delta('NumberOfDiscardedProducts')} AS scrap,
  coalesce(sum(CASE WHEN Name = 'FaultyTime' THEN TRY_CAST(Value AS DOUBLE) END), 0.0) AS faulty"""
AVAILABILITY = "CASE WHEN span > 0 THEN (span - faulty) / span ELSE 0.0 END"
PERFORMANCE = "CASE WHEN span - faulty > 0 THEN ideal * (good + scrap) / (span - faulty) ELSE 0.0 END"
QUALITY = "CASE WHEN good + scrap > 0 THEN good / (good + scrap) ELSE 0.0 END"
OEE = f"({AVAILABILITY}) * ({PERFORMANCE}) * ({QUALITY})"
SPAN = "CAST(7 * 86400000 AS DOUBLE) AS span, CAST(6000 AS DOUBLE) AS ideal"
STATION_COUNTS = f"""SELECT {SPAN}, {COUNTS} FROM big
  WHERE Subject IN (SELECT Subject FROM lkv WHERE {STATION}) AND {WINDOW}"""


# --- last known values ---------------------------------------------------------


@query("lkv_ties", f"SELECT {MD} FROM lkv", "lkv")
def lkv_ties(p: Plant):
    return lkv.metadata_lkv(p.md)


@query("lkv_one", f"SELECT {MD} FROM lkv_one", "lkv_one")
def lkv_one(p: Plant):
    return lkv.metadata_lkv(p.md, ties=False)


@query("stations", "SELECT DISTINCT Workcell, Site FROM lkv", "lkv")
def stations(p: Plant):
    return p.lkv.select("Workcell", "Site").distinct()


# --- station series and panels -------------------------------------------------


@query(
    "station_rows",
    f"SELECT Subject, Timestamp, Name, Value FROM big WHERE Subject IN (SELECT Subject FROM lkv WHERE {STATION})",
    "big", "lkv",
)
def station_rows(p: Plant):
    return monitor.station_rows(p.big, p.lkv, "assembly", "europe")


@query(
    "station_rows_ci",
    """SELECT Subject, Timestamp, Name, Value FROM big WHERE Subject IN (SELECT Subject FROM lkv
       WHERE contains(lower(DataSetName), 'assembly') AND contains(lower(DataSetName), 'europe'))""",
    "big", "lkv",
)
def station_rows_ci(p: Plant):
    return monitor.station_rows(p.big, p.lkv, "ASSEMBLY", "Europe", how="contains_ci")


SERIES = """SELECT t.Timestamp, {value} FROM {table} t JOIN lkv m ON m.Subject = t.Subject
  WHERE m.DataSetName LIKE '%assembly%' AND m.DataSetName LIKE '%europe%' AND t.Name = '{name}'
    AND t.Timestamp > TIMESTAMP '2024-01-05 00:00:00' AND t.Timestamp < TIMESTAMP '2024-01-12 00:00:00'"""


def _series(table: str, name: str, value: str) -> str:
    return SERIES.format(table=table, name=name, value=value)


def _of(p: Plant, name: str, table: str = "big", **kw):
    return monitor.station_series(getattr(p, table), p.lkv, "assembly", "europe", name, START, END, **kw)


@query("station_series", _series("big", "Status", "TRY_CAST(t.Value AS DOUBLE) AS NodeValue"), "big", "lkv")
def station_series(p: Plant):
    return monitor.newest_first(monitor.numeric_series(_of(p, "Status")))


@query(
    "station_series_once",
    f"""SELECT Timestamp, TRY_CAST(Value AS DOUBLE) AS NodeValue FROM big WHERE Name = 'Status' AND {WINDOW}
        AND Subject IN (SELECT Subject FROM lkv WHERE {STATION})""",
    "big", "lkv",
)
def station_series_once(p: Plant):
    return monitor.newest_first(monitor.numeric_series(_of(p, "Status", dedupe=True)))


@query("cycle_series", _series("tel", "ActualCycleTime", "TRY_CAST(t.Value AS DOUBLE) AS NodeValue"), "tel", "lkv")
def cycle_series(p: Plant):
    return monitor.numeric_series(_of(p, "ActualCycleTime", "tel"))


@query(
    "pressure_series",
    _series("tel", "Pressure", "CAST(trunc(TRY_CAST(t.Value AS DOUBLE)) AS INTEGER) AS NodeValue"),
    "tel", "lkv",
)
def pressure_series(p: Plant):
    return monitor.numeric_series(_of(p, "Pressure", "tel"), as_int=True)


@query(
    "panel_counts",
    "SELECT 'manufactured' AS panel, max(v) AS num_prod FROM ("
    + _series("big", "NumberOfManufacturedProducts", "CAST(trunc(TRY_CAST(t.Value AS DOUBLE)) AS INTEGER) AS v")
    + ") UNION ALL SELECT 'discarded', max(v) FROM ("
    + _series("big", "NumberOfDiscardedProducts", "CAST(trunc(TRY_CAST(t.Value AS DOUBLE)) AS INTEGER) AS v") + ")",
    "big", "lkv",
)
def panel_counts(p: Plant):
    made = monitor.panel_max(_of(p, "NumberOfManufacturedProducts", dedupe=True))
    scrap = monitor.panel_max(_of(p, "NumberOfDiscardedProducts", dedupe=True))
    return made.withColumn("panel", F.lit("manufactured")).unionByName(scrap.withColumn("panel", F.lit("discarded")))


@query(
    "energy_avg",
    "SELECT round(avg(v) * 1000, 2) AS average FROM (" + _series("big", "Pressure", "TRY_CAST(t.Value AS DOUBLE) AS v") + ")",
    "big", "lkv",
)
def energy_avg(p: Plant):
    counted = monitor.counted_series(p.big, p.lkv, "assembly", "europe", "Pressure", START, END)
    return monitor.panel_average(counted)


@query(
    "status_last_hour",
    """SELECT m.DataSetName, m.DisplayName, m.Workcell, m.Line, t.Timestamp, t.Value FROM lkv m JOIN big t ON t.Subject = m.Subject
       WHERE m.DataSetName LIKE '%assembly%' AND m.DataSetName LIKE '%europe%' AND t.Name = 'Status'
         AND t.Timestamp > TIMESTAMP '2024-01-19 12:00:00' AND t.Timestamp < TIMESTAMP '2024-01-20 12:00:00'""",
    "big", "lkv",
)
def status_last_hour(p: Plant):
    return monitor.status_of_station(p.big, p.lkv, "assembly", "europe", "2024-01-20T12:00:00Z", "24 HOUR")


# --- aggregates ------------------------------------------------------------------


@query(
    "counter_delta",
    f"""SELECT Subject, {_delta('NumberOfManufacturedProducts')} AS num_prod, {_delta('NumberOfDiscardedProducts')} AS num_scrap
        FROM big WHERE Name IN ('NumberOfManufacturedProducts', 'NumberOfDiscardedProducts') GROUP BY 1""",
    "big",
)
def counter_delta(p: Plant):
    return analytics.counter_delta(p.big, ["Subject"])


@query(
    "counter_delta_safe",
    """SELECT Subject, round(sum(CASE WHEN nv >= v THEN nv - v ELSE nv END), 4) AS increase FROM (
         SELECT Subject, v, lead(v) OVER (PARTITION BY Subject ORDER BY Timestamp) AS nv FROM (
           SELECT Subject, Timestamp, max(TRY_CAST(Value AS DOUBLE)) AS v FROM big
           WHERE Name = 'NumberOfManufacturedProducts' GROUP BY 1, 2) a) b
       WHERE nv IS NOT NULL GROUP BY 1""",
    "big",
)
def counter_delta_safe(p: Plant):
    return analytics.counter_delta_safe(p.big).withColumn("increase", F.round("increase", 4))


@query(
    "fault_time",
    "SELECT Subject, round(sum(TRY_CAST(Value AS DOUBLE)), 4) AS faulty_ms FROM tel WHERE Name = 'FaultyTime' GROUP BY 1",
    "tel",
)
def fault_time(p: Plant):
    return analytics.fault_time(p.tel, ["Subject"]).withColumn("faulty_ms", F.round("faulty_ms", 4))


@query(
    "cycle_avg",
    """SELECT Subject, round(avg(CAST(trunc(TRY_CAST(Value AS DOUBLE)) AS INTEGER)), 6) AS avg_cycle
       FROM big WHERE Name = 'ActualCycleTime' GROUP BY 1""",
    "big",
)
def cycle_avg(p: Plant):
    stats = analytics.cycle_stats(p.big, ["Subject"])
    return stats.withColumn("avg_cycle", F.round("avg_cycle", 6))


@query(
    "cycle_median",
    """SELECT CAST(date_trunc('day', Timestamp) AS TIMESTAMP) AS bucket, median(TRY_CAST(Value AS DOUBLE)) AS median_value
       FROM big WHERE Name = 'ActualCycleTime' GROUP BY 1""",
    "big",
)
def cycle_median(p: Plant):
    return analytics.median_per_bucket(p.big)


@query(
    "throughput_trend",
    """SELECT Subject, CAST(time_bucket(INTERVAL 6 HOUR, Timestamp, TIMESTAMP '2000-01-01 00:00:00') AS TIMESTAMP) AS window_start,
         max(TRY_CAST(Value AS DOUBLE)) - min(TRY_CAST(Value AS DOUBLE)) AS produced, count(*) AS readings
       FROM big WHERE Name = 'NumberOfManufacturedProducts' GROUP BY 1, 2""",
    "big",
)
def throughput_trend(p: Plant):
    return analytics.throughput(p.big, ["Subject"], "6 hours")


@query(
    "high_pressure_now",
    f"""SELECT Subject, Name, Timestamp, Value, 'Good' AS Quality FROM (SELECT *, row_number() OVER (PARTITION BY Subject, Name
          ORDER BY Timestamp DESC, Value DESC) AS rn FROM big WHERE Name = 'Pressure') x
        WHERE rn = 1 AND TRY_CAST(Value AS DOUBLE) > 2510
          AND Subject IN (SELECT Subject FROM lkv WHERE DataSetName LIKE '%test%' AND DataSetName LIKE '%asia%')""",
    "big", "lkv",
)
def high_pressure_now(p: Plant):
    found = monitor.high_now(p.big, p.lkv, "test", "asia", "Pressure", 2510)
    return found.select("Subject", "Name", "Timestamp", "Value", "Quality")


# --- OEE -------------------------------------------------------------------------


@query("oee_station", f"SELECT round({OEE}, 6) AS oee FROM ({STATION_COUNTS}) c", "big", "lkv")
def oee_station(p: Plant):
    result = oee.oee_station(p.big, p.lkv, "assembly", "europe", 6000, START, END)
    return result.select(F.round("oee", 6).alias("oee"))


@query("oee_pct", f"SELECT round(({OEE}) * 100, 2) AS oee_pct FROM ({STATION_COUNTS}) c", "big", "lkv")
def oee_pct(p: Plant):
    result = oee.oee_station(p.big, p.lkv, "assembly", "europe", 6000, START, END)
    return result.select(text.percent("oee").alias("oee_pct"))


@query(
    "oee_factors",
    f"""SELECT good, scrap, round(faulty, 6) AS faulty, round({AVAILABILITY}, 6) AS availability,
          round({PERFORMANCE}, 6) AS performance, round({QUALITY}, 6) AS quality, round({OEE}, 6) AS oee
        FROM ({STATION_COUNTS}) c""",
    "big", "lkv",
)
def oee_factors(p: Plant):
    result = oee.oee_station(p.big, p.lkv, "assembly", "europe", 6000, START, END)
    rounded = ["faulty", "availability", "performance", "quality", "oee"]
    return result.select("good", "scrap", *[F.round(c, 6).alias(c) for c in rounded])


LINE = f"""SELECT station, {OEE} AS oee FROM (
  SELECT s.station, {SPAN}, {COUNTS} FROM (SELECT DISTINCT Workcell AS station FROM lkv
    WHERE Site = 'europe' AND Workcell <> '' AND Workcell NOT IN ('publisher', 'mes', 'commander')) s
  LEFT JOIN (SELECT DISTINCT s2.station, b.* FROM (SELECT DISTINCT Workcell AS station FROM lkv WHERE Site = 'europe') s2
    JOIN (SELECT DISTINCT Subject AS sub, DataSetName FROM lkv WHERE DataSetName LIKE '%europe%') w ON w.DataSetName LIKE '%' || s2.station || '%'
    JOIN (SELECT row_number() OVER () AS id, * FROM big WHERE {WINDOW}) b ON b.Subject = w.sub) x ON x.station = s.station
  GROUP BY s.station) c"""


@query("oee_line", f"SELECT round(min(oee), 6) AS oee FROM ({LINE}) l", "big", "lkv")
def oee_line(p: Plant):
    line = oee.oee_line(p.big, p.lkv, "europe", 6000, START, END)
    return line.select(F.round("oee", 6).alias("oee"))


@query("oee_line_stations", f"SELECT station, round(oee, 6) AS oee FROM ({LINE}) l", "big", "lkv")
def oee_line_stations(p: Plant):
    line = oee.oee_stations_of_line(p.big, p.lkv, "europe", 6000, START, END)
    return line.select("station", F.round("oee", 6).alias("oee"))


@query("oee_sql_functions", f"""SELECT 'station' AS what, round({OEE}, 6) AS oee FROM ({STATION_COUNTS}) c
  UNION ALL SELECT 'line', round(min(oee), 6) FROM ({LINE}) l""", "big", "lkv")
def oee_sql_functions(p: Plant):
    """The same two figures through the SQL functions."""
    _sql_functions(p, p.big)
    window = f"TIMESTAMP '{START}', TIMESTAMP '{END}'"
    return p.sql(
        f"""SELECT 'station' AS what, round(oee_station('assembly', 'europe', 6000, {window}), 6) AS oee
            UNION ALL SELECT 'line', round(oee_line('europe', 6000, {window}), 6)"""
    )


@query(
    "oee_station_ci",
    f"""SELECT round({OEE}, 6) AS oee FROM (SELECT {SPAN}, {COUNTS} FROM big WHERE {WINDOW} AND Subject IN (
          SELECT Subject FROM lkv WHERE contains(lower(DataSetName), 'assembly') AND contains(lower(DataSetName), 'europe'))) c""",
    "big", "lkv",
)
def oee_station_ci(p: Plant):
    result = oee.oee_station(p.big, p.lkv, "ASSEMBLY", "Europe", 6000, START, END, how="contains_ci")
    return result.select(F.round("oee", 6).alias("oee"))


def _sql_functions(p: Plant, telemetry) -> None:
    telemetry.createOrReplaceTempView("plant_telemetry")
    p.md.createOrReplaceTempView("plant_metadata")
    sqlfuncs.create_lkv_view(p.spark, "plant_metadata", "plant_lkv")
    sqlfuncs.create_names_view(p.spark, "plant_metadata", "plant_names")
    sqlfuncs.create_functions(p.spark, "plant_telemetry", "plant_lkv", "plant_names")


@query(
    "sql_faulty_assets",
    """SELECT m.AssetName, t.Name, t.Value, t.Timestamp
       FROM tel t JOIN (SELECT DISTINCT Subject, split_part(DataSetName, ';', 1) AS AssetName FROM lkv) m ON m.Subject = t.Subject
       WHERE t.Name = 'FaultyTime' AND TRY_CAST(t.Value AS DOUBLE) > 0
         AND t.Timestamp BETWEEN TIMESTAMP '2024-01-17 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "tel", "lkv",
)
def sql_faulty_assets(p: Plant):
    _sql_functions(p, p.tel)
    return p.sql("SELECT * FROM faulty_assets(TIMESTAMP '2024-01-20 12:00:00', 3)")


@query(
    "sql_value_history",
    """SELECT Timestamp, Value FROM big WHERE Subject = '1' AND Name = 'Pressure'
       AND Timestamp BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'""",
    "big",
)
def sql_value_history(p: Plant):
    _sql_functions(p, p.big)
    return p.sql("SELECT * FROM value_history('1', 'Pressure', TIMESTAMP '2024-01-02 00:00:00', TIMESTAMP '2024-01-25 00:00:00')")


SHIFT_WINDOWS = """
shift_days AS (SELECT s.*, CAST(d AS DATE) AS shift_day FROM sites s,
  generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) g(d)),
shift_windows AS (SELECT Site, ideal_cycle_ms, shift_day, shift,
    timezone(tz, CAST(shift_day AS TIMESTAMP) + s * INTERVAL 1 MINUTE) AT TIME ZONE 'UTC' AS start_ts,
    timezone(tz, CAST(shift_day AS TIMESTAMP) + e * INTERVAL 1 MINUTE) AT TIME ZONE 'UTC' AS end_ts
  FROM shift_days, (VALUES ('Morning', 420, 840), ('Afternoon', 900, 1320), ('Night', 1380, 1800)) t(shift, s, e))"""
BY_SHIFT = f"""SELECT Site, Workcell, CAST(shift_day AS VARCHAR) AS shift_day, shift, {OEE} AS oee FROM (
  SELECT w.Site, o.Workcell, w.shift_day, w.shift, w.ideal_cycle_ms AS ideal,
    CAST(epoch_ms(w.end_ts) - epoch_ms(w.start_ts) AS DOUBLE) AS span, {COUNTS}
  FROM big b JOIN (SELECT DISTINCT Subject, Site, Workcell FROM lkv
      WHERE Workcell NOT IN ('publisher', 'mes', 'commander')) o ON o.Subject = b.Subject
    JOIN shift_windows w ON w.Site = o.Site AND b.Timestamp > w.start_ts AND b.Timestamp < w.end_ts
  WHERE b.Name IN ('NumberOfManufacturedProducts', 'NumberOfDiscardedProducts', 'FaultyTime')
  GROUP BY ALL) c"""


def _with_windows(body: str) -> str:
    return f", {SHIFT_WINDOWS.strip()} {body}"


def _by_shift(p: Plant):
    return oee.oee_by_shift(p.big, p.lkv, p.sites)


@query(
    "oee_by_shift",
    _with_windows(f"SELECT Site, Workcell, shift_day, shift, round(oee, 6) AS oee FROM ({BY_SHIFT}) s"),
    "big", "lkv", "sites",
)
def oee_by_shift(p: Plant):
    return _by_shift(p).select(
        "Site", "Workcell", F.col("shift_day").cast("string").alias("shift_day"), "shift", F.round("oee", 6).alias("oee")
    )


@query(
    "oee_by_calendar",
    _with_windows(f"SELECT Site, Workcell, shift_day, shift, round(oee, 6) AS oee FROM ({BY_SHIFT}) s"),
    "big", "lkv", "sites",
)
def oee_by_calendar(p: Plant):
    """The same from a calendar file that is written and read."""
    path = scratch(p.spark, "calendar")
    lines = ["Morning,07:00,14:00", "Afternoon,15:00,22:00", "no shift", "Night,23:00,06:00"]
    p.spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.text(path)
    found = oee.oee_by_shift(p.big, p.lkv, p.sites, read_shift_calendar(p.spark, path))
    return found.select(
        "Site", "Workcell", F.col("shift_day").cast("string").alias("shift_day"), "shift", F.round("oee", 6).alias("oee")
    )


LOW_SHIFTS = _with_windows(
    f"SELECT Site, Workcell, shift_day, shift, round(oee * 100, 2) AS oee_pct FROM ({BY_SHIFT}) s WHERE round(oee * 100, 2) < 10"
)


@query("oee_alert", LOW_SHIFTS, "big", "lkv", "sites")
def oee_alert(p: Plant):
    alerts = oee.low_oee_alerts(_by_shift(p))
    return alerts.select(
        "Site", "Workcell", F.col("shift_day").cast("string").alias("shift_day"), "shift", "oee_pct"
    )


# --- shifts ----------------------------------------------------------------------

LOCAL = """SELECT b.Subject, b.Timestamp, b.Name, s.Site, (b.Timestamp AT TIME ZONE 'UTC') AT TIME ZONE s.tz AS lt
  FROM big b JOIN writers w ON w.writer = CAST(b.Subject AS BIGINT) JOIN sites s ON s.Site = w.Site"""


@query(
    "shift_assign",
    f"""SELECT Site, Name, shift, CAST(CASE WHEN shift = 'Night' AND tod <= 21600 THEN CAST(lt AS DATE) - 1
          WHEN shift IS NULL THEN NULL ELSE CAST(lt AS DATE) END AS VARCHAR) AS shift_day, count(*) AS n
        FROM (SELECT *, CASE WHEN tod >= 25200 AND tod <= 50400 THEN 'Morning' WHEN tod >= 54000 AND tod <= 79200 THEN 'Afternoon'
            WHEN tod > 82800 OR tod <= 21600 THEN 'Night' END AS shift
          FROM (SELECT *, epoch_ms(lt) / 1000.0 - epoch_ms(date_trunc('day', lt)) / 1000.0 AS tod FROM ({LOCAL}) a) b) c
        GROUP BY ALL""",
    "big", "writers", "sites",
)
def shift_assign(p: Plant):
    where = p.writers.select(F.col("writer").cast("string").alias("Subject"), "Site").join(p.sites, "Site")
    assigned = shifts.assign_shift(p.big.join(small(where), "Subject"), zones=stored_index(p.sites))
    return assigned.groupBy("Site", "Name", "shift", F.col("shift_day").cast("string").alias("shift_day")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "shift_window_join",
    _with_windows(
        """SELECT w.Site, w.shift, CAST(w.shift_day AS VARCHAR) AS shift_day, b.Name, count(*) AS n
           FROM big b JOIN writers o ON o.writer = CAST(b.Subject AS BIGINT)
             JOIN shift_windows w ON w.Site = o.Site AND b.Timestamp > w.start_ts AND b.Timestamp < w.end_ts GROUP BY ALL"""
    ),
    "big", "writers", "sites",
)
def shift_window_join(p: Plant):
    windows = shifts.shift_windows(p.sites, "2023-12-30", "2024-02-02")
    where = p.writers.select(F.col("writer").cast("string").alias("Subject"), "Site")
    joined = shifts.join_windows(p.big.join(small(where), "Subject"), windows, ["Site"])
    return joined.groupBy("Site", "shift", F.col("shift_day").cast("string").alias("shift_day"), "Name").agg(
        F.count(F.lit(1)).alias("n")
    )


BREAKS = """SELECT Subject, ts AS Timestamp, CAST(1.5 AS DOUBLE) AS Break FROM (
         SELECT Subject, off, unnest(generate_series(a, b, INTERVAL 1 MINUTE)) AS ts
         FROM (SELECT Subject, CAST(CAST(Subject AS BIGINT) % 24 AS INTEGER) * 60 AS off, min(Timestamp) AS a, max(Timestamp) AS b
               FROM tel GROUP BY 1, 2) s) m
       WHERE hour(ts + off * INTERVAL 1 MINUTE) IN (14, 6)"""


@query("shift_break", BREAKS, "tel")
def shift_break(p: Plant):
    """Break bands over the time span of each writer, each at an offset of its own."""
    spans = p.tel.groupBy("Subject").agg(
        F.min("Timestamp").alias("start_ts"), F.max("Timestamp").alias("end_ts")
    )
    offset = (F.col("Subject").cast("bigint") % 24 * 60).cast("int")
    return shifts.shift_break(spans.withColumns({"offset_min": offset, "band": F.lit(1.5)}))


@query("sql_shift_break", BREAKS, "tel")
def sql_shift_break(p: Plant):
    """The same through the SQL table function, called for the span of each writer."""
    _sql_functions(p, p.tel)
    # Few rows become many, so they are dealt over all tasks before they unfold.
    parts = p.spark.conf.get("spark.sql.shuffle.partitions")
    return p.sql(
        f"""SELECT s.Subject, b.Timestamp, b.Break FROM (
             SELECT /*+ REPARTITION({parts}) */ Subject, CAST(CAST(Subject AS BIGINT) % 24 * 60 AS INT) AS off,
               min(Timestamp) AS a, max(Timestamp) AS z
             FROM plant_telemetry GROUP BY Subject) s, LATERAL shift_break(s.a, s.z, 1.5D, s.off) b"""
    )


@query(
    "shift_calendar",
    """SELECT 'S' || o_orderkey AS shift, CAST(o_custkey % 24 AS INTEGER) * 60 + 30 AS start_min, CAST(o_orderkey % 24 AS INTEGER) * 60 AS end_min
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def shift_calendar(p: Plant):
    """Calendar files with a line per order; lines of pending orders lack their end."""
    hour = F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0")
    until = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    line = F.concat(F.lit("S"), F.col("o_orderkey").cast("string"), F.lit(","), hour, F.lit(":30"))
    lines = p.table("orders").select(
        F.when(F.col("o_orderstatus") == "P", line)
        .otherwise(F.concat(line, F.lit(","), until, F.lit(":00")))
        .alias("value")
    )
    path = scratch(p.spark, "calendar")
    lines.write.text(path)
    return read_shift_calendar(p.spark, path)


@query(
    "tag_list",
    """SELECT 'ns=1;i=' || p_partkey AS NodeID, p_name AS TagName, p_size AS QueueSize, 'none' AS ObservabilityMode,
         500 AS SamplingMs FROM part""",
)
def tag_list(p: Plant):
    """A tag list with a line per part, written and read as CSV with a header."""
    tags = p.table("part").select(
        F.format_string("ns=1;i=%s", F.col("p_partkey")).alias("NodeID"),
        F.col("p_name").alias("TagName"),
        F.col("p_size").alias("QueueSize"),
        F.lit("none").alias("ObservabilityMode"),
        F.lit(500).alias("Sampling Interval Milliseconds"),
    )
    path = scratch(p.spark, "tags")
    tags.write.option("header", True).csv(path)
    return read_tag_list(p.spark, path)


# --- alerts ----------------------------------------------------------------------


@query(
    "asset_list",
    "SELECT DISTINCT split_part(DataSetName, ';', 1) AS AssetName FROM md WHERE Subject IN (SELECT Subject FROM tel)",
    "tel", "md",
)
def asset_list(p: Plant):
    return monitor.asset_list(p.tel, p.md)


FAULTS = """SELECT m.AssetName, t.Name, t.Value, t.Timestamp,
    '**' || m.AssetName || '** has a **' || t.Name || '** of **' || t.Value || '**' AS message, m.copies
  FROM tel t JOIN (SELECT Subject, split_part(DataSetName, ';', 1) AS AssetName, count(*) AS copies FROM md GROUP BY 1, 2) m
    ON m.Subject = t.Subject
  WHERE t.Name = 'FaultyTime' AND TRY_CAST(t.Value AS DOUBLE) > 0
    AND t.Timestamp BETWEEN TIMESTAMP '2024-01-17 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"""


@query("fault_alerts", FAULTS, "tel", "md")
def fault_alerts(p: Plant):
    return monitor.fault_alerts(p.tel, p.md, "2024-01-20T12:00:00Z")


@query(
    "fault_alerts_repeated",
    """SELECT split_part(m.DataSetName, ';', 1) AS AssetName, t.Name, t.Value, t.Timestamp FROM tel t JOIN md m ON m.Subject = t.Subject
       WHERE t.Name = 'FaultyTime' AND TRY_CAST(t.Value AS DOUBLE) > 0
         AND t.Timestamp BETWEEN TIMESTAMP '2024-01-17 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "tel", "md",
)
def fault_alerts_repeated(p: Plant):
    return monitor.fault_alerts(p.tel, p.md, "2024-01-20T12:00:00Z", repeat=True).drop("message")


COMMANDS = f"""SELECT Subject, Timestamp, TRY_CAST(Value AS DOUBLE) AS pressure, 'ns=2;i=424' AS object_id, 'ns=2;i=435' AS method_id,
          'plant/asset-operations/assembly-europe-asset/managementGroup/OpenPressureReliefValve' AS topic
        FROM tel WHERE Name = 'Pressure' AND TRY_CAST(Value AS DOUBLE) > 2520 AND Subject IN (SELECT Subject FROM lkv WHERE {STATION})"""


@query("pressure_trigger", COMMANDS, "tel", "lkv")
def pressure_trigger(p: Plant):
    return monitor.pressure_trigger(p.tel, p.lkv, "assembly", "europe", 2520, topic_root="plant/")
