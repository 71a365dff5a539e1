"""Views and SQL functions over the tables, for callers that write SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.functions.text import not_empty
from plantlake.operators.contains import containing
from plantlake.operators.expand import expand_metadata, expand_telemetry
from plantlake.operators.lkv import last_names, metadata_lkv
from plantlake.schemas import DISCARDED, FAULTY_TIME, MANUFACTURED, NON_PRODUCTION_WORKCELLS


def create_lkv_view(spark: SparkSession, metadata: str = "metadata", view: str = "metadata_lkv") -> None:
    """The last known metadata, ties included, as a view that follows the table."""
    metadata_lkv(spark.table(metadata)).createOrReplaceTempView(view)


#: What the functions read of the last known metadata.
NAMES = ("DataSetName", "Site", "Workcell")


def create_names_view(spark: SparkSession, metadata: str = "metadata", view: str = "metadata_names") -> None:
    """The distinct names of the last known metadata, as a view that follows the table."""
    last_names(spark.table(metadata), *NAMES).createOrReplaceTempView(view)


def create_expansions(spark: SparkSession, telemetry_raw: str = "telemetry_raw", metadata_raw: str = "metadata_raw") -> None:
    """Temporary SQL table functions telemetry_expand() and metadata_expand() over the landed documents."""
    made = {"telemetry": expand_telemetry(spark.table(telemetry_raw)), "metadata": expand_metadata(spark.table(metadata_raw))}
    for kind, rows in made.items():
        view = f"{kind}_expanded"
        rows.createOrReplaceTempView(view)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {kind}_expand() RETURNS TABLE ({columns}) RETURN SELECT * FROM {view}")


def production_stations(lkv: DataFrame) -> DataFrame:
    """Distinct Site and station that produce; an empty workcell is none."""
    stations = lkv.where(not_empty("Workcell") & ~F.col("Workcell").isin(*NON_PRODUCTION_WORKCELLS)).select(
        "Site", F.col("Workcell").alias("station")
    )
    return stations.where("Site IS NOT NULL").distinct()


def station_members(lkv: DataFrame) -> DataFrame:
    """Site, station and Subject: the writers whose data set name contains a site and a station of it.

    A station without writers has no row. Sites and stations are looked up in an index of the names, each by itself; a
    name's sites and stations meet where a site has the station.
    """
    stations = production_stations(lkv)
    names = lkv.select("Subject", "DataSetName").distinct()
    sites = containing(names, "DataSetName", stations, "Site")
    cells = containing(names, "DataSetName", stations, "station")
    pairs = sites.join(cells, "DataSetName").join(stations, ["Site", "station"], "left_semi")
    return names.join(pairs, "DataSetName").select("Subject", "Site", "station").distinct()


def create_functions(
    spark: SparkSession, telemetry: str = "telemetry", lkv: str = "metadata_lkv", names: str | None = None
) -> None:
    """Temporary SQL functions oee_station, oee_line, shift_break, faulty_assets, value_history.

    The two oee functions aggregate a window per writer and counter before it meets the names: `names` is the view that
    create_names_view makes of the same metadata, without it they are taken from `lkv`. A telemetry
    table that is partitioned by `date` is read for the dates of the window only. For all stations and shifts at
    once the DataFrame function oee_by_shift needs a single pass. shift_break unfolds break hours alone, in a single
    generator, so that a call for each row of a table is no join.
    """
    dated = "date" in spark.table(telemetry).columns

    def within(start: str, end: str) -> str:
        return f"date BETWEEN to_date({start}) AND to_date({end})" if dated else "true"

    if names is None:
        names = f"{lkv}_names_of"
        spark.table(lkv).select("Subject", *NAMES).distinct().createOrReplaceTempView(names)

    # One row per writer and counter of the window; all that meets the names.
    counters = f"""(
        SELECT r.Subject, r.Name AS counter, min(r.number) AS least_value, max(r.number) AS most_value, sum(r.number) AS total
        FROM (
          SELECT Subject, Name, try_cast(Value AS DOUBLE) AS number FROM {telemetry}
          WHERE Name IN ('{MANUFACTURED}', '{DISCARDED}', '{FAULTY_TIME}')
            AND Timestamp > since AND Timestamp < until AND {within("since", "until")}) r
        GROUP BY r.Subject, r.Name)"""

    def made(counter: str) -> str:
        only = f"FILTER (WHERE counter = '{counter}')"
        return f"coalesce(max(most_value) {only} - min(least_value) {only}, 0D)"

    sums = f"""coalesce(sum(total) FILTER (WHERE counter = '{FAULTY_TIME}'), 0D) AS faulty,
        {made(MANUFACTURED)} AS good, {made(DISCARDED)} AS scrap"""
    # The three factors multiply to ideal * good / window where all their denominators are positive.
    window_ms = "CAST(unix_millis(until) - unix_millis(since) AS DOUBLE)"
    figure = f"if({window_ms} > greatest(0D, faulty) AND good + scrap > 0, ideal_cycle_ms * good / {window_ms}, 0D)"
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION oee_station(
              station STRING, location STRING, ideal_cycle_ms DOUBLE, since TIMESTAMP, until TIMESTAMP)
            RETURNS DOUBLE RETURN
            SELECT {figure} FROM (SELECT {sums} FROM {counters} c JOIN (
              SELECT DISTINCT n.Subject FROM {names} n
              WHERE n.DataSetName LIKE concat('%', station, '%') AND n.DataSetName LIKE concat('%', location, '%')
            ) w ON w.Subject = c.Subject)"""
    )
    members, stations = f"{lkv}_members", f"{lkv}_stations"
    station_members(spark.table(names)).createOrReplaceTempView(members)
    production_stations(spark.table(names)).createOrReplaceTempView(stations)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION oee_line(
              location STRING, ideal_cycle_ms DOUBLE, since TIMESTAMP, until TIMESTAMP)
            RETURNS DOUBLE RETURN
            SELECT min(oee) FROM (SELECT {figure} AS oee FROM (SELECT station, {sums} FROM (
              SELECT m.station, c.counter, c.least_value, c.most_value, c.total
              FROM {members} m JOIN {counters} c ON c.Subject = m.Subject WHERE m.Site = location
              UNION ALL
              SELECT s.station, NULL, NULL, NULL, NULL FROM {stations} s WHERE s.Site = location) GROUP BY station))"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION shift_break(
              since TIMESTAMP, until TIMESTAMP, band DOUBLE, offset_min INT)
            RETURNS TABLE (Timestamp TIMESTAMP, Break DOUBLE) RETURN
            SELECT col, band FROM explode(flatten(transform(
              filter(sequence(since, until, INTERVAL 1 HOUR), h -> hour(h + make_dt_interval(0, 0, offset_min)) IN (14, 6)
                OR hour(h + make_dt_interval(0, 0, offset_min + 59)) IN (14, 6)),
              h -> filter(sequence(h, least(until, h + INTERVAL 59 MINUTE), INTERVAL 1 MINUTE),
                m -> hour(m + make_dt_interval(0, 0, offset_min)) IN (14, 6)))))"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION faulty_assets(as_of TIMESTAMP, days INT)
            RETURNS TABLE (AssetName STRING, Name STRING, Value STRING, Timestamp TIMESTAMP) RETURN
            WITH assets AS (SELECT DISTINCT Subject, split_part(DataSetName, ';', 1) AS AssetName FROM {names})
            SELECT assets.AssetName, f.Name, f.Value, f.Timestamp
            FROM {telemetry} f JOIN assets ON assets.Subject = f.Subject
            WHERE f.Name = '{FAULTY_TIME}' AND try_cast(f.Value AS DOUBLE) > 0
              AND f.Timestamp >= as_of - make_dt_interval(days) AND f.Timestamp <= as_of
              AND {within("as_of - make_dt_interval(days)", "as_of")}"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION value_history(
              writer STRING, field STRING, since TIMESTAMP, until TIMESTAMP)
            RETURNS TABLE (Timestamp TIMESTAMP, Value STRING) RETURN
            SELECT h.Timestamp, h.Value FROM {telemetry} h
            WHERE h.Subject = writer AND h.Name = field AND h.Timestamp BETWEEN since AND until
              AND {within("since", "until")}"""
    )
