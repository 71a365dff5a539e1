"""Time zones as a table: the offset of a zone at an instant, and the instant of a wall clock, without a zone conversion a row.

Instants are cut into cells of 2^19 seconds, a little over six days. No zone of the tz database ever changed its offset
twice within a cell, so a cell holds one change at most. A row of the index has the offsets around its cell and the changes
in it and in its two neighbours, so that wall clocks up to six days away turn into instants by arithmetic alone.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.session import path_exists, scratch

#: Seconds of a cell as a power of two.
CELL_BITS = 19
SECOND = 1_000_000
#: Years whose changes an index knows by default; times beyond have the offset of its nearest cell.
FIRST_YEAR, LAST_YEAR = 1970, 2100
#: Earlier than any change.
NEVER = -(1 << 61)

#: Columns of the index besides the keys: three changes, and the offsets before, between and after them, in microseconds.
CHANGES = ("_change_0", "_change_1", "_change_2")
OFFSETS = ("_offset_0", "_offset_1", "_offset_2", "_offset_3")


def _offset(second: Column, zone: Column) -> Column:
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(second), zone)) - second


def _edge(year: int) -> Column:
    return F.shiftright(F.unix_seconds(F.lit(f"{year}-01-01 00:00:00+00:00").cast("timestamp")), CELL_BITS)


def zone_index(zones: DataFrame, zone_col: str = "tz", first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """The index of the zones named in `zones`: one row for each zone and cell.

    A few thousand zone conversions a zone build it, however many readings are looked up in it. Where a cell's edges have
    different offsets the change is found by halving the cell down to a second.
    """
    cells = F.sequence(_edge(first_year), _edge(last_year))
    rows = zones.select(F.col(zone_col).alias("tz")).where("tz IS NOT NULL").distinct().select("tz", F.explode(cells).alias("cell"))
    zone, begin = F.col("tz"), F.shiftleft("cell", CELL_BITS)
    rows = rows.withColumns({name: _offset(begin + F.lit((k - 1) << CELL_BITS), zone) for k, name in enumerate(OFFSETS)})
    halves = F.array(*[F.lit(1 << k).cast("long") for k in reversed(range(CELL_BITS))])

    def change(k: int) -> Column:
        start = begin + F.lit((k - 1) << CELL_BITS)
        before = F.col(OFFSETS[k])

        def step(same: Column, half: Column) -> Column:
            return F.when(_offset(start + same + half, zone) == before, same + half).otherwise(same)

        found = start + F.aggregate(halves, F.lit(0).cast("long"), step) + 1
        return F.when(before != F.col(OFFSETS[k + 1]), found * SECOND).otherwise(F.lit(NEVER))

    rows = rows.withColumns({name: change(k) for k, name in enumerate(CHANGES)})
    return rows.withColumns({name: F.col(name) * SECOND for name in OFFSETS})


def with_zone(df: DataFrame, index: DataFrame, micros: str, zone_col: str = "tz") -> DataFrame:
    """`df` with the index's columns for the zone in `zone_col` and the instant `micros`; rows of unknown zones have nulls.

    Here and below `micros` and `wall` are SQL texts of microseconds: parsing one text is many times faster than building
    its tree of columns call by call.
    """
    first, last = (f"shiftright(unix_seconds(TIMESTAMP '{year}-01-01 00:00:00+00:00'), {CELL_BITS})" for year in (FIRST_YEAR, LAST_YEAR))
    cell = f"shiftright((({micros}) - pmod({micros}, {SECOND}L)) div {SECOND}, {CELL_BITS})"
    known = F.expr(f"greatest({first}, least({last}, {cell}))")
    lookup = index.withColumnsRenamed({"tz": "_tz", "cell": "_cell"})
    return df.join(lookup, (df[zone_col] == F.col("_tz")) & (known == F.col("_cell")), "left").drop("_tz", "_cell")


def offset_at(micros: str) -> str:
    """SQL of the offset in force at an instant near the cell."""
    cases = " ".join(f"WHEN {micros} < {change} THEN {offset}" for change, offset in zip(CHANGES, OFFSETS, strict=False))
    return f"CASE {cases} ELSE {OFFSETS[-1]} END"


def offset_before(micros: str) -> str:
    """SQL of the offset before the last change, where that lies back less than what it changed; else null.

    Only there does a wall clock read what it has read before, or something it has just skipped.
    """
    cases = [
        f"WHEN {micros} >= {change} AND {micros} - {change} < abs({OFFSETS[k + 1]} - {OFFSETS[k]}) THEN {OFFSETS[k]}"
        for k, change in reversed(list(enumerate(CHANGES)))
    ]
    return f"CASE {' '.join(cases)} END"


def instant_of(wall: str) -> str:
    """SQL of the instant at which a wall clock near the cell shows `wall`: of two the earlier, a skipped time by the offset before."""
    cases = [
        f"WHEN {wall} < {change} + greatest({OFFSETS[k]}, {OFFSETS[k + 1]}) THEN {wall} - {OFFSETS[k]}"
        for k, change in enumerate(CHANGES)
    ]
    return f"CASE {' '.join(cases)} ELSE {wall} - {OFFSETS[-1]} END"


INDEX_COLUMNS = (*CHANGES, *OFFSETS)


#: Where the indexes of this process's applications lie, by application and zones.
_STORED: dict[tuple, tuple] = {}


def stored_index(zones: DataFrame, zone_col: str = "tz") -> DataFrame:
    """The index of the zones named in `zones`, written to the shared folder once in an application and read again later.

    The names of the distinct zones, at most as many as the tz database has, are read now to find it.
    """
    spark = zones.sparkSession
    names = tuple(sorted(zones.agg(F.collect_set(zone_col)).first()[0]))
    key = (spark.sparkContext.applicationId, names)
    if key not in _STORED or not path_exists(spark, _STORED[key][0]):
        path = scratch(spark, "zones")
        index = zone_index(zones, zone_col)
        index.write.parquet(path)
        _STORED[key] = path, index.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)
