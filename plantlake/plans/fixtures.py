"""Plant tables derived from the given tables, in SQL that Spark and DuckDB both read.

Every derived table grows with the tables it comes from:

  writers    one per supplier, with its data set name and hierarchy
  tel        one reading per event, ten fields
  big        one reading per line item, seven fields, one month
  md         ten field descriptions per order (a metadata message)
  edges      region, nation, supplier and customer as a hierarchy
  sites      one per region, with time zone and ideal cycle time
"""

from pyspark.sql import DataFrame, SparkSession

from plantlake.session import use_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

# --- fixed values: field names, built-in types and data types of the ten fields ---
FIELD_ROWS = """
  ('ProductSerialNumber', 12, 'i=12', 'serial'), ('NumberOfManufacturedProducts', 9, 'i=9', 'counter'),
  ('NumberOfDiscardedProducts', 9, 'i=9', 'counter'), ('OverallRunningTime', 9, 'i=9', 'duration'),
  ('FaultyTime', 9, 'i=9', 'duration'), ('Status', 6, 'i=6', 'state'),
  ('EnergyConsumption', 11, 'i=11', 'measure'), ('IdealCycleTime', 9, 'i=9', 'duration'),
  ('ActualCycleTime', 9, 'i=9', 'duration'), ('Pressure', 11, 'i=11', 'measure')
"""

SITES = """
SELECT lower(replace(r_name, ' ', '')) AS Site,
  CASE r_name WHEN 'AFRICA' THEN 'Africa/Johannesburg' WHEN 'AMERICA' THEN 'America/Los_Angeles'
    WHEN 'ASIA' THEN 'Asia/Tokyo' WHEN 'EUROPE' THEN 'Europe/Berlin' ELSE 'Asia/Dubai' END AS tz,
  CAST(CASE WHEN r_name = 'AMERICA' THEN 10000 ELSE 6000 END AS BIGINT) AS ideal_cycle_ms
FROM region
"""

WRITERS = """
SELECT writer, CASE WHEN server THEN workcell || '.' || line || '.' || area || '.' || site
    || '.contoso;nsu=http://example.org/UA/' || workcell || '/;i=' || CAST(379 + writer % 10 AS STRING)
    ELSE workcell || '-' || site || '-asset_telemetry' END AS DataSetName,
  workcell AS Workcell, CASE WHEN server THEN line ELSE '' END AS Line,
  CASE WHEN server THEN area ELSE '' END AS Area, site AS Site,
  CASE WHEN server THEN 'contoso' ELSE '' END AS Enterprise,
  CASE WHEN server THEN 'http://example.org/UA/' || workcell || '/' ELSE '' END AS NamespaceUri,
  CASE WHEN server THEN 'i=' || CAST(379 + writer % 10 AS STRING) ELSE '' END AS NodeId
FROM (
  SELECT s_suppkey AS writer, n_nationkey % 2 = 0 AS server,
    CASE CAST(s_suppkey % 5 AS INT) WHEN 0 THEN 'assembly' WHEN 1 THEN 'test' WHEN 2 THEN 'packaging'
      WHEN 3 THEN 'mes' ELSE 'publisher' END AS workcell,
    'line' || CAST(s_suppkey % 3 AS STRING) AS line, 'building' || CAST(n_nationkey AS STRING) AS area,
    lower(replace(r_name, ' ', '')) AS site
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
) w
"""

TEL = """
SELECT CAST(user_id % (SELECT count(*) FROM supplier) AS STRING) AS Subject, CAST(ts AS TIMESTAMP) AS Timestamp, Name,
  CASE WHEN Name IN ('ProductSerialNumber','NumberOfManufacturedProducts','NumberOfDiscardedProducts') THEN CAST(event_id AS STRING)
    WHEN Name = 'Status' THEN CAST(CAST(floor(value) AS BIGINT) % 5 AS STRING)
    WHEN Name = 'FaultyTime' THEN CASE WHEN value > 40 THEN CAST(CAST(value AS DECIMAL(18,2)) AS STRING) ELSE '0' END
    WHEN Name = 'Pressure' THEN CAST(CAST(2500 + value AS DECIMAL(18,2)) AS STRING)
    ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS Value
FROM (SELECT e.*, CASE CAST(event_id % 10 AS INT) WHEN 0 THEN 'ProductSerialNumber' WHEN 1 THEN 'NumberOfManufacturedProducts'
  WHEN 2 THEN 'NumberOfDiscardedProducts' WHEN 3 THEN 'OverallRunningTime' WHEN 4 THEN 'FaultyTime' WHEN 5 THEN 'Status'
  WHEN 6 THEN 'EnergyConsumption' WHEN 7 THEN 'IdealCycleTime' WHEN 8 THEN 'ActualCycleTime' ELSE 'Pressure' END AS Name FROM events e) x
"""

BIG = """
SELECT CAST(l_suppkey AS STRING) AS Subject,
  TIMESTAMP '2024-01-01 00:00:00' + ((l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 104729) % 2592000) * INTERVAL 1 SECOND AS Timestamp,
  CASE CAST(l_linenumber AS INT) WHEN 1 THEN 'NumberOfManufacturedProducts' WHEN 2 THEN 'NumberOfDiscardedProducts'
    WHEN 3 THEN 'FaultyTime' WHEN 4 THEN 'EnergyConsumption' WHEN 5 THEN 'ActualCycleTime' WHEN 6 THEN 'Pressure'
    ELSE 'Status' END AS Name,
  CAST(CASE CAST(l_linenumber AS INT) WHEN 1 THEN l_orderkey % 5000 WHEN 2 THEN l_partkey % 200
    WHEN 3 THEN CAST(l_quantity AS BIGINT) * 1000 WHEN 4 THEN CAST(l_quantity AS BIGINT)
    WHEN 5 THEN 5000 + CAST(l_quantity AS BIGINT) * 100 WHEN 6 THEN 2500 + CAST(l_quantity AS BIGINT)
    ELSE CAST(l_quantity AS BIGINT) % 5 END AS STRING) AS Value
FROM lineitem
"""

MD = f"""
SELECT CAST(w.writer AS STRING) AS Subject, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS Timestamp,
  w.DataSetName, CAST(o_orderkey AS BIGINT) AS MajorVersion, CAST(o_custkey AS BIGINT) AS MinorVersion,
  f.Name, f.BuiltInType, f.DataType, -1 AS ValueRank, f.Type, f.Name AS DisplayName,
  w.Workcell, w.Line, w.Area, w.Site, w.Enterprise, w.NamespaceUri, w.NodeId
FROM (SELECT *, o_custkey % (SELECT count(*) FROM supplier) AS sender FROM orders) o
  JOIN writers w ON w.writer = o.sender
  CROSS JOIN (VALUES {FIELD_ROWS}) f(Name, BuiltInType, DataType, Type)
"""

EDGES = """
SELECT 'R' || CAST(r_regionkey AS STRING) AS parent, 'N' || CAST(n_nationkey AS STRING) AS child, 'site' AS rel
  FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'N' || CAST(s_nationkey AS STRING), 'S' || CAST(s_suppkey AS STRING), 'area' FROM supplier
UNION ALL SELECT 'N' || CAST(c_nationkey AS STRING), 'C' || CAST(c_custkey AS STRING), 'area' FROM customer
"""

# Oracle side only: the last known metadata with and without ties.
LKV = """
SELECT * FROM md m WHERE EXISTS (SELECT 1 FROM (SELECT Subject, Name, max(Timestamp) AS mts FROM md GROUP BY 1, 2) l
  WHERE l.Subject = m.Subject AND l.Name = m.Name AND l.mts = m.Timestamp)
"""
LKV_ONE = """
SELECT Subject, Timestamp, DataSetName, MajorVersion, MinorVersion, Name, BuiltInType, DataType, ValueRank, Type,
  DisplayName, Workcell, Line, Area, Site, Enterprise, NamespaceUri, NodeId
FROM (SELECT m.*, row_number() OVER (PARTITION BY Subject, Name
  ORDER BY Timestamp DESC, MajorVersion DESC, MinorVersion DESC) AS rn FROM md m) r WHERE rn = 1
"""

SQL = {
    "sites": SITES, "writers": WRITERS, "tel": TEL, "big": BIG, "md": MD, "edges": EDGES,
    "lkv": LKV, "lkv_one": LKV_ONE,
}
NEEDS = {"md": ["writers"], "lkv": ["md"], "lkv_one": ["md"]}


def oracle(body: str, *tables: str) -> str:
    """A DuckDB statement with the derived tables it reads as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in tables:
        add(name)
    ctes = ",\n".join(f"{name} AS ({SQL[name].strip()})" for name in order)
    return f"WITH RECURSIVE {ctes}\n{body.strip()}" if ctes else body.strip()


class Plant:
    """The derived tables of one data folder as DataFrames.

    `stored` names a folder `store` has written them to; without it they are views.
    """

    def __init__(self, spark: SparkSession, folder: str, stored: str | None = None):
        self.spark = use_utc(spark)
        self.stored = stored
        for table in TABLES:
            spark.read.parquet(f"{folder}/{table}.parquet").createOrReplaceTempView(table)
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ("sites", "writers", "tel", "big", "md", "edges"):
            raise AttributeError(name)
        if name not in self._made and self.stored and name in ("tel", "big", "md"):
            self._made[name] = self.spark.read.parquet(f"{self.stored}/{name}")
        elif name not in self._made:
            if name == "md":
                self.writers.createOrReplaceTempView("writers")
            self._made[name] = self.spark.sql(SQL[name])
        return self._made[name]

    def store(self, path: str) -> None:
        """Write the large derived tables, telemetry laid out as the library stores it."""
        from plantlake.sources.tables import write_telemetry

        write_telemetry(self.tel, f"{path}/tel")
        write_telemetry(self.big, f"{path}/big")
        self.md.repartition(32).write.parquet(f"{path}/md")
        self.lkv.write.parquet(f"{path}/lkv")

    @property
    def lkv(self) -> DataFrame:
        from plantlake.operators.lkv import metadata_lkv

        # At scale the last known metadata is a maintained table, not recomputed per query.
        return self.spark.read.parquet(f"{self.stored}/lkv") if self.stored else metadata_lkv(self.md)
