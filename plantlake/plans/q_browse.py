"""Queries over the asset hierarchy, graphs, and the derived use cases."""

from pyspark.sql import functions as F

from plantlake.operators import analytics, browse, graph
from plantlake.plans.fixtures import Plant
from plantlake.plans.registry import query

ASSEMBLY = "http://example.org/UA/assembly/"
PATH = "concat_ws('/', nullif(Enterprise, ''), nullif(Site, ''), nullif(Area, ''), nullif(Line, ''), nullif(Workcell, '')"
VARIABLE = f"{PATH}, Name)"


@query("i3x_namespaces", "SELECT DISTINCT NamespaceUri FROM lkv WHERE NamespaceUri <> ''", "lkv")
def i3x_namespaces(p: Plant):
    return browse.namespaces(p.lkv)


@query(
    "i3x_types",
    "SELECT DISTINCT NamespaceUri || '#' || Type AS TypeId, NamespaceUri, Type FROM lkv WHERE NamespaceUri <> ''",
    "lkv",
)
def i3x_types(p: Plant):
    return browse.object_types(p.lkv)


@query(
    "i3x_types_of_namespace",
    f"SELECT DISTINCT NamespaceUri || '#' || Type AS TypeId, NamespaceUri, Type FROM lkv WHERE NamespaceUri = '{ASSEMBLY}'",
    "lkv",
)
def i3x_types_of_namespace(p: Plant):
    return browse.object_types(p.lkv, ASSEMBLY)


def _level(name: str, path: str, above: str) -> str:
    return f"SELECT {path} AS ElementId, {name} AS DisplayName, '{name}' AS Level, {above} AS ParentId FROM lkv WHERE {name} <> ''"


LEVELS = ["Enterprise", "Site", "Area", "Line", "Workcell"]


def _path(n: int) -> str:
    return "concat_ws('/', " + ", ".join(f"nullif({c}, '')" for c in LEVELS[:n]) + ")" if n else "''"


NODES = " UNION ".join(
    [_level(LEVELS[i], _path(i + 1), _path(i)) for i in range(5)]
    + [f"SELECT {VARIABLE}, Name, 'Variable', {_path(5)} FROM lkv"]
)


@query("uns_graph", NODES, "lkv")
def uns_graph(p: Plant):
    nodes, _ = browse.uns_graph(p.lkv)
    return nodes


@query("uns_edges", f"SELECT ParentId AS parent, ElementId AS child, 'contains' AS rel FROM ({NODES}) n WHERE ParentId <> ''", "lkv")
def uns_edges(p: Plant):
    _, edges = browse.uns_graph(p.lkv)
    return edges


@query(
    "i3x_roots",
    f"WITH n AS ({NODES}) SELECT ElementId, DisplayName FROM n WHERE ParentId = ''".replace("WITH n", ", n", 1),
    "lkv",
)
def i3x_roots(p: Plant):
    return browse.root_objects(*browse.uns_graph(p.lkv))


@query(
    "i3x_objects",
    f"SELECT DISTINCT {VARIABLE} AS ElementId, Name AS DisplayName FROM lkv WHERE NamespaceUri || '#' || Type = '{ASSEMBLY}#counter'",
    "lkv",
)
def i3x_objects(p: Plant):
    return browse.objects_of_type(browse.variables(p.lkv), f"{ASSEMBLY}#counter")


@query(
    "i3x_related",
    f""", n AS ({NODES}), ids AS (SELECT DISTINCT ElementId FROM n WHERE Level IN ('Site', 'Workcell'))
    SELECT ParentId AS ElementId, ElementId AS RelatedId, 'contains' AS rel, 'child' AS direction FROM (SELECT DISTINCT ElementId, ParentId FROM n) e
      WHERE ParentId <> '' AND ParentId IN (SELECT ElementId FROM ids)
    UNION ALL SELECT ElementId, ParentId, 'contains', 'parent' FROM (SELECT DISTINCT ElementId, ParentId FROM n) e
      WHERE ParentId <> '' AND ElementId IN (SELECT ElementId FROM ids)""",
    "lkv",
)
def i3x_related(p: Plant):
    nodes, edges = browse.uns_graph(p.lkv)
    return browse.related(nodes.where(F.col("Level").isin("Site", "Workcell")), edges.distinct(), "contains")


IDS = f"ids AS (SELECT DISTINCT {VARIABLE} AS ElementId, Subject, Name FROM lkv WHERE NamespaceUri = '{ASSEMBLY}')"


@query(
    "i3x_values",
    f""", {IDS} SELECT ElementId, Value, CASE WHEN Value IS NULL THEN 'Bad' ELSE 'Good' END AS Quality, Timestamp FROM (
      SELECT i.ElementId, t.Value, t.Timestamp, row_number() OVER (PARTITION BY i.ElementId, t.Subject, t.Name ORDER BY t.Timestamp DESC, t.Value DESC) AS rn
      FROM ids i JOIN big t ON t.Subject = i.Subject AND t.Name = i.Name) x WHERE rn = 1""",
    "lkv", "big",
)
def i3x_values(p: Plant):
    ids = browse.variables(p.lkv).where(F.col("NamespaceUri") == ASSEMBLY)
    return browse.current_values(p.big, ids)


@query(
    "i3x_history",
    f""", {IDS} SELECT i.ElementId, t.Timestamp, t.Value, 'Good' AS Quality FROM ids i JOIN big t ON t.Subject = i.Subject AND t.Name = i.Name
      WHERE t.Timestamp BETWEEN TIMESTAMP '2024-01-13 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "lkv", "big",
)
def i3x_history(p: Plant):
    ids = browse.variables(p.lkv).where(F.col("NamespaceUri") == ASSEMBLY)
    return browse.value_history(p.big, ids, "2024-01-20T12:00:00Z", default_window="7 DAY")


# --- graphs ------------------------------------------------------------------------


@query(
    "closure",
    """SELECT parent AS ancestor, child AS descendant, 1 AS depth FROM edges
       UNION ALL SELECT a.parent, b.child, 2 FROM edges a JOIN edges b ON a.child = b.parent""",
    "edges",
)
def closure(p: Plant):
    return graph.closure(p.edges)


@query(
    "hierarchy_paths",
    """SELECT 'R' || r_regionkey AS node, 0 AS depth, 'R' || r_regionkey AS path FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
       UNION ALL SELECT child, 1, parent || '/' || child FROM edges WHERE rel = 'site'
       UNION ALL SELECT b.child, 2, a.parent || '/' || a.child || '/' || b.child FROM edges a JOIN edges b ON a.child = b.parent""",
    "edges",
)
def hierarchy_paths(p: Plant):
    return graph.hierarchy_paths(p.edges)


@query(
    "hierarchy_nodes",
    """SELECT 'R' || r_regionkey AS node, NULL AS parent, 'R' || r_regionkey AS root, 0 AS depth FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
       UNION ALL SELECT child, parent, parent, 1 FROM edges WHERE rel = 'site'
       UNION ALL SELECT b.child, b.parent, a.parent, 2 FROM edges a JOIN edges b ON a.child = b.parent""",
    "edges",
)
def hierarchy_nodes(p: Plant):
    """Parent, root and depth of every node, for hierarchies too deep for all their paths."""
    return graph.ancestry(p.edges)


@query(
    "hierarchy_customer_paths",
    """SELECT b.child AS node, a.parent || '/' || a.child || '/' || b.child AS path FROM edges a JOIN edges b ON a.child = b.parent
       WHERE b.child IN (SELECT 'C' || c_custkey FROM customer WHERE c_acctbal < 0)""",
    "edges",
)
def hierarchy_customer_paths(p: Plant):
    """The paths of the customers in debt alone."""
    wanted = p.sql("SELECT 'C' || c_custkey AS node FROM customer WHERE c_acctbal < 0")
    return graph.path_texts(wanted, p.edges)


@query(
    "dangling_refs",
    """SELECT 'C' || o_custkey AS target, 'O' || o_orderkey AS source FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def dangling_refs(p: Plant):
    """Orders whose customer is not among those in credit."""
    edges = p.sql("SELECT 'C' || o_custkey AS target, 'O' || o_orderkey AS source FROM orders")
    ids = p.sql("SELECT 'C' || c_custkey AS id FROM customer WHERE c_acctbal >= 0")
    return graph.dangling(edges, ids)


# --- use cases (own design) ----------------------------------------------------------


@query(
    "state_durations",
    """SELECT Subject, state, CAST(sum(epoch_ms(nt) - epoch_ms(Timestamp)) AS BIGINT) AS duration_ms FROM (
         SELECT *, lead(Timestamp) OVER (PARTITION BY Subject ORDER BY Timestamp) AS nt FROM (
           SELECT Subject, Timestamp, max(CAST(Value AS INTEGER)) AS state FROM big WHERE Name = 'Status' GROUP BY 1, 2) a) b
       WHERE nt IS NOT NULL GROUP BY 1, 2""",
    "big",
)
def state_durations(p: Plant):
    return analytics.state_durations(p.big)


@query(
    "anomaly_zscore",
    """SELECT Subject, Timestamp, v AS value,
         CASE WHEN count(v) OVER w >= 3 AND stddev_samp(v) OVER w > 1e-6
           THEN round((v - avg(v) OVER w) / stddev_samp(v) OVER w, 6) END AS zscore
       FROM (SELECT Subject, Timestamp, TRY_CAST(Value AS DOUBLE) AS v FROM big WHERE Name = 'Pressure') r
       WHERE v IS NOT NULL
       WINDOW w AS (PARTITION BY Subject ORDER BY Timestamp
         RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
    "big",
)
def anomaly_zscore(p: Plant):
    scored = analytics.anomaly_zscore(p.big, "Pressure")
    return scored.withColumn("zscore", F.round("zscore", 6))


DAYS = "(epoch_ms(Timestamp) - epoch_ms(TIMESTAMP '2024-01-01 00:00:00')) / 86400000.0"


@query(
    "forecast_linear",
    f"""SELECT Subject, round(slope, 5) AS slope, CAST(n AS BIGINT) AS n, round(intercept + slope * 35.0, 5) AS forecast FROM (
          SELECT Subject, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_count(y, x) AS n
          FROM (SELECT Subject, TRY_CAST(Value AS DOUBLE) AS y, {DAYS} AS x FROM big WHERE Name = 'Pressure') a GROUP BY 1) b""",
    "big",
)
def forecast_linear(p: Plant):
    line = analytics.forecast_linear(p.big, "Pressure", ["Subject"], "2024-02-05T00:00:00Z")
    return line.select(
        "Subject", F.round("slope", 5).alias("slope"), "n", F.round("forecast", 5).alias("forecast")
    )


@query(
    "forecast_smoothed",
    """SELECT Subject, CAST(count(*) AS BIGINT) AS n,
         round(list_reduce(list(v ORDER BY Timestamp), lambda level, v: 0.3 * v + 0.7 * level), 5) AS forecast
       FROM (SELECT Subject, Timestamp, avg(TRY_CAST(Value AS DOUBLE)) AS v FROM big
             WHERE Name = 'Pressure' AND TRY_CAST(Value AS DOUBLE) IS NOT NULL GROUP BY 1, 2) a GROUP BY 1""",
    "big",
)
def forecast_smoothed(p: Plant):
    level = analytics.forecast_smoothed(p.big, "Pressure", ["Subject"])
    return level.withColumn("forecast", F.round("forecast", 5))


SIGHTINGS = """SELECT Subject, Timestamp, 'ProductSerialNumber' AS Name, 'P' || CAST(l_partkey AS STRING) AS Value FROM (
  SELECT l_partkey, CAST(l_suppkey AS STRING) AS Subject,
    TIMESTAMP '2024-01-01 00:00:00' + ((l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 104729) % 2592000) * INTERVAL 1 SECOND AS Timestamp
  FROM lineitem) s"""


@query(
    "product_trace",
    f"""SELECT Value AS serial, min(CASE WHEN Workcell = 'assembly' THEN Timestamp END) AS assembly_ts,
          min(CASE WHEN Workcell = 'test' THEN Timestamp END) AS test_ts, min(CASE WHEN Workcell = 'packaging' THEN Timestamp END) AS packaging_ts,
          CAST(count(DISTINCT Workcell) AS INTEGER) AS n_stations, epoch_ms(max(Timestamp)) - epoch_ms(min(Timestamp)) AS lead_ms
        FROM ({SIGHTINGS}) s JOIN writers w ON w.writer = CAST(s.Subject AS BIGINT)
        WHERE Workcell IN ('assembly', 'test', 'packaging') GROUP BY 1""",
    "writers",
)
def product_trace(p: Plant):
    """Parts as products: each line item is a sighting at the station of its supplier."""
    where = p.writers.select(F.col("writer").cast("string").alias("Subject"), "Workcell")
    return analytics.product_trace(p.sql(SIGHTINGS), where)


@query(
    "carbon_footprint",
    """, i AS (SELECT Subject, Timestamp, sum(CASE WHEN Name = 'EnergyConsumption' THEN TRY_CAST(Value AS DOUBLE) END) AS kwh,
            max(CASE WHEN Name = 'ProductSerialNumber' THEN Value END) AS serial FROM tel
          WHERE Name IN ('EnergyConsumption', 'ProductSerialNumber') GROUP BY 1, 2),
       a AS (SELECT Subject, kwh, last_value(serial IGNORE NULLS) OVER (PARTITION BY Subject ORDER BY Timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS serial FROM i),
       g AS (SELECT s.Site, avg(s_acctbal) + 400 AS g_per_kwh FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
             JOIN sites s ON s.Site = lower(replace(r_name, ' ', '')) WHERE s.Site <> 'asia' GROUP BY 1)
       SELECT serial, round(sum(kwh), 4) AS kwh, round(sum(kwh * coalesce(g.g_per_kwh, (SELECT avg(g_per_kwh) FROM g))), 3) AS g_co2
       FROM a JOIN writers w ON w.writer = CAST(a.Subject AS BIGINT) LEFT JOIN g ON g.Site = w.Site
       WHERE serial IS NOT NULL AND kwh IS NOT NULL GROUP BY 1""",
    "tel", "writers", "sites",
)
def carbon_footprint(p: Plant):
    """Intensities of all sites but one, which takes the average."""
    p.sites.createOrReplaceTempView("sites")
    intensity = p.sql(
        """SELECT lower(replace(r_name, ' ', '')) AS Site, avg(s_acctbal) + 400 AS g_per_kwh FROM supplier
           JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
           WHERE r_name <> 'ASIA' GROUP BY 1"""
    )
    where = p.writers.select(F.col("writer").cast("string").alias("Subject"), "Site")
    result = analytics.carbon_footprint(p.tel, where, intensity)
    return result.select("serial", F.round("kwh", 4).alias("kwh"), F.round("g_co2", 3).alias("g_co2"))
