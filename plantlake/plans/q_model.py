"""Queries over information models and type catalogs built from the given tables."""

from pyspark.sql import functions as F

from plantlake.operators import graph, model, ontology
from plantlake.plans.fixtures import Plant
from plantlake.plans.registry import query
from plantlake.session import scratch
from plantlake.sources import files

# --- node sets: one download per order, one variable per line item --------------------

XMLNS = "http://opcfoundation.org/UA/2011/03/UANodeSet.xsd"
ITEMS = """SELECT l_orderkey, 'Order ' || CAST(l_orderkey AS STRING) AS Title, l_linenumber,
  'ns=1;s=' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS NodeId,
  'ns=1;i=' || CAST(l_orderkey AS STRING) AS ParentNodeId,
  CASE WHEN l_linenumber = 6 THEN 'InputArguments' WHEN l_returnflag = 'N' THEN '' ELSE 'Item ' || CAST(l_partkey AS STRING) END AS DisplayName,
  '1:Item' || CAST(l_partkey AS STRING) AS BrowseName, CASE WHEN l_linestatus = 'F' THEN '' ELSE 'Double' END AS DataType,
  l_linenumber = 7 AS has_rule, l_returnflag FROM lineitem"""


def _downloads(p: Plant):
    c = F.col
    name = (
        F.when(c("DisplayName") == "", F.lit("<DisplayName/>"))
        .when(
            c("l_returnflag") == "R",
            F.format_string('<DisplayName Locale="en">%s</DisplayName><DisplayName Locale="de">Teil</DisplayName>', c("DisplayName")),
        )
        .otherwise(F.format_string("<DisplayName>%s</DisplayName>", c("DisplayName")))
    )
    data_type = F.when(c("DataType") == "", F.lit("")).otherwise(F.lit(' DataType="Double"'))
    rule = F.when(c("has_rule"), F.lit('<Reference ReferenceType="HasModellingRule">i=78</Reference>')).otherwise(F.lit(""))
    variable = F.format_string(
        '<UAVariable NodeId="%s" BrowseName="%s" ParentNodeId="%s"%s>%s<References>'
        '<Reference ReferenceType="HasComponent" IsForward="false">%s</Reference>%s</References></UAVariable>',
        c("NodeId"), c("BrowseName"), c("ParentNodeId"), data_type, name, c("ParentNodeId"), rule,
    )
    # First line items are also listed as objects, under another name and parent.
    twin = F.when(
        c("l_linenumber") == 1,
        F.format_string('<UAObject NodeId="%s" ParentNodeId="i=58"><DisplayName>Twin</DisplayName></UAObject>', c("NodeId")),
    )
    items = p.sql(ITEMS).groupBy("l_orderkey").agg(
        F.array_join(F.collect_list(variable), "").alias("variables"),
        F.array_join(F.collect_list(twin), "").alias("twins"),
    )
    order_rule = F.when(
        c("o_orderstatus") == "P",
        F.lit('<References><Reference ReferenceType="HasModellingRule">i=78</Reference></References>'),
    ).otherwise(F.lit(""))
    joined = p.table("orders").join(items, c("o_orderkey") == c("l_orderkey"))
    xml = F.format_string(
        '<?xml version="1.0"?><UANodeSet xmlns="' + XMLNS + '"><NamespaceUris><Uri>http://example.org/%s/</Uri>'
        "<Uri>http://example.org/base/</Uri></NamespaceUris>%s"
        '<UAObject NodeId="ns=1;i=%s" ParentNodeId="i=85"><DisplayName>Order</DisplayName>%s</UAObject>%s</UANodeSet>',
        F.lower(F.substring("o_orderpriority", 1, 1)), c("variables"), c("o_orderkey"), order_rule, c("twins"),
    )
    doc = F.to_json(
        F.struct(
            F.format_string("Order %s", c("o_orderkey")).alias("title"),
            F.struct(c("o_orderpriority").alias("name")).alias("contributor"),
            F.struct(xml.alias("nodesetXml")).alias("nodeset"),
        )
    )
    return model.parse_downloads(joined.select(doc.alias("value")))


SQL_ITEMS = f", items AS ({ITEMS})"


@query(
    "model_variables",
    f"""{SQL_ITEMS} SELECT Title, o_orderpriority AS Contributor, 'http://example.org/' || substr(o_orderpriority, 1, 1) || '/' AS NamespaceUri,
          NodeId, DisplayName, BrowseName, DataType FROM items JOIN orders ON o_orderkey = l_orderkey""",
    "sites",
)
def model_variables(p: Plant):
    return model.model_variables(_downloads(p)).select(
        "Title", "Contributor", "NamespaceUri", "NodeId", "DisplayName", "BrowseName", "DataType"
    )


@query(
    "model_append",
    f"""{SQL_ITEMS}, named AS (SELECT * FROM items JOIN orders ON o_orderkey = l_orderkey WHERE DisplayName <> '')
        SELECT 'metadata' AS kind, Title AS source, '[Future]' AS text, 'UA Cloud Library' AS enterprise, -1 AS value_rank, count(*) AS n FROM named GROUP BY ALL
        UNION ALL SELECT 'telemetry', DisplayName, '[Future]', NULL, NULL, count(*) FROM named GROUP BY ALL
        UNION ALL SELECT 'live', Name, NULL, NULL, NULL, count(*) FROM tel GROUP BY ALL""",
    "tel",
)
def model_append(p: Plant):
    """Placeholders appended to a telemetry table with live rows, next to placeholder metadata."""
    # Both kinds of placeholders come from them: the documents are built and parsed once.
    models = scratch(p.spark, "variables")
    model.model_variables(_downloads(p)).write.parquet(models)
    variables = p.spark.read.parquet(models)
    now = F.to_timestamp(F.lit("2024-02-01T00:00:00Z"))
    path = scratch(p.spark, "telemetry")
    p.tel.write.parquet(path)
    model.future_telemetry(variables, now).write.mode("append").parquet(path)
    telemetry = p.spark.read.parquet(path)
    future = F.col("Value") == "[Future]"
    none = F.lit(None).cast("string")
    return (
        model.future_metadata(variables, now)
        .select(
            F.lit("metadata").alias("kind"), F.col("Workcell").alias("source"), F.col("Site").alias("text"),
            F.col("Enterprise").alias("enterprise"), F.col("ValueRank").alias("value_rank"),
        )
        .unionByName(
            telemetry.select(
                F.when(future, "telemetry").otherwise("live").alias("kind"), F.col("Name").alias("source"),
                F.when(future, F.col("Value")).alias("text"), none.alias("enterprise"), F.lit(None).cast("int").alias("value_rank"),
            )
        )
        .groupBy("kind", "source", "text", "enterprise", "value_rank")
        .agg(F.count(F.lit(1)).alias("n"))
    )


GRAPH = f"""{SQL_ITEMS}, v AS (SELECT Title, NodeId, ParentNodeId, DisplayName FROM items WHERE NOT has_rule AND DisplayName <> 'InputArguments'),
    o AS (SELECT 'Order ' || o_orderkey AS Title, 'ns=1;i=' || o_orderkey AS NodeId, 'i=85' AS ParentNodeId, 'Order' AS DisplayName
            FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
          UNION ALL SELECT Title, NodeId, 'i=58', 'Twin' FROM items WHERE l_linenumber = 1),
    g AS (SELECT coalesce(v.Title, o.Title) AS Title, coalesce(v.NodeId, o.NodeId) AS source, coalesce(v.ParentNodeId, o.ParentNodeId) AS target,
            coalesce(v.DisplayName, o.DisplayName) AS name
          FROM v FULL JOIN o ON v.Title = o.Title AND v.NodeId = o.NodeId)"""


def _graph(p: Plant):
    parsed = _downloads(p)
    return model.model_graph(model.model_variables(parsed), model.model_objects(parsed))


@query("model_graph", f"{GRAPH} SELECT Title, source, target, name FROM g", "sites")
def model_graph(p: Plant):
    return _graph(p)[0]


@query("model_edges", f"{GRAPH} SELECT Title, source, target FROM g WHERE target <> ''", "sites")
def model_edges(p: Plant):
    return _graph(p)[1]


@query(
    "model_lookup",
    f"""{SQL_ITEMS}, wanted AS (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN NodeId || '-gone' ELSE NodeId END AS NodeId FROM items)
        SELECT w.l_orderkey, w.NodeId, k.Title AS ModelTitle, k.BrowseName AS ModelBrowseName, k.DataType AS ModelDataType
        FROM wanted w LEFT JOIN items k ON k.NodeId = w.NodeId""",
    "sites",
)
def model_lookup(p: Plant):
    """All items against all imported models, seventh items under an id that no model has."""
    info = model.information_model(model.model_variables(_downloads(p)))
    gone = F.when(F.col("l_linenumber") == 7, F.concat("NodeId", F.lit("-gone"))).otherwise(F.col("NodeId"))
    rows = p.sql(ITEMS).select("l_orderkey", gone.alias("NodeId"))
    found = model.model_lookup(rows, info, by="NodeId")
    return found.select("l_orderkey", "NodeId", "ModelTitle", "ModelBrowseName", "ModelDataType")


@query(
    "model_lookup_name",
    f"""{SQL_ITEMS}, kinds AS (SELECT DISTINCT DisplayName, BrowseName, DataType FROM items WHERE DisplayName <> '')
        SELECT p_partkey, 'Item ' || p_partkey AS Name, k.BrowseName AS ModelBrowseName, k.DataType AS ModelDataType
        FROM part LEFT JOIN kinds k ON k.DisplayName = 'Item ' || p_partkey""",
    "sites",
)
def model_lookup_name(p: Plant):
    """Parts by the display name of their variables, each kind of variable once."""
    info = model.information_model(model.model_variables(_downloads(p))).where("DisplayName <> ''")
    none = F.lit(None).cast("string")
    kinds = info.drop("Contributor").withColumns({"Title": none, "NodeId": none}).distinct()
    rows = p.table("part").select("p_partkey", F.format_string("Item %s", F.col("p_partkey")).alias("Name"))
    return model.model_lookup(rows, kinds).select("p_partkey", "Name", "ModelBrowseName", "ModelDataType")


# --- type catalog: a type per part, brand and part type -------------------------------
# Parts extend their brand, large ones their part type too; brands extend one root.


def _type_documents(p: Plant):
    part = p.sql(
        "SELECT *, replace(p_brand, '#', '') AS brand, replace(p_type, ' ', '') AS kind FROM part"
    )
    c = F.col
    extends = F.when(
        c("p_size") > 25, F.format_string('["dtmi:plant:%s;1","dtmi:plant:%s;1"]', c("brand"), c("kind"))
    ).otherwise(F.format_string('"dtmi:plant:%s;1"', c("brand")))
    tags = F.when(
        c("p_size") > 40,
        F.lit(
            ',{"@type":"Property","name":"tags","schema":{"@type":"Map","mapKey":{"name":"k","schema":"string"},'
            '"mapValue":{"name":"v","schema":"boolean"}},"writable":true}'
        ),
    ).otherwise(F.lit(""))
    parts = part.select(
        F.format_string("/catalog/%s/Part%s.json", c("brand"), c("p_partkey")).alias("path"),
        F.format_string(
            '{"@id":"dtmi:plant:Part%s;1","@type":"Interface","displayName":"%s","extends":%s,"contents":['
            '{"@type":"Property","name":"size","schema":"integer"},'
            '{"@type":"Property","name":"level","schema":{"@type":"Enum","valueSchema":"string","enumValues":['
            '{"name":"Small","enumValue":"small"},{"name":"%s","enumValue":"%s"}]}},'
            '{"@type":"Relationship","name":"suppliedBy","target":"dtmi:plant:Supplier;1","maxMultiplicity":%s},'
            '{"@type":"Component","name":"label","schema":"dtmi:plant:Label;1"}%s]}',
            c("p_partkey"), c("p_name"), extends, c("kind"), F.lower("kind"), c("p_size"), tags,
        ).alias("value"),
    )
    brands = part.select("brand").distinct().select(
        F.format_string("/catalog/brands/%s.json", c("brand")).alias("path"),
        F.format_string(
            '{"@id":"dtmi:plant:%s;1","@type":"Interface","displayName":"%s","extends":"dtmi:plant:Root;1","contents":['
            '{"@type":"Property","name":"size","schema":"string"},{"@type":"Property","name":"origin","schema":"dateTime"}]}',
            c("brand"), c("brand"),
        ).alias("value"),
    )
    return parts.unionByName(brands)


def _catalog(p: Plant):
    return ontology.catalog(_type_documents(p), path_col="path")


TYPES = """, pt AS (SELECT *, replace(p_brand, '#', '') AS brand, replace(p_type, ' ', '') AS kind,
    'dtmi:plant:Part' || p_partkey || ';1' AS id FROM part),
  ext AS (SELECT id AS child, 'dtmi:plant:' || brand || ';1' AS parent FROM pt
    UNION ALL SELECT id, 'dtmi:plant:' || kind || ';1' FROM pt WHERE p_size > 25
    UNION ALL SELECT DISTINCT 'dtmi:plant:' || brand || ';1', 'dtmi:plant:Root;1' FROM pt)"""


@query(
    "onto_catalog",
    TYPES + """ SELECT id, 'Interface' AS type, p_name AS display_name, brand AS area, CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS n_extends,
      CASE WHEN p_size > 40 THEN 5 ELSE 4 END AS n_contents FROM pt
    UNION ALL SELECT DISTINCT 'dtmi:plant:' || brand || ';1', 'Interface', brand, 'brands', 1, 2 FROM pt""",
    "sites",
)
def onto_catalog(p: Plant):
    return _catalog(p).select(
        "id", "type", "display_name", "area",
        F.size("extends").alias("n_extends"), F.size("contents").alias("n_contents"),
    )


MEMBERS = TYPES + """, mem AS (
  SELECT id, 'Property' AS kind, 'size' AS name, NULL AS target, NULL AS max_multiplicity, false AS writable FROM pt
  UNION ALL SELECT id, 'Property', 'level', NULL, NULL, false FROM pt
  UNION ALL SELECT id, 'Relationship', 'suppliedBy', 'dtmi:plant:Supplier;1', p_size, false FROM pt
  UNION ALL SELECT id, 'Component', 'label', NULL, NULL, false FROM pt
  UNION ALL SELECT id, 'Property', 'tags', NULL, NULL, true FROM pt WHERE p_size > 40
  UNION ALL SELECT DISTINCT 'dtmi:plant:' || brand || ';1', 'Property', x, NULL, NULL, false FROM pt, (VALUES ('size'), ('origin')) v(x))"""


@query("onto_members", MEMBERS + " SELECT * FROM mem", "sites")
def onto_members(p: Plant):
    return ontology.members(_catalog(p)).select("id", "kind", "name", "target", "max_multiplicity", "writable")


@query("onto_extends", TYPES + " SELECT child, parent FROM ext", "sites")
def onto_extends(p: Plant):
    return ontology.extends_edges(_catalog(p))


@query(
    "onto_closure",
    TYPES + """ SELECT child AS descendant, parent AS ancestor, 1 AS depth FROM ext
      UNION ALL SELECT DISTINCT a.child, b.parent, 2 FROM ext a JOIN ext b ON a.parent = b.child""",
    "sites",
)
def onto_closure(p: Plant):
    return graph.closure(ontology.extends_edges(_catalog(p)))


@query(
    "effective_members",
    MEMBERS + """, up AS (SELECT child AS id, parent AS anc, 1 AS depth FROM ext UNION ALL SELECT DISTINCT a.child, b.parent, 2 FROM ext a JOIN ext b ON a.parent = b.child)
      SELECT id, name, defined_in, distance FROM (SELECT *, row_number() OVER (PARTITION BY id, name ORDER BY distance, defined_in) AS rn FROM (
        SELECT id, name, id AS defined_in, 0 AS distance FROM mem
        UNION ALL SELECT up.id, mem.name, up.anc, up.depth FROM up JOIN mem ON mem.id = up.anc) x) y WHERE rn = 1""",
    "sites",
)
def effective_members(p: Plant):
    cat = _catalog(p)
    found = ontology.inherited_members(ontology.members(cat), ontology.extends_edges(cat))
    return found.select("id", "name", "defined_in", "distance")


@query(
    "onto_edges",
    TYPES + """ SELECT id, 'suppliedBy' AS name, 'dtmi:plant:Supplier;1' AS target, 'Relationship' AS kind, p_size AS max_multiplicity FROM pt
      UNION ALL SELECT id, 'label', 'dtmi:plant:Label;1', 'Component', NULL FROM pt
      UNION ALL SELECT id, 'tags', 'string:boolean', 'Map', NULL FROM pt WHERE p_size > 40""",
    "sites",
)
def onto_edges(p: Plant):
    """Relationships and components, and map properties in the same shape."""
    cat = _catalog(p)
    mapped = ontology.maps(cat).select(
        "id", F.col("property").alias("name"), F.concat_ws(":", "key_schema", "value_schema").alias("target"),
        F.lit("Map").alias("kind"), F.lit(None).cast("int").alias("max_multiplicity"),
    )
    return ontology.relation_edges(cat).unionByName(mapped)


@query(
    "onto_files",
    TYPES + " SELECT DISTINCT 'dtmi:plant:' || brand || ';1' AS id, name FROM pt, (VALUES ('size'), ('origin')) m(name)",
    "sites",
)
def onto_files(p: Plant):
    """Brand types as one file each below a folder per brand, found again at any depth."""
    path = scratch(p.spark, "types")
    brands = _type_documents(p).where(F.startswith("path", F.lit("/catalog/brands")))
    folder = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    brands.select(folder.alias("folder"), "value").write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
    cat = ontology.catalog(files.read_documents(p.spark, path, "*.txt"), path_col="path")
    return ontology.members(cat).select("id", "name")


@query(
    "onto_enums",
    TYPES + " SELECT id, 'level' AS property, 'Small' AS name, 'small' AS value FROM pt UNION ALL SELECT id, 'level', kind, lower(kind) FROM pt",
    "sites",
)
def onto_enums(p: Plant):
    return ontology.enums(_catalog(p))


@query(
    "onto_parity",
    TYPES + """ SELECT id, 'property' AS fact, 'level' AS name, '' AS target, 'a' AS side, CAST(1 AS BIGINT) AS copies FROM pt WHERE p_size = 1
      UNION ALL SELECT id, 'property', 'evel', '', 'b', 1 FROM pt WHERE p_size = 1
      UNION ALL SELECT id, 'relationship', 'suppliedBy', 'dtmi:plant:Supplier;1', 'a', 1 FROM pt WHERE p_size = 2
      UNION ALL SELECT id, 'property', 'tags', '', 'a', 1 FROM pt WHERE p_size > 40
      UNION ALL SELECT 'dtmi:plant:Extra' || p_partkey || ';1', 'type', '', '', 'b', 1 FROM pt WHERE p_size = 3""",
    "sites",
)
def onto_parity(p: Plant):
    """All types against a second encoding of them with a few slips."""
    c = F.col
    part = p.sql("SELECT *, replace(p_brand, '#', '') AS brand, replace(p_type, ' ', '') AS kind FROM part")
    second = F.when(c("p_size") > 25, F.format_string(',{"href":"dtmi:plant:%s;1","rel":"tm:extends"}', c("kind"))).otherwise(F.lit(""))
    relation = F.when(
        c("p_size") != 2,
        F.lit('{"href":"dtmi:plant:Supplier;1","rel":"dtdl:suppliedBy","@type":"dtdl:Relationship"},'),
    ).otherwise(F.lit(""))
    form_b = part.select(
        F.format_string(
            '{"@id":"dtmi:plant:Part%s;1","@type":"tm:ThingModel","links":[%s'
            '{"href":"dtmi:plant:Label;1","rel":"tm:submodel","dtdl:name":"label"},'
            '{"href":"dtmi:plant:%s;1","rel":"tm:extends"}%s],'
            '"properties":{"size":{"type":"integer"},"%s":{"type":"string","oneOf":[{"const":"small"}]}}}',
            c("p_partkey"), relation, c("brand"), second, F.when(c("p_size") == 1, "evel").otherwise("level"),
        ).alias("value")
    ).unionByName(
        part.where("p_size = 3").select(
            F.format_string('{"@id":"dtmi:plant:Extra%s;1","@type":"tm:ThingModel"}', c("p_partkey")).alias("value")
        )
    ).unionByName(
        part.select("brand").distinct().select(
            F.format_string(
                '{"@id":"dtmi:plant:%s;1","@type":"tm:ThingModel","links":[{"href":"dtmi:plant:Root;1","rel":"tm:extends"}],'
                '"properties":{"size":{"type":"string"},"origin":{"type":"string","format":"date-time"}}}',
                c("brand"),
            ).alias("value")
        )
    )
    return ontology.parity(ontology.facts_a(_catalog(p)), ontology.facts_b(form_b))


@query(
    "type_map",
    TYPES + """ SELECT id, 'size' AS name, NULL AS rel, 'integer' AS json_type, NULL AS json_format, 'INT' AS spark_type FROM pt
      UNION ALL SELECT id, 'level', NULL, 'string', NULL, 'STRING' FROM pt
      UNION ALL SELECT id, 'suppliedBy', 'dtdl:suppliedBy', NULL, NULL, NULL FROM pt
      UNION ALL SELECT id, 'label', 'tm:submodel', NULL, NULL, NULL FROM pt
      UNION ALL SELECT id, 'tags', NULL, 'object', NULL, 'MAP<STRING,BOOLEAN>' FROM pt WHERE p_size > 40
      UNION ALL SELECT DISTINCT 'dtmi:plant:' || brand || ';1', 'size', NULL, 'string', NULL, 'STRING' FROM pt
      UNION ALL SELECT DISTINCT 'dtmi:plant:' || brand || ';1', 'origin', NULL, 'string', 'date-time', 'TIMESTAMP' FROM pt""",
    "sites",
)
def type_map(p: Plant):
    return ontology.map_types(ontology.members(_catalog(p))).drop("kind")


@query(
    "validate_instances",
    """SELECT CAST(p_partkey AS VARCHAR) AS instance, 'type' AS rule, 'size_text' AS detail FROM part WHERE p_retailprice < 950
       UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'enum', 'p_type=' || p_type FROM part
         WHERE p_type NOT IN (SELECT p_type FROM part GROUP BY p_type HAVING avg(p_size) > (SELECT avg(p_size) FROM part))
       UNION ALL SELECT CAST(l_partkey AS VARCHAR), 'multiplicity', 'suppliedBy=' || count(*) FROM lineitem GROUP BY l_partkey HAVING count(*) > 35""",
)
def validate_instances(p: Plant):
    """Parts with a numeric size, a restricted type, and a limit on their line items."""
    rows = p.table("part").select(
        "p_partkey",
        F.when(F.col("p_retailprice") < 950, "n/a").otherwise(F.col("p_size").cast("string")).alias("size_text"),
        "p_type",
        "p_brand",
    )
    allowed = p.sql(
        """SELECT 'p_type' AS property, p_type AS value FROM part GROUP BY p_type
           HAVING avg(p_size) > (SELECT avg(p_size) FROM part)"""
    )
    links = p.table("lineitem").select(F.col("l_partkey").alias("instance"), F.lit("suppliedBy").alias("name"))
    limits = p.spark.createDataFrame([("suppliedBy", 35)], "name STRING, max_multiplicity INT")
    return ontology.validate_instances(rows, "p_partkey", {"size_text": "int"}, allowed, links, limits)


@query(
    "tag_filter",
    """SELECT event_id, json_extract_string(props, '$.k') AS k,
         CASE WHEN event_type = 'view' THEN 'Ansicht' ELSE event_type END AS label
       FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
         AND (event_type = 'error' OR json_extract_string(props, '$.k') = '42')""",
)
def tag_filter(p: Plant):
    """Events by marker (error) or tag value (k = 42), labelled in German where there is a text."""
    events = p.table("events").select(
        "event_id",
        F.map_concat(
            F.from_json("props", "map<string,string>"), F.create_map(F.col("event_type"), F.lit("true"))
        ).alias("tags"),
        F.map_filter(
            F.create_map(F.lit("en"), F.col("event_type"), F.lit("de"), F.when(F.col("event_type") == "view", "Ansicht")),
            lambda k, v: v.isNotNull(),
        ).alias("texts"),
    )
    wanted = ontology.has_marker("tags", "error") | ontology.has_tag("tags", "k", "42")
    return events.where(ontology.has_marker("tags", "k") & wanted).select(
        "event_id", F.element_at("tags", F.lit("k")).alias("k"), ontology.in_language("texts", "de").alias("label")
    )
