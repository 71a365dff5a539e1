"""Type catalogs in two JSON encodings: members, inheritance, relations, enums, parity.

Form A lists `contents` and `extends`; form B lists `links` and `properties`. Both become the same
tables, so every later step works on either.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.nested import unfold
from plantlake.operators.graph import jumps
from plantlake.operators.spread import spread_join
from plantlake.session import checkpoint

# --- schemas of the two forms -----------------------------------------------
# `extends` may be text or a list; `schema` text or an object: both are read as text.
FORM_A = (
    "struct<`@id`:string,`@type`:string,displayName:string,description:string,comment:string,"
    "extends:string,contents:array<struct<`@type`:string,name:string,displayName:string,"
    "description:string,schema:string,target:string,maxMultiplicity:int,minMultiplicity:int,"
    "writable:boolean>>>"
)
FORM_B = (
    "struct<`@id`:string,`@type`:string,title:string,description:string,"
    "links:array<struct<href:string,rel:string,`@type`:string,`dtdl:name`:string,"
    "`dtdl:displayName`:string,`dtdl:maxMultiplicity`:int>>,"
    "properties:map<string,struct<title:string,type:string,format:string,"
    "oneOf:array<struct<const:string,title:string>>,additionalProperties:string>>>"
)
ENUM = (
    "struct<`@type`:string,valueSchema:string,"
    "enumValues:array<struct<name:string,displayName:string,enumValue:string>>>"
)
MAP = (
    "struct<`@type`:string,mapKey:struct<name:string,schema:string>,"
    "mapValue:struct<name:string,schema:string>>"
)

# --- fixed values: primitive types in form A, form B and Spark ---------------
TYPE_MAP = (
    ("boolean", "boolean", None, "BOOLEAN"),
    ("date", "string", "date-time", "DATE"),
    ("dateTime", "string", "date-time", "TIMESTAMP"),
    ("double", "number", None, "DOUBLE"),
    ("duration", "string", "duration", "STRING"),
    ("float", "number", None, "FLOAT"),
    ("integer", "integer", None, "INT"),
    ("long", "number", None, "BIGINT"),
    ("string", "string", None, "STRING"),
    ("time", "string", "time", "STRING"),
)


def catalog(documents: DataFrame, text_col: str = "value", path_col: str | None = None) -> DataFrame:
    """Form A documents: id, type, display_name, description, area, extends, contents.

    `area` is the folder of the document, if its path is known.
    """
    area = (
        F.regexp_extract(F.col(path_col), r"([^/]+)/[^/]+$", 1) if path_col else F.lit(None).cast("string")
    )
    doc = documents.select(F.from_json(text_col, FORM_A).alias("d"), area.alias("area"))
    extends = F.col("d.extends")
    return doc.where(F.col("d.`@id`").isNotNull()).select(
        F.col("d.`@id`").alias("id"),
        F.col("d.`@type`").alias("type"),
        F.col("d.displayName").alias("display_name"),
        F.col("d.description").alias("description"),
        "area",
        F.when(F.startswith(extends, F.lit("[")), F.from_json(extends, "array<string>"))
        .when(extends.isNotNull(), F.array(extends))
        .alias("extends"),
        F.col("d.contents").alias("contents"),
    )


def members(cat: DataFrame) -> DataFrame:
    """One row per entry of `contents`; `schema` is a primitive name or JSON text."""
    return unfold(cat, F.col("contents"), "m", "id").select(
        "id",
        F.col("m.`@type`").alias("kind"),
        F.col("m.name").alias("name"),
        F.col("m.displayName").alias("display_name"),
        F.col("m.schema").alias("schema"),
        F.col("m.target").alias("target"),
        F.col("m.maxMultiplicity").alias("max_multiplicity"),
        F.coalesce("m.writable", F.lit(False)).alias("writable"),
    )


def extends_edges(cat: DataFrame) -> DataFrame:
    """Inheritance: (child, parent)."""
    return unfold(cat, F.col("extends"), "parent", F.col("id").alias("child"))


def relation_edges(cat: DataFrame) -> DataFrame:
    """Relationships and components: (id, name, target, kind, max_multiplicity)."""
    m = members(cat).where(F.col("kind").isin("Relationship", "Component"))
    return m.select(
        "id",
        "name",
        F.when(F.col("kind") == "Component", F.col("schema")).otherwise(F.col("target")).alias("target"),
        "kind",
        "max_multiplicity",
    )


def _schema_kind(schema: Column) -> Column:
    return F.get_json_object(schema, "$.@type")


def enums(cat: DataFrame) -> DataFrame:
    """Enum values: (id, property, name, value)."""
    m = members(cat).where((F.col("kind") == "Property") & F.startswith("schema", F.lit("{")))
    found = m.where(_schema_kind(F.col("schema")) == "Enum")
    values = F.from_json("schema", ENUM)["enumValues"]
    return unfold(found, values, "v", "id", F.col("name").alias("property")).select(
        "id", "property", F.col("v.name").alias("name"), F.col("v.enumValue").alias("value")
    )


def maps(cat: DataFrame) -> DataFrame:
    """Map properties: (id, property, key_schema, value_schema)."""
    m = members(cat).where((F.col("kind") == "Property") & F.startswith("schema", F.lit("{")))
    return (
        m.select("id", F.col("name").alias("property"), F.from_json("schema", MAP).alias("p"))
        .where(F.col("p.`@type`") == "Map")
        .select(
            "id",
            "property",
            F.col("p.mapKey.schema").alias("key_schema"),
            F.col("p.mapValue.schema").alias("value_schema"),
        )
    )


def type_map(spark) -> DataFrame:
    """Primitive types of form A with their form B and Spark counterparts."""
    return spark.createDataFrame(
        TYPE_MAP, "schema STRING, json_type STRING, json_format STRING, spark_type STRING"
    )


def map_types(member_rows: DataFrame) -> DataFrame:
    """Members with their form B shape and Spark type.

    Relationships become links named after them, components submodel links, enums `oneOf`, maps
    objects with `additionalProperties`; primitives follow the fixed table, whose ten rows
    are part of the expression.
    """
    pick = {
        c: F.create_map(*[F.lit(x) for row in TYPE_MAP for x in (row[0], row[i])])
        for i, c in ((1, "json_type"), (2, "json_format"), (3, "spark_type"))
    }
    kind, schema = F.col("kind"), F.col("schema")
    shape = _schema_kind(schema)
    return member_rows.select(
        "id",
        "name",
        "kind",
        F.when(kind == "Relationship", F.concat(F.lit("dtdl:"), F.col("name")))
        .when(kind == "Component", F.lit("tm:submodel"))
        .alias("rel"),
        F.when(kind != "Property", F.lit(None))
        .when(shape == "Enum", F.get_json_object(schema, "$.valueSchema"))
        .when(shape == "Map", F.lit("object"))
        .otherwise(F.element_at(pick["json_type"], schema))
        .alias("json_type"),
        F.when(kind == "Property", F.element_at(pick["json_format"], schema)).alias("json_format"),
        F.when(kind != "Property", F.lit(None))
        .when(shape == "Enum", F.element_at(pick["spark_type"], F.get_json_object(schema, "$.valueSchema")))
        .when(
            shape == "Map",
            F.concat(
                F.lit("MAP<STRING,"),
                F.element_at(pick["spark_type"], F.get_json_object(schema, "$.mapValue.schema")),
                F.lit(">"),
            ),
        )
        .otherwise(F.element_at(pick["spark_type"], schema))
        .alias("spark_type"),
    )


def facts_a(cat: DataFrame) -> DataFrame:
    """Form A as comparable facts: (id, fact, name, target)."""
    none = F.lit("")
    m = members(cat)
    return (
        cat.select("id", F.lit("type").alias("fact"), none.alias("name"), none.alias("target"))
        .unionByName(
            extends_edges(cat).select(
                F.col("child").alias("id"), F.lit("extends").alias("fact"), none.alias("name"),
                F.col("parent").alias("target"),
            )
        )
        .unionByName(
            m.select(
                "id",
                F.lower("kind").alias("fact"),
                "name",
                F.when(F.col("kind") == "Relationship", F.col("target"))
                .when(F.col("kind") == "Component", F.col("schema"))
                .alias("target"),
            ).withColumn("target", F.coalesce("target", none))
        )
    )


def facts_b(documents: DataFrame, text_col: str = "value") -> DataFrame:
    """Form B documents as the same facts."""
    none = F.lit("")
    doc = documents.select(F.from_json(text_col, FORM_B).alias("d")).where(F.col("d.`@id`").isNotNull())
    ident = F.col("d.`@id`").alias("id")
    links = unfold(doc, F.col("d.links"), "l", ident).select(
        "id",
        F.when(F.col("l.rel") == "tm:extends", "extends")
        .when(F.col("l.rel") == "tm:submodel", "component")
        .otherwise("relationship")
        .alias("fact"),
        F.when(F.col("l.rel") == "tm:extends", none)
        .when(F.col("l.rel") == "tm:submodel", F.col("l.`dtdl:name`"))
        .otherwise(F.regexp_replace("l.rel", "^dtdl:", ""))
        .alias("name"),
        F.col("l.href").alias("target"),
    )
    properties = unfold(doc, F.map_keys("d.properties"), "name", ident).select(
        "id", F.lit("property").alias("fact"), "name", none.alias("target")
    )
    return (
        doc.select(ident, F.lit("type").alias("fact"), none.alias("name"), none.alias("target"))
        .unionByName(links)
        .unionByName(properties)
        .select(
            "id", "fact", F.coalesce("name", none).alias("name"), F.coalesce("target", none).alias("target")
        )
    )


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Facts found in one encoding only, with the side that has them and how often more.

    Hardly a fact repeats within an encoding, so they are dealt before they are counted: a small file of documents unfolds into
    many facts, which one task should not hold.
    """
    facts = ["id", "fact", "name", "target"]
    counted = (
        a.select(*facts, F.lit(1).alias("n"))
        .unionByName(b.select(*facts, F.lit(-1).alias("n")))
        .repartition(*facts)
        .groupBy(*facts)
        .agg(F.sum("n").alias("n"))
    )
    return counted.where(F.col("n") != 0).select(
        *facts, F.when(F.col("n") > 0, "a").otherwise("b").alias("side"), F.abs("n").alias("copies")
    )


def effective_members(member_rows: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Own and inherited members of each type; of equal names the nearest definition wins.

    `ancestors` is the closure (ancestor, descendant, depth). Of equally near ones the first
    by id counts.
    """
    own = member_rows.withColumns({"defined_in": F.col("id"), "distance": F.lit(0)})
    # All types descend from a few roots, so the descendants of one ancestor are spread.
    inherited = (
        spread_join(ancestors, member_rows.withColumnRenamed("id", "ancestor"), ["ancestor"], "inner")
        .withColumnsRenamed({"ancestor": "defined_in", "depth": "distance", "descendant": "id"})
    )
    rest = [c for c in own.columns if c not in ("id", "name", "distance", "defined_in")]
    best = F.min(F.struct("distance", "defined_in", *rest)).alias("best")
    return (
        own.unionByName(inherited)
        .groupBy("id", "name")
        .agg(best)
        .select("id", "name", "best.*")
    )


def inherited_members(member_rows: DataFrame, edges: DataFrame) -> DataFrame:
    """The same from the inheritance edges (child, parent), without a table of all ancestors.

    Each round doubles how far up definitions are looked for: what a type has from nearer ones is joined by what the types
    2^k levels above have from theirs. So there are as many rows as types have members and rounds as the depth has digits in binary.
    """
    rest = [c for c in member_rows.columns if c not in ("id", "name")]
    # Dealt before they are sorted by type: a small file of documents unfolds into many wide members.
    own = member_rows.repartition("id", "name").groupBy("id", "name").agg(F.min(F.struct(*rest)).alias("own"))
    best = own.select("id", "name", F.lit(0).alias("distance"), F.col("id").alias("defined_in"))
    for k, jump in enumerate(jumps(edges)):
        above = best.withColumnRenamed("id", "far")
        more = spread_join(jump, above, ["far"], "inner").select(
            F.col("node").alias("id"), "name", (F.col("distance") + (1 << k)).alias("distance"), "defined_in"
        )
        nearest = F.min(F.struct("distance", "defined_in")).alias("nearest")
        best = checkpoint(best.unionByName(more).groupBy("id", "name").agg(nearest).select("id", "name", "nearest.*"))
    defined = own.select(F.col("id").alias("_id"), F.col("name").alias("_name"), "own")
    same = (F.col("defined_in") == F.col("_id")) & F.col("name").eqNullSafe(F.col("_name"))
    return best.join(defined, same).select("id", "name", "distance", "defined_in", "own.*")


def validate_instances(
    rows: DataFrame,
    id_col: str,
    value_cols: dict[str, str],
    enum_values: DataFrame,
    links: DataFrame,
    max_links: DataFrame,
) -> DataFrame:
    """Violations (instance, rule, detail) of instance rows against a type.

    value_cols maps a column to the Spark type its text must cast to. `enum_values` has property
    and value; a column named like the property must hold one of the values. `links` has
    instance and name, `max_links` name and max_multiplicity.
    """
    casts = F.filter(
        F.array(
            *[
                F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
                for c, t in value_cols.items()
            ]
        ),
        lambda c: c.isNotNull(),
    )
    instance = F.col(id_col).cast("string").alias("instance")
    bad_type = rows.select(instance, F.explode(casts).alias("detail")).select(
        "instance", F.lit("type").alias("rule"), "detail"
    )
    properties = [c for c in rows.columns if c != id_col and c not in value_cols]
    values = rows.select(
        instance,
        F.inline(F.array(*[F.struct(F.lit(c).alias("property"), F.col(c).cast("string").alias("value")) for c in properties])),
    ).where(F.col("value").isNotNull())
    restricted = enum_values.select("property").distinct()
    bad_enum = (
        spread_join(
            spread_join(values, restricted, ["property"], "left_semi"),
            enum_values.select("property", "value").distinct(),
            ["property", "value"],
            "left_anti",
        ).select("instance", F.lit("enum").alias("rule"), F.concat_ws("=", "property", "value").alias("detail"))
    )
    counted = links.groupBy(F.col("instance").cast("string").alias("instance"), "name").agg(
        F.count(F.lit(1)).alias("n")
    )
    bad_count = (
        spread_join(counted, max_links, ["name"], "inner")
        .where(F.col("n") > F.col("max_multiplicity"))
        .select("instance", F.lit("multiplicity").alias("rule"), F.concat_ws("=", "name", F.col("n").cast("string")).alias("detail"))
    )
    return bad_type.unionByName(bad_enum).unionByName(bad_count)


def has_marker(tags: str, tag: str) -> Column:
    """Whether a tag map holds a marker, whatever its value."""
    return F.map_contains_key(F.col(tags), tag)


def has_tag(tags: str, tag: str, value) -> Column:
    """Whether a tag map gives a tag the value."""
    return F.element_at(F.col(tags), F.lit(tag)) == value


def in_language(texts: str, language: str, fallback: str = "en") -> Column:
    """Text in a language from a map of language to text, or in the fallback one."""
    return F.coalesce(
        F.element_at(F.col(texts), F.lit(language)), F.element_at(F.col(texts), F.lit(fallback))
    )
