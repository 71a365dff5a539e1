import json

import pytest

from plantlake.operators import endpoints, graph, model, ontology
from plantlake.sources import files

XML = """<?xml version="1.0"?><UANodeSet xmlns="http://opcfoundation.org/UA/2011/03/UANodeSet.xsd">
<NamespaceUris><Uri>http://example.org/own/</Uri><Uri>http://example.org/base/</Uri></NamespaceUris>
<UAVariable NodeId="ns=1;i=1" BrowseName="1:A" DataType="Double" ParentNodeId="ns=1;i=9"><DisplayName>Plain</DisplayName></UAVariable>
<UAVariable NodeId="ns=1;i=2" BrowseName="1:B"><DisplayName Locale="en">Attr &amp; x</DisplayName></UAVariable>
<UAVariable NodeId="ns=1;i=3" BrowseName="1:C"><DisplayName/></UAVariable>
<UAVariable NodeId="ns=1;i=4"><DisplayName>Rule</DisplayName><References><Reference ReferenceType="HasModellingRule">i=78</Reference></References></UAVariable>
<UAVariable NodeId="ns=1;i=5" ParentNodeId="i=1"><DisplayName>InputArguments</DisplayName></UAVariable>
<UAObject NodeId="ns=1;i=9" ParentNodeId="i=85"><DisplayName>Root</DisplayName></UAObject></UANodeSet>"""


@pytest.fixture
def parsed(spark):
    doc = json.dumps({"title": "Station", "contributor": {"name": "me"}, "nodeset": {"nodesetXml": XML}})
    return model.parse_downloads(spark.createDataFrame([(doc,), ("{}",), ("junk",)], "value STRING"))


def test_variables(parsed):
    rows = {r["NodeId"]: r for r in model.model_variables(parsed).collect()}
    assert rows["ns=1;i=1"]["DisplayName"] == "Plain" and rows["ns=1;i=2"]["DisplayName"] == "Attr & x"
    assert rows["ns=1;i=3"]["DisplayName"] == "" and rows["ns=1;i=2"]["DataType"] == ""
    assert rows["ns=1;i=1"]["NamespaceUri"] == "http://example.org/own/"
    assert rows["ns=1;i=4"]["has_rule"] and not rows["ns=1;i=1"]["has_rule"]


def test_placeholders_skip_unnamed(parsed):
    from pyspark.sql import functions as F

    now = F.to_timestamp(F.lit("2024-01-01T00:00:00Z"))
    md = model.future_metadata(model.model_variables(parsed), now)
    assert md.count() == 4 and {r["Enterprise"] for r in md.collect()} == {"UA Cloud Library"}
    assert {r["Value"] for r in model.future_telemetry(model.model_variables(parsed), now).collect()} == {"[Future]"}


def test_graph(parsed):
    nodes, edges = model.model_graph(model.model_variables(parsed), model.model_objects(parsed))
    assert sorted(r["source"] for r in nodes.collect()) == ["ns=1;i=1", "ns=1;i=2", "ns=1;i=3", "ns=1;i=9"]
    assert sorted((r["source"], r["target"]) for r in edges.collect()) == [("ns=1;i=1", "ns=1;i=9"), ("ns=1;i=9", "i=85")]


def test_nodeset_files(spark, tmp_path):
    (tmp_path / "Own.NodeSet.xml").write_text(XML)
    rows = model.model_variables(files.read_nodesets(spark, str(tmp_path)))
    assert rows.count() == 5 and rows.first()["Title"] == "Own"


def test_cycles_end(spark, rows_of):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("r", "a"), ("a", "b")], "parent STRING, child STRING")
    pairs = {(r["ancestor"], r["descendant"]): r["depth"] for r in graph.closure(edges).collect()}
    assert pairs[("a", "a")] == 3 and pairs[("r", "c")] == 3 and len(pairs) == 12
    assert len(graph.closure(edges, max_depth=1).collect()) == 4
    paths = [r["path"] for r in graph.hierarchy_paths(edges).collect()]
    assert sorted(paths) == ["r", "r/a", "r/a/b", "r/a/b/c"]


FORM_A = {
    "@id": "dtmi:x:Thing;1", "@type": "Interface", "displayName": "Thing", "extends": "dtmi:x:Base;1",
    "contents": [
        {"@type": "Property", "name": "level", "schema": {"@type": "Enum", "valueSchema": "string", "enumValues": [{"name": "A", "enumValue": "a"}]}},
        {"@type": "Property", "name": "when", "schema": "dateTime"},
        {"@type": "Property", "name": "texts", "schema": {"@type": "Map", "mapKey": {"name": "k", "schema": "string"}, "mapValue": {"name": "v", "schema": "string"}}},
        {"@type": "Relationship", "name": "partOf", "target": "dtmi:x:Thing;1", "maxMultiplicity": 1},
        {"@type": "Component", "name": "label", "schema": "dtmi:x:Label;1"},
    ],
}
FORM_B = {
    "@id": "dtmi:x:Thing;1", "@type": "tm:ThingModel",
    "links": [
        {"href": "dtmi:x:Thing;1", "rel": "dtdl:partOf", "@type": "dtdl:Relationship"},
        {"href": "dtmi:x:Label;1", "rel": "tm:submodel", "dtdl:name": "label"},
        {"href": "dtmi:x:Base;1", "rel": "tm:extends"},
    ],
    "properties": {"level": {"type": "string", "oneOf": [{"const": "a"}]}, "when": {"type": "string"}, "texts": {"type": "object"}},
}


@pytest.fixture
def folder(tmp_path):
    area = tmp_path / "models" / "Area"
    area.mkdir(parents=True)
    (area / "Thing.json").write_text(json.dumps(FORM_A, indent=2))
    (area / "Base.json").write_text(json.dumps({"@id": "dtmi:x:Base;1", "@type": "Interface", "contents": [{"@type": "Property", "name": "when", "schema": "string"}, {"@type": "Property", "name": "base", "schema": "double"}]}, indent=2))
    (area / "Thing.tm.jsonb").write_text(json.dumps(FORM_B, indent=2))
    return str(tmp_path / "models")


def test_catalog_from_files(spark, folder):
    cat = ontology.catalog(files.read_documents(spark, folder), path_col="path")
    rows = {r["id"]: r for r in cat.collect()}
    assert rows["dtmi:x:Thing;1"]["area"] == "Area" and rows["dtmi:x:Thing;1"]["extends"] == ["dtmi:x:Base;1"]
    assert ontology.members(cat).count() == 7
    assert [tuple(r) for r in ontology.enums(cat).collect()] == [("dtmi:x:Thing;1", "level", "A", "a")]
    assert [tuple(r) for r in ontology.maps(cat).collect()] == [("dtmi:x:Thing;1", "texts", "string", "string")]
    types = {(r["id"][7:-2], r["name"]): r["spark_type"] for r in ontology.map_types(ontology.members(cat)).collect()}
    assert types[("Thing", "when")] == "TIMESTAMP" and types[("Thing", "texts")] == "MAP<STRING,STRING>"


def test_nearest_definition_wins(spark, folder):
    cat = ontology.catalog(files.read_documents(spark, folder))
    found = ontology.effective_members(ontology.members(cat), graph.closure(ontology.extends_edges(cat)))
    rows = {r["name"]: r for r in found.where("id = 'dtmi:x:Thing;1'").collect()}
    assert rows["when"]["distance"] == 0 and rows["when"]["schema"] == "dateTime"
    assert rows["base"]["defined_in"] == "dtmi:x:Base;1" and len(rows) == 6


def test_parity(spark, folder):
    a = ontology.facts_a(ontology.catalog(files.read_documents(spark, folder, "Thing.json")))
    b = ontology.facts_b(files.read_documents(spark, folder, "*.jsonb"))
    assert ontology.parity(a, b).count() == 0
    assert ontology.parity(a, b.where("fact <> 'extends'")).collect()[0]["side"] == "a"


def test_dangling(spark, folder):
    cat = ontology.catalog(files.read_documents(spark, folder))
    assert [r["target"] for r in graph.dangling(ontology.relation_edges(cat), cat).collect()] == ["dtmi:x:Label;1"]


def test_type_map_covers_primitives(spark):
    rows = {r["schema"]: r for r in ontology.type_map(spark).collect()}
    assert len(rows) == 10 and rows["integer"]["spark_type"] == "INT" and rows["time"]["json_format"] == "time"


def test_validation(spark, rows_of):
    rows = spark.createDataFrame([(1, "5", "red"), (2, "x", "blue"), (3, None, None)], "id INT, size STRING, color STRING")
    enums = spark.createDataFrame([("color", "red")], "property STRING, value STRING")
    links = spark.createDataFrame([(1, "partOf"), (1, "partOf"), (2, "partOf")], "instance INT, name STRING")
    limits = spark.createDataFrame([("partOf", 1)], "name STRING, max_multiplicity INT")
    found = ontology.validate_instances(rows, "id", {"size": "int"}, enums, links, limits)
    assert rows_of(found) == [("1", "multiplicity", "partOf=2"), ("2", "enum", "color=blue"), ("2", "type", "size")]


def test_endpoints(spark):
    doc = json.dumps([
        {"EndpointUrl": "opc.tcp://Assembly.Munich/", "OpcNodes": [{"Id": "nsu=x;i=406", "OpcSamplingInterval": 500}, {"Id": "nsu=x;s=odd"}]},
        {"EndpointUrl": "opc.tcp://mes.munich:4841/", "OpcAuthenticationMode": "UsernamePassword", "OpcNodes": []},
    ])
    docs = spark.createDataFrame([(doc,)], "value STRING")
    parsed = endpoints.parse_endpoints(docs)
    row = parsed.first()
    assert parsed.count() == 1
    assert (row["Host"], row["Station"], row["SafeName"], row["Address"], row["AuthenticationMode"]) == (
        "Assembly.Munich", "assembly", "assembly-munich", "opc.tcp://Assembly.Munich:4840", "Anonymous")
    names = spark.createDataFrame([("ns=1;i=406", "1:EnergyConsumption")], "NodeId STRING, BrowseName STRING")
    tags = {r["NodeId"]: (r["name"], r["sampling_ms"]) for r in endpoints.name_tags(parsed, names, ["SafeName"]).collect()}
    assert tags == {"nsu=x;i=406": ("EnergyConsumption", 500), "nsu=x;s=odd": ("node-1", 1000)}
