import datetime as dt

from pyspark.sql import functions as F

from plantlake.functions import text
from plantlake.operators import expand

MESSAGES = [
    '{"DataSetWriterId":"3/telemetry","Timestamp":"2024-01-05T08:00:00.123Z","Payload":{"Status":{"Value":2},"Pressure":{"Value":2511.5}}}',
    '[{"DataSetWriterId":4,"Timestamp":"2024-01-05T08:00:01Z","Payload":{"FaultyTime":{"Value":61000}}},'
    '{"DataSetWriterId":"5","Timestamp":"2024-01-05T08:00:02Z","Payload":{}}]',
    '{"DataSetWriterId":"6","Timestamp":"2024-01-05T08:00:03Z","Payload":{"Bad":7,"Good":{"Value":1}}}',
    '{"DataSetWriterId":"7","Timestamp":"2024-01-05T08:00:04Z","Payload":[{"A":{"Value":1}},{"B":{"Value":null}}]}',
    '{"DataSetWriterId":"/x","Timestamp":"not a time","Payload":{"A":{"Value":"[Future]"}}}',
    "not json{",
    "",
    None,
]


def raw(spark, messages):
    return spark.createDataFrame([(m,) for m in messages], "payload STRING")


def test_edge_messages(spark, rows_of):
    rows = expand.expand_telemetry(raw(spark, MESSAGES)).drop("Timestamp")
    assert rows_of(rows) == [
        ("", "A", "[Future]"),
        ("3", "Pressure", "2511.5"),
        ("3", "Status", "2"),
        ("4", "FaultyTime", "61000"),
        ("6", "Good", "1"),
        ("7", "A", "1"),
        ("7", "B", None),
    ]


def test_timestamps(spark):
    rows = expand.expand_telemetry(raw(spark, MESSAGES)).collect()
    by_name = {(r["Subject"], r["Name"]): r["Timestamp"] for r in rows}
    assert by_name[("3", "Status")] == dt.datetime(2024, 1, 5, 8, 0, 0, 123000)
    assert by_name[("", "A")] is None


def test_rejects(spark, rows_of):
    rejects = expand.telemetry_rejects(raw(spark, MESSAGES)).select("Subject", "Name", "reason")
    assert rows_of(rejects) == [
        (None, None, "not a message or an array of messages"),
        (None, None, "not a message or an array of messages"),
        ("6", "Bad", "payload field is not an object"),
    ]


def test_array_equals_its_elements(spark, rows_of):
    singles = [m for m in MESSAGES[:1] + MESSAGES[2:5]]
    together = "[" + ",".join(singles) + "]"
    assert rows_of(expand.expand_telemetry(raw(spark, [together]))) == rows_of(
        expand.expand_telemetry(raw(spark, singles))
    )


def test_hierarchy_forms(spark, rows_of):
    names = [
        "assembly.line1.building1.munich.contoso;nsu=http://example.org/UA/S/;i=385",
        "test-seattle-asset_telemetry",
        "test-seattle",
        "plain",
    ]
    df = spark.createDataFrame([(n,) for n in names], "DataSetName STRING")
    strict = {r["DataSetName"]: tuple(r)[1:] for r in text.parse_isa95(df).collect()}
    assert strict[names[0]] == ("assembly", "line1", "building1", "munich", "contoso", "http://example.org/UA/S/", "i=385")
    assert strict[names[1]] == ("test", "", "", "seattle", "", "", "")
    assert strict[names[2]] == ("test", "", "", "", "", "", "")
    assert strict[names[3]] == ("",) * 7
    lenient = {r["DataSetName"]: tuple(r)[1:] for r in text.parse_isa95(df, lenient=True).collect()}
    assert lenient[names[1]][:4] == ("test", "", "", "seattle")
    assert lenient[names[2]][:4] == ("test", "", "", "seattle")
    assert lenient[names[3]][:4] == ("plain", "", "", "")


def test_metadata_message(spark):
    doc = (
        '{"DataSetWriterId":"3/m","Timestamp":"2024-01-05T08:00:00Z","MetaData":{"Name":"assembly-munich-asset",'
        '"ConfigurationVersion":{"MajorVersion":1,"MinorVersion":2},"Fields":[{"Name":"Status","Description":"d",'
        '"BuiltInType":6,"DataType":"i=6","ValueRank":-1},{"Name":"Pressure"}]}}'
    )
    rows = {r["Name"]: r.asDict() for r in expand.expand_metadata(raw(spark, [doc, "x"])).collect()}
    assert rows["Status"]["Type"] == "d" and rows["Status"]["DisplayName"] == "Status"
    assert rows["Pressure"]["MinorVersion"] == 2 and rows["Pressure"]["BuiltInType"] is None
    assert rows["Status"]["Workcell"] == "assembly" and rows["Status"]["Site"] == "munich"
    assert expand.metadata_rejects(raw(spark, [doc, "x"])).count() == 1


def test_each_document_is_parsed_once(spark):
    plan = expand.expand_telemetry(raw(spark, MESSAGES))._jdf.queryExecution().optimizedPlan().toString()
    # Once with the typed schema; the two other parses are for the text form and run on demand.
    assert plan.count("AS messages") == 1
    assert "Filter" not in plan.split("AS messages")[1]


def test_numbers_and_names(spark):
    row = spark.range(1).select(
        text.whole_number(F.lit("5.7")).alias("i"),
        text.number(F.lit("[Future]")).alias("n"),
        text.contains_like(F.lit("a_b"), "_").alias("wild"),
        text.contains_like(F.lit("ab"), "_b", literal=True).alias("literal"),
        text.contains_ci(F.lit("Assembly"), "SEMB").alias("ci"),
        text.element_path(F.lit("x"), F.lit(""), F.lit("y")).alias("path"),
    ).first()
    assert tuple(row) == (5, None, True, False, True, "x/y")
