"""Raw JSON documents to narrow telemetry rows and hierarchy-aware metadata rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.nested import unfold
from plantlake.functions.text import isa95_columns, timestamp, writer_id
from plantlake.schemas import (
    METADATA_COLUMNS,
    METADATA_MESSAGE,
    TELEMETRY_MESSAGES,
    TELEMETRY_MESSAGES_AS_TEXT,
)


def _is_object(text: Column) -> Column:
    return F.startswith(text, F.lit("{"))


def _payload_entries(text: Column) -> Column:
    """Payload JSON text to an array of (key, value text), from an object or an array of objects."""
    from_object = F.map_entries(F.from_json(text, "map<string,string>"))
    from_array = F.flatten(
        F.transform(F.from_json(text, "array<map<string,string>>"), lambda m: F.map_entries(m))
    )
    return F.when(_is_object(text), from_object).when(F.startswith(text, F.lit("[")), from_array)


def _tolerant_entries(text: Column) -> Column:
    """Entries of a payload the typed schema rejected, keeping those that are objects or null."""
    kept = F.filter(
        _payload_entries(text), lambda e: e["value"].isNull() | _is_object(e["value"])
    )
    return F.transform(
        kept,
        lambda e: F.struct(
            e["key"].alias("key"),
            F.struct(F.get_json_object(e["value"], "$.Value").alias("Value")).alias("value"),
        ),
    )


def _elements(typed: Column) -> Column:
    """The elements of an array that the typed schema rejected as a whole, each as JSON text."""
    apart = typed.isNull() & F.startswith(F.ltrim("payload"), F.lit("["))
    return F.when(apart, F.from_json("payload", "array<string>"))


def _documents(raw: DataFrame, *carried: str) -> DataFrame:
    """One parse per document: its messages, their payloads as text where needed, its loose elements.

    An array with an element that is no message is taken apart, so its other messages stay.
    """
    typed = F.from_json("payload", TELEMETRY_MESSAGES)
    read = raw.select(*carried, "payload", typed.alias("typed"), _elements(typed).alias("elements"))
    objects = F.filter("elements", _is_object)
    loose = F.transform(objects, lambda e: F.from_json(e, TELEMETRY_MESSAGES)[0])
    texts = F.when(
        F.exists("typed", lambda m: m["Payload"].isNull()),
        F.from_json("payload", TELEMETRY_MESSAGES_AS_TEXT)["Payload"],
    ).when(F.col("typed").isNull(), F.transform(objects, lambda e: F.get_json_object(e, "$.Payload")))
    return read.select(*carried, F.coalesce("typed", loose).alias("messages"), texts.alias("texts"), "elements")


def _unfolded(documents: DataFrame, *carried: str) -> DataFrame:
    return unfold(documents, F.col("messages"), "m", *carried, "texts", pos="pos").select(
        *carried,
        writer_id("m.DataSetWriterId").alias("Subject"),
        timestamp("m.Timestamp").alias("Timestamp"),
        F.col("m.Payload").alias("typed"),
        F.get("texts", F.col("pos")).alias("text"),
    )


def _messages(raw: DataFrame, *carried: str) -> DataFrame:
    """One row per telemetry message; `text` is set only where the typed payload is NULL."""
    return _unfolded(_documents(raw, *carried), *carried)


def expand_telemetry(raw: DataFrame) -> DataFrame:
    """One row per payload field: Subject, Timestamp, Name, Value.

    Each document is parsed once with the typed schema. Only documents holding a message
    whose payload that schema cannot take (a field that is no object, or a payload given
    as an array) are read a second time, and lose no good field.
    """
    entries = F.coalesce(F.map_entries("typed"), _tolerant_entries(F.col("text")))
    return unfold(_messages(raw), entries, "e", "Subject", "Timestamp").select(
        "Subject",
        "Timestamp",
        F.col("e.key").alias("Name"),
        F.col("e.value.Value").alias("Value"),
    )


def telemetry_rejects(raw: DataFrame) -> DataFrame:
    """What `expand_telemetry` leaves out: payload, Subject, Name, reason."""
    none = F.lit(None).cast("string")
    documents = _documents(raw.where(F.col("payload").isNotNull()).withColumn("document", F.col("payload")), "document")
    odd = F.transform(F.filter("elements", lambda e: e.isNull() | ~_is_object(e)), lambda e: F.lit("element is not a message"))
    reasons = F.when(F.col("messages").isNull(), F.array(F.lit("not a message or an array of messages"))).otherwise(odd)
    unread = unfold(documents.withColumn("reasons", reasons), F.col("reasons"), "reason", "document").select(
        F.col("document").alias("payload"), none.alias("Subject"), none.alias("Name"), "reason"
    )

    def reject(name: Column, reason: str) -> Column:
        return F.struct(name.alias("Name"), F.lit(reason).alias("reason"))

    entries = _payload_entries(F.col("text"))
    fields = F.transform(
        F.filter(entries, lambda e: e["value"].isNotNull() & ~_is_object(e["value"])),
        lambda e: reject(e["key"], "payload field is not an object"),
    )
    found = (
        F.when(F.col("text").isNull() | (F.col("text") == "null"), F.array(reject(none, "message has no payload")))
        .when(entries.isNull(), F.array(reject(none, "payload is neither an object nor an array of objects")))
        .otherwise(fields)
    )
    lost = unfold(_unfolded(documents, "document").where("typed IS NULL"), found, "r", "document", "Subject").select(
        F.col("document").alias("payload"), "Subject", "r.Name", "r.reason"
    )
    return unread.unionByName(lost)


def expand_metadata(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per described field, with the hierarchy read from the data set name.

    The name is parsed once per message, before the fields are expanded.
    """
    message = raw.select(F.from_json("payload", METADATA_MESSAGE).alias("p")).select(
        writer_id("p.DataSetWriterId").alias("Subject"),
        timestamp("p.Timestamp").alias("Timestamp"),
        F.col("p.MetaData.Name").alias("DataSetName"),
        F.col("p.MetaData.ConfigurationVersion.MajorVersion").alias("MajorVersion"),
        F.col("p.MetaData.ConfigurationVersion.MinorVersion").alias("MinorVersion"),
        F.col("p.MetaData.Fields").alias("Fields"),
    )
    named = message.withColumns(isa95_columns("DataSetName", lenient))
    fields = unfold(named, F.col("Fields"), "Field", *[c for c in named.columns if c != "Fields"])
    return fields.withColumns(
        {
            "Name": F.col("Field.Name"),
            "BuiltInType": F.col("Field.BuiltInType"),
            "DataType": F.col("Field.DataType"),
            "ValueRank": F.col("Field.ValueRank"),
            "Type": F.col("Field.Description"),
            "DisplayName": F.col("Field.Name"),
        }
    ).select(*METADATA_COLUMNS)


def metadata_rejects(raw: DataFrame) -> DataFrame:
    """Documents that carry no field description: payload, reason."""
    fields = F.from_json("payload", METADATA_MESSAGE)["MetaData"]["Fields"]
    return raw.where(F.col("payload").isNotNull() & fields.isNull()).select(
        "payload", F.lit("no field descriptions").alias("reason")
    )


def envelope_wrap(
    events: DataFrame,
    body_key: str,
    body_cols: list[str],
    subject_col: str = "subject",
    time_col: str = "time",
) -> DataFrame:
    """Edge events (flat body plus subject and time attributes) to message documents.

    `body_key` is 'Payload' for telemetry and 'MetaData' for metadata.
    """
    return events.select(
        F.to_json(
            F.struct(
                F.col(subject_col).alias("DataSetWriterId"),
                F.col(time_col).alias("Timestamp"),
                F.struct(*body_cols).alias(body_key),
            )
        ).alias("payload")
    )


def as_variant(raw: DataFrame) -> DataFrame:
    """Add the document as a VARIANT and the kind of its root: array, object, other or NULL."""
    schema = F.schema_of_variant("document")
    return raw.withColumn("document", F.try_parse_json("payload")).withColumn(
        "kind",
        F.when(F.startswith(schema, F.lit("ARRAY")), "array")
        .when(F.startswith(schema, F.lit("OBJECT")), "object")
        .when(F.col("document").isNotNull(), "other"),
    )
