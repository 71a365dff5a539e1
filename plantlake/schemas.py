"""Table and message schemas, and the fixed values of the plant data model."""

# --- tables -----------------------------------------------------------------
RAW_SCHEMA = "payload STRING"

TELEMETRY_SCHEMA = "Subject STRING, Timestamp TIMESTAMP, Name STRING, Value STRING"

METADATA_SCHEMA = (
    "Subject STRING, Timestamp TIMESTAMP, DataSetName STRING, MajorVersion BIGINT, "
    "MinorVersion BIGINT, Name STRING, BuiltInType INT, DataType STRING, ValueRank INT, "
    "Type STRING, DisplayName STRING, Workcell STRING, Line STRING, Area STRING, "
    "Site STRING, Enterprise STRING, NamespaceUri STRING, NodeId STRING"
)

INFORMATION_MODEL_SCHEMA = (
    "Title STRING, Contributor STRING, NodeId STRING, DisplayName STRING, "
    "BrowseName STRING, DataType STRING"
)

TABLES = {
    "telemetry_raw": RAW_SCHEMA,
    "telemetry": TELEMETRY_SCHEMA,
    "metadata_raw": RAW_SCHEMA,
    "metadata": METADATA_SCHEMA,
    "information_model": INFORMATION_MODEL_SCHEMA,
}

METADATA_COLUMNS = [part.split()[0] for part in METADATA_SCHEMA.split(", ")]

# --- messages ---------------------------------------------------------------
# A telemetry document is one message or an array of messages; reading with an
# array schema turns a single message into a one-element array.
TELEMETRY_MESSAGES = (
    "array<struct<DataSetWriterId:string,Timestamp:string,"
    "Payload:map<string,struct<Value:string>>>>"
)
# The same document with the payload kept as JSON text, for messages the typed
# schema cannot hold.
TELEMETRY_MESSAGES_AS_TEXT = (
    "array<struct<DataSetWriterId:string,Timestamp:string,Payload:string>>"
)
METADATA_MESSAGE = (
    "struct<DataSetWriterId:string,Timestamp:string,MetaData:struct<Name:string,"
    "ConfigurationVersion:struct<MajorVersion:bigint,MinorVersion:bigint>,"
    "Fields:array<struct<Name:string,Description:string,BuiltInType:int,"
    "DataType:string,ValueRank:int>>>>"
)

# --- fixed values -----------------------------------------------------------
# Telemetry field names.
SERIAL_NUMBER = "ProductSerialNumber"
MANUFACTURED = "NumberOfManufacturedProducts"
DISCARDED = "NumberOfDiscardedProducts"
RUNNING_TIME = "OverallRunningTime"
FAULTY_TIME = "FaultyTime"
STATUS = "Status"
ENERGY = "EnergyConsumption"
IDEAL_CYCLE = "IdealCycleTime"
ACTUAL_CYCLE = "ActualCycleTime"
PRESSURE = "Pressure"

# Workcells that publish data but produce nothing.
NON_PRODUCTION_WORKCELLS = ("publisher", "mes", "commander")

# Shift calendar in minutes of the local day; an end before its start wraps past midnight.
DEFAULT_SHIFTS = (("Morning", 420, 840), ("Afternoon", 900, 1320), ("Night", 1380, 360))

# Local hours drawn as breaks.
BREAK_HOURS = (14, 6)

# Marker for values a model announces but no station publishes yet.
PLACEHOLDER = "[Future]"
MODEL_ENTERPRISE = "UA Cloud Library"

# Default port of a plant server address.
DEFAULT_PORT = 4840

# Pressure relief command: object, method and topic pattern (below a broker's own root).
RELIEF_OBJECT = "ns=2;i=424"
RELIEF_METHOD = "ns=2;i=435"
RELIEF_TOPIC = "asset-operations/%s/managementGroup/OpenPressureReliefValve"
