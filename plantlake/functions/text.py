"""Column expressions for names, identifiers, numbers held as text, and messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.schemas import DEFAULT_PORT, RELIEF_TOPIC

# --- fixed patterns ---------------------------------------------------------
WRITER_ID = r"^([^/]+)"
# Workcell.Line.Area.Site.Enterprise;nsu=...
SERVER_NAME = r"([^:.]+)\.([^.]+)\.([^.]+)\.([^.]+)\.([^;]+);nsu="
SERVER_NODE = r";nsu=([^;]+);(.*)$"
# <station>-<location>-...
ASSET_STATION = r"^([^-]+)-"
ASSET_LOCATION = r"^[^-]+-([^-]+)-"
NUMERIC_NODE_ID = r";i=([0-9]+)$"
# host, port and path of a server URL
ENDPOINT = r"^(?:opc\.tcp://)?([^/]*?)(?::([0-9]+))?(/.*)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c) -> Column:
    """Text to double; placeholders and other non-numbers become NULL."""
    return _col(c).try_cast("double")


def whole_number(c) -> Column:
    """Text to int by way of double, so '5.7' gives 5."""
    return number(c).try_cast("int")


def timestamp(c) -> Column:
    """ISO-8601 text to a timestamp, NULL when it is not one."""
    return F.try_to_timestamp(_col(c))


def writer_id(c) -> Column:
    """The writer id without the topic suffix some producers append after a slash."""
    return F.regexp_extract(_col(c), WRITER_ID, 1)


def contains_ci(c, needle) -> Column:
    """Case-insensitive substring test in which no character is special."""
    needle = needle if isinstance(needle, Column) else F.lit(needle)
    return F.contains(F.lower(_col(c)), F.lower(needle))


def contains_like(c, needle, literal: bool = False) -> Column:
    """Case-sensitive LIKE %needle%; `%` and `_` in the needle stay wildcards.

    With `literal=True` they lose that meaning.
    """
    needle = needle if isinstance(needle, Column) else F.lit(needle)
    if literal:
        return F.contains(_col(c), needle)
    return F.like(_col(c), F.concat(F.lit("%"), needle, F.lit("%")))


def matches(c, needle, how: str = "like") -> Column:
    """Name match by `like` (default), `contains_ci` or `literal`."""
    if how == "like":
        return contains_like(c, needle)
    if how == "literal":
        return contains_like(c, needle, literal=True)
    if how == "contains_ci":
        return contains_ci(c, needle)
    raise ValueError(f"unknown match: {how}")


def not_empty(c) -> Column:
    return _col(c).isNotNull() & (_col(c) != "")


def isa95_columns(name, lenient: bool = False) -> dict[str, Column]:
    """The seven hierarchy columns of a data set name; levels it does not carry are ''.

    Server names hold all levels, asset names only station and location. `lenient`
    also takes asset names that end after the location.
    """
    name = _col(name)
    is_server = F.contains(name, F.lit(";nsu="))

    def level(group: int, otherwise: Column) -> Column:
        return F.when(is_server, F.regexp_extract(name, SERVER_NAME, group)).otherwise(otherwise)

    if lenient:
        bare = F.replace(F.replace(name, F.lit("_telemetry"), F.lit("")), F.lit("-asset"), F.lit(""))
        station = F.split_part(bare, F.lit("-"), F.lit(1))
        location = F.split_part(bare, F.lit("-"), F.lit(2))
    else:
        station = F.regexp_extract(name, ASSET_STATION, 1)
        location = F.regexp_extract(name, ASSET_LOCATION, 1)
    none = F.lit("")
    return {
        "Workcell": level(1, station),
        "Line": level(2, none),
        "Area": level(3, none),
        "Site": level(4, location),
        "Enterprise": level(5, none),
        "NamespaceUri": F.when(is_server, F.regexp_extract(name, SERVER_NODE, 1)).otherwise(none),
        "NodeId": F.when(is_server, F.regexp_extract(name, SERVER_NODE, 2)).otherwise(none),
    }


def parse_isa95(df: DataFrame, name_col: str = "DataSetName", lenient: bool = False) -> DataFrame:
    return df.withColumns(isa95_columns(name_col, lenient))


def parse_endpoint(df: DataFrame, url_col: str, default_port: int = DEFAULT_PORT) -> DataFrame:
    """Server URL to Host, Station, SafeName (DNS label) and Address (always with a port)."""
    host, port, path = (F.regexp_extract(url_col, ENDPOINT, k) for k in (1, 2, 3))
    with_port = F.concat(host, F.lit(":"), port, F.rtrim(path, F.lit("/")))
    address = F.when(port != "", with_port).otherwise(F.concat(host, F.lit(f":{default_port}")))
    return df.withColumns(
        {
            "Host": host,
            "Station": F.lower(F.split_part(host, F.lit("."), F.lit(1))),
            "SafeName": F.btrim(F.regexp_replace(F.lower(host), r"[^a-z0-9]+", "-"), F.lit("-")),
            "Address": F.concat(F.lit("opc.tcp://"), address),
        }
    )


def asset_name(c) -> Column:
    """The data set name up to its first semicolon."""
    return F.split_part(_col(c), F.lit(";"), F.lit(1))


def type_id(namespace, type_name) -> Column:
    return F.concat_ws("#", _col(namespace), _col(type_name))


def alert_text(asset, name, value) -> Column:
    return F.format_string("**%s** has a **%s** of **%s**", _col(asset), _col(name), _col(value))


def percent(c) -> Column:
    return F.round(_col(c) * 100, 2)


def relief_topic(asset, root: str = "") -> Column:
    """Command topic of an asset below the root of the plant's broker."""
    return F.format_string(root + RELIEF_TOPIC, _col(asset))


def element_path(*levels) -> Column:
    """Element id of an asset: its hierarchy levels joined by '/', without empty ones."""
    return F.concat_ws("/", *[F.when(_col(c) != "", _col(c)) for c in levels])
