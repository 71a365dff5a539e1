"""Streaming jobs: topic to raw table, raw to expanded tables, mirrors, last values, alerts.

Every job has its own checkpoint and can be restarted on its own. `once=True` processes what
is there and stops, for tests and backfills.
"""

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable
from datetime import datetime, timezone

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plantlake.operators.analytics import throughput
from plantlake.operators.expand import expand_metadata, expand_telemetry
from plantlake.operators.lkv import newest, newest_values
from plantlake.operators.monitor import pressure_trigger
from plantlake.operators.oee import (
    SHIFT_KEYS,
    counters,
    low_oee_alerts,
    oee_of_shifts,
    production_writers,
    readings_in_shifts,
)
from plantlake.operators.shifts import longest_shift
from plantlake.operators.zones import zone_index
from plantlake.schemas import DEFAULT_SHIFTS, METADATA_SCHEMA, RAW_SCHEMA, TELEMETRY_SCHEMA
from plantlake.session import path_exists, remove_folder, require_utc, subfolders

# Start at the beginning of a topic and go on if the broker dropped old messages.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}

# How raw documents are stored: each repeats the names of its fields, which the default codec packs badly.
RAW_FILES = {"compression": "zstd"}


def read_topic(
    spark: SparkSession, fmt: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """A stream of raw documents, column `payload`.

    For `kafka` the topic is subscribed to; for `text` it is a folder of files with one document
    per line; any other format is loaded from the path `topic` and must have a column `value`.
    """
    options = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        stream = reader.options(**{**KAFKA_DEFAULTS, "subscribe": topic, **options}).load()
    else:
        stream = reader.options(**options).load(topic)
    return stream.selectExpr("CAST(value AS STRING) AS payload")


def read_table_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> DataFrame:
    """A landed table as a stream."""
    return spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(path)


def _timed(writer, interval: str | None, once: bool):
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def write_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str | None = None,
    once: bool = False,
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append a stream to a table folder, exactly once."""
    writer = df.writeStream.format(fmt).outputMode("append").options(**(options or {}))
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _timed(writer, interval, once).start(path)


def by_date(telemetry: DataFrame, files: int = 8) -> DataFrame:
    """Telemetry with its UTC date, each batch in at most `files` files per date.

    Readings are dealt to the files by their hash, so a date or a writer that holds most of a batch
    is still written by several tasks.
    """
    require_utc(telemetry.sparkSession)
    part = F.pmod(F.xxhash64("Subject", "Name", "Timestamp"), F.lit(files))
    return telemetry.withColumn("date", F.to_date("Timestamp")).repartition("date", part)


def land(spark, fmt, topic, root, table, options=None, interval=None, once=False) -> StreamingQuery:
    """Topic to raw table, unparsed."""
    raw = read_topic(spark, fmt, topic, options)
    return write_append(
        raw, f"{root}/{table}", f"{root}/_checkpoints/{table}", interval=interval, once=once, options=RAW_FILES
    )


def expand(spark, root, kind, interval=None, once=False, options=None) -> StreamingQuery:
    """Raw table to expanded table; `kind` is 'telemetry' or 'metadata'.

    Telemetry is partitioned by UTC date, metadata is not.
    """
    raw = read_table_stream(spark, f"{root}/{kind}_raw", RAW_SCHEMA, options=options)
    if kind == "telemetry":
        rows, parts = by_date(expand_telemetry(raw)), ["date"]
    else:
        rows, parts = expand_metadata(raw), None
    return write_append(
        rows, f"{root}/{kind}", f"{root}/_checkpoints/{kind}", interval=interval, once=once, partition_by=parts
    )


def start_all(spark, fmt, topics: dict[str, str], root, options=None, interval=None, once=False):
    """The four continuous jobs: land and expand telemetry and metadata."""
    jobs = []
    for kind in ("telemetry", "metadata"):
        job = land(spark, fmt, topics[kind], root, f"{kind}_raw", options, interval, once)
        if once:
            job.awaitTermination()
        jobs.append(job)
    for kind in ("telemetry", "metadata"):
        job = expand(spark, root, kind, interval, once)
        if once:
            job.awaitTermination()
        jobs.append(job)
    return jobs


def block_until_any_stops(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()


FAILURES_SCHEMA = "job STRING, failed_at TIMESTAMP, message STRING, restarted BOOLEAN"


def keep_running(
    spark: SparkSession, starts: dict[str, Callable[[], StreamingQuery]], failures: str | None = None, restarts: int = 3
) -> None:
    """Run jobs until all have ended; one that fails is started again and goes on from its checkpoint.

    `starts` has a function for each job that starts it. Each failure adds a row to the table `failures`. A job that fails
    more than `restarts` times stops the others and raises its error.
    """
    running = {name: start() for name, start in starts.items()}
    left = dict.fromkeys(starts, restarts)
    while running:
        try:
            spark.streams.awaitAnyTermination()
        except StreamingQueryException:
            # Which job it was is asked below, as several may have ended by now.
            pass
        spark.streams.resetTerminated()
        for name, query in list(running.items()):
            if query.isActive:
                continue
            error = running.pop(name).exception()
            if error is None:
                continue
            again = left[name] > 0
            if failures:
                row = [(name, datetime.now(timezone.utc), str(error), again)]
                spark.createDataFrame(row, FAILURES_SCHEMA).coalesce(1).write.mode("append").parquet(failures)
            if not again:
                for other in running.values():
                    other.stop()
                raise error
            left[name] -= 1
            running[name] = starts[name]()


def land_and_expand(
    spark, raw: DataFrame, root: str, interval: str | None = None, once: bool = False
) -> StreamingQuery:
    """Raw and expanded telemetry from one batch, as an update policy does it.

    The raw table is partitioned by batch, telemetry by date and batch. A batch that is repeated
    after a failure replaces its own partitions, so neither table ever holds a batch twice. Batch numbers
    belong to the checkpoint: tables that outlived theirs are refused, as a new one would overwrite them.
    """
    checkpoint = f"{root}/_checkpoints/both"
    if path_exists(spark, f"{root}/telemetry_raw") and not path_exists(spark, checkpoint):
        raise ValueError(f"{root} holds batches of a checkpoint that is gone; start below another folder")

    def both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _replace_batch(batch, batch_id, f"{root}/telemetry_raw", options=RAW_FILES)
            _replace_batch(by_date(expand_telemetry(batch)), batch_id, f"{root}/telemetry", ["date"])
        finally:
            batch.unpersist()

    writer = raw.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    return _timed(writer, interval, once).start()


def _replace_batch(
    df: DataFrame, batch_id: int, path: str, by: list[str] | None = None, options: dict[str, str] | None = None
) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .options(**(options or {}))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(by or []), "batch_id")
        .parquet(path)
    )


def mirror(
    spark, source: str, schema: str, root: str, name: str, interval: str = "5 minutes", once: bool = False
) -> StreamingQuery:
    """A parquet copy of a table for other readers, by UTC date, at most `interval` behind."""
    rows = by_date(read_table_stream(spark, source, schema))
    return write_append(
        rows, f"{root}/{name}", f"{root}/_checkpoints/{name}", interval=interval, once=once, partition_by=["date"]
    )


# --- last known values --------------------------------------------------------
# Each batch adds its own last values as one small partition. Taking a maximum is
# idempotent and does not depend on order, so late data and repeated batches are harmless.
# Every so often the partitions are merged into a new base. What a base replaces goes when the next
# base is complete, so a reader that has just chosen the old one can finish.

METADATA_KEPT = (METADATA_SCHEMA, newest)
VALUES_KEPT = (TELEMETRY_SCHEMA, newest_values)


def _maintain(stream: DataFrame, root: str, kept, compact_every: int, interval: str | None, once: bool) -> StreamingQuery:
    spark, (_, reduce) = stream.sparkSession, kept

    def merge(batch: DataFrame, batch_id: int) -> None:
        _keep_batch(spark, reduce(batch), batch_id, root, kept, compact_every)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/_checkpoint")
    return _timed(writer, interval, once).start()


def _keep_batch(spark: SparkSession, rows: DataFrame, batch_id: int, root: str, kept, compact_every: int) -> None:
    """Adds the reduced rows of a batch to what is kept below `root`, and merges now and then."""
    _replace_batch(rows, batch_id, f"{root}/deltas")
    if batch_id % compact_every == compact_every - 1:
        replaced = [number for number in _batches(spark, f"{root}/base") if number < batch_id]
        _replace_batch(_read_kept(spark, root, kept, batch_id), batch_id, f"{root}/base")
        if replaced:
            _drop_batches(spark, f"{root}/deltas", max(replaced))
            _drop_batches(spark, f"{root}/base", max(replaced) - 1)


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """The batch numbers of a folder, from the names of its partitions."""
    names = subfolders(spark, folder)
    return [int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id=")]


def _drop_batches(spark: SparkSession, folder: str, upto: int) -> None:
    for number in _batches(spark, folder):
        if number <= upto:
            remove_folder(spark, f"{folder}/batch_id={number}")


def _read_kept(spark: SparkSession, root: str, kept, upto: int | None = None) -> DataFrame:
    """The newest base merged with the batches after it."""
    schema, reduce = kept
    # A batch that is repeated after a failure must not count its own base.
    bases = [number for number in _batches(spark, f"{root}/base") if upto is None or number < upto]
    folders = [f"base/batch_id={max(bases)}"] if bases else []
    wanted = [n for n in _batches(spark, f"{root}/deltas") if n > max(bases, default=-1) and (upto is None or n <= upto)]
    folders += [f"deltas/batch_id={number}" for number in sorted(wanted)]
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).parquet(*[f"{root}/{folder}" for folder in folders])
    return reduce(found)


def maintain_lkv(
    metadata: DataFrame, root: str, compact_every: int = 100, interval: str | None = None, once: bool = False
) -> StreamingQuery:
    """Keep the last known metadata of a stream below `root`."""
    return _maintain(metadata, root, METADATA_KEPT, compact_every, interval, once)


def read_lkv(spark: SparkSession, root: str) -> DataFrame:
    """The last known metadata that `maintain_lkv` keeps below `root`."""
    return _read_kept(spark, root, METADATA_KEPT)


def maintain_values(
    telemetry: DataFrame, root: str, compact_every: int = 100, interval: str | None = None, once: bool = False
) -> StreamingQuery:
    """Keep the last reading of every series of a stream below `root`; the history is never scanned for it."""
    return _maintain(telemetry, root, VALUES_KEPT, compact_every, interval, once)


def read_values(spark: SparkSession, root: str) -> DataFrame:
    """The last readings that `maintain_values` keeps below `root`, one per series.

    They stand for the history wherever only the latest values are asked for, as in `current_values`
    and `high_now`.
    """
    return _read_kept(spark, root, VALUES_KEPT)


#: What the state of some fields holds: for each change of a description its field, when it was first and last sent, and the
#: description.
CHANGES = "names array<string>, since array<bigint>, until array<bigint>, documents array<string>"
#: A writer's fields are dealt to so many states: a state costs as much as some hundred rows.
FIELD_GROUPS = 4
#: Between the values of a description; the escape by itself is NULL.
SEPARATOR, ESCAPE = "\x1f", "\x1e"
ESCAPED = {ESCAPE: ESCAPE + "0", SEPARATOR: ESCAPE + "1"}
UNTIMED = -(1 << 62)
MICROS_OF_DAY = 86_400_000_000


class Descriptions:
    """The changes of one field's description in the order of their times."""

    def __init__(self, since=(), until=(), documents=()):
        self.since, self.until, self.documents = list(since), list(until), list(documents)
        self.sent = set(zip(self.since, self.documents, strict=True))

    def _insert(self, at: int, document: str) -> tuple[int, str]:
        k = bisect_right(self.since, at)
        self.since.insert(k, at)
        self.until.insert(k, at)
        self.documents.insert(k, document)
        self.sent.add((at, document))
        return at, document

    def add(self, at: int, document: str) -> list[tuple[int, str]]:
        """The changes that a row makes: none for a repeat, itself, and what it cuts in two is sent again at its end."""
        if (at, document) in self.sent:
            return []
        first, last = bisect_left(self.since, at), bisect_right(self.since, at)
        before = bisect_left(self.since, self.since[first - 1]) if first else 0
        if first == last and first - before == 1 and self.documents[before] == document:
            self.until[before] = max(self.until[before], at)
            return []
        cut = [k for k in range(before, last) if self.until[k] >= at and self.since[k] < self.until[k]]
        again = [(self.until[k], self.documents[k]) for k in cut]
        for k in cut:
            self.until[k] = self.since[k]
        return [self._insert(at, document), *(self._insert(*change) for change in again)]

    def recent(self, days: int) -> tuple[list[int], list[int], list[str]]:
        """What the state keeps: of changes that are long over only those of the last instant."""
        old = bisect_right(self.since, self.since[-1] - days * MICROS_OF_DAY) if self.since else 0
        first = bisect_left(self.since, self.since[old - 1]) if old else 0
        return self.since[first:], self.until[first:], self.documents[first:]


def _new_descriptions(keep_days: int):
    """Rows of some fields that change their descriptions, from their rows of a batch and the changes seen before."""

    def run(key, frames, state):
        kept = defaultdict(lambda: ([], [], []))
        for name, *change in zip(*state.get, strict=True) if state.exists else ():
            for values, value in zip(kept[name], change, strict=True):
                values.append(value)
        known = defaultdict(Descriptions, {name: Descriptions(*changes) for name, changes in kept.items()})
        for frame in frames:
            rows = zip(frame["Name"].tolist(), frame["at"].tolist(), frame["document"].tolist(), strict=True)
            changes = [change for name, at, document in rows for change in known[name].add(at, document)]
            yield pd.DataFrame(changes, columns=["at", "document"])
        held = [(name, *change) for name, field in known.items() for change in zip(*field.recent(keep_days), strict=True)]
        state.update(tuple(map(list, zip(*held, strict=True))))

    return run


def _is_plain(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType))


def _packed(fields: list[T.StructField]) -> Column:
    """Values as one text that is cheaper to read than JSON; what is no text or whole number is JSON in it."""

    def text(field: T.StructField) -> Column:
        value = F.col(field.name)
        return value.cast("string") if _is_plain(field.dataType) else F.when(value.isNotNull(), F.to_json(F.array(value)))

    def safe(value: Column) -> Column:
        for plain, escaped in ESCAPED.items():
            value = F.replace(value, F.lit(plain), F.lit(escaped))
        return value

    def joined(values: list[Column]) -> Column:
        return F.concat_ws(SEPARATOR, *[F.coalesce(value, F.lit(ESCAPE)) for value in values])

    texts = [text(field) for field in fields]
    # Hardly a name holds what must be escaped: one look at all of them is cheaper than replacing in each.
    whole = F.concat_ws("", *texts)
    odd = F.contains(whole, F.lit(SEPARATOR)) | F.contains(whole, F.lit(ESCAPE))
    return F.when(odd, joined([safe(value) for value in texts])).otherwise(joined(texts))


def _unpacked(values: Column, fields: list[T.StructField]) -> dict[str, Column]:
    """The values of a text of `_packed` that was split, by their names."""

    def value(k: int, field: T.StructField) -> Column:
        text = F.get(values, F.lit(k))
        found = F.when(text != ESCAPE, text)
        if isinstance(field.dataType, T.StringType) or not _is_plain(field.dataType):
            for plain, escaped in reversed(ESCAPED.items()):
                found = F.replace(found, F.lit(escaped), F.lit(plain))
        if _is_plain(field.dataType):
            return found.cast(field.dataType)
        return F.from_json(found, T.ArrayType(field.dataType))[0]

    return {field.name: value(k, field) for k, field in enumerate(fields)}


def without_repeats(metadata: DataFrame, keep_days: int = 30) -> DataFrame:
    """A metadata stream without true repeats: a field's row that says what held of it at that time already.

    The state of a writer's field keeps when its description changed. Every change passes, however late it comes and
    also within one version, so the last known metadata of what passes says what those of the stream say. A field
    that sends nothing for `keep_days`, or a row that much older than the newest, may pass once more; none is lost.
    """
    described = [field for field in metadata.schema.fields if field.name != "Timestamp"]
    rows = metadata.select(
        "Subject",
        F.pmod(F.xxhash64("Name"), F.lit(FIELD_GROUPS)).alias("part"),
        "Name",
        F.coalesce(F.unix_micros("Timestamp"), F.lit(UNTIMED)).alias("at"),
        _packed(described).alias("document"),
    )
    changed = rows.groupBy("Subject", "part").applyInPandasWithState(
        _new_descriptions(keep_days), "at bigint, document string", CHANGES, "append", "NoTimeout"
    )
    values = changed.select("at", F.split("document", SEPARATOR, -1).alias("values"))
    time = F.when(F.col("at") != UNTIMED, F.timestamp_micros("at"))
    columns = _unpacked(F.col("values"), described) | {"Timestamp": time}
    return values.select(*[columns[name].alias(name) for name in metadata.columns])


# --- windows and alerts -------------------------------------------------------


def stream_throughput(
    telemetry: DataFrame, keys: list[str], width: str = "1 hour", late: str = "10 minutes"
) -> DataFrame:
    """Finished production windows; readings later than `late` are dropped by the watermark."""
    return throughput(telemetry.withWatermark("Timestamp", late), keys, width)


def run_alerts(
    telemetry: DataFrame,
    alerts_of: Callable[[DataFrame], DataFrame],
    root: str,
    interval: str = "3 minutes",
    once: bool = False,
    table: str = "alerts",
) -> StreamingQuery:
    """Apply a batch alert function to every batch and keep its rows, one partition per batch."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        _replace_batch(alerts_of(batch), batch_id, f"{root}/{table}")

    writer = telemetry.writeStream.foreachBatch(emit).option("checkpointLocation", f"{root}/_checkpoint")
    return _timed(writer, interval, once).start()


def run_pressure_commands(
    telemetry: DataFrame,
    lkv: DataFrame | Callable[[], DataFrame],
    station: str,
    location: str,
    threshold: float,
    root: str,
    interval: str = "10 seconds",
    once: bool = False,
    topic_root: str = "",
) -> StreamingQuery:
    """A table `commands` below `root`: one relief command per reading above the threshold.

    `lkv` is the last known metadata, or a function that reads them, such as one of `read_lkv`: it is called for every
    batch, so new and renamed writers count at once.
    """

    def commands(batch: DataFrame) -> DataFrame:
        known = lkv if isinstance(lkv, DataFrame) else lkv()
        return pressure_trigger(batch, known, station, location, threshold, topic_root=topic_root)

    return run_alerts(telemetry, commands, root, interval, once, table="commands")


FIGURES_SCHEMA = (
    "Site STRING, Workcell STRING, shift_day DATE, shift STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, "
    "ideal_cycle_ms BIGINT, good DOUBLE, scrap DOUBLE, faulty DOUBLE, availability DOUBLE, performance DOUBLE, "
    "quality DOUBLE, oee DOUBLE, seen BIGINT"
)


def _last_figures(figures: DataFrame) -> DataFrame:
    """The figure of the last batch of each shift."""
    rest = [f.split()[0] for f in FIGURES_SCHEMA.split(", ") if f.split()[0] not in SHIFT_KEYS]
    last = F.max_by(F.struct(*rest), "seen").alias("last")
    return figures.groupBy(*SHIFT_KEYS).agg(last).select(*SHIFT_KEYS, "last.*")


FIGURES_KEPT = (FIGURES_SCHEMA, _last_figures)


def shift_states(
    telemetry: DataFrame, writers: DataFrame, zones: DataFrame, shifts=DEFAULT_SHIFTS, late: str = "1 day"
) -> DataFrame:
    """Counters of every station and shift, kept in the state store of a stream and given again when a batch changes them.

    The watermark runs on the ends of shifts: a shift's state goes when one that ends later by the longest shift and
    `late` has readings, so the state holds the open shifts of the stations whatever the stream has been running for.
    """
    longest = longest_shift(telemetry.sparkSession, shifts)
    delay = telemetry.sparkSession.range(1).select(F.expr(f"CAST(INTERVAL '{late}' AS INTERVAL DAY TO SECOND)").alias("i")).first()["i"]
    wait = f"{longest * 60 + int(delay.total_seconds())} seconds"
    within = readings_in_shifts(telemetry, writers, zones, shifts)
    return counters(within.withWatermark("end_ts", wait), *SHIFT_KEYS)


def run_oee_alerts(
    telemetry: DataFrame,
    lkv: DataFrame,
    sites: DataFrame,
    root: str,
    threshold_pct: float = 10,
    shifts=DEFAULT_SHIFTS,
    interval: str = "2 minutes",
    once: bool = False,
    late: str = "1 day",
    compact_every: int = 100,
) -> StreamingQuery:
    """Stations whose OEE in a shift is low so far, for the shifts that a batch has readings of.

    The counters of a shift live in the job's state (`shift_states`) until readings can no longer be late for it; readings
    later than `late` are not counted. Each batch adds its alerts to the table `alerts` and its figures to the last ones
    below `figures` (`read_figures`), which are merged now and then. Writers belong to the stations of `lkv` as it is
    when the job starts; a restarted job goes on with its state and the metadata of then.
    """
    spark = telemetry.sparkSession
    production_writers(lkv, sites).write.mode("overwrite").parquet(f"{root}/writers")
    zone_index(sites).write.mode("overwrite").parquet(f"{root}/zones")
    writers, zones = (spark.read.parquet(f"{root}/{name}") for name in ("writers", "zones"))

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            figures = oee_of_shifts(batch)
            _replace_batch(low_oee_alerts(figures, threshold_pct), batch_id, f"{root}/alerts")
            columns = [f.split()[0] for f in FIGURES_SCHEMA.split(", ")]
            figures = figures.withColumn("seen", F.lit(batch_id).cast("bigint")).select(*columns)
            _keep_batch(spark, figures, batch_id, f"{root}/figures", FIGURES_KEPT, compact_every)
        finally:
            batch.unpersist()

    states = shift_states(telemetry, writers, zones, shifts, late)
    writer = states.writeStream.outputMode("update").foreachBatch(emit).option("checkpointLocation", f"{root}/_checkpoint")
    return _timed(writer, interval, once).start()


def read_figures(spark: SparkSession, root: str) -> DataFrame:
    """The last OEE figure of each station and shift that `run_oee_alerts` has seen below `root`."""
    return _read_kept(spark, f"{root}/figures", FIGURES_KEPT)


def telemetry_stream(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> DataFrame:
    return read_table_stream(spark, path, TELEMETRY_SCHEMA, options=options)
