"""Conversation structure repair by lightest derivations, after Knuth's generalisation of shortest paths.

An item says that a span of rows, entered in one state of the grammar `(s?(ua)+)?`, leaves it in another. Its weight is
(cost, audit): what the edits cost and their initials. Deductions extend an item by one edit or join the items of two
neighbouring spans. Both are superior functions: a conclusion never weighs less than a premise, and a lighter premise never
makes a heavier conclusion (audits of one span and one cost are never the beginning of one another, as only an insertion
adds a letter without a row, and that costs). So an agenda that pops the lightest item first finalises each item once.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length is cut at the bounds of tasks. Each task
derives the items of its spans without their texts; the spans of a conversation are joined in order, and one pass over the
texts in order applies the edits. That last pass reads a conversation in one task, row by row, as a SHA-256 of it demands.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

#: States of the grammar: nothing yet, a system row, a user row, an assistant row.
STATES = "0sua"
GOALS = "0a"
ORDERED = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of a span that is derived row by row; longer ones are joined from halves.
SPAN = 64
#: Spans whose items a worker remembers. The memory never changes a result.
KNOWN_SPANS = 50_000

#: A row that must go, and rows of roles s, u, a and others; capital if truncated.
GONE = "-"

Item = tuple[int, str]
Items = dict[tuple[str, str], Item]


def turn(state: str) -> str:
    """The role, user or assistant, that may follow a state."""
    return "a" if state == "u" else "u"


def edits(label: str, state: str) -> Iterator[tuple[int, str, str]]:
    """Cost, initial and next state of each edit of a row."""
    yield DELETE, "D", state
    if label != GONE:
        extra = TRUNCATED if label.isupper() else 0
        yield REROLE + extra, "R", turn(state)
        role = label.lower()
        if role == turn(state) or (role == "s" and state == "0"):
            yield KEEP + extra, "K", role


@lru_cache(KNOWN_SPANS)
def derived(labels: str, start: str) -> dict[str, Item]:
    """The lightest item of a short span for each state that it can be left in."""
    agenda: list[tuple[int, str, int, str]] = [(0, "", 0, start)]
    final: set[tuple[int, str]] = set()
    out: dict[str, Item] = {}
    while agenda:
        cost, audit, at, state = heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(labels):
            out[state] = (cost, audit)
        else:
            for more, letter, after in edits(labels[at], state):
                if (at + 1, after) not in final:
                    heappush(agenda, (cost + more, audit + letter, at + 1, after))
        if (at, turn(state)) not in final:
            heappush(agenda, (cost + INSERT, audit + "I", at, turn(state)))
    return out


def joined(left: Items, right: Items) -> Items:
    """The lightest items of two neighbouring spans as one."""
    agenda: list[tuple[int, str, str, str]] = []
    for (start, middle), (cost, audit) in left.items():
        for (enter, leave), (more, rest) in right.items():
            if enter == middle:
                heappush(agenda, (cost + more, audit + rest, start, leave))
    final: Items = {}
    while agenda:
        cost, audit, start, leave = heappop(agenda)
        final.setdefault((start, leave), (cost, audit))
    return final


def span(labels: str, starts: str) -> Items:
    """The lightest items of a span of any length that is entered in one of `starts`."""
    if len(labels) <= SPAN:
        return {(start, leave): item for start in starts for leave, item in derived(labels, start).items()}
    half = SPAN
    while 2 * half < len(labels):
        half *= 2
    left = span(labels[:half], starts)
    return joined(left, span(labels[half:], "".join(s for s in STATES if any(q == s for _, q in left))))


def goal(items: Items) -> Item:
    """The lightest way from nothing to a whole conversation."""
    return min(items["0", q] for q in GOALS if ("0", q) in items)


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of each row of `df` after its damage; a dropped row has no copies."""
    conv, number = (F.coalesce(df[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    case = F.crc32(F.concat(conv, F.lit(":"), number).cast("binary")) % 20
    role, text = (F.coalesce(df[c], F.lit(" ")) for c in ("role", "text"))
    text = F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text)
    return df.select(
        df["conv_id"].alias("conv_id"),
        df["turn"].cast("long").alias("turn"),
        F.when(case == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("copies"),
    )


#: Rows of a conversation in order; those alike in all four are interchangeable.
ORDER = ["conv_id", "turn", "role", "print"]


def _printed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("print", F.unhex(F.md5(F.col("text").cast("binary"))))


def faults(rows: DataFrame) -> DataFrame:
    """One row for all alike rows: how many there are, the initial of their role, and the fault of the first one.

    A fault is `b` for blank, `d` for duplicate, `t` for truncated or empty; of the others alike a non-blank one is `d`.
    """
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    kinds = _printed(rows).withColumns({"blank": last == "", "cut": ~last.isin(".", "!", "?")})
    alike = kinds.groupBy(*ORDER).agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    place = F.expr("row_number() OVER (PARTITION BY conv_id, role, print, copies > 0 ORDER BY turn)")
    fault = F.when(F.col("blank"), "b").when(place > 1, "d").when(F.col("cut"), "t").otherwise("")
    return alike.select(*ORDER, "copies", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


COUNTS = ["size", "turns", "blank", "duplicate", "truncated", "illegal"]
SPANS = "part int, low long, high long, first string, last string, " + ", ".join(f"{c} long" for c in COUNTS)
SPANS += ", costs array<long>, audits array<string>"


class Run:
    """Consecutive rows of one conversation."""

    def __init__(self, conversation):
        self.conversation = conversation
        self.labels: list[str] = []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.first = self.last = None

    def add(self, number: int | None, initial: str, fault: str, copies: int) -> None:
        counts = self.counts
        if number is not None and copies:
            counts["turns"] += number != self.high
            self.low, self.high = number if self.low is None else self.low, number
        for k in range(copies):
            kind = fault if k == 0 or fault == "b" else "d"
            label = initial if initial in ("s", "u", "a") else "x"
            self.labels.append(GONE if kind in ("b", "d") else label.upper() if kind == "t" else label)
            counts["size"] += 1
            counts["blank"] += kind == "b"
            counts["duplicate"] += kind == "d"
            counts["truncated"] += kind == "t"
            counts["illegal"] += self.last is not None and self.last + initial not in ORDERED
            self.first, self.last = initial if self.first is None else self.first, initial

    def row(self, part: int, starts: str) -> tuple:
        items = span("".join(self.labels), starts)
        found = [items.get((p, q)) for p in STATES for q in STATES]
        costs, audits = [i and i[0] for i in found], [i and i[1] for i in found]
        ends = (self.low, self.high, self.first, self.last)
        return (self.conversation, part, *ends, *self.counts.values(), costs, audits)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _record(held, schema)
            held = []
    if held:
        yield _record(held, schema)


def _arrow(kind: DataType, fields: str) -> pa.Schema:
    """The Arrow schema of a conversation's id and `fields`."""
    return to_arrow_schema(StructType([StructField("conv_id", kind), *StructType.fromDDL(fields).fields]))


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def spans(alike: DataFrame) -> DataFrame:
    """The items and counts of each run of rows of one conversation, `alike` as `faults` gives it."""
    kind = alike.schema["conv_id"].dataType
    schema = _arrow(kind, SPANS)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, run, starts = TaskContext.get().partitionId(), None, STATES
        for conversation, number, initial, fault, copies in _values(batches):
            if run is None or conversation != run.conversation:
                if run is not None:
                    yield run.row(part, starts)
                    # No other task has rows of a conversation that begins and ends inside this one.
                    starts = "0"
                run = Run(conversation)
            run.add(number, initial, fault, copies)
        if run is not None:
            yield run.row(part, STATES)

    ranged = alike.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    columns = ranged.select("conv_id", "turn", "initial", "fault", "copies")
    return columns.mapInArrow(lambda batches: _batched(runs(batches), schema), f"conv_id {kind.simpleString()}, {SPANS}")


WHOLE = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def repaired(parts: DataFrame) -> DataFrame:
    """Counts, cost and audit of each conversation from its spans, `parts` as `spans` gives it."""
    kind = parts.schema["conv_id"].dataType
    schema = _arrow(kind, WHOLE)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held = None
        for conversation, _, low, high, first, last, *rest in _values(batches):
            counts, (costs, audits) = dict(zip(COUNTS, rest[: len(COUNTS)], strict=True)), rest[len(COUNTS) :]
            pairs = [(p, q) for p in STATES for q in STATES]
            found = zip(pairs, costs, audits, strict=True)
            items = {pair: (cost, audit) for pair, cost, audit in found if cost is not None}
            if held is not None and held[0] == conversation:
                _, before, least, most, end, sums = held
                if low is not None and low == most:
                    counts["turns"] -= 1
                if first is not None and end is not None and end + first not in ORDERED:
                    counts["illegal"] += 1
                least = low if least is None else least
                sums = {c: sums[c] + counts[c] for c in COUNTS}
                most = most if high is None else high
                held = (conversation, joined(before, items), least, most, end if last is None else last, sums)
                continue
            if held is not None:
                yield _whole(*held)
            held = (conversation, {k: v for k, v in items.items() if k[0] == "0"}, low, high, last, counts)
        if held is not None:
            yield _whole(*held)

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(lambda batches: _batched(merge(batches), schema), f"conv_id {kind.simpleString()}, {WHOLE}")


def _whole(conversation, items: Items, low, high, last, counts: dict) -> tuple:
    gaps = 0 if low is None else high - low + 1 - counts["turns"]
    return (conversation, gaps, *(counts[c] for c in ("blank", "duplicate", "truncated", "illegal")), *goal(items))


class Writer:
    """Applies the edits of one conversation to its rows, given in order, and hashes what comes out."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.lines = audit, 0, "0", 0
        self.hash = hashlib.sha256()

    def _line(self, role: str, text: str, initial: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines, self.state = self.lines + 1, initial

    def _other(self, text: str) -> None:
        self._line("assistant" if turn(self.state) == "a" else "user", text, turn(self.state))

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._other("")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self._line(role, text, role[:1])
        elif letter == "R":
            self._other(text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


def conversations(df: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of `df`.

    `df` (conv_id, turn, role, text) is damaged first. Null ids are one conversation; a null turn stands first; a null text
    or role is one space. Rows of one turn stand in the order of their roles, then of the hashes of their texts, so their
    order in the table does not matter; alike rows are duplicates from the second on. A role without an initial cannot be
    kept. An empty table gives no rows; other columns are not read.
    """
    rows = damaged(df)
    found = repaired(spans(faults(rows)))
    kind = found.schema["conv_id"].dataType
    texts = _printed(rows.where("copies > 0"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in WHOLE.split(", "))]
    bare = [F.lit(None).cast(t).alias(c) for c, t in zip(("turn", "role", "print", "text", "copies"), ("long", "string", "binary", "string", "int"), strict=True)]
    columns = [c.split()[0] for c in WHOLE.split(", ")]
    both = found.select("conv_id", F.lit(0).alias("kind"), *bare, *columns)
    both = both.unionByName(texts.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "print", "text", "copies", *nothing))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:]).drop("print", "turn")
    schema = _arrow(kind, f"{WHOLE}, repaired_sha256 string")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head, writer = None, None
        for conversation, is_row, role, text, copies, *whole in _values(batches):
            if is_row:
                for _ in range(copies):
                    writer.row(role, text)
                continue
            if writer is not None:
                yield (*head, writer.digest())
            head, writer = (conversation, *whole), Writer(whole[-1])
        if writer is not None:
            yield (*head, writer.digest())

    out = f"conv_id {kind.simpleString()}, {WHOLE}, repaired_sha256 string"
    return ordered.mapInArrow(lambda batches: _batched(write(batches), schema), out)
