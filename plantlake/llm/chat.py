"""Chat formatting by quotation linking.

Messages are parsed into lines of nested quote levels. What a message says itself, its paragraphs, lines and sentences, is
hashed after normalising, and the first message of a conversation with a passage is its original. Quoted passages are joined
to the originals by that hash; the message quoted most is the one replied to. Paragraphs and lines count before sentences,
sentences before passages of a few letters, and a deeper level counts only if no level above it is found. A message without a
match replies to the one before.
The conversation is then laid out in reply order, each message without its quotes.
"""

from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm.common import running, stored

MARKS = regex.compile(r"^\s*((?:>\s?)+)")
ATTRIBUTION = regex.compile(r"(?i)\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$")
SENTENCE_ENDS = regex.compile(r"[.!?…؟।]+[\p{Pe}\p{Pf}\"']*\s+|[。！？．｡]+")
#: A passage with fewer normalised characters may be said by chance, so it counts after all longer ones.
LEAST_CHARS = 8
#: What a quoted print is of; the lower one counts first.
WHOLE, SENTENCE, SHORT = 0, 1, 2
TURNS = 512


def levels(text: str) -> list[tuple[int, str]]:
    """Quote level and content of each line; a line that only announces a quote is left out."""
    lines = []
    for line in text.split("\n"):
        mark = MARKS.match(line)
        lines.append((mark[1].count(">"), line[mark.end() :]) if mark else (0, line))
    deeper = [b[0] > a[0] for a, b in zip(lines, lines[1:], strict=False)] + [False]
    return [x for x, d in zip(lines, deeper, strict=True) if not (d and ATTRIBUTION.search(x[1]))]


def passages(lines: list[tuple[int, str]]) -> Iterator[tuple[int, str]]:
    """Level and text of each paragraph, a run of lines of one level without an empty one."""
    held: list[str] = []
    at = 0
    for level, line in [*lines, (-1, "")]:
        if held and (level != at or not line.strip()):
            yield at, " ".join(held)
            held = []
        if line.strip():
            held.append(line)
            at = level


def print_of(passage: str) -> tuple[int, bool] | None:
    """A hash of the letters and digits of a passage, in lower case, and whether they are few; none if there are none.

    A passage of pictographs alone is hashed by them.
    """
    plain = " ".join(regex.findall(r"[\p{L}\p{N}]+", passage.lower())) or "".join(regex.findall(r"\p{So}+", passage))
    return (xxhash.xxh3_64_intdigest(plain) - (1 << 63), len(plain) < LEAST_CHARS) if plain else None


def sentences(passage: str) -> list[str]:
    return SENTENCE_ENDS.split(passage)


def kinds(passage: str) -> Iterator[tuple[int, int]]:
    """Print and kind of a quoted passage and of its sentences; short sentences tell nothing beside longer ones."""
    if whole := print_of(passage):
        yield whole[0], SHORT if whole[1] else WHOLE
    found = [h for x in sentences(passage) if (h := print_of(x))]
    few = all(short for _, short in found)
    yield from ((h, SHORT if short else SENTENCE) for h, short in found if few or not short)


def parsed(text: str) -> tuple[str, set[int], dict[tuple[int, int], int], int]:
    """Own text without quotes, prints of own passages, kinds of quoted prints by level and print, quoted lines."""
    lines = levels(text)
    own = [line for level, line in lines if level == 0]
    said = {p for _, p in passages([(0, line) for line in own])} | set(own)
    said = said | {x for p in said for x in sentences(p)} | {"\n".join(own)}
    quoted: dict[tuple[int, int], int] = {}
    for level, passage in [*passages(lines), *lines]:
        for found, kind in kinds(passage) if level else ():
            quoted[level, found] = min(kind, quoted.get((level, found), kind))
    prints = {h[0] for p in said if (h := print_of(p))}
    return "\n".join(own).strip(), prints, quoted, sum(level > 0 for level, _ in lines)


QUOTED = "array<struct<level:bigint,print:bigint,kind:bigint>>"
SCHEMA = f"conv_id long, turn long, role string, text string, said array<long>, quoted {QUOTED}, quoted_lines long"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [parsed(t or "") for t in batch.column(3).to_pylist()]
        columns = [*batch.columns[:3], pa.array([r[0] for r in rows], pa.string())]
        columns.append(pa.array([sorted(r[1]) for r in rows], pa.list_(pa.int64())))
        quoted = [[{"level": a, "print": h, "kind": kind} for (a, h), kind in sorted(r[2].items())] for r in rows]
        columns.append(pa.array(quoted, pa.list_(pa.struct([(n, pa.int64()) for n in ("level", "print", "kind")]))))
        columns.append(pa.array([r[3] for r in rows], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])


def _parents(rows: DataFrame) -> DataFrame:
    """conv_id, turn, quoted_turn: the message that a message quotes.

    The lowest level that is found decides, by the number of passages, of sentences, of short passages and then the latest.
    """
    said = rows.select("conv_id", "turn", F.explode("said").alias("print"))
    originals = said.groupBy("conv_id", "print").agg(F.min("turn").alias("parent"))
    quotes = rows.select("conv_id", "turn", F.inline("quoted"))
    quotes = quotes.groupBy("conv_id", "turn", "level", "print").agg(F.min("kind").alias("kind"))
    met = quotes.join(originals, ["conv_id", "print"]).where("parent < turn")
    counts = [F.count_if(F.col("kind") == kind).alias(f"n{kind}") for kind in (WHOLE, SENTENCE, SHORT)]
    votes = met.groupBy("conv_id", "turn", "level", "parent").agg(*counts)
    order = F.struct((-F.col("level")).alias("above"), "n0", "n1", "n2", "parent")
    best = votes.groupBy("conv_id", "turn").agg(F.max(order).alias("best"))
    return best.select("conv_id", "turn", F.col("best.parent").alias("quoted_turn"))


def _carried(df: DataFrame, value: str, into: str, own: bool) -> DataFrame:
    """The largest `value` of rows of the conversation up to a turn, that turn itself included if `own`.

    Turns are dealt out in blocks, so that a conversation of any length is not one task's work.
    """
    ends = df.groupBy("conv_id", "block").agg(F.max(value).alias("_end"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("conv_id", "block", F.max("_end").over(earlier).alias("_end"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    inner = df.withColumn("_inner", F.max(value).over(inside)).join(ends, ["conv_id", "block"])
    return inner.withColumn(into, F.greatest("_inner", "_end")).drop("_inner", "_end")


def _paths(turns: DataFrame) -> DataFrame:
    """conv_id, start, path of each run of messages; a run starts where a message replies to an earlier one than the last.

    Runs that hang on later messages of a run come first, so that each reply follows what it replies to without cutting
    another thread in two. The loop takes one round for each level of nesting.
    """
    heads = turns.where("turn = start").select("conv_id", "start", "quoted_turn")
    branches = heads.where("quoted_turn IS NOT NULL")
    of = turns.select("conv_id", F.col("turn").alias("quoted_turn"), F.col("start").alias("above"))
    branches = stored(branches.join(of, ["conv_id", "quoted_turn"]), "branches")
    empty = F.array().cast("array<struct<a:bigint,b:bigint>>")
    done = heads.where("quoted_turn IS NULL").select("conv_id", "start", empty.alias("path"))
    layer = done
    while True:
        upper = layer.select("conv_id", F.col("start").alias("above"), F.col("path").alias("_path"))
        step = F.array(F.struct((-F.col("quoted_turn")).alias("a"), F.col("start").alias("b")))
        layer = branches.join(upper, ["conv_id", "above"]).select("conv_id", "start", F.concat("_path", step).alias("path"))
        layer = stored(layer, "layer")
        if layer.isEmpty():
            return done
        done = done.unionByName(layer)


def formatted(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, reply_to, link, position, quoted_lines, text of each row of `df` (conv_id, turn, role, text).

    `reply_to` is a turn, `link` is `quote`, `previous` or `root`, `position` counts from 0 in reply order within the
    conversation, `text` is without quotes. A null text is empty. Rows of the same turn are alternatives: they reply to the
    same message and stand next to each other. A row without conv_id or turn has no place: link `none`, position null.
    An empty table gives no rows; other columns are not read.
    """
    rows = df.select(df["conv_id"].cast("long").alias("conv_id"), df["turn"].cast("long").alias("turn"), "role", "text")
    rows = stored(rows.mapInArrow(_parse, SCHEMA), "messages")
    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    turns = placed.select("conv_id", "turn").distinct().join(_parents(placed), ["conv_id", "turn"], "left")
    turns = turns.withColumn("block", F.floor(F.col("turn") / TURNS))
    turns = _carried(turns, "turn", "last", own=False)
    branch = F.col("last").isNull() | (F.col("quoted_turn") < F.col("last"))
    turns = _carried(turns.withColumn("_start", F.when(branch, F.col("turn"))), "_start", "start", own=True)
    turns = stored(turns, "turns")
    turns = turns.join(_paths(turns), ["conv_id", "start"])
    link = F.when(F.col("quoted_turn").isNotNull(), "quote").when(F.col("last").isNotNull(), "previous").otherwise("root")
    turns = turns.select(
        "conv_id",
        "turn",
        F.coalesce("quoted_turn", "last").alias("reply_to"),
        link.alias("link"),
        F.struct("path", "block").alias("part"),
    )
    linked = placed.drop("said", "quoted").join(turns, ["conv_id", "turn"])
    order = ["turn", "role", F.xxhash64("text")]
    linked = running(linked, ["conv_id"], "part", order, F.lit(1).cast("long"), "position").drop("part")
    lost = rows.where("conv_id IS NULL OR turn IS NULL").drop("said", "quoted")
    return linked.unionByName(lost.withColumn("link", F.lit("none")), allowMissingColumns=True).select(
        "conv_id", "turn", "role", "reply_to", "link", "position", "quoted_lines", "text"
    )
