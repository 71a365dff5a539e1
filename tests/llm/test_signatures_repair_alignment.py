"""Circulant signatures, conversation repair and token alignment against plain versions in Python."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from plantlake.llm import alignment, minhash, repair, words

FOLDER = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
BOTH = pytest.mark.parametrize("name", ["documents", "edges", "nothing"])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


# Near copies.


def shingles(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    found = [w for w in re.split(f"[{SPACES}]+", lower) if w]
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def plain_components(rows):
    """Rows of one id are one document; a row without an id links with nothing."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    named = [(i, s) for i, s in sets if i is not None and s]
    for k, (a, x) in enumerate(named):
        for b, y in named[:k]:
            if 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(i, len(s), i if i is None else find(i), i is None or find(i) == i) for i, s in sets]


@BOTH
def test_near_copies(request, name):
    df = request.getfixturevalue(name)
    assert ordered(minhash.grouped(df).collect()) == ordered(plain_components([(r["doc_id"], r["text"]) for r in df.collect()]))


def test_groups_templates_and_chains(spark):
    """A large group of near copies, a template whose texts are not linked, chains of links, and sets at the very threshold."""
    draw, rows = random.Random(5), []
    base = [f"w{k}" for k in range(120)]
    for k in range(300):
        text = list(base)
        text[draw.randrange(120)] = f"new{k}"
        rows.append(" ".join(text))
    for k in range(200):
        rows.append(" ".join([f"t{j}" for j in range(80)] + [f"own{k}_{j}" for j in range(20)]))
    for k in range(60):
        rows.append(" ".join(f"c{j}" for j in range(k * 3, k * 3 + 60)))
    rows += [" ".join(f"e{j}" for j in range(104)), " ".join(f"e{j}" for j in range(89)), " ".join(f"e{j}" for j in range(88))]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(8)
    got = ordered(minhash.grouped(df).collect())
    assert got == ordered(plain_components(list(enumerate(rows))))
    sizes = Counter(r[2] for r in got)
    assert max(sizes.values()) > 290 and sizes[300] == 1


def test_rare_shingles_find_every_link(spark):
    """The way for what stays apart in a bucket loses no link: linked sets share a token of their rare parts."""
    draw = random.Random(9)
    pool = [np.array(sorted(draw.sample(range(1, 2000), 60)), np.uint64) for _ in range(12)]
    sets = []
    for k in range(120):
        own = set(pool[k % 12].tolist())
        own -= set(draw.sample(sorted(own), draw.randint(0, 6)))
        sets.append(np.array(sorted(own | set(draw.sample(range(1, 2000), draw.randint(0, 6)))), np.uint64))
    rows = [(k, s.tobytes()) for k, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "node long, shingles binary").repartition(5)
    found = defaultdict(set)
    for r in minhash.by_rare_shingles(df).collect():
        found[r["token"]].add(r["node"])
    met = {(a, b) for nodes in found.values() for a in nodes for b in nodes if a < b}
    links = {(a, b) for a in range(120) for b in range(a + 1, 120) if minhash.linked(sets[a], sets[b])}
    assert links and links <= met


def test_signatures_estimate_similarity():
    """Coordinates agree as often as the sets are similar, and are circular shifts of one permutation."""
    draw = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.95):
        both = draw.integers(0, 1 << 63, int(1000 * share)).astype(np.uint64)
        sets = [np.sort(np.r_[both, draw.integers(0, 1 << 63, 1000 - len(both)).astype(np.uint64)]) for _ in range(2)]
        want = len(both) / (2000 - len(both))
        a, b = minhash.signatures(sets).T
        assert abs((a == b).mean() - want) < 0.09
    cells = minhash.scattered(words.mix(np.arange(50, dtype=np.uint64)))
    for k in range(0, 300, 37):
        later = cells + np.uint32(k * minhash.FIRST & 0xFFFFFFFF)
        one, two = (minhash.shifted(c, s, np.empty_like(c), np.empty_like(c)) for c, s in ((cells, k), (later, 0)))
        assert (one == two).all()
    assert len(set(minhash.shifted(np.arange(1 << 16, dtype=np.uint32), 3, *(np.empty(1 << 16, np.uint32) for _ in "ab")))) == 1 << 16


# Conversations.


def plain_repair(rows):
    groups = defaultdict(list)
    for conv, number, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if number is None else number}".encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        groups[conv] += [(number, role, text)] * {0: 0, 3: 2}.get(case, 1)
    return [(conv, *plain_conversation(found)) for conv, found in groups.items()]


def plain_conversation(rows):
    """The best way into each state after each row, kept with all lines written so far."""
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
    turns = [t for t, _, _ in rows if t is not None]
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACES)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after, full = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}

    def keep(best, state, value):
        if state not in best or value[:2] < best[state][:2]:
            best[state] = value

    def insert(best):
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                keep(best, after[state], (cost + 5, audit + "I", [*lines, full[after[state]] + ":"]))
        return best

    best = insert({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        step = {}
        for state, (cost, audit, lines) in best.items():
            keep(step, state, (cost + 2, audit + "D", lines))
            if fault in ("b", "d"):
                continue
            cost, follow = cost + 5 * (fault == "t"), after[state]
            keep(step, follow, (cost + 1, audit + "R", [*lines, f"{full[follow]}:{text}"]))
            if role[:1] == follow or (role[:1], state) == ("s", ""):
                keep(step, role[:1], (cost, audit + "K", [*lines, f"{role}:{text}"]))
        best = insert(step)
    cost, audit, lines = min((best[q] for q in ("", "a") if q in best), key=lambda v: v[:2])
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


CONVERSATIONS = "conv_id long, turn int, role string, text string"


def test_repairs_of_the_table(spark):
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert ordered(repair.conversations(df).collect()) == ordered(plain_repair(rows))


def test_repairs_of_odd_and_long_conversations(spark):
    """Nulls everywhere, ties, repeated rows, unknown roles, and conversations over many tasks; extra columns are not read."""
    draw, rows = random.Random(4), []
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    for conv in [None, *range(120)]:
        many = conv in (None, 7)
        for k in range(2000 if many else draw.randint(1, 12)):
            text = draw.choice([f"Text {k}.", f"Cut {k}", "Same.", "", None, " \n", "Hello! ", "x"])
            rows.append((conv, k if many else draw.choice([None, k, k, k // 2]), draw.choice(roles), text))
    rows += rows[:40]
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(8)
    for name in ("kind", "copies", "part", "print", "fault", "audit", "_"):
        df = df.selectExpr("*", f"7 AS {name}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordered(repair.conversations(df).collect())
        assert repair.spans(repair.faults(repair.damaged(df))).where("conv_id = 7").count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == ordered(plain_repair(rows))
    assert repair.conversations(df.where("1 = 0")).count() == 0


def test_named_conversations_and_dropped_ones(spark):
    """Ids may be text; a conversation of which nothing is left has zeros and the hash of nothing."""
    gone = next(f"c{k}" for k in range(1000) if zlib.crc32(f"c{k}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 1, "user", "Hi."), ("ok", 1, "user", "Hi.")], CONVERSATIONS.replace("long", "string", 1))
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.conversations(df).collect()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got["ok"][5:7] == (2, "D")


def test_derivations_are_lightest_by_trying_all():
    """Every string of edits with up to two insertions in a row, for all conversations of three rows."""

    def all_ways(labels, state):
        if not labels:
            yield 0, "", state
        else:
            for cost, letter, after in repair.edits(labels[0], state):
                for more, rest, last in all_ways(labels[1:], after):
                    yield cost + more, letter + rest, last
        for more, rest, last in insertions(labels, state, 2):
            yield more, rest, last

    def insertions(labels, state, left):
        for k in range(1, left + 1):
            at = state
            for _ in range(k):
                at = repair.turn(at)
            if not labels:
                yield 5 * k, "I" * k, at
                continue
            for cost, letter, after in repair.edits(labels[0], at):
                for more, rest, last in all_ways(labels[1:], after):
                    yield 5 * k + cost + more, "I" * k + letter + rest, last

    for code in range(9**3):
        labels = "".join("suaxSUAX-"[code // 9**k % 9] for k in range(3))
        want = min((c, a) for c, a, q in all_ways(labels, "0") if q in repair.GOALS)
        assert repair.goal(repair.span(labels, "0")) == want
        halves = repair.joined(repair.span(labels[:1], "0"), repair.span(labels[1:], repair.STATES))
        assert repair.goal(halves) == want


# Alignment.


def byte_values():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_VOCABULARY)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
        self.values = byte_values()

    def tokens(self, text):
        """(id, start, end) of both sides."""
        if not text:
            return [], []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(self.values[c] for c in self.a.id_to_token(i))) for i in ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        if any(b"".join(x for _, x in side) != f" {text}".encode() for side in (a, b)):
            return [], []
        out = []
        for side in (a, b):
            at, spans = 0, []
            for i, piece in side:
                spans.append((i, at, at + len(piece)))
                at += len(piece)
            out.append(spans)
        return out

    def digests(self, rows):
        docs, held = [], Counter()
        for doc, text in rows:
            a, b = self.tokens(text)
            cuts = sorted({e for *_, e in a} & {e for *_, e in b})
            parts = [([], []) for _ in cuts]
            for side, spans in enumerate((a, b)):
                for token in spans:
                    parts[bisect.bisect_left(cuts, token[2])][side].append(token)
            links = [(i, j) for x, y in parts for i, s, e in x for j, t, f in y if s < f and t < e]
            text = ";".join("|".join(",".join(str(i) for i, _, _ in side) for side in part) for part in parts)
            held.update(set(links))
            docs.append((doc, len(a), len(b), len(cuts), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
        best = Counter()
        for (i, _), n in held.items():
            best[i] = max(best[i], n)
        for *counts, links, digest in docs:
            yield *counts, len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), digest


ODD = ["a▁b", "<|endoftext|> x <s> </s> <unk>", "é日本 \U0001f600 ﬁ", "x" * 5000, "  a  b\n\n\tc ", "\x00", "hi", "hi", "1" * 300]


@BOTH
def test_alignment(request, name):
    df = request.getfixturevalue(name)
    want = Plain().digests([(r["doc_id"], r["text"]) for r in df.collect()])
    assert ordered(alignment.aligned(df, BYTE_VOCABULARY, PIECE_VOCABULARY).collect()) == ordered(want)


def test_alignment_of_odd_texts(spark, monkeypatch):
    """Special strings are plain text, a piece that stands for a space gives nothing, and blocks do not matter."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 10)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "hi"), (None, "hi there"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ordered(alignment.aligned(df, BYTE_VOCABULARY, PIECE_VOCABULARY).collect())
    assert got == ordered(Plain().digests(rows))
    assert [r[1] for r in got if r[0] == 0] == [0]


def test_intervals_by_trying_all_pairs():
    draw = np.random.default_rng(2)
    for _ in range(200):
        sides = []
        for _ in "ab":
            ends = np.unique(np.r_[draw.integers(1, 30, draw.integers(1, 12)), 30])
            sides += [np.r_[0, ends[:-1]], ends]
        a, b = alignment.overlaps(*sides)
        pairs = [(i, j) for i in range(len(sides[0])) for j in range(len(sides[2])) if sides[0][i] < sides[3][j] and sides[2][j] < sides[1][i]]
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == pairs
        group_a, group_b = alignment.coalesced(*sides)
        cuts = sorted(set(sides[1].tolist()) & set(sides[3].tolist()))
        for group, ends in ((group_a, sides[1]), (group_b, sides[3])):
            assert group.tolist() == [bisect.bisect_left(cuts, e) for e in ends]
