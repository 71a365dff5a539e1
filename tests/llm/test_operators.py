"""Each operator against a plain version in Python, on edge cases and on the smallest documents table."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plantlake.llm import (
    bpe_count,
    chat,
    components,
    compression,
    decontaminate,
    jaccard,
    langid,
    mixing,
    orc_ids,
    shard_tree,
    toxicity,
)
from plantlake.session import scratch

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    out, held = [], ""
    for letter in text or "":
        if letter in SPACES:
            out, held = out + [held] * bool(held), ""
        else:
            held += letter
    return out + [held] * bool(held)


def shingles(text):
    found = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def tables(request, name):
    return request.getfixturevalue(name)


BOTH = pytest.mark.parametrize("name", ["documents", "edges", "nothing"])


@BOTH
def test_shards(request, name):
    df = tables(request, name)
    rows = shard_tree.sharded(df).collect()
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == texts
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "key" and 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        assert r["shard"] == r["region"] * 10 + r["rack"] * 5 + r["shard"] % 5
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_a_changed_weight_moves_rows_of_its_subtree_alone(spark):
    keys = spark.range(20000).withColumnRenamed("id", "doc_id")
    before, after = shard_tree.tree(), shard_tree.tree()
    after[1][0][2] = 3.0
    placed = shard_tree.place(shard_tree.place(keys, before, F.col("doc_id")), after, F.col("doc_id"), "new_")
    moved = placed.where("shard <> new_shard").collect()
    assert moved and all(r["new_region"] == 1 for r in moved)
    shares = Counter(r["new_shard"] for r in placed.collect())
    assert 1200 < shares[12] < 1670 and all(380 < n < 580 for k, n in shares.items() if k != 12)


@BOTH
def test_token_counts(request, name):
    df = tables(request, name)
    library = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for r in df.collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        want[r["doc_id"], len((r["text"] or "").encode()), n, n > 512] += 1
    assert Counter(map(tuple, bpe_count.token_counts(df, VOCABULARY).collect())) == want


def test_token_counts_of_odd_strings():
    library, letters = Tokenizer.from_file(VOCABULARY), list(" \n\t'stre<|>aAéß日1²!\x1c\x85 😀lmd")
    draw = random.Random(3)
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|>" * 3, "a<|endoftext|> b", "word " * 400_000]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert bpe_count.Counter(VOCABULARY).count(texts) == want


@BOTH
def test_ids_in_files(request, spark, name):
    df, path = tables(request, name), scratch(spark, "ids")
    orc_ids.write(df, VOCABULARY, path)
    got = orc_ids.contents(spark, path).collect()
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for r in df.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(want)
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    if ids:
        assert "PushedFilters: [In(doc_id" in orc_ids.lookup(spark, path, [5, 6])._jdf.queryExecution().toString()
        assert orc_ids.lookup(spark, path, [5]).count() == ids.count(5)


@BOTH
def test_languages(request, name):
    df = tables(request, name)
    rows = langid.identified(df, langid.train(df)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in df.collect())
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    known = {r["lang"] for r in df.collect() if r["lang"]}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 3 == 1)
        letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        if r["doc_id"] not in (None, 3):
            assert (r["lang_pred"] == "und") == (not letters) and r["lang_pred"] in known | {"und"}
        assert 0 <= r["score"] <= 1


def test_language_accuracy_and_rejection(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(df)
    held = langid.identified(df, model).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert langid.accepted(df, model).count() > 0.99 * df.count()
    assert langid.accepted(df, model).columns == df.columns


def filled(sizes):
    """Targets by sharing and resharing, as the words of the rule say."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_ones, rest = {}, set(order), float(sum(sizes.values()))
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if rest * weight[s] / total > 3 * sizes[s]}
        if not above:
            return target | {s: rest * weight[s] / total for s in open_ones}
        for s in above:
            target[s] = 3.0 * sizes[s]
        rest -= sum(target[s] for s in above)
        open_ones -= above
    return target


@BOTH
def test_mixing(request, name):
    df = tables(request, name)
    rows = mixing.mixed(df).collect()
    sizes = defaultdict(int)
    for r in df.collect():
        sizes[r["source"]] += len(words(r["text"]))
    want, taken = filled(dict(sizes)), defaultdict(int)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r["doc_id"], len(words(r["text"]))) for r in df.collect())
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mixed(df).collect()))
    drawn = mixing.drawn(df)
    assert drawn.columns == df.columns
    longest = max((len(words(r["text"])) for r in df.collect()), default=0)
    real = defaultdict(int)
    for r in drawn.collect():
        real[r["source"]] += len(words(r["text"]))
    assert all(abs(real[s] - want[s]) <= 2 * longest for s in sizes)


def test_many_sources_fill_up(spark):
    draw = random.Random(5)
    for _ in range(3):
        sizes = {f"s{k}": draw.choice([0, 1, 10, 1000, 50000]) for k in range(12)} | {None: 7}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        assert got == pytest.approx(filled(sizes))


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != t)))
    return min(row)


def test_bit_parallel_distance():
    draw = random.Random(2)
    for _ in range(500):
        pattern = "".join(draw.choices("abc", k=draw.randint(1, 90)))
        text = "".join(draw.choices("abc", k=draw.randint(0, 60)))
        assert decontaminate.nearest(pattern, text)[0] == distance(pattern, text)


def test_leaks(spark, edges, nothing):
    draw = random.Random(4)
    items = [(k, " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(draw.randint(3, 14)))) for k in range(30)]
    texts = []
    for k in range(200):
        item = list(draw.choice(items)[1])
        for _ in range(draw.randint(0, len(item) // 8)):
            item[draw.randrange(len(item))] = draw.choice("abcdefgh ")
        texts.append((k, "some words before, " + "".join(item).upper() + "\nand after."))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([*items, items[0], (50, None), (51, ""), (52, "tiny")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(frame, bench).collect()}
    plain = decontaminate.texts_of(pa.array([t for _, t in texts]))
    tests = dict(zip([i for i, _ in items], decontaminate.texts_of(pa.array([t for _, t in items])), strict=True))
    want = {
        (d, i)
        for (d, _), text in zip(texts, plain, strict=True)
        for i, item in tests.items()
        if len(item) >= decontaminate.LEAST_BYTES and distance(item, text) <= int(decontaminate.ERROR_RATE * len(item))
    }
    assert got == want and len(want) > 50
    clean = {r["doc_id"] for r in decontaminate.clean(frame, bench).collect()}
    assert clean == set(range(200)) - {d for d, _ in want}
    assert decontaminate.leaks(edges, bench).count() == 0 and decontaminate.clean(edges, bench).count() == edges.count()
    assert decontaminate.leaks(nothing, bench).count() == 0 and decontaminate.leaks(frame, bench.limit(0)).count() == 0


def test_short_items(spark):
    items = ["Tiny!", "42", "東京", "мир", "José", "blue whale", "What is it", "red apples grow", "?", "日本の首都は東京"]
    texts = {
        "a tiny house": {0}, "destiny and tinytown": set(), "it is 42.": {1}, "420 or 142": set(), "TINY": {0},
        "私は東京に住む。": {2}, "Война и мир": {3}, "“мир”": {3}, "смирный": set(), "by josé, née": {4}, "josés": set(),
        "two Blue\nWhales, a blue whale": {5}, "blue whales": set(), "so what is it?": {6}, "what is in": set(),
        "big red aples grow here": {7}, "red pears grow": set(), "? ! ?": set(), "Wo? 日本の首都は東京です": {2, 9},
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(frame, bench).collect()}
    assert got == {(d, i) for d, found in enumerate(texts.values()) for i in found}
    clean = {r["doc_id"] for r in decontaminate.clean(frame, bench).collect()}
    assert clean == {d for d, found in enumerate(texts.values()) if not found}


def test_conversations(spark):
    rows = [
        (1, 0, "system", "You are a helpful machine."),
        (1, 1, "user", "How do I bake a loaf of bread?"),
        (1, 2, "assistant", "Mix flour and water first.\n\nThen wait for the dough to rise."),
        (1, 3, "user", "On Monday, A wrote:\n> Mix flour and water first.\n\nHow much flour is that?"),
        (1, 4, "assistant", "> How much flour is that?\n>> Mix flour and water first.\nHalf a kilo of it."),
        (1, 5, "user", "> Then wait for the dough to rise.\nHow long do I wait?"),
        (2, 0, "user", None),
        (2, 0, "user", None),
        (2, 7, "user", ">>> unknown words that nobody said"),
        (None, 1, "user", "lost message"),
        (3, None, "user", "lost turn"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS position")
    got = chat.formatted(frame).collect()
    assert len(got) == len(rows)
    of = {(r["conv_id"], r["turn"]): r for r in got}
    assert [of[1, k]["reply_to"] for k in range(6)] == [None, 0, 1, 2, 3, 2]
    assert [of[1, k]["link"] for k in range(6)] == ["root", "previous", "previous", "quote", "quote", "quote"]
    assert [of[1, k]["position"] for k in range(6)] == [0, 1, 2, 3, 4, 5]
    assert of[1, 4]["text"] == "Half a kilo of it." and of[1, 3]["text"] == "How much flour is that?"
    assert of[2, 7]["text"] == "" and of[2, 7]["reply_to"] == 0
    assert sorted(r["position"] for r in got if r["conv_id"] == 2) == [0, 1, 2]
    assert {r["link"] for r in got if r["position"] is None} == {"none"}
    assert chat.formatted(frame.limit(0)).count() == 0


def test_short_partial_and_deep_quotes(spark):
    turns = [
        ("Shall we go to the lake, or rather up the hill on Sunday? The weather will be fine. Bring some water.", None),
        ("Yes", 0),
        ("42", 1),
        ("好的。明天见。我会带水来的朋友们。", 2),
        ("👍", 3),
        ("Hm. No way. It will rain all day long.", 4),
        ("> The weather will be fine.\nAre you sure?", 0),
        ("> yes\nGood.", 1),
        ("> 42\nWhy?", 2),
        ("> 明天见\nWhere?", 3),
        ("> 👍\nGreat.", 4),
        (">> It will rain\n>> all day long.\nThen we stay.", 5),
        ("> No way!\nPity.", 5),
        ("> Yes\n> Bring some water.\nHow much?", 0),
        (">> Bring some water.\n> 42\nLitres?", 2),
        ("> Yes. That was said by somebody else.\n> ```\nWho?", 14),
    ]
    rows = [(1, k, "user", t) for k, (t, _) in enumerate(turns)] + [(2, 0, "user", "Hello"), (2, 1, "user", "Fine"), (2, 2, "user", "> 42")]
    got = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [r["reply_to"] for r in sorted(got, key=lambda r: r["turn"]) if r["conv_id"] == 1] == [p for _, p in turns]
    links = {(r["conv_id"], r["turn"]): r["link"] for r in got}
    assert {k for k, link in links.items() if link == "quote"} == {(1, k) for k in range(6, 15)}
    assert links[2, 2] == "previous"


def test_reply_order_with_branches(spark):
    said = "message number {} says something of its own"
    parents = {1: 0, 2: 1, 3: 2, 4: 1, 5: 4, 6: 2, 7: 4}
    rows = [(9, 0, "user", said.format(0))]
    for turn, parent in parents.items():
        quote = "" if parent == turn - 1 else f"> {said.format(parent)}\n"
        rows.append((9, turn, "user", quote + said.format(turn)))
    got = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["turn"]: r["reply_to"] for r in got} == {0: None} | parents
    order = [r["turn"] for r in sorted(got, key=lambda r: r["position"])]
    assert order == [0, 1, 2, 3, 6, 4, 5, 7]


def test_toxicity(spark, edges, nothing):
    folder = "/root/testdata/sf0.01"
    df, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    grammar = toxicity.train(df, labels)
    held = toxicity.scored(df, grammar).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.95
    rows = toxicity.scored(edges, toxicity.train(edges, labels)).collect()
    assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scored(nothing, toxicity.train(nothing, labels.limit(0))).count() == 0


def test_readings_of_clauses():
    grammar = toxicity.Grammar({"idio": 4.0}, {"hurt": 2.0})
    read = {t: dict(zip(toxicity.READINGS, grammar.features(t), strict=False)) for t in (
        "Such an idiot.", "You are an idiot!", "He is not an idiot.", "She said idiots; fine.", "I will hurt it", "unhurt hurting, videos"
    )}
    kinds = [max(v, key=v.get) if any(v.values()) else None for v in read.values()]
    assert kinds == ["plain", "targeted", "negated", "reported", "threat", None]


def labelled(folder):
    texts = {r["doc_id"]: r for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}
    rows = [(texts[r["doc_id"]], r["toxic"]) for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()]
    fold = [zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 for d, _ in rows]
    taught = sorted(((d["text"] or "", bool(y)) for (d, y), h in zip(rows, fold, strict=True) if not h), key=lambda r: zlib.crc32(r[0].encode()))
    return taught, [(d["text"], d["lang"], y) for (d, y), h in zip(rows, fold, strict=True) if h]


def test_toxicity_by_language():
    taught, held = labelled("/root/testdata/sf0.1")
    grammar = toxicity.fit(*map(list, zip(*taught, strict=True)))
    said = (grammar.scores(np.array([grammar.features(t) for t, _, _ in held])) >= 0.5).tolist()
    found, there = Counter(), Counter()
    for (_, lang, toxic), yes in zip(held, said, strict=True):
        there[lang, toxic] += 1
        found[lang, toxic] += yes
    assert all(found[k] >= 0.6 * n for k, n in there.items() if k[1] and n >= 5), (found, there)
    assert sum(n for k, n in found.items() if k[1]) >= 0.85 * sum(n for k, n in there.items() if k[1])
    assert sum(n for k, n in found.items() if not k[1]) <= 0.02 * len(held)


def test_stems_of_small_samples():
    filler = [f"plain words number {k} of a text" for k in range(120)]
    taught = filler + [f"you vargling thing {k}" for k in range(6)]
    stems = toxicity.learn_stems(taught, np.array([False] * 120 + [True] * 6))
    assert any("vargling".startswith(s) for s in stems) and not any("words".startswith(s) for s in stems)
    assert not toxicity.learn_stems(filler, np.arange(120) % 2 == 0)
    share = sum(math.comb(9, k) * 0.2**k * 0.8 ** (9 - k) for k in range(4, 10))
    assert math.isclose(toxicity.chance(4, 9, 0.2), share)


@BOTH
def test_compression(request, name):
    df = tables(request, name)
    rows = compression.judged(df).collect()
    want = Counter()
    for r in df.collect():
        text = r["text"] or ""
        found = words(text)
        grams = Counter(tuple(found[k : k + 3]) for k in range(len(found) - 2))
        repeat = {k + j for k in range(len(found) - 2) if grams[tuple(found[k : k + 3])] > 1 for j in range(3)}
        lines = Counter(line for line in text.split("\n") if words(line))
        counts = (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in lines.values()), len(repeat))
        want[r["doc_id"], *counts, len(found) < 50 or 100 * len(repeat) > 50 * len(found)] += 1
    assert Counter(tuple(r)[:7] for r in rows) == want
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_bands():
    import zstandard

    draw, press = random.Random(1), zstandard.ZstdCompressor(level=3)
    noise = bytes(draw.getrandbits(8) for _ in range(9000))
    prose = b" ".join(bytes(draw.choices(b"etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(1500))
    assert not compression.in_bands(b"same words " * 500, press)[2]
    assert not compression.in_bands(noise, press)[2]
    assert compression.in_bands(prose, press)[2]
    assert not compression.in_bands(prose[:4000] + b"spam " * 1000, press)[2]
    assert compression.in_bands(b"", press)[2] and compression.in_bands(b"short", press)[2]


def plain_verdicts(texts):
    """The bands' verdict on each text, with quartiles of sorted lists in place of merged histograms."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)

    def base(text):
        found = words(text)
        grams = Counter(tuple(found[k : k + 3]) for k in range(len(found) - 2))
        repeat = {k + j for k in range(len(found) - 2) if grams[tuple(found[k : k + 3])] > 1 for j in range(3)}
        return len(found) >= 50 and 100 * len(repeat) <= 50 * len(found)

    def place(raw):
        many = sum(b > 127 for b in raw) > len(raw) / 3
        return many, sum(len(raw) >= b[0] for b in compression.BANDS) - 1

    found = {}
    seen = set()
    for text in texts:
        raw = (text or "").encode()
        if not base(text or "") or len(raw) < 64 or raw in seen:
            continue
        seen.add(raw)
        found.setdefault(place(raw), []).append(round(math.log(compression.ratio(raw, press)) * 400))
        parts = list(compression.chunks(raw))
        for part in parts if len(parts) > 1 else ():
            found.setdefault((place(raw)[0], -1), []).append(round(math.log(compression.ratio(part, press)) * 400))

    def outside(key, value):
        if key not in found:
            return False
        low, high = np.quantile(found[key], [0.25, 0.75]) / 400
        beyond = 3 * (high - low) + 0.2
        return not low - beyond <= math.log(value) <= high + beyond

    out = []
    for text in texts:
        raw = (text or "").encode()
        whole, share, fine, packed = compression.in_bands(raw, press)
        if len(raw) >= 64:
            fine = fine and not outside(place(raw), whole)
            bad = sum(outside((place(raw)[0], -1), r) for r in packed)
            fine = fine and bad <= compression.BAD_CHUNKS * len(packed)
        out.append((base(text or "") and fine, fine))
    return out


def test_learned_bands(spark, edges):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(
        edges.select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text")
    )
    spot = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars BETWEEN 2200 AND 6000").limit(40)
    # A third of a text said again, too little for the base rule and the fixed limits.
    again = spot.selectExpr("doc_id + 2000000", "text || ' ' || substr(text, 1, int(n_chars * 0.28))").toDF("doc_id", "text")
    df = df.unionByName(again)
    given = df.collect()
    want = Counter((r["doc_id"], *v) for r, v in zip(given, plain_verdicts([r["text"] for r in given]), strict=True))
    rows = compression.judged(spark.createDataFrame(given, df.schema)).collect()
    assert Counter((r["doc_id"], r["kept"], r["in_bands"]) for r in rows) == want
    assert all(r["in_bands"] == (r["reason"] is None) for r in rows)
    clean = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 10**6 and not r["base_failed"]]
    assert len(clean) > 100 and all(r["kept"] for r in clean)
    assert any(not r["in_bands"] for r in rows if r["base_failed"])


def test_lower_limits_hold_encoded_text():
    import base64

    import zstandard

    draw, press = random.Random(3), zstandard.ZstdCompressor(level=3)
    letters = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    encoded = base64.encodebytes(draw.randbytes(300_000))
    noise = b" ".join(bytes(draw.choices(letters, k=draw.randint(3, 10))) for _ in range(50_000))
    base85 = base64.b85encode(draw.randbytes(300_000))
    for size in (256, 400, 600, 900, 1500, 2048, 3000, 4000, 10_000, 40_000, 300_000):
        for text in (encoded, noise, base85):
            assert not compression.in_bands(text[:size], press)[2], (size, text[:20])
    texts = pq.read_table(f"{FOLDER}/documents.parquet").column("text").to_pylist()
    prose = [t.encode() for t in texts if t and compression.ratio(t.encode(), press) < 3]
    prose = [t for t in prose if len(t) >= 256]
    lowest = [t for t in prose if compression.ratio(t, press) < compression.limits(t)[0]]
    assert len(prose) > 100 and not lowest
    korean = "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로".encode()
    assert not compression.in_bands(draw.randbytes(3000), press)[2] and compression.in_bands(korean, press)[2]
    long = max(prose, key=len)
    assert compression.in_bands(long[:3500], press)[2]
    assert not compression.in_bands(long[:1700] + encoded[:1700], press)[2]
    assert not compression.in_bands(long[:6000] + encoded[:4500], press)[2]


def plain_groups(rows):
    sets = [(r["doc_id"], frozenset(shingles(r["text"]))) for r in rows]
    above = {i: i for i, _ in sets if i is not None}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    named = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, a) in enumerate(named):
        for j, b in named[:k]:
            if 100 * len(a & b) >= 75 * len(a | b):
                x, y = top(i), top(j)
                above[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else top(i)) for i, s in sets)


@BOTH
def test_jaccard(request, name):
    df = tables(request, name)
    assert Counter(map(tuple, jaccard.grouped(df).collect())) == plain_groups(df.collect())


def test_jaccard_near_the_limit(spark):
    draw = random.Random(8)
    rows, n = [], 0
    for _ in range(25):
        base = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice([5, 6, 8, 12, 30, 80, 200]))]
        for _ in range(draw.randint(2, 12)):
            own = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 25))):
                own[draw.randrange(len(own))] = f"v{draw.randrange(10**6)}"
            rows.append((n, " ".join(own[: len(own) - draw.randint(0, len(own) // 5)])))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_groups(df.collect())
    assert Counter(map(tuple, jaccard.grouped(df).collect())) == want
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    first = {s: min(i for i in sets if sets[i] == s) for s in set(sets.values())}
    pairs = {(a, b) for x, a in first.items() for y, b in first.items() if a < b and 100 * len(x & y) >= 75 * len(x | y)}
    assert {tuple(r) for r in jaccard.links(df).collect()} == pairs


def test_components(spark):
    draw = random.Random(6)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1200)]
    got = {r["node"]: r["label"] for r in components.labels(spark.createDataFrame(links, "a long, b long")).collect()}
    above = {k: k for pair in links for k in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(above[a], above[b])
            changed |= above[a] != low or above[b] != low
            above[a] = above[b] = low
    assert got == {k: v for k, v in above.items() if any(k in p and p[0] != p[1] for p in links)}
