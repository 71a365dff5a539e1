"""Toxicity by a grammar of weighted finite-state transducers over the clauses of a text.

Five small transducers read the words of a clause: insults and threats emit a weight, targets, negation and reported speech
change the state in which later words are read. Their composition is one table over the states (targeted, negated,
reported): a clause is scored by the weights it emits and by the state they were emitted in, so the same word counts
otherwise in `you are ...`, `never ...` and `he said ...`. How much each reading counts is learned.

Insult and threat stems with their weights are learned from a bounded labelled sample as a prefix tree; the words of the
other transducers are fixed lists. Only clauses around a stem are read, found by one Aho-Corasick pass over the whole text.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import per_batch
from plantlake.llm.langid import held_out

#: Bound of the labelled sample: rows of each label, in expectation, and rows in all.
PER_LABEL = 2500
SAMPLE_ROWS = 6000
LENGTHS = range(3, 11)
#: Share of the learned stems that may be there by chance, and the least log odds of a stem.
FALSE_SHARE = 0.05
LEAST_ODDS = 2.5
PRIOR_ODDS = 2.0

#: Words of the fixed transducers.
THREATS = "kill hurt destroy beat shoot stab burn attack murder töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your you're yours he she they them his her their du dich dein ihr euch tu toi vous te ton usted ustedes".split()
NEGATIONS = "not never no isn't aren't wasn't don't nicht nie kein keine pas jamais nunca tampoco".split()
REPORTS = "said says wrote called quoted claimed reported sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()

WORD = regex.compile(r"[\p{L}][\p{L}'’]*")
LETTERS = regex.compile(r"\p{L}+")
BREAK = regex.compile(r"[.!?;:\n\r]")
#: Readings of an emitted weight, in the order of the features.
READINGS = ("plain", "targeted", "negated", "reported", "threat")
CLAUSE_CHARS = 400


def composed() -> dict[tuple[int, str], int]:
    """The product of the three state-changing transducers: state and word class give the next state.

    Bits of a state: 1 targeted, 2 negated, 4 reported. A negation is used up by the next emitted weight.
    """
    table = {}
    for state in range(8):
        table[state, "target"] = state | 1
        table[state, "negation"] = state | 2
        table[state, "report"] = state | 4
        table[state, "stem"] = state & ~2
        table[state, "other"] = state
    return table


NEXT = composed()
CLASS = {w: k for k, ws in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in ws}


def reading(state: int, threat: bool) -> int:
    if state & 4:
        return 3
    if state & 2:
        return 2
    if threat:
        return 4
    return 1 if state & 1 else 0


@dataclass
class Grammar:
    """Stems with weights, and the learned weights of the readings."""

    stems: dict[str, float] = field(default_factory=dict)
    threats: dict[str, float] = field(default_factory=dict)
    readings: np.ndarray = field(default_factory=lambda: np.zeros(len(READINGS) + 1))
    bias: float = -3.0
    automaton: object = None

    def __getstate__(self):
        return {**self.__dict__, "automaton": None}

    def hits(self, text: str) -> Iterator[tuple[int, float, bool]]:
        """Place, weight and kind of each word of a lower-cased text that starts with a stem or is a threat."""
        if self.automaton is None:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for stem, weight in {**self.stems, **self.threats}.items():
                self.automaton.add_word(stem, (len(stem), weight, stem in self.threats))
            self.automaton.make_automaton()
        for end, (size, weight, threat) in self.automaton.iter(text):
            begin = end + 1 - size
            if begin and text[begin - 1].isalpha():
                continue
            if threat and end + 1 < len(text) and text[end + 1].isalpha():
                continue
            yield begin, weight, threat

    def features(self, text: str | None) -> np.ndarray:
        """Of each reading the weights of the matched clauses, damped, and the share of matched clauses' words."""
        out = np.zeros(len(READINGS) + 1)
        if not text or not (self.stems or self.threats):
            return out
        text = text.lower()
        clauses: dict[tuple[int, int], dict[int, tuple[float, bool]]] = {}
        end = -1
        begin = 0
        for at, weight, threat in self.hits(text):
            if at >= end:
                begin, end = clause(text, at)
            found = clauses.setdefault((begin, end), {})
            if at not in found or weight > found[at][0]:
                found[at] = (weight, threat)
        sums = np.zeros(len(READINGS))
        for (begin, end), found in clauses.items():
            sums += self.read(text[begin:end], {at - begin: v for at, v in found.items()})
        out[: len(READINGS)] = np.log1p(sums)
        out[-1] = np.log1p(len(clauses))
        return out

    def read(self, words: str, found: dict[int, tuple[float, bool]]) -> np.ndarray:
        """Runs the composed transducer over a clause; the largest weight of each reading."""
        out, state = np.zeros(len(READINGS)), 0
        for word in WORD.finditer(words):
            hit = found.get(word.start())
            if hit is None:
                state = NEXT[state, CLASS.get(word.group(), "other")]
                continue
            where = reading(state, hit[1])
            out[where] = max(out[where], hit[0])
            state = NEXT[state, "stem"]
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.readings + self.bias, -30, 30)))


def clause(text: str, at: int) -> tuple[int, int]:
    """Begin and end of the clause around a place; a clause without breaks is read `CLAUSE_CHARS` to either side."""
    low, high = max(0, at - CLAUSE_CHARS), at + CLAUSE_CHARS
    breaks = [m.end() for m in BREAK.finditer(text, low, at)]
    after = BREAK.search(text, at, high)
    return (breaks[-1] if breaks else low), (after.start() if after else min(high, len(text)))


def chance(n_bad: int, n_all: int, share: float) -> float:
    """Chance that at least `n_bad` of `n_all` texts are toxic where each is with the probability `share`."""
    logs = math.lgamma(n_all + 1) + n_all * math.log1p(-share)
    odds = math.log(share) - math.log1p(-share)
    terms = (logs - math.lgamma(k + 1) - math.lgamma(n_all - k + 1) + k * odds for k in range(n_bad, n_all + 1))
    return min(1.0, sum(math.exp(t) for t in terms))


def learn_stems(texts: list[str], toxic: np.ndarray) -> dict[str, float]:
    """Word beginnings that stand in toxic texts more often than chance allows, with their smoothed log odds.

    Every beginning is tested against the share of toxic texts, and the chances are cut by Benjamini and Hochberg's rule: at most
    `FALSE_SHARE` of what is kept is expected to be there by chance. The rule knows no least number of texts; what a small sample
    can show it finds. Beginnings that stand in the same texts are one test, for which the longest stands.

    The least likely come first, and none is kept that begins a kept one or begins with it.
    """
    bad: Counter[str] = Counter()
    good: Counter[str] = Counter()
    for text, label in zip(texts, toxic, strict=True):
        words = set(LETTERS.findall(text.lower()))
        begins = {w[:n] for w in words for n in LENGTHS if n <= len(w)}
        (bad if label else good).update(begins)
    n_bad, n_good = int(toxic.sum()), int((~toxic).sum())
    counts = {stem: (n, good[stem]) for stem, n in bad.items()} | {stem: (0, n) for stem, n in good.items() if stem not in bad}
    # A beginning that a longer one matches in both counts says nothing more, so it is no test of its own.
    same = {stem[:-1] for stem, found in counts.items() if len(stem) - 1 in LENGTHS and counts[stem[:-1]] == found}
    share = n_bad / (n_bad + n_good)
    known: dict[tuple[int, int], float] = {}
    for found in counts.values():
        if found not in known:
            known[found] = chance(found[0], sum(found), share) if found[0] > share * sum(found) else 1.0
    chances = sorted((known[found], stem) for stem, found in counts.items() if stem not in same)
    passed = [k for k, (p, _) in enumerate(chances, 1) if p <= FALSE_SHARE * k / len(chances)]
    kept: dict[str, float] = {}
    begun: set[str] = set()
    for _, stem in chances[: max(passed, default=0)]:
        weight = np.log((bad[stem] + 0.5) / (n_bad + 1)) - np.log((good[stem] + 0.5) / (n_good + 1))
        own = {stem[:n] for n in LENGTHS if n <= len(stem)}
        if weight >= LEAST_ODDS and stem not in begun and not own & kept.keys():
            kept[stem] = float(weight)
            begun |= own
    return kept


def fit(texts: list[str], toxic: list[bool], shares: dict[bool, float] | None = None) -> Grammar:
    """A grammar from labelled texts: stems from two thirds of them, the readings' weights from all.

    `shares` says which part of the rows of either label the sample holds, so that scores are right for all rows.
    """
    label = np.array(toxic, dtype=bool)
    if not label.any() or label.all():
        return Grammar(bias=-3.0 if not label.any() else 3.0)
    first = np.arange(len(label)) % 3 != 2
    stems = learn_stems([t for t, k in zip(texts, first, strict=True) if k], label[first])
    grammar = Grammar(stems, {t: stems.pop(t, PRIOR_ODDS) for t in THREATS})
    x = np.array([grammar.features(t) for t in texts])
    weight = np.where(label, 1 / (shares or {}).get(True, 1), 1 / (shares or {}).get(False, 1))
    weight /= weight.mean()
    columns = np.c_[x, np.ones(len(x))]
    beta = np.zeros(columns.shape[1])
    ridge = np.r_[np.full(x.shape[1], 0.5), 1e-6]
    for _ in range(25):
        odds = 1 / (1 + np.exp(-np.clip(columns @ beta, -30, 30)))
        slope = columns.T @ (weight * (odds - label)) + ridge * beta
        bend = (columns * (weight * np.maximum(odds * (1 - odds), 1e-4))[:, None]).T @ columns + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    grammar.readings, grammar.bias = beta[:-1], float(beta[-1])
    return grammar


def train(df: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, most: int = SAMPLE_ROWS) -> Grammar:
    """Learns from a bounded sample of the labelled rows of `df` (doc_id, text) outside the held-out fold.

    The sample is drawn by a hash of the id within each label; its ids, at most `most`, are sent to the documents.
    An id with two different labels counts as toxic. Null labels and ids are passed by.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(5, 0))
    marked = usable.groupBy("doc_id").agg((F.max("toxic") > 0).alias("_toxic"))
    found = {r[0]: r[1] for r in marked.groupBy("_toxic").count().collect()}
    shares = {k: min(1.0, per_label / n) for k, n in found.items()}
    key = F.xxhash64("doc_id", F.lit(5))
    share: Column = F.lit(0.0)
    for value, part in shares.items():
        share = F.when(F.col("_toxic") == F.lit(value), F.lit(part)).otherwise(share)
    ids = marked.where(F.pmod(key, F.lit(1 << 30)) < share * (1 << 30)).orderBy(key).limit(most).collect()
    picked = df.sparkSession.createDataFrame([(r[0], r[1]) for r in ids], "doc_id long, _toxic boolean")
    rows = df.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
    rows = rows.select("text", "_toxic").distinct().collect()
    rows.sort(key=lambda r: (zlib.crc32(r["text"].encode()), r["_toxic"]))
    return fit([r["text"] for r in rows], [r["_toxic"] for r in rows], shares)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def scored(df: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of `df` (doc_id, text).

    A null or empty text has no clause and gets the score of a text without matches. Only the text decides, so repeated
    rows, null ids and extra columns need no rule; every row gives one row and an empty table none.
    """
    shared = df.sparkSession.sparkContext.broadcast(grammar)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = shared.value
        features = [machine.features(t.as_py()) for t in batch.column(2)]
        score = machine.scores(np.array(features).reshape(batch.num_rows, -1))
        columns = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), held_out(5, 0).alias("held_out"), "text")
    return rows.mapInArrow(per_batch(run), SCHEMA)
