"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, report, other) through a
lexical acceptor: a trie of whole words and of stems that longer words begin with.
Small sequential transducers then rewrite the symbols of a clause:

    negation: insults and threats within three words after a negator weigh less
    reported speech: those after a reporting verb in the clause weigh less
    target: those that meet a target word in the clause weigh more
    threat: counts in full only together with a target

They are composed into one transducer, whose run over a clause gives its score;
a run from right to left goes first and marks insults and threats that a target
follows, so that a target counts on either side (a threat weighs in full before
its target, and by the target rule a little more after it). Words outside a
matching clause score nothing. A text's evidence is the sum, over
the distinct lexicon entries it uses, of the entry's best clause score; a logistic
curve turns evidence into a score.

Entry weights (smoothed log-odds of a text being toxic) and the curve are learned (entries are whole words and stems of 3 to 10 letters)
from labelled rows: those whose crc32(doc_id as text) mod 4 isn't 2, and of them a
bounded sample in hash order, MAX_POSITIVE toxic and MAX_NEGATIVE other rows. Only
the text is an input of a score.

Rules for odd input: a null text is empty; texts without a match all get the same
low score; null or missing labels are not learned from; a doc_id with several
labels counts once, as its greatest label; without any labelled rows the seed words
keep a default weight.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MAX_POSITIVE, MAX_NEGATIVE = 3000, 6000
#: The words of the symbols other than learned insults.
SEEDS = "idiot idiots moron morons stupid scum trash worthless pathetic disgusting loser losers vermin imbecile bastard dumb idiota imbécil basura estúpido idiotin dummkopf abschaum crétin ordure stupide".split()
THREATS = "kill hurt destroy murder stab shoot beat burn töten umbringen tuer matar".split()
TARGETS = "you your yours you're u ur du dich dir deine ihr euch tu toi te vous ton tú ti usted ustedes vosotros".split()
NEGATORS = "not never no none neither nor isn't aren't wasn't don't nicht kein keine nie ne pas jamais nunca jamás tampoco".split()
REPORTS = "said says say called calls calling wrote writes told claimed quoted sagte nannte schrieb dit appelle écrit dijo llamó escribió".split()
LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
CLAUSE = re.compile(r"[.!?;:\n]+")
OTHER, INSULT, THREAT, TARGET, NEGATOR, REPORT = "other", "insult", "threat", "target", "negator", "report"
#: Insults and threats that a target follows in the clause.
AIMED_INSULT, AIMED_THREAT = "aimed insult", "aimed threat"
STEM_MIN, STEM_MAX = 3, 10


class Transducer:
    """Sequential weighted transducer: arcs[(state, symbol)] = (next state, symbol out, log weight); a missing arc keeps state and symbol.

    `fallback` gives the state reached on any symbol without an arc, where it isn't the same.
    """

    def __init__(self, start, arcs: dict, fallback: dict | None = None):
        self.start, self.arcs, self.fallback = start, arcs, fallback or {}

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (self.fallback.get(state, state), symbol, 0.0)


def compose(a: Transducer, b: Transducer, symbols: Iterable[str]) -> Transducer:
    """The transducer that runs a and then b on a's output; its weights are products (sums of logs)."""
    arcs, start = {}, (a.start, b.start)
    todo, seen = [start], {start}
    while todo:
        state = todo.pop()
        for s in symbols:
            x, mid, u = a.step(state[0], s)
            y, out, v = b.step(state[1], mid)
            arcs[state, s] = ((x, y), out, u + v)
            if (x, y) not in seen:
                seen.add((x, y))
                todo.append((x, y))
    return Transducer(start, arcs)


def grammar() -> Transducer:
    """The composed transducer over the six symbols and the two that AHEAD makes."""
    less, half, more = math.log(0.25), math.log(0.6), math.log(1.3)
    hits = (INSULT, THREAT, AIMED_INSULT, AIMED_THREAT)
    negation = Transducer(0, {(s, NEGATOR): (3, NEGATOR, 0.0) for s in range(4)} | {(s, h): (0, h, less) for s in (1, 2, 3) for h in hits}, {s: max(0, s - 1) for s in range(4)})
    report = Transducer(0, {(0, REPORT): (1, REPORT, 0.0)} | {(1, h): (1, h, half) for h in hits})
    target = Transducer(0, {(0, TARGET): (1, TARGET, 0.0), (0, AIMED_INSULT): (0, INSULT, more), (1, AIMED_INSULT): (1, INSULT, more)} | {(1, h): (1, h, more) for h in hits if h != AIMED_INSULT})
    threat = Transducer(0, {(s, THREAT): (1, THREAT, 0.0 if s == 2 else math.log(0.1)) for s in (0, 1)} | {(s, TARGET): (2, TARGET, 0.0) for s in (0, 1)} | {(2, THREAT): (2, THREAT, 0.0)} | {(s, AIMED_THREAT): (max(s, 1), THREAT, 0.0) for s in (0, 1, 2)})
    symbols = (OTHER, INSULT, THREAT, TARGET, NEGATOR, REPORT, AIMED_INSULT, AIMED_THREAT)
    out = negation
    for t in (report, target, threat):
        out = compose(out, t, symbols)
    return out


#: Runs over a clause from right to left.
AHEAD = Transducer(0, {(0, TARGET): (1, TARGET, 0.0), (1, INSULT): (1, AIMED_INSULT, 0.0), (1, THREAT): (1, AIMED_THREAT, 0.0)})


class Lexicon:
    """Trie lookups by dictionaries: the longest entry wins, a whole word before any stem."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.lengths = sorted({len(s) for s in stems}, reverse=True)
        self.starts = {w[:STEM_MIN] for w in (*words, *stems, *THREATS)}
        self.plain = {w: TARGET for w in TARGETS} | {w: NEGATOR for w in NEGATORS} | {w: REPORT for w in REPORTS}
        self.threats = frozenset(THREATS)

    def entry(self, word: str) -> str | None:
        """The insult entry a word matches: 'w:' and the word, or 'p:' and a stem shorter than the word."""
        if word in self.words:
            return f"w:{word}"
        for n in self.lengths:
            if n < len(word) and word[:n] in self.stems:
                return f"p:{word[:n]}"
        return None

    def weight(self, entry: str) -> float:
        return (self.words if entry[0] == "w" else self.stems)[entry[2:]]

    def cues(self, text: str) -> bool:
        """Whether any word of lower-cased text is an insult or a threat."""
        for w in {w for w in LETTERS.findall(text) if w[:STEM_MIN] in self.starts}:
            if w in self.threats or self.entry(w):
                return True
        return False


THREAT_WEIGHT = 3.0


def evidence(text: str, lexicon: Lexicon, rules: Transducer) -> float:
    """Sum over entries of their best clause score."""
    text = text.lower()
    if not lexicon.cues(text):
        return 0.0
    best: dict[str, float] = defaultdict(float)
    for clause in CLAUSE.split(text):
        words = [w for w in LETTERS.findall(clause)]
        hit = [lexicon.entry(w) if w[:STEM_MIN] in lexicon.starts else None for w in words]
        if not any(hit) and lexicon.threats.isdisjoint(words):
            continue
        symbols = [INSULT if e else THREAT if w in lexicon.threats else lexicon.plain.get(w, OTHER) for w, e in zip(words, hit, strict=True)]
        state = AHEAD.start
        for i in reversed(range(len(symbols))):
            state, symbols[i], _ = AHEAD.step(state, symbols[i])
        state, aim = rules.start, []
        for w, e, symbol in zip(words, hit, symbols, strict=True):
            state, out, log = rules.step(state, symbol)
            if out == INSULT:
                aim.append((e, lexicon.weight(e) * math.exp(log)))
            elif out == THREAT:
                aim.append((f"t:{w}", THREAT_WEIGHT * math.exp(log)))
        for e, x in aim:
            best[e] = max(best[e], x)
    return sum(best.values())


def _features(text: str) -> set[str]:
    out = set()
    for w in set(LETTERS.findall(text.lower())):
        out.add(f"w:{w}")
        for n in range(STEM_MIN, min(STEM_MAX, len(w) - 1) + 1):
            out.add(f"p:{w[:n]}")
    return out


def _odds(pos: float, neg: float, n1: float, n0: float) -> float:
    return math.log((pos + 0.5) / (n1 + 1.0)) - math.log((neg + 0.5) / (n0 + 1.0))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, half) of the rows that are learned from; at most MAX_POSITIVE + MAX_NEGATIVE labels."""
    y = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter("id IS NOT NULL AND toxic IN (0, 1)")
    y = y.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64(F.lit("sample"), "id"))
    ids = [y.filter(F.col("toxic") == k).orderBy("h", "id").limit(n) for k, n in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    picked = ids[0].unionByName(ids[1]).withColumn("half", F.pmod("h", F.lit(2)).cast("int"))
    text = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    rows = text.join(F.broadcast(picked), "id")  # at most 9,000 ids are broadcast
    first = rows.withColumn("sign", F.arrow_udf(_sign, "long")(F.col("text"))).groupBy("sign", "toxic").agg(F.min(F.struct("id", "text", "half")).alias("s"))
    return first.select("s.text", "toxic", "s.half")


def _sign(texts: pa.Array) -> pa.Array:
    """A value that near copies mostly share: a hash of the three least hashes of a text's long words, of the whole text if it has fewer than three.

    Learning counts a group of copies once; else each word of a much-copied text would look like a mark of its label.
    """
    out = []
    for t in texts.to_pylist():
        words = {w for w in LETTERS.findall((t or "").lower()) if len(w) >= 7}
        least = sorted(xxhash.xxh64_intdigest(w.encode()) for w in words)[:3]
        out.append(xxhash.xxh64_intdigest(repr(least if len(least) == 3 else t).encode()) >> 1)
    return pa.array(out, pa.int64())


def _counts(rows: DataFrame, of) -> dict[str, list[int]]:
    """entry: texts with it, as [other half 0, other half 1, toxic half 0, toxic half 1]."""
    parts = rows.mapInArrow(of, "f string, k int, n long").groupBy("f", "k").agg(F.sum("n").alias("n"))
    out: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    for f, k, n in parts.collect():
        out[f][k] = n
    return dict(out)


def _counter(entries):
    """A mapInArrow function that counts entries(text) by toxic and half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            text, toxic, half = (b.column(i).to_pylist() for i in range(3))
            for t, y, h in zip(text, toxic, half, strict=True):
                seen.update((f, 2 * y + h) for f in entries(t or ""))
        f, k = zip(*seen, strict=True) if seen else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(k, pa.int32()), pa.array(seen.values(), pa.int64())], names=["f", "k", "n"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon, float, float]:
    """The lexicon with its weights, and the curve's intercept and slope."""
    spark = common.session(docs)
    rows = common.written(sample(docs, labels), "toxic-sample", 4)
    n = {(r.toxic, r.half): r["count"] for r in rows.groupBy("toxic", "half").count().collect()}
    n1, n0 = (sum(n.get((y, h), 0) for h in (0, 1)) for y in (1, 0))
    if not n1 or not n0:
        return Lexicon(dict.fromkeys(SEEDS, 4.0), {}), -3.0, 1.0
    support = max(3, n1 // 150)
    common_in_toxic = rows.filter("toxic = 1").mapInArrow(_counter(_features), "f string, k int, n long").groupBy("f").agg(F.sum("n").alias("n")).filter(F.col("n") >= support)
    wanted = frozenset(r.f for r in common_in_toxic.collect())  # each is in 1/150 of the toxic texts, so their number has a bound
    counts = _counts(rows, _counter(lambda t: _features(t) & wanted))
    del wanted

    odds = {f: _odds(c[2] + c[3], c[0] + c[1], n1, n0) for f, c in counts.items()}
    gain = {f: odds[f] * (counts[f][2] + counts[f][3]) for f in odds if odds[f] >= 2.5 and len(f) > 2}
    chosen: dict[str, float] = {}
    for f in sorted(gain, key=lambda f: (-gain[f], -len(f), f)):
        if f[0] == "p" and any(g[2:].startswith(f[2:]) and sum(counts[g][2:]) >= 0.9 * sum(counts[f][2:]) for g in chosen):
            continue  # a longer entry says the same
        above = [odds[g] for k in range(STEM_MIN, len(f) - 1) if (g := f"p:{f[2:2 + k]}") in chosen]
        if not above or odds[f] > max(above) + 0.7:
            chosen[f] = odds[f]
    for w in SEEDS:
        chosen.setdefault(f"w:{w}", 1.0)

    def lexicon(weights: dict[str, float]) -> Lexicon:
        return Lexicon({f[2:]: w for f, w in weights.items() if f[0] == "w"}, {f[2:]: w for f, w in weights.items() if f[0] == "p"})

    whole = lexicon(chosen)

    def exclusive(text: str) -> set[str]:  # by the longest entry only, as scoring does
        words = {w for w in LETTERS.findall(text.lower()) if w[:STEM_MIN] in whole.starts}
        return {e for w in words if (e := whole.entry(w))}

    own = _counts(rows, _counter(exclusive))
    seeds = {f"w:{w}" for w in SEEDS}
    weights, by_half = {}, ({}, {})
    for f in chosen:
        c = own.get(f, [0, 0, 0, 0])
        prior = 2.0 if f in seeds else 0.0
        w = _odds(c[2] + c[3] + prior, c[0] + c[1], n1, n0)
        if f in seeds or c[2] + c[3] >= 2 and w >= 2.0:
            weights[f] = max(w, 0.5)
            for h in (0, 1):  # weights for half h are learned from the other half
                by_half[h][f] = max(0.0, _odds(c[3 - h] + prior / 2, c[1 - h], n.get((1, 1 - h), 0), n.get((0, 1 - h), 0)))
    halves = [lexicon(by_half[h]) for h in (0, 1)]
    rules = grammar()

    def score(batches):
        for b in batches:
            text, toxic, half = (b.column(i).to_pylist() for i in range(3))
            xs = [evidence(t or "", halves[h], rules) for t, h in zip(text, half, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.float64()), pa.array(toxic, pa.int32())], names=["x", "y"])

    points = [(min(r.x, 30.0), r.y) for r in rows.mapInArrow(score, "x double, y int").collect()]  # at most 9,000
    a, b = _logistic(points, n1, n0)
    return lexicon(weights), a, b


def _logistic(points: list[tuple[float, int]], n1: int, n0: int, ridge: float = 0.05) -> tuple[float, float]:
    """Intercept and slope by damped Newton steps; both classes weigh as they occur."""
    a, b = math.log((n1 + 1) / (n0 + 1)), 0.3
    for _ in range(60):
        ga = gb = haa = hab = hbb = 0.0
        for x, y in points:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x))))
            g, h = y - p, max(p * (1 - p), 1e-9)
            ga, gb, haa, hab, hbb = ga + g, gb + g * x, haa + h, hab + h * x, hbb + h * x * x
        ga, gb, haa, hbb = ga - ridge * a, gb - ridge * b, haa + ridge, hbb + ridge
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        scale = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a + scale * da, max(0.05, b + scale * db)
        if max(abs(da), abs(db)) < 1e-8:
            break
    return a, b


def scores(text: Column, model: tuple[Lexicon, float, float]) -> Column:
    lexicon, a, b = model
    rules = grammar()

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * min(evidence(t or "", lexicon, rules), 30.0))))) for t in texts.to_pylist()], pa.float64())

    return run(text.cast("string"))


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of documents."""
    model = learn(docs, labels)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score under the threshold, with the columns of docs."""
    (s,) = common.hidden(docs, "score")
    return docs.withColumn(s, scores(F.col("text"), learn(docs, labels))).filter(F.col(s) < threshold).drop(s)
