"""Toxicity scoring with a weighted finite-state pattern grammar.

Words become symbols: a lexical transducer reads a word's letters through weighted
prefix and whole-word arcs and emits INSULT with the weight of the best arc, or
THREAT, TARGET, NEGATION, REPORT, OTHER.  Four small transducers rewrite the
symbols of a line and are composed into one machine:

* negation: an insult or threat within ``SCOPE`` words after a negation is negated;
* reported speech: one after a reporting verb in its clause, or in quotes, is reported;
* threat: a threat verb counts only if its clause names a target after it;
* target: an insult whose clause names a target, before or after it, is aimed.

Every match adds its arc's weight times the weight of its pattern, so a clause
counts by what it says, not by a word alone.  The arcs' weights (log ratios of
rates in toxic and other texts) and the logistic layer over a text's sums are
fitted on a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, id_crc_mod, materialize, slices, with_columns

SAMPLE_ROWS = 3000         # labelled rows of each label that the grammar is fitted on, at most
MAX_ARCS = 5000            # learned arcs, at most; those in most toxic texts come first
PREFIX = range(4, 9)       # letters of a prefix arc
LONGEST = 24               # letters of a whole-word arc, at most
LEAST_SHARE = 0.01         # of the toxic sample texts have an arc's words (five at least)
LEAST_LIFT = 4.0           # rate of an arc's words in toxic texts over that in others
LEAST_SPREAD = 3.0         # the same for the shares of texts that have them
SCOPE = 3                  # words that a negation reaches
SEED_WEIGHT = 4.0          # of a listed insult without counts
CACHE_WORDS = 200_000
PIECE = 1 << 20            # characters of a text that are cut into words at once

# The grammar's closed word lists (English, German, French, Spanish).
TARGETS = """you your yours yourself they them their he him his she her these those
du dich dir dein deine ihr euch euer sie tu toi ton ta vous votre vos ils elles tú te ti usted ustedes vosotros""".split()
NEGATIONS = "not no never nor without isn aren wasn don doesn nicht kein keine nie niemals ne pas jamais sans nunca jamás sin".split()
REPORTS = """said says say wrote writes write called calls claimed claims reported reports quoted quotes told tells according
sagte sagt schrieb nannte behauptet behauptete laut dit disait écrit appelé selon dijo dice escribió llamó según""".split()
THREATS = """kill hurt destroy beat burn shoot stab strangle crush
töten umbringen vernichten verprügeln tuer détruire frapper brûler matar destruir golpear quemar""".split()
INSULTS = """idiot idiots moron morons stupid imbecile fool loser losers scum trash garbage worthless pathetic disgusting clown clowns dumb
idiotisch dumm dummkopf trottel abschaum wertlos widerlich imbécile crétin stupide débile minable dégoûtant
idiota estúpido estúpida imbécil basura inútil patético asqueroso""".split()

# Symbols of the word classes, and of what the transducers make of them.
INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER, CLAUSE, LINE = b"IHTNRQOEL"
NEGATED, NEGATED_THREAT, REPORTED, AIMED, AIMS, ATTACK = b"ihrABX"

#: Weight of a pattern; AIMS (a target after an insult) and ATTACK have no arc of their own.
PATTERNS = {INSULT: ("insult", 1.0), AIMED: ("aimed", 1.25), NEGATED: ("negated", 0.25), REPORTED: ("reported", 0.4),
            AIMS: ("aims", 0.25), ATTACK: ("threat", 1.0)}
_ARCLESS = {AIMS: SEED_WEIGHT, ATTACK: SEED_WEIGHT}

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:…\n\"“”„«»]")
_MARKS = dict.fromkeys('"“”„«»', QUOTE) | dict.fromkeys(".!?;:…", CLAUSE) | {"\n": LINE}


# ---- transducers ---------------------------------------------------------------

class Transducer(NamedTuple):
    """Letter-to-letter: (state, symbol) -> (next state, symbol).  A symbol that a
    state does not list passes unchanged and keeps the state."""
    arcs: dict[tuple[int, int], tuple[int, int]]

    def step(self, state, symbol: int) -> tuple:
        return self.arcs.get((state, symbol), (state, symbol))


def compose(first: Transducer, second: Transducer, alphabet: bytes) -> Transducer:
    """One machine that feeds the output of ``first`` to ``second``; its states are
    numbered from 0, the start of both."""
    number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        for symbol in alphabet:
            a2, middle = first.step(a, symbol)
            b2, out = second.step(b, middle)
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            arcs[number[a, b], symbol] = (number[a2, b2], out)
    return Transducer(arcs)


def negation() -> Transducer:
    """State: words that the last negation still reaches."""
    arcs = {}
    for left in range(SCOPE + 1):
        arcs[left, NEGATION] = (SCOPE, NEGATION)
        arcs[left, CLAUSE], arcs[left, LINE] = (0, CLAUSE), (0, LINE)
        for symbol in (INSULT, THREAT, TARGET, REPORT, OTHER):
            changed = {INSULT: NEGATED, THREAT: NEGATED_THREAT}.get(symbol, symbol) if left else symbol
            arcs[left, symbol] = (max(left - 1, 0), changed)
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """States: 0 plain, 1 after a reporting verb, 2 in quotes."""
    arcs = {(0, REPORT): (1, REPORT), (1, CLAUSE): (0, CLAUSE),
            (0, QUOTE): (2, QUOTE), (1, QUOTE): (2, QUOTE), (2, QUOTE): (0, QUOTE)}
    for state in range(3):
        arcs[state, LINE] = (0, LINE)
        if state:
            arcs[state, INSULT], arcs[state, THREAT] = (state, REPORTED), (state, OTHER)
    return Transducer(arcs)


def threats() -> Transducer:
    """State 1: a threat verb waits for its target."""
    return Transducer({(0, THREAT): (1, OTHER), (1, THREAT): (1, OTHER), (1, TARGET): (0, ATTACK),
                       (1, CLAUSE): (0, CLAUSE), (1, LINE): (0, LINE),
                       (0, NEGATED_THREAT): (0, OTHER), (1, NEGATED_THREAT): (1, OTHER)})


def targets() -> Transducer:
    """States: 1 a target was named, 2 an insult waits for one."""
    arcs = {(0, TARGET): (1, TARGET), (0, ATTACK): (1, ATTACK), (0, INSULT): (2, INSULT),
            (1, INSULT): (1, AIMED), (2, TARGET): (1, AIMS), (2, ATTACK): (1, ATTACK)}
    for state in (1, 2):
        arcs[state, CLAUSE], arcs[state, LINE] = (0, CLAUSE), (0, LINE)
    return Transducer(arcs)


def grammar() -> Transducer:
    alphabet = bytes((INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER, CLAUSE, LINE))
    machine = negation()
    for following in (reported_speech(), threats(), targets()):
        machine = compose(machine, following, alphabet)
    return machine


# ---- lexical transducer --------------------------------------------------------

def arcs_of(word: str) -> list[str]:
    """The arcs that accept a word: its prefixes, and the whole word (marked)."""
    found = [word[:k] for k in PREFIX if k <= len(word)]
    if len(word) <= LONGEST:
        found.append(word + "$")
    return found


class Lexicon(dict):
    """Word -> (symbol, weight); words are looked up by their arcs once."""

    def __init__(self, arcs: dict[str, float]):
        super().__init__()
        self.arcs = {w + "$": SEED_WEIGHT for w in INSULTS} | arcs
        self.closed = {w: s for words, s in ((REPORTS, REPORT), (THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION))
                       for w in words} | _MARKS

    def __missing__(self, word: str) -> tuple[int, float]:
        weight = max((self.arcs.get(a, 0.0) for a in arcs_of(word)), default=0.0)
        found = (INSULT, weight) if weight > 0 else (self.closed.get(word, OTHER), 0.0)
        if len(self) < CACHE_WORDS:
            self[word] = found
        return found


def pieces(text: str) -> Iterator[str]:
    """The text in parts of about ``PIECE`` characters, cut at spaces only."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = re.compile(r"\s").search(text, end)
            end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


class Matches(NamedTuple):
    words: int
    found: list[tuple[int, int, float]]     # (token number, pattern, weight)


class Grammar:
    def __init__(self, arcs: dict[str, float]):
        self.lexicon = Lexicon(arcs)
        self.machine = grammar()

    def match(self, text: str) -> Matches:
        """Lines without an insult or threat are passed over by their symbols."""
        parts, weights, tokens = [], {}, 0
        for piece in pieces(text):
            found = [self.lexicon[w] for w in _TOKEN.findall(piece.lower())]
            parts.append(bytes([s for s, _ in found]))
            if INSULT in parts[-1]:
                weights |= {tokens + k: w for k, (s, w) in enumerate(found) if s == INSULT}
            tokens += len(found)
        symbols = b"".join(parts)
        marks = symbols.count(QUOTE) + symbols.count(CLAUSE) + symbols.count(LINE)
        out, start, step = [], 0, self.machine.step
        if INSULT in symbols or THREAT in symbols:
            for line in symbols.split(bytes((LINE,))):
                if INSULT in line or THREAT in line:
                    state = 0
                    for k, symbol in enumerate(line, start):
                        state, made = step(state, symbol)
                        if made in PATTERNS:
                            out.append((k, made, PATTERNS[made][1] * weights.get(k, _ARCLESS.get(made, 0.0))))
                start += len(line) + 1
        return Matches(tokens - marks, out)

    def features(self, text: str) -> tuple[Matches, list[float]]:
        found = self.match(text)
        n = max(found.words, 1)
        count = sum(PATTERNS[p][1] for _, p, _ in found.found)
        mass = sum(w for _, _, w in found.found)
        return found, [math.log1p(count), min(100 * mass / n, 20.0), math.log1p(mass), math.log(n + 10),
                       mass / math.sqrt(n), math.log1p(100 * mass / n)]


# ---- fitting -------------------------------------------------------------------

class Logistic(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray        # the last one is the bias

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Logistic:
    """Weighted logistic regression with a small ridge, by Newton's method."""
    mean, scale = np.average(x, axis=0, weights=w), x.std(axis=0) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    beta = np.zeros(a.shape[1])
    w = w * len(w) / w.sum()
    ridge = np.diag([1e-2] * (len(beta) - 1) + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge, a.T @ (w * (p - y)) + ridge @ beta)
        beta -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, beta)


def _decoded(batch: pa.RecordBatch) -> list[str]:
    return [t.decode("utf-8", "replace") for t in byte_texts(batch)]


def sample_texts(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[bool, int]]:
    """(text, toxic) of at most ``SAMPLE_ROWS`` labelled ids of each label, those
    with the smallest hashes, equal texts once; and the labelled ids of each label.
    The chosen ids are few, so they are broadcast and only their texts travel."""
    marks = labels.where("id is not null and toxic is not null").groupBy("id").agg((F.max("toxic") == 1).alias("toxic"))
    total = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in (True, False):
        part = marks.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
        chosen = part if chosen is None else chosen.union(part)
    found = docs.join(F.broadcast(chosen), "id").select("text", "toxic")
    return materialize(found.dropDuplicates(["text", "toxic"]), "toxicity-sample"), total


def learned_arcs(sample: DataFrame) -> dict[str, float]:
    """Weights of the arcs whose words mark toxic texts, and of all listed insults
    that occur: the log ratio of the words' rates in toxic texts and in others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^\W\d_]+")
        for b in (part for batch in batches for part in slices(batch, 100)):
            rows: dict[tuple, list[int]] = {}
            for text, toxic in zip(_decoded(b), b.column("toxic").to_pylist()):
                n: Counter = Counter()
                for w, k in Counter(word.findall(text.lower())).items():
                    n[""] += k
                    for a in arcs_of(w):
                        n[a] += k
                for a, k in n.items():
                    row = rows.setdefault((a, toxic), [0, 0])
                    row[0] += 1
                    row[1] += k
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.bool_()),
                pa.array([v[0] for v in rows.values()], pa.int64()), pa.array([v[1] for v in rows.values()], pa.int64())],
                names=["arc", "toxic", "texts", "words"])

    def of(label: bool, name: str) -> Column:
        return F.sum(F.when(F.col("toxic") == label, F.col(name)).otherwise(0))

    stats = sample.mapInArrow(run, "arc string, toxic boolean, texts long, words long").groupBy("arc").agg(
        of(True, "texts").alias("t1"), of(False, "texts").alias("t0"), of(True, "words").alias("w1"), of(False, "words").alias("w0"))
    stats = materialize(stats, "toxicity-arcs")
    texts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    whole = stats.where("arc = ''").first()
    if whole is None or not whole["w1"] or not whole["w0"]:
        return {}
    lift = F.log((F.col("w1") + 0.5) * float(whole["w0"]) / ((F.col("w0") + 0.5) * float(whole["w1"])))
    known = stats.where("arc <> ''").withColumn("weight", lift)
    marked = known.where((F.col("t1") >= max(5.0, LEAST_SHARE * texts[True])) & (F.col("weight") >= math.log(LEAST_LIFT))
                         & (F.col("t1") * texts[False] > F.col("t0") * LEAST_SPREAD * texts[True]))
    top = marked.orderBy(F.desc("t1"), "arc").limit(MAX_ARCS)
    listed = known.where(F.col("arc").isin([w + "$" for w in INSULTS]) & (F.col("t1") + F.col("t0") >= 5))
    return {r["arc"]: r["weight"] for r in (*listed.select("arc", "weight").collect(), *top.select("arc", "weight").collect())}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], Logistic | None]:
    """Arcs and logistic layer from (id, text) and (id, toxic) rows; no layer if a label is missing."""
    sample, total = sample_texts(docs, labels)
    arcs = learned_arcs(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Grammar(arcs)
        for b in (part for batch in batches for part in slices(batch, 100)):
            yield with_columns(b, ["toxic"], x=pa.array([rules.features(t)[1] for t in _decoded(b)], pa.list_(pa.float64())))

    # at most twice SAMPLE_ROWS rows of six numbers
    rows = sorted((r["toxic"], r["x"]) for r in sample.mapInArrow(run, "toxic boolean, x array<double>").collect())
    y = np.array([r[0] for r in rows], float)
    if not rows or y.min() == y.max():
        return arcs, None
    # a label's sampled texts stand for all its labelled ids
    w = np.where(y == 1, total[True] / y.sum(), total[False] / (len(y) - y.sum()))
    return arcs, fit_logistic(np.array([r[1] for r in rows]), y, w)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> DataFrame:
    """One row per document row: id, score (0 to 1), predicted (1 if score >= 0.5),
    n_words, and matches: (token number, pattern, weight) of what the grammar found.

    ``learn`` selects the rows of ``labels`` to learn from, by their columns.  A NULL
    id or label teaches nothing; of several labels of an id the largest counts;
    repeated rows are scored one by one.  NULL and empty texts have no match and
    the score of a text without one.  Without labelled rows of both kinds the
    listed words alone decide: the score is the matches' weight w a hundred words
    as w / (w + 5).  Texts of any length are read whole, in pieces.  An empty
    table gives no rows.  Other columns of both tables are ignored.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = labels.where(learn).select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic"))
    arcs, layer = fit(src, marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Grammar(arcs)
        kind = pa.list_(pa.struct([("token", pa.int64()), ("pattern", pa.string()), ("weight", pa.float64())]))
        for b in (part for batch in batches for part in slices(batch, 200)):
            found = [rules.features(t) for t in _decoded(b)]
            x = np.array([f for _, f in found]).reshape(len(found), -1)
            score = layer.score(x) if layer else x[:, 1] / (x[:, 1] + 5)
            yield with_columns(
                b, ["id"], score=pa.array(score, pa.float64()), predicted=pa.array((score >= 0.5).astype(np.int32)),
                n_words=pa.array([m.words for m, _ in found], pa.int64()),
                matches=pa.array([[{"token": k, "pattern": PATTERNS[p][0], "weight": w} for k, p, w in m.found] for m, _ in found], kind))

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {id_type}, score double, predicted int, n_words long, "
                               "matches array<struct<token:bigint,pattern:string,weight:double>>")


def held_out(id_col: Column) -> Column:
    """Rows whose labels the query never learns from."""
    return id_crc_mod(id_col, 5) == 0
