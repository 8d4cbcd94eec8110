"""Language-model scoring with a hashed maximum-entropy model.

P(token | context) = P(class | context) * P(token | class, context).  The most
frequent training tokens form classes of ``SLOTS`` tokens; all other tokens fall
in classes by a hash of their ending.  The class softmax, and the softmax over
the tokens of a frequent class, are maximum-entropy models over three hashed
context features: the previous word, the word before it (a skip feature) and
both (an n-gram).  Inside a class of rare tokens the distribution is the
smoothed training frequency, the maximum-entropy solution without features.

Token counts cover all training documents and stay a table.  Training runs in
rounds over disjoint slices of the training documents: every partition runs
gradient updates from the weights merged so far, and a row's updates are merged
over the partitions that saw the row.  Texts are scored in sparse numpy batches; counts of words outside a bounded dictionary of
frequent words are joined in, never broadcast.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, id_crc_mod, materialize, slices, with_columns

END = b""                  # the end token; words are never empty
SLOTS = 32                 # tokens of a frequent class
FREQUENT = 512             # tokens in frequent classes
RARE_CLASSES = 16
DICTIONARY = 200_000       # most frequent words whose counts every task holds
DICTIONARY_BYTES = 64      # longer words are never in it
CODES = 1024               # hashed endings that stand for rare words as context
PAIR_ROWS = 1 << 14        # hashed rows of the n-gram feature (all rows fit 16 bits)
IN_ROWS = 1 << 15          # hashed (feature, class) rows of the within-class softmax
STEP = 4096                # tokens of one gradient step
RATE = 0.5
ROUNDS = (5, 25)           # percent of the training texts after which the partitions' updates are merged
SETTLED = 1000             # sightings of a row from which on more of them only average it
FARTHEST = 8.0             # most that a round moves a weight
BLOCK_ROWS = 512           # model rows that travel together
_FLUSH = 200_000


def tokens_of(text: bytes) -> list[bytes]:
    """Words of the text with A-Z lowered, then the end token."""
    words = text.lower().split()
    words.append(END)
    return words


_PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())


def ending(word: bytes) -> int:
    """Hash of a word's last two letters (bytes), without trailing punctuation."""
    return zlib.crc32(word.rstrip(_PUNCTUATION)[-2:])


# ---- counts --------------------------------------------------------------------

def token_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(token, c) over all rows; hot tokens are summed inside the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(n):
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())],
                                              names=["token", "n"])
        n: Counter = Counter()
        for t in (t for batch in batches for b in slices(batch, 500) for t in byte_texts(b)):
            n.update(tokens_of(t))
            if len(n) > _FLUSH:
                yield out(n)
                n = Counter()
        yield out(n)

    partial = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "token binary, n long")
    return partial.groupBy("token").agg(F.sum("n").alias("c"))


def frequent_words(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts, most frequent first: at most
    ``DICTIONARY``, none longer than ``DICTIONARY_BYTES``.

    Words are binned by the logarithm of their count; the bins from the top that
    hold at most so many words are collected, so no task and no sort gathers
    more than what is returned."""
    able = counts.where(f"length(token) between 1 and {DICTIONARY_BYTES}").withColumn("bin", F.floor(F.log2("c") * 64))
    least, room = None, DICTIONARY
    for r in able.groupBy("bin").count().orderBy(F.desc("bin")).collect():      # at most 64 * 64 bins
        if r["count"] > room:
            break
        least, room = r["bin"], room - r["count"]
    if least is None:
        return []
    found = able.where(F.col("bin") >= least).select("token", "c").collect()
    return sorted(((bytes(r[0]), r[1]) for r in found), key=lambda x: (-x[1], x[0]))


class Lexicon:
    """Frequent words with counts, the classes, and the total counts."""

    def __init__(self, top: list[tuple[bytes, int]], total: int, distinct: int, rare_mass: dict[int, int], end_count: int):
        top = [(END, end_count)] + [x for x in top if x[0] != END]
        self.index = {w: k for k, (w, _) in enumerate(top)}
        self.counts = np.array([c for _, c in top], np.int64)
        self.logs = np.log10(self.counts + 1.0)
        self.total, self.distinct = total, distinct
        self.frequent = min(FREQUENT, len(top))
        self.classes = -(-self.frequent // SLOTS)
        self.all_classes = self.classes + RARE_CLASSES
        ends = np.array([ending(w) for w, _ in top], np.int64)
        k = np.arange(len(top))
        self.cls = np.where(k < self.frequent, k // SLOTS, self.classes + ends % RARE_CLASSES)
        self.code = np.where(k < self.frequent, k, FREQUENT + ends % CODES)
        # words of each rare class: counts plus one each, and one for the unknown word
        self.rare_mass = np.array([rare_mass.get(r, 0) + 1 for r in range(RARE_CLASSES)], np.float64)

    def context_rows(self, code: np.ndarray) -> np.ndarray:
        """Feature rows (3 x tokens) of a code sequence; a start code precedes it."""
        start = FREQUENT + CODES
        one = np.concatenate(([start], code[:-1])) if len(code) else code
        two = np.concatenate(([start], one[:-1])) if len(code) else code
        width = FREQUENT + CODES + 1
        pair = (two * 1000003 ^ one * 7919) % PAIR_ROWS
        return np.stack([one, width + two, 2 * width + pair])

    @property
    def class_rows(self) -> int:
        return 2 * (FREQUENT + CODES + 1) + PAIR_ROWS


def read_text(text: bytes, lex: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(dictionary index or -1, class, code) per token, and the words outside."""
    tokens = tokens_of(text)
    idx = np.fromiter(map(lex.index.get, tokens, repeat(-1)), np.int64, len(tokens))
    out = np.flatnonzero(idx < 0)
    cls, code = lex.cls[idx], lex.code[idx]
    words = [tokens[k] for k in out.tolist()]
    if words:
        ends = np.fromiter(map(ending, words), np.int64, len(words))
        cls[out] = lex.classes + ends % RARE_CLASSES
        code[out] = FREQUENT + ends % CODES
    return idx, cls, code, words


# ---- model ---------------------------------------------------------------------

class Weights:
    """Class matrix and bias, within-class matrix and bias (float32)."""

    def __init__(self, lex: Lexicon):
        self.a = np.zeros((lex.class_rows, lex.all_classes), np.float32)
        self.b = np.zeros((IN_ROWS, SLOTS), np.float32)
        slots = np.full(lex.classes * SLOTS, -30.0)          # slots without a token
        slots[:lex.frequent] = np.log(np.maximum(lex.counts[:lex.frequent], 0.5))
        slots = slots.reshape(lex.classes, SLOTS)
        mass = np.exp(slots).sum(axis=1)
        self.in_bias = (slots - np.log(mass)[:, None]).astype(np.float32)
        mass = np.concatenate([mass, lex.rare_mass])
        self.bias = np.log(mass / mass.sum()).astype(np.float32)

    def class_weights(self, rows: np.ndarray) -> np.ndarray:
        """exp of the class logits: rows of unnormalized probabilities."""
        return _exp_sum(self.a, rows, self.bias)

    def in_weights(self, rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """exp of the logits of the tokens of each row's class."""
        return _exp_sum(self.b, rows, np.take(self.in_bias, cls, axis=0))


def _exp_sum(matrix: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """exp(sum of the three feature rows + bias); biases are log shares, a step
    moves a weight by less than the rate and a round's merge by at most
    ``FARTHEST``, so nothing overflows."""
    z = np.take(matrix, rows[0], axis=0)
    z += np.take(matrix, rows[1], axis=0)
    z += np.take(matrix, rows[2], axis=0)
    z += bias
    return np.exp(z, out=z)


def in_rows(rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
    return (rows * 31 + cls * 1000003) % IN_ROWS


def _row_sums(z: np.ndarray) -> np.ndarray:
    return z @ np.ones(z.shape[1], z.dtype)


def _descend(matrix: np.ndarray, rows: np.ndarray, z: np.ndarray, target: np.ndarray, rate: float, seen: np.ndarray) -> None:
    """One gradient step of a softmax whose logits are sums of matrix rows; rows
    that recur move by their mean gradient, slower the more often seen."""
    z /= _row_sums(z)[:, None]
    z[np.arange(len(z)), target] -= 1
    columns = np.arange(z.shape[1])
    for r in rows:
        at, own, n = np.unique(r.astype(np.uint16), return_inverse=True, return_counts=True)
        cell = (own[:, None] * len(columns) + columns).ravel()
        g = np.bincount(cell, weights=z.ravel(), minlength=len(at) * len(columns)).reshape(len(at), -1)
        seen[at] += n
        g *= (rate / np.sqrt(n * seen[at] + 1.0))[:, None]
        matrix[at] -= g.astype(np.float32)


def train_step(w: Weights, lex: Lexicon, idx, cls, rows, seen_a, seen_b, rate=RATE) -> None:
    _descend(w.a, rows, w.class_weights(rows), cls, rate, seen_a)
    at = np.flatnonzero((idx >= 0) & (idx < lex.frequent))
    if len(at):
        c = cls[at]
        r = in_rows(rows[:, at], c)
        _descend(w.b, r, w.in_weights(r, c), idx[at] % SLOTS, rate, seen_b)


def train(docs: DataFrame, text_col: str, lex: Lexicon) -> Weights:
    """Rounds of gradient updates over disjoint slices of the documents; each
    round starts in every partition from the weights that the last one merged.

    A slice is dealt by a hash of the text, so it does not follow the layout."""
    w = Weights(lex)
    seen = {"a": np.zeros(len(w.a)), "b": np.zeros(len(w.b))}
    part = F.pmod(F.xxhash64("text"), F.lit(100))
    texts, parts = docs.select(F.col(text_col).alias("text")), 1
    for low, high in zip((0, *ROUNDS), (*ROUNDS, 100)):
        parts = _train_round(texts.where((part >= low) & (part < high)), lex, w, seen, parts)
    return w


def _train_round(docs: DataFrame, lex: Lexicon, w: Weights, seen: dict[str, np.ndarray], parts: int) -> int:
    """Updates ``w`` and ``seen`` (per row of the model) by one pass over the
    texts; returns the number of partitions that had any.

    A partition takes its share of what the rows have seen as the measure of its
    steps and sends the rows that it touched, with their changes weighted by how
    often it saw them.  Blocks of rows meet by number and are summed in a stream,
    so a task holds a few blocks and the driver receives one model, whatever the
    size of the data.  A row's merged change is the mean over what touched it,
    never over partitions that did not see it.  A sequence of n steps at rates
    that fall with their square root moves a row sqrt(n / m) times as far as m
    steps, so rows that the partitions saw seldom move that much further; rows
    seen ``SETTLED`` times have settled in the partition already."""
    share = {name: x / parts for name, x in seen.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights(lex)
        own.a, own.b = w.a.copy(), w.b.copy()
        own_seen = {name: x.copy() for name, x in share.items()}
        held, size = [], 0

        def step():
            idx, cls, rows = (np.concatenate([h[k] for h in held], axis=-1) for k in range(3))
            for k in range(0, len(idx), STEP):
                train_step(own, lex, idx[k:k + STEP], cls[k:k + STEP], rows[:, k:k + STEP], own_seen["a"], own_seen["b"])

        for t in (t for batch in batches for b in slices(batch, 200) for t in byte_texts(b)):
            idx, cls, code, _ = read_text(t, lex)
            held.append((idx, cls, lex.context_rows(code)))
            size += len(idx)
            if size >= 4 * STEP:
                step()
                held, size = [], 0
        if held:
            step()
        for name, m, start in (("a", own.a, w.a), ("b", own.b, w.b)):
            n = own_seen[name] - share[name]
            for k in range(0, len(m), BLOCK_ROWS):
                at = np.flatnonzero(n[k:k + BLOCK_ROWS] > 0.5)
                if len(at):
                    count = n[k + at].astype(np.float32)
                    change = (m[k + at] - start[k + at]) * count[:, None]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{name}{k}"]), pa.array([1], pa.int64()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                        pa.array([count.tobytes()], pa.binary()), pa.array([change.tobytes()], pa.binary())], names=names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for b in batches:
            for name, n, at, count, data in zip(*(b.column(c).to_pylist() for c in names)):
                at, count = np.frombuffer(at, np.uint16), np.frombuffer(count, np.float32).astype(np.float64)
                change = np.frombuffer(data, np.float32).reshape(len(at), -1)
                s = sums.setdefault(name, [0, np.zeros(BLOCK_ROWS), np.zeros(BLOCK_ROWS), np.zeros((BLOCK_ROWS, change.shape[1]))])
                s[0] += n
                s[1][at] += count
                s[2][at] += count * count
                s[3][at] += change
        for name, (n, count, squares, change) in sums.items():
            at = np.flatnonzero(count)
            count, squares = count[at], squares[at]
            typical = squares / count                       # times that a partition saw the row
            further = np.sqrt(np.maximum(np.minimum(count, SETTLED) / typical, 1.0))
            merged = np.clip(change[at] * (further / count)[:, None], -FARTHEST, FARTHEST)
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([n], pa.int64()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                pa.array([count.tobytes()], pa.binary()), pa.array([merged.astype(np.float32).tobytes()], pa.binary())], names=names)

    names = ["block", "parts", "at", "count", "data"]
    schema = "block string, parts long, at binary, count binary, data binary"
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = docs.mapInArrow(run, schema).repartition(n, "block").mapInArrow(add, schema).collect()   # one model: bounded by its fixed size
    for r in sums:
        name, m = r["block"][0], w.a if r["block"][0] == "a" else w.b
        at = int(r["block"][1:]) + np.frombuffer(bytes(r["at"]), np.uint16).astype(np.int64)
        m[at] += np.frombuffer(bytes(r["data"]), np.float32).reshape(len(at), -1)
        seen[name][at] += np.frombuffer(bytes(r["count"]), np.float64)
    return max((r["parts"] for r in sums), default=parts)


def score_texts(texts: list[bytes], lex: Lexicon, w: Weights) -> list[tuple]:
    """Per text (tokens, known, base and model log10 sums over dictionary tokens
    and classes, words outside the dictionary): the counts of the words outside
    are added later, their class terms are in the model sum already."""
    read = [read_text(t, lex) for t in texts]
    rows = np.concatenate([lex.context_rows(r[2]) for r in read], axis=1)
    idx, cls = (np.concatenate([r[k] for r in read]) for k in (0, 1))
    model = np.empty(len(idx))
    for k in range(0, len(idx), 4 * STEP):
        s = slice(k, k + 4 * STEP)
        i, c, r = idx[s], cls[s], rows[:, s]
        z = w.class_weights(r)
        p = z[np.arange(len(z)), c].astype(np.float64) / _row_sums(z)
        at = np.flatnonzero((i >= 0) & (i < lex.frequent))
        if len(at):
            ca = c[at]
            z = w.in_weights(in_rows(r[:, at], ca), ca)
            p[at] *= z[np.arange(len(z)), i[at] % SLOTS] / _row_sums(z)
        np.log10(np.maximum(p, 1e-300), out=model[s])
    rare = cls >= lex.classes
    model[rare] -= np.log10(lex.rare_mass)[cls[rare] - lex.classes]
    inside = idx >= 0
    logs = np.zeros(len(idx))
    logs[inside] = lex.logs[idx[inside]]
    model += np.where(idx >= lex.frequent, logs, 0.0)
    known = np.zeros(len(idx), np.int64)
    known[inside] = lex.counts[idx[inside]] > 0
    sizes = np.array([len(r[0]) for r in read])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    total = np.log10(lex.total + 1.0 * (lex.distinct + 1))
    sums = [np.add.reduceat(x, starts) for x in (known, logs, model)]      # every text has a token, its end
    return [(int(n), int(k), float(b - n * total), float(m), r[3]) for n, k, b, m, r in zip(sizes, *sums, read)]


def score_documents(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, learned (whether it taught the model),
    n_tokens, n_known (tokens seen in training), train_tokens, base_score
    (log10 of the add-one unigram), score (log10 probability of the model).

    ``learn`` selects the training rows.  NULL counts as an empty text, which is
    one end token.  Without any training row all words are unknown (N = V = 0).
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learned"))
    training = docs.where("learned")
    counts = materialize(token_counts(training, "text"), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = frequent_words(counts)
    ends = counts.where("length(token) = 0").first()
    first = {w for w, _ in [(END, 0)] + [x for x in top if x[0] != END][: FREQUENT - 1]}

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mass: Counter = Counter()
            for t, c in zip(b.column("token").to_pylist(), b.column("c").to_pylist()):
                if t not in first:
                    mass[ending(t) % RARE_CLASSES] += c + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(mass), pa.int32()), pa.array(list(mass.values()), pa.int64())],
                                             names=["r", "m"])

    rare = {r[0]: r[1] for r in counts.mapInArrow(masses, "r int, m long").groupBy("r").agg(F.sum("m")).collect()}
    lex = Lexicon(top, total, distinct, rare, ends[1] if ends else 0)
    weights = train(training, "text", lex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, 100):
                rows = score_texts(byte_texts(b), lex, weights)
                outside = [list(Counter(r[4]).items()) for r in rows]
                yield with_columns(
                    b, ["id", "learned"], n_tokens=pa.array([r[0] for r in rows], pa.int64()),
                    known=pa.array([r[1] for r in rows], pa.int64()), base=pa.array([r[2] for r in rows], pa.float64()),
                    model=pa.array([r[3] for r in rows], pa.float64()),
                    words=pa.array([[w for w, _ in x] for x in outside], pa.list_(pa.binary())),
                    ns=pa.array([[n for _, n in x] for x in outside], pa.list_(pa.int64())))

    id_type = docs.schema["id"].dataType.simpleString()
    scored = docs.mapInArrow(run, f"id {id_type}, learned boolean, n_tokens long, known long, base double, model double, "
                                  "words array<binary>, ns array<long>")
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    outside = scored.select("row", F.explode(F.arrays_zip("words", "ns")).alias("x")).select(
        "row", F.col("x.words").alias("token"), F.col("x.ns").alias("n"))
    # words without training count add log10(0 + 1) = 0 and stay unknown
    added = outside.join(counts, "token").groupBy("row").agg(
        F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"))
    zero = F.lit(0.0)
    return scored.drop("words", "ns").join(added, "row", "left").select(
        "id", "learned", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("logs", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("logs", zero)).alias("score"))


def held_out(id_col: Column) -> Column:
    """Rows that the query never learns from."""
    return id_crc_mod(id_col, 7) == 2
