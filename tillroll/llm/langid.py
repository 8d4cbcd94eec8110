"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its words' character n-grams (hashed);
a linear layer and a softmax give the language.  The model is fitted on a
bounded sample of labelled texts with stochastic gradient descent in numpy; a
temperature on held-back texts of the sample calibrates the probabilities, and
a calibrated threshold marks predictions to reject.  Since the layers are
linear, every word is one row of class sums, so scoring a text is a sum over
its words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, id_crc_mod, with_columns

SAMPLE_ROWS = 3000     # labelled texts that the classifier is fitted on, at most
BUCKETS = 1 << 14
DIM = 16
EPOCHS = 12
BATCH = 64
RATE = 0.5
REJECT = 0.01          # share of right held-back predictions below the rejection threshold
NO_LANGUAGE = "und"
CACHE_WORDS = 200_000

#: ASCII other than letters separates words; bytes beyond ASCII belong to words.
_TABLE = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def words_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(_TABLE).split()


def subwords(word: bytes, buckets: int = BUCKETS) -> list[int]:
    """Hashed n-grams (2 to 4 bytes) of the marked word, and the word itself."""
    w = b"<" + word + b">"
    n = len(w)
    return [zlib.crc32(w[k:k + size]) % buckets for size in (2, 3, 4) for k in range(n - size + 1)] + [zlib.crc32(w) % buckets]


def features(text: bytes, buckets: int = BUCKETS) -> tuple[list[int], list[float]]:
    """Bucket numbers and their shares in the text."""
    n: Counter = Counter()
    for w, c in Counter(words_of(text)).items():
        for b in subwords(w, buckets):
            n[b] += c
    total = sum(n.values())
    return list(n), [c / total for c in n.values()]


class Model:
    """Class sums per bucket (embedding times linear layer), bias, temperature."""

    def __init__(self, names, table, bias, temperature, threshold):
        self.names, self.table, self.bias = names, table, bias
        self.temperature, self.threshold = temperature, threshold

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _dense(rows, buckets):
    x = np.zeros((len(rows), buckets), np.float32)
    for k, (b, v) in enumerate(rows):
        x[k, b] = v
    return x


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], buckets: int = BUCKETS, dim: int = DIM,
        epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> Model | None:
    """Model from (buckets, shares, language) rows; None without any row."""
    if not rows:
        return None
    names = sorted({r[2] for r in rows})
    y = np.array([names.index(r[2]) for r in rows])
    x = [(r[0], r[1]) for r in rows]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5] if len(rows) >= 50 else order
    train = order[len(rows) // 5:] if len(rows) >= 50 else order
    e = rng.normal(0, 1, (buckets, dim)).astype(np.float32) / np.sqrt(dim)
    w = np.zeros((dim, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(train)
        for k in range(0, len(train), BATCH):
            at = train[k:k + BATCH]
            xb = _dense([x[i] for i in at], buckets)
            used = np.flatnonzero(xb.any(axis=0))
            xb = xb[:, used] * 30            # means of many small shares: bring them to unit scale
            h = xb @ e[used]
            z = h @ w + bias
            g = np.exp(z - z.max(axis=1, keepdims=True))
            g /= g.sum(axis=1, keepdims=True)
            g[np.arange(len(at)), y[at]] -= 1
            g /= len(at)
            back = g @ w.T
            w -= step * (h.T @ g)
            bias -= step * g.sum(axis=0)
            e[used] -= step * (xb.T @ back)
    table = 30 * (e @ w)
    logits = np.array([x[i][1] @ table[x[i][0]] if len(x[i][0]) else np.zeros(len(names)) for i in held])
    model = Model(names, table.astype(np.float32), bias, 1.0, 0.0)
    best = np.inf
    for t in np.geomspace(0.05, 20, 60):     # temperature of least log loss on the held-back texts
        p = (m := Model(names, model.table, bias, float(t), 0.0)).probabilities(logits)
        loss = -np.log(np.maximum(p[np.arange(len(held)), y[held]], 1e-12)).mean()
        if loss < best:
            best, model = loss, m
    p = model.probabilities(logits)
    right = p.argmax(axis=1) == y[held]
    model.threshold = float(np.quantile(p.max(axis=1)[right], REJECT)) if right.any() else 0.0
    return model


def training_rows(docs: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str, sample_rows: int) -> list:
    """Features of at most ``sample_rows`` labelled texts that have a letter:
    those with the smallest hashes of id and text (NULL labels never count)."""
    able = docs.where(learn & F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("text"),
        F.col(label_col).cast("string").alias("label"))
    least = [r[0] for r in able.select("h").orderBy("h").limit(sample_rows).collect()]
    if not least:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(features(t), k) for t, k in zip(byte_texts(b), b.column("label").to_pylist()) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([
                pa.array([np.asarray(r[0][0], "<i4").tobytes() for r in rows], pa.binary()),
                pa.array([np.asarray(r[0][1], "<f4").tobytes() for r in rows], pa.binary()),
                pa.array([r[1] for r in rows], pa.string())], names=["buckets", "shares", "label"])

    if len(least) < sample_rows:
        chosen = able
    elif least[0] < least[-1]:
        chosen = able.where(F.col("h") < least[-1])          # fewer than sample_rows, however often a row recurs
    else:
        chosen = able.where(F.col("h") == least[-1]).limit(sample_rows)
    found = chosen.select("text", "label").mapInArrow(run, "buckets binary, shares binary, label string").collect()
    rows = sorted((r["label"], bytes(r["buckets"]), bytes(r["shares"])) for r in found)
    return [(np.frombuffer(b, "<i4"), np.frombuffer(v, "<f4"), k) for k, b, v in rows]


class _Scorer:
    """Sums of class rows over the words of texts, with a bounded word cache."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def word_rows(self, words: list[bytes]) -> np.ndarray:
        """(class sums, number of n-grams) of each word."""
        new = [w for w in words if w not in self.known]
        fresh = {}
        if new:
            grams = [subwords(w) for w in new]
            sizes = np.array([len(g) for g in grams])
            flat = self.model.table[np.concatenate([np.array(g) for g in grams])]
            sums = np.add.reduceat(flat, np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
            fresh = dict(zip(new, np.concatenate([sums, sizes[:, None]], axis=1).astype(np.float32)))
            if len(self.known) + len(fresh) <= CACHE_WORDS:
                self.known.update(fresh)
        return np.array([self.known[w] if w in self.known else fresh[w] for w in words], np.float64)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        number: dict[bytes, int] = {}
        codes = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for t in texts]
        k = len(self.model.names)
        rows = self.word_rows(list(number)) if number else np.zeros((0, k + 1))
        sums = np.array([rows[c].sum(axis=0) if len(c) else np.zeros(k + 1) for c in codes])
        p = self.model.probabilities(sums[:, :k] / np.maximum(sums[:, k:], 1))
        ok = [has_letter(t) for t in texts]
        best = p.argmax(axis=1)
        return ([self.model.names[b] if o else NO_LANGUAGE for b, o in zip(best, ok)],
                np.where(ok, p.max(axis=1), 0.0))


def predict_language(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document row: id, lang_pred, score (0 to 1, calibrated),
    rejected (score below the calibrated threshold).

    ``learn`` selects the rows to learn from (rows with a NULL text or label
    teach nothing); the label is never an input of a prediction.  Texts that are
    NULL or have no letter are ``und`` with score 0 and rejected; so is every
    text if there is nothing to learn from.  Ties go to the first language.
    """
    model = fit(training_rows(docs, learn, id_col, text_col, label_col, sample_rows))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model) if model else None
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                b = batch.slice(k, 500)
                names, score = scorer.predict(byte_texts(b)) if scorer else (
                    [NO_LANGUAGE] * b.num_rows, np.zeros(b.num_rows))
                rejected = [n == NO_LANGUAGE or s < model.threshold for n, s in zip(names, score)]
                yield with_columns(b, ["id"], lang_pred=pa.array(names, pa.string()),
                                   score=pa.array(score, pa.float64()), rejected=pa.array(rejected, pa.bool_()))

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {id_type}, lang_pred string, score double, rejected boolean")


def held_out(id_col: Column) -> Column:
    """Rows that the query never learns from."""
    return id_crc_mod(id_col, 4) == 2
