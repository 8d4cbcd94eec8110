"""Filter interaction audit with wide packed counters.

Every document has a mask of the filters it fails.  A mask (with the document's
two labels) maps to one big integer: for each of the 120 orders and 5 steps it
holds a field per outcome (kept, removed, redundant, good lost, toxic lost), and
one field per filter for documents that fail nothing else.  A field has
``FIELD_BITS`` bits, more than any document count, so sums of integers never
carry into the next field.  Documents are counted per (part, mask, labels) first;
a part's integer is the sum of its at most 128 state integers times their counts,
and is unpacked into all 600 rows at once.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, slices, with_columns

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
STEPS = len(FILTERS)
CELLS = len(ORDERS) * STEPS
OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
FIELD_BITS = 64            # counts are longs, so a field's sum stays below 2**63

MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CONTINUED = bytes(range(0x80, 0xC0))     # UTF-8 bytes that begin no character


def text_mask(text: bytes) -> int:
    """Bits 0 to 3: the filters A to D that the text fails."""
    words = text.split()
    chars = len(text) if text.isascii() else len(text.translate(None, _CONTINUED))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, _CAPITALS))) > CAPITAL_PERCENT * chars) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


# ---- packed counters -----------------------------------------------------------

@functools.cache          # 128 states of 24 kB
def packed_state(mask: int, good: bool, toxic: bool) -> int:
    """The integer of one document: its outcome at every step of every order."""
    fields = np.zeros(CELLS * len(OUTCOMES) + STEPS, "<u8")
    out = fields[:CELLS * len(OUTCOMES)].reshape(len(OUTCOMES), len(ORDERS), STEPS)
    for o, order in enumerate(ORDERS):
        alive = True
        for s, name in enumerate(order):
            fails = bool(mask >> FILTERS.index(name) & 1)
            removed = alive and fails
            out[2, o, s] = fails and not alive
            alive = alive and not fails
            out[0, o, s], out[1, o, s], out[3, o, s], out[4, o, s] = alive, removed, removed and good, removed and toxic
    for k in range(STEPS):
        fields[CELLS * len(OUTCOMES) + k] = mask == 1 << k
    return int.from_bytes(fields.tobytes(), "little")


def unpack(total: int) -> tuple[np.ndarray, np.ndarray]:
    """(outcome, order, step) counts and the documents failing one filter only."""
    size = CELLS * len(OUTCOMES) + STEPS
    fields = np.frombuffer(total.to_bytes(size * FIELD_BITS // 8, "little"), "<u8").astype(np.int64)
    return fields[:-STEPS].reshape(len(OUTCOMES), len(ORDERS), STEPS), fields[-STEPS:]


def audit_rows(part: str, states: Iterator[tuple[int, bool, bool, int]]) -> pd.DataFrame:
    """The 600 rows of a part from its (mask, good, toxic, documents) counts."""
    counts, unique = unpack(sum(n * packed_state(m, g, t) for m, g, t, n in states))
    letter = np.array([[FILTERS.index(c) for c in order] for order in ORDERS])
    share = np.array([counts[1][letter == k].sum() for k in range(STEPS)])
    rows = {"part": part, "filter_order": np.repeat(ORDERS, STEPS), "step": np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))}
    rows |= {name: counts[k].ravel() for k, name in enumerate(OUTCOMES)}
    return pd.DataFrame(rows | {"unique_fails": unique[letter].ravel(), "shapley": share[letter].ravel()})


# ---- masks ---------------------------------------------------------------------

def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """Documents per (part, mask, good, toxic).

    Texts are compared by their SHA-256; only digests travel.  Equal rows, and
    then all copies of a text, are counted inside the tasks before each shuffle,
    so a text that fills a third of the table is no heavier than another."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                      F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch, 500)):
            texts = byte_texts(b)
            yield with_columns(b, ["id", "part"], mask=pa.array([text_mask(t) for t in texts], pa.int32()),
                               key=pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()))

    id_type = src.schema["id"].dataType.simpleString()
    rows = (src.mapInArrow(run, f"id {id_type}, part string, mask int, key binary")
            .groupBy("id", "key", "part", "mask").agg(F.count("*").alias("n")))
    # a row without an id meets no label; its digest spreads such rows over the join
    rows = rows.withColumn("at", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("\0"), F.hex("key"))))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("string").alias("at")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = rows.join(marks, "at", "left").fillna(False, ["good", "toxic"])
    # rows are distinct in (id, text, part) now: the least id's struct holds its number of rows
    copies = marked.groupBy("key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("low"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    least = F.min("low.id").over(Window.partitionBy("key"))
    firsts = F.col("no_id") + F.when(F.col("low.id") == F.col("least"), F.col("low.n")).otherwise(0)
    split = copies.withColumn("least", least).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), firsts.alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - firsts).alias("n")))).alias("x"))
    return (split.where("x.n > 0").groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic")
            .agg(F.sum("x.n").alias("n")))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """One row per part, filter order and step: kept, removed, redundant,
    good_lost, toxic_lost, unique_fails, shapley (see ``OUTCOMES``).

    Filters: A under 50 words; B 100 * distinct words < 65 * words; C 100 *
    capitals > 5 * code points; D any of ``#$%&*|``; E same text as a smaller id
    anywhere in the table.  A NULL text is empty, a NULL part the empty string; a
    row without an id has no smaller id and no label; equal rows count one by
    one; of several labels of an id any 1 counts.  Texts of any length are read
    whole.  An empty table has no parts and no rows.  Other columns are ignored.
    """
    counts = failure_counts(docs, labels, id_col, text_col, part_col)

    def rows(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return audit_rows(key[0], zip(*(group[c].tolist() for c in ("mask", "good", "toxic", "n"))))

    return counts.groupBy("part").applyInPandas(
        rows, "part string, filter_order string, step int, kept long, removed long, redundant long, good_lost long, "
              "toxic_lost long, unique_fails long, shapley long")
