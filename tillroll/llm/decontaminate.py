"""Benchmark decontamination with a positional inverted index.

The training documents are indexed in blocks: every block row holds the sorted
terms of its documents and, per term, the ascending positions of the term
(postings).  Blocks are cut by words, so they are as large on a small table as
on a huge one; a hot source or a very frequent word only makes more blocks.
Benchmark items are the stated query set; they visit the index in bounded
groups.  For every window the posting lists are intersected, shifted by each
term's offset in the window, from the rarest term (by corpus counts taken from
the index) to the most frequent one.  The same lists answer proximity: around
each posting of the rarest term all other terms must occur within ``slop``.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import byte_texts, free_prefix, materialize, slices, text_key

WINDOW = 10
SLOP = 20
BLOCK_WORDS = 1 << 20      # words of one index block (a longer document is a block of its own)
QUERY_WORDS = 200_000      # benchmark words that one pass over the index looks for
GAP = 64                   # position numbers left free between documents; slop is below it

#: Words are runs of [0-9a-z] and of bytes beyond ASCII; the rest separates.
_TABLE = bytes(ord(chr(c).lower()) if chr(c) in string.ascii_letters else
               c if chr(c) in string.digits or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


# ---- index --------------------------------------------------------------------

def _starts(counts: np.ndarray) -> np.ndarray:
    """First position of each document of a block."""
    return np.concatenate(([0], np.cumsum(counts + GAP)[:-1]))


class _Block:
    """Documents of a block while it grows: term numbers instead of words."""

    def __init__(self):
        self.ids, self.keys, self.codes, self.size = [], [], [], 0
        self.number: dict[bytes, int] = {}

    def add(self, ident, key: int, words: list[bytes]) -> None:
        number = self.number
        self.ids.append(ident)
        self.keys.append(key)
        self.codes.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
        self.size += len(words)

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        """The block's row.  Positions number its words; numbers left free
        between documents keep phrases and neighbourhoods inside one."""
        counts = np.array([len(c) for c in self.codes], np.int64)
        starts = _starts(counts)
        codes = np.concatenate(self.codes)
        positions = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(len(codes))
        positions = positions[np.argsort(codes, kind="stable")]
        ends = np.cumsum(np.bincount(codes, minlength=len(self.number)))
        wide = "<i8" if starts[-1] + counts[-1] >> 31 else "<i4"
        return pa.RecordBatch.from_arrays([
            pa.array([self.ids], pa.list_(id_type)), pa.array([self.keys], pa.list_(pa.int64())),
            pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([b"\n".join(self.number)], pa.binary()),
            pa.array([ends.astype("<i8").tobytes()], pa.binary()), pa.array([positions.astype(wide).tobytes()], pa.binary()),
        ], names=["ids", "keys", "counts", "terms", "ends", "positions"])


def positional_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per block: block number, document ids, text keys and word counts,
    terms, ends of their posting lists, positions.  The table is written once
    under the shared checkpoint folder."""
    src = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    id_sql = src.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kind = _Block(), None
        for b in (part for batch in batches for part in slices(batch, 200)):
            kind = b.column("id").type
            for i, k, t in zip(b.column("id").to_pylist(), b.column("key").to_pylist(), byte_texts(b)):
                words = words_of(t)
                if block.ids and block.size + len(words) > block_words:
                    yield block.batch(kind)
                    block = _Block()
                block.add(i, k, words)
        if block.ids:
            yield block.batch(kind)

    schema = T.StructType([
        T.StructField("ids", T.ArrayType(id_sql)), T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("terms", T.BinaryType()),
        T.StructField("ends", T.BinaryType()), T.StructField("positions", T.BinaryType())])
    index = src.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())
    return materialize(index, "postings")


# ---- queries ------------------------------------------------------------------

def item_windows(items: list[tuple], width: int = WINDOW) -> dict[tuple[bytes, ...], set]:
    """Window of words -> ids of the items that contain it."""
    found: dict[tuple[bytes, ...], set] = defaultdict(set)
    for item, text in items:
        w = words_of((text or "").encode())
        for k in range(max(len(w) - width, 0) + 1 if w else 0):
            found[tuple(w[k:k + width])].add(item)
    return found


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one at a time (a block's lists take some megabytes)."""
    for k in range(batch.num_rows):
        yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _lists(row: dict, wanted: set[bytes]) -> dict[bytes, np.ndarray]:
    ends = np.frombuffer(row["ends"], "<i8")
    wide = "<i8" if len(row["positions"]) == 8 * (ends[-1] if len(ends) else 0) else "<i4"
    positions = np.frombuffer(row["positions"], wide)
    return {t: positions[ends[k - 1] if k else 0:ends[k]]
            for k, t in enumerate(row["terms"].split(b"\n") if row["terms"] else []) if t in wanted}


def _has(postings: np.ndarray, at: np.ndarray) -> np.ndarray:
    k = np.searchsorted(postings, at)
    return (k < len(postings)) & (postings[np.minimum(k, len(postings) - 1)] == at)


def exact_starts(lists: dict, window: tuple, rank: dict) -> np.ndarray:
    """Positions where the window begins: offset-adjusted lists, rarest first."""
    terms = sorted(range(len(window)), key=lambda o: rank.get(window[o], 0))
    if any(window[o] not in lists for o in terms):
        return np.empty(0, np.int64)
    at = lists[window[terms[0]]].astype(np.int64) - terms[0]
    for o in terms[1:]:
        if not at.size:
            break
        at = at[_has(lists[window[o]], at + o)]
    return at


def near_anchors(lists: dict, window: tuple, rank: dict, slop: int) -> np.ndarray:
    """Postings of the window's rarest term with all its other terms within ``slop``."""
    terms = sorted(set(window), key=lambda t: (rank.get(t, 0), t))
    if any(t not in lists for t in terms):
        return np.empty(0, np.int64)
    at = lists[terms[0]].astype(np.int64)
    for t in terms[1:]:
        if not at.size:
            break
        at = at[np.searchsorted(lists[t], at + slop, "right") > np.searchsorted(lists[t], at - slop)]
    return at


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _search(index: DataFrame, windows: dict[tuple, set], slop: int, item_type: T.DataType) -> DataFrame:
    """(block, doc, spans, items, near_items) of the documents that the windows touch."""
    terms = {t for w in windows for t in w}

    def count(batches):
        for b in batches:
            n: dict[bytes, int] = defaultdict(int)
            for row in _rows(b):
                ends = np.frombuffer(row["ends"], "<i8")
                size = np.diff(ends, prepend=0)
                for k, t in enumerate(row["terms"].split(b"\n") if row["terms"] else []):
                    if t in terms:
                        n[t] += int(size[k])
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())],
                                             names=["term", "n"])

    # corpus counts of the query terms: at most one row per term of this query group
    rank = {bytes(r["term"]): r["n"] for r in index.select("terms", "ends").mapInArrow(count, "term binary, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect()}
    windows = {w: sorted(i, key=str) for w, i in windows.items() if all(t in rank for t in w)}

    def run(batches):
        for b in batches:
            for row in _rows(b):
                lists = _lists(row, terms)
                starts = _starts(np.array(row["counts"], np.int64))
                spans, items, near = defaultdict(list), defaultdict(set), defaultdict(set)
                for w, ids in windows.items():
                    at = exact_starts(lists, w, rank)
                    for d, p in zip(np.searchsorted(starts, at, "right") - 1, at):
                        spans[int(d)].append((int(p - starts[d]), int(p - starts[d]) + len(w)))
                        items[int(d)].update(ids)
                    if slop:
                        at = near_anchors(lists, w, rank, slop)
                        for d in np.unique(np.searchsorted(starts, at, "right") - 1).tolist():
                            near[d].update(ids)
                found = sorted(spans.keys() | near.keys())
                yield pa.RecordBatch.from_pylist([
                    {"block": row["block"], "doc": d,
                     "spans": [{"begin": x, "end": y} for x, y in _merged(spans.get(d, []))],
                     "items": sorted(items.get(d, ()), key=str), "near_items": sorted(near.get(d, ()), key=str)}
                    for d in found], schema=arrow)

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc", T.IntegerType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()),
                                                         T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(item_type)), T.StructField("near_items", T.ArrayType(item_type))])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return index.select("block", "counts", "terms", "ends", "positions").mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
                  slop: int = SLOP, block_words: int = BLOCK_WORDS, query_words: int = QUERY_WORDS) -> DataFrame:
    """One row per document row: id, key (text key), n_words, n_hit (words inside
    an occurrence of a window), spans (their word ranges), items (ids of items
    with an occurring window), near_items (items with a window whose terms all
    lie within ``slop`` words of its rarest term).

    An item of fewer than ``width`` words is one window.  NULL and empty texts
    have no words and no windows; equal item ids count once; an empty benchmark
    or table gives no hits or no rows.  The benchmark is read in groups of at
    most about ``query_words`` words, one pass over the index each.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be from 0 to {GAP - 1}")
    index = positional_index(docs, id_col, text_col, block_words)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    # an upper bound of the words: every word has a character and a separator
    size = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    groups = max(1, -(-int(size) // query_words))
    item_type = items.schema["item"].dataType
    part = F.pmod(F.xxhash64("item", "text"), F.lit(groups))
    hits = None
    for k in range(groups):
        rows = [tuple(r) for r in items.where(part == k).collect()]   # bounded by query_words
        windows = item_windows(rows, width)
        if windows:
            found = _search(index, windows, slop, item_type)
            hits = found if hits is None else hits.union(found)
    listed = index.select("block", F.posexplode(F.arrays_zip("ids", "keys", "counts")).alias("doc", "x")).select(
        "block", "doc", F.col("x.ids").alias("id"), F.col("x.keys").alias("key"), F.col("x.counts").alias("n_words"))
    if hits is None:
        none = f"array<{item_type.simpleString()}>"
        return listed.select("id", "key", "n_words", F.lit(0).cast("long").alias("n_hit"),
                             F.expr("cast(array() as array<struct<begin:bigint,end:bigint>>)").alias("spans"),
                             F.expr(f"cast(array() as {none})").alias("items"),
                             F.expr(f"cast(array() as {none})").alias("near_items"))
    # a document's lists come from at most ``groups`` passes
    hits = hits.groupBy("block", "doc").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"))
    n_hit = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["begin"], a["end"]))).alias("n"),
                              F.greatest(a["end"], s["end"]).alias("end")), lambda a: a["n"])
    joined = listed.join(hits, ["block", "doc"], "left")
    empty = lambda c: F.coalesce(c, F.array().cast(hits.schema[c].dataType))
    return joined.select("id", "key", "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
                         *[empty(c).alias(c) for c in ("spans", "items", "near_items")])


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents without any hit word, all columns unchanged (equal rows share
    their fate).  NULL and empty texts have no words and stay; texts of any length
    are searched whole; an empty table or benchmark removes nothing."""
    inner = free_prefix(docs)
    own, ident, key = inner + "own", inner + "id", inner + "key"
    bad = contamination(docs, benchmark, id_col, text_col, **({"slop": 0} | kw)).where("n_hit > 0").select(
        F.col("id").alias(ident), F.col("key").alias(key)).distinct()
    return (docs.withColumn(own, text_key(F.col(text_col)))
            .join(bad, F.col(id_col).eqNullSafe(F.col(ident)) & (F.col(own) == F.col(key)), "left_anti")
            .drop(own))
