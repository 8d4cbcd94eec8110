"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are computed in one pass over the texts.  Equal fingerprints are
collapsed first; the distinct ones meet in buckets that share two of five bit
blocks (three differing bits cannot touch more than three blocks, so every
link shares a bucket).  Inside a bucket the fingerprints are stored as vertical
bit planes; distances of a whole block of pairs are updated plane by plane with
carry-save counters, and a block is abandoned once every counter has passed
the radius.  A bucket emits a spanning forest, never its pairs; buckets beyond
``chunk`` members are dealt out as pairs of chunks, so no group grows with the
data.  Components of the forests are found with joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, free_prefix, materialize, text_key, with_columns
from tillroll.llm.components import connected_components

SEED = 42
SHINGLE = 3
RADIUS = 3
CHUNK = 2048           # members of a bucket that one task compares with each other
LANES = 4096           # pairs whose counters are updated together
_STEP = 1 << 15        # shingles unpacked at once (bounds memory on long texts)


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Bit k is 1 if it is set in over half of the shingles' XXH64 values.
    No word: 0; fewer words than ``width``: one shingle of all words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: n - width + 1].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), _STEP):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k:k + _STEP], ends[k:k + _STEP])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """One row per document row: id, text key, fingerprint as a signed long."""
    src = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.fromiter((fingerprint(t, width) for t in byte_texts(b)), np.uint64, b.num_rows)
            yield with_columns(b, ["id", "key"], fp=pa.array(f.view(np.int64)))

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {id_type}, key long, fp long")


# ---- bit-sliced comparison ---------------------------------------------------

def _within(planes: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs (i[k], j[k]) differ in at most ``radius`` bits."""
    n = len(i)
    size = -(-n // 8)
    width = max(1, radius.bit_length())
    offset = (1 << width) - 1 - radius       # counters overflow exactly beyond the radius
    counter = [np.full(size, 255 if offset >> k & 1 else 0, np.uint8) for k in range(width)]
    over = np.zeros(size, np.uint8)
    if n % 8:
        over[-1] = (1 << (8 - n % 8)) - 1    # lanes that hold no pair
    run = n == 0 or (i[-1] - i[0] + 1 == n and j[-1] - j[0] + 1 == n)
    for k, plane in enumerate(planes):
        carry = np.packbits(plane[i[0]:i[-1] + 1] ^ plane[j[0]:j[-1] + 1] if run else plane[i] ^ plane[j])
        for c in counter:                    # carry-save: add the plane into the counter bits
            carry_out = c & carry
            c ^= carry
            carry = carry_out
        over |= carry
        if k & 3 == 3 and over.min() == 255:
            return np.zeros(n, bool)         # every pair of the block is beyond the radius
    return np.unpackbits(~over, count=n).astype(bool)


def local_forest(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint (rows of a group adjacent) the index of its
    component's first member, linking pairs of one group within the radius."""
    n = len(fps)
    label = np.arange(n)
    if n < 2:
        return label
    planes = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1).T.copy()
    change = np.flatnonzero(np.diff(group)) + 1
    end = np.repeat(np.append(change, n), np.diff(np.concatenate(([0], change, [n]))))
    live, d = np.arange(n), 1
    while True:
        live = live[live + d < end[live]]
        if not live.size:
            return label
        pairs = live[label[live] != label[live + d]]
        joined = False
        for k in range(0, len(pairs), LANES):
            i = pairs[k:k + LANES]
            hit = i[_within(planes, i, i + d, radius)]
            for a, b in zip(hit.tolist(), (hit + d).tolist()):
                while label[a] != a:
                    a = label[a]
                while label[b] != b:
                    b = label[b]
                if a != b:
                    label[max(a, b)] = min(a, b)
                    joined = True
        while joined and not np.array_equal(label, nxt := label[label]):
            label = nxt
        d += 1


def _forests(radius: int):
    def flush(parts: list, last: bool):
        g = np.concatenate([p[0] for p in parts])
        f = np.concatenate([p[1] for p in parts])
        cut = len(g) if last else int(np.searchsorted(g, g[-1]))
        label = local_forest(f[:cut], g[:cut], radius)
        at = np.flatnonzero(label != np.arange(cut))
        out = pa.RecordBatch.from_arrays([pa.array(f[at]), pa.array(f[label[at]])], names=["a", "b"])
        return out, ([(g[cut:], f[cut:])] if cut < len(g) else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, base, prev = [], 0, -1, None
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(c).to_numpy() for c in ("bucket", "ci", "cj")], axis=1)
            new = np.ones(len(k), np.int64)
            new[1:] = (k[1:] != k[:-1]).any(axis=1)
            new[0] = prev is None or bool((k[0] != prev).any())
            g = base + np.cumsum(new)
            base, prev = int(g[-1]), k[-1]
            parts.append((g, b.column("fp").to_numpy()))
            rows += len(g)
            if rows >= 50_000 and parts[0][0][0] != base:
                out, parts = flush(parts, False)
                rows = sum(len(p[0]) for p in parts)
                yield out
        if parts:
            yield flush(parts, True)[0]
    return run


def _block_keys(radius: int) -> list[Column]:
    """Bucket keys: every choice of all but ``radius`` of the radius + 2 bit blocks."""
    n = radius + 2
    cuts = [round(64 * k / n) for k in range(n + 1)]
    block = [F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1)) for k in range(n)]
    keys = []
    for c, (x, y) in enumerate(combinations(range(n), 2)):
        wide = cuts[y + 1] - cuts[y]
        keys.append(F.shiftleft(F.lit(c).cast("long"), 56).bitwiseOR(F.shiftleft(block[x], wide)).bitwiseOR(block[y]))
    return keys


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Spanning edges (a, b) between distinct fingerprints (column ``fp``)
    at most ``radius`` bits apart; every link is implied by the edges."""
    keyed = fps.select("fp", F.explode(F.array(*_block_keys(radius))).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    parts = F.ceil(F.col("m") / chunk)
    own = F.pmod(F.xxhash64("fp"), parts)
    dealt = (keyed.join(sizes, "bucket").withColumn("own", own)
             .select("bucket", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
             .select("bucket", F.least("own", "other").alias("ci"), F.greatest("own", "other").alias("cj"), "fp"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "bucket", "ci", "cj").sortWithinPartitions("bucket", "ci", "cj", "fp")
            .mapInArrow(_forests(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """One row per document row: id, key (text key), fp, root (smallest
    fingerprint of its component), component_id (smallest id of the component).

    NULL and empty texts have fingerprint 0 and link like any other; rows with
    equal ids stay separate rows; a NULL id never names a component unless the
    component has no other id (then it is NULL).  An empty table gives no rows.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, width), "simhash")
    per_fp = materialize(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-fp")
    comp = connected_components(fingerprint_links(per_fp, radius, chunk))
    rooted = per_fp.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(ids, "root")
    return marked.join(by_fp, "fp").select("id", "key", "fp", "root", "component_id")


def fingerprint_hex(c: Column) -> Column:
    """16 lowercase hexadecimal digits of a signed long."""
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents without near-duplicates: of each component the row with
    the smallest id stays (NULL ids last; ties by text key, equal rows once).

    NULL, empty and very long texts are compared like any other; an empty table
    gives no rows; columns of any name are returned as they are."""
    found = near_duplicates(docs, id_col, text_col, **kw)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    inner = free_prefix(docs)
    own, ident, key = inner + "own", inner + "id", inner + "key"
    chosen = first.select(F.col("first.id").alias(ident), F.col("first.key").alias(key))
    kept = docs.withColumn(own, text_key(F.col(text_col))).join(
        chosen, F.col(id_col).eqNullSafe(F.col(ident)) & (F.col(own) == F.col(key)), "left_semi")
    return kept.dropDuplicates([id_col, own]).drop(own)
