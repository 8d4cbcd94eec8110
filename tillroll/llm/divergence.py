"""Source divergence audit on frequent-pattern trees of term rows.

A kept term's row lists its sources, in order, with their nonzero counts.  Rows
that are equal become one row with a multiplicity; the rows of a task are
inserted into a tree whose nodes are (source, count), so rows with the same
beginning share a path.  For two sources s and o, the sum over all terms of
f(p_s, p_o) is taken apart:

* as if o had no term: every count of s against o's zero probability;
* the terms that o has, as if s had none of them;
* for terms that both have, what these two leave over: a correction that depends
  on the two counts only.  It is added once per node and ancestor, times the
  node's multiplicity, for all terms that share the path.

The first two need only each source's counts of counts.  All arithmetic is on
integers: probabilities are scaled to ``SCALE``, sums are exact.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, materialize, slices

SCALE = 1_000_000_000
MIN_DOCS = 3               # documents of a language that a kept term is in, at least
TOP_TERMS = 200
TREE_ROWS = 50_000         # distinct term rows of one tree
CHUNK = 512                # sources, and counts of counts, that one cell compares at once
SPREAD = 16                # tasks that a language's cells are dealt to, at least
_FLUSH = 300_000           # term counts that a task holds before it passes them on

#: Terms are runs of letters and of bytes beyond ASCII; A-Z becomes a-z.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


# ---- counts --------------------------------------------------------------------

def term_rows(docs: DataFrame) -> DataFrame:
    """(lang, term, total, entries) of the kept terms; entries are the sources with
    a count, in order.  Counts are summed inside the tasks, shuffled once by
    (lang, term), and written under the shared checkpoint folder."""
    def out(found: dict) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(5)]
        for (lang, source), (n, n_docs) in found.items():
            terms = list(n)
            for held, part in zip(columns, (
                    pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)),
                    pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()),
                    pa.array(map(n_docs.__getitem__, terms), pa.int64()))):
                held.append(part)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = defaultdict(lambda: (Counter(), Counter()))
        held = 0
        for b in (part for batch in batches for part in slices(batch, 200)):
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), byte_texts(b)):
                n, n_docs = found[lang, source]
                before, terms = len(n), terms_of(text)
                n.update(terms)
                n_docs.update(set(terms))
                held += len(n) - before
            if held > _FLUSH:
                yield out(found)
                found.clear()
                held = 0
        if found:
            yield out(found)

    partial = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    # one shuffle serves the sums per source and the row of the term
    summed = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("count"), F.sum("docs").alias("docs"))
    rows = summed.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("total"),
        F.array_sort(F.collect_list(F.struct("source", "count"))).alias("entries"))
    return materialize(rows.where(F.col("docs") >= MIN_DOCS).drop("docs"), "term-rows")


def scaled(count: str, mass: str) -> Column:
    """1 + floor(SCALE * (count + 1) / mass), in decimals: counts of any size fit."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(20,0)) + 1)) div cast({mass} as decimal(20,0))")


# ---- divergences ---------------------------------------------------------------

def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); both are at most SCALE + 1, so squares fit 64 bits."""
    return (p - q) * (p - q) // q


def _exact(values: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Products of which sums over all rows stay exact: 64 bits where they suffice."""
    most = max(int(values.max(initial=0)), -int(values.min(initial=0))) * max(int(times.max(initial=0)), 1) * max(values.size, 1)
    return values * times if most < 1 << 62 else values.astype(object) * times.astype(object)


def _reduced(keys: np.ndarray, values: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(key, sum of the values of the key) for keys below ``size``."""
    if values.dtype != object and size <= 1 << 20:
        sums = np.zeros(size, np.int64)
        np.add.at(sums, keys, values)
        found = np.flatnonzero(sums)
        yield from zip(found.tolist(), sums[found].tolist())
    elif len(keys):
        order = np.argsort(keys, kind="stable")
        found, starts = np.unique(keys[order], return_index=True)
        yield from zip(found.tolist(), np.add.reduceat(values[order], starts).tolist())


class Tree:
    """Sorted term rows of one language as paths of (source, count) nodes.

    A node knows its parent, its source, its probability as counted and as if
    the source had no such term, and the multiplicity of the rows through it.
    Rows that begin alike are neighbours, so a level is built at once: a row
    shares its node with the row before if all entries up to there are equal."""

    def __init__(self, ends: np.ndarray, times: np.ndarray, source: np.ndarray, count: np.ndarray, p: np.ndarray, zero: np.ndarray):
        starts = np.concatenate(([0], ends[:-1]))
        size = ends - starts
        rows, shared = np.arange(len(ends)), np.zeros(len(ends), bool)
        shared[1:] = True
        above = np.full(len(ends), -1)
        parts: dict[str, list] = {"parent": [], "source": [], "p": [], "zero": [], "times": []}
        nodes = depth = 0
        while len(rows := rows[size[rows] > depth]):
            at = starts[rows] + depth
            same = shared[rows] & (size[rows - 1] > depth)
            before = np.where(same, starts[rows - 1] + depth, at)
            same &= (source[at] == source[before]) & (count[at] == count[before])
            shared[:] = False
            shared[rows] = same
            new = np.flatnonzero(~same)
            node = nodes + np.cumsum(~same) - 1
            parts["parent"].append(above[rows[new]])
            for name, of in (("source", source), ("p", p), ("zero", zero)):
                parts[name].append(of[at[new]])
            parts["times"].append(np.add.reduceat(times[rows], new))
            above[rows] = node
            nodes += len(new)
            depth += 1
        self.parent, self.source, self.p, self.zero, self.times = (
            np.concatenate(v) if v else np.empty(0, np.int64) for v in parts.values())

    def corrections(self, names: list[str]) -> Counter:
        """(source, other source) -> sum of the corrections of node and ancestor,
        one step up at a time for all nodes together."""
        found: Counter = Counter()
        source, p, zero, k = self.source, self.p, self.zero, len(names)
        node, above = np.arange(len(self.parent)), self.parent
        while True:
            keep = above >= 0
            node, above = node[keep], above[keep]
            if not len(node):
                return found
            base = divergence(zero[node], zero[above]), divergence(zero[above], zero[node])
            for s, o, none in ((node, above, base[0]), (above, node, base[1])):
                left = divergence(p[s], p[o]) - divergence(p[s], zero[o]) - divergence(zero[s], p[o]) + none
                for key, value in _reduced(source[s] * k + source[o], _exact(left, self.times[node]), k * k):
                    found[names[key // k], names[key % k]] += value
            above = self.parent[above]


_PAIRS = "lang string, source string, item string, value decimal(38,0)"


def _pair_batch(found: dict[tuple, int]) -> pa.RecordBatch:
    keys = list(found)
    columns = [pa.array([k[c] for k in keys], pa.string()) for c in range(3)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([Decimal(found[k]) for k in keys], pa.decimal128(38, 0))],
                                      names=["lang", "source", "item", "value"])


def tree_corrections(rows: DataFrame) -> DataFrame:
    """Partial corrections per (lang, source, other source) from rows (lang,
    entries, times).  Rows are sorted, so neighbours share long paths; a tree has
    at most ``TREE_ROWS`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in (part for batch in batches for part in slices(batch, TREE_ROWS)):
            langs = b.column("lang").dictionary_encode()
            entries, times = b.column("entries"), b.column("times").to_numpy()
            flat = entries.flatten()
            coded = flat.field("source").dictionary_encode()
            fields = [np.asarray(coded.indices, np.int64), *(flat.field(c).to_numpy() for c in ("count", "p", "zero"))]
            ends = np.cumsum(pc.list_value_length(entries).to_numpy())
            names = coded.dictionary.to_pylist()
            cuts = np.flatnonzero(np.diff(np.asarray(langs.indices), prepend=-1, append=-1))
            for x, y in zip(cuts[:-1], cuts[1:]):            # rows are sorted by language
                first = ends[x - 1] if x else 0
                tree = Tree(ends[x:y] - first, times[x:y], *(f[first:ends[y - 1]] for f in fields))
                for (s, o), v in tree.corrections(names).items():
                    found[langs.dictionary[int(langs.indices[x])].as_py(), s, o] += v
            if len(found) > _FLUSH:
                yield _pair_batch(found)
                found.clear()
        yield _pair_batch(found)

    # ranges of the first entries and a hash: what the driver samples stays small
    start = F.transform(F.slice("entries", 1, 3), lambda e: F.struct(e["source"].alias("source"), e["count"].alias("count")))
    ordered = rows.repartitionByRange("lang", start, F.xxhash64("entries")).sortWithinPartitions("lang", "entries")
    return ordered.mapInArrow(run, _PAIRS)


def single_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums per (lang, source, other source) in which one of the two has no term.

    ``counts``: (lang, source, count, p, zero, times), counts of counts with the
    zero count included; ``groups``: (lang, source, zero).  Both are packed in
    chunks of at most about ``CHUNK``, and chunks of a language meet in cells;
    the sources' chunks go to ``SPREAD`` places, so a language is not one task."""
    def packed(df: DataFrame, name: str, *cols: str) -> DataFrame:
        chunks = -(-df.count() // CHUNK) or 1
        return (df.groupBy("lang", F.pmod(F.xxhash64(*cols), F.lit(chunks)).alias("chunk"))
                .agg(F.collect_list(F.struct(*cols)).alias(name)))

    heads = packed(groups, "heads", "source", "zero").select(
        "lang", "heads", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias("place"))
    cells = (packed(counts, "counts", "source", "count", "p", "zero", "times")
             .select("lang", "counts", F.pmod("chunk", F.lit(SPREAD)).alias("place")).join(heads, ["lang", "place"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch, 1)):
            row = b.to_pylist()[0]
            mine = sorted(row["counts"], key=lambda e: e["source"])
            heads = [h["source"] for h in row["heads"]]
            q = np.array([h["zero"] for h in row["heads"]], np.int64)[None, :]
            p, zero, times, count = (np.array([e[c] for e in mine], np.int64)[:, None] for c in ("p", "zero", "times", "count"))
            names, starts = np.unique(np.array([e["source"] for e in mine], object), return_index=True)
            forward = np.add.reduceat(_exact(divergence(p, q), times), starts, axis=0)
            # the other way round only the terms that the source has change anything
            gain = np.where(count > 0, divergence(q, p) - divergence(q, zero), 0)
            backward = np.add.reduceat(_exact(gain, times), starts, axis=0)
            found: Counter = Counter()
            for k, s in enumerate(names):
                for j, o in enumerate(heads):
                    if s != o:
                        found[row["lang"], s, o] += int(forward[k, j])
                        found[row["lang"], o, s] += int(backward[k, j])
            yield _pair_batch(found)

    return cells.mapInArrow(run, _PAIRS)


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: for every (lang, source) group its
    divergence from each other source of the language (part ``pair``), and its
    ``top`` terms by divergence above the language (part ``term``).

    NULL in any column reads as the empty string.  Repeated rows are documents of
    their own; a group without terms, and a language without kept terms, has
    value 0 for every pair.  Ties rank by the item's UTF-8 bytes.  Texts of any
    length are read whole.  An empty table gives no rows.  Other columns are ignored.
    """
    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                        for c, n in ((lang_col, "lang"), (source_col, "source"))], F.col(text_col).alias("text"))
    rows = term_rows(src)
    each = rows.select("lang", "term", "total", F.inline("entries"))
    languages = rows.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sums = each.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("seen"))
    groups = materialize(
        src.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(languages, "lang", "left")
        .fillna(0, ["n", "seen", "v", "lang_n"])
        # without kept terms nothing is ever counted: any probability serves
        .withColumn("mass", F.greatest(F.col("n") + F.col("v"), F.lit(1))).withColumn("none", F.lit(0).cast("long"))
        .withColumn("zero", scaled("none", "mass")).drop("none"), "divergence-groups")
    known = (each.join(groups, ["lang", "source"]).withColumn("p", scaled("count", "mass"))
             .withColumn("q", scaled("total", "lang_n + v")))

    signature = F.array_sort(F.collect_list(F.struct("source", "count", "p", "zero")))
    paths = known.groupBy("lang", "term").agg(signature.alias("entries")).groupBy("lang", "entries").agg(F.count("*").alias("times"))
    counts = known.groupBy("lang", "source", "count", "p", "zero").agg(F.count("*").alias("times"))
    unseen = groups.select("lang", "source", F.lit(0).cast("long").alias("count"), F.col("zero").alias("p"), "zero",
                           (F.col("v") - F.col("seen")).alias("times"))
    pairs = (single_sums(materialize(counts.union(unseen), "counts-of-counts"), groups.select("lang", "source", "zero"))
             .union(tree_corrections(paths.where(F.size("entries") > 1)))
             .groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    terms = known.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        F.expr("((p - q) * (p - q)) div q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).union(terms.withColumn("rank", rank).where(F.col("rank") <= top))
