"""Mixing sources to target weights, with DataFrame operations only.

The words of each source are packed, in a fixed order of its documents, into
blocks of ``block_words`` words (the last one may be shorter).  A source's
target is a number of words; it is served by passes over the source's blocks,
whole ones and a last partial one whose final block is cut, so the words taken
equal the rounded target.  For every source the slots of a mix are dealt over
the output shards by one multinomial draw (each slot draws its shard), which
makes a shard's source counts multinomial while the totals stay on target.
The slots of a source are numbered through its shards, and slot ``j`` of a pass
reads block ``perm(j)``, a pseudorandom permutation of the block numbers
(swap-or-not, Hoang, Morris and Rogaway 2012: a bijection of any range, computed
per row).  Slots and document pieces then meet by (source, block) in one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE, count_words, free_prefix, materialize

BLOCK_WORDS = 512
SLOTS_PER_SHARD = 1024
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SEED = 7
ROUNDS = 24
_TASK_SLOTS = 1 << 15   # slots that a task makes, about
_RANGE = 4096              # shards that are numbered together
_SPAN = 1 << 16        # slots drawn from one generated row


def permuted(j: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """Position of ``j`` under a pseudorandom permutation of 0..n-1 named by ``key``."""
    def step(x, r):
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        top = F.greatest(x, mirror)
        return F.when(F.xxhash64(*key, r, top).bitwiseAND(F.lit(1)) == 1, mirror).otherwise(x)
    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), j, step)


def source_targets(sized: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: sid, source, source_size, target (double).

    Sources in code-point order, NULL last, take the weights in turn and share
    the whole size by weight; a target stops at ``max_passes`` times its
    source's size and the excess is shared again by weight.  The fixed point is
    min(cap, level * weight); the level follows from the sources ordered by
    cap / weight.  Works on one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").isNull(), "source")
    w = F.array(*[F.lit(float(x)) for x in weights])
    per = per.withColumn("sid", (F.row_number().over(by_name) - 1).cast("long"))
    per = per.withColumn("weight", F.get(w, F.pmod("sid", F.lit(len(weights))).cast("int"))).withColumn(
        "cap", F.col("source_size") * F.lit(float(max_passes)))
    filled = W.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # the level if exactly the sources before this one are at their cap
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("__level", level).withColumn("__nth", F.row_number().over(filled))
    # the first source in that order that stays below its cap settles it
    below = F.col("__level") * F.col("weight") <= F.col("cap")
    per = per.withColumn("__level", F.min(F.when(below, F.struct("__nth", "__level"))).over(whole)["__level"])
    return per.select("sid", "source", "source_size",
                      F.least("cap", F.coalesce(F.col("__level") * F.col("weight"), F.col("cap"))).alias("target"))


def word_array(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, f"[{SPACE}]+", -1), lambda w: w != "")


def row_key(docs: DataFrame) -> Column:
    """64-bit key of all columns that Spark can hash; equal rows share it."""
    return F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])


def place(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """id, key, source, size and word offset in the source (start) of each row.

    The running sum is taken in about sqrt(rows) pseudorandom buckets per
    source and then over the bucket totals, so no source is ordered in one task.
    """
    # the place follows id, source and text alone; other columns only tell equal ones apart
    at = F.xxhash64(*dict.fromkeys([id_col, source_col, text_col]))
    sized = docs.select(F.col(id_col).alias("id"), row_key(docs).alias("key"), at.alias("at"), F.col(source_col).alias("source"),
                        count_words(F.col(text_col)).alias("size"))
    sized = materialize(sized, "mix-sized")
    buckets = max(1, int(sized.count() ** 0.5))
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("id", "at"), F.lit(buckets)))
    per = sized.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    base = per.select(F.col("source").alias("s2"), F.col("bucket").alias("b2"), F.coalesce(F.sum("in_bucket").over(
        W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inner = W.partitionBy("source", "bucket").orderBy("id", "at", "key").rowsBetween(W.unboundedPreceding, -1)
    local = sized.withColumn("local", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return local.join(base, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("b2"))).select(
        "id", "key", "source", "size", (F.col("local") + F.col("base")).alias("start"))


def draw_slots(targets: DataFrame, block_words: int = BLOCK_WORDS, slots_per_shard: int = SLOTS_PER_SHARD,
               seed: int = SEED) -> DataFrame:
    """One row per slot: sid, shard, slot (number in its source), pass_no, block
    and words (how many of the block's words it takes)."""
    t = targets.where("source_size > 0 and target > 0").withColumns({
        "blocks": F.ceil(F.col("source_size") / block_words),
        "full": F.floor(F.col("source_size") / block_words),
        "words": F.round("target").cast("long")})
    rest = F.col("words") - F.floor(F.col("words") / F.col("source_size")) * F.col("source_size")
    t = t.withColumn("slots", F.floor(F.col("words") / F.col("source_size")) * F.col("blocks") + F.ceil(rest / block_words))
    total = t.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-int(total) // slots_per_shard))
    # one multinomial draw per source: every slot draws its shard, counts stay
    spans = t.where("slots > 0").select("sid", "slots", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / _SPAN))).alias("span")).repartition("sid", "span")
    drawn = spans.select("sid", F.explode(F.sequence(
        F.col("span") * _SPAN, F.least((F.col("span") + 1) * _SPAN, F.col("slots")) - 1)).alias("n")).select(
        "sid", F.pmod(F.xxhash64(F.lit(seed), "sid", "n"), F.lit(shards)).alias("shard"))
    counts = drawn.groupBy("sid", "shard").agg(F.count("*").alias("c")).withColumn("range", F.floor(F.col("shard") / _RANGE))
    # slots are numbered through the shards: within ranges of shards, and over the ranges' totals
    before = F.coalesce(F.sum("in_range").over(W.partitionBy("sid").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.groupBy("sid", "range").agg(F.sum("c").alias("in_range")).select("sid", "range", before.alias("base"))
    local = F.coalesce(F.sum("c").over(W.partitionBy("sid", "range").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = counts.withColumn("local", local).join(ranges, ["sid", "range"]).withColumn("first", F.col("local") + F.col("base"))
    # a shard's slots are made where the shard is dealt to, not where its source was numbered;
    # the number of tasks follows the slots that come out, not the few bytes that go in
    tasks = max(1, -(-int(total) // _TASK_SLOTS))
    slot = first.select("sid", "shard", "first", "c").repartition(tasks, "sid", "shard").select(
        "sid", "shard", F.explode(F.expr("sequence(first, first + c - 1)")).alias("slot"))
    placed = slot.join(t.select("sid", "source_size", "blocks", "full", "words"), "sid").withColumns({
        "pass_no": F.floor(F.col("slot") / F.col("blocks")), "j": F.col("slot") % F.col("blocks")})
    # the short last block closes every pass, so a pass is cut at j * block_words
    block = F.when(F.col("j") < F.col("full"), permuted(F.col("j"), F.col("full"), F.lit(seed), F.col("sid"), F.col("pass_no"))
                   ).otherwise(F.col("j"))
    left = F.col("words") - F.col("pass_no") * F.col("source_size") - F.col("j") * block_words
    return placed.select("sid", "shard", "slot", "pass_no", block.alias("block"),
                         F.least(left, F.lit(block_words).cast("long")).alias("words"))


def _pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """Documents cut at block borders: sid, start, block, begin/end in the block."""
    return placed.where("size > 0").select("sid", "start", "size", F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))).alias("block")).select(
        "sid", "start", "block",
        F.greatest(F.lit(0).cast("long"), F.col("start") - F.col("block") * block_words).alias("begin"),
        F.least(F.lit(block_words).cast("long"), F.col("start") + F.col("size") - F.col("block") * block_words).alias("end"))


def _mix(docs, id_col, source_col, text_col, weights, max_passes, block_words, slots_per_shard, seed):
    """(placed documents, pieces of them that the mix takes)."""
    placed = place(docs, id_col, source_col, text_col)
    targets = materialize(source_targets(placed.select("source", "size"), weights, max_passes), "mix-targets")
    named = targets.select("sid", F.col("source").alias("s2"), "source_size", "target")
    placed = materialize(placed.join(named, F.col("source").eqNullSafe(F.col("s2"))).drop("s2", "source"), "mix-placed")
    slots = draw_slots(targets, block_words, slots_per_shard, seed)
    taken = _pieces(placed, block_words).join(slots, ["sid", "block"]).select(
        "sid", "start", "shard", "slot", "pass_no", "block",
        (F.col("block") * block_words + F.col("begin") - F.col("start")).alias("from_word"),
        (F.least("end", "words") - F.col("begin")).alias("n")).where("n > 0")
    return placed, taken


def mix_report(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               weights=WEIGHTS, max_passes: int = MAX_PASSES, block_words: int = BLOCK_WORDS,
               slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """One row per document row: id, size, source_size, target, taken (words,
    repeats counted), passes (in how many passes).

    NULL and empty texts have size 0 and take nothing; NULL is a source of its
    own; equal rows are packed one after the other; an empty table gives no
    rows.  Reruns on equal data agree.  Texts of any length are cut at block
    borders; other columns are ignored.
    """
    docs = docs.select(*dict.fromkeys([id_col, source_col, text_col]))
    placed, taken = _mix(docs, id_col, source_col, text_col, weights, max_passes, block_words, slots_per_shard, seed)
    per_doc = taken.groupBy("sid", "start").agg(
        F.sum("n").alias("taken"), F.countDistinct("pass_no").alias("passes")).withColumn("any", F.lit(True))
    # a document without words shares its start with the next one and takes nothing
    return placed.withColumn("any", F.col("size") > 0).join(per_doc, ["sid", "start", "any"], "left").select(
        "id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("passes", F.lit(0)).cast("long").alias("passes"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    weights=WEIGHTS, max_passes: int = MAX_PASSES, block_words: int = BLOCK_WORDS,
                    slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """The mix as documents: per document and pass one row with the words that
    the pass takes (the unchanged text if it takes all), other columns kept.
    Documents that no pass reads, and those without words, are not in the mix.
    Columns of any name are returned as they are; see ``mix_report`` for the rest."""
    placed, taken = _mix(docs, id_col, source_col, text_col, weights, max_passes, block_words, slots_per_shard, seed)
    inner = free_prefix(docs)
    n, runs_, key, ident, size, row = (inner + x for x in ("n", "runs", "key", "id", "size", "row"))
    runs = taken.groupBy("sid", "start", "pass_no").agg(
        F.sum("n").alias(n), F.sort_array(F.collect_list(F.struct("from_word", "n"))).alias(runs_))
    runs = placed.where("size > 0").join(runs, ["sid", "start"]).select(
        F.col("id").alias(ident), F.col("key").alias(key), F.col("size").alias(size), n, runs_)
    # the texts travel once; equal rows share one text and have a run each
    body = docs.withColumn(row, row_key(docs)).dropDuplicates([id_col, row])
    joined = body.join(runs, F.col(id_col).eqNullSafe(F.col(ident)) & (F.col(row) == F.col(key)))
    part = F.transform(
        F.array(word_array(F.col(text_col))),
        lambda w: F.array_join(F.flatten(F.transform(
            runs_, lambda r: F.slice(w, (r["from_word"] + 1).cast("int"), r["n"].cast("int")))), " "))[0]
    text = F.when(F.col(n) == F.col(size), F.col(text_col)).otherwise(part)
    return joined.select(*[(text if c == text_col else F.col(c)).alias(c) for c in docs.columns])


def mix_blocks(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               weights=WEIGHTS, max_passes: int = MAX_PASSES, block_words: int = BLOCK_WORDS,
               slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """The mix itself, one row per slot: shard, slot (number in its source),
    source, pass_no, block, words (the slot's words, ``block_words`` of them, fewer
    in a source's short last block and in its last slot).

    Edge cases as in ``mix_report``, which counts the same slots per document.
    """
    docs = docs.select(*dict.fromkeys([id_col, source_col, text_col]))
    placed, taken = _mix(docs, id_col, source_col, text_col, weights, max_passes, block_words, slots_per_shard, seed)
    rows = docs.select(F.col(id_col).alias("id"), row_key(docs).alias("key"), F.col(source_col).alias("source"),
                       word_array(F.col(text_col)).alias("w")).dropDuplicates(["id", "key"])
    named = placed.where("size > 0").select("id", "key", "sid", "start").join(taken, ["sid", "start"]).alias("t")
    pieces = named.join(rows.alias("r"), F.col("t.id").eqNullSafe(F.col("r.id")) & (F.col("t.key") == F.col("r.key"))).select(
        "sid", "source", "shard", "slot", "pass_no", "block", (F.col("start") + F.col("from_word")).alias("at"),
        F.slice("w", (F.col("from_word") + 1).cast("int"), F.col("n").cast("int")).alias("w"))
    return pieces.groupBy("sid", "slot").agg(
        *[F.first(c).alias(c) for c in ("shard", "source", "pass_no", "block")],
        F.sort_array(F.collect_list(F.struct("at", "w"))).alias("parts")).select(
        "shard", "slot", "source", "pass_no", "block", F.flatten("parts.w").alias("words"))
