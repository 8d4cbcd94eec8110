"""Filter interaction audit and source divergence audit against brute force."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import ROWS
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, divergence, filter_audit, mixing, quality, simhash

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, 1), (7, 1, 1), (None, 1, 1), (99, 1, 1), (13, 1, 0)]
AUDIT = ["kept", "removed", "redundant", "good_lost", "toxic_lost", "unique_fails", "shapley"]


def audit(spark, docs, labels):
    got = filter_audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in AUDIT) for r in got}
    assert len(found) == len(got)
    return found


def test_filter_audit_matches_brute_force(spark, edge_docs, clash_docs, no_docs):
    want = brute.filter_audit([(r[0], r[1], r[3]) for r in ROWS], LABELS)
    assert audit(spark, edge_docs, LABELS) == want
    assert audit(spark, clash_docs.repartition(7), LABELS) == want
    assert audit(spark, no_docs, LABELS) == {}
    assert audit(spark, edge_docs, []) == brute.filter_audit([(r[0], r[1], r[3]) for r in ROWS], [])


def test_filter_audit_on_random_texts(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(("ab", "Cd", "e#", "fg", "hI", f"w{k}")) for k in range(rng.choice((3, 60, 90)))) for _ in range(40)]
    rows = [(k, rng.choice(texts), None, rng.choice(("x", "y", None)), 0) for k in range(300)]
    labels = [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 300, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert audit(spark, docs, labels) == brute.filter_audit([(r[0], r[1], r[3]) for r in rows], labels)


def test_packed_counters_do_not_carry():
    n = 2**62
    counts, unique = filter_audit.unpack(n * filter_audit.packed_state(0, True, True) + (n - 1) * filter_audit.packed_state(4, True, False))
    assert counts[0].max() == 2 * n - 1 and set(counts[1].ravel().tolist()) == {0, n - 1}
    assert unique.tolist() == [0, 0, n - 1, 0, 0]


def divergences(df, **kw):
    return sorted(tuple(r) for r in divergence.source_divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence_matches_brute_force(spark, edge_docs, clash_docs, no_docs):
    want = brute.source_divergence([(r[1], r[2], r[3]) for r in ROWS])
    assert divergences(edge_docs) == want
    assert divergences(clash_docs) == want
    assert divergences(no_docs) == []


@pytest.mark.parametrize("seed", range(3))
def test_divergence_on_random_tables(spark, monkeypatch, seed):
    """Small chunks and trees, so that every partial sum is put together again."""
    monkeypatch.setattr(divergence, "CHUNK", 3)
    monkeypatch.setattr(divergence, "TREE_ROWS", 4)
    rng = random.Random(seed)
    vocabulary = ["a", "B", "été", "zz9yy", "ñ", "the", "of"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 30)))) if rng.random() < .95 else None,
             rng.choice(("en", "en", "fr", None)), rng.choice([f"s{k}" for k in range(12)] + [None, ""])) for _ in range(120)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert divergences(df, top=5) == brute.source_divergence(rows, top=5)
    assert divergences(df.repartition(9)) == brute.source_divergence(rows)


def test_tree_shares_paths():
    rows = [([(0, 1), (1, 2)], 5), ([(0, 1), (1, 2), (2, 1)], 2), ([(0, 1), (2, 1)], 1), ([(1, 2)], 4), ([(1, 3), (2, 1)], 1)]
    flat = np.array([e for r, _ in rows for e in r])
    tree = divergence.Tree(np.cumsum([len(r) for r, _ in rows]), np.array([n for _, n in rows]),
                           flat[:, 0], flat[:, 1], flat[:, 1] + 1, np.ones(len(flat), np.int64))
    assert list(zip(tree.parent.tolist(), tree.source.tolist(), tree.p.tolist(), tree.times.tolist())) == [
        (-1, 0, 2, 8), (-1, 1, 3, 4), (-1, 1, 4, 1), (0, 1, 3, 7), (0, 2, 2, 1), (2, 2, 2, 1), (3, 2, 2, 2)]


def test_sums_beyond_64_bits_are_exact():
    big = np.array([10**18, 10**18, -5])
    assert sum(divergence._exact(big, np.array([10**6, 10**6, 1]))) == 2 * 10**24 - 5
    keys = np.array([0, 0, 1])
    assert dict(divergence._reduced(keys, divergence._exact(big, np.array([9, 9, 1])), 2)) == {0: 18 * 10**18, 1: -5}


# ---- mix as blocks, extra columns of the stages -------------------------------------

def test_mix_blocks_hold_what_the_report_counts(spark, edge_docs, no_docs):
    from collections import Counter
    got = mixing.mix_blocks(edge_docs, block_words=16, slots_per_shard=8).collect()
    report = mixing.mix_report(edge_docs, block_words=16, slots_per_shard=8).collect()
    assert sum(len(r.words) for r in got) == sum(r.taken for r in report)
    assert len({(r.source, r.slot) for r in got}) == len(got) and len({r.shard for r in got}) > 1
    by_source = Counter()
    for r in got:
        assert 1 <= len(r.words) <= 16
        by_source[r.source] += len(r.words)
    texts = {s: Counter(w for _, t, _, x, _ in ROWS if x == s for w in brute.words(t)) for s in by_source}
    for r in got:
        assert not Counter(r.words) - Counter({w: 16 * n for w, n in texts[r.source].items()})
    passes = Counter()
    for r in got:
        passes[r.source, r.pass_no, r.block] += 1
    assert set(passes.values()) == {1}                       # a pass reads a block once
    assert mixing.mix_blocks(no_docs).count() == 0


def test_slots_of_one_source_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_TASK_SLOTS", 1500)
    sizes = spark.createDataFrame([("one", 120_000)], "source string, size long")
    slots = mixing.draw_slots(mixing.source_targets(sizes), block_words=8, slots_per_shard=64)
    per_task = [r["count"] for r in slots.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per_task) >= 6 and max(per_task) < 0.4 * sum(per_task) and sum(per_task) == 15_000
    assert sorted(r.slot for r in slots.select("slot").collect()) == list(range(15_000))


def test_stages_return_clashing_columns_unchanged(spark, edge_docs, clash_docs):
    benchmark = spark.createDataFrame([(1, "the quick brown fox went over the hill and came back")], "item_id long, text string")
    for stage in (quality.passes, simhash.keep_one, lambda d: decontaminate.clean_documents(d, benchmark), mixing.mixed_documents):
        plain, extra = stage(edge_docs), stage(clash_docs)
        assert extra.columns == clash_docs.columns
        assert sorted(map(repr, extra.select(*edge_docs.columns).collect())) == sorted(map(repr, plain.collect()))
        added = [c for c in clash_docs.columns if c not in edge_docs.columns]
        assert {tuple(r) for r in extra.select(*added).distinct().collect()} <= {("clash",) * len(added)}
