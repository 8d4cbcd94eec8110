"""Pruned search on the inverted index against scoring every pair."""

import random

import pytest

from tillroll.operators import text_index
from tillroll.operators.similarity import text_topk


def hits(df):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 6)) for r in df.collect())


def corpus(rng, docs, words):
    vocabulary = [f"w{k}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 12))) for _ in range(docs)]


@pytest.mark.parametrize("seed, words", [(0, 8), (1, 60), (2, 400)])
def test_equals_scoring_every_pair(spark, seed, words, monkeypatch):
    monkeypatch.setattr(text_index, "BLOCK_ROWS", 16)
    rng = random.Random(seed)
    texts = corpus(rng, 250, words)
    docs = spark.createDataFrame([*enumerate(texts + texts[:40]), (900, None), (901, ""), (902, " ,. ")], "doc_id long, text string")
    asked = corpus(rng, 60, words) + [None, "", "unknown words", "w0", "W0!", "w0 w0 w1 unknown"]
    queries = spark.createDataFrame([*enumerate(asked)], "query_id long, text string")
    index = text_index.build_text_index(docs)
    for k in (1, 5, 300):
        want = hits(text_topk(queries, docs, k))
        assert hits(text_index.search(queries, index, k)) == want
    one = text_index.signatures(queries, index, "query_id", "text").where("qid in (63, 64)").select("sig").distinct()
    assert one.count() == 1


def test_scored_pairs_follow_rare_tokens(spark):
    """A token of every document costs nothing once a rare one sets the floor."""
    rng = random.Random(3)
    names = [f"n{k}" for k in range(300)]
    texts = [f"common other {rng.choice(names)} {rng.choice(names)}" + " x" * rng.randrange(3) for _ in range(3000)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    queries = spark.createDataFrame([(k, f"common {n}") for k, n in enumerate(names)] + [(1000 + k, "common " * (k + 1)) for k in range(100)],
                                    "query_id long, text string")
    index = text_index.build_text_index(docs)
    asked = text_index.signatures(queries, index, "query_id", "text").groupBy("sig").agg({"terms": "first"}).toDF("sig", "terms")
    pairs, _ = text_index.candidates(asked, index, 5)
    assert pairs.count() < 0.02 * 400 * 3000
    assert hits(text_index.search(queries, index, 5)) == hits(text_topk(queries, docs, 5))
    empty = text_index.build_text_index(docs.limit(0))
    assert text_index.search(queries, empty, 5).count() == 0 and text_index.search(queries.limit(0), index, 5).count() == 0


def test_common_tokens_together_read_few_pairs(spark):
    """Two tokens of every document: the floor is what their best documents reach with both."""
    rng = random.Random(5)
    docs = spark.createDataFrame([(k, "made of " + " ".join(f"n{rng.randrange(40)}" for _ in range(rng.randrange(1, 9)))) for k in range(2000)],
                                 "doc_id long, text string")
    queries = spark.createDataFrame([(k, "made " * (k % 5 + 1) + "of " * (k // 5 + 1)) for k in range(25)], "query_id long, text string")
    index = text_index.build_text_index(docs)
    asked = text_index.signatures(queries, index, "query_id", "text").groupBy("sig").agg({"terms": "first"}).toDF("sig", "terms")
    pairs, _ = text_index.candidates(asked, index, 5)
    assert pairs.count() < 0.1 * 25 * 2000
    assert hits(text_index.search(queries, index, 5)) == hits(text_topk(queries, docs, 5))


def test_nothing_that_grows_is_broadcast(spark, tmp_path):
    """The planner takes exploded tokens for as small as the file of their texts."""
    words = [f"a{k % 7} b{k % 11} c{k % 13}" for k in range(500)]
    spark.createDataFrame([*enumerate(words)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    index = text_index.build_text_index(docs)
    found = text_index.search(docs.withColumnRenamed("doc_id", "query_id").where("query_id < 40"), index, 3)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 120
