"""Vector index against scoring every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.operators import vector_index
from tillroll.operators.similarity import vector_topk
from tillroll.registry import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def hits(df):
    return {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in df.collect()}


def recall(got, want, k):
    found = {}
    for (q, _), (d, _s) in got.items():
        found.setdefault(q, set()).add(d)
    return sum(d in found.get(q, ()) for (q, r), (d, _s) in want.items() if r <= k) / len(want)


def clustered(rng, n, centres=20, dim=16):
    around = rng.normal(size=(centres, dim))
    return around[rng.integers(0, centres, n)] + 0.15 * rng.normal(size=(n, dim))


def test_all_lists_equal_every_pair_and_few_reach_the_recall(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "PART_ROWS", 100)          # lists in several parts
    monkeypatch.setattr(vector_index, "QUERY_ROWS", 7)           # and several blocks
    rng = np.random.default_rng(5)
    x = clustered(rng, 1200)
    x[400:800] = x[0]                                            # a third are copies
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)]
    odd = [(5000, None, 0), (5001, [0.0] * 16, 0), (5002, [1.0], 1), (5003, [float("nan")] * 16, 1), (3, x[3].tolist(), 0)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    index = vector_index.build(df, keep=["label"])
    assert index.rows.count() == 1201 and index.rows.where("did >= 5000").count() == 0
    clean = df.where("vec_id < 5000")
    asked = df.where("vec_id % 50 = 0 or vec_id >= 5000")
    want = hits(vector_topk(clean.where("vec_id % 50 = 0"), clean, 5))
    assert hits(vector_index.search(asked, index, 5, probes=len(index.centres))) == want
    assert index.probes < len(index.centres) / 2
    assert recall(hits(vector_index.search(asked, index, 5)), want, 5) >= 0.9
    again = vector_index.open_index(spark, index.path)
    assert again.probes == index.probes and np.allclose(again.centres, index.centres)
    assert hits(vector_index.search(asked, again, 5, probes=2)) == hits(vector_index.search(asked, index, 5, probes=2))


def test_a_filter_never_empties_a_result(spark):
    """Partners of a rare label lie in far lists: they are found there."""
    rng = np.random.default_rng(6)
    x = clustered(rng, 600)
    rows = [(i, v.tolist(), 1 if i % 100 == 0 else 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    index = vector_index.build(df, keep=["label"])
    rare = df.where("label = 1")
    want = hits(vector_topk(rare, df, 5, same=["label"]))
    assert len(want) == 30
    assert hits(vector_index.search(rare, index, 5, same=["label"], probes=1)).keys() == want.keys()
    assert hits(vector_index.search(rare, index, 6, same=["label"], probes=1)) == hits(vector_topk(rare, df, 6, same=["label"]))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny_tables(spark, n):
    df = spark.createDataFrame([(i, [1.0, float(i)], 0) for i in range(n)], SCHEMA)
    index = vector_index.build(df)
    assert vector_index.search(df, index, 3).count() == n * n
    assert vector_index.search(df.limit(0), index, 3).count() == 0


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    index = vector_index.build(df)
    asked = df.where(F.col("vec_id") % 50 == 0)
    assert index.rows.count() == df.count()
    assert recall(hits(vector_index.search(asked, index, 5)), hits(vector_topk(asked, df, 5)), 5) >= 0.9


def test_registered_search(spark):
    got, want = (QUERIES[name](spark, SF_SMALL).withColumnRenamed("vec_id", "doc_id") for name in ("vector_index_topk", "vector_topk"))
    assert got.columns == want.columns and recall(hits(got), hits(want), 5) >= 0.9
