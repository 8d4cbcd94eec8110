"""Operators against brute force on small hand-made frames."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import rank, similarity, upsert


def test_percent_rank_global_matches_window(spark):
    rnd = random.Random(7)
    vals = [None, None] + [float(rnd.randint(0, 20)) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {r.id: r.p for r in rank.percent_rank_global(df, "v", out="p", num_partitions=5).collect()}
    exp = {r.id: r.p for r in df.select("id", F.percent_rank().over(
        Window.orderBy(F.col("v").asc_nulls_first())).alias("p")).collect()}
    assert got == exp


def test_percent_rank_single_row(spark):
    df = spark.createDataFrame([(1, 5.0)], "id long, v double")
    assert rank.percent_rank_global(df, "v", out="p").first().p == 0.0


def test_row_number_in_groups_matches_window(spark):
    rnd = random.Random(3)
    # one hot group with most rows, NULL group, small groups
    rows = [(i, "hot" if i % 3 else rnd.choice(["a", "b", None]), rnd.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    got = {r.id: r.rn for r in rank.row_number_in_groups(
        df, ["g"], [F.col("x").asc(), F.col("id").asc()], out="rn", num_partitions=7).collect()}
    exp = {r.id: r.rn for r in df.select("id", F.row_number().over(
        Window.partitionBy("g").orderBy("x", "id")).alias("rn")).collect()}
    assert got == exp


def test_keyed_upsert_semantics_and_idempotence(spark):
    t = spark.createDataFrame([(1, "keep", 10), (2, "old", 20)], "k long, name string, v int")
    u = spark.createDataFrame([(2, "new", 21), (3, "ins", 30)], "k long, name string, v int")
    once = upsert.keyed_upsert(t, u, ["k"], ["v"])
    twice = upsert.keyed_upsert(once, u, ["k"], ["v"])
    a = sorted(map(tuple, once.collect()))
    assert a == [(1, "keep", 10), (2, "old", 21), (3, "ins", 30)]
    assert sorted(map(tuple, twice.collect())) == a


def test_insert_if_absent_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a")], "k long, v string")
    n = spark.createDataFrame([(1, "changed"), (2, "b")], "k long, v string")
    once = upsert.insert_if_absent(t, n, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "b")]
    assert sorted(map(tuple, upsert.insert_if_absent(once, n, ["k"]).collect())) == [(1, "a"), (2, "b")]


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (4, "d")], "k long, v string")
    got = sorted(map(tuple, upsert.snapshot_diff(old, new, ["k"]).collect()))
    assert got == [(2, "update", "B"), (3, "update", "c"), (4, "insert", "d")]
    back = sorted(map(tuple, upsert.snapshot_diff(new, old, ["k"]).collect()))
    assert back == [(2, "update", "b"), (3, "update", None), (4, "delete", "d")]


def test_state_violations(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, None), (None, "z"), (2, "w")], "k long, v string")
    got = {r.constraint_name: r.violations for r in upsert.state_violations(df, "t", ["k"], ["v"]).collect()}
    assert got == {"primary key (k) unique": 2, "primary key (k) not null": 1, "v not null": 1}


def _brute_cos(q, d, k):
    out = {}
    for qi, qv in q.items():
        scores = []
        for di, dv in d.items():
            s = float(np.dot(qv, dv) / (np.linalg.norm(qv) * np.linalg.norm(dv)))
            scores.append((-round(s, 6), di))
        out[qi] = [di for _, di in sorted(scores)[:k]]
    return out


def test_vector_topk_blocked_equals_brute_force(spark):
    rnd = np.random.default_rng(5)
    vecs = {i: rnd.normal(size=8).round(2) for i in range(120)}
    labels = {i: i % 3 for i in vecs}
    df = spark.createDataFrame([(i, [float(x) for x in v], labels[i]) for i, v in vecs.items()],
                               "vec_id long, embedding array<float>, label int")
    vec32 = {i: np.asarray(v, dtype=np.float32).astype(np.float64) for i, v in vecs.items()}
    # tiny blocks force many (block, bucket) cells
    got = similarity.vector_topk(df, df, 4, query_blocks=7, doc_buckets=4)
    g = {}
    for r in got.orderBy("query_id", "rank").collect():
        g.setdefault(r.query_id, []).append(r.doc_id)
    assert g == _brute_cos(vec32, vec32, 4)
    # metadata filters: static and per-query (same label)
    got_f = similarity.vector_topk(df, df, 3, filters={"label": [0, 1]}, same=["label"], query_blocks=3, doc_buckets=5)
    for r in got_f.collect():
        assert labels[r.doc_id] == labels[r.query_id] and labels[r.doc_id] in (0, 1)
    exp_f = _brute_cos({i: v for i, v in vec32.items() if labels[i] == 0},
                       {i: v for i, v in vec32.items() if labels[i] == 0}, 3)
    gf = {}
    for r in got_f.orderBy("query_id", "rank").collect():
        if labels[r.query_id] == 0:
            gf.setdefault(r.query_id, []).append(r.doc_id)
    assert gf == exp_f


def test_cells_stay_bounded_as_both_tables_grow(spark, monkeypatch):
    monkeypatch.setattr(similarity, "QUERY_ROWS", 50, raising=False)
    monkeypatch.setattr(similarity, "DOC_ROWS", 20, raising=False)
    q = spark.range(1000).select(F.col("id").alias("qid"))
    d = spark.range(600).select(F.col("id").alias("did"))

    def cell(q, d):
        import pandas as pd
        return pd.DataFrame({"query_id": q["qid"], "doc_id": len(d), "score": float(len(q))})

    got = similarity.blocked_topk(q, d, 10_000, cell)
    most = got.agg(F.max("score"), F.max("doc_id"), F.count_distinct("query_id")).first()
    assert most[0] <= 100 and most[1] <= 50 and most[2] == 1000
    texts = spark.range(300).select(F.col("id").alias("query_id"), F.concat_ws(
        " ", F.concat(F.lit("a"), F.col("id") % 7), F.concat(F.lit("b"), F.col("id") % 11)).alias("text"))
    docs = texts.where("query_id % 3 = 0").withColumnRenamed("query_id", "doc_id")
    one = similarity.text_topk(texts, docs, 3, query_blocks=1, doc_buckets=1)
    assert sorted(map(tuple, similarity.text_topk(texts, docs, 3).collect())) == sorted(map(tuple, one.collect()))


def test_text_topk_equals_brute_force(spark):
    docs = [(1, "red shoe for running"), (2, "blue shoe"), (3, "red red hat"), (4, None), (5, "green coat")]
    qs = [(10, "Red shoe!"), (11, "coat coat"), (12, "nothing matches"), (13, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(qs, "query_id long, text string")
    got = similarity.text_topk(q, d, 2, query_blocks=2, doc_buckets=3)
    res = {}
    for r in got.orderBy("query_id", "rank").collect():
        res.setdefault(r.query_id, []).append((r.doc_id, r.score))
    # brute force
    import re
    from collections import Counter
    toks = {i: [t for t in re.split(r"[^\w]+", s.lower()) if t] for i, s in docs if s is not None}
    n = len(toks)
    df = Counter(t for ts in toks.values() for t in set(ts))
    idf = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in df.items()}

    def vec(ts):
        c = Counter(t for t in ts if t in idf)
        return {t: v * idf[t] for t, v in c.items()}

    exp = {}
    for qi, s in qs:
        qv = vec([t for t in re.split(r"[^\w]+", s.lower()) if t])
        scored = []
        for di, ts in toks.items():
            dv = vec(ts)
            dot = sum(w * dv.get(t, 0.0) for t, w in qv.items())
            if dot > 0:
                sc = round(dot / (math.sqrt(sum(w * w for w in qv.values())) *
                                  math.sqrt(sum(w * w for w in dv.values()))), 6)
                scored.append((-sc, di))
        if scored:
            exp[qi] = [(di, -s) for s, di in sorted(scored)[:2]]
    assert res == exp


def test_apply_changes_rebuilds_new_snapshot(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k long, v string")
    diff = upsert.snapshot_diff(old, new, ["k"])
    got = sorted(map(tuple, upsert.apply_changes(old, diff, ["k"]).collect()))
    assert got == sorted(map(tuple, new.collect()))


def test_text_topk_vocab_chunks_do_not_change_results(spark):
    from tillroll.operators import similarity as sim
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(12))) for i in range(60)],
                                 "doc_id long, text string")
    qs = spark.createDataFrame([(100 + i, " ".join(f"w{(i * 3 + j) % 50}" for j in range(5))) for i in range(15)],
                               "query_id long, text string")
    base = sorted(map(tuple, sim.text_topk(qs, docs, 3).collect()))
    chunked = sorted(map(tuple, sim.text_topk(qs, docs, 3, vocab_chunk=4).collect()))
    assert chunked == base


def test_similarity_with_string_ids(spark):
    docs = spark.createDataFrame([("PRD-1", "red shoe"), ("PRD-2", "blue shoe"), ("PRD-3", "green hat")],
                                 "doc_id string, text string")
    qs = spark.createDataFrame([("Q-1", "red shoe"), ("Q-2", "nothing")], "query_id string, text string")
    got = sorted((r.query_id, r.doc_id, r.rank) for r in similarity.text_topk(qs, docs, 2).collect())
    assert got == [("Q-1", "PRD-1", 1), ("Q-1", "PRD-2", 2)]
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0])],
                                "vec_id string, embedding array<float>")
    top = sorted((r.query_id, r.doc_id) for r in similarity.vector_topk(vec, vec, 1).collect())
    assert top == [("a", "a"), ("b", "b"), ("c", "c")]


def test_topk_exact_when_cells_spread_over_partitions(spark):
    """With AQE coalescing off, cells land in many partitions; both halves of
    every cell must still meet (regression: differently typed cell keys)."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rnd = np.random.default_rng(11)
        vecs = {i: rnd.normal(size=6).round(2) for i in range(90)}
        df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vecs.items()],
                                   "vec_id long, embedding array<float>")
        vec32 = {i: np.asarray(v, dtype=np.float32).astype(np.float64) for i, v in vecs.items()}
        got = {}
        for r in similarity.vector_topk(df, df, 3, query_blocks=5, doc_buckets=9).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.doc_id)
        assert got == _brute_cos(vec32, vec32, 3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_similarity_blocks_change_the_rows_shipped_not_the_result(spark):
    rnd = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(x) for x in rnd.normal(size=4)]) for i in range(60)], "vec_id long, embedding array<float>")
    few = df.where("vec_id % 20 = 0")
    base = sorted(map(tuple, similarity.vector_topk(few, df, 4).collect()))
    assert len(base) == 12
    q = few.select(F.col("vec_id").alias("qid"))
    d = df.select(F.col("vec_id").alias("did"))
    for blocks, buckets in ((1, 1), (1, 6), (3, 4)):
        assert sorted(map(tuple, similarity.vector_topk(few, df, 4, query_blocks=blocks, doc_buckets=buckets).collect())) == base
        qc, dc = similarity.cells(q, d, blocks, buckets)
        assert (qc.count(), dc.count()) == (3 * buckets, 60 * blocks)      # one block: every document travels once


def test_keyed_writes_with_null_and_repeated_keys(spark):
    kind = "a long, b string, v int, w string"
    t = spark.createDataFrame([(1, None, 10, "x"), (1, "p", 11, "x"), (None, None, 12, "x")], kind)
    u = spark.createDataFrame([(1, None, 20, "y"), (None, None, 21, "y"), (2, None, 22, "y")], kind)
    keys = ["a", "b"]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    up = upsert.keyed_upsert(t, u, keys, ["v"])
    assert rows(up) == sorted([(1, None, 20, "x"), (1, "p", 11, "x"), (None, None, 21, "x"), (2, None, 22, "y")], key=str)
    twice = u.unionByName(u.withColumn("v", F.col("v") + 100))
    with pytest.raises(Exception, match="key occurs more than once"):
        upsert.keyed_upsert(t, twice, keys, ["v"]).collect()
    last = upsert.keyed_upsert(t, twice, keys, ["v"], order_by=["v"])
    assert rows(last) == sorted([(1, None, 120, "x"), (1, "p", 11, "x"), (None, None, 121, "x"), (2, None, 122, "y")], key=str)
    ins = upsert.insert_if_absent(t, twice, keys)
    assert len(rows(ins)) == 4 and rows(upsert.insert_if_absent(ins, twice, keys)) == rows(ins)
    assert upsert.snapshot_diff(t, t, keys).count() == 0
    diff = upsert.snapshot_diff(t, up, keys)
    assert sorted(r.change for r in diff.collect()) == ["insert", "update", "update"]
    assert rows(upsert.apply_changes(t, diff, keys)) == rows(up)
    assert rows(upsert.apply_changes(up, upsert.snapshot_diff(up, t, keys), keys)) == rows(t)


def test_diff_tells_values_with_separators_apart(spark):
    old = spark.createDataFrame([(1, "a\u0001b", "c")], "k long, x string, y string")
    new = spark.createDataFrame([(1, "a", "b\u0001c")], "k long, x string, y string")
    assert [r.change for r in upsert.snapshot_diff(old, new, ["k"]).collect()] == ["update"]


def test_searchable_versions_follow_the_catalog(spark):
    from tests.conftest import SF_SMALL
    from tillroll.plans import search
    from tillroll.sources.adapters import Retail
    p = Retail(spark, SF_SMALL).products.where("product_id < 20")
    v1, feed = search.searchable_version(None, p.where("product_id < 15"))
    assert {r.change for r in feed.collect()} == {"insert"} and v1.count() == 15
    v2, feed = search.searchable_version(v1, p.where("product_id >= 5").withColumn("price", F.when(F.col("product_id") == 7, 0.0).otherwise(F.col("price"))))
    assert sorted((r.change, r.product_id) for r in feed.collect()) == sorted(
        [("delete", k) for k in range(5)] + [("insert", k) for k in range(15, 20)] + [("update", 7)])
    assert sorted(r.product_id for r in v2.collect()) == list(range(5, 20))


def test_state_defaults(spark):
    from tillroll.plans import schemas
    rows = schemas.with_defaults(spark.createDataFrame([("o1", 1, "C")], "offer_id string, customer_id long, offer_code string"),
                                 "personalized_offers").first()
    assert (rows.status, rows.offer_type, rows.relevance_score) == ("active", "recommendation", 0.0)
    loyal = schemas.with_defaults(spark.createDataFrame([(1, None, None)], "customer_id long, loyalty_tier string, churn_risk_level string"),
                                  "loyalty_status")
    assert (loyal.first().loyalty_tier, loyal.first().churn_risk_level, loyal.first().points_balance) == ("Bronze", "Low", 0)
    assert all(r.violations == 0 for r in schemas.audit(loyal, "loyalty_status").collect())


def test_scratch_folder_must_be_shared_off_local_mode():
    from types import SimpleNamespace
    from tillroll import session
    conf = SimpleNamespace(get=lambda k, d=None: None, set=lambda k, v: None)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(SimpleNamespace(conf=conf, sparkContext=context))
    context.master = "local[2]"
    assert session.checkpoint_root(SimpleNamespace(conf=conf, sparkContext=context))
