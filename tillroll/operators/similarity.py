"""Exact top-k similarity search as a blocked Spark job.

The queries are a frame of their own: they are hashed into ``query_blocks``
blocks and the documents into ``doc_buckets`` buckets; each (block, bucket) cell
is one cogroup group that scores its queries against its documents with numpy
and keeps only the k best per query.  A final ``row_number() ≤ k`` per query
merges the candidates.

* Documents travel ``query_blocks`` times, queries ``doc_buckets`` times; a cell
  holds |queries| / query_blocks queries and |documents| / doc_buckets documents.
  Without given numbers, blocks have about ``QUERY_ROWS`` queries and buckets
  about ``DOC_ROWS`` documents, counted in the plan itself, so a cell's matrix is
  bounded however large both tables are, and a query's candidates (k a bucket)
  do not follow the number of partitions.  The numbers change the cost, never
  the rows.
* ``same`` columns (metadata equality filters such as label) become extra
  cogroup keys, so a query only ever meets documents of its own group.
* Ties are broken by document id, inside the cell and in the merge, so the
  result is exact and deterministic.
* No job runs while the plan is built.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillroll.operators.rank import top_k_per_group

SCORE_DECIMALS = 6
#: Mean queries of a block and documents of a bucket at most: a matrix of 32 MB.
QUERY_ROWS = 1024
DOC_ROWS = 4096


def _best_k(scores: np.ndarray, qids: np.ndarray, dids: np.ndarray, k: int,
            min_score: float | None, chunk: int = 256) -> pd.DataFrame:
    """Top-k rows of each query column of ``scores`` (n_docs × n_queries),
    ordered by (score desc, doc id asc).  Vectorised and linear: documents
    are put in id order once; per chunk of queries the k-th best score comes
    from ``np.partition``, all better scores are kept plus the lowest-id ties
    (a running count in id order), so the cut is exact without a full sort."""
    empty = pd.DataFrame({"query_id": pd.Series([], dtype="object"), "doc_id": pd.Series([], dtype="object"),
                          "score": pd.Series([], dtype="float64")})
    if scores.size == 0:
        return empty
    by_id = np.argsort(dids, kind="stable")
    scores, dids = scores[by_id], dids[by_id]
    n = scores.shape[0]
    kk = min(k, n)
    out_q, out_d, out_s = [], [], []
    for c0 in range(0, scores.shape[1], chunk):
        block = scores[:, c0:c0 + chunk]
        valid = ~np.isnan(block)
        if min_score is not None:
            valid &= block > min_score
        neg = np.where(valid, -block, np.inf)
        # kth best value per query (linear selection), then: everything strictly
        # better, plus the lowest-id ties (documents are in id order) up to k
        kth = np.partition(neg, kk - 1, axis=0)[kk - 1]
        better = neg < kth
        ties = (neg == kth) & valid
        need = kk - better.sum(axis=0)
        take = better | (ties & (np.cumsum(ties, axis=0) <= need))
        take &= valid
        di, qi = np.nonzero(take)
        order = np.lexsort((di, neg[di, qi], qi))          # per query: score desc, id asc
        di, qi = di[order], qi[order]
        out_q.append(qids[c0:c0 + chunk][qi])
        out_d.append(dids[di])
        out_s.append(block[di, qi])
    if not out_q:
        return empty
    return pd.DataFrame({"query_id": np.concatenate(out_q), "doc_id": np.concatenate(out_d),
                         "score": np.concatenate(out_s)})


def _dense_cell(k: int):
    def run(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if q.empty or d.empty:
            return _best_k(np.zeros((0, 0)), np.array([]), np.array([]), k, None)
        qm = np.vstack([np.asarray(v, dtype=np.float64) for v in q["vec"]])
        dm = np.vstack([np.asarray(v, dtype=np.float64) for v in d["vec"]])
        qn = np.linalg.norm(qm, axis=1)
        dn = np.linalg.norm(dm, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = (dm @ qm.T) / np.outer(dn, qn)
        s[~np.isfinite(s)] = np.nan
        s = np.round(s, SCORE_DECIMALS)
        return _best_k(s, q["qid"].to_numpy(), d["did"].to_numpy(), k, None)
    return run


VOCAB_CHUNK = 2048


def _sparse_cell(k: int, vocab_chunk: int = VOCAB_CHUNK):
    """Token-weight vectors: only tokens present on both sides matter.  The
    score matrix (docs × queries) is accumulated over chunks of the shared
    vocabulary, so memory stays bounded by block sizes × chunk width even
    for long texts with large vocabularies."""
    def run(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if q.empty or d.empty:
            return _best_k(np.zeros((0, 0)), np.array([]), np.array([]), k, 0.0)
        q_tok = q[["qid", "tokens", "weights"]].explode(["tokens", "weights"]).dropna(subset=["tokens"])
        d_tok = d[["did", "tokens", "weights"]].explode(["tokens", "weights"]).dropna(subset=["tokens"])
        common = pd.Index(q_tok["tokens"].unique()).intersection(d_tok["tokens"].unique())
        if len(common) == 0:
            return _best_k(np.zeros((0, 0)), np.array([]), np.array([]), k, 0.0)
        q_tok = q_tok[q_tok["tokens"].isin(common)]
        d_tok = d_tok[d_tok["tokens"].isin(common)]
        qpos = pd.Index(q["qid"]).get_indexer(q_tok["qid"])
        dpos = pd.Index(d["did"]).get_indexer(d_tok["did"])
        qti = common.get_indexer(q_tok["tokens"])
        dti = common.get_indexer(d_tok["tokens"])
        qw = q_tok["weights"].astype(float).to_numpy()
        dw = d_tok["weights"].astype(float).to_numpy()
        dots = np.zeros((len(d), len(q)))
        for c0 in range(0, len(common), vocab_chunk):
            width = min(vocab_chunk, len(common) - c0)
            mq = (qti >= c0) & (qti < c0 + width)
            md = (dti >= c0) & (dti < c0 + width)
            if not mq.any() or not md.any():
                continue
            qm = np.zeros((len(q), width))
            dm = np.zeros((len(d), width))
            np.add.at(qm, (qpos[mq], qti[mq] - c0), qw[mq])
            np.add.at(dm, (dpos[md], dti[md] - c0), dw[md])
            dots += dm @ qm.T
        with np.errstate(divide="ignore", invalid="ignore"):
            s = dots / np.outer(d["norm"].to_numpy(float), q["norm"].to_numpy(float))
        s[~np.isfinite(s)] = np.nan
        s = np.round(s, SCORE_DECIMALS)
        return _best_k(s, q["qid"].to_numpy(), d["did"].to_numpy(), k, 0.0)
    return run


def cells(queries: DataFrame, docs: DataFrame, query_blocks, doc_buckets) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cell keys (identically typed, so the two halves of
    a cell hash to the same partition); the numbers are ints or scalar columns."""
    def place(df, key, own, n, other, m):
        df = df.withColumn("_m", m if isinstance(m, Column) else F.lit(m)).withColumn("_n", n if isinstance(n, Column) else F.lit(n))
        return (df.withColumn(own, F.pmod(F.xxhash64(key), F.col("_n")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_m").cast("int") - 1))).drop("_m", "_n"))
    return (place(queries, "qid", "_blk", query_blocks, "_bkt", doc_buckets),
            place(docs, "did", "_bkt", doc_buckets, "_blk", query_blocks))


def parts_of(df: DataFrame, rows: int) -> Column:
    """Parts of about ``rows`` rows, one at least: a scalar of the plan."""
    return F.greatest(F.lit(1), F.ceil(df.select(F.count("*")).scalar() / F.lit(rows)).cast("int"))


def blocked_topk(queries: DataFrame, docs: DataFrame, k: int, cell, same: list[str] = (),
                 query_blocks: int | Column | None = None, doc_buckets: int | Column | None = None) -> DataFrame:
    """Generic exact top-k: ``queries`` has ``qid`` + payload, ``docs`` has
    ``did`` + payload (same payload schema); returns (query_id, doc_id,
    score, rank).  ``query_blocks`` defaults to blocks of ``QUERY_ROWS``,
    ``doc_buckets`` to buckets of ``DOC_ROWS``."""
    if query_blocks is None:
        query_blocks = parts_of(queries, QUERY_ROWS)
    if doc_buckets is None:
        doc_buckets = parts_of(docs, DOC_ROWS)
    q, d = cells(queries, docs, query_blocks, doc_buckets)
    keys = ["_blk", "_bkt", *same]
    out_schema = StructType([StructField("query_id", queries.schema["qid"].dataType),
                             StructField("doc_id", docs.schema["did"].dataType),
                             StructField("score", DoubleType())])
    cands = q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInPandas(cell, out_schema)
    return top_k_per_group(cands, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, out="rank")


def vector_topk(queries: DataFrame, vectors: DataFrame, k: int = 5, *, id_col: str = "vec_id",
                vec_col: str = "embedding", query_id: str = "vec_id", filters: dict | None = None,
                same: list[str] = (), **block) -> DataFrame:
    """Cosine top-k of every query vector over ``vectors``.

    ``filters`` = {column: value or list} restricts the searched vectors
    (pushed down as a plain filter); ``same`` = columns whose value must equal
    the query's own (per-query metadata filter, done by co-grouping)."""
    v = vectors
    for col, val in (filters or {}).items():
        v = v.filter(F.col(col).isin(*val) if isinstance(val, (list, tuple, set)) else F.col(col) == val)
    qq = queries.select(F.col(query_id).alias("qid"), F.col(vec_col).alias("vec"), *same)
    dv = v.select(F.col(id_col).alias("did"), F.col(vec_col).alias("vec"), *same)
    return blocked_topk(qq, dv, k, _dense_cell(k), same, **block)


TOKEN_SPREAD = 16      # parts that the documents of one token are dealt over
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text_col: str):
    return F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT))


def text_topk(queries: DataFrame, docs: DataFrame, k: int = 5, *, query_id: str = "query_id",
              query_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text",
              filters: dict | None = None, vocab_chunk: int = VOCAB_CHUNK, **block) -> DataFrame:
    """TF-IDF cosine top-k of every query text over the document texts.

    Tokens: lower-cased runs of letters/digits.  idf = ln((1+N)/(1+df)) + 1
    over the searched documents (N documents with text); weight = tf·idf;
    query tokens unknown to the corpus weigh 0.  Only scores > 0 count."""
    d = docs
    for col, val in (filters or {}).items():
        d = d.filter(F.col(col).isin(*val) if isinstance(val, (list, tuple, set)) else F.col(col) == val)
    d = d.filter(F.col(doc_text).isNotNull())
    n_docs = d.select(F.count("*")).scalar()
    dtf = (d.select(F.col(doc_id).alias("did"), tokens(doc_text).alias("token"))
           .filter(F.col("token") != "").groupBy("did", "token").agg(F.count(F.lit(1)).alias("tf")))
    idf = (dtf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
           .select("token", (F.log((n_docs + 1).cast("double") / (F.col("df") + 1).cast("double")) + 1.0)
                   .alias("idf")))
    # A token of every text would bring all documents to one task: each token's
    # weight is dealt to TOKEN_SPREAD parts and meets its documents there.
    spread = idf.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(TOKEN_SPREAD - 1))))
    dw = (dtf.withColumn("_part", F.pmod(F.xxhash64("did"), F.lit(TOKEN_SPREAD)).cast("int"))
          .join(spread, ["token", "_part"]).select("did", "token", (F.col("tf") * F.col("idf")).alias("w")))
    qtf = (queries.select(F.col(query_id).alias("qid"), tokens(query_text).alias("token"))
           .filter(F.col("token") != "").groupBy("qid", "token").agg(F.count(F.lit(1)).alias("tf")))
    qw = qtf.join(idf, "token").withColumn("w", F.col("tf") * F.col("idf"))

    def vecs(df, key):
        return (df.groupBy(key).agg(
            F.collect_list(F.struct("token", "w")).alias("tw"),
            F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
            .select(key, F.col("tw.token").alias("tokens"), F.col("tw.w").alias("weights"), "norm"))

    # counted on the tables, not on the token vectors made of them
    block = {"query_blocks": None, "doc_buckets": None} | block
    if block["query_blocks"] is None:
        block["query_blocks"] = parts_of(queries, QUERY_ROWS)
    if block["doc_buckets"] is None:
        block["doc_buckets"] = parts_of(d, DOC_ROWS)
    return blocked_topk(vecs(qw, "qid"), vecs(dw, "did"), k, _sparse_cell(k, vocab_chunk), **block)
