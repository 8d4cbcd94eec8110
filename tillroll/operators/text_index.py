"""Inverted text index with impact levels, and exact pruned top-k search.

``build_text_index`` writes three tables: the documents' unit vectors (TF-IDF,
cosine), the postings of every token in blocks of one impact level with the
block's greatest weight, and the tokens with their IDF and best weights.

``search`` never meets a document that cannot be among the k best:

* Queries with the same known tokens and frequencies are one signature and are
  searched once.
* The k-th best weight of a token, times its weight in the query, is a score
  that k documents reach, and so is the k-th best exact score of the documents
  that are best for the query's tokens one by one: the largest of these is a
  floor for the k-th score.
* A document at or above the floor has a token that brings its share of it, and
  what the other tokens could add at most must fill the rest.  Both give the
  least weight of a posting worth reading, so only the levels from there up are
  joined, by (token, level), and blocks below it are left out.
* The candidates are scored exactly, ranked by (score, id).

The work follows the postings above the floor, not queries times documents.

Joins are sort-merge joins by hint: the planner takes exploded tokens and
compressed index files for as small as the files that they come from, and would
send them through the driver.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.rank import top_k_per_group
from tillroll.operators.similarity import SCORE_DECIMALS, TOKEN_SPREAD, tokens
from tillroll.session import work_dir

LEVELS = 8                 # impact levels of a doubling of the weight
BLOCK_ROWS = 4096          # postings of a block, about, at most
KEPT = 100                 # best weights that a token keeps (a larger k has no floor, only more candidates)
_SLACK = 10.0 ** -SCORE_DECIMALS       # scores are compared as rounded


class TextIndex(NamedTuple):
    """terms (token, idf, best, seeds, least), blocks (token, level, most, docs), vectors (did, vector).
    ``seeds`` are the documents of the weights in ``best``."""
    terms: DataFrame
    blocks: DataFrame
    vectors: DataFrame


def _level(weight: Column) -> Column:
    return F.floor(F.log2(weight) * LEVELS).cast("int")


def _dealt(rows: DataFrame, by: str, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a table of one row per key: a key's rows are dealt over
    ``TOKEN_SPREAD`` parts, and its one row goes to each of them."""
    spread = small.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(TOKEN_SPREAD - 1))))
    return (rows.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(TOKEN_SPREAD)).cast("int"))
            .join(spread.hint("merge"), [*on, "_part"], how).drop("_part"))


def build_text_index(docs: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", path: str | None = None) -> TextIndex:
    """Write the index of all documents with a text (default: a new folder under
    the shared checkpoint folder).  Tokens are lower-cased runs of letters and
    digits; idf = ln((1 + N) / (1 + df)) + 1 over the N documents with text."""
    spark = docs.sparkSession
    path = path or work_dir(spark, "text-index")
    d = docs.select(F.col(doc_id).alias("did"), F.col(doc_text).alias("text")).where("text is not null")
    n_docs = d.select(F.count("*")).scalar()
    tf = (d.select("did", tokens("text").alias("token")).where("token <> ''")
          .groupBy("did", "token").agg(F.count(F.lit(1)).alias("tf")))
    idf = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df")).select(
        "token", (F.log((n_docs + 1).cast("double") / (F.col("df") + 1).cast("double")) + 1.0).alias("idf"))
    weighted = _dealt(tf, "did", idf, ["token"]).select("did", "token", (F.col("tf") * F.col("idf")).alias("w"), "idf")
    norm = F.sqrt(F.aggregate("tw", F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))
    vectors = (weighted.groupBy("did").agg(F.array_sort(F.collect_list(F.struct("token", "w", "idf"))).alias("tw"))
               .withColumn("_norm", norm)
               .select("did", F.transform("tw", lambda x: F.struct(x["token"].alias("token"), (x["w"] / F.col("_norm")).alias("u"),
                                                                   x["idf"].alias("idf"))).alias("vector")))
    vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    vectors = spark.read.parquet(f"{path}/vectors")

    postings = vectors.select("did", F.inline("vector"))
    top = top_k_per_group(postings.select("token", "did", "u"), ["token"], [F.desc("u"), F.asc("did")], KEPT, out="_rank")
    best = top.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("_rank", "u", "did"))).alias("b")).select(
        "token", F.col("b.u").alias("best"), F.col("b.did").alias("seeds"))
    known = postings.groupBy("token").agg(F.max("idf").alias("idf"), F.min("u").alias("least"))
    known.join(best.hint("merge"), "token").write.mode("overwrite").parquet(f"{path}/terms")
    parts = F.greatest(F.lit(1), F.ceil(vectors.select(F.count("*")).scalar() / F.lit(BLOCK_ROWS)).cast("int"))
    (postings.groupBy("token", _level(F.col("u")).alias("level"), F.pmod(F.xxhash64("did"), parts).alias("_part"))
     .agg(F.max("u").alias("most"), F.collect_list(F.struct("did", "u")).alias("docs")).drop("_part")
     .write.mode("overwrite").parquet(f"{path}/blocks"))
    return open_text_index(spark, path)


def open_text_index(spark, path: str) -> TextIndex:
    return TextIndex(*[spark.read.parquet(f"{path}/{name}") for name in TextIndex._fields])


def signatures(queries: DataFrame, index: TextIndex, query_id: str, query_text: str) -> DataFrame:
    """(qid, sig, terms): the known tokens of every query that has one, with
    frequency, IDF and best weights; equal ``sig`` means equal known tokens."""
    tf = (queries.select(F.col(query_id).alias("qid"), tokens(query_text).alias("token")).where("token <> ''")
          .groupBy("qid", "token").agg(F.count(F.lit(1)).alias("tf")))
    known = _dealt(tf, "qid", index.terms.select("token"), ["token"])
    listed = known.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("token", "tf"))).alias("terms"))
    return listed.withColumn("sig", F.sha2(F.to_json("terms"), 256))


def _scored(pairs: DataFrame, weights: DataFrame, index: TextIndex) -> DataFrame:
    """(sig, did, score): exact scores of (sig, did).  The query's few weights
    travel to the documents' vectors, not the other way."""
    score = F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.coalesce(F.try_element_at("weights", x["token"]), F.lit(0.0)) * x["u"])
    return (pairs.join(weights.hint("merge"), "sig").join(index.vectors.hint("merge"), "did")
            .select("sig", "did", F.round(score, SCORE_DECIMALS).alias("score")))


def candidates(signature_terms: DataFrame, index: TextIndex, k: int) -> tuple[DataFrame, DataFrame]:
    """((sig, did) worth scoring, (sig, weights)) for distinct signatures (sig, terms)."""
    each = signature_terms.select("sig", F.inline("terms"))
    w = _dealt(each, "sig", index.terms, ["token"]).withColumn("w", F.col("tf") * F.col("idf"))
    best = F.col("best")
    # a k beyond the kept weights, or beyond the token's postings, gives no floor
    kth = F.when((F.size(best) >= k) & F.lit(k <= KEPT), F.get(best, F.lit(k - 1))).otherwise(0.0)
    listed = w.groupBy("sig").agg(F.collect_list(F.struct(
        "token", "w", "least", kth.alias("kth"), F.get(best, F.lit(0)).alias("top"),
        F.slice("seeds", 1, min(k, KEPT)).alias("seeds"))).alias("t"))
    norm = F.sqrt(F.aggregate("t", F.lit(0.0), lambda a, t: a + t["w"] * t["w"]))
    listed = listed.withColumn("_norm", norm).withColumn("t", F.transform("t", lambda t: F.struct(
        t["token"].alias("token"), (t["w"] / F.col("_norm")).alias("x"), t["least"].alias("least"), t["kth"].alias("kth"), t["top"].alias("top"), t["seeds"].alias("seeds"))))
    weights = listed.select("sig", F.map_from_entries(F.transform("t", lambda t: F.struct(t["token"], t["x"]))).alias("weights"))
    seeds = listed.select("sig", F.explode(F.array_distinct(F.flatten("t.seeds"))).alias("did"))       # k per token at most
    reached = _scored(seeds, weights, index).groupBy("sig").agg(F.sort_array(F.collect_list("score"), asc=False).alias("_s"))
    reached = reached.select("sig", F.get("_s", F.lit(k - 1)).alias("_reached"))                       # NULL: fewer than k
    listed = listed.withColumn("t", F.transform("t", lambda t: t.dropFields("seeds"))).join(reached.hint("merge"), "sig", "left")
    floor = F.array_max(F.transform("t", lambda t: t["x"] * t["kth"]))
    floor = F.greatest(floor, F.col("_reached")) - _SLACK                  # greatest skips NULL
    all_most = F.aggregate("t", F.lit(0.0), lambda a, t: a + t["x"] * t["top"])
    listed = listed.withColumn("_floor", floor).withColumn("_most", all_most).withColumn("_m", F.size("t"))
    least = F.greatest(F.col("_floor") / F.col("_m"), F.col("_floor") - F.col("_most") + F.col("x") * F.col("top")) / F.col("x")
    # divisions and products are rounded: a hair below the bound is still read
    wanted = (listed.select("sig", "_floor", "_most", "_m", F.inline("t")).withColumn("need", least * (1 - 1e-9))
              .where("need <= top")
              .withColumn("level", F.explode(F.sequence(_level(F.greatest("need", "least")), _level(F.col("top"))))))
    found = wanted.select("sig", "token", "level", "need").join(index.blocks.hint("merge"), ["token", "level"]).where("most >= need")
    read = found.select("sig", "need", F.inline("docs")).where("u >= need")
    return read.select("sig", "did").distinct(), weights


def search(queries: DataFrame, index: TextIndex, k: int = 5, query_id: str = "query_id", query_text: str = "text") -> DataFrame:
    """(query_id, doc_id, score, rank): the k best documents with a score above 0
    of every query, by (score descending, id); NULL and unknown texts have none."""
    asked = signatures(queries, index, query_id, query_text)
    distinct = asked.groupBy("sig").agg(F.first("terms").alias("terms"))
    pairs, weights = candidates(distinct, index, k)
    scored = _scored(pairs, weights, index).where("score > 0").withColumnRenamed("did", "doc_id")
    ranked = top_k_per_group(scored, ["sig"], [F.desc("score"), F.asc("doc_id")], k, out="rank")
    hits = ranked.groupBy("sig").agg(F.collect_list(F.struct("doc_id", "score", "rank")).alias("hits"))   # k at most
    return _dealt(asked.select("qid", "sig"), "qid", hits, ["sig"]).select(F.col("qid").alias("query_id"), F.inline("hits"))
