"""Vector index: vectors in lists around k-means centres, searched list by list.

* ``build`` fits the centres with Spark's k-means (cosine) on a bounded sample,
  about ``TRAIN_PER_LIST`` distinct vectors for each of about √rows lists, then
  puts *every* vector into the list of its nearest centre.
* How many lists a search visits (``probes``) is measured, not guessed: at most
  ``CALIBRATION`` stored vectors are searched exactly, and the smallest number of
  lists that holds the wanted share of their true neighbours is stored with the
  index.  Clustered vectors need few lists, vectors without any structure many.
* ``search`` sends a query to its nearest lists only and scores it there exactly.
  A list's vectors are dealt into parts of about ``PART_ROWS`` and its queries
  into blocks, so a cell is bounded even if a third of all vectors are copies.
* ``same`` columns are compared inside the lists; a query that finds fewer than
  k partners in its lists visits all the others, so a filter never empties a
  result.

``similarity.vector_topk`` gives the exact result by scoring every pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.rank import top_k_per_group
from tillroll.operators.similarity import DOC_ROWS, QUERY_ROWS, _dense_cell, vector_topk
from tillroll.session import work_dir

MAX_LISTS = 4096           # centres reach every task: at most this many rows of one vector each
TRAIN_PER_LIST = 64        # sampled vectors a list that the centres are fitted on
CALIBRATION = 256          # stored vectors that the number of probes is measured on, about
CALIBRATION_K = 10
TARGET_RECALL = 0.95
PART_ROWS = DOC_ROWS


def has_direction(vec: str, dim: int) -> Column:
    """``dim`` finite numbers, not all zero: vectors that a cosine exists for."""
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) == dim) & whole & F.exists(vec, lambda x: x != 0), F.lit(False))


@dataclass
class VectorIndex:
    """Stored under ``path``: ``rows`` (id, vec, kept columns, list, deal),
    ``centres`` (list, centre) and ``meta`` (one row)."""
    spark: SparkSession
    path: str
    centres: np.ndarray
    probes: int

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def nearest(self, df: DataFrame, first: int, last: int) -> DataFrame:
        """``df`` (with ``vec``) once for each of its nearest lists ``first`` to
        ``last`` (from 0, ``last`` not included); ``near`` counts them."""
        centres, last = self.centres, min(last, len(self.centres))
        schema = T.StructType([*df.schema.fields, T.StructField("list", T.IntegerType()), T.StructField("near", T.IntegerType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, (1 << 17) // len(centres))         # bounds the scores and the repeated rows of a slice
            for batch in batches:
                for k in range(0, batch.num_rows, step):
                    b = batch.slice(k, step)
                    v = b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
                    near = v @ centres.T
                    order = np.argmax(near, axis=1)[:, None] if last == 1 else np.argsort(-near, axis=1, kind="stable")[:, first:last]
                    rows = pa.array(np.repeat(np.arange(len(v)), order.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [*[b.column(n).take(rows) for n in b.schema.names], pa.array(order.ravel().astype(np.int32)),
                         pa.array(np.tile(np.arange(first, first + order.shape[1], dtype=np.int32), len(v)))],
                        names=schema.names)

        return df.where(has_direction("vec", self.dim)).mapInArrow(run, schema)


def _fit(vectors: DataFrame, rows: int, lists: int, dim: int, seed: int) -> np.ndarray:
    every = max(1, rows // (lists * TRAIN_PER_LIST))
    sample = (vectors.where(F.pmod(F.xxhash64("did", F.lit(seed)), F.lit(every)) == 0).select("vec").distinct()
              .select(array_to_vector(F.col("vec").cast("array<double>")).alias("features")).persist())
    try:
        if lists < 2 or sample.count() < 2:
            return np.ones((1, dim))
        model = KMeans(k=lists, seed=seed, maxIter=10, distanceMeasure="cosine").fit(sample)
        centres = np.array(model.clusterCenters())
    finally:
        sample.unpersist()
    norms = np.linalg.norm(centres, axis=1, keepdims=True)
    return centres / np.where(norms == 0, 1, norms)


def build(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: list[str] = (), *,
          path: str | None = None, lists: int | None = None, target: float = TARGET_RECALL, seed: int = 11) -> VectorIndex:
    """Index all rows of ``vectors``; ``keep`` are columns to filter by.

    Rows whose vector is NULL, zero, not finite or of another length than most
    have no cosine and are in no list.  Equal ids and equal vectors are kept as
    often as they come.  An empty table gives an index without rows."""
    spark = vectors.sparkSession
    path = path or work_dir(spark, "vector-index")
    src = vectors.select(F.col(id_col).alias("did"), F.col(vec_col).alias("vec"), *keep)
    n, dim = src.agg(F.count(F.when(F.size("vec") > 0, 1)), F.mode(F.when(F.size("vec") > 0, F.size("vec")))).first()
    dim = dim or 1
    usable = src.where(has_direction("vec", dim))
    centres = _fit(usable, n, lists or min(MAX_LISTS, max(1, round(n ** 0.5))), dim, seed)
    index = VectorIndex(spark, path, centres, len(centres))
    # rows of one id are dealt apart, too: the place is drawn once and stored
    placed = (index.nearest(src, 0, 1).drop("near")
              .withColumn("deal", F.xxhash64("did", F.monotonically_increasing_id())))
    placed.repartitionByRange("list", "deal").sortWithinPartitions("list").write.mode("overwrite").parquet(f"{path}/rows")
    index.probes = _measure_probes(index, n, target, seed)
    spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centres)], "list int, centre array<double>").write.mode(
        "overwrite").parquet(f"{path}/centres")
    spark.createDataFrame([(index.probes, target)], "probes int, target double").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return index


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    centres = spark.read.parquet(f"{path}/centres").orderBy("list").collect()      # at most MAX_LISTS
    return VectorIndex(spark, path, np.array([r.centre for r in centres]), spark.read.parquet(f"{path}/meta").first().probes)


def _measure_probes(index: VectorIndex, n: int, target: float, seed: int) -> int:
    """Smallest number of lists that holds ``target`` of the true neighbours of
    the calibration vectors (their own row left out)."""
    every = max(1, n // CALIBRATION)
    asked = (index.rows.where(F.pmod(F.xxhash64("did", F.lit(seed + 1)), F.lit(every)) == 0)
             .select("did", "vec").dropDuplicates(["did"]))
    true = vector_topk(asked, index.rows, CALIBRATION_K + 1, id_col="did", vec_col="vec", query_id="did").where("query_id <> doc_id")
    of = index.rows.select(F.col("did").alias("doc_id"), "list").distinct()
    order = index.nearest(asked, 0, len(index.centres)).select(F.col("did").alias("query_id"), "list", "near")
    far = true.join(of, "doc_id").join(order, ["query_id", "list"]).agg(F.percentile("near", F.lit(float(target)))).first()[0]
    return 1 if far is None else min(len(index.centres), int(np.ceil(far)) + 1)


def _visit(index: VectorIndex, asked: DataFrame, first: int, last: int, k: int, same: list[str]) -> DataFrame:
    """Best k of every query in its lists ``first`` to ``last``."""
    probed = index.nearest(asked, first, last).drop("near")
    blocks = probed.groupBy("list").agg(F.ceil(F.count("*") / F.lit(QUERY_ROWS)).cast("int").alias("blocks"))
    parts = index.rows.groupBy("list").agg(F.ceil(F.count("*") / F.lit(PART_ROWS)).cast("int").alias("parts"))
    layout = F.broadcast(blocks.join(parts, "list"))                               # at most MAX_LISTS rows
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    q = (probed.join(layout, "list").withColumn("_blk", F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int"))
         .withColumn("_part", numbers("parts")).drop("blocks", "parts"))
    d = (index.rows.join(layout, "list").withColumn("_part", F.pmod("deal", F.col("parts")).cast("int"))
         .withColumn("_blk", numbers("blocks")).drop("blocks", "parts", "deal"))
    keys = ["list", "_part", "_blk", *same]
    out = T.StructType([T.StructField("query_id", asked.schema["qid"].dataType),
                        T.StructField("doc_id", index.rows.schema["did"].dataType), T.StructField("score", T.DoubleType())])
    found = q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInPandas(_dense_cell(k), out)
    return top_k_per_group(found, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, out="rank")


def search(queries: DataFrame, index: VectorIndex, k: int = 5, *, query_id: str = "vec_id", vec_col: str = "embedding",
           same: list[str] = (), probes: int | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank): the best k of each query's nearest
    ``probes`` lists (default: the number measured for the index).

    Scores are exact, ties go to the smaller id; with as many probes as there
    are lists the result is that of ``vector_topk``.  Queries without a
    direction find nothing; an empty side gives no rows."""
    probes = min(probes or index.probes, len(index.centres))
    same = list(same)
    asked = queries.select(F.col(query_id).alias("qid"), F.col(vec_col).alias("vec"), *same)
    hits = _visit(index, asked, 0, probes, k, same)
    if probes == len(index.centres):
        return hits
    path = work_dir(index.spark, "vector-hits")
    hits.write.mode("overwrite").parquet(path)
    hits = index.spark.read.schema(hits.schema).parquet(path)
    full = hits.where(F.col("rank") == k).select(F.col("query_id").alias("qid"))
    rest = _visit(index, asked.join(full, "qid", "left_anti"), probes, len(index.centres), k, same)
    return top_k_per_group(hits.unionByName(rest).drop("rank"), ["query_id"], [F.desc("score"), F.asc("doc_id")], k, out="rank")
