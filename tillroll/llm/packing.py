"""Token-id files with fixed-width bit packing.

File format: a folder of Parquet parts in ascending document order.  A row is
one block of whole documents: ``part`` and ``start`` (ids of the part before
the block) are the block offsets, ``n_ids`` the number of ids, ``width`` the
bits per id (the fewest that hold the vocabulary), ``packed`` the ids, least
significant bit first, id k at bit k * width, and ``doc_ids`` / ``doc_lens`` the
documents in order.  Since every id has the same width, any range of ids is cut
out of ``packed`` by arithmetic and unpacked at once with numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import byte_texts, text_key
from tillroll.llm.tokens import encode, vocabulary_size

END_ID = 1
BLOCK_IDS = 1 << 16     # a block closes with the document that brings it to this many ids


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0..vocabulary-1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids at ``width`` bits each, least significant bit first."""
    if width in (8, 16, 32):       # whole bytes: the same layout without bit work
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, first: int, n: int) -> np.ndarray:
    """Ids first .. first + n - 1 of a block (random access)."""
    if width in (8, 16, 32):
        return np.frombuffer(packed, f"<u{width // 8}", n, first * (width // 8)).astype(np.uint32)
    a, b = first * width, (first + n) * width
    bits = np.unpackbits(np.frombuffer(packed, np.uint8)[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + n * width]
    return (bits.reshape(n, width).astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1).astype(np.uint32)


def write_token_file(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     end_id: int = END_ID, block_ids: int = BLOCK_IDS, parts: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending
    id order (NULL ids first; equal ids by text key) to ``path``.

    NULL texts count as empty (one id, the end).  ``parts`` ranges of ids are
    written in parallel (default: spark.sql.shuffle.partitions); rows with equal
    ids are spread over ranges by their text, so no key fills a part.
    """
    spark = docs.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = bits_for(max(vocabulary_size(tokenizer_path), end_id + 1))
    src = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"),
                      F.monotonically_increasing_id().alias("nth"))
    ordered = src.repartitionByRange(n, "id", "key", "nth").sortWithinPartitions("id", "key", "nth").select("id", "text")
    id_type = src.schema["id"].dataType
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        start, size, ids, lens, parts_, kind = 0, 0, [], [], [], None

        def block():
            data = np.frombuffer(b"".join(parts_), "<u4")
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([len(data)], pa.int64()),
                pa.array([width], pa.int32()), pa.array([pack(data, width)], pa.binary()),
                pa.array([ids], pa.list_(kind)), pa.array([lens], pa.list_(pa.int64()))],
                names=["part", "start", "n_ids", "width", "packed", "doc_ids", "doc_lens"])

        for batch in batches:
            kind = batch.column("id").type
            for k in range(0, batch.num_rows, 500):
                b = batch.slice(k, 500)
                for i, x in zip(b.column("id").to_pylist(), encode(byte_texts(b), tokenizer_path)):
                    ids.append(i)
                    lens.append(len(x) // 4 + 1)
                    parts_ += [x, end]
                    size += lens[-1]
                    if size >= block_ids:
                        yield block()
                        start, size, ids, lens, parts_ = start + size, 0, [], [], []
        if ids:
            yield block()

    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("width", T.IntegerType()), T.StructField("packed", T.BinaryType()),
        T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("doc_lens", T.ArrayType(T.LongType()))])
    ordered.mapInArrow(run, schema).write.mode("overwrite").parquet(path)


def read_token_file(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of a token file: id, start (ids of all documents
    before it), n_tokens (with the end id), ids_crc32 (of the ids as little-
    endian unsigned 32-bit integers) and, if ``with_ids``, the ids themselves."""
    blocks = spark.read.parquet(path)
    # one row per part, as many as the writer had ranges
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = totals.select("part", F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(base), "part").select(
        (F.col("base") + F.col("start")).alias("start"), "n_ids", "width", "packed", "doc_ids", "doc_lens")
    id_type = blocks.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                ids = unpack(row["packed"].as_py(), row["width"].as_py(), 0, row["n_ids"].as_py()).astype("<u4")
                lens = np.array(row["doc_lens"].as_py(), np.int64)
                at = np.concatenate(([0], np.cumsum(lens)))
                cuts = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
                cols = [row["doc_ids"].values, pa.array(row["start"].as_py() + at[:-1]), pa.array(lens),
                        pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64())]
                if with_ids:
                    cols.append(pa.array([c.astype(np.int64).tolist() for c in cuts], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=["id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    fields = [T.StructField("id", id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    return placed.mapInArrow(run, T.StructType(fields))
