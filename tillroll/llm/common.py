"""Shared pieces of the training-data operators: text rules, scratch tables."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import work_dir

#: Java-regex classes of the contracts' word rule (ASCII white space separates).
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def count_words(c: Column) -> Column:
    """Number of words in a text; NULL counts as an empty text."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def id_crc_mod(c: Column, m: int) -> Column:
    """crc32 of the id's text form, modulo ``m`` (a NULL id as the empty text)."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % m


def text_key(c: Column) -> Column:
    """64-bit key of a text; together with the id it names a document row."""
    return F.xxhash64(F.coalesce(c, F.lit("")), c.isNull())


def free_prefix(df: DataFrame) -> str:
    """A beginning that no column of ``df`` has, for inner columns beside them."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors, and is column-pruned on read."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes; NULL becomes the empty text."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def with_columns(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    """The batch's ``keep`` columns followed by new ones."""
    cols = {k: batch.column(k) for k in keep} | new
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)
