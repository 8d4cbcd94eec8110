"""CSV landing zone: write, batch read, incremental (streaming) ingestion.

Quotes are doubled inside quoted fields (``escape='"'``), the way common CSV
writers emit JSON-array columns; timestamps keep microseconds.  An empty
unquoted field reads back as NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COLUMN = "_corrupt_record"

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "dateFormat": "yyyy-MM-dd",
    "mode": "PERMISSIVE",
}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """One CSV file set per call (one file per partition; no coalesce to 1,
    which would funnel the table through one task).  Readers know a compressed
    file by its name; one task reads it whole."""
    df.write.mode(mode).options(**CSV_OPTIONS).option("compression", compression).csv(path)


def with_corrupt_column(schema: StructType) -> StructType:
    """Schema plus a text column that keeps malformed lines (PERMISSIVE mode
    fills it and sets the typed fields of that line to NULL).  Spark only
    lets a query filter on this column alone after the frame is cached or
    written, which is how a quarantine table is produced."""
    return StructType(list(schema.fields) + [StructField(CORRUPT_COLUMN, StringType(), True)])


def _reader(r, schema: StructType, keep_corrupt: bool):
    r = r.schema(with_corrupt_column(schema) if keep_corrupt else schema).options(**CSV_OPTIONS)
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return r


def read_csv(spark: SparkSession, path: str, schema: StructType, keep_corrupt: bool = False) -> DataFrame:
    return _reader(spark.read, schema, keep_corrupt).csv(path)


def read_csv_stream(spark: SparkSession, path: str, schema: StructType,
                    max_files_per_trigger: int | None = None, keep_corrupt: bool = False) -> DataFrame:
    """File-source stream over a landing directory: each new file is read once
    (tracked in the query checkpoint)."""
    r = _reader(spark.readStream, schema, keep_corrupt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(path)


def ingest(stream: DataFrame, out: str, checkpoint: str, partition_by: list[str] = (),
           wait: bool = True) -> StreamingQuery:
    """Append a stream to a parquet table, processing everything available
    now and stopping (exactly-once through the checkpoint + file sink log)."""
    w = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(out)
    if wait:
        q.awaitTermination()
    return q
