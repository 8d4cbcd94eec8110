"""Landing of CSV deliveries, and the current row of every key.

Bronze is append-only: what was delivered stays as it came, with its place in
the order of arrival (the file's modification time, its path, the place in the
file).  A key that arrives again does not replace anything there; ``current``
picks each key's last row.  ``latest`` does the same, but only rows of keys that
arrived more than once travel for it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillroll.sources.csv import CORRUPT_COLUMN, read_csv_stream, with_corrupt_column

#: How the tables of the chains are written.
PARQUET = {"compression": "zstd"}

#: Place in the order of arrival; compares field by field.
ARRIVAL = "_arrival"
ARRIVAL_TYPE = StructType().add("at", "timestamp").add("file", "string").add("block", "long").add("line", "long")

#: What names a row of each source.  A transaction has several lines; a line is
#: named by its transaction, product, quantity and unit price.  A row whose first
#: key column is NULL has no key.
KEYS = {"products": ["product_id"], "customers": ["customer_id"],
        "purchases": ["transaction_id", "product_id", "quantity", "unit_price"], "clickstream": ["event_id"]}

#: Key numbers of 8 bytes that are sent to every task at most; of more numbers, a
#: map of bits of at most as many rows.
FEW = 1_000_000
#: Words of 64 bits in a row of the map.
LANES = 4


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def read_arrivals(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of a landing folder: each file once, with the file's place in time."""
    lines = read_csv_stream(spark, path, schema, max_files_per_trigger, keep_corrupt=True)
    return lines.select("*", F.struct(
        F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block")).alias("_file"))


def land(stream: DataFrame, out: str, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Append what has arrived to ``out``, a folder per batch.  A batch that is
    run again after a failure overwrites its own folder, so a line lands once.
    Rows of a block are read by one task in the lines' order, so the row number
    within the batch orders them."""
    def write(batch: DataFrame, number: int) -> None:
        line = F.monotonically_increasing_id().alias("line")
        (batch.withColumn(ARRIVAL, F.struct("_file.at", "_file.file", "_file.block", line)).drop("_file")
         .write.mode("overwrite").options(**PARQUET).parquet(f"{out}/batch={number}"))

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        q.awaitTermination()
    return q


def bronze_schema(schema: StructType) -> StructType:
    return with_corrupt_column(schema).add(ARRIVAL, ARRIVAL_TYPE).add("batch", "integer")


def read_bronze(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The landed lines (no rows if nothing has arrived yet)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], bronze_schema(schema))
    return spark.read.schema(bronze_schema(schema)).parquet(path)


def split_lines(bronze: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with the reason): lines that do not parse, and
    rows without a key, which nothing could ever replace."""
    bad, keyless = F.col(CORRUPT_COLUMN).isNotNull(), F.col(keys[0]).isNull()
    named = [c for c in bronze.columns if c not in (CORRUPT_COLUMN, ARRIVAL, "batch")]
    rejected = bronze.where(bad | keyless).select(
        F.coalesce(F.col(CORRUPT_COLUMN), F.to_json(F.struct(*named))).alias("line"),
        F.when(bad, "does not parse").otherwise(f"{keys[0]} is NULL").alias("reason"))
    return bronze.where(~bad & ~keyless).drop(CORRUPT_COLUMN, "batch"), rejected


def current(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the one that arrived last.  Partial results are combined
    before the shuffle, so a key that arrives very often is no hot spot."""
    # the place comes first and differs from row to row, so it decides; it travels once (``max_by`` would carry it twice)
    rest = [ARRIVAL, *[c for c in rows.columns if c not in (ARRIVAL, *keys)]]
    last = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns])


def key_number(keys: list[str]) -> Column:
    """A number per key, never NULL.  Different keys may share one, so equal numbers
    only say that keys may be equal."""
    return F.xxhash64(*keys)


def few_numbers(numbers: DataFrame, path: str) -> DataFrame | None:
    """Numbers (column ``_number``) written to ``path``; None if they are more than ``FEW``."""
    numbers.write.mode("overwrite").options(**PARQUET).parquet(path)
    found = numbers.sparkSession.read.schema("_number long").parquet(path)
    return found if found.count() <= FEW else None


def _bit(number: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(number, 48), F.lit(64 * LANES)).cast("int")


def number_bits(numbers: DataFrame, path: str) -> DataFrame:
    """A map of bits with the numbers' bits set, written to ``path``: at most ``FEW``
    rows however many the numbers are.  A number that is not among them may have
    its bit set too, the more so the more numbers there are."""
    number, bit = F.col("_number"), _bit(F.col("_number"))
    words = [F.bit_or(F.when(F.shiftright(bit, 6) == i, F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63)))
                      .otherwise(F.lit(0).cast("long"))).alias(f"_w{i}") for i in range(LANES)]
    bits = numbers.groupBy(F.pmod(number, F.lit(FEW)).alias("_row")).agg(*words)
    bits.write.mode("overwrite").options(**PARQUET).parquet(path)
    return numbers.sparkSession.read.schema(", ".join(["_row long", *[f"_w{i} long" for i in range(LANES)]])).parquet(path)


def sent_numbers(numbers: DataFrame, path: str) -> DataFrame:
    """Numbers (column ``_number``) written to ``path``, in the form that every task
    gets: they themselves, or of more than ``FEW`` their map of bits."""
    few = few_numbers(numbers, path)
    return few if few is not None else number_bits(numbers.sparkSession.read.schema("_number long").parquet(path), f"{path}-bits")


def repeated_numbers(rows: DataFrame, keys: list[str], path: str, fresh: DataFrame | None = None,
                     known: DataFrame | None = None, send: Callable = few_numbers) -> DataFrame | None:
    """Numbers that more than one row has, written to ``path``; None if they are
    more than ``FEW`` (with ``sent_numbers`` as ``send`` their map of bits).
    Nothing but numbers is shuffled.  If ``known`` has the repeated numbers of
    all rows but ``fresh`` ones, only the numbers of these are looked for again,
    unless there are too many."""
    number = key_number(keys).alias("_number")
    new = send(fresh.select(number).distinct(), f"{path}-fresh") if known is not None else None
    counts = (rows if new is None else with_numbers(rows, keys, new)).groupBy(number).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.where("_n > 1").select("_number")
    return send(found if new is None else found.unionByName(known).distinct(), path)


def with_numbers(rows: DataFrame, keys: list[str], numbers: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key has one of these numbers (``left_anti``: has none).  By a
    map of bits, a row that has none of them may be taken for one that has, and
    so are all rows of its key."""
    number = key_number(keys)
    if "_number" in numbers.columns:
        return rows.join(F.broadcast(numbers), number == F.col("_number"), how)
    bit = _bit(number)
    word = reduce(lambda other, i: F.when(F.shiftright(bit, 6) == i, F.col(f"_w{i}")).otherwise(other), range(1, LANES), F.col("_w0"))
    found = F.call_function("shiftright", word, bit.bitwiseAND(63)).bitwiseAND(1) == 1
    joined = rows.join(F.broadcast(numbers), F.pmod(number, F.lit(FEW)) == F.col("_row"), "inner" if how == "left_semi" else "left")
    return joined.where(found if how == "left_semi" else ~F.coalesce(found, F.lit(False))).select(*rows.columns)


def latest(rows: DataFrame, keys: list[str], numbers: DataFrame | None) -> DataFrame:
    """``current``, given the ``repeated_numbers`` of the rows: a row that shares its
    number with no other is the last of its key and stays where it is (a few
    of these travel too if the numbers are a map of bits)."""
    if numbers is None:
        return current(rows, keys)
    alone = with_numbers(rows, keys, numbers, "left_anti")
    return alone.unionByName(current(with_numbers(rows, keys, numbers), keys))
