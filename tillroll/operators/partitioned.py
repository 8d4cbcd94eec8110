"""Keyed writes that touch only the partitions they change.

A table is a plain parquet folder, partitioned by one column: a calendar value
for facts, a hash bucket of the key for tables with a row per key.  A write
replaces whole partitions with Spark's dynamic partition overwrite and leaves
all others alone; a read names the partitions it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.sources.arrivals import PARQUET, path_exists

BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket number of a key; a NULL key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def buckets_for(rows: int, rows_per_bucket: int) -> int:
    return max(1, -(-rows // rows_per_bucket))


def is_in(column: str, values: Iterable) -> Column:
    """NULL-safe IN over literal values: prunes partitions."""
    values = list(values)
    known = F.col(column).isin([v for v in values if v is not None]) if any(v is not None for v in values) else F.lit(False)
    return known | F.col(column).isNull() if None in values else known


def values_of(df: DataFrame, column: str) -> list:
    """Distinct values of a partition column: at most one per partition."""
    return [r[0] for r in df.select(column).distinct().collect()]


class Written(NamedTuple):
    partitions: int
    rows: int


class PartitionedTable:
    """``schema`` is that of the rows without the partition column, if it is known."""

    def __init__(self, spark: SparkSession, path: str, by: str, kind: str, schema: StructType | None = None):
        self.spark, self.path, self.by, self.kind, self.schema = spark, path, by, kind, schema

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def _full(self, rows: StructType) -> StructType:
        # the column's type is declared: a month such as 2024-01 would be taken for a date
        return StructType([f for f in rows if f.name != self.by]).add(self.by, self.kind)

    def read(self, values: Iterable | None = None) -> DataFrame:
        """The table, or its partitions with these values only; no rows if it was never written."""
        there = self.exists()
        if self.schema is None:
            self.schema = self.spark.read.parquet(self.path).schema
        if not there:
            return self.spark.createDataFrame([], self._full(self.schema))
        rows = self.spark.read.schema(self._full(self.schema)).parquet(self.path)
        return rows if values is None else rows.where(is_in(self.by, values))

    def replace(self, rows: DataFrame, values: Iterable, kept: DataFrame | None = None, placed: bool = False) -> Written:
        """Make ``rows`` the whole content of the partitions ``values``, which are
        all the partitions that ``rows`` has rows of.  The rows may come from
        the table itself: files are swapped when the job has ended.  Running the
        same write again leaves the same table.  ``kept`` are more rows, read
        from these partitions; they and ``placed`` rows lie together by
        partition already and are not moved."""
        values = list(values)
        if not values:
            return Written(0, 0)
        seen = Observation()
        rows = rows if placed else rows.hint("rebalance", self.by)
        rows = rows if kept is None else rows.unionByName(kept)
        watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(self.by).cast("string")).alias("filled"),
                               F.count_if(F.col(self.by).isNull()).alias("nulls"))
        (watched.write.mode("overwrite").options(**PARQUET).option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.by).parquet(self.path))
        got, self.schema = seen.get, rows.schema
        filled = set(got["filled"]) | ({None} if got["nulls"] else set())
        for value in values:
            if (None if value is None else str(value)) not in filled:
                self._empty(value)
        return Written(len(values), got["rows"])

    def _empty(self, value) -> None:
        """Remove a partition that has no row any more."""
        jvm = self.spark._jvm
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.by}={name}")
        p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def same_rows(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def only(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key is in ``keys`` (``left_anti``: is not), NULL-safe."""
    return rows.alias("r").join(keys.alias("k"), same_rows("r", "k", keys.columns), how)


def together(*jobs: Callable):
    """Results of jobs that do not need each other, run at the same time."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


class KeyedTable(PartitionedTable):
    """A table in hash buckets of one key column."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int, schema: StructType | None = None):
        super().__init__(spark, path, BUCKET, "integer", schema)
        self.key, self.buckets = key, buckets

    def buckets_of(self, keys: DataFrame) -> list[int]:
        return values_of(keys.select(bucket_of(self.key, self.buckets)), BUCKET)

    def rows_of(self, keys: DataFrame, buckets: list[int] | None = None) -> DataFrame:
        """The rows of these keys; their buckets only are read."""
        return only(self.read(self.buckets_of(keys) if buckets is None else buckets).drop(BUCKET), keys)

    def replace_keys(self, keys: DataFrame, rows: DataFrame, buckets: list[int] | None = None) -> Written:
        """Make ``rows`` the table's rows of the given keys (a key without a row
        goes); only the keys' buckets are read and written."""
        touched = self.buckets_of(keys) if buckets is None else buckets
        rows = rows.withColumn(BUCKET, bucket_of(self.key, self.buckets))
        if self.exists():
            rows = only(self.read(touched), keys, "left_anti").unionByName(rows)
        return self.replace(rows, touched)
