"""Read the given parquet tables (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_READS: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table as a DataFrame.  DataFrames are immutable plans, so
    one instance per (session, directory, table) is reused: the file
    listing and footer/schema read happen once, not on every access."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _READS[key] = df
    return df


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
