"""Keyed state of streaming jobs, merged batch by batch.

A state is a parquet table in hash buckets of its entity key.  A micro-batch
brings partial rows; only the buckets that they touch are read, merged and
written, as a new version, and a manifest of one row per bucket then names the
current version of every bucket.  So:

* late rows are merged like any others, nothing is dropped by a watermark;
* an empty batch, or a re-run without new files, writes nothing;
* a batch that is delivered again rewrites its own version from the version
  before it (exactly once); readers never see a half-written state, since a
  manifest appears only when its data is complete;
* versions that no kept manifest names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32
KEEP = 2               # manifests (and what they name) that stay readable
_BUCKET = "_bucket"


class KeyedState:
    """``merge(rows)`` combines several rows of one key into one; ``bucket_by``
    are columns of the key, so that a key lies in one bucket."""

    def __init__(self, spark: SparkSession, root: str, bucket_by: list[str], merge: Callable[[DataFrame], DataFrame],
                 buckets: int = BUCKETS, keep: int = KEEP):
        self.spark, self.root = spark, root.rstrip("/")
        self.bucket_by, self.merge = bucket_by, merge
        self.buckets, self.keep = buckets, keep

    # ---- manifests: bucket -> version ------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        p, fs = self._fs(f"{self.root}/manifest")
        if not fs.exists(p):
            return []
        found = [s.getPath() for s in fs.listStatus(p)]
        done = [x for x in found if x.getName().startswith("v=") and fs.exists(self._fs(f"{x}/_SUCCESS")[0])]
        return sorted(int(x.getName()[2:]) for x in done)

    def latest(self, before: int | None = None) -> int | None:
        return max((v for v in self.versions() if before is None or v < before), default=None)

    def manifest(self, version: int) -> dict[int, int]:
        rows = self.spark.read.schema("bucket int, version long").parquet(f"{self.root}/manifest/v={version}").collect()
        return {r.bucket: r.version for r in rows}        # one row per bucket

    # ---- data ----------------------------------------------------------------------

    def _paths(self, named: dict[int, int]) -> list[str]:
        return [f"{self.root}/data/v={v}/{_BUCKET}={b}" for b, v in sorted(named.items())]

    def read(self, version: int | None = None, schema=None) -> DataFrame:
        """The state at a committed version (default: the latest)."""
        version = self.latest() if version is None else version
        if version is None:
            if schema is None:
                raise FileNotFoundError(f"no committed version under {self.root}")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(*self._paths(self.manifest(version)))

    def apply(self, partials: DataFrame, version: int) -> int | None:
        """Merge a batch's partial rows as ``version``; returns the version that
        is current afterwards."""
        key = F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")
        fresh = partials.withColumn(_BUCKET, key).persist()
        try:
            touched = [r[0] for r in fresh.select(_BUCKET).distinct().collect()]     # at most ``buckets`` numbers
            before = self.latest(before=version)
            if not touched:
                return before
            named = self.manifest(before) if before is not None else {}
            rows = fresh.drop(_BUCKET)
            old = {b: v for b, v in named.items() if b in touched}
            if old:
                rows = self.spark.read.parquet(*self._paths(old)).unionByName(rows)
            merged = self.merge(rows).withColumn(_BUCKET, key)
            merged.repartition(self.buckets, _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(
                f"{self.root}/data/v={version}")
        finally:
            fresh.unpersist()
        named.update(dict.fromkeys(touched, version))
        self.spark.createDataFrame(sorted(named.items()), "bucket int, version long").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/manifest/v={version}")
        self._retire()
        return version

    def _retire(self) -> None:
        """Delete manifests beyond ``keep`` and data that no kept one names."""
        old, kept = self.versions()[:-self.keep], self.versions()[-self.keep:]
        if not old:
            return
        alive = {(b, v) for m in kept for b, v in self.manifest(m).items()}
        for m in old:
            gone = {(b, v) for b, v in self.manifest(m).items()} - alive
            for path in (*self._paths(dict(gone)), f"{self.root}/manifest/v={m}"):
                p, fs = self._fs(path)
                fs.delete(p, True)


def merge_sink(state: KeyedState, partials: Callable[[DataFrame], DataFrame]):
    """foreachBatch function: partial rows of the batch, merged into the state."""
    def run(batch: DataFrame, batch_id: int) -> None:
        state.apply(partials(batch), batch_id)
    return run
