"""Derived state that follows its facts: a batch recomputes the keys that it touches and no others.

Facts are kept for good; what is derived from them can be thrown away and made anew. Three tables lie in one folder, each
partitioned by epoch and by a bucket of the key: `facts` has the facts that are new in an epoch, `derived` what the touched keys
give after it, and `touched` these keys. A key's current rows are those of the last epoch that touched it, so nothing old is
rewritten, and a batch reads the facts of the buckets that it touches only.

`touched` is written last: until then an epoch is not there for any reader, and a batch that comes again overwrites its own
epoch. So a lost executor or driver costs the batch in hand."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PARTS = ("epoch", "bucket")


@dataclass(frozen=True)
class DerivedState:
    """folder: of this state alone. facts: DDL of their columns; key: those that facts are resolved by; id: what names a fact.
    resolve: facts to derived rows, which hold the key and whose rows of one key follow from the facts of that key alone.
    Epochs count from 0 without a gap, as the batches of a stream do. Facts with a null in the key or id are left out; of
    facts with one id the first epoch's stays, and within a batch the least by all columns. No column may be called epoch,
    bucket or last."""

    folder: str
    facts: str
    derived: str
    key: Sequence[str]
    id: Sequence[str]
    resolve: Callable[[DataFrame], DataFrame]
    buckets: int = 64

    def _read(self, spark: SparkSession, name: str, columns: str) -> DataFrame:
        return spark.read.schema(f"{columns}, epoch long, bucket int").parquet(f"{self.folder}/{name}")

    def _keys(self) -> str:
        kinds = dict(c.strip().split(None, 1) for c in self.facts.split(","))
        return ", ".join(f"{k} {kinds[k]}" for k in self.key)

    def _write(self, rows: DataFrame, name: str, epoch: int) -> None:
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        # one file a bucket where it is small; a large bucket is split over tasks
        rows.withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{name}/epoch={epoch}")

    def _names(self, columns: str) -> list[str]:
        return [c.split()[0] for c in columns.split(",")]

    def merge(self, batch: DataFrame, epoch: int) -> None:
        """A foreachBatch function."""
        spark, names = batch.sparkSession, self._names(self.facts)
        whole = batch.select(*names).dropna(subset=[*self.key, *self.id])
        new = whole.groupBy(*self.id).agg(F.min(F.struct(*names)).alias("f")).select("f.*")
        if epoch > 0:
            new = new.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))
            old = self._read(spark, "facts", self.facts).where(F.col("epoch") < epoch)
            # an id may come again under another key, so ids are looked up over all buckets
            new = new.join(old.select(*self.id).distinct(), list(self.id), "left_anti").select(*names)
        self._write(new, "facts", epoch)
        mine = self._read(spark, "facts", self.facts).where(F.col("epoch") == epoch)
        self._derive(spark, mine.select(*self.key).distinct(), [r.bucket for r in mine.select("bucket").distinct().collect()], epoch)

    def _derive(self, spark: SparkSession, keys: DataFrame, buckets: list[int], epoch: int) -> None:
        """buckets: those of the keys, at most as many as there are; their list prunes the scan of the facts."""
        facts = self._read(spark, "facts", self.facts).where((F.col("epoch") <= epoch) & F.col("bucket").isin(buckets))
        of_keys = facts.drop(*_PARTS).join(keys, list(self.key), "left_semi")
        self._write(self.resolve(of_keys).select(*self._names(self.derived)), "derived", epoch)
        self._write(keys, "touched", epoch)

    def reset(self, spark: SparkSession, epoch: int) -> None:
        """Throw away what was derived and make it anew from the facts before this epoch, as when the rules have changed. The
        epoch has no facts of its own."""
        known = self._read(spark, "facts", self.facts).where(F.col("epoch") < epoch)
        self._write(known.select(*self._names(self.facts)).limit(0), "facts", epoch)
        self._derive(spark, known.select(*self.key).distinct(), list(range(self.buckets)), epoch)

    def current(self, spark: SparkSession, epoch: int | None = None) -> DataFrame:
        """The derived rows after the last whole epoch, or after the given one."""
        touched = self._read(spark, "touched", self._keys())
        touched = touched if epoch is None else touched.where(F.col("epoch") <= epoch)
        last = touched.groupBy(*self.key).agg(F.max("epoch").alias("last"))
        rows = self._read(spark, "derived", self.derived).join(last, list(self.key))
        return rows.where(F.col("epoch") == F.col("last")).select(*self._names(self.derived))

    def known_facts(self, spark: SparkSession) -> DataFrame:
        """All facts of whole epochs."""
        whole = self._read(spark, "touched", self._keys()).agg(F.max("epoch").alias("last"))
        return self._read(spark, "facts", self.facts).join(F.broadcast(whole), F.col("epoch") <= F.col("last")).select(*self._names(self.facts))
