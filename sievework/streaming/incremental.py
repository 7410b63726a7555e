"""Incremental intake: new catalogue files as a stream, each id once, upserts that keep non-empty values.

The batch operators stay the definition; the stream only decides what is new. State is bounded by the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_files(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_of_each(stream: DataFrame, id_: str, time: str, late: str = "1 day") -> DataFrame:
    """Each id once within the watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([id_])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts and sums in tumbling windows, with late rows up to the watermark."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    counted = timed.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counted.select(F.col("w.start").alias("start"), by, "n", "total")


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Take in what is there now, write it once, and stop."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink).awaitTermination()


def upsert_into(spark: SparkSession, target: str, key: str, order: str, columns: list[str]):
    """A foreachBatch function: merges a batch into the table at `target`, the latest non-empty value of each column wins.
    The merged table is written beside the old one and then takes its place, so a failed batch leaves the old one."""
    from ..operators.sheets import upsert

    def merge(batch: DataFrame, epoch: int) -> None:
        base = f"{target}/epoch={epoch - 1}"
        rows = batch.select(key, order, *columns)
        if epoch > 0:
            rows = rows.unionByName(spark.read.parquet(base).select(key, order, *columns))
        last = upsert(rows, key, order, columns).join(rows.groupBy(key).agg(F.max(order).alias(order)), key)
        last.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    return merge
