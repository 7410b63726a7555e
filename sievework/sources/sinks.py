"""Sinks: JSON lines, delimited catalogues, sample sheets, decision splits and release manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame, sep: str = "; ") -> DataFrame:
    """String arrays joined, other nested columns as JSON text, so every cell is plain."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, sep)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_json_lines(df: DataFrame, path: str, *order: str) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").json(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t", *order: str) -> None:
    rows = flat(df)
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").option("escape", '"').csv(path)


def sheet_lines(cells: DataFrame) -> DataFrame:
    """Long form back to lines of a sample sheet: file, row_idx (-1 for the header), line. A row's cells are as many as
    the sheet has columns."""
    of = lambda v: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_idx", F.col(v).alias("v")))), lambda x: x["v"]), "\t")
    heads = cells.select("file", "col_idx", "header").distinct().groupBy("file").agg(of("header").alias("line")).select("file", F.lit(-1).alias("row_idx"), "line")
    return heads.unionByName(cells.groupBy("file", "row_idx").agg(of("value").alias("line")))


def split_by(df: DataFrame, path: str, column: str) -> None:
    """One scan, one folder for each decision."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def manifest(df: DataFrame, key: str) -> DataFrame:
    """key, sha256 of the row's canonical JSON: a release is the same if its manifest is."""
    names = sorted(c for c in df.columns if c != key)
    return df.select(key, F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256).alias("sha256"))


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder that all executors share, removed when the driver ends: in spark.checkpoint.dir as the session names it.
    Only where that is unset it is under the warehouse folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path
