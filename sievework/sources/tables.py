"""Reading the sources: Parquet tables, and the text formats that catalogues and sample sheets come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import norm


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON document a file; with no schema as (path, VARIANT)."""
    if schema is not None:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return whole.select("path", F.try_parse_json("value").alias("document"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines are skipped, a bad line fails the scan."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def list_file(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines without blank and # lines."""
    lines = spark.read.text(path).select(F.trim("value").alias("value"))
    return lines.where((F.col("value") != "") & ~F.col("value").startswith("#"))


def delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """All columns as strings, missing cells empty. Without sep, the header's tabs or commas decide."""
    if sep is None:
        head = spark.read.text(path).limit(1).collect()
        sep = "\t" if head and head[0].value.count("\t") >= head[0].value.count(",") and "\t" in head[0].value else ","
    rows = spark.read.option("header", True).option("sep", sep).option("multiLine", sep == ",").option("escape", '"').csv(path)
    return rows.fillna("")


def first_column_of(df: DataFrame, *names: str):
    """The first column that the table has, without regard to case; else empty text."""
    have = {c.lower(): c for c in df.columns}
    for n in names:
        if n.lower() in have:
            return F.col(f"`{have[n.lower()]}`")
    return F.lit("")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate TSV: missing columns take defaults, ;-joined lists become arrays, a bad number is 0."""
    raw = delimited(spark, path, "\t")
    split = lambda c: F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")
    return raw.select(
        first_column_of(raw, "accession", "pxd_accession").alias("accession"),
        F.coalesce(first_column_of(raw, "score").try_cast("int"), F.lit(0)).alias("score"),
        first_column_of(raw, "tier").alias("tier"),
        split(first_column_of(raw, "positive_lanes", "lanes")).alias("lanes"),
        split(first_column_of(raw, "labels")).alias("labels"),
    )


def long_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A sample sheet in long form: file, row_idx, col_idx, header, value. Headers may repeat, so columns go by place.
    Byte order marks, empty rows and cells beyond the header go; short rows are padded with empty cells."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split(F.regexp_replace(F.regexp_replace("value", "^﻿", ""), "\r\n?", "\n"), "\n").alias("lines"))
    heads = lines.select("file", F.transform(F.split(F.get("lines", F.lit(0)), sep), lambda h: F.lower(norm(h))).alias("headers"), F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))).alias("rows"))
    rows = heads.select("file", "headers", F.posexplode("rows").alias("row_idx", "line")).where(norm(F.translate("line", sep, " ")) != "")
    cells = rows.select("file", "row_idx", F.split("line", sep).alias("cells"), F.posexplode("headers").alias("col_idx", "header"))
    return cells.select("file", "row_idx", "col_idx", "header", norm(F.coalesce(F.get("cells", F.col("col_idx")), F.lit(""))).alias("value"))


def listing(lines: DataFrame, column: str = "line") -> DataFrame:
    """FTP listings: MLSD facts in any order, unix ls, or DOS. name, is_dir, size; links and unknown lines get problem."""
    c = F.col(column)
    mlsd, unix, dos = c.rlike(r"(?i)^([a-z.]+=[^;]*;)+ .+$"), c.rlike(r"^[bcdlps-][rwxsStT-]{9}\S*\s"), c.rlike(r"^\d{2}-\d{2}-\d{2,4}\s+\d{1,2}:\d{2}[AP]M\s")
    unix_pattern = r"^(.)\S+\s+\d+\s+\S+\s+\S+\s+(\d+)\s+\S+\s+\S+\s+\S+\s(.*)$"
    dos_pattern = r"^\S+\s+\S+\s+(<DIR>|\d+)\s+(.*)$"
    kind = F.when(mlsd, F.lower(F.regexp_extract(c, r"(?i)(?:^|;)type=([^;]*);", 1))).when(unix, F.regexp_extract(c, unix_pattern, 1)).when(dos, F.regexp_extract(c, dos_pattern, 1))
    name = F.when(mlsd, F.regexp_extract(c, r"^[^ ]* (.+)$", 1)).when(unix, F.regexp_extract(c, unix_pattern, 3)).when(dos, F.regexp_extract(c, dos_pattern, 2))
    size = F.when(mlsd, F.regexp_extract(c, r"(?i)(?:^|;)size=(\d+);", 1)).when(unix, F.regexp_extract(c, unix_pattern, 2)).when(dos, F.regexp_extract(c, dos_pattern, 1))
    return lines.withColumn("name", name).withColumn("is_dir", F.coalesce(kind.isin("dir", "cdir", "pdir", "d", "<DIR>"), F.lit(False))).withColumn(
        "size", F.when(~F.col("is_dir"), size.try_cast("long"))
    ).withColumn("problem", F.when(kind == "l", "link").when(kind.isNull() | (F.col("name") == ""), "unknown"))


def latest_page(pages: DataFrame, key: str, page: str) -> DataFrame:
    return pages.groupBy(key).agg(F.max(page).alias("page"))


def first_seen(rows: DataFrame, id_: str, page: str) -> DataFrame:
    return rows.groupBy(id_).agg(F.min(page).alias("first_page"))


def stagnant(rows: DataFrame, key: str, id_: str, page: str) -> DataFrame:
    """For each page of a source the number of new ids, and the run of pages so far that added none."""
    new = rows.groupBy(key, id_).agg(F.min(page).alias(page)).groupBy(key, page).agg(F.count("*").alias("n_new"))
    pages = rows.select(key, page).distinct().join(new, [key, page], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0).cast("long")))
    order = Window.partitionBy(key).orderBy(page)
    islands = pages.withColumn("island", F.sum((F.col("n_new") > 0).cast("long")).over(order))
    run = F.sum((F.col("n_new") == 0).cast("long")).over(Window.partitionBy(key, "island").orderBy(page))
    return islands.select(key, page, "n_new", run.alias("stagnant_run"))
