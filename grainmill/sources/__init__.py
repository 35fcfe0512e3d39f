"""Reading and writing: scans with filters and trace columns, and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CODECS = {"none": "uncompressed", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "brotli": "brotli", "lz4": "lz4"}


def rows(spark: SparkSession, path: str, kind: str = "parquet", merge: bool = False, glob: str | None = None) -> DataFrame:
    """A scan of parquet, ndjson, csv, orc or text objects (one object, one row: path and text)."""
    reader = spark.read.option("mergeSchema", str(merge).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if kind == "objects":
        return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    if kind == "pdf":
        return reader.format("binaryFile").load(path)
    return {"parquet": reader.parquet, "ndjson": reader.json, "orc": reader.orc, "csv": lambda p: reader.csv(p, header=True)}[kind](path)


def required(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame, or an error that names the columns it lacks."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}; there are {', '.join(df.columns)}")
    return df


def where_equal(df: DataFrame, filters: dict[str, str]) -> DataFrame:
    """Equality on values as strings, all of them."""
    condition: Column = F.lit(True)
    for name, value in filters.items():
        condition = condition & (F.col(name).cast("string") == F.lit(str(value)))
    return df.where(condition)


def traced(df: DataFrame, text_col: str, bucket: str = "local") -> DataFrame:
    """Adds sample_uid, its hash, source_object_key, source_row_index and original_text_sha256, from the file and row a row was read from."""
    key = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/+", "")
    df = df.select("*", key.alias("source_object_key"), F.col("_metadata.row_index").alias("source_row_index"))
    uid = F.concat(F.lit(f"object://{bucket}/"), F.col("source_object_key"), F.lit("#row="), F.col("source_row_index").cast("string"))
    return df.withColumn("sample_uid", uid).withColumns({"sample_uid_hash": F.sha2("sample_uid", 256), "original_text_sha256": F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)})


def write(df: DataFrame, path: str, kind: str = "parquet", by: list[str] = (), codec: str = "zstd", rows_a_file: int = 0, row_group_bytes: int = 0) -> None:
    """Parquet (codec 'none' is uncompressed) or ndjson, partitioned by columns; Spark's commit protocol swaps the result in."""
    writer = df.write.mode("overwrite")
    if rows_a_file:
        writer = writer.option("maxRecordsPerFile", rows_a_file)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if by:
        writer = writer.partitionBy(*by)
    if kind == "ndjson":
        writer.json(path)
    else:
        writer.option("compression", CODECS[codec]).parquet(path)


def output_key(path: Column) -> Column:
    """Name of the object derived from a source object: 16 digits of its path's hash, and its base name as markdown."""
    base = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    return F.concat(F.substring(F.sha2(path, 256), 1, 16), F.lit("-"), base, F.lit(".md"))


def ledger(rows: DataFrame, status: str = "status") -> DataFrame:
    """Run counters by status."""
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def explore(df: DataFrame, by: str, k: int, seed: int) -> DataFrame:
    """k random rows of each group, the same for the same seed; random numbers are drawn per row, nothing is sorted globally."""
    from pyspark.sql import Window

    order = Window.partitionBy(by).orderBy("__r")
    return df.withColumn("__r", F.xxhash64(F.lit(seed), *df.columns)).withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k).drop("__r", "__n")
