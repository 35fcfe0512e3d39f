"""The retained-document index: building, retraction, refresh by watermark, and export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def retained_index(metrics: DataFrame, documents: DataFrame, languages: DataFrame, duplicates: DataFrame, keep: Column, labels: list[str], profile: str) -> DataFrame:
    """Documents that pass a profile's thresholds, are in an allowed language and are nobody's near duplicate."""
    rows = metrics.join(documents, "doc_id").join(languages.where(F.col("lid_label").isin(labels)), "doc_id").where(keep)
    return rows.join(duplicates.select("doc_id"), "doc_id", "left_anti").withColumn("profile_name", F.lit(profile))


def retract(index: DataFrame, duplicates: DataFrame) -> DataFrame:
    """The index without documents that were found to be duplicates since."""
    return index.join(duplicates.select("doc_id"), "doc_id", "left_anti")


def refresh_window(rows: DataFrame, changed: list[str], last: Column, overlap_hours: float, now: Column) -> DataFrame:
    """Rows whose latest change lies between the last watermark, less an overlap, and now. A null watermark takes all."""
    at = F.greatest(*(F.coalesce(c, F.lit("1900-01-01").cast("timestamp")) for c in changed)) if len(changed) > 1 else F.col(changed[0])
    since = last - F.expr(f"interval {int(overlap_hours * 3600)} seconds")
    return rows.where((last.isNull() | (at >= since)) & (at <= now))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows take the place of old ones with the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def export(index: DataFrame, path: str, by: list[str], rows_a_file: int = 1_000_000, compression: str = "zstd") -> None:
    """Hive-partitioned parquet; the commit protocol makes the swap atomic per job."""
    index.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).option("compression", compression).partitionBy(*by).parquet(path)
