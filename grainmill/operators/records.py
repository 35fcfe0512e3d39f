"""Rows of outside corpora as unified rows, keys that cross corpora, list columns as JSON, part metrics and regression checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def external_rows(df: DataFrame, dataset: str, text: str, record: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Rows of an outside corpus, which nothing has cleaned, as unified rows: original and cleaned figures are equal.

    A null text counts as empty; a null record id stays null, and so does its sample_uid. ``extra``
    holds further columns of the result; those of the source that are not named are left out.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    uid = F.concat(F.lit(f"{dataset}#"), F.col(record).cast("string"))
    sha, chars = F.sha2(body, 256), F.length(body).cast("long")
    same = {"original_text_sha256": sha, "cleaned_text_sha256": sha, "original_char_count": chars, "cleaned_char_count": chars, "removed_char_count": F.lit(0).cast("long")}
    columns = {"sample_uid": uid, "sample_uid_hash": F.sha2(uid, 256), "document_id": F.col(record).cast("string"), "native_source": F.lit(dataset), "cleaned_text": body}
    columns |= same | {"cleaning_is_dropped": F.lit(False), "cleaning_rules_triggered": F.array().cast("array<string>")} | (extra or {})
    return df.select(*(c.alias(n) for n, c in columns.items()))


def with_origin(derived: DataFrame, originals: DataFrame, uid: str, scheme: str, origin_uid: str | None = None) -> DataFrame:
    """Derived rows, such as translations, with the original whose uid has the same name under ``scheme``; both tables' other columns must differ in name."""
    origin_uid = origin_uid or uid
    key = F.concat(F.lit(f"{scheme}://"), F.split_part(F.col(uid), F.lit("://"), F.lit(2)))
    return derived.withColumn("origin_uid", key).join(originals.withColumnRenamed(origin_uid, "origin_uid"), "origin_uid")


def on_partition_and_key(left: DataFrame, right: DataFrame, partition: str, key: str) -> DataFrame:
    """Joined on the partition column as well as on the key, so that a table stored by partition is read only where the other side has rows."""
    return left.join(right, [partition, key])


def contains_all(column: str, values: list[str]) -> Column:
    """Whether an array holds every one of ``values``; null for a null array."""
    return reduce(lambda a, b: a & b, (F.array_contains(column, v) for v in values), F.col(column).isNotNull())


def json_list(column: str) -> Column:
    """A list column as JSON; null as the empty list."""
    return F.coalesce(F.to_json(column), F.lit("[]"))


def json_items(column: str, item: str) -> Column:
    """A list of ``item`` from JSON; null for what is no list."""
    return F.from_json(column, f"array<{item}>")


def language_profile(source: str, by_source: dict[str, str], profiles: list[str], default: str = "zsm_Latn") -> Column:
    """The profile a source names, else the default, else the first in order of name."""
    fallback = default if default in profiles else min(profiles)
    name = F.lower(F.trim(F.coalesce(F.col(source), F.lit(""))))
    return F.coalesce(*(F.when(name == k, F.lit(v)) for k, v in by_source.items()), F.lit(fallback))


def part_metrics(df: DataFrame, part: str, source: str, dropped: Column, removed: Column, tokens: Column) -> DataFrame:
    """Rows, dropped rows, removed characters and tokens of each part, and its rows by source in order of name; a null source is 'unknown'."""
    name = F.coalesce(F.col(source).cast("string"), F.lit("unknown"))
    flag = F.coalesce(dropped, F.lit(False)).cast("long")
    small = df.groupBy(part, name.alias("name")).agg(F.count(F.lit(1)).alias("n"), F.sum(flag).alias("d"), F.coalesce(F.sum(removed), F.lit(0)).alias("r"), F.coalesce(F.sum(tokens), F.lit(0)).alias("t"))
    counts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "n"))), lambda x: F.concat(x["name"], F.lit(":"), x["n"].cast("string"))), ",")
    return small.groupBy(part).agg(F.sum("n").alias("rows"), F.sum("d").alias("dropped"), F.sum("r").cast("long").alias("removed_chars"), F.sum("t").cast("long").alias("tokens"), counts.alias("source_counts"))


def stale_errors(done: DataFrame, errors: DataFrame, key: str) -> DataFrame:
    """Keys of errors whose task has been done since."""
    return errors.select(key).distinct().join(done.select(key), key, "left_semi")


def regressions(actual: DataFrame, expected: DataFrame, key: str, metrics: list[str], digits: int = 3) -> DataFrame:
    """(key, metric, actual, expected, equal): each metric of both tables, rounded; one that a table lacks is null there and not equal."""
    long = [f.select(key, F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.round(F.col(m).cast("double"), digits).alias(side)) for m in metrics)))) for f, side in ((actual, "actual"), (expected, "expected"))]
    both = long[0].join(long[1], [key, "metric"], "full")
    return both.withColumn("equal", F.coalesce(F.col("actual") == F.col("expected"), F.lit(False)))


def row_groups(df: DataFrame, rows: int) -> DataFrame:
    """(path, row_group, start, rows) of a parquet scan in groups of ``rows``, from the places of rows in their files."""
    at = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at"))
    found = at.groupBy("path", F.floor(F.col("at") / rows).cast("long").alias("row_group")).agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("rows"))
    return found.select("path", "row_group", "start", "rows")


def shares(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Rows of each (outer, inner), and their share of the table and of the outer group; the windows are over the counts, not the rows."""
    counts = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("rows"))
    total, within = F.expr("sum(rows) over ()"), F.expr(f"sum(rows) over (partition by {outer})")
    return counts.select(outer, inner, "rows", F.round(F.col("rows") / total, 6).alias("of_total"), F.round(F.col("rows") / within, 6).alias("of_group"))
