"""The unified projection, the validated merge of per-document tables, and threads from posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, schema: dict[str, str], renamed: dict[str, str] | None = None) -> DataFrame:
    """Every column of ``schema`` (name to type), cast; absent ones are typed nulls. ``renamed`` maps a target to its source column."""
    renamed = renamed or {}
    return df.select(*((F.col(renamed.get(n, n)) if renamed.get(n, n) in df.columns else F.lit(None)).cast(kind).alias(n) for n, kind in schema.items()))


def passed_through(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names})


def audit(left: DataFrame, right: DataFrame, key: str, checked: list[str]) -> DataFrame:
    """(key, problem) of every row of two tables that should match one to one and agree on ``checked``."""
    a, b = left.alias("a"), right.alias("b")
    rows = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    problem = F.when(F.col(f"a.{key}").isNull(), "missing_left").when(F.col(f"b.{key}").isNull(), "missing_right")
    for c in checked:
        problem = problem.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), f"mismatch_{c}")
    return rows.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), problem.alias("problem")).where("problem is not null")


def merge(left: DataFrame, right: DataFrame, key: str, checked: list[str], added: list[str]) -> DataFrame:
    """The left rows with ``added`` columns of the right; a row that disagrees on ``checked``, or has no partner, raises an error as it is read."""
    marked = right.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in checked), *added)
    rows = left.join(marked, F.col(key) == F.col("__key"), "left")
    same: Column = F.col("__key").isNotNull()
    for c in checked:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    failure = F.raise_error(F.concat(F.lit("rows do not match at "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return rows.withColumn(key, F.when(same, F.col(key)).otherwise(failure.cast(left.schema[key].dataType))).drop("__key", *(f"__{c}" for c in checked))


def threads(posts: DataFrame, thread: str, order: str, author: str, text: str) -> DataFrame:
    """One document per thread: its posts in order as 'author: text', and how many there are."""
    said = F.concat(F.col(author), F.lit(": "), F.coalesce(F.col(text), F.lit("")))
    entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), said.alias("t"))))
    rows = posts.groupBy(thread).agg(entries.alias("e"))
    return rows.select(thread, F.size("e").cast("long").alias("posts"), F.array_join(F.transform("e", lambda x: x["t"]), "\n").alias("text"))


def first_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key, the first in order."""
    return df.groupBy(key).agg(F.min_by(F.struct(*(c for c in df.columns if c != key)), order).alias("r")).select(key, "r.*")


def numbered(df: DataFrame, known: DataFrame, id_col: str, order: str) -> DataFrame:
    """New rows get ids after the largest known one."""
    from grainmill.operators.planning import running_total

    last = known.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]
    return running_total(df, order, None, "__n").withColumn(id_col, (F.col("__n") + F.lit(last)).cast("long")).drop("__n")
