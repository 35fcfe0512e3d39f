"""Quotas, interleaving, packing, ranges and availability, as windows over what a plan lists.

A running total over a whole table would put it in one partition. running_total() deals rows to
ranges of the order instead, sums within each, and adds the total of the ranges before, of which
there are only as many as partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, order: str, value: str | None, out: str, ranges: int | None = None, by: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds the sum of ``value`` (or the number of rows) up to and with each row, in order of ``order``, then ``ties``, within each value of ``by``.

    Rows of one value of ``order`` are in one range. Nulls come first in the order; a null in ``by`` is a group.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.agg(F.percentile_approx(order, F.array(*(F.lit(n / ranges) for n in range(1, ranges))), 10_000)).first()[0] if ranges > 1 else None
    cuts = F.array(*(F.lit(c) for c in sorted(set(cuts)))) if cuts else F.array().cast(f"array<{df.schema[order].dataType.simpleString()}>")
    df = df.withColumn("__range", F.size(F.filter(cuts, lambda c: c <= F.col(order))))
    keys = ["__range", *([by] if by else [])]
    amount = F.col(value) if value else F.lit(1)
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("__sum"))
    before = Window.partitionBy(*([by] if by else [])).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*(F.col(k).alias(f"__of_{k}") for k in keys), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*keys).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    joined = df.withColumn("__within", F.sum(amount).over(within)).join(sums, same)
    return joined.withColumn(out, F.col("__within") + F.col("__before")).drop("__range", "__within", "__before", *(f"__of_{k}" for k in keys))


def month_quotas(months: DataFrame, cap: int) -> DataFrame:
    """Shares ``cap`` among distinct months, the first ones getting what is over; months are few."""
    w = Window.orderBy("month")
    n, total = F.row_number().over(w) - 1, F.count(F.lit(1)).over(Window.partitionBy())
    months = months.select("month").distinct().select("month", n.alias("n"), total.alias("total"))
    return months.select("month", (F.floor(F.lit(cap) / F.col("total")) + F.when(F.col("n") < F.lit(cap) % F.col("total"), 1).otherwise(0)).cast("long").alias("byte_quota"))


def part_quotas(quotas: DataFrame, target: int) -> DataFrame:
    """Splits each quota into parts of about ``target``, the first ones getting what is over."""
    parts = F.ceil(F.col("byte_quota") / target)
    rows = quotas.where("byte_quota > 0").withColumn("parts", F.greatest(parts, F.lit(1)).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    quota = F.floor(F.col("byte_quota") / F.col("parts")) + F.when(F.col("part") < F.col("byte_quota") % F.col("parts"), 1).otherwise(0)
    return rows.select("month", "part", quota.cast("long").alias("part_quota"))


def accept_within_quota(rows: DataFrame, quotas: DataFrame, key: str, order: str, size: str, quota: str) -> DataFrame:
    """Rows of each key up to the first that would exceed its quota: sums only grow, so that is where the running sum passes it."""
    summed = running_total(rows.join(quotas, key), order, size, "running", by=key)
    return summed.where(F.col("running") <= F.col(quota))


def round_robin(df: DataFrame, by: str, order: str) -> DataFrame:
    """Adds turn (place within its group) for an order of (turn, group): first of each group, then second of each."""
    return running_total(df, order, None, "turn", by=by)


def take_within(df: DataFrame, order: tuple[str, ...], size: str, cap: int, past: bool = False) -> DataFrame:
    """Rows in order while their sizes stay within ``cap``; with ``past`` the row that crosses it is taken too."""
    rows = running_total(df, order[0], size, "running", ties=order[1:])
    return rows.where((F.col("running") - F.col(size) < cap) if past else (F.col("running") <= cap))


def weighted_interleave(df: DataFrame, by: str, order: str, weight: Column) -> DataFrame:
    """Adds place: groups take turns, each with as many rows a turn as its weight."""
    turns = running_total(df, order, None, "n", by=by).withColumn("turn", F.floor((F.col("n") - 1) / weight).cast("long"))
    return running_total(turns, "turn", None, "place", ties=(by, "n"))


def fixed_parts(df: DataFrame, order: str, rows: int) -> DataFrame:
    """Adds part: rows in order, so many a part."""
    return running_total(df, order, None, "number").withColumn("part", F.floor((F.col("number") - 1) / rows).cast("long"))


def id_ranges(start: int, stop: int, workers: int) -> list[tuple[int, int]]:
    """[start, stop) in even ranges, none of them empty."""
    n = max(0, stop - start)
    workers = min(workers, n)
    base, over = divmod(n, workers) if workers else (0, 0)
    edges = [start]
    for k in range(workers):
        edges.append(edges[-1] + base + (k < over))
    return list(zip(edges, edges[1:]))


def range_counts(df: DataFrame, id_col: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """Rows of each range; ids outside all of them count nowhere."""
    rows = df.sparkSession.createDataFrame([(n, *r) for n, r in enumerate(ranges)], "worker int, first long, stop long")
    if ranges:
        df = df.where((F.col(id_col) >= ranges[0][0]) & (F.col(id_col) < ranges[-1][1]))
    number = F.size(F.filter(F.array(*(F.lit(r[0]) for r in ranges)), lambda c: c <= F.col(id_col))) - 1
    return df.groupBy(number.alias("worker")).agg(F.count(F.lit(1)).alias("rows")).join(rows, "worker", "right").select("worker", "first", "stop", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def availability(expected: DataFrame, done: DataFrame, errors: DataFrame, key: str) -> DataFrame:
    """Each key's status: done, error_only, missing, or orphan if it was not expected."""
    e, d, x = (f.select(key).distinct().withColumn(name, F.lit(True)) for f, name in ((expected, "e"), (done, "d"), (errors, "x")))
    rows = e.join(d, key, "full").join(x, key, "full")
    status = F.when(F.col("e").isNull(), "orphan").when(F.col("d"), "done").when(F.col("x"), "error_only").otherwise("missing")
    return rows.select(key, status.alias("status"))


def evenly_spaced(n: int, k: int) -> list[int]:
    """k of n places, ends included, halves to the even neighbour."""
    if k >= n:
        return list(range(n))
    return [0] if k == 1 else [round(i * (n - 1) / (k - 1)) for i in range(k)]


def hash_shuffle(df: DataFrame, id_col: str, seed: int, index: int = 0, count: int = 1) -> DataFrame:
    """One of ``count`` shards of the rows, in a seeded order that needs no shuffle buffer."""
    return df.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(count)) == index).orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col)
