"""Jump consistent hashing: keys to shards without a ring table (Lamping and Veach, 2014).

A 64-bit key seeds a linear congruential generator; each draw gives the next shard count at which
the key would move. The last such count below ``n`` is the key's shard among ``n``. Going from
``n`` to ``n + 1`` shards, a key stays or moves to shard ``n``; about 1 / (n + 1) of them move.

Spark's arithmetic checks for overflow, so the generator's state is kept as two 32-bit halves in
longs; everything is a built-in expression, and one walk gives the shard for ``n`` and ``n + 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U32, text_or_empty

# The generator of the published algorithm, state * MULTIPLIER + 1 modulo 2**64.
MULTIPLIER = 2862933555777941757

M_HIGH, M_MID, M_LOW = MULTIPLIER >> 32, MULTIPLIER >> 16 & 0xFFFF, MULTIPLIER & 0xFFFF


def _advance(hi: Column, lo: Column) -> tuple[Column, Column]:
    """The generator's next state from halves of 32 bits; no product passes 2**62."""
    mid = lo * M_MID
    low = lo * M_LOW + F.shiftleft(mid.bitwiseAND(0xFFFF), 16) + 1
    high = F.shiftright(low, 32) + F.shiftright(mid, 16) + (lo * M_HIGH).bitwiseAND(U32) + hi * M_LOW + F.shiftleft((hi * M_MID).bitwiseAND(0xFFFF), 16)
    return high.bitwiseAND(U32), low.bitwiseAND(U32)


def jump(key: Column, shards: int) -> Column:
    """struct(shard, grown): the shard of a long key among ``shards`` and among one more. Null keys count as 0."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def state(hi, lo, at, shard, grown):
        return F.struct(hi.alias("hi"), lo.alias("lo"), at.alias("at"), shard.cast("int").alias("shard"), grown.cast("int").alias("grown"))

    def step(acc, _):
        hi, lo = _advance(acc["hi"], acc["lo"])
        at = F.floor((acc["at"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(hi, 1) + 1).cast("double")))
        moved = state(hi, lo, at, F.when(acc["at"] < shards, acc["at"]).otherwise(acc["shard"]), acc["at"])
        return F.when(acc["at"] > shards, acc).otherwise(moved)

    zero = F.lit(0).cast("long")
    start = state(F.shiftrightunsigned(key, 32), key.bitwiseAND(U32), zero, zero, zero)
    # Each step moves to a larger shard number, so shards + 1 steps always suffice.
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step, lambda acc: F.struct(acc["shard"], acc["grown"]))


def lane_of(key: Column, lanes: int) -> Column:
    """One of ``lanes`` from the lower half of the generator's next state, which the first jump does not look at."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    _, lo = _advance(F.shiftrightunsigned(key, 32), key.bitwiseAND(U32))
    return F.shiftright(lo * lanes, 32).cast("int")


def key_of(df: DataFrame, id_col: str) -> Column:
    """Integer ids are their own key; other types are hashed."""
    kind = df.schema[id_col].dataType.typeName()
    return F.col(id_col).cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(id_col)


def shard_documents(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", lanes: int = 64) -> DataFrame:
    """Deal rows to ``shards`` by jump hash of the id and number the rows of each shard from 0.

    One row per input row: id, size (UTF-8 bytes of the text, 0 for null, plus 16), text_crc32,
    law ('key'), shard, slot, grown_shard.

    Slots need no task that holds a whole shard: rows go to ``lanes`` lanes per shard, are numbered
    within a lane, and a lane's first slot is the number of rows in the lanes before it. The table
    of these starts has shards * lanes rows whatever the input, so it may be broadcast; counting
    reads only the id column.

    Null ids have key 0; a null text has size 16 and the CRC of an empty text; repeated rows each
    get a slot of their own; an empty table gives an empty result; other columns are ignored.
    """
    placed = jump(key_of(df, id_col), shards)
    # The lane depends on the id alone, so counting it needs no other column.
    lane = lane_of(key_of(df, id_col), lanes)
    starts = df.select(placed["shard"].alias("shard"), lane.alias("lane")).groupBy("shard", "lane").count()
    starts = starts.select("shard", "lane", F.expr("sum(count) over (partition by shard order by lane rows between unbounded preceding and current row) - count").alias("start"))
    rows = df.select(
        F.col(id_col), (F.octet_length(text_or_empty(text_col)).cast("long") + 16).alias("size"),
        F.crc32(text_or_empty(text_col).cast("binary")).alias("text_crc32"), placed.alias("placed"), lane.alias("lane"),
    ).select(id_col, "size", "text_crc32", F.col("placed.shard").alias("shard"), F.col("placed.grown").alias("grown_shard"), "lane")
    numbered = rows.withColumn("at", F.expr(f"row_number() over (partition by shard, lane order by `{id_col}`, size, text_crc32) - 1"))
    return numbered.join(F.broadcast(starts), ["shard", "lane"]).select(
        id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("at")).cast("long").alias("slot"), "grown_shard"
    )
