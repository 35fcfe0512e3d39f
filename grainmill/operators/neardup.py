"""Exact and MinHash-LSH duplicates of documents, and their clusters."""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERMUTATIONS, BANDS, ROWS = 128, 16, 8
PRIME = (1 << 31) - 1
SPACES = re.compile(r"[ \t\n\x0B\f\r]+")
WORDS, LEAST_CHARS = 3, 50


def coefficients(n: int = PERMUTATIONS) -> list[tuple[int, int]]:
    """(a, b) of the affine family, from a fixed recurrence rather than a table."""
    out, x = [], 20_240_601
    for _ in range(n):
        x = x * 48_271 % PRIME
        a = x
        x = x * 48_271 % PRIME
        out.append((a, x))
    return out


def saved(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="grainmill-"))
    return df.checkpoint(eager=True)


def eligible(df: DataFrame, text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    return df.where(F.col(text).isNotNull() & (F.length(text) > least))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, sha, canonical, rank): the smallest id of each text, by an aggregate that is joined back; copies are not sorted in one task."""
    hashed = df.select(id_col, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("sha"))
    first = hashed.groupBy("sha").agg(F.min(id_col).alias("canonical"), F.count(F.lit(1)).alias("copies"))
    return hashed.join(first, "sha").select(id_col, "sha", "canonical", "copies", (F.col(id_col) == F.col("canonical")).alias("kept"))


def shingle_hashes(text: str, most_words: int | None = None) -> np.ndarray:
    """Distinct 31-bit hashes of the word shingles of a text, or of its first ``most_words`` words, from eight hex digits of their MD5."""
    words = [w for w in SPACES.split(text) if w][:most_words]
    grams = {" ".join(g) for g in zip(*(words[n:] for n in range(WORDS)))}
    return np.array([int.from_bytes(hashlib.md5(g.encode()).digest()[:4], "big") % PRIME for g in grams], np.int64)


def signature(hashes: np.ndarray, factors: np.ndarray) -> list[int]:
    """One 62-bit number per band: the minima of its permutations folded together modulo PRIME, twice."""
    least = np.full(PERMUTATIONS, PRIME, np.int64)
    for start in range(0, len(hashes), 4096):
        least = np.minimum(least, ((factors[:, :1] * hashes[None, start : start + 4096] + factors[:, 1:]) % PRIME).min(axis=1))
    high, low = np.zeros(BANDS, np.int64), np.zeros(BANDS, np.int64)
    for row in range(ROWS):
        column = least.reshape(BANDS, ROWS)[:, row]
        high, low = (high * 65_599 + column) % PRIME, (low * 31_337 + column) % PRIME
    return (high * PRIME + low).tolist()


def band_hashes(text: Column, most_words: int | None = None) -> Column:
    """The band numbers of a text; null for one with fewer than WORDS words."""
    factors = np.array(coefficients(), np.int64)

    @F.pandas_udf("array<bigint>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([signature(h, factors) if len(h := shingle_hashes(t, most_words)) else None for t in part], dtype=object)

    return run(text)


def bands(df: DataFrame, id_col: str = "doc_id", text: str = "text", done: DataFrame | None = None, most_words: int | None = None) -> DataFrame:
    """(id, band_index, band_hash) of every eligible document, those in ``done`` left out; of whole texts unless ``most_words`` is given."""
    df = eligible(df, text)
    if done is not None:
        df = df.join(done.select(id_col).distinct(), id_col, "left_anti")
    return df.select(id_col, F.posexplode(band_hashes(F.col(text), most_words)).alias("band_index", "band_hash"))


def star_links(banded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, root, shared_bands): each document with the smallest of a bucket; as good as all pairs for components."""
    first = banded.groupBy("band_index", "band_hash").agg(F.min(id_col).alias("root"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return banded.join(first, ["band_index", "band_hash"]).where(F.col(id_col) > F.col("root")).groupBy(id_col, "root").agg(F.count(F.lit(1)).alias("shared_bands"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the graph of two-column ``links``, by alternating large and small stars; each round is checkpointed."""
    links = saved(links.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
        before = now
        both = links.union(links.select("b", "a"))
        large = both.join(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        links = saved(small.select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).where("a > b").distinct())


def clusters(banded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, canonical, shared_bands) of every duplicate: the smallest document of its cluster, and the bands it shares with that one itself, 0 if none."""
    banded = saved(banded)
    found = components(star_links(banded, id_col).select(id_col, "root")).where("node <> root").select(F.col("node").alias(id_col), F.col("root").alias("canonical"))
    mine, its = banded.join(found, id_col), banded.select(F.col(id_col).alias("canonical"), "band_index", "band_hash")
    shared = mine.join(its, ["canonical", "band_index", "band_hash"]).groupBy(id_col).agg(F.count(F.lit(1)).alias("shared_bands"))
    return found.join(shared, id_col, "left").select(id_col, "canonical", F.coalesce("shared_bands", F.lit(0).cast("long")).alias("shared_bands"))


def bucket_sizes(banded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Buckets that hold more than one document: size, smallest and largest member."""
    return banded.groupBy("band_index", "band_hash").agg(F.count(F.lit(1)).alias("size"), F.min(id_col).alias("first"), F.max(id_col).alias("last")).where("size > 1")


def chains(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Canonical documents that are duplicates themselves; there should be none."""
    return found.select("canonical").distinct().join(found.select(F.col(id_col).alias("canonical")), "canonical", "left_semi")


def keep_canonical(df: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.join(found.select(id_col), id_col, "left_anti")
