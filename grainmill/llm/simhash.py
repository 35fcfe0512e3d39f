"""SimHash near-duplicates by an inverted index over byte positions with count filtering.

Two 64-bit fingerprints that differ in at most four bits agree in at least four of their eight
bytes. The index holds, for each fingerprint, postings of positional bytes; a posting joins three
positions, chosen so that any four positions contain a chosen triple (20 triples, Turan's
construction), so every pair to be found meets in some posting, and a posting is 65,536 times rarer
than that of one byte. For pairs in a posting the shared positional bytes are tallied; those with
fewer than four are dropped, the rest are verified bit by bit.

Pairs never become rows. Postings are sorted by key and compared in numpy inside a task; out come
only links that join what was not yet joined, fewer than there are fingerprints. A posting longer
than ``BLOCK`` is dealt into blocks, and each pair of blocks is a unit of work of its own, so no
task gets an unbounded group. Copies of a text share a fingerprint and are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, in_small_batches, parallelism, text_or_empty
from .components import connected_components

WORDS, SEED, BITS, BYTES = 4, 42, 4, 8
#: Fingerprints of one posting that are compared in one piece.
BLOCK = 4096
#: Postings that a task takes up before it compares them.
TAKEN = 400_000


def triples() -> list[tuple[int, int, int]]:
    """Triples of eight positions such that any four positions contain one: all within a group, or two in a group and one in the next."""
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    wanted = {(3, 0, 0), (0, 3, 0), (0, 0, 3), (2, 1, 0), (0, 2, 1), (1, 0, 2)}
    return [t for t in combinations(range(BYTES), 3) if tuple(sum(group[p] == g for p in t) for g in range(3)) in wanted]


def fingerprint(text: str) -> int:
    """64-bit SimHash of the text's word shingles; 0 for a text without words."""
    words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: -WORDS] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[part : part + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp as a signed long with the fingerprint's bits."""
    source = in_small_batches(df).select(F.col(id_col), text_or_empty(text_col).alias("text"))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=[id_col, "fp"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, fp long")


def forest(runs: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, for each run of equal ``runs``, all fingerprints within BITS bits of each other; a subset of them with the same components."""
    names, node = np.unique(prints, return_inverse=True)
    root = np.arange(len(names))
    stop = np.append(np.flatnonzero(runs[1:] != runs[:-1]) + 1, len(runs))
    end = np.repeat(stop, np.diff(np.append(0, stop)))
    left: list[int] = []
    right: list[int] = []
    at, gap = np.arange(len(runs)), 1
    while len(at := at[at + gap < end[at]]):
        other = prints[at] ^ prints[at + gap]
        shared = (other.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        near = shared >= BYTES - BITS
        near[near] = np.bitwise_count(other[near]) <= BITS
        a, b = node[at[near]], node[at[near] + gap]
        new = root[a] != root[b]
        if new.any():
            for x, y in zip(a[new].tolist(), b[new].tolist()):
                p, q = x, y
                while root[p] != p:
                    p = root[p]
                while root[q] != q:
                    q = root[q]
                if p != q:
                    root[max(p, q)] = min(p, q)
                    left.append(x)
                    right.append(y)
            while (flat := root[root]).tobytes() != root.tobytes():
                root = flat
        gap += 1
    return names[left], names[right]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by (key, part): links within each."""

    def flush(key, part, fp):
        new = np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1]))
        run = np.cumsum(new)
        # Most postings hold one fingerprint and have nothing to compare.
        size = np.bincount(run)[run]
        a, b = forest(run[size > 1], fp[size > 1].view(np.uint64)) if (size > 1).any() else (fp[:0], fp[:0])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held: list[tuple] = []
    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in range(3)))
        rows += batch.num_rows
        if rows < TAKEN:
            continue
        key, part, fp = (np.concatenate(x) for x in zip(*held))
        # The last part may go on in the next batch; its length is bounded.
        before = np.flatnonzero((key != key[-1]) | (part != part[-1]))
        cut = int(before[-1]) + 1 if len(before) else 0
        if cut:
            yield flush(key[:cut], part[:cut], fp[:cut])
        held, rows = [(key[cut:], part[cut:], fp[cut:])], len(key) - cut
    if rows:
        yield flush(*(np.concatenate(x) for x in zip(*held)))


def fingerprint_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct values of ``fp`` at BITS or fewer bits, enough for the components."""
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255) for p in range(BYTES)]
    keys = [F.lit(n << 24).cast("long") + F.shiftleft(byte[a], 16) + F.shiftleft(byte[b], 8) + byte[c] for n, (a, b, c) in enumerate(triples())]
    postings = prints.select("fp").distinct().select(F.explode(F.array(*keys)).alias("key"), "fp")
    long = postings.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    dealt = postings.join(long, "key", "left").withColumn("mine", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int"))
    other = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    # A block meets every block, itself included: parts are named by the pair, smaller number first.
    part = F.transform(other, lambda x: F.least(x, F.col("mine")) * 1_000_000 + F.greatest(x, F.col("mine")))
    dealt = dealt.select("key", F.explode(part).alias("part"), "fp")
    return dealt.repartition(parallelism(prints), "key", "part").sortWithinPartitions("key", "part").mapInArrow(_links, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 lowercase hex digits), component_id.

    component_id is the smallest id that can be reached over links of at most four bits. Null,
    empty and wordless texts have fingerprint zero and link like any other. Rows without an id are
    linked as well; where no row of a component has an id, component_id is null. Repeated rows stay
    as they are; an empty table gives an empty result; other columns are ignored.
    """
    prints = checkpoint(fingerprints(df, id_col, text_col))
    first = prints.groupBy("fp").agg(F.min(id_col).alias("first"))
    roots = connected_components(fingerprint_links(prints))
    rooted = first.join(roots, first.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, less near duplicates: of each component the row with the smallest id.

    Rows that repeat an id stay once for each text; rows without an id stay only where no row that
    has one is like them.
    """
    kept = near_duplicates(df, id_col, text_col).where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__id")).distinct()
    rows = df.join(kept, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    # Rows that repeat an id and a text may differ in other columns.
    order = f"xxhash64({', '.join(f'`{c}`' for c in df.columns)})"
    ranked = rows.withColumn("__copy", F.expr(f"row_number() over (partition by `{id_col}`, xxhash64(`{text_col}`) order by {order})"))
    return ranked.where(F.col("__copy") == 1).drop("__copy")
