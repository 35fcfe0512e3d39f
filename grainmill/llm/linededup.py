"""Line dedup by a deletion-neighbourhood join, with an edit bound of one character.

Lines within one edit have a common deletion variant: deleting position i from both gives the same
string if they differ there alone, and the longer with its extra character deleted is the shorter.
Variants are hashed, equal keys are joined by sorting, and a line is paired with the earliest lines
it meets alone, so no pairs within a group are formed; then their edit distance is computed.

Emitting a variant for every character of a corpus would cost more than reading it, so lines that
cannot have a partner are set aside first, exactly. One edit leaves the first or the last half of
the shorter line untouched. Lengths are put in bands of BAND, and a line whose length starts a band
is in the band below as well, so lines within one edit share a band, and in it the hash of their
first or last p characters, p being half the band's least length. Only lines that share such an
end with another line emit variants, and only for positions outside the shared end.

Hot groups: a batch of documents sends one row for a line, however often it occurs in it, and of
the ends that several of its lines share one row each; those lines then are known to have a
neighbour and are dealt by their own hash. The lines that occur most often (by a share of all
occurrences, so there are at most HOT of them) are spread over SPREAD tasks where occurrences are
looked up.

A line stays if none like it comes earlier, in order of document id, hash of the text, and line
number; a line within the bound of an earlier one goes with all its repeats, whether or not that
earlier one stays. Lines are told apart by 96 bits of XXH3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, in_parts, in_small_batches, parallelism, relieve

#: Lengths in one band. Lines shorter than it all emit variants.
BAND = 8
#: Lines that are looked up in SPREAD tasks: those with over one in HOT of the occurrences.
HOT, SPREAD = 1000, 64
#: Bytes of text whose lines are taken together, and characters that are hashed at once.
PART = 8_000_000
AT_ONCE = 500_000
BLANK = " \t\r"
#: Which end of a line is shared: the first or last characters by its own band, or by the band below; and that it is known to be.
FIRST, LAST, FIRST_BELOW, LAST_BELOW, MET = 1, 2, 4, 8, 16

U64 = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def bare(line: Column) -> Column:
    """What of a line is compared."""
    return F.btrim(line, F.lit(BLANK))


class Powers:
    """Powers of a base and of its inverse modulo 2**64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            size = max(n + 1, 1024)
            self.up, self.down = (np.multiply.accumulate(np.append(np.ones(1, U64), np.full(size - 1, b, U64))) for b in (self.base, self.inverse))
        return self.up, self.down


_POWERS: dict[int, Powers] = {}


class Hashes:
    """Polynomial hashes of parts of lines, all lines at once: a character at place j counts times base**j."""

    def __init__(self, lines: list[str], base: int = BASES[0]):
        powers = _POWERS.setdefault(base, Powers(base))
        self.n = np.array([len(t) for t in lines], np.int64)
        self.start = np.cumsum(self.n) - self.n
        self.place = np.arange(int(self.n.sum())) - np.repeat(self.start, self.n)
        self.up, self.down = powers.to(int(self.n.max(initial=0)))
        points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(U64)
        # The place in ``sums`` before a character holds what stands before it.
        self.sums = np.append(U64(0), np.cumsum((points + U64(0x51ED27)) * self.up[self.place], dtype=U64))
        self.inverse = U64(powers.inverse)

    def first(self, p: np.ndarray) -> np.ndarray:
        return self.sums[self.start + p] - self.sums[self.start]

    def last(self, p: np.ndarray) -> np.ndarray:
        return (self.sums[self.start + self.n] - self.sums[self.start + self.n - p]) * self.down[self.n - p]

    def without(self, flat: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Hashes of lines without the character at the places ``flat`` of all characters."""
        start, stop = self.start[owner], (self.start + self.n)[owner]
        return self.sums[flat] - self.sums[start] + (self.sums[stop] - self.sums[flat + 1]) * self.inverse


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def in_chunks(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of lines with about AT_ONCE characters."""
    start = size = 0
    for n, line in enumerate(lines):
        size += len(line)
        if size >= AT_ONCE:
            yield start, n + 1
            start, size = n + 1, 0
    if start < len(lines):
        yield start, len(lines)


def names(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(g, h) of each line: 32 and 64 bits of its XXH3."""
    found = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in lines), ">u8").reshape(-1, 2)
    return (found[:, 0] & U64(0xFFFFFFFF)).astype(np.uint32).view(np.int32), found[:, 1].astype(U64)


def reach(n: np.ndarray, below: int = 0) -> np.ndarray:
    """Characters of an end: half the least length of the band."""
    return (n // BAND - below) * BAND // 2


def ends(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, flag) of every end of every line; in the lowest band a line has one end, which is empty."""
    found = []
    for start, stop in in_chunks(lines):
        hashes = Hashes(lines[start:stop])
        n, every = hashes.n, np.arange(start, stop)
        for below, first, last in ((0, FIRST, LAST), (1, FIRST_BELOW, LAST_BELOW)):
            has = (n % BAND == 0) & (n >= BAND) if below else np.ones(len(n), bool)
            p = np.where(has, reach(n, below), 0)
            for flag, value, there in ((first, hashes.first(p), has), (last, hashes.last(p), has & (p > 0))):
                key = mixed(value + mixed((U64(4) * p.astype(U64) + U64(flag == last))))
                found.append((every[there], np.where(p > 0, key, U64(0))[there], np.full(int(there.sum()), flag)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _rows_of(batch: pa.RecordBatch, texts: list[str]):
    """(row, number, line) of every line of a batch of (id, th, text) that is not blank, in order of id, hash and number."""
    for row in np.lexsort((batch.column(1).to_numpy(), batch.column(0).to_numpy())).tolist():
        for number, raw in enumerate(texts[row].split("\n")):
            if line := raw.strip(BLANK):
                yield row, number, line


ENDS = "k long, h long, g int, id long, th long, no int, flags int, times long"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in (part for b in batches for part in in_parts(b, 2, PART)):
        at: dict[str, int] = {}
        row, number, times = [], [], []
        for r, n, line in _rows_of(batch, texts):
            if (place := at.setdefault(line, len(times))) == len(times):
                row.append(r)
                number.append(n)
                times.append(1)
            else:
                times[place] += 1
        lines = list(at)
        g, h = names(lines)
        which, key, flag = ends(lines)
        # Ends that several lines of the batch share, or that are empty: the lines are dealt by their own hash, and one row speaks for the end.
        _, one, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        shared = count[back] > 1
        met = shared | (key == 0)
        speaks = one[(count > 1) & (key[one] != 0)]
        own = mixed(key ^ h[which])
        k = np.append(np.where(met, own, key), key[speaks])
        counted = np.where(flag == FIRST, np.array(times, np.int64)[which], 0)
        flag, counted = np.append(flag | np.where(met, MET, 0), flag[speaks] | MET), np.append(counted, np.zeros(len(speaks), np.int64))
        which = np.append(which, which[speaks])
        source = pa.array(np.array(row, np.int64)[which])
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.view(np.int64)), pa.array(h[which].view(np.int64)), pa.array(g[which]), batch.column(0).take(source), batch.column(1).take(source),
             pa.array(np.array(number, np.int32)[which]), pa.array(flag.astype(np.int32)), pa.array(counted)],
            names=["k", "h", "g", "id", "th", "no", "flags", "times"],
        )
    relieve()


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in (part for b in batches for part in in_parts(b, 2, PART)):
        found = list(_rows_of(batch, texts))
        row, number, lines = ([f[n] for f in found] for n in range(3))
        g, h = names(lines)
        source = pa.array(np.array(row, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(source), batch.column(1).take(source), pa.array(np.array(number, np.int32)), pa.array(g), pa.array(h.view(np.int64))], names=["id", "th", "no", "g", "h"])
    relieve()


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (seq, ends, line): (key, check, place, seq) of the line itself, with place -1, and of what is left of it without one character."""
    for batch in batches:
        seq, flags, lines = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
        for start, stop in in_chunks(lines):
            one, two = (Hashes(lines[start:stop], base) for base in BASES)
            n, f, s = one.n, flags[start:stop], seq[start:stop]
            left, right = n.copy(), np.zeros_like(n)
            for below, first, last in ((0, FIRST, LAST), (1, FIRST_BELOW, LAST_BELOW)):
                p = reach(n, below)
                left = np.where(f & first, np.minimum(left, p), left)
                right = np.where(f & last, np.maximum(right, n - p), right)
            owner = np.repeat(np.arange(len(n)), n)
            flat = np.flatnonzero((one.place >= left[owner]) | (one.place < right[owner]))
            owner = owner[flat]
            key, check = (mixed(np.append(x.first(n), x.without(flat, owner))) for x in (one, two))
            place = np.append(np.full(len(n), -1), one.place[flat]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array((check >> U64(32)).astype(np.uint32).view(np.int32)), pa.array(place), pa.array(np.append(s, s[owner]))], names=["key", "check", "place", "seq"])


def meetings(key: np.ndarray, check: np.ndarray, place: np.ndarray, seq: np.ndarray) -> tuple[list[int], list[int]]:
    """(line, earlier line) from variants sorted by (key, check, seq): the earliest with the same place cut, and the earliest of the other kind."""
    later: list[int] = []
    earlier: list[int] = []
    new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    many = np.flatnonzero(size[group] > 1)
    before, whole, cut, cuts = -1, None, None, {}
    for at, p, s in zip(group[many].tolist(), place[many].tolist(), seq[many].tolist()):
        if at != before:
            before, whole, cut, cuts = at, None, None, {}
        for other in (cut,) if p < 0 else (whole, cuts.setdefault(p, s)):
            if other is not None and other != s:
                later.append(s)
                earlier.append(other)
        if p < 0:
            whole = s if whole is None else whole
        else:
            cut = s if cut is None else cut
    return later, earlier


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [c.to_numpy() for c in batch.columns]
        if held is not None:
            rows = [np.append(a, b) for a, b in zip(held, rows)]
        # The last group may go on; one key and place differ in a letter, so it is no larger than an alphabet times a run of one letter.
        other = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
        end = int(other[-1]) + 1 if len(other) else 0
        held = [r[end:] for r in rows]
        if end:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in meetings(*(r[:end] for r in rows))], names=["seq", "witness"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in meetings(*held)], names=["seq", "witness"])


def within_one(a: str, b: str) -> bool:
    """Whether the edit distance is at most one; linear in the lines' length."""
    if abs(len(a) - len(b)) > 1:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    shift = len(b) - len(a)
    return a[low + (shift <= 0) :] == b[low + (shift >= 0) :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, h) of the pairs (g, h, line, earlier) that are within one edit."""
    for batch in batches:
        keep = [within_one(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["g", "h"]).filter(pa.array(keep, pa.bool_()))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text): rows with an id and a text; th tells rows of one id apart."""
    text = F.col(text_col).cast("string")
    return in_small_batches(df).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _meeting(rows: DataFrame) -> DataFrame:
    """(g, h, id, th, no, ends, times): distinct lines that occur again or share an end with another, with their first place; ``ends`` are those shared."""
    by_end = "over (partition by k)"
    found = rows.mapInArrow(_ends, ENDS).selectExpr("*", f"count(1) {by_end} as many", f"min(h) {by_end} <> max(h) {by_end} or max(flags) {by_end} >= {MET} as met")
    found = found.where((F.col("many") > 1) | (F.col("times") > 1) | (F.col("flags") >= MET))
    shared = F.when(F.col("met"), F.col("flags").bitwiseAND(MET - 1)).otherwise(0)
    return found.groupBy("g", "h").agg(F.min(F.struct("id", "th", "no")).alias("first"), F.bit_or(shared).alias("ends"), F.sum("times").alias("times")).select("g", "h", "first.*", "ends", "times")


def _with_text(met: DataFrame, rows: DataFrame) -> DataFrame:
    """(seq, ends, line, g, h) of lines that share an end; seq is in order of their first places."""
    wanted = met.where("ends > 0").groupBy("id", "th").agg(F.collect_list(F.struct("no", "ends", "g", "h")).alias("wanted"))
    found = rows.join(wanted, ["id", "th"]).withColumn("lines", lines_of(F.col("text")))
    pick = F.transform("wanted", lambda w: F.struct(w["no"].alias("no"), w["ends"].alias("ends"), w["g"].alias("g"), w["h"].alias("h"), bare(F.get("lines", w["no"])).alias("line")))
    lines = checkpoint(found.select("id", "th", F.inline(pick)).dropDuplicates(["id", "th", "no"]))
    ordered = lines.repartitionByRange(parallelism(lines), "id", "th", "no").sortWithinPartitions("id", "th", "no")
    return checkpoint(ordered.select(F.monotonically_increasing_id().alias("seq"), "ends", "line", "g", "h"))


def _near(lines: DataFrame) -> DataFrame:
    """(g, h) of lines within one edit of an earlier one."""
    variants = lines.select("seq", "ends", "line").mapInArrow(_variants, "key long, check int, place int, seq long")
    variants = variants.repartition(parallelism(lines), "key").sortWithinPartitions("key", "check", "seq")
    pairs = variants.mapInArrow(_meetings, "seq long, witness long").distinct()
    one, other = lines.select("seq", "line", "g", "h"), lines.select(F.col("seq").alias("witness"), F.col("line").alias("earlier"))
    return pairs.join(one, "seq").join(other, "witness").select("g", "h", "line", "earlier").mapInArrow(_verified, "g int, h long").distinct()


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, removed): the numbers, from 0, of each document's lines that repeat an earlier one, ascending; documents without any have no row.

    th is xxhash64 of the text. Lines are compared without blanks around them; blank lines take no
    part. Ids have to be integers. Rows that repeat an id with another text are documents of their
    own, in order of th; rows that repeat both are one document. Rows without an id or text take no
    part.
    """
    rows = _rows(df, id_col, text_col)
    met = checkpoint(_meeting(rows))
    near = _near(_with_text(met, rows)).withColumn("gone", F.lit(True))
    kinds = met.join(near, ["g", "h"], "left").where("gone or times > 1")
    # At most HOT lines have over one in HOT of these occurrences each.
    total = met.agg(F.sum("times")).first()[0] or 0
    hot = met.where(F.col("times") * HOT > total).select("g", "h", F.lit(SPREAD).alias("spread"))
    places = rows.mapInArrow(_occurrences, "id long, th long, no int, g int, h long").join(F.broadcast(hot), ["g", "h"], "left")
    places = places.withColumn("part", F.when(F.col("spread").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "th"), F.lit(SPREAD)).cast("int"))).drop("spread")
    spread = F.when(F.col("times") * HOT > total, SPREAD).otherwise(1)
    kinds = kinds.select("g", "h", F.struct("id", "th", "no").alias("first"), F.coalesce("gone", F.lit(False)).alias("gone"), F.explode(F.sequence(F.lit(0), spread - 1)).alias("part"))
    removed = places.join(kinds, ["g", "h", "part"]).where(F.col("gone") | (F.struct("id", "th", "no") != F.col("first")))
    return removed.groupBy("id", "th").agg(F.array_sort(F.collect_set("no")).alias("removed"))


def _beside(df: DataFrame, gone: DataFrame, id_col: str, th: Column) -> DataFrame:
    """Adds __removed to the rows of ``df``."""
    gone = gone.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("removed").alias("__removed"))
    return df.join(gone, (F.col(id_col).cast("long") == F.col("__id")) & (th == F.col("__th")), "left")


def line_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_lines, n_removed, removed (numbers of the removed lines, from 0).

    A null text has no lines, an empty one has one. An empty table gives an empty result; other
    columns are ignored.
    """
    gone = repeated_lines(df, id_col, text_col)
    text = F.col(text_col).cast("string")
    lines = F.when(text.isNull(), 0).otherwise(F.size(lines_of(text)))
    rows = df.select(F.col(id_col), lines.cast("long").alias("n_lines"), F.xxhash64(text).alias("__own"))
    rows = _beside(rows, gone, id_col, F.col("__own"))
    removed = F.coalesce("__removed", F.array().cast("array<int>"))
    return rows.select(id_col, "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``df`` with the repeated lines taken out of the text.

    Texts that lose none stay as they are; rows of which only blanks are left go.
    """
    text = F.col(text_col).cast("string")
    rows = _beside(df, repeated_lines(df, id_col, text_col), id_col, F.xxhash64(text))
    rows = rows.withColumn("__lines", F.when(F.col("__removed").isNotNull(), lines_of(text)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__removed"))
    text = F.array_join(F.transform(kept, lambda n: F.get("__lines", n)), "\n")
    rows = rows.withColumn(text_col, F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(text))
    return rows.where(F.col("__removed").isNull() | F.col(text_col).rlike(r"\S")).select(*df.columns)
