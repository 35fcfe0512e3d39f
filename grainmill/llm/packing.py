"""Best-fit packing of tokenized documents by a grouping genetic algorithm on islands.

A chromosome is a packing, its genes are whole bins. Crossover injects some of the best-filled bins
of one parent into the other, removes the bins that hold items twice by that, and puts the items
this displaced back by best fit, longest first (Falkenauer's grouping genetic algorithm).

Items are dealt at random to blocks of about ``BLOCK``; the blocks' number grows with the input and
their size does not. Each block is evolved on ISLANDS islands from different seeds; after an epoch
the elites of each island move on to the next one, in a shuffle, and another epoch follows. An
island stops early when it reaches a lower bound on the number of bins. Pieces that fill a sequence
alone need no packing.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, in_parts, in_small_batches, resident, text_or_empty
from .tokencount import byte_alphabet

BLOCK, ISLANDS, EPOCHS, GENERATIONS, POPULATION, ELITES = 4096, 3, 2, 5, 6, 2
#: Stretches of text, and pre-tokens, whose ids a worker remembers before it keeps only those of the text at hand; it bounds memory, not results.
REMEMBERED = 400_000
#: Bytes of text whose ids are looked up at once.
AT_ONCE = 6_000_000

# Where a space stands inside a run of white space, or ends a text after other white space: no place to cut. \s is more than the property White_Space.
_NO_CUT = re.compile(r"\s \s|\s \Z")
# Fixed value: the pattern by which byte-level vocabularies split a text; white space is that property.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def gathered(start: np.ndarray, length: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``start``, one after the other."""
    end = np.cumsum(length)
    return flat[np.repeat(start - (end - length), length) + np.arange(int(end[-1]) if len(end) else 0)]


class Store:
    """Ids of distinct strings, as flat arrays; ``make`` gives (lengths, ids) of strings not seen before."""

    def __init__(self, make):
        self.make, self.keys = make, pa.array([], pa.string())
        self.start = self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def find(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) in ``flat`` of each of the distinct strings ``keys``."""
        at = pc.index_in(keys, value_set=self.keys)
        missing = pc.is_null(at).to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if missing.any():
            new = keys.filter(pa.array(missing))
            length, ids = self.make(new)
            if len(self.keys) + len(new) > REMEMBERED:
                kept = at[~missing]
                self.keys, self.flat = keys.filter(pa.array(~missing)), gathered(self.start[kept], self.length[kept], self.flat)
                self.length = self.length[kept]
                self.start = np.cumsum(self.length) - self.length
                at[~missing] = np.arange(len(kept))
            at[missing] = np.arange(len(self.keys), len(self.keys) + len(new))
            self.start = np.append(self.start, len(self.flat) + np.cumsum(length) - length)
            self.length = np.append(self.length, length)
            self.keys, self.flat = pa.concat_arrays([self.keys, new]), np.append(self.flat, ids)
        return self.start[at], self.length[at]


def _all_of(store: Store, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(length, ids) of strings that may repeat."""
    coded = strings.dictionary_encode()
    start, length = store.find(coded.dictionary)
    index = coded.indices.to_numpy()
    return length[index], gathered(start[index], length[index], store.flat)


class Ids:
    """Ids of whole texts by the tokenizers library, as little-endian unsigned 32-bit bytes.

    No pre-token spans the place before a space unless that space stands inside a run of white
    space. Texts are cut there, and the distinct stretches of a batch, and the distinct pre-tokens
    in those not seen before, are looked up at once; only new pre-tokens go through the library's
    merge model. Texts with spaces inside a run of white space, or with the string of a special
    token, are encoded whole.
    """

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = dict(enumerate(byte_alphabet()))
        self.words, self.stretches = Store(self._merge), Store(self._split)

    def _merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(pc.binary_length(words).to_numpy()).tolist()
        letters = "".join(words.to_pylist()).encode().decode("latin-1").translate(self.letters)
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(letters[a:b])] for a, b in zip([0, *ends], ends)]
        return np.fromiter(map(len, found), np.int64, len(found)), np.fromiter(chain.from_iterable(found), np.uint32)

    def _split(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # Stretches of a space and a word join to a text that splits as they do; others are split one by one.
        size = pc.utf8_length(stretches).to_numpy()
        first = pc.equal(pc.utf8_slice_codeunits(stretches, 0, 1), " ").to_numpy(zero_copy_only=False)
        space = [pc.utf8_is_space(e).to_numpy(zero_copy_only=False) for e in (pc.utf8_slice_codeunits(stretches, 1, 2), pc.utf8_slice_codeunits(stretches, -1))]
        plain = (size > 1) & first & ~space[0] & ~space[1]
        words = SPLIT.findall("".join(stretches.filter(pa.array(plain)).to_pylist()))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        counts = np.zeros(len(stretches), np.int64)
        counts[plain] = np.diff(np.searchsorted(ends, np.cumsum(size[plain]), side="left") + 1, prepend=0)
        others = [SPLIT.findall(t) for t in stretches.filter(pa.array(~plain)).to_pylist()]
        counts[~plain] = [len(o) for o in others]
        length, ids = _all_of(self.words, pa.array(words + [w for o in others for w in o], pa.string()))
        # Words stand in order of plain stretches, then others.
        order = np.append(np.flatnonzero(plain), np.flatnonzero(~plain))
        before = np.append(0, np.cumsum(length))
        last = np.cumsum(counts[order])
        start, stop = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        start[order], stop[order] = before[last - counts[order]], before[last]
        return stop - start, gathered(start, stop - start, ids)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def can_be_cut(self, text: str) -> bool:
        # Printable but for newlines: then the only white space is these and the plain space.
        plain = text.replace("\n", "").isprintable() and "  " not in text and "\n " not in text
        return (plain or not _NO_CUT.search(text)) and not any(s in text for s in self.special)

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [self.can_be_cut(t) for t in texts]
        parts = pc.split_pattern(pa.array([t if c else "" for t, c in zip(texts, cut)], pa.string()), " ")
        flat, offsets = parts.flatten().cast(pa.string()), parts.offsets.to_numpy()
        first = np.zeros(len(flat), bool)
        first[offsets[:-1]] = True
        heads, rest = flat.filter(pa.array(first)).dictionary_encode(), flat.filter(pa.array(~first)).dictionary_encode()
        spaced = pc.binary_join_element_wise("", rest.dictionary, " ")
        keys = pa.concat_arrays([heads.dictionary, spaced]).dictionary_encode()
        start, length = self.stretches.find(keys.dictionary)
        place = keys.indices.to_numpy()
        index = np.empty(len(flat), np.int64)
        index[first] = place[heads.indices.to_numpy()]
        index[~first] = place[len(heads.dictionary) + rest.indices.to_numpy()]
        ids = gathered(start[index], length[index], self.stretches.flat).astype("<u4", copy=False)
        bounds = np.append(0, np.cumsum(length[index]))[offsets].tolist()
        return [(ids[a:b] if c else self.whole(t)).tobytes() for t, c, a, b in zip(texts, cut, bounds, bounds[1:])]


def pieces_of(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32): the whole if it fits; else pieces of ``capacity``, of which the first may be shorter."""
    total = len(ids) // 4
    first = total if total <= capacity else (total % capacity or capacity)
    bounds = [0, *range(first, total + 1, capacity)]
    return [(n, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for n, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def pieces(df: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids with ``end_id`` at the end."""
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    source = in_small_batches(df).select(F.col(id_col), text_or_empty(text_col).alias("text"))
    kind = source.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = resident("ids", Ids, shared.value)
        for batch in batches:
            for part, texts in in_parts(batch, 1, AT_ONCE):
                found = [pieces_of(ids + end, capacity) for ids in encode(texts)]
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                numbers = np.array([p for f in found for p in f], np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(numbers[:, 0].astype(np.int32)), *(pa.array(numbers[:, n]) for n in (1, 2, 3))], names=[id_col, "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Martello and Toth's L2: no packing has fewer bins."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    total = np.cumsum(count * np.arange(capacity + 1))
    number = np.cumsum(count)
    best = -(-int(total[-1]) // capacity)
    for low in range(1, capacity // 2 + 1):
        # Items above capacity - low share a bin with none from low on; those above half not with each other.
        large = int(number[-1] - number[capacity - low])
        middle = int(number[capacity - low] - number[capacity // 2])
        middle_sum = int(total[capacity - low] - total[capacity // 2])
        small_sum = int(total[capacity // 2] - total[low - 1])
        best = max(best, large + middle + max(0, -(-(small_sum - (middle * capacity - middle_sum)) // capacity)))
    return best


class Bins:
    """Best fit by free space: a bin set for each, and a bit mask of those that are not empty."""

    def __init__(self, free: list[int], capacity: int):
        self.by: dict[int, list[int]] = {}
        self.mask, self.used, self.capacity = 0, len(free), capacity
        for b, space in enumerate(free):
            self.add(b, space)

    def add(self, b: int, space: int) -> None:
        if space > 0:
            self.by.setdefault(space, []).append(b)
            self.mask |= 1 << space

    def place(self, size: int) -> int:
        fits = self.mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            bins = self.by[space]
            b = bins.pop()
            if not bins:
                self.mask ^= 1 << space
        else:
            b, space = self.used, self.capacity
            self.used += 1
        self.add(b, space - size)
        return b


def best_fit(order: np.ndarray, sizes: np.ndarray, capacity: int, assign: np.ndarray, free: list[int]) -> np.ndarray:
    """Puts the items of ``order`` into bins with ``free`` space or new ones; ``assign`` gets their bins."""
    bins = Bins(free, capacity)
    assign[order] = [bins.place(s) for s in sizes[order].tolist()]
    return assign


def fitness(assign: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """(bins, -mean squared fill): less is better."""
    fill = np.bincount(assign, sizes)
    return len(fill), -float(np.mean((fill / capacity) ** 2))


def crossover(giver: np.ndarray, taker: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    fill = np.bincount(giver, sizes)
    # Whole bins of the giver, the fuller the likelier.
    count = max(1, int(len(fill) * rng.uniform(0.05, 0.4)))
    chosen = np.zeros(len(fill), bool)
    chosen[np.argsort(-(fill + rng.uniform(0, capacity / 4, len(fill))))[:count]] = True
    injected = chosen[giver]
    # Bins of the taker that hold an injected item go; their other items are displaced.
    broken = np.zeros(taker.max() + 1, bool)
    broken[taker[injected]] = True
    displaced = broken[taker] & ~injected
    kept = ~broken[taker]
    child = np.empty(len(sizes), np.int64)
    names = np.cumsum(chosen) - 1
    child[injected] = names[giver[injected]]
    names = np.cumsum(~broken) - 1 + count
    child[kept] = names[taker[kept]]
    there = injected | kept
    free = (capacity - np.bincount(child[there], sizes[there])).astype(int).tolist()
    order = np.flatnonzero(displaced)
    return best_fit(order[np.argsort(-sizes[order], kind="stable")], sizes, capacity, child, free)


def evolve(sizes: np.ndarray, capacity: int, seed: int, arrived: list[np.ndarray]) -> list[np.ndarray]:
    """One epoch of an island: the elites, best first. The first packing is best fit by falling size."""
    rng = np.random.default_rng(seed)
    scored = [(fitness(a, sizes, capacity), a) for a in arrived]
    falling = np.argsort(-sizes, kind="stable")
    bound = lower_bound(sizes, capacity)
    if not arrived:
        scored.append((fitness(a := best_fit(falling, sizes, capacity, np.empty(len(sizes), np.int64), []), sizes, capacity), a))
    best = min(s[0][0] for s in scored)
    while len(scored) < POPULATION and best > bound:
        order = np.argsort(-sizes * rng.uniform(0.8, 1.0, len(sizes)), kind="stable")
        scored.append((fitness(a := best_fit(order, sizes, capacity, np.empty(len(sizes), np.int64), []), sizes, capacity), a))
        best = min(best, scored[-1][0][0])
    for _ in range(GENERATIONS):
        scored.sort(key=lambda s: s[0])
        if scored[0][0][0] <= bound:
            break
        keep = scored[: max(2, POPULATION // 2)]
        children = []
        for _ in range(POPULATION - len(keep)):
            giver, taker = rng.choice(len(keep), 2, replace=False)
            a = crossover(keep[giver][1], keep[taker][1], sizes, capacity, rng)
            children.append((fitness(a, sizes, capacity), a))
        scored = keep + children
    scored.sort(key=lambda s: s[0])
    return [a for _, a in scored[:ELITES]]


ELITE = "block long, island int, bins long, fill double, assign binary"


def _epoch(capacity: int, epoch: int):
    def run(key, items: pd.DataFrame, arrived: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("item")
        sizes = items["length"].to_numpy(np.int64)
        if not len(sizes):
            return pd.DataFrame(columns=["block", "island", "bins", "fill", "assign"])
        block, island = int(key[0]), int(key[1])
        elites = evolve(sizes, capacity, (block * ISLANDS + island) * EPOCHS + epoch, [np.frombuffer(a, "<i4").astype(np.int64) for a in sorted(arrived["assign"])])
        return pd.DataFrame([(block, island, *fitness(a, sizes, capacity), a.astype("<i4").tobytes()) for a in elites], columns=["block", "island", "bins", "fill", "assign"])

    return run


def _settle(key, items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
    """Sequences and places of a block's items."""
    items = items.sort_values("item")
    items["sequence_id"] = (int(key[0]) << 24) + np.frombuffer(best["assign"].iloc[0], "<i4").astype(np.int64)
    items["offset"] = items.groupby("sequence_id")["length"].cumsum() - items["length"]
    return items.drop(columns=["block"])


def pack(items: DataFrame, capacity: int, block: int = BLOCK) -> DataFrame:
    """Adds sequence_id and offset to rows with item (a distinct long) and length (1 to ``capacity``); ``items`` has to be a checkpoint or table, as it is read several times."""
    count = items.where(F.col("length") < capacity).count()
    blocks = max(1, -(-count // block))
    alone = items.where(F.col("length") >= capacity).select("*", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("length") < capacity).withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    spread = rest.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "item", "length")
    elites = items.sparkSession.createDataFrame([], ELITE)
    for epoch in range(EPOCHS):
        elites = spread.groupBy("block", "island").cogroup(elites.groupBy("block", "island")).applyInPandas(_epoch(capacity, epoch), ELITE)
        if epoch + 1 < EPOCHS:
            # Elites stay where they are, and a copy moves on to the next island.
            hosts = F.array(F.col("island"), ((F.col("island") + 1) % ISLANDS).cast("int"))
            elites = elites.select("block", F.explode(hosts).alias("host"), "bins", "fill", "assign").withColumnRenamed("host", "island")
    best = elites.groupBy("block").agg(F.min_by("assign", F.struct("bins", "fill", "island")).alias("assign"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    settled = rest.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(_settle, f"{schema}, sequence_id long, offset long")
    return settled.unionByName(alone)


def pack_documents(df: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Pack the ids of all documents, each with ``end_id`` at its end, into sequences of at most ``capacity``.

    One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset. Documents of more
    than ``capacity`` ids are cut into pieces of just that many, of which the first may be shorter.
    A null text counts as empty (its piece is the end id); rows without id and repeated rows are
    documents like others; an empty table gives an empty result; other columns are ignored.
    """
    cut = pieces(df, tokenizer_path, capacity, end_id, id_col, text_col)
    items = checkpoint(cut.withColumn("item", F.monotonically_increasing_id()))
    return pack(items, capacity, block).drop("item")
