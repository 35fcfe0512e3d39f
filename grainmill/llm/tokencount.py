"""Token counts of word-level BPE by rank-synchronous array merging.

Pre-tokens of a batch are held as one flat array of symbols with the number of the sequence that
each belongs to. Every round looks up the rank of each adjacent pair, finds each sequence's lowest
rank, and merges that pair wherever it stands in the sequence, in all sequences at once. A pair
with a merged symbol in it can only have a higher rank than the merge that made the symbol, so this
is the order in which the library merges. Sequences without a known pair leave; what is left of
them is their count. Words already counted are looked up instead.

A sequence of over LONG symbols is merged by itself, in the same rounds: its pairs stand in buckets
by rank, a round takes the lowest bucket and merges its pairs at once, and only pairs beside a merge
are looked up anew, so a word costs what its merges cost, not its length in every round.

The vocabulary file is read on the driver and broadcast; its size does not depend on the data.
"""

from __future__ import annotations

import json
import unicodedata
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, resident, text_or_empty

# A sigma's lower case away from a word's end, and two pairs newer than Python's tables.
_LOWER = (("\u03a3", "\u03c3"), ("\ua7cb", "\u0264"), ("\ua7dc", "\u019b"))
_SPACE = regex.compile(r"\p{White_Space}+")

#: Words whose counts a worker remembers before it starts anew; it bounds memory, not results.
REMEMBERED = 400_000
#: Symbols of a sequence that is merged by itself.
LONG = 4_000
#: Symbols merged at once.
ROUND_SYMBOLS = 1_000_000


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next code point from 256 on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Counts tokens as the library does for a vocabulary with NFC, lower case, a splitting pattern and word ends."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model, vocab = data["model"], data["model"]["vocab"]
        self.special = [t["content"] for t in data["added_tokens"]]
        self.special_split = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        split = data["pre_tokenizer"]["pretokenizers"][0]
        # In the library \s is the property White_Space.
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}"))
        alphabet, end = byte_alphabet(), model["end_of_word_suffix"]
        self.first = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + end] for c in alphabet], np.int64)
        self.base = len(vocab) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.known: dict[str, int] = {}
        self.chunk: dict[str, int] = {}

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols that each of the words ends with."""
        lengths = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.first[flat]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[flat[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.zeros(len(words), np.int64)
        none = len(self.keys)
        while len(symbols):
            pair = symbols[:-1] * self.base + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            known = (self.keys[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.rank[at], none), none)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            done = lowest == none
            counts[owner[starts[done]]] = sizes[done]
            target = np.repeat(lowest, sizes)
            hit = (rank == target) & (rank < none)
            # Of hits side by side (a pair of equal symbols) every second one overlaps its neighbour.
            where = np.flatnonzero(hit)
            if len(where) > 1:
                new_run = np.append(True, np.diff(where) > 1)
                begin = np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - begin) % 2 == 0]
            symbols[where] = self.made[at[where]]
            keep = np.repeat(~done, sizes)
            keep[where + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, symbol made) of pairs of symbols; unknown pairs have the rank after the last."""
        pair = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.rank[at], len(self.keys)), self.made[at]

    def merged_alone(self, word: bytes) -> int:
        """Number of symbols that one long word ends with."""
        flat = np.frombuffer(word, np.uint8)
        symbols = self.first[flat]
        symbols[-1] = self.last[flat[-1]]
        n, none = len(symbols), len(self.keys)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank, made = np.full(n, none), np.zeros(n, np.int64)
        rank[:-1], made[:-1] = self.ranks(symbols[:-1], symbols[1:])
        buckets: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []
        left = n

        def enter(places: np.ndarray) -> None:
            places = places[rank[places] < none]
            places = places[np.argsort(rank[places], kind="stable")]
            values, start = np.unique(rank[places], return_index=True)
            for value, part in zip(values.tolist(), np.split(places, start[1:])):
                if value not in buckets:
                    buckets[value] = []
                    heappush(queue, value)
                buckets[value].append(part)

        enter(np.arange(n - 1))
        while queue:
            lowest = heappop(queue)
            # Places whose pair has changed since they were entered are no longer of this rank.
            where = np.unique(np.concatenate(buckets.pop(lowest)))
            where = where[rank[where] == lowest]
            if not len(where):
                continue
            # Of hits side by side every second one overlaps its neighbour.
            new_run = np.append(True, after[where[:-1]] != where[1:])
            begin = np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - begin) % 2 == 0]
            gone = after[where]
            symbols[where] = made[where]
            rank[gone] = none
            after[where] = after[gone]
            follows = after[where] < n
            before[after[where[follows]]] = where[follows]
            left -= len(where)
            ends = where[after[where] >= n]
            rank[ends] = none
            changed = np.unique(np.append(where[after[where] < n], before[where][before[where] >= 0]))
            rank[changed], made[changed] = self.ranks(symbols[changed], symbols[after[changed]])
            enter(changed)
        return left

    def learn(self, words: set[str]) -> None:
        todo, size = [], 0
        for word in words:
            if len(word) > LONG:
                self.known[word] = self.merged_alone(word.encode())
                continue
            todo.append(word)
            size += len(word)
            if size > ROUND_SYMBOLS:
                self._learn(todo)
                todo, size = [], 0
        if todo:
            self._learn(todo)

    def _learn(self, words: list[str]) -> None:
        self.known.update(zip(words, self.merged([w.encode() for w in words]).tolist()))

    def chunks(self, text: str) -> tuple[list[str], int]:
        """The stretches of a text between white space, which no word spans, and how many special tokens it holds."""
        special = 0
        if self.special_split is not None and any(t in text for t in self.special):
            parts = self.special_split.split(text)
            special = len(parts) - 1
        else:
            parts = [text]
        out: list[str] = []
        for part in parts:
            part = lower(unicodedata.normalize("NFC", part))
            # str.split() also cuts at four separators that are not white space to the pattern.
            out += _SPACE.split(part) if any(c in part for c in "\x1c\x1d\x1e\x1f") else part.split()
        return out, special

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        if len(self.known) > REMEMBERED or len(self.chunk) > REMEMBERED:
            self.known, self.chunk = {}, {}
        split = [self.chunks(t) for t in texts]
        chunk = self.chunk
        new = {c: self.words.findall(c) for chunks, _ in split for c in set(chunks) if c not in chunk}
        self.learn({w for words in new.values() for w in words if w not in self.known})
        for c, words in new.items():
            chunk[c] = sum([self.known[w] for w in words])
        return [special + sum(map(chunk.__getitem__, chunks)) for chunks, special in split]


def lower(text: str) -> str:
    """Lower case of each character by itself; Python's own looks at a capital sigma's neighbours."""
    for old, new in _LOWER:
        if old in text:
            text = text.replace(old, new)
    return text.lower()


def count_tokens(df: DataFrame, vocabulary_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Strings of special tokens inside a text count as one token each, as is the library's default.
    A null text counts as empty; null ids, repeated rows and empty tables pass through; other
    columns are ignored. Texts are taken in small groups, so memory follows the longest text.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    source = in_small_batches(df).select(F.col(id_col), text_or_empty(text_col).alias("text"))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = resident("counts", WordBpe, shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column(1).to_pylist()
                counts = np.array(bpe.count(texts), np.int64)
                size = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(counts), pa.array(counts > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
