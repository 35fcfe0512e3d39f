"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds all substrings of a sample of labelled text. A text is
parsed against it into phrases, each the longest match from where the last one ended (Ziv and
Merhav, 1993); phrases times log2 of the sample's length, per symbol of the text, estimates the
cross entropy, and the language with the least of it wins.

Following an automaton from its root needs no suffix links, so the greedy parse is a finite
automaton: where no transition exists, a phrase ends and the next begins with that symbol. Its
table is one flat array over all languages, and the parse advances all languages and some ten
thousand stretches of text at once, one gather a step. Stretches of ``STRETCH`` symbols are parsed
as if a phrase began with each; then the parse of the stretch before is carried over the seam, side
by side with that one, until both are in the same state, from where on they are the same. So the
phrases are those of the whole text in one parse.

Symbols: lower-cased letters and marks; any run of other characters is one separator.

The fit takes a bounded sample, ``sample_texts`` distinct texts a language (those of least hash);
of a text longer than ``sample_chars`` characters, pieces of PIECE characters spread evenly over the
whole of it. Copies count once, whatever their share of the rows.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_parts, in_small_batches, resident

#: Symbols that are parsed side by side with those of other stretches.
STRETCH = 1024
#: Letters with a code of their own; others share SHARED codes by code point.
OWN, SHARED = 190, 16
#: Characters of a piece of a long sampled text.
PIECE = 100
#: Symbols from which a text that no language compresses can be told from a short one.
ENOUGH = 40


class Automaton:
    """Suffix automaton of a sequence of symbols, with the number of places where each state's strings end."""

    def __init__(self, symbols):
        self.next, link, length, places = [{}], [-1], [0], [0]
        last = 0
        for c in symbols:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            places.append(1)
            at = last
            while at != -1 and c not in self.next[at]:
                self.next[at][c] = new
                at = link[at]
            if at != -1:
                old = self.next[at][c]
                if length[old] == length[at] + 1:
                    link[new] = old
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[old]))
                    length.append(length[at] + 1)
                    link.append(link[old])
                    places.append(0)
                    while at != -1 and self.next[at].get(c) == old:
                        self.next[at][c] = clone
                        at = link[at]
                    link[old] = link[new] = clone
            last = new
        for state in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
            places[link[state]] += places[state]
        self.places = places


class Model:
    """Parses texts against the samples of several languages."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.names = [name for name, _ in samples]
        count = Counter(c for _, texts in samples for t in texts for c in t.lower() if unicodedata.category(c)[0] in "LM")
        own = {c: 1 + n for n, (c, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0]))[:OWN])}
        base = 1 + len(own)
        self.code = np.zeros(0x110000, np.uint8)
        self.letter = np.zeros(0x110000, bool)
        for point in range(0x110000):
            kind = unicodedata.category(c := chr(point))[0]
            if kind in "LM":
                low = c.lower()[0]
                self.code[point] = own.get(low) or base + ord(low) % SHARED
                self.letter[point] = kind == "L"
        self.width = width = base + SHARED
        sequences = [np.concatenate([self.symbols("\n".join(texts)), np.zeros(1, np.uint8)]) for _, texts in samples]
        # An automaton has fewer states than twice the symbols; pages that are not written to take no memory.
        cells = sum(2 * len(q) + 2 for q in sequences) * width
        if cells >= 2**30:
            raise ValueError("the samples are too large for one table: take fewer or shorter texts")
        table, starts, sizes, places, at = np.empty(cells + 1, np.int32), [], [], [], 0
        for sequence in sequences:
            a = Automaton(sequence.tolist())
            # The row after the last state's is for a symbol that the sample lacks, a phrase by itself.
            root = np.array([a.next[0].get(c, len(a.next)) for c in range(width)], np.int64)
            # Twice the place of the next row, plus 1 where a phrase ends first.
            own = table[at : at + (len(a.next) + 1) * width].reshape(-1, width)
            own[:] = (root * width + at) * 2 + 1
            own[0] -= 1
            for state, row in enumerate(a.next):
                for c, to in row.items():
                    own[state, c] = (to * width + at) * 2
            starts.append(at)
            sizes.append(math.log2(max(2, len(sequence))))
            places.append(np.array([0, *a.places[1:], 0], np.int32))
            at += own.size
        self.table = table[: at + 1]
        self.table[at] = 0
        self.starts, self.cost, self.places = np.array(starts, np.int32), np.array(sizes), places

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[points]
        gap = codes == 0
        return codes[~(gap & np.append(False, gap[:-1]))] if len(codes) else codes

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases of each sequence in each language."""
        size = np.array([len(c) for c in codes], np.int64)
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint8)
        parts = -(-size // STRETCH)
        owner = np.repeat(np.arange(len(codes)), parts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(np.cumsum(size) - size, parts) + within * STRETCH
        length = np.minimum(STRETCH, np.repeat(size, parts) - within * STRETCH)
        order = np.argsort(-length, kind="stable")
        first, falling = start[order], length[order]
        live = np.searchsorted(-falling, -np.arange(STRETCH), side="left")
        state = np.repeat(self.starts[:, None], len(start), axis=1)
        count = np.zeros(state.shape, np.int32)
        for step in range(int(falling[0]) if len(falling) else 0):
            k = live[step]
            got = self.table[state[:, :k] + flat[first[:k] + step]]
            count[:, :k] += got & 1
            state[:, :k] = got >> 1
        last, ended = np.empty_like(state), np.empty_like(count)
        last[:, order], ended[:, order] = state, count
        self._over_seams(flat, start, length, within, last, ended)
        # A text's last phrase ends with it.
        return np.stack([np.bincount(owner, e, len(codes)) for e in ended]).astype(np.int64) + (size > 0)

    def _over_seams(self, flat, start, length, within, last, ended) -> None:
        """Brings ``ended`` from stretches that begin a phrase to those that go on with the one before's; ``last`` are the states at their ends."""
        lang, part = np.divmod(np.arange(last.size), max(1, last.shape[1]))
        lang, part = lang[within[part] > 0], part[within[part] > 0]
        enter = last[lang, part - 1]
        alone, counted = last.copy(), np.zeros(last.shape, np.int32)
        while len(part):
            own, fresh, change = enter.copy(), self.starts[lang].copy(), np.zeros(len(part), np.int32)
            at = np.arange(len(part))
            for step in range(STRETCH):
                at = at[(own[at] != fresh[at]) & (step < length[part[at]])]
                if not len(at):
                    break
                symbol = flat[start[part[at]] + step]
                one, two = self.table[own[at] + symbol], self.table[fresh[at] + symbol]
                change[at] += (one & 1) - (two & 1)
                own[at], fresh[at] = one >> 1, two >> 1
            ended[lang, part] += change - counted[lang, part]
            counted[lang, part] = change
            # Where the two did not meet, the stretch ends otherwise, and the next one has to be done again.
            ending = np.where(own == fresh, alone[lang, part], own)
            moved = (ending != last[lang, part]) & (part + 1 < last.shape[1])
            last[lang, part] = ending
            lang, part = lang[moved], part[moved] + 1
            goes_on = within[part] > 0
            lang, part = lang[goes_on], part[goes_on]
            enter = last[lang, part - 1]

    def familiar(self, lang: int, codes: np.ndarray) -> float:
        """Settles a tie: mean log of how often the phrases occur in the language's sample."""
        places, first = self.places[lang], int(self.starts[lang])
        at, total, n = first, 0.0, 0
        for c in codes.tolist():
            to = int(self.table[at + c])
            if to & 1:
                total, n = total + math.log1p(places[(at - first) // self.width]), n + 1
            at = to >> 1
        return (total + math.log1p(places[(at - first) // self.width])) / (n + 1)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language or 'und', score, bits per symbol) of each text; score is one minus the best entropy over the second best."""
        codes, known = [], []
        for t in texts:
            points = np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32)
            known.append(bool(self.names) and bool(self.letter[points].any()))
            codes.append(self.symbols(t) if known[-1] else np.zeros(0, np.uint8))
        if not self.names:
            return [("und", 0.0, 0.0)] * len(texts)
        bits = self.phrases(codes) * self.cost[:, None] / np.maximum(1, [len(c) for c in codes])
        out = []
        for n, c in enumerate(codes):
            if not known[n]:
                out.append(("und", 0.0, 0.0))
                continue
            row = bits[:, n]
            best = np.flatnonzero(row <= row.min() * (1 + 1e-12))
            lang = int(best[0]) if len(best) == 1 else max(best.tolist(), key=lambda b: (self.familiar(b, c), -b))
            rest = np.delete(row, lang)
            out.append((self.names[lang], float(1 - row[lang] / rest.min()) if len(rest) else 1.0, float(row[lang])))
        return out


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _spread(text: Column, chars: int) -> Column:
    """The text, or pieces of it that are ``chars`` characters together and stand evenly over the whole."""
    count = max(1, chars // PIECE)
    begin = [F.floor((F.length(text) - PIECE) * n / max(1, count - 1)).cast("int") + 1 for n in range(count)]
    return F.when(F.length(text) <= max(chars, PIECE), F.array(text)).otherwise(F.array(*(F.substring(text, b, F.lit(PIECE)) for b in begin)))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample_texts: int = 64, sample_chars: int = 500) -> tuple:
    """Samples of labelled text by language, from rows that are not held out.

    What comes to the driver is bounded: languages * sample_texts * sample_chars characters. Rows
    without id, label or text are not learned from. The result has each language's name and pieces
    of text, and is sorted by name.
    """
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.length(F.trim(text_col)) > 0) & ~held_out(id_col))
    rows = rows.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    texts = rows.groupBy("label", F.xxhash64("text").alias("hash")).agg(F.min("id").alias("id"))
    # First in buckets, so that no task ranks all texts of a label.
    for key in ("label, pmod(hash, 64)", "label"):
        texts = texts.withColumn("rank", F.expr(f"row_number() over (partition by {key} order by hash, id)")).where(F.col("rank") <= sample_texts).drop("rank")
    ids = sorted({r.id for r in texts.select("id").collect()})
    if not ids:
        return ()
    taken = rows.where(F.col("id").isin(ids)).groupBy("label", "id").agg(F.min(_spread(F.col("text"), sample_chars)).alias("pieces"))
    found: dict[str, list[str]] = {}
    for r in taken.orderBy("label", "id").collect():
        found.setdefault(r.label, []).extend(r.pieces)
    return tuple((label, tuple(texts)) for label, texts in sorted(found.items()))


def identify(df: DataFrame, samples: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score (0 to 1), bits (cross entropy per symbol), rejected.

    lang_pred is a label of the samples, or 'und' if the text is null or has no letter (or there
    are no samples), with score 0. Only the text is looked at. rejected: 'und', or at least ENOUGH
    symbols that the best language codes no better than letters drawn at random. Null ids are not
    held out; repeated rows get equal answers; an empty table gives an empty result; other columns
    are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(samples)
    source = in_small_batches(df).select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches):
        model = resident("languages", Model, shared.value)
        for batch in batches:
            for part, texts in in_parts(batch, 2):
                got = model.predict(texts)
                most = math.log2(model.width)
                out = [p == "und" or (b >= most and len(t) >= ENOUGH) for (p, _, b), t in zip(got, texts)]
                columns = [pa.array([g[n] for g in got], kind) for n, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns, pa.array(out, pa.bool_())], names=[id_col, "held_out", "lang_pred", "score", "bits", "rejected"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double, bits double, rejected boolean")


def identified(df: DataFrame, samples: tuple, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose language identify() does not reject."""
    shared = df.sparkSession.sparkContext.broadcast(samples)
    column = df.columns.index(text_col)

    def run(batches):
        model = resident("languages", Model, shared.value)
        most = math.log2(model.width)
        for batch in batches:
            for part, texts in in_parts(batch, column):
                keep = [p != "und" and (b < most or len(t) < ENOUGH) for (p, _, b), t in zip(model.predict(texts), texts)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return in_small_batches(df).mapInArrow(run, df.schema)
