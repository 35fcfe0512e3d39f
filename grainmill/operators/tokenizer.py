"""Pre-token counts, two-stage BPE on collected counts, tokenized datasets and fertility."""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections import Counter, defaultdict
from functools import lru_cache

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: pre-tokens cover every character, so what lies between matches of words is counted as well.
PRETOKEN = r" ?[\p{L}\p{M}]+| ?[\p{N}]+| ?[^ \t\n\x0B\f\r\p{L}\p{M}\p{N}]+|[ \t\n\x0B\f\r]+"


def pretoken_counts(df: DataFrame, text: str = "text", pattern: str = PRETOKEN, words: int | None = None) -> DataFrame:
    """(piece, count); with ``words``, runs of up to so many words are one piece. Partial counts are summed before the shuffle."""
    # Pre-tokens follow one another without gaps, so a run of them is a repetition of the pattern.
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"(?:{pattern}){{1,{words}}}" if words else pattern), F.lit(0))
    rows = df.select(found.alias("p"))
    return rows.select(F.explode("p").alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("count"))


def capped(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """The most frequent pieces, at most ``most``, ties by the piece; a bounded list for the driver."""
    return [(r.piece, r["count"]) for r in counts.orderBy(F.col("count").desc(), "piece").limit(most).collect()]


def train(counts: list[tuple[str, int]], size: int, longest: int = 32, inherited: list[tuple[str, str]] = (), skip_colon: bool = False) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """(vocabulary, merges) by repeated merging of the most frequent pair, ties to the smaller pair of ids.

    Inherited merges come first; a token longer than ``longest`` characters, or (with
    ``skip_colon``, for stages that join words) one holding a colon before a space, is not made.
    """
    words = [list(p) for p, _ in counts]
    weight = [n for _, n in counts]
    vocab = {c: n for n, c in enumerate(sorted({c for w in words for c in w}))}
    pairs: Counter = Counter()
    where: dict[tuple[str, str], set[int]] = defaultdict(set)
    for n, w in enumerate(words):
        for pair in zip(w, w[1:]):
            pairs[pair] += weight[n]
            where[pair].add(n)
    merges: list[tuple[str, str]] = []

    def allowed(pair):
        made = pair[0] + pair[1]
        return len(made) <= longest and not (skip_colon and ": " in made)

    def key(pair):
        return (-pairs[pair], vocab[pair[0]], vocab[pair[1]])

    def apply(pair) -> set:
        made, changed = pair[0] + pair[1], set()
        vocab.setdefault(made, len(vocab))
        merges.append(pair)
        for n in list(where[pair]):
            w = words[n]
            for old in zip(w, w[1:]):
                pairs[old] -= weight[n]
                where[old].discard(n)
                changed.add(old)
            at, out = 0, []
            while at < len(w):
                if at + 1 < len(w) and (w[at], w[at + 1]) == pair:
                    out.append(made)
                    at += 2
                else:
                    out.append(w[at])
                    at += 1
            words[n] = out
            for new in zip(out, out[1:]):
                pairs[new] += weight[n]
                where[new].add(n)
                changed.add(new)
        return changed

    for pair in inherited:
        if len(vocab) < size:
            for half in pair:
                vocab.setdefault(half, len(vocab))
            apply(tuple(pair))
    heap = [(key(p), p) for p in pairs if allowed(p)]
    heapq.heapify(heap)
    while heap and len(vocab) < size:
        k, pair = heapq.heappop(heap)
        if k != key(pair):
            if pairs[pair] > 0:
                heapq.heappush(heap, (key(pair), pair))
            continue
        if pairs[pair] <= 0:
            break
        for new in apply(pair):
            if pairs[new] > 0 and allowed(new):
                heapq.heappush(heap, (key(new), new))
    return vocab, merges


def artifact(vocab: dict[str, int], merges: list[tuple[str, str]]) -> str:
    """Tokenizer JSON that the tokenizers library loads; pieces are characters, without a splitter."""
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "vocab": vocab, "merges": [list(m) for m in merges]}
    return json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None, "model": model}, ensure_ascii=False)


def byte_letters() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 for itself, the rest from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


def to_letters(data: bytes) -> str:
    table = byte_letters()
    return "".join(table[b] for b in data)


def from_letters(text: str) -> bytes:
    table = {c: b for b, c in byte_letters().items()}
    return bytes(table[c] for c in text)


@lru_cache(maxsize=2)
def _ranks(data: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("dataset", pat_str=pattern, mergeable_ranks=table, special_tokens={})


#: White space in a row above which the library's pattern engine is spared: its stack does not hold runs of millions.
RUN = 1_000
_RUNS = regex.compile(rf"\p{{White_Space}}{{{RUN + 1},}}")


def encoded(enc, text: str) -> list[int]:
    """Ids of a text. The usual patterns take all of a run of white space but its last character (the whole run at the end) as one piece, so a long one is merged as that."""
    ids, start = [], 0
    for run in _RUNS.finditer(text) if len(text) > RUN else ():
        stop = run.end() - (run.end() < len(text))
        ids += enc.encode_ordinary(text[start : run.start()]) + enc._encode_single_piece(text[run.start() : stop])
        start = stop
    return ids + enc.encode_ordinary(text[start:])


def tokenize_dataset(df: DataFrame, ranks_path: str, pattern: str, name: str, sha256: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds token_ids, token_count, text_sha256, text_bytes, round_trip and tokenizer to each row; the rank file's digest is checked if one is given."""
    import pyarrow as pa

    with open(ranks_path, "rb") as file:
        data = file.read()
    if sha256 and hashlib.sha256(data).hexdigest() != sha256:
        raise ValueError(f"{ranks_path} is not the tokenizer that was asked for")
    shared = df.sparkSession.sparkContext.broadcast(data)

    def run(batches):
        enc = _ranks(shared.value, pattern)
        for batch in batches:
            ids = [encoded(enc, t) for t in batch.column(1).to_pylist()]
            same = [enc.decode(i) == t for i, t in zip(ids, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([len(i) for i in ids], pa.int32()), batch.column(2), batch.column(3), pa.array(same, pa.bool_())], names=[id_col, "token_ids", "token_count", "text_sha256", "text_bytes", "round_trip"])

    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(id_col, t.alias("t"), F.sha2(t, 256).alias("h"), F.octet_length(t).cast("long").alias("b"))
    out = rows.mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, token_ids array<int>, token_count int, text_sha256 string, text_bytes long, round_trip boolean")
    return out.withColumn("tokenizer", F.lit(name))


def fertility(tokens: DataFrame, words: Column, by: list[str]) -> DataFrame:
    """Tokens per word, bytes per token, percentiles and mean of the documents' own ratios, and round trips, by group."""
    n = F.col("token_count")
    ratio = F.try_divide(n.cast("double"), words.cast("double"))
    return tokens.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(n).alias("tokens"), F.sum(words).alias("words"), F.round(F.try_divide(F.sum(n).cast("double"), F.sum(words).cast("double")), 6).alias("fertility"),
        F.round(F.try_divide(F.sum("text_bytes").cast("double"), F.sum(n).cast("double")), 6).alias("bytes_per_token"), F.round(F.avg(ratio), 6).alias("mean_document_fertility"),
        F.round(F.percentile(n, 0.5), 6).alias("p50_tokens"), F.round(F.percentile(n, 0.95), 6).alias("p95_tokens"), F.count_if("round_trip").alias("round_trips"),
    )
