"""Queries of pre-token counts, tokenized datasets and fertility."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.functions.text import token_count
from grainmill.operators import tokenizer as T
from grainmill.plans.corpus import read


def tokenized(s, d):
    import public_tokenizers as P

    return T.tokenize_dataset(read(s, d, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, "byte_bpe_50k")


def fertility(s, d):
    docs = read(s, d, "documents").select("doc_id", "source", token_count(F.coalesce("text", F.lit(""))).alias("words"))
    return T.fertility(tokenized(s, d).join(docs, "doc_id"), F.col("words"), ["source"])


QUERIES = {
    "pretoken_counts": lambda s, d: T.pretoken_counts(read(s, d, "documents")),
    "pretoken_counts_four_words": lambda s, d: T.pretoken_counts(read(s, d, "documents"), words=4),
    "tokenize_dataset": lambda s, d: tokenized(s, d).select("doc_id", "token_count", "text_sha256", "text_bytes", "round_trip", F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256")),
    "fertility": fertility,
}
PIECES = f"(select regexp_extract_all(coalesce(text, ''), '{T.PRETOKEN}') as p from documents)"
ORACLES = {
    "pretoken_counts": f"select piece, count(*) as count from (select unnest(p) as piece from {PIECES}) group by 1",
    "pretoken_counts_four_words": f"select piece, count(*) as count from (select unnest(list_transform(range(1, len(p) + 1, 4), lambda i: array_to_string(p[i:i + 3], ''))) as piece from {PIECES} where len(p) > 0) group by 1",
}
