"""Byte-level BPE encoding and decoding with the tiktoken library and a rank file.

The rank file is read once on the driver and broadcast (its size is that of a vocabulary, not of
the data), so executors need no local copy. Long texts are cut before encoding, only where a
non-space is followed by white space: no alternative of the usual splitting patterns spans such a
place, and none looks behind, so the pieces' ids joined are the text's ids.

The library's pattern engine overflows its stack on very long runs of white space. The usual
patterns take all of a run but its last character as one match (the whole run at a text's end), so
runs of over RUN characters are merged as that one piece, without the pattern.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, resident, text_or_empty

#: Characters above which a text is encoded in pieces.
PIECE_CHARS = 20_000

#: White space in a row above which it is not given to the pattern.
RUN = 1_000

_LONG_RUN = regex.compile(rf"\p{{White_Space}}{{{RUN + 1},}}")
_SAFE = regex.compile(r"(?<=[^\p{White_Space}])(?=\p{White_Space})")


def encoding(ranks: bytes, pattern: str):
    """A tiktoken encoding from the bytes of a rank file."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, most: int = PIECE_CHARS) -> list[str]:
    """Cut a text at the first safe boundary after every ``most`` characters."""
    if len(text) <= most:
        return [text]
    out, start = [], 0
    while len(text) - start > most:
        cut = _SAFE.search(text, start + most)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


def _in_pieces(enc, text: str) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return enc.encode_ordinary(text)
    return [i for p in pieces(text) for i in enc.encode_ordinary(p)]


def encode(enc, text: str) -> np.ndarray:
    """Ids of a whole text, little-endian unsigned 32-bit."""
    ids: list[int] = []
    start = 0
    for run in _LONG_RUN.finditer(text) if len(text) > RUN else ():
        stop = run.end() - (run.end() < len(text))
        ids += _in_pieces(enc, text[start : run.start()])
        ids += enc._encode_single_piece(text[run.start() : stop])
        start = stop
    return np.array(ids + _in_pieces(enc, text[start:]), dtype="<u4")


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Encode every text and decode the ids again.

    One row per input row: id, n_tokens, ids (array<long>, left out with ``with_ids=False``),
    ids_sha256 (of the ids as little-endian unsigned 32-bit numbers), decoded_sha256 (of the bytes
    that the ids stand for, not passed through a string). A null text counts as empty; null ids,
    repeated rows and empty tables pass through; other columns are ignored.
    """
    with open(ranks_path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    source = in_small_batches(df).select(F.col(id_col), text_or_empty(text_col).alias("text"))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = resident("ranks", encoding, shared.value, pattern)
        for batch in batches:
            counts, ids_out, sha, back = [], [], [], []
            for value in batch.column(1):
                ids = encode(enc, value.as_py())
                counts.append(len(ids))
                sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back.append(hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest())
                if with_ids:
                    ids_out.append(ids.astype("i8"))
            columns = [batch.column(0), pa.array(counts, pa.int64())]
            names = [id_col, "n_tokens"]
            if with_ids:
                columns.append(pa.array(ids_out, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sha, pa.string()), pa.array(back, pa.string())], names=[*names, "ids_sha256", "decoded_sha256"])

    schema = f"`{id_col}` {kind}, n_tokens long, {'ids array<long>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(run, schema)
