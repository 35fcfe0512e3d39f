import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from grainmill.llm.bpe import encode, encode_documents, pieces

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def enc():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_join_and_keep_ids(enc):
    texts = ["ab cd" * 9000, "a\n\n  b\t 　c'll 12 " * 3000, "word   \n" * 5000, "y" * 45_000, "é " * 30_000, "<|endoftext|> x" * 2000]
    for text in texts:
        assert "".join(pieces(text, 1000)) == text
        whole = enc.encode_ordinary(text)
        assert [i for p in pieces(text, 1000) for i in enc.encode_ordinary(p)] == whole
        assert encode(enc, text).tolist() == whole


def test_rows(odd, empty, enc):
    rows = encode_documents(odd, PATH, P.PATTERN).collect()
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    assert len(rows) == len(texts)
    want = sorted(str((i, ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())) for i, t in texts for ids in [enc.encode_ordinary(t)])
    assert sorted(str((r.doc_id, r.ids, r.ids_sha256, r.decoded_sha256)) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert encode_documents(empty, PATH, P.PATTERN).count() == 0


def test_long_runs_of_white_space(enc):
    for run in (" " * 3001, "\n \t" * 1500, "\u3000" * 2000):
        for text in (run, f"a{run}b", f"a{run}", f"{run}b", f"x {run} y{run}'s z {run}"):
            assert encode(enc, text).tolist() == enc.encode_ordinary(text)
    for text in (" " * 3_000_000, "a" + " " * 2_000_000 + "b", "c" * 1_000_000):
        assert enc.decode(encode(enc, text).tolist()) == text
