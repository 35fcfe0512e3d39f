import zlib
from itertools import permutations

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from grainmill.llm.packing import Ids, best_fit, crossover, evolve, lower_bound, pack_documents, pieces_of

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ids():
    with open(PATH, encoding="utf-8") as file:
        return Ids(file.read())


def test_ids_equal_the_library(ids, library):
    rnd = np.random.default_rng(2)
    letters = list("aab 't  \n\t\r\x1c\x1f　12½_-.é日🙂")
    texts = ["", " ", "a b", "a  b", "a   b", "x\n y", "x \n\n y ", "<|endoftext|> a <|endoftext|>", "it's  'll", "a " * 3000]
    texts += ["".join(rnd.choice(letters, rnd.integers(1, 40))) for _ in range(3000)]
    texts += [" ".join("".join(rnd.choice(list("abc'.é9"), rnd.integers(1, 5))) for _ in range(20)) for _ in range(500)]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids(texts) == want and ids(texts) == want
    assert ids([]) == []


def test_ids_when_little_is_remembered(library, monkeypatch):
    monkeypatch.setattr("grainmill.llm.packing.REMEMBERED", 50)
    with open(PATH, encoding="utf-8") as file:
        ids = Ids(file.read())
    rnd = np.random.default_rng(5)
    for _ in range(60):
        texts = [" ".join("".join(rnd.choice(list("abc\n.é"), rnd.integers(0, 4))) for _ in range(12)) for _ in range(6)]
        assert ids(texts) == [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def test_pieces():
    def cut(n):
        return [p[:3] for p in pieces_of(np.arange(n, dtype="<u4").tobytes(), 4)]

    assert cut(1) == [(0, 0, 1)] and cut(4) == [(0, 0, 4)] and cut(5) == [(0, 0, 1), (1, 1, 4)] and cut(8) == [(0, 0, 4), (1, 4, 4)]


def fewest(sizes, capacity):
    """By trying every order with first fit."""
    best = len(sizes)
    for order in permutations(sizes):
        bins = []
        for s in order:
            for n, b in enumerate(bins):
                if b + s <= capacity:
                    bins[n] += s
                    break
            else:
                bins.append(s)
        best = min(best, len(bins))
    return best


def test_bound_and_crossover():
    rnd = np.random.default_rng(4)
    for _ in range(40):
        sizes = rnd.integers(1, 10, 7)
        assert lower_bound(sizes, 10) <= fewest(sizes.tolist(), 10)
    sizes = rnd.integers(1, 100, 300)
    one, two = (best_fit(rnd.permutation(300), sizes, 100, np.empty(300, np.int64), []) for _ in range(2))
    for a in (one, two, crossover(one, two, sizes, 100, rnd), *evolve(sizes, 100, 1, [one, two])):
        fill = np.bincount(a, sizes)
        assert fill.max() <= 100 and fill.min() > 0
    # An island is at least as good as what arrived and as best fit by falling size.
    falling = best_fit(np.argsort(-sizes), sizes, 100, np.empty(300, np.int64), [])
    assert evolve(sizes, 100, 1, [])[0].max() <= falling.max()


def check(df, library, block=4096, capacity=64):
    rows = pack_documents(df, PATH, capacity, block=block).collect()
    want = []
    for r in df.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want += [str((r.doc_id, *p)) for p in pieces_of(ids, capacity)]
    assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return by, sum(r.length for r in rows)


def test_rows(spark, odd, empty, library):
    check(odd, library)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    by, total = check(docs, library, block=50, capacity=1024)
    assert len(by) <= 1.15 * total / 1024
    assert pack_documents(empty, PATH).count() == 0
    assert zlib.crc32(b"") == 0
