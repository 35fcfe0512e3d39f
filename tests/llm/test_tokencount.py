import random
import time

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from grainmill.llm.tokencount import WordBpe, byte_alphabet, count_tokens

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, encoding="utf-8") as file:
        return WordBpe(file.read())


def test_alphabet_has_256_printable_letters():
    assert len(set(byte_alphabet())) == 256 and byte_alphabet()[65] == "A"


def test_counts_equal_the_library(bpe, library):
    rnd = random.Random(1)
    letters = "aaabB ΣσςİIıſKÀà́ \n\t 　\u0085\x1c\x1f'st 12½² _--..🙂日本Ɤ"
    texts = ["", " ", "a" * 5000, "aaa", "aaaa", "the's <|endoftext|>x<|startoftext|>", "ΟΔΟΣ ΟΔΟΣ.", "İ", "é"]
    texts += ["".join("<|endoftext|>" if rnd.random() < 0.03 else rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert bpe.count(texts) == want
    assert bpe.count(texts) == want  # and again from what it remembers


def test_every_script_block(bpe, library):
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    assert bpe.count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_rows(spark, odd, empty, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (odd, docs):
        want = sorted(str((r.doc_id, len((r.text or "").encode()), n, n > 100)) for r in df.collect() for n in [len(library.encode(r.text or "", add_special_tokens=False).ids)])
        assert sorted(str(tuple(r)) for r in count_tokens(df, PATH, limit=100).collect()) == want
    assert count_tokens(empty, PATH).count() == 0


def test_long_words(bpe, library):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("etaoinshrd") for _ in range(30_000)), "a" * 20_001, "ab" * 9_000, "é" * 5_000 + "la" * 5_000, "日本語" * 3_000]
    assert bpe.count(words) == [len(e.ids) for e in library.encode_batch(words, add_special_tokens=False)]
    # Merging by itself and merging together are the same.
    short = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 200))).encode() for _ in range(300)]
    assert [bpe.merged_alone(w) for w in short] == bpe.merged(short).tolist()
    start = time.process_time()
    bpe.count(["".join(rnd.choice("etaoinshrdlucm") for _ in range(1_000_000))])
    assert time.process_time() - start < 120
