import re
from collections import Counter

import pytest
from tokenizers import Tokenizer
import public_tokenizers as P

import corpus_pipeline
from tests.llm.test_linededup import brute as repeated
from tests.llm.test_secrets import base
from tests.llm.test_simhash import brute as components


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage gets and returns, on the smallest table."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect(), after.collect()
        if name != "packing":
            assert after.schema == docs.schema
        docs = after
    return out


def test_language_id_keeps_text_with_letters(steps):
    before, after = steps["language_id"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if re.search(r"[^\W\d_]", r.text or "")}


def test_line_dedup(steps):
    before, after = steps["line_dedup"]
    gone = repeated(before)
    want = {r.doc_id: "\n".join(line for n, line in enumerate(r.text.split("\n")) if n not in gone[r.doc_id]) for r in before}
    assert {r.doc_id: r.text for r in after} == {i: t for i, t in want.items() if t.strip()}
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_dedup_keeps_one_of_each(steps):
    before, after = steps["near_dedup"]
    roots = [r.rsplit(", ", 1)[1].rstrip(")") for r in components(before)]
    assert sorted(str(r.doc_id) for r in after) == sorted(set(roots))


def test_secrets_are_gone(steps):
    before, after = steps["secret_scan"]
    assert len(before) == len(after)
    texts = {r.doc_id: r.text for r in before}
    for r in after:
        assert not base(r.text)
        if not base(texts[r.doc_id]):
            assert r.text == texts[r.doc_id] or "[SECRET]" in r.text


def test_packing(steps):
    before, after = steps["packing"]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    held = Counter()
    for r in after:
        held[r.doc_id] += r.length
    assert held == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in got) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in steps["packing"][1])
