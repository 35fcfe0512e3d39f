import zlib
from collections import Counter

from grainmill.llm.sharding import jump, shard_documents


def jump_hash(key: int, n: int) -> int:
    """The published algorithm, on Python's integers."""
    key &= 2**64 - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901234, *range(2, 500), *(k * 7919**3 for k in range(200))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 40, 97):
        for k, shard, grown in df.select("k", (p := jump(df.k, n))["shard"], p["grown"]).collect():
            assert (shard, grown) == (jump_hash(k, n), jump_hash(k, n + 1))
            assert grown in (shard, n)


def check(df, n):
    rows = shard_documents(df, n, lanes=3).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = {}
    for r in rows:
        assert (r.shard, r.grown_shard, r.law) == (jump_hash(r.doc_id or 0, n), jump_hash(r.doc_id or 0, n + 1), "key")
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows(odd, empty):
    check(odd, 5)
    check(odd, 1)
    assert shard_documents(empty, 5).count() == 0


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(df, 40)
    assert not any("Python" in line for line in shard_documents(df, 40)._jdf.queryExecution().toString().splitlines())
