import hashlib

from pyspark.sql import functions as F

from grainmill.llm.syncmers import K, LONG, S, SKETCH, anchors, fingerprint_documents, in_lanes


def words_of(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [u for w in text.split(" ") for u in (w if len(w) > LONG else [w]) if u]


def hashes(spark, lists):
    """xxhash64 of each tuple, as Spark has it."""
    out = {}
    for size in {len(x) for x in lists}:
        part = sorted({x for x in lists if len(x) == size})
        names = [f"c{n}" for n in range(size)]
        df = spark.createDataFrame(part, names)
        out |= {tuple(r[:-1]): r[-1] for r in df.select("*", F.xxhash64(*names)).collect()}
    return out


def sketches(spark, texts):
    """By the definition: windows, inner runs, edges."""
    words = {t: words_of(t) for t in texts}
    pair = hashes(spark, {(w[i], w[i + 1]) for w in words.values() for i in range(len(w) - 1)} or {("a", "b")})
    picked = {}
    for t, w in words.items():
        picked[t] = []
        for i in range(len(w) - K + 1):
            inner = [pair[w[j], w[j + 1]] for j in range(i, i + K - S + 1)]
            if min(inner) in (inner[0], inner[-1]):
                picked[t].append(tuple(inner))
    whole = hashes(spark, {x for v in picked.values() for x in v} or {(1, 2, 3, 4)})
    return {t: sorted({whole[x] & 0xFFFFFFFF for x in v})[:SKETCH] for t, v in picked.items()}


def expected(rows):
    rows = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((i, t, t[: len(t) - half] + after[:half], after))
    return out


def like(a, b):
    union = sorted(set(a) | set(b))[:SKETCH]
    return 1.0 if not union else len(set(a) & set(b) & set(union)) / len(union)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = expected(df.collect())
    sk = sketches(spark, {t for _, a, b, _ in want for t in (a, b)})
    got = {r.doc_id: r for r in fingerprint_documents(df).collect()}
    assert len(got) == len(want)
    for i, text, edited, after in want:
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for t, print_ in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            if sk[t]:
                assert print_ == "".join(f"{h:08x}" for h in sk[t])
        if sk[text] and sk[edited] and sk[after]:
            assert abs(r.near_edited - like(sk[text], sk[edited])) < 1e-12 and abs(r.near_next - like(sk[text], sk[after])) < 1e-12


def test_odd_rows(spark, odd, empty):
    want = expected(odd.collect())
    got = fingerprint_documents(odd).collect()
    assert sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got) == sorted(str((i, len(t), hashlib.sha256(e.encode()).hexdigest())) for i, t, e, _ in want)
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[5].fingerprint != "" and by[2].fingerprint == by[3].fingerprint == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint_documents(empty).count() == 0
    one = fingerprint_documents(odd.where("doc_id = 1")).collect()
    assert [r.near_next for r in one] == [1.0]


def test_lanes_carry_the_next_row(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("k"), F.col("id").cast("string").alias("text"))
    rows = in_lanes(df, "k", 7).collect()
    assert sum(r.extra for r in rows) == 7 and len(rows) == 107
    assert max(sum(r.lane == n for r in rows) for n in range(7)) < 25


def test_anchors_have_no_long_gap(spark):
    text = " ".join(f"w{n * 7919 % 1009}" for n in range(500))
    rows = anchors(spark.createDataFrame([(1, text), (2, None), (3, "a b")], "doc_id long, text string")).collect()
    places = [r.place for r in rows]
    assert {r.doc_id for r in rows} == {1} and places == sorted(places)
    assert max(b - a for a, b in zip(places, places[1:])) <= K - S + 1
    # An anchor depends on its words alone.
    moved = anchors(spark.createDataFrame([(1, "other words before " + text)], "doc_id long, text string")).collect()
    assert {r.hash for r in rows} <= {r.hash for r in moved}


def test_long_texts_that_share_a_passage(spark):
    words = [f"w{n * 7919 % 100_003}" for n in range(40_100)]
    passage = words[40_000:]
    texts = [" ".join(words[:9_000] + passage + words[9_000:20_000]), " ".join(words[20_000:33_000] + passage + words[33_000:40_000])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in fingerprint_documents(df).collect()}
    assert rows[0].near_next > 0
    for i in (0, 1):
        placed = [(int(p), h) for p, h in (a.split(":") for a in rows[i].anchors.split(","))]
        assert placed == [(r.place, f"{r.hash & 0xFFFFFFFF:08x}") for r in anchors(df.where(f"doc_id = {i}")).orderBy("place").collect()]
        assert rows[i].fingerprint == "".join(sorted({h for _, h in placed}))
    # Common hashes line up at one distance, that of the passage in the two texts.
    at = {h: int(p) for p, h in (a.split(":") for a in rows[0].anchors.split(","))}
    apart = [int(p) - at[h] for p, h in (a.split(":") for a in rows[1].anchors.split(",")) if h in at]
    assert apart.count(4_000) >= 24


def test_texts_without_spaces(spark):
    cjk = "".join(chr(0x4E00 + n * 7919 % 20_000) for n in range(4_000))
    texts = [cjk, "字" + cjk, cjk[:2_000] + "🙂" + cjk[2_000:], "".join(f"{n:02d} " for n in range(14)) + cjk]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in fingerprint_documents(df).collect()}
    for n in range(3):
        assert rows[n].near_next > 0.98
    sk = sketches(spark, set(texts))
    assert all(rows[n].fingerprint == "".join(f"{h:08x}" for h in sk[t]) for n, t in enumerate(texts))


def test_very_many_lanes(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3000).alias("k"), F.col("id").cast("string").alias("text"))
    rows = in_lanes(df, "k", 2000).collect()
    lanes = {r.lane for r in rows}
    assert len(lanes) > 1500 and sum(r.extra for r in rows) == len(lanes) and sum(not r.extra for r in rows) == 3000
