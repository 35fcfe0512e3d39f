import pytest
from pyspark.sql import functions as F

from grainmill.functions import text as X
from grainmill.operators import index as I
from grainmill.operators import language as L
from grainmill.operators import neardup as N
from grainmill.operators import planning as P
from grainmill.operators import recipe as R
from grainmill.operators import tokenizer as T
from grainmill.operators import unify as U


def test_near_duplicates_are_transitive(spark):
    words = [f"w{n}" for n in range(200)]
    a, b, c = words, words[:196] + ["x1", "x2", "x3", "x4"], words[:192] + [f"y{n}" for n in range(8)]
    df = spark.createDataFrame([(5, " ".join(a)), (7, " ".join(b)), (9, " ".join(c)), (1, "something else entirely " * 5), (2, "short"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.canonical for r in N.clusters(N.bands(df)).collect()}
    assert found == {7: 5, 9: 5}
    assert N.chains(N.clusters(N.bands(df))).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(n, n + 1) for n in range(40)] + [(100, 99)], "a long, b long")
    assert {r.node: r.root for r in N.components(links).collect()} == {**{n: 0 for n in range(41)}, 99: 99, 100: 99}


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None)], "doc_id long, text string")
    assert {r.doc_id: (r.canonical, r.kept) for r in N.exact_duplicates(df).collect()} == {3: (1, False), 1: (1, True), 2: (2, True), 4: (4, True)}


def test_quotas(spark):
    months = spark.createDataFrame([("b",), ("a",), ("c",)], "month string")
    quotas = P.month_quotas(months, 10)
    assert sorted((r.month, r.byte_quota) for r in quotas.collect()) == [("a", 4), ("b", 3), ("c", 3)]
    assert sorted(r.part_quota for r in P.part_quotas(spark.createDataFrame([("m", 10)], "month string, byte_quota long"), 3).collect()) == [2, 2, 3, 3]
    rows = spark.createDataFrame([("m", 1, 5), ("m", 2, 6), ("m", 3, 1)], "month string, n long, bytes long")
    assert [r.n for r in P.accept_within_quota(rows, spark.createDataFrame([("m", 10)], "month string, byte_quota long"), "month", "n", "bytes", "byte_quota").collect()] == [1]


def test_orders(spark):
    rows = spark.createDataFrame([("A", n) for n in range(4)] + [("B", n) for n in range(4)], "source string, n long")
    placed = P.weighted_interleave(rows, "source", "n", F.when(F.col("source") == "B", 3).otherwise(1)).orderBy("place").collect()
    assert "".join(r.source for r in placed) == "ABBBABAA"
    assert P.id_ranges(0, 10, 4) == [(0, 3), (3, 6), (6, 8), (8, 10)] and P.id_ranges(5, 7, 9) == [(5, 6), (6, 7)] and P.id_ranges(3, 3, 2) == []
    assert P.evenly_spaced(10, 4) == [0, 3, 6, 9] and P.evenly_spaced(2, 5) == [0, 1]
    total = P.running_total(spark.range(1, 101).withColumn("v", F.col("id") * 2), "id", "v", "s", ranges=7)
    assert all(r.s == r.id * (r.id + 1) for r in total.collect())


def test_orders_by_ranges_equal_one_window(spark):
    rows = [(n, None if n % 5 == 0 else "hot" if n % 3 else f"g{n % 4}", n % 11) for n in range(300)]
    df = spark.createDataFrame(rows, "id long, source string, bytes long")
    groups, turns = {}, []
    for n, source, size in sorted(rows, key=lambda r: r[0]):
        groups[source] = groups.get(source, 0) + 1
        turns.append((groups[source], source or "", n, size))
    turned = P.round_robin(df, "source", "id")
    assert sorted((r.turn, r.source or "", r.id, r.bytes) for r in turned.collect()) == sorted(turns)
    total, want = 0, []
    for turn, source, n, size in sorted(turns):
        total += size
        if total <= 700:
            want.append((n, total))
    assert sorted((r.id, r.running) for r in P.take_within(turned, ("turn", "source"), "bytes", 700).collect()) == sorted(want)
    placed = P.weighted_interleave(df, "source", "id", F.when(F.col("source") == "hot", 4).otherwise(1)).orderBy("place").collect()
    order = sorted(((t - 1) // (4 if s == "hot" else 1), s, t, n) for t, s, n, _ in turns)
    assert [(r.place, r.id) for r in placed] == [(k, n) for k, (_, _, _, n) in enumerate(order, 1)]
    assert P.weighted_interleave(df.where("id < 0"), "source", "id", F.lit(1)).count() == 0


def test_merge_raises_on_a_mismatch(spark):
    left = spark.createDataFrame([("a", "1"), ("b", "2")], "uid string, sha string")
    good = left.withColumn("label", F.lit("x"))
    assert U.merge(left, good, "uid", ["sha"], ["label"]).count() == 2
    for bad in (good.where("uid = 'a'"), good.withColumn("sha", F.lit("9"))):
        with pytest.raises(Exception, match="do not match"):
            U.merge(left, bad, "uid", ["sha"], ["label"]).collect()
    assert {r.problem for r in U.audit(left, good.where("uid = 'a'"), "uid", ["sha"]).collect()} == {"missing_right"}


def test_index_retraction_and_upsert(spark):
    index = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, v string")
    assert [r.doc_id for r in I.retract(index, spark.createDataFrame([(2,)], "doc_id long")).collect()] == [1]
    assert sorted(map(tuple, I.upsert(index, spark.createDataFrame([(2, "z"), (3, "y")], "doc_id long, v string"), ["doc_id"]).collect())) == [(1, "a"), (2, "z"), (3, "y")]


def test_bpe_training_and_artifact():
    vocab, merges = T.train([("low", 5), ("lower", 2), ("newest", 6), ("widest", 3)], 20)
    assert merges[0] == ("e", "s") and merges[1] == ("es", "t") and len(vocab) == 20
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(T.artifact(vocab, merges))
    assert "".join(tokenizer.encode("lowest").tokens) == "lowest" and "est" in tokenizer.encode("lowest").tokens
    again, first = T.train([("newest", 6)], 30, inherited=merges[:2])
    assert first[:2] == merges[:2] and all(len(t) <= 32 for t in again)
    assert all(": " not in t for t in T.train([("a: b", 9)], 20, skip_colon=True)[0])
    assert T.from_letters(T.to_letters(bytes(range(256)))) == bytes(range(256))


def test_pretokens_cover_the_text(spark):
    text = "It's 12 words,  or: none\n日本 x"
    df = spark.createDataFrame([(text,), (None,)], "text string")
    for words in (None, 4):
        assert sum(len(r.piece) * r["count"] for r in T.pretoken_counts(df, words=words).collect()) == len(text)


def test_recipes(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("steps:\n- op: prepare_rows\n- op: keep_where\n  options: {condition: 'n > 1'}\n")
    recipe = R.load([str(tmp_path / "a.yaml")])
    assert [r.n for r in recipe(spark.createDataFrame([(1,), (2,)], "n long")).collect()] == [2]
    with pytest.raises(ValueError):
        R.Recipe([("keep_where", {})])
    with pytest.raises(TypeError):
        R.register_op("keep_where")(lambda df: df)
    assert R.merged({"a": {"b": 1, "c": [1]}}, {"a": {"c": [2]}}) == {"a": {"b": 1, "c": [2]}} and R.overridden({}, ["a.b=3"]) == {"a": {"b": 3}}
    assert "clean_source" in {n for n, _, _ in R.list_ops()}


def test_text_functions(spark):
    row = spark.createDataFrame([("12-3-2020 01:15 PM", "9999999999", "A b_C!", "2024-05-01")], "t string, n string, s string, d string").select(
        X.forum_time(F.col("t")).cast("string").alias("t"), X.int32_or_null(F.col("n")).alias("n"), X.slug(F.col("s")).alias("s"), X.month_bucket(F.col("d")).alias("d"), X.sample_key(F.lit("doc://1")).alias("k")).first()
    import hashlib

    assert tuple(row) == ("2020-03-12 13:15:00", None, "a-b_c", "2024-05", int(hashlib.sha256(b"doc://1").hexdigest()[:15], 16) % (1 << 62))


def test_plugged_in_detector(spark):
    df = spark.createDataFrame([(1, "x" * 60), (2, "short"), (3, None), (4, "y" * 60)], "doc_id long, text string")
    got = L.detect(df, lambda texts: [("" if t[0] == "y" else "en", 1) for t in texts]).collect()
    assert [(r.doc_id, r.lid_label) for r in got] == [(1, "en")]


def test_rows_outside_the_ranges_count_nowhere(spark):
    got = P.range_counts(spark.range(50), "id", P.id_ranges(10, 30, 3)).orderBy("worker").collect()
    assert [tuple(r) for r in got] == [(0, 10, 17, 7), (1, 17, 24, 7), (2, 24, 30, 6)]


def test_retained_index_is_the_composition_of_its_parts(spark):
    from grainmill.plans.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    good = {r.doc_id for r in QUERIES["quality_filter_retained"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    first = {}
    for r in sorted(docs, key=lambda r: r.doc_id):
        first.setdefault(r.text, r.doc_id)
    want = {r.doc_id for r in docs if r.doc_id in good and r.lang in ("en", "fr", "es") and first[r.text] == r.doc_id}
    assert {r.doc_id for r in QUERIES["retained_index"](spark, folder).collect()} == want
