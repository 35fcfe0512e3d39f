import zlib

import numpy as np

from grainmill.llm.langid import STRETCH, Automaton, Model, fit, held_out, identify

WORDS = {"aa": "the and of thing water", "bb": "der und nicht wasser schon", "cc": "el los que agua cosa"}
SAMPLES = tuple((k, (f"{v} " * 30,)) for k, v in WORDS.items())


def greedy(sample: str, text: str) -> int:
    """Phrases by searching for the longest match at every start."""
    n = phrases = 0
    while n < len(text):
        size = 1
        while n + size < len(text) and text[n : n + size + 1] in sample:
            size += 1
        if text[n] not in sample:
            size = 1
        n += size
        phrases += 1
    return phrases


def test_phrases_are_longest_matches():
    rnd = np.random.default_rng(1)
    samples = tuple((k, ("".join(rnd.choice(list("abcd e"), 300)),)) for k in "xy")
    model = Model(samples)
    texts = ["".join(rnd.choice(list("abcdef "), n)).strip() or "a" for n in (1, 2, 5, 40, STRETCH, STRETCH + 1, 700, 5000)]
    # Runs that the sample does not have: the parse from a seam may never meet the one before's.
    texts += ["a" * 3000, "abc" * 900, "b" * (2 * STRETCH) + "a" * 400]
    codes = [model.symbols(t) for t in texts]
    got = model.phrases(codes)
    for lang, (_, parts) in enumerate(samples):
        sample = "".join(map(chr, [*model.symbols(parts[0]).tolist(), 0]))
        for n, c in enumerate(codes):
            whole = "".join(map(chr, c.tolist()))
            assert got[lang, n] == greedy(sample, whole)


def test_places():
    a = Automaton([1, 2, 1, 2, 1])
    assert a.places[a.next[0][1]] == 3 and a.places[a.next[a.next[0][1]][2]] == 2


def test_predict():
    model = Model(SAMPLES)
    assert [p[0] for p in model.predict(["water and the thing", "NICHT WASSER", "agua, que cosa!", None, "", " 12 ?!", "wasser"])] == ["aa", "bb", "cc", "und", "und", "und", "bb"]
    assert model.predict(["字"])[0][0] != "und"
    assert all(0 <= p[1] <= 1 for p in model.predict(["water", "x", None]))
    assert Model((("only", ("text of it",)),)).predict(["of it"])[0][:2] == ("only", 1.0)


def test_rows(spark, odd, empty):
    rows = identify(odd, SAMPLES).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    by = {r.doc_id: r for r in rows}
    assert by[2].lang_pred == by[3].lang_pred == by[9].lang_pred == "und" and by[2].rejected and by[2].score == 0
    assert {r.lang_pred for r in identify(odd, ()).collect()} == {"und"}
    assert identify(empty, SAMPLES).count() == 0 and fit(empty) == ()
    assert {k for k, _ in fit(odd)} <= {"en", "fr", "de", "es"}


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    samples = fit(df)
    assert all(len(texts) <= 320 and sum(map(len, texts)) <= 64 * 500 for _, texts in samples)
    got = identify(df, samples).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert sum(r.rejected for r in got) == 0
    # Only rows that are not held out are learned from.
    assert fit(df.where(held_out("doc_id"))) == ()


def test_samples_are_spread_over_long_texts(spark):
    text = "".join(chr(97 + n // 1000) for n in range(20_000))
    df = spark.createDataFrame([(1, text, "en"), (7, "short one", "en")], "doc_id long, text string, lang string").where(~held_out("doc_id"))
    ((name, pieces),) = fit(df)
    assert name == "en" and sorted(p for p in pieces if p[0] != "s" or " " not in p) == sorted(text[a : a + 100] for a in (0, 4975, 9950, 14925, 19900))
