import pytest

from pyspark.sql import functions as F

from grainmill.operators import cleaning as C
from grainmill.operators import sequential as S


def cleaned(spark, source, texts):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n long, text string")
    return [r for r in C.clean(df, source).orderBy("n").collect()]


def test_forum_chain(spark):
    rows = cleaned(spark, "lowyat", ["Hello&amp;bye<br>this post has been edited by x: now\nShow spoiler\nkeep www.a.com/x me", None, "...", "see http://a.b/c"])
    assert rows[0].text == "Hello&bye\n\nkeep me"
    assert rows[0]._cleaning.rules_triggered == ["lowyat.url"] and rows[0]._cleaning.dropped is False
    assert [r._cleaning.dropped for r in rows[1:]] == [True, True, False] and rows[1].text == ""


def test_reddit_and_web_chains(spark):
    rows = cleaned(spark, "reddit_bolehland", ["![gif](giphy|x)\n[deleted]\nreal words here", "[removed]"])
    assert rows[0].text == "real words here" and rows[1]._cleaning.dropped
    rows = cleaned(spark, "hplt-malay", ["<p>Home</p>\nWe use cookies here\nA real sentence stays."])
    assert rows[0].text.endswith("A real sentence stays.") and "cookies" not in rows[0].text


def test_books_tail_and_captions(spark):
    body = "The body of the book goes on.\nFigure 1. A caption\n"
    tail = "References\n[1] Smith, A. Title of a paper in some journal 1999 doi:10.1/x\n[2] Jones, B. Another title of a paper 2001 https://x.y\n[3] Poe, C. Third title of a long paper 2003 www.z.org\n"
    row = cleaned(spark, "books", [body + tail])[0]
    assert row.text == "The body of the book goes on." and "books_ocr.reference_tail" in row._cleaning.rules_triggered


def test_link_and_symbol_drops(spark):
    texts = ["", "   ", "!!! ??? ###", "http://a.b/c", "word http://aaaaaaaaaaaaaaaaaaaaaaaa.b", "some plain words with one link http://a.b"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n long, text string")
    from pyspark.sql import functions as F

    assert [r.d for r in df.select("n", C.should_drop(F.col("text")).alias("d")).orderBy("n").collect()] == [True, True, True, True, True, False]


def test_source_names():
    assert C.source_of("Books") == "books-ocr" and C.source_of("reddit_indonesia") == "reddit-indonesia"
    with pytest.raises(ValueError):
        C.source_of("nothing")


def test_line_cleaner():
    text, counts = S.LineCleaner("reddit-bolehland").clean("Sent from my iPhone\nhttps://imgur.com/x\nhello   there http://a.b\n\n\n\nend")
    assert text == "hello there\n\nend"
    assert counts == {"reddit_bolehland.fixed_boilerplate": 1, "reddit_bolehland.media_url_line": 1, "reddit_bolehland.url": 1}
    assert S.drop_reason("") == "drop.empty_after_cleaning" and S.drop_reason("<b></b>") == "drop.markup_only" and S.drop_reason("fine words") is None


def test_ocr_cleanup():
    text, counts, examples = S.ocr_cleanup("![x](y.png)Text stays here.\nISSN 1234-5678\nsee http://a.b and some more words that stay with it here\n")
    assert text == "Text stays here.\nsee and some more words that stay with it here"
    assert counts == {"markdown_image_link": 11, "publication_contact_metadata": 14, "url_or_doi": 10} and examples["url_or_doi"] == ["http://a.b"]


def test_reference_section():
    assert S.trim_section("body\n# References\n[1] a\n[2] b", ("references",)) == "body"
    assert S.trim_section("body\n# References\nplain text", ("references",)) == "body\n# References\nplain text"


def test_chunks_keep_all_words():
    text = "One two three. Four five six.\n\n" + "word " * 80 + "\n\nlast paragraph"
    parts = S.chunks(text, 10, count=lambda t: len(t.split()))
    assert " ".join(" ".join(parts).split()) == " ".join(text.split())
    assert max(len(p.split()) for p in parts) <= 10 and S.chunks("short", 10) == ["short"]


def test_think_and_places():
    assert S.split_think("<think>a b</think> answer ") == ("answer", "a b") and S.split_think(" x ") == ("x", "")
    assert S.word_places("a bb a", ["a", "bb", "a", "z"]) == [0, 2, 5, -1]


def test_texts_in_other_scripts_are_kept(spark):
    texts = ["这是一个完整的中文句子，应当保留。", "Это обычное предложение на русском языке.", "هذه جملة عربية عادية", "見る http://example.org/abc これは日本語の説明文です", "。。。！！！", "http://example.org/中文"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    # The fourth has two words beside a link that is over half of it.
    assert [r.d for r in df.select("n", C.should_drop(F.col("text")).alias("d")).orderBy("n").collect()] == [False, False, False, True, True, True]
    assert [S.drop_reason(t) for t in texts[:3]] == [None] * 3


def test_reference_tails_far_apart():
    # The last heading has no references after it, the one before has.
    text = "Body.\n# References\n" + "".join(f"[{n}] Smith, J. 2001. A title of a paper https://doi.org/10.1000/{n}\n" for n in range(9))
    assert S.tail_start(text) == 5 and S.trim_tail(text) == "Body."
    assert S.tail_start("Body.\n# References\nnone at all\n" * 3) is None
    assert S.tail_start("") is None and S.tail_start("# References") is None
