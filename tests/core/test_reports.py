import pytest

from grainmill.__main__ import main
from grainmill.operators import accounting as A


def test_markdown_round_trip():
    rows = [{"source": "b|x", "documents": 12345}, {"source": "a", "documents": 7}]
    text = A.render_markdown(rows, ["source", "documents"])
    assert "12,345" in text and "b\\|x" in text
    assert A.parse_markdown("title\n\n" + text + "\n\nend") == [{"source": "a", "documents": 7}, {"source": "b|x", "documents": 12345}]
    assert A.parse_markdown("no table") == []


def test_named_sources():
    assert A.named_sources("first cari, then Lowyat and cari", ["lowyat", "cari", "hplt"]) == ["cari", "lowyat"]


def test_strict_comparison(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "source string, documents long")
    assert A.ensure_match(A.compare(one, one, "source", ["documents"])).count() == 2
    with pytest.raises(Exception, match="accounting differs"):
        A.ensure_match(A.compare(one, one.where("source = 'a'"), "source", ["documents"])).collect()


def test_accounting_of_nulls(spark):
    df = spark.createDataFrame([("s", "one two"), ("s", None), ("t", "é")], "source string, text string")
    got = {r.source: (r.documents, r.words, r.characters, r.bytes, r.empty_documents) for r in A.account(df, ["source"]).collect()}
    assert got == {"s": (2, 2, 7, 7, 1), "t": (1, 1, 1, 2, 0)}
    assert A.metadata_columns([df, df.withColumn("month", df.text)], "text") == ["source", "month"]


def test_command_line(spark, tmp_path, capsys):
    assert main(["list-ops"]) == 0 and "clean_source" in capsys.readouterr().out
    (tmp_path / "rows.jsonl").write_text('{"n": 1}\n{"n": 2}\n')
    assert main(["test-op", "keep_where", "--rows", str(tmp_path / "rows.jsonl"), "--option", "condition=n > 1"]) == 0
    assert capsys.readouterr().out.strip() == '{"n": 2}'
