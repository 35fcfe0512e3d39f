import pytest
from pyspark.sql import functions as F

from grainmill.operators import records as R


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_external_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, "añb", "x"), (2, None, "y"), (None, "", "z")], "id long, body string, sample_uid string")
    got = R.external_rows(df, "web", "body", "id", {"tag": F.col("sample_uid")})
    assert rows(got.select("sample_uid", "original_char_count", "cleaned_text", "tag")) == [("web#1", 3, "añb", "x"), ("web#2", 0, "", "y"), (None, 0, "", "z")]
    assert R.external_rows(df.limit(0), "web", "body", "id").count() == 0


def test_origin_has_the_same_name(spark):
    derived = spark.createDataFrame([("tr://7", "a"), ("tr://8", "b"), (None, "c")], "uid string, malay string")
    originals = spark.createDataFrame([("en://7", "A"), ("tr://7", "no"), ("en://9", "B")], "uid string, english string")
    assert rows(R.with_origin(derived, originals, "uid", "en")) == [("en://7", "tr://7", "a", "A")]


def test_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, []), (4, None)], "id int, rules array<string>")
    assert rows(df.where(R.contains_all("rules", ["b", "a"])).select("id")) == [(1,)]
    coded = df.select("id", R.json_list("rules").alias("j"))
    assert rows(coded) == [(1, '["a","b"]'), (2, '["a"]'), (3, "[]"), (4, "[]")]
    assert rows(coded.select("id", R.json_items("j", "string").alias("l"))) == [(1, ["a", "b"]), (2, ["a"]), (3, []), (4, [])]


@pytest.mark.parametrize("profiles,fallback", [(["zsm_Latn", "ind_Latn"], "zsm_Latn"), (["jav_Latn", "ind_Latn"], "ind_Latn")])
def test_language_profile(spark, profiles, fallback):
    df = spark.createDataFrame([(" Forum ",), ("other",), (None,)], "source string")
    assert [r[0] for r in df.select(R.language_profile("source", {"forum": "jav_Latn"}, profiles)).collect()] == ["jav_Latn", fallback, fallback]


def test_part_metrics(spark):
    df = spark.createDataFrame([(0, "b", True, 3, 5), (0, "a", False, None, 2), (0, "b", None, 1, 1), (1, None, True, None, None)], "part int, source string, gone boolean, cut int, n int")
    got = R.part_metrics(df, "part", "source", F.col("gone"), F.col("cut"), F.col("n"))
    assert rows(got) == [(0, 3, 1, 4, 8, "a:1,b:2"), (1, 1, 1, 0, 0, "unknown:1")]


def test_regressions(spark):
    a = spark.createDataFrame([("x", 1.0004, 2.0), ("y", 1.0, 1.0)], "source string, f double, g double")
    b = spark.createDataFrame([("x", 1.0, 2.01), ("z", 1.0, None)], "source string, f double, g double")
    assert {(r[0], r[1]) for r in R.regressions(a, b, "source", ["f", "g"]).where("equal").collect()} == {("x", "f")}
    assert R.regressions(a, b, "source", ["f", "g"]).count() == 6


def test_row_groups_and_stale(spark, tmp_path):
    spark.range(0, 10, 1, 1).write.parquet(str(tmp_path / "t"))
    got = R.row_groups(spark.read.parquet(str(tmp_path / "t")), 4).drop("path")
    assert rows(got) == [(0, 0, 4), (1, 4, 4), (2, 8, 2)]
    keys = spark.range(4)
    assert rows(R.stale_errors(keys.where("id > 1"), keys.where("id < 3").union(keys), "id")) == [(2,), (3,)]


def test_shares(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", None)], "s string, l string")
    assert rows(R.shares(df, "s", "l")) == [("a", "x", 1, 0.25, 0.333333), ("a", "y", 2, 0.5, 0.666667), ("b", None, 1, 0.25, 1.0)]
