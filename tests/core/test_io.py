from pyspark.sql import functions as F

import pytest

from grainmill import sources as Z
from grainmill import streaming as M


def test_round_trip_and_trace(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "n long, text string, part string")
    Z.write(df, str(tmp_path / "p"), by=["part"], codec="none")
    back = Z.rows(spark, str(tmp_path / "p"), merge=True)
    assert sorted((r.n, r.text, r.part) for r in back.collect()) == [(1, "a", "x"), (2, None, "y")]
    traced = Z.traced(Z.rows(spark, str(tmp_path / "p")), "text").collect()
    assert len({r.sample_uid for r in traced}) == 2 and all(r.source_row_index == 0 for r in traced)
    Z.write(df, str(tmp_path / "j"), kind="ndjson")
    assert Z.rows(spark, str(tmp_path / "j"), "ndjson").count() == 2
    assert Z.where_equal(back, {"n": "2"}).count() == 1
    with pytest.raises(ValueError):
        Z.required(back, ["absent"])


def test_objects(spark, tmp_path):
    (tmp_path / "a.md").write_text("one\ntwo")
    (tmp_path / "b.txt").write_text("no")
    rows = Z.rows(spark, str(tmp_path), "objects", glob="*.md").collect()
    assert [r.text for r in rows] == ["one\ntwo"]
    key = spark.createDataFrame([("in/a.pdf",)], "p string").select(Z.output_key(F.col("p")).alias("k")).first().k
    assert key.endswith("-a.md") and len(key) == 21


def test_stream_counts_and_refresh(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    seen = []
    query = M.refresh(M.arrivals(spark, str(tmp_path / "in"), events.schema), lambda df, n: seen.append(df.count()), str(tmp_path / "state"))
    query.awaitTermination(120)
    assert sum(seen) == events.count()
    want = events.groupBy(F.window("ts", "1 hour"), "event_type").count().count()
    stream = M.event_counts(M.arrivals(spark, str(tmp_path / "in"), events.schema))
    out = stream.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    out.awaitTermination(120)
    assert spark.table("counted").count() == want
