import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill.llm.ann import SEARCH_BEAM, SHARD_ROWS, Graph, nearest


def brute(rows, queries, k):
    """All candidates, in double precision."""
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], np.float64)
    out = {}
    for q, v in queries:
        scores = (matrix * np.array(v, np.float64)).sum(axis=1)
        hits = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i != q)[:k]
        out[q] = [(i, -s) for s, i in hits]
    return out


def recall(got, want):
    hits = sum(len({r.vec_id for r in got if r.query_id == q} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_graph_finds_neighbours():
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(1500, 24)) * rng.uniform(0.2, 3, (1500, 1))).astype(np.float32)
    graph = Graph(rows)
    hits = 0
    for q in rng.normal(size=(50, 24)).astype(np.float32):
        want = set(np.argsort(-(rows @ q))[:20].tolist())
        hits += len(want & set(graph.search(q, 128).tolist()))
    assert hits >= 950
    assert Graph(rows[:1]).search(rows[0], 5).tolist() == [0]


def test_recall_at_the_size_of_a_shard():
    """Random directions, the hardest case: of twenty neighbours in twelve shards or more, about two are in one shard."""
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(SHARD_ROWS, 64)).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    graph, hits = Graph(rows), 0
    for q in rng.normal(size=(100, 64)).astype(np.float32):
        hits += len(set(np.argsort(-(rows @ q))[:2].tolist()) & set(graph.search(q, SEARCH_BEAM).tolist()))
    assert hits >= 180


def test_several_shards_a_task(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    queries = df.where("vec_id % 20 = 0")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = nearest(df, queries, shard_rows=5).collect()
    assert recall(got, brute(rows, [x for x in rows if x[0] % 20 == 0], 20)) == 1.0
    assert sorted(r["rank"] for r in got if r.query_id == 20) == list(range(1, 21))


def test_documents_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [x for x in rows if x[0] % 20 == 0], 20)
    got = nearest(df, df.where("vec_id % 20 = 0")).collect()
    assert len(got) == sum(map(len, want.values()))
    assert recall(got, want) >= 0.95
    scores = {q: dict(w) for q, w in brute(rows, [x for x in rows if x[0] % 20 == 0], len(rows)).items()}
    for r in got:
        assert abs(r.score - scores[r.query_id][r.vec_id]) < 1e-12


@pytest.fixture(scope="module")
def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(n, [float(n % 7 - 3), float(n % 5), 1.0]) for n in range(60)] + [(20, [-2.0, 0.0, 1.0])]
    rows += [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, nan, 0.0]), (160, [inf, 1.0, 1.0]), (180, [None, 1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (200, [1.0, 2.0]), (201, [2.0, 2.0]), (220, [])]
    rows += [(n, [9.0, 9.0, 9.0]) for n in range(300, 400)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"shard": F.lit(1), "rank": F.lit("x")})


def test_odd_rows(odd):
    queries = odd.where("vec_id % 20 = 0")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(odd, queries, k=5).collect())
    rows = {(r.vec_id, tuple(r.embedding)) for r in odd.collect() if r.vec_id is not None and r.embedding and len(r.embedding) == 3 and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)}
    want = brute(sorted(rows), sorted(x for x in rows if x[0] % 20 == 0), 5)
    assert [g for g in got if g[0] != 200] == sorted((q, n, i, s) for q, w in want.items() for n, (i, s) in enumerate(w, 1))
    assert [g for g in got if g[0] == 200] == [(200, 1, 201, 6.0)]
    assert nearest(odd.limit(0), queries).count() == 0 and nearest(odd, queries.limit(0)).count() == 0
