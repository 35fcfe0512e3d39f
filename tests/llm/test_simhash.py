from itertools import combinations

import numpy as np
import xxhash

from grainmill.llm import simhash
from grainmill.llm.components import connected_components
from grainmill.llm.simhash import fingerprint, fingerprint_links, near_duplicates, triples


def plain(text):
    """The definition, bit by bit."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for text in ("", " \n", "One", "One two  THREE", "a b c d", "a b c d e", "É É x É y z", "the cat sat on the mat " * 50, "Ab\x1cc d e f g\x85h i"):
        assert fingerprint(text) == plain(text)


def test_any_four_positions_contain_a_triple():
    assert len(triples()) == 20
    assert all(any(set(t) <= set(four) for t in triples()) for four in combinations(range(8), 4))


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (20, 1), (30, 20), *((k, k + 1) for k in range(100, 160)), (-4, 200)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "x long, y long")).collect())
    nodes = {n for a, b in links for n in (a, b) if a != b}
    assert got == {k: v for k, v in roots_of(nodes, [x for x in links if x[0] != x[1]]).items()}
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_links_have_the_components_of_all_pairs(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    prints = set(rnd.integers(0, 2**63, 400).tolist())
    for centre in list(prints)[:6]:
        for _ in range(60):
            value = centre
            for bit in rnd.integers(0, 63, rnd.integers(1, 8)):
                value ^= 1 << int(bit)
            prints.add(value)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = roots_of(prints, [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4])
    monkeypatch.setattr(simhash, "TAKEN", 500)
    for block in (4096, 7):
        links = [tuple(r) for r in fingerprint_links(df, block).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in links)
        assert roots_of(prints, links) == want


def brute(rows):
    prints = [(r.doc_id, plain(r.text or "")) for r in rows]
    values = sorted({p for _, p in prints})
    root = roots_of(values, [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 4])
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    return sorted(str((i, format(p, "016x"), least.get(root[p]))) for i, p in prints)


def test_rows(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (odd, docs):
        assert sorted(str(tuple(r)) for r in near_duplicates(df).collect()) == brute(df.collect())
    assert near_duplicates(empty).count() == 0
