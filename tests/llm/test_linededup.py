import random

import numpy as np

from grainmill.llm import linededup
from grainmill.llm.linededup import BAND, Hashes, ends, line_report, meetings, without_repeats


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    """Every line against every earlier one, by id: the operator may take rows of one id in any order, so tests give those no lines in common."""
    docs = {(r.doc_id, r.text) for r in rows if r.doc_id is not None and r.text is not None}
    seen, removed = [], {}
    for i, text in sorted(docs):
        removed[i] = []
        for n, line in enumerate(text.split("\n")):
            line = line.strip(" \t\r")
            if not line:
                continue
            if any(within_one(line, other) for other in seen):
                removed[i].append(n)
            if line not in seen:
                seen.append(line)
    return removed


def check(df):
    rows = df.collect()
    want = brute(rows)
    got = line_report(df).collect()
    lines = sorted(str((r.doc_id, 0 if r.text is None else r.text.count("\n") + 1, want.get(r.doc_id, []) if r.text is not None or r.doc_id in want else [])) for r in rows)
    assert sorted(str((r.doc_id, r.n_lines, r.removed)) for r in got) == lines
    assert all(r.n_removed == len(r.removed) for r in got)
    return want


def mutate(rnd, line):
    at = rnd.randrange(len(line))
    kind = rnd.randrange(4)
    if kind == 0:
        return line[:at] + rnd.choice("abcé🙂") + line[at + 1 :]
    if kind == 1:
        return line[:at] + line[at + 1 :]
    if kind == 2:
        return line[:at] + rnd.choice("abcé🙂") + line[at:]
    return "  " + line + "\t"


def test_against_all_pairs(spark):
    rnd = random.Random(7)
    lines = ["".join(rnd.choice("ab é🙂c") for _ in range(rnd.choice((12, 19, 20, 21, 31, 32, 33, 63, 64, 65, 90)))) for _ in range(60)] + ["a" * 32, "a" * 33, "a" * 34, "ab" * 16]
    pool = list(lines)
    for _ in range(500):
        pool.append(mutate(rnd, rnd.choice(pool)))
    rows = [(-3 + i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 9)))) for i in range(150)]
    want = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sum(map(len, want.values())) > 100


def test_odd_rows(spark, odd, empty):
    check(odd)
    assert line_report(empty).count() == 0


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = check(df)
    texts = {r.doc_id: r.text for r in df.collect()}
    out = without_repeats(df).collect()
    assert out[0].__fields__ == df.columns
    kept = {i: "\n".join(line for n, line in enumerate(t.split("\n")) if n not in want[i]) for i, t in texts.items()}
    assert {r.doc_id: r.text for r in out} == {i: t for i, t in kept.items() if t.strip()}


def test_short_lines(spark):
    rnd = random.Random(11)
    lines = ["".join(rnd.choice("abcdefgh é🙂中文") for _ in range(rnd.randrange(0, 20))) for _ in range(400)]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randrange(1, 9)))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sum(map(len, check(df).values())) > 300
    menu = spark.createDataFrame([(1, "Read more\n\nMIT\n这是一句话。\na\n"), (2, "Read more\n\nGPL-2\n这是一句话。\nread more\nbc\nb"), (3, " MIT\nReed more\n")], "doc_id long, text string")
    assert {r.doc_id: r.removed for r in line_report(menu).collect()} == {1: [], 2: [0, 3, 4, 6], 3: [0, 1]}


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "first line of all\nsecond line here"), (3, "first line of all\nkept in one"), (3, "quite another line here\nkept in two"), (3, "quite another line here\nkept in two"), (4, "Quite another line here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((r.doc_id, r.removed) for r in line_report(df).collect()) == [(1, []), (3, []), (3, []), (3, [0]), (4, [0])]
    kept = sorted((r.doc_id, r.text) for r in without_repeats(df).collect())
    assert kept == [(1, rows[0][1]), (3, "kept in one"), (3, rows[2][1]), (3, rows[2][1])]


def test_lines_within_one_edit_share_an_end():
    rnd = random.Random(3)
    for n in [*range(1, 40), 200]:
        for _ in range(20):
            line = "".join(rnd.choice("ab") for _ in range(n))
            other = mutate(rnd, line).strip()
            if not other or other == line:
                continue
            which, key, _ = ends([line, other])
            assert set(key[which == 0].tolist()) & set(key[which == 1].tolist()), (line, other)
    assert BAND > 1


def test_hashes_are_of_the_string_alone():
    lines = ["abcabc", "xabcabc", "abc", "é🙂" * 700, "z"]
    hashes = Hashes(lines)
    assert hashes.first(np.array([3, 0, 3, 0, 0]))[0] == hashes.first(np.array([3, 0, 3, 0, 0]))[2] == hashes.last(np.array([3, 3, 3, 2, 0]))[1]
    flat = np.array([6])
    assert hashes.without(flat, np.array([1]))[0] == hashes.first(hashes.n)[0]


def test_verification():
    rnd = random.Random(9)
    for _ in range(3000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 7)))
        b = "".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 7)))
        assert linededup.within_one(a, b) == within_one(a, b), (a, b)


def test_meetings():
    # Two lines cut at the same place, one cut elsewhere, and a whole line, which comes second.
    key, check = np.zeros(4, np.int64), np.zeros(4, np.int32)
    got = meetings(key, check, np.array([2, -1, 5, 2]), np.array([10, 11, 12, 13]))
    assert sorted(zip(*got)) == [(11, 10), (12, 11), (13, 10), (13, 11)]


def test_long_lines(spark):
    long = "".join(random.Random(1).choice("abcdefgh ") for _ in range(1_000_000))
    rows = [(1, long + "!"), (2, long[:500_000] + "Z" + long[500_000:] + "!"), (3, long[:400_000] + "##" + long[400_001:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.removed for r in line_report(df).collect()} == {1: [], 2: [0], 3: []}


def test_template_with_many_ends(spark):
    rows = [(n, f"a template that all lines share, number {n:07d}") for n in range(0, 40_000, 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    # Numbers 0, 20 .. 80 differ from one another in one digit.
    want = set()
    for n, _ in rows:
        digits = f"{n:07d}"
        if any(int(digits[:i] + c + digits[i + 1 :]) < n and int(digits[:i] + c + digits[i + 1 :]) % 20 == 0 for i in range(7) for c in "0123456789"):
            want.add(n)
    assert {r.doc_id for r in line_report(df).where("n_removed > 0").collect()} == want
