"""Secret scans: three base patterns, and a battery of randomness tests for other strings.

Everything is built-in expressions. Spark returns a pattern's matches but not their places; these
follow from the lengths of the matches and of the parts between them.

The battery looks at stretches of encoding characters, infers the encoding of each (hex, base32 or
base64 and its URL form) and computes
- chi-squared uniformity over the alphabet, against both hypotheses: that the characters are drawn
  at random, and that they are ordinary text, whose repeats make the statistic grow with length;
- the runs test of symbols above and below the alphabet's middle;
- the lag-one serial correlation of symbol numbers;
- runs of character classes: ordinary names, paths and dates go from one word or number to the next
  about once in ``1 / BREAKS`` characters, random strings far more often.
A stretch that mixes at least two of lower case, upper case and digits is tested; it is eligible if
none of the first three rejects randomness at ``ALPHA``. Its p-value joins, by Fisher's rule, the
chances in ordinary text of its length of so even a distribution and of so many runs. Benjamini and
Hochberg's procedure at ``FALSE_DISCOVERY`` is applied within octaves of length over the tested
stretches of all documents, from a histogram of p-values in tenths of a power of ten, each rounded
up, so that rounding can only lose discoveries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, digest, text_or_empty

# The base kinds in their order, with their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
#: Matches of a text whose places are worked out together.
BLOCK = 256
STRETCH = r"[A-Za-z0-9+/_-]{20,}"

ALPHA, FALSE_DISCOVERY = 0.001, 0.01
#: Cells of the histogram of p-values: tenths of a power of ten.
CELLS = 400
#: How often ordinary strings go from one word or number to the next, by character.
BREAKS = 0.15
#: From a lower-case to an upper-case letter, or between a letter and a digit.
BREAK = "(?<=[a-z])(?=[A-Z])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"

# Alphabets, and how likely two characters of ordinary strings over them are equal.
ALPHABETS = {
    "hex": ("0123456789abcdef", 0.12),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.075),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.055),
}


def places(text: Column, pattern: str, group: int | None = None, least: int = 0) -> Column:
    """array<struct(start, end)> of the matches in code points, end exclusive; those whose ``group`` has fewer than ``least`` characters are left out."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.transform(found, F.length)
    held = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length) if group else size
    before = F.transform(F.split(text, pattern, -1), F.length)
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, x):
        begin = acc["at"] + x["before"]
        end = begin + x["size"]
        kept = F.when(x["held"] >= least, F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    def block_after(acc, block):
        first = F.coalesce(F.get(acc, F.size(acc) - 1)["at"], F.lit(0))
        start = F.struct(first.alias("at"), none.alias("out"))
        return F.concat(acc, F.array(F.aggregate(block, start, step)))

    steps = F.arrays_zip(F.slice(before, 1, F.size(size)).alias("before"), size.alias("size"), held.alias("held"))
    # An array is copied when it grows, so matches are added to blocks, and blocks to their list.
    blocks = F.transform(F.sequence(F.lit(1), F.size(size), F.lit(BLOCK)), lambda at: F.slice(steps, at, BLOCK))
    listed = F.array().cast("array<struct<at:int,out:array<struct<start:int,end:int>>>>")
    return F.when(text.rlike(pattern), F.aggregate(blocks, listed, block_after, lambda acc: F.flatten(acc["out"]))).otherwise(none)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (Abramowitz and Stegun, 26.2.17)."""
    # Fixed values of that formula.
    weights = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = F.lit(0.0)
    for w in reversed(weights):
        series = (series + w) * t
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, within 0.003."""
    m = F.greatest(n, F.lit(1.0))
    return F.when(n < 1, 0.0).otherwise(m * F.log(m) - m + F.log(2 * math.pi * m) / 2 + 1 / (12 * m))


def many_breaks(n: Column, breaks: Column, rate: float = BREAKS) -> Column:
    """A bound from above, near for large counts, of the chance of at least so many breaks at n - 1 places."""
    m = n - 1
    log = _log_factorial(m) - _log_factorial(breaks) - _log_factorial(m - breaks) + breaks * math.log(rate) + (m - breaks) * math.log(1 - rate)
    # Each further term of the binomial is at most this share of the one before.
    share = (m - breaks) / (breaks + 1) * (rate / (1 - rate))
    return F.when((breaks > m * rate) & (share < 1), F.least(F.lit(1.0), F.exp(log) / (1 - share))).otherwise(1.0)


def _with(x: Column, fields: list[str], **more: Column) -> Column:
    return F.struct(*(x[f].alias(f) for f in fields), *(v.alias(k) for k, v in more.items()))


def battery(text: Column, spans: Column) -> list[tuple[str, Column]]:
    """Columns to add one after another, the last being array<struct(start, end, octave, cell)>: -10 log10 p of each stretch, 0 if not eligible, null if not tested."""
    name = "__stretches"
    col = F.col(name)

    def encoding(token):
        is_hex = token.rlike("^([0-9a-f]+|[0-9A-F]+)$")
        return F.when(is_hex, F.lit("hex")).when(token.rlike("^[A-Z2-7]+$"), F.lit("base32")).otherwise(F.lit("base64"))

    def begun(s):
        token = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        kinds = sum(token.rlike(c).cast("int") for c in ("[a-z]", "[A-Z]", "[0-9]"))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), token.alias("token"), encoding(token).alias("code"), (kinds >= 2).alias("coded"))

    def pick(x, what):
        chosen = F.lit(what["base64"])
        for code in ("hex", "base32"):
            chosen = F.when(x["code"] == code, F.lit(what[code])).otherwise(chosen)
        return chosen

    def numbered(x):
        token = F.when(x["code"] == "hex", F.lower(x["token"])).otherwise(F.translate(x["token"], "-_", "+/"))
        alphabet = pick(x, {k: a for k, (a, _) in ALPHABETS.items()})
        letters = F.split(token, "")
        size = F.length(token)
        value = F.transform(letters, lambda c: (F.instr(alphabet, c) - 1).cast("double"))
        squares = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda a, c: a + F.pow((size - F.length(F.replace(token, c))).cast("double"), 2.0))
        breaks = F.regexp_count(x["token"], F.lit(BREAK)).cast("double")
        return _with(x, ["start", "end", "coded"], breaks=breaks, n=size.cast("double"), k=pick(x, {c: float(len(a)) for c, (a, _) in ALPHABETS.items()}), same=pick(x, {c: s for c, (_, s) in ALPHABETS.items()}), value=value, squares=squares)

    def summed(x):
        n, k, value = x["n"], x["k"], x["value"]
        mean = F.aggregate(value, F.lit(0.0), lambda a, v: a + v) / n
        high = F.aggregate(value, F.lit(0.0), lambda a, v: a + F.when(v >= k / 2, 1.0).otherwise(0.0))
        start = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("runs"))
        runs = F.aggregate(value, start, lambda a, v: F.struct((s := F.when(v >= k / 2, 1.0).otherwise(0.0)).alias("last"), (a["runs"] + (s != a["last"]).cast("double")).alias("runs")), lambda a: a["runs"])
        return _with(x, ["start", "end", "coded", "breaks", "n", "k", "same", "value"], chi=k / n * x["squares"] - n, mean=mean, high=high, runs=runs)

    def tested(x):
        n, k, mean = x["n"], x["k"], x["mean"]
        # Uniformity if random, by Wilson and Hilferty's cube root.
        v = k - 1
        even = (F.pow(x["chi"] / v, 1 / 3) - (1 - 2 / (9 * v))) / F.sqrt(2 / (9 * v))
        # Uniformity of ordinary text: the statistic's mean grows with the length.
        usual = k + k * (n - 1) * x["same"] - n
        spread = F.sqrt(2 * v + 4 * F.greatest(usual - v, F.lit(0.0)))
        low = n - x["high"]
        runs_mean = 2 * x["high"] * low / n + 1
        runs_var = (runs_mean - 1) * (runs_mean - 2) / (n - 1)
        runs = F.when(runs_var > 0, (x["runs"] - runs_mean) / F.sqrt(runs_var)).otherwise(99.0)
        start = F.struct(mean.alias("last"), F.lit(0.0).alias("cross"), F.lit(0.0).alias("square"))
        sums = F.aggregate(x["value"], start, lambda a, s: F.struct(s.alias("last"), (a["cross"] + (s - mean) * (a["last"] - mean)).alias("cross"), (a["square"] + (s - mean) * (s - mean)).alias("square")))
        return _with(x, ["start", "end", "coded", "breaks", "n"], even=even, text=(x["chi"] - usual) / spread, runs=runs, sums=sums)

    def judged(x):
        n = x["n"]
        serial = F.when(x["sums"]["square"] > 0, (x["sums"]["cross"] / x["sums"]["square"] + 1 / n) * F.sqrt(n)).otherwise(99.0)
        odd = 2 * F.least(upper_tail(F.abs(x["runs"])), upper_tail(F.abs(serial)))
        eligible = (upper_tail(x["even"]) >= ALPHA) & (odd >= ALPHA)
        both = F.greatest(upper_tail(-x["text"]) * many_breaks(n, x["breaks"]), F.lit(1e-60))
        cell = F.least(F.lit(CELLS), F.floor(-10 * F.log10(both * (1 - F.log(both)))).cast("int"))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.floor(F.log2(n)).cast("int").alias("octave"), F.when(x["coded"], F.when(eligible, F.greatest(cell, F.lit(0))).otherwise(0)).alias("cell"))

    first = F.transform(spans, begun)
    return [(name, first), *((name, F.transform(col, f)) for f in (numbered, summed, tested, judged))]


def tagged(spans: Column | str, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def of_kind(kind: int) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def with_scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds __base, array<struct(start, kind, end)> in order with kind a place in KINDS, and __stretches."""
    names = df.columns
    df = df.withColumn("__text", text_or_empty(text_col))
    df = df.withColumns({
        "__assign": places(F.col("__text"), ASSIGN, 2, LEAST_VALUE), "__access": places(F.col("__text"), ACCESS),
        "__hex": places(F.col("__text"), HEX), "__spans": places(F.col("__text"), STRETCH),
    })
    df = df.withColumn("__base", F.array_sort(F.concat(*(tagged(f"__{kind}", n) for n, kind in enumerate(KINDS[:3])))))
    for name, value in battery(F.col("__text"), F.col("__spans")):
        df = df.withColumn(name, value)
    return df.select(*names, "__base", "__stretches")


def least_cells(scanned: DataFrame, rate: float = FALSE_DISCOVERY) -> dict[int, int]:
    """The cell from which stretches of each octave of length are discoveries. The driver gets one row per octave."""
    cells = scanned.select(F.explode("__stretches").alias("x")).where("x.cell is not null").groupBy("x.octave", "x.cell").count()
    ranked = cells.selectExpr("octave", "cell", "sum(count) over (partition by octave order by cell desc) as found", "sum(count) over (partition by octave) as tests")
    # The cell's largest p-value, 10^(-cell / 10), has to stay under rate * found / tests.
    passed = ranked.where((F.col("cell") > 0) & (F.pow(F.lit(10.0), -F.col("cell") / 10) <= rate * F.col("found") / F.col("tests")))
    return {r.octave: r.cell for r in passed.groupBy("octave").agg(F.min("cell").alias("cell")).collect()}


def found(cells: dict[int, int]) -> Column:
    """All spans of a scanned row, given least_cells: the base ones, and discoveries that overlap none of them."""

    def added(x):
        wanted = F.lit(False)
        for octave, cell in sorted(cells.items()):
            wanted = wanted | ((x["octave"] == octave) & (x["cell"] >= cell))
        return wanted & ~F.exists("__base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    return F.array_sort(F.concat("__base", tagged(F.filter("__stretches", added), KINDS.index("random"))))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """One row per input row: id and found, array<struct(start, kind, end)> ordered by start, then kind.

    Kinds are places in KINDS: the three base kinds and stretches the battery adds, of which those
    that overlap a base match are left out. A null text counts as empty; null ids, repeated rows
    and empty tables pass through; other columns are ignored.
    """
    scanned = checkpoint(with_scan(df.select(F.col(id_col), F.col(text_col)), text_col).select(id_col, "__base", "__stretches"))
    return scanned.select(id_col, found(least_cells(scanned, rate)).alias("found"))


def without_secrets(df: DataFrame, text_col: str = "text", rate: float = FALSE_DISCOVERY, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``df``, every secret in the text replaced by a mark.

    The text is scanned twice, once for the corpus-wide p-values and once in passing, rather than
    shuffled to meet its spans. Null texts stay null.
    """
    cells = least_cells(with_scan(df.select(text_col), text_col), rate)
    scanned = with_scan(df, text_col).withColumn("__found", found(cells))
    return scanned.withColumn(text_col, redacted(F.col(text_col).cast("string"), F.col("__found"), mark)).select(*df.columns)


def shown(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """find_secrets in digest form: id, n_assign, n_access, n_hex, base_sha256, spans."""
    spans = find_secrets(df, id_col, text_col, rate)
    count = [of_kind(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS[:3])]
    return spans.select(id_col, *count, digest(shown(F.filter("found", lambda s: s["kind"] < 3))).alias("base_sha256"), shown(F.col("found")).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every found span, overlapping ones as one, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        more = F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))).otherwise(text)
