"""Document fingerprints from closed syncmers, in built-in expressions only.

The units are words. A k-mer of K words is an anchor if, among the hashes of its inner runs of S
words, the smallest is the first or the last. That depends on the k-mer alone, so an anchor stays
one wherever its words move, and among K - S + 1 k-mers in a row there is at least one. A text's
fingerprint holds the 32-bit hashes of all its distinct anchors, ascending, eight hex digits each,
and beside it the places where each of them stands; the share of common hashes among those of two
texts is the Jaccard likeness of their anchor sets.

A run of more than LONG characters without a space (scripts without spaces, encoded data) has each of
its characters as a unit. That depends on the run alone, so it is the same wherever the run stands,
and a character more or less in it changes only the anchors that hold it. A text with fewer than K words, or without an anchor, has one
hash, that of all its words; a text without words has an empty fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U32, digest, parallelism, text_or_empty

#: SKETCH bounds the hashes of a fingerprint; None keeps all.
K, S, SKETCH = 5, 2, None
LONG = 24
SPACE = r"[ \t-\r]+"


def _columns(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``_words and ``out``_inner (hash of the S words from each place on)."""
    words = F.array_remove(F.split(text, SPACE), "")
    df = df.withColumn(f"{out}_words", words)
    units = F.flatten(F.transform(f"{out}_words", lambda w: F.when(F.length(w) > LONG, F.array_remove(F.split(w, ""), "")).otherwise(F.array(w))))
    df = df.withColumn(f"{out}_words", F.when(F.exists(f"{out}_words", lambda w: F.length(w) > LONG), units).otherwise(F.col(f"{out}_words")))
    assert S == 2
    pairs = F.zip_with(f"{out}_words", F.slice(f"{out}_words", F.lit(2), F.size(f"{out}_words")), lambda a, b: F.xxhash64(a, b))
    return df.withColumn(f"{out}_inner", F.slice(pairs, F.lit(1), F.greatest(F.size(f"{out}_words") - 1, F.lit(0))))


def _anchor(inner: str):
    """Of the k-mer at a place: its hash if it is a closed syncmer, else null."""

    def at(first: Column, place: Column) -> Column:
        rest = [F.get(inner, place + n) for n in range(1, K - S + 1)]
        low = F.least(first, *rest)
        return F.when(rest[-1].isNotNull() & ((low == first) | (low == rest[-1])), F.xxhash64(first, *rest))

    return at


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, the distinct anchor hashes of a text column as an ascending array<long>, and ``out``_at, array<struct(place, hash)> of all anchors in order of place."""
    df = _columns(df, text, out)
    words, inner = F.col(f"{out}_words"), f"{out}_inner"
    at = _anchor(inner)
    # Two arguments: the element and its place.
    placed = F.filter(F.transform(inner, lambda x, i: F.struct(i.alias("place"), at(x, i).bitwiseAND(U32).alias("hash"))), lambda a: a["hash"].isNotNull())
    whole = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(words).bitwiseAND(U32).alias("hash")))
    df = df.withColumn(f"{out}_at", placed)
    df = df.withColumn(f"{out}_at", F.when((F.size(f"{out}_at") > 0) | (F.size(words) == 0), F.col(f"{out}_at")).otherwise(whole))
    hashes = F.array_sort(F.array_distinct(F.col(f"{out}_at")["hash"]))
    return df.withColumn(out, hashes if SKETCH is None else F.slice(hashes, 1, SKETCH)).drop(f"{out}_words", inner)


def anchors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, place, hash) of every anchor of every text, place being the number of its first word; for positional matching.

    Texts without an anchor have no row here. Nulls count as empty texts; repeated rows repeat
    their anchors; other columns are ignored.
    """
    df = _columns(df.select(F.col(id_col), text_or_empty(text_col).alias("__t")), "__t", "__a")
    at = _anchor("__a_inner")
    found = F.transform("__a_inner", lambda x, i: F.struct(i.alias("place"), at(x, i).alias("hash")))
    return df.select(id_col, F.inline(F.filter(found, lambda a: a["hash"].isNotNull())))


def _digits(h: Column) -> Column:
    return F.lpad(F.lower(F.hex(h)), 8, "0")


def shown(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, _digits), "")


def shown_places(placed: Column) -> Column:
    """place:hash of every anchor, comma-joined."""
    return F.array_join(F.transform(placed, lambda a: F.concat_ws(":", a["place"].cast("string"), _digits(a["hash"]))), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two fingerprints, 0 to 1; two empty ones are alike. An estimate if SKETCH bounds them."""
    union = F.array_union(a, b) if SKETCH is None else F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    common = F.array_intersect(a, b) if SKETCH is None else F.array_intersect(F.array_intersect(a, b), union)
    return F.when(F.size(F.array_union(a, b)) == 0, 1.0).otherwise(F.size(common) / F.greatest(F.size(union), F.lit(1))).cast("double")


def in_lanes(df: DataFrame, id_col: str, lanes: int) -> DataFrame:
    """Deals rows of (id, text) to ranges of the id and appends to each range the first row of the next, marked.

    Adds lane and extra (1 for an appended row). The driver gets at most ``lanes`` ids and the very
    first row, which follows the last. Rows are in order of id, nulls first, then text.
    """
    shares = [n / lanes for n in range(1, lanes)]
    cuts = df.agg(F.percentile_approx(id_col, F.array(*map(F.lit, shares)), 10_000)).first()[0] if shares else None
    kind = df.schema[id_col].dataType.simpleString()
    cuts = F.array(*(F.lit(c).cast(kind) for c in sorted(set(cuts or ())))) if cuts else F.array().cast(f"array<{kind}>")
    lane = F.size(F.filter(cuts, lambda c: c <= F.col(id_col)))
    df = df.withColumn("lane", lane)
    firsts = sorted((r.lane, r.id) for r in df.groupBy("lane").agg(F.min(id_col).alias("id")).collect())
    if not firsts:
        return df.withColumn("extra", F.lit(0))
    own = F.struct(F.col("lane"), F.lit(0).alias("extra"))
    # By lane: its first id, and the lane before; the first lane has none before it.
    known = dict(firsts)
    before = dict(zip([at for at, _ in firsts[1:]], [at for at, _ in firsts]))
    lane_count = firsts[-1][0] + 1
    first_id = F.get(F.array(*(F.lit(known.get(n)).cast(kind) for n in range(lane_count))), F.col("lane"))
    lane_before = F.get(F.array(*(F.lit(before.get(n)).cast("int") for n in range(lane_count))), F.col("lane"))
    twice = F.array(own, F.struct(lane_before.alias("lane"), F.lit(1).alias("extra")))
    places = F.when(lane_before.isNotNull() & (F.col(id_col) == first_id), twice).otherwise(F.array(own))
    dealt = df.withColumn("__place", F.explode(places)).select(id_col, "text", "__place.lane", "__place.extra")
    head = df.select(id_col, "text").orderBy(F.col(id_col).asc_nulls_first(), "text").limit(1)
    return dealt.unionByName(head.withColumns({"lane": F.lit(firsts[-1][0]), "extra": F.lit(1)}))


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints every text and its edited form, and compares them.

    One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, anchors, edited_anchors (place:hash of every anchor, place being the
    number of its first word). The edited text has its last floor(n_chars / 2) characters replaced by
    the first as many of the next document's (all of a shorter one), in order of the id, then text;
    the first row follows the last, and a single row follows itself.

    A null text counts as empty; rows without id come first; repeated rows follow one another; an
    empty table gives an empty result; other columns are ignored. Rows are shuffled once, by ranges
    of the id, and no range holds more than its share.
    """
    rows = in_lanes(df.select(F.col(id_col), text_or_empty(text_col).alias("text")), id_col, parallelism(df))
    order = f"over (partition by lane order by extra, `{id_col}` nulls first, text)"
    rows = rows.withColumn("next", F.expr(f"lead(text) {order}")).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = with_sketch(rows.withColumn("edited", edited).drop("next"), "text", "own")
    rows = with_sketch(rows, "edited", "other").withColumn("edited_sha256", digest(F.col("edited"))).drop("edited")
    rows = rows.withColumn("following", F.expr(f"lead(own) {order}")).where("extra = 0")
    return rows.select(
        id_col, F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", shown(F.col("own")).alias("fingerprint"),
        shown(F.col("other")).alias("edited_fingerprint"), likeness("own", "other").alias("near_edited"), likeness("own", "following").alias("near_next"),
        shown_places(F.col("own_at")).alias("anchors"), shown_places(F.col("other_at")).alias("edited_anchors"),
    )
