"""Source accounting and corpus distributions: single aggregates, which Spark splits into partial and final ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.text import preview, rounded, safe_ratio, text_of, token_count

#: Words of at least three letters.
WORD = r"[a-zà-öø-ÿ]{3,}"


def unified(documents: DataFrame) -> DataFrame:
    """A documents table in the shape of the unified corpus."""
    return documents.select(
        F.col("source").alias("cleaning_source"), F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("sample_uid"), "doc_id", "lang",
        text_of("text").alias("cleaned_text"), token_count(text_of("text")).alias("token_count"), F.length(text_of("text")).cast("long").alias("char_count"), F.col("text").isNull().alias("is_dropped"),
    )


def account(df: DataFrame, by: list[str], text_col: str = "text", filters: dict[str, str] | None = None) -> DataFrame:
    """Documents, words, characters and UTF-8 bytes by group; ``filters`` are equalities on values as strings. Null text is an empty document."""
    for name, value in (filters or {}).items():
        df = df.where(F.col(name).cast("string") == value)
    text = text_of(text_col)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(token_count(text)).alias("words"), F.sum(F.length(text).cast("long")).alias("characters"),
        F.sum(F.octet_length(text).cast("long")).alias("bytes"), F.count_if(text == "").alias("empty_documents"),
    )


def macro_stats(corpus: DataFrame, by: str = "cleaning_source") -> DataFrame:
    """Counts, sums, averages and continuous percentiles of token counts, and shares of the totals."""
    tokens = F.col("token_count")
    stats = corpus.groupBy(by).agg(
        F.count(F.lit(1)).alias("sample_count"), F.count_if("is_dropped").alias("dropped_sample_count"), F.count_if(~F.col("is_dropped")).alias("kept_sample_count"),
        F.sum(tokens).alias("token_count"), F.sum("char_count").alias("char_count"), F.avg(tokens).alias("avg_tokens_per_doc"),
        F.percentile(tokens, F.array(*(F.lit(q) for q in (0.5, 0.9, 0.95, 0.99)))).alias("q"), F.max(tokens).alias("max_tokens_per_doc"),
        F.avg(F.when(tokens > 0, F.col("char_count") / tokens)).alias("avg_chars_per_token"),
    )
    total = Window.partitionBy()
    return stats.select(
        by, "sample_count", "dropped_sample_count", "kept_sample_count", "token_count", "char_count", rounded(F.col("avg_tokens_per_doc")).alias("avg_tokens_per_doc"),
        *(rounded(F.col("q")[n]).alias(name) for n, name in enumerate(("median_tokens_per_doc", "p90_tokens_per_doc", "p95_tokens_per_doc", "p99_tokens_per_doc"))),
        "max_tokens_per_doc", rounded(F.col("avg_chars_per_token")).alias("avg_chars_per_token"),
        rounded(safe_ratio(F.col("sample_count"), F.sum("sample_count").over(total))).alias("doc_share"),
        rounded(safe_ratio(F.col("token_count"), F.sum("token_count").over(total))).alias("token_share"),
    )


def label_distribution(corpus: DataFrame, label: str, by: str = "cleaning_source") -> DataFrame:
    """Documents and tokens by label, with shares within each group; an absent label is 'missing'."""
    name = F.coalesce(F.nullif(F.col(label), F.lit("")), F.lit("missing"))
    counted = corpus.groupBy(by, name.alias("label")).agg(F.count(F.lit(1)).alias("document_count"), F.sum("token_count").alias("token_count"))
    within = Window.partitionBy(by)
    return counted.select("*", rounded(safe_ratio(F.col("document_count"), F.sum("document_count").over(within))).alias("document_share"), rounded(safe_ratio(F.col("token_count"), F.sum("token_count").over(within))).alias("token_share"))


def nested_distribution(corpus: DataFrame, spans: str, label: str, value: Column, by: str = "cleaning_source") -> DataFrame:
    """Entries and a summed value by label of an array of structs; ``value`` is an expression over the fields."""
    rows = corpus.select(by, F.inline(spans))
    name = F.coalesce(F.nullif(F.col(label), F.lit("")), F.lit("missing"))
    return rows.groupBy(by, name.alias("label")).agg(F.count(F.lit(1)).alias("entry_count"), F.sum(value).cast("long").alias("value_sum"))


def label_pivot(corpus: DataFrame, label: str, labels: list[str], by: str = "cleaning_source") -> DataFrame:
    return corpus.groupBy(by).pivot(label, labels).agg(F.count(F.lit(1))).na.fill(0)


def word_counts(corpus: DataFrame, pattern: str = WORD, by: str = "cleaning_source") -> DataFrame:
    words = F.regexp_extract_all(F.lower("cleaned_text"), F.lit(pattern), F.lit(0))
    return corpus.where(~F.col("is_dropped")).select(by, F.explode(words).alias("word")).groupBy(by, "word").agg(F.count(F.lit(1)).alias("count"))


def top_words(counts: DataFrame, k: int, stopwords: DataFrame | None = None, by: str = "cleaning_source") -> DataFrame:
    """The k most frequent words of each group, ties by the word; ``stopwords`` is a bounded list of words to leave out."""
    if stopwords is not None:
        counts = counts.join(stopwords, "word", "left_anti")
    order = Window.partitionBy(by).orderBy(F.col("count").desc(), "word")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(by, "rank", "word", "count")


def top_samples(corpus: DataFrame, k: int, by: str = "cleaning_source") -> DataFrame:
    """The k longest kept documents of each group, with a preview."""
    kept = corpus.where(~F.col("is_dropped") & (F.length("cleaned_text") > 0))
    order = Window.partitionBy(by).orderBy(F.col("token_count").desc(), "sample_uid")
    # Ranks need no text: it is cut to the preview before rows are dealt by group.
    narrow = kept.select(by, "sample_uid", "token_count", "lang", preview(F.col("cleaned_text")).alias("preview"))
    return narrow.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def compare(expected: DataFrame, observed: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Full outer comparison: both values, their difference, and a status."""
    a, b = expected.alias("a"), observed.alias("b")
    rows = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    out = [F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key)]
    same = F.lit(True)
    for v in values:
        x, y = F.coalesce(F.col(f"a.{v}"), F.lit(0)).cast("long"), F.coalesce(F.col(f"b.{v}"), F.lit(0)).cast("long")
        out += [x.alias(f"expected_{v}"), y.alias(f"observed_{v}"), (y - x).alias(f"delta_{v}")]
        same = same & (x == y)
    status = F.when(F.col(f"a.{key}").isNull(), "unexpected").when(F.col(f"b.{key}").isNull(), "missing").when(same, "match").otherwise("mismatch")
    return rows.select(*out, status.alias("status"))


def source_stats(corpus: DataFrame, registry: DataFrame) -> DataFrame:
    """All and active documents, tokens and characters by registered source and type."""
    return corpus.join(registry, corpus.cleaning_source == registry.source_name).groupBy("source_name", "source_type").agg(
        F.count(F.lit(1)).alias("total_docs"), F.count_if(~F.col("is_dropped")).alias("active_docs"), F.sum("token_count").alias("total_tokens"), F.sum("char_count").alias("total_chars")
    )


def training_manifest(corpus: DataFrame) -> DataFrame:
    from grainmill.functions.text import sample_key

    return corpus.where(~F.col("is_dropped") & F.col("token_count").isNotNull()).select("doc_id", "cleaning_source", "token_count", "char_count", sample_key(F.col("sample_uid")).alias("sample_key"))


def render_markdown(rows: list[dict], columns: list[str]) -> str:
    """A markdown table of a small report, sorted by its first column, with thousands separators and escaped bars."""
    def cell(v):
        return f"{v:,}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str("" if v is None else v).replace("|", "\\|")

    body = sorted(rows, key=lambda r: str(r[columns[0]]))
    lines = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in body])


def parse_markdown(text: str) -> list[dict[str, str | int | float]]:
    """Rows of the first table of a markdown report; numbers lose their thousands separators."""
    def value(cell: str):
        bare = cell.replace(",", "")
        for kind in (int, float):
            try:
                return kind(bare)
            except ValueError:
                pass
        return cell

    lines = [x.strip() for x in text.splitlines()]
    start = next((n for n, x in enumerate(lines[:-1]) if x.startswith("|") and set(lines[n + 1]) <= set("|-: ") and "-" in lines[n + 1]), None)
    if start is None:
        return []
    import re

    def cells(line: str) -> list[str]:
        return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line)[1:-1]]

    names, out = cells(lines[start]), []
    for line in lines[start + 2 :]:
        if not line.startswith("|"):
            break
        out.append(dict(zip(names, map(value, cells(line)))))
    return out


def named_sources(plan: str, known: list[str]) -> list[str]:
    """Known sources that a plan's text names, in the order they first appear."""
    low = plan.lower()
    return sorted((s for s in known if s.lower() in low), key=lambda s: low.index(s.lower()))


def metadata_columns(frames: list[DataFrame], text_col: str) -> list[str]:
    """Columns other than the text, in the order first seen over several tables."""
    return list(dict.fromkeys(c for df in frames for c in df.columns if c != text_col))


def ensure_match(compared: DataFrame) -> DataFrame:
    """The comparison, which raises an error as it is read if a row does not match."""
    failure = F.raise_error(F.concat(F.lit("accounting differs: "), F.to_json(F.struct(*compared.columns))))
    return compared.withColumn("status", F.when(F.col("status") == "match", F.col("status")).otherwise(failure.cast("string")))
