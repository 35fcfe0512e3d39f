"""Queries of accounting, distributions and manifests, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions.text import rounded, sample_key, sample_uid
from grainmill.operators import accounting as A

#: Words too common to tell sources apart; a fixed list, so it may be broadcast.
STOPWORDS = ("and", "that", "the", "this", "with", "des", "les", "par", "pour", "une", "das", "der", "die", "ein", "und", "los", "las", "que", "con", "una")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.unified(read(spark, sf_dir, "documents"))


def stopwords(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(w,) for w in STOPWORDS], "word string"))


def registry(df: DataFrame) -> DataFrame:
    """A registry of the sources there are: even-numbered ones are 'web', the others 'books'."""
    number = F.regexp_extract("source", "([0-9]+)", 1).cast("int")
    return df.select(F.col("source").alias("source_name"), F.when(number % 2 == 0, "web").otherwise("books").alias("source_type")).distinct()


def words_structs(df: DataFrame) -> DataFrame:
    """Word-label entries as a detector stores them: label and count of each document."""
    words = F.regexp_extract_all(F.lower("cleaned_text"), F.lit(A.WORD), F.lit(0))
    short = F.size(F.filter(words, lambda w: F.length(w) <= 4))
    entries = F.array(F.struct(F.lit("short").alias("label"), short.alias("count")), F.struct(F.lit("").alias("label"), (F.size(words) - short).alias("count")))
    return df.withColumn("word_label_counts", entries)


def spans(df: DataFrame) -> DataFrame:
    half = F.floor(F.col("char_count") / 2).cast("long")
    entries = F.array(
        F.struct(F.lit(0).cast("long").alias("start_index"), half.alias("end_index"), F.col("lang").alias("language_label")),
        F.struct((half + 5).alias("start_index"), F.col("char_count").alias("end_index"), F.lit(None).cast("string").alias("language_label")),
    )
    return df.withColumn("spans", entries)


def quality_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.col("quality").alias("score"))
    return A.training_manifest(corpus(spark, sf_dir)).join(labels, "doc_id").select("doc_id", "cleaning_source", "token_count", "sample_key", "score", F.lit("quality").alias("signal_name"))


QUERIES = {
    "source_accounting": lambda s, d: A.account(read(s, d, "documents"), ["source"]),
    "source_accounting_filtered": lambda s, d: A.account(read(s, d, "documents"), ["source", "lang"], filters={"lang": "en"}),
    "macro_source_stats": lambda s, d: A.macro_stats(corpus(s, d)),
    "lang_distribution": lambda s, d: A.label_distribution(corpus(s, d), "lang"),
    "span_distribution": lambda s, d: A.nested_distribution(spans(corpus(s, d)), "spans", "language_label", F.greatest(F.col("end_index") - F.col("start_index"), F.lit(0))),
    "word_label_distribution": lambda s, d: A.nested_distribution(words_structs(corpus(s, d)), "word_label_counts", "label", F.col("count")),
    "lang_pivot": lambda s, d: A.label_pivot(corpus(s, d), "lang", ["de", "en", "es", "fr"]),
    "top_words_raw": lambda s, d: A.top_words(A.word_counts(corpus(s, d)), 20),
    "top_words_stopword_filtered": lambda s, d: A.top_words(A.word_counts(corpus(s, d)), 20, stopwords(s)),
    "topk_samples_per_source": lambda s, d: A.top_samples(corpus(s, d), 3),
    "accounting_compare_full_outer": lambda s, d: A.compare(
        A.account(read(s, d, "documents").where("source <> 'src1'"), ["source"]),
        A.account(read(s, d, "documents").join(read(s, d, "labels"), "doc_id", "left").where("source <> 'src2' and coalesce(toxic, 0) = 0"), ["source"]), "source", ["documents", "words"]),
    "source_stats_active": lambda s, d: A.source_stats(corpus(s, d), registry(read(s, d, "documents"))),
    "training_manifest": lambda s, d: A.training_manifest(corpus(s, d)),
    "sample_key_one_percent": lambda s, d: read(s, d, "documents").select("doc_id", sample_key(sample_uid("doc_id")).alias("sample_key")).where(F.col("sample_key") < int(0.01 * (1 << 62))),
    "quality_filtered_manifest": quality_filtered,
    "percent_of_total": lambda s, d: read(s, d, "documents").groupBy("lang").count().select("lang", F.col("count").alias("documents"), rounded(F.expr("count * 100.0 / sum(count) over ()")).alias("percent")),
    "events_by_month": lambda s, d: read(s, d, "events").groupBy(F.date_format("ts", "yyyy-MM").alias("month"), "event_type").agg(F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")),
}

TOKENS = r"cast(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) as bigint)"
CORPUS = f"""(select source as cleaning_source, 'doc://' || doc_id as sample_uid, doc_id, lang, coalesce(text, '') as cleaned_text,
  {TOKENS} as token_count, cast(length(coalesce(text, '')) as bigint) as char_count, text is null as is_dropped from documents)"""
KEY = "cast(cast('0x' || substr(sha256('doc://' || doc_id), 1, 15) as bigint) % 4611686018427387904 as bigint)"
ACCOUNT = f"count(*) as documents, cast(sum({TOKENS}) as bigint) as words, cast(sum(length(coalesce(text, ''))) as bigint) as characters, cast(sum(strlen(coalesce(text, ''))) as bigint) as bytes, count(*) filter (coalesce(text, '') = '') as empty_documents"
WORDS = f"(select cleaning_source, word, count(*) as count from (select cleaning_source, unnest(regexp_extract_all(lower(cleaned_text), '{A.WORD}')) as word from {CORPUS}) group by 1, 2)"


def _top(where: str) -> str:
    return f"select cleaning_source, rank, word, count from (select *, cast(row_number() over (partition by cleaning_source order by count desc, word) as int) as rank from {WORDS} {where}) where rank <= 20"


def _share(a: str, over: str) -> str:
    return f"round(coalesce({a} / nullif(sum({a}) over ({over}), 0), 0), 6)"


ORACLES = {
    "source_accounting": f"select source, {ACCOUNT} from documents group by source",
    "source_accounting_filtered": f"select source, lang, {ACCOUNT} from documents where lang = 'en' group by source, lang",
    "macro_source_stats": f"""with g as (select cleaning_source, count(*) as sample_count, count(*) filter (is_dropped) as dropped_sample_count, count(*) filter (not is_dropped) as kept_sample_count,
        cast(sum(token_count) as bigint) as token_count, cast(sum(char_count) as bigint) as char_count, round(avg(token_count), 6) as avg_tokens_per_doc, round(quantile_cont(token_count, 0.5), 6) as median_tokens_per_doc,
        round(quantile_cont(token_count, 0.9), 6) as p90_tokens_per_doc, round(quantile_cont(token_count, 0.95), 6) as p95_tokens_per_doc, round(quantile_cont(token_count, 0.99), 6) as p99_tokens_per_doc,
        max(token_count) as max_tokens_per_doc, round(avg(case when token_count > 0 then char_count / token_count end), 6) as avg_chars_per_token from {CORPUS} c group by cleaning_source)
        select *, {_share("sample_count", "")} as doc_share, {_share("token_count", "")} as token_share from g""",
    "lang_distribution": f"""with g as (select cleaning_source, coalesce(nullif(lang, ''), 'missing') as label, count(*) as document_count, cast(sum(token_count) as bigint) as token_count from {CORPUS} c group by 1, 2)
        select *, {_share("document_count", "partition by cleaning_source")} as document_share, {_share("token_count", "partition by cleaning_source")} as token_share from g""",
    "span_distribution": f"""with x as (select cleaning_source, lang as label, char_count // 2 as value from {CORPUS} c union all select cleaning_source, 'missing', greatest(char_count - (char_count // 2 + 5), 0) from {CORPUS} c)
        select cleaning_source, label, count(*) as entry_count, cast(sum(value) as bigint) as value_sum from x group by 1, 2""",
    "word_label_distribution": f"""with w as (select cleaning_source, regexp_extract_all(lower(cleaned_text), '{A.WORD}') as words from {CORPUS} c),
        x as (select cleaning_source, len(words) as n, len(list_filter(words, lambda w: length(w) <= 4)) as short from w)
        select cleaning_source, 'short' as label, count(*) as entry_count, cast(sum(short) as bigint) as value_sum from x group by 1 union all select cleaning_source, 'missing', count(*), cast(sum(n - short) as bigint) from x group by 1""",
    "lang_pivot": f"select cleaning_source, count(*) filter (lang = 'de') as de, count(*) filter (lang = 'en') as en, count(*) filter (lang = 'es') as es, count(*) filter (lang = 'fr') as fr from {CORPUS} c group by 1",
    "top_words_raw": _top(""),
    "top_words_stopword_filtered": _top("where word not in (" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"),
    "topk_samples_per_source": rf"""select cleaning_source, sample_uid, token_count, lang, preview, rank from (select cleaning_source, sample_uid, token_count, lang, substr(regexp_replace(cleaned_text, '[ \t\n\x0B\f\r]+', ' ', 'g'), 1, 500) as preview,
        cast(row_number() over (partition by cleaning_source order by token_count desc, sample_uid) as int) as rank from {CORPUS} c where length(cleaned_text) > 0) where rank <= 3""",
    "accounting_compare_full_outer": f"""with a as (select source, count(*) as documents, sum({TOKENS}) as words from documents where source <> 'src1' group by 1),
        b as (select source, count(*) as documents, sum({TOKENS}) as words from documents left join labels using (doc_id) where source <> 'src2' and coalesce(toxic, 0) = 0 group by 1)
        select coalesce(a.source, b.source) as source, coalesce(a.documents, 0) as expected_documents, coalesce(b.documents, 0) as observed_documents, coalesce(b.documents, 0) - coalesce(a.documents, 0) as delta_documents,
        cast(coalesce(a.words, 0) as bigint) as expected_words, cast(coalesce(b.words, 0) as bigint) as observed_words, cast(coalesce(b.words, 0) - coalesce(a.words, 0) as bigint) as delta_words,
        case when a.source is null then 'unexpected' when b.source is null then 'missing' when a.documents = b.documents and a.words = b.words then 'match' else 'mismatch' end as status from a full join b on a.source = b.source""",
    "source_stats_active": f"""select r.source_name, r.source_type, count(*) as total_docs, count(*) filter (not is_dropped) as active_docs, cast(sum(token_count) as bigint) as total_tokens, cast(sum(char_count) as bigint) as total_chars
        from {CORPUS} c join (select distinct source as source_name, case when cast(regexp_extract(source, '([0-9]+)', 1) as int) % 2 = 0 then 'web' else 'books' end as source_type from documents) r on c.cleaning_source = r.source_name group by 1, 2""",
    "training_manifest": f"select doc_id, cleaning_source, token_count, char_count, {KEY} as sample_key from {CORPUS} c where not is_dropped",
    "sample_key_one_percent": f"select doc_id, {KEY} as sample_key from documents where {KEY} < {int(0.01 * (1 << 62))}",
    "quality_filtered_manifest": f"select doc_id, cleaning_source, token_count, {KEY} as sample_key, quality as score, 'quality' as signal_name from {CORPUS} c join labels using (doc_id) where not is_dropped and quality = 1",
    "percent_of_total": "select lang, count(*) as documents, round(count(*) * 100.0 / sum(count(*)) over (), 6) as percent from documents group by lang",
    "events_by_month": "select strftime(ts, '%Y-%m') as month, event_type, count(*) as rows, min(event_id) as first_id, max(event_id) as last_id from events group by 1, 2",
}
