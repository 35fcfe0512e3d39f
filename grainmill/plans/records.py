"""Queries of outside rows, crossed keys, JSON lists, part metrics and regression checks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.functions.text import month_bucket, sample_uid, token_count
from grainmill.operators import planning as P
from grainmill.operators import records as R
from grainmill.plans.corpus import read

PROFILES, BY_SOURCE = ["ind_Latn", "zsm_Latn"], {"src1": "ind_Latn", "src3": "ind_Latn"}


def external(s, d):
    rows = R.external_rows(read(s, d, "documents"), "corpus", "text", "doc_id", {"language": F.col("lang")})
    return rows.drop("cleaned_text", "cleaning_rules_triggered")


def origins(s, d):
    graded = read(s, d, "labels").select(sample_uid("doc_id", "label").alias("uid"), "quality")
    return R.with_origin(graded, read(s, d, "documents").select(sample_uid("doc_id").alias("uid"), "lang"), "uid", "doc")


def composite(s, d):
    docs = read(s, d, "documents")
    good = docs.join(read(s, d, "labels").where("quality = 1").select("doc_id"), "doc_id", "left_semi").select("source", "doc_id")
    return R.on_partition_and_key(good, docs.select("source", "doc_id", F.length("text").cast("long").alias("chars")), "source", "doc_id").select("source", "doc_id", "chars")


def roles(s, d):
    found = read(s, d, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return found.where(R.contains_all("roles", ["user", "assistant"])).select("conv_id")


def turns(s, d):
    said = read(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set("turn")).alias("turns"))
    coded = said.select("conv_id", R.json_list("turns").alias("turns")).withColumn("n", F.size(R.json_items("turns", "long")))
    return coded.where("n > 2").select("conv_id", "turns", F.col("n").cast("long").alias("n"))


def parts(s, d):
    docs = P.fixed_parts(read(s, d, "documents"), "doc_id", 64)
    text = F.coalesce("text", F.lit(""))
    return R.part_metrics(docs, "part", "source", F.trim(text) == "", F.length(text) - F.length(F.trim(text)), token_count(text))


def regression(s, d):
    docs = read(s, d, "documents")
    found = [docs.groupBy("source").agg(F.avg(n).alias("chars"), F.max(n).alias("longest")) for n in (F.length("text"), F.col("n_chars"))]
    return R.regressions(*found, "source", ["chars", "longest"])


QUERIES = {
    "external_rows": external,
    "origin_pairs": origins,
    "composite_key_join": composite,
    "array_containment": roles,
    "json_list_length": turns,
    "language_profiles": lambda s, d: read(s, d, "documents").groupBy(R.language_profile("source", BY_SOURCE, PROFILES).alias("profile")).agg(F.count(F.lit(1)).alias("documents")),
    "part_metrics": parts,
    "stale_errors": lambda s, d: R.stale_errors(read(s, d, "labels").where("quality = 1"), read(s, d, "labels").where("toxic = 1"), "doc_id"),
    "metric_regression": regression,
    "row_group_manifest": lambda s, d: R.row_groups(read(s, d, "documents"), 128).drop("path"),
    "source_shares": lambda s, d: R.shares(read(s, d, "documents"), "source", "lang"),
    "month_buckets": lambda s, d: read(s, d, "events").groupBy(month_bucket(F.date_format("ts", "yyyy-MM-dd")).alias("month")).agg(F.count(F.lit(1)).alias("events")),
}

TOKENS = r"len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))"
PARTS = f"(select *, (row_number() over (order by doc_id) - 1) // 64 as part, coalesce(text, '') as t, coalesce(source, 'unknown') as name, {TOKENS} as n_tokens from documents)"

ORACLES = {
    "external_rows": """select uid as sample_uid, sha256(uid) as sample_uid_hash, id as document_id, 'corpus' as native_source, h as original_text_sha256, h as cleaned_text_sha256, n as original_char_count, n as cleaned_char_count,
        cast(0 as bigint) as removed_char_count, false as cleaning_is_dropped, lang as language from (select 'corpus#' || doc_id as uid, cast(doc_id as varchar) as id, sha256(coalesce(text, '')) as h, length(coalesce(text, '')) as n, lang from documents)""",
    "origin_pairs": "select 'doc://' || doc_id as origin_uid, 'label://' || doc_id as uid, quality, lang from labels join documents using (doc_id)",
    "composite_key_join": "select source, doc_id, length(text) as chars from documents where source is not null and doc_id in (select doc_id from labels where quality = 1)",
    "array_containment": "select conv_id from conversations group by 1 having bool_or(role = 'user') and bool_or(role = 'assistant')",
    "json_list_length": "select conv_id, '[' || string_agg(distinct turn, ',' order by turn) || ']' as turns, count(distinct turn) as n from conversations group by 1 having count(distinct turn) > 2",
    "language_profiles": "select case when lower(trim(source)) in ('src1', 'src3') then 'ind_Latn' else 'zsm_Latn' end as profile, count(*) as documents from documents group by 1",
    "part_metrics": f"""with x as (select part, name, count(*) as n, count(*) filter (where trim(t) = '') as d, sum(length(t) - length(trim(t))) as r, sum(n_tokens) as k from {PARTS} p group by 1, 2)
        select part, cast(sum(n) as bigint) as rows, cast(sum(d) as bigint) as dropped, cast(sum(r) as bigint) as removed_chars, cast(sum(k) as bigint) as tokens, string_agg(name || ':' || n, ',' order by name) as source_counts from x group by 1""",
    "stale_errors": "select doc_id from labels group by 1 having bool_or(quality = 1) and bool_or(toxic = 1)",
    "metric_regression": """with x as (select source, round(avg(length(text)), 3) as a, round(avg(n_chars), 3) as b, cast(max(length(text)) as double) as c, cast(max(n_chars) as double) as d from documents group by 1)
        select source, 'chars' as metric, a as actual, b as expected, coalesce(a = b, false) as equal from x union all select source, 'longest', c, d, coalesce(c = d, false) from x""",
    "row_group_manifest": "select n // 128 as row_group, min(n) as start, count(*) as rows from (select row_number() over () - 1 as n from documents) group by 1",
    "source_shares": "select source, lang, n as rows, round(n / sum(n) over (), 6) as of_total, round(n / sum(n) over (partition by source), 6) as of_group from (select source, lang, count(*) as n from documents group by 1, 2)",
    "month_buckets": "select strftime(ts, '%Y-%m') as month, count(*) as events from events group by 1",
}
