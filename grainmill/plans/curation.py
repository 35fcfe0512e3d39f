"""Queries of planning, the retained index, unification and language labels, with their SQL."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from grainmill.functions.text import sample_uid
from grainmill.operators import index as I
from grainmill.operators import language as L
from grainmill.operators import planning as P
from grainmill.operators import quality as Q
from grainmill.operators import unify as U
from grainmill.plans.corpus import CORPUS, corpus, read, spans

CAP, PART, SAMPLE_BYTES = 1_000_000, 50_000, 400_000
NOW, LAST = "2024-01-25 00:00:00", "2024-01-15 00:00:00"


def dated(s, d):
    """Documents with the month of the event of the same number."""
    events = read(s, d, "events").select(F.col("event_id").alias("doc_id"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    docs = read(s, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    return docs.join(events, "doc_id").select("doc_id", "bytes", F.concat(F.substring("day", 1, 8), F.lit("0"), (F.col("doc_id") % 3 + 1).cast("string")).alias("month"))


def quota_accept(s, d):
    rows = dated(s, d)
    return P.accept_within_quota(rows, P.month_quotas(rows, CAP), "month", "doc_id", "bytes", "byte_quota").select("doc_id", "month", F.col("running").cast("long").alias("running"), "byte_quota")


def sizes(s, d):
    return read(s, d, "documents").select("doc_id", "source", F.octet_length("text").cast("long").alias("bytes"))


def sampled(s, d, past=False):
    rows = P.round_robin(sizes(s, d), "source", "doc_id")
    return P.take_within(rows, ("turn", "source"), "bytes", SAMPLE_BYTES, past).select("doc_id", "source", F.col("turn").cast("int").alias("turn"), F.col("running").cast("long").alias("running"))


def weight():
    return F.when(F.col("source") == "src1", 3).otherwise(1)


def duplicates(s, d):
    docs = read(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = docs.groupBy("h").agg(F.min("doc_id").alias("first"))
    return docs.join(first, "h").where("doc_id > first").select("doc_id")


def built(s, d):
    """The index over all thresholds of the 'retained' profile."""
    docs = read(s, d, "documents")
    metrics = Q.quality(docs.select("doc_id", "text")).drop("text")
    keep = reduce(and_, Q.passes(Q.RETAINED).values())
    languages = docs.select("doc_id", F.col("lang").alias("lid_label"))
    rows = I.retained_index(metrics, docs.select("doc_id", F.col("source").alias("source_domain")), languages, duplicates(s, d), keep, ["en", "fr", "es"], "retained")
    return rows.select("profile_name", "doc_id", "source_domain", "lid_label", "word_count")


def refreshed(s, d):
    events = read(s, d, "events").select("event_id", "ts", "event_type")
    return I.refresh_window(events, ["ts"], F.lit(LAST).cast("timestamp"), 24, F.lit(NOW).cast("timestamp")).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


def refresh_upsert(s, d):
    docs = read(s, d, "documents").select("doc_id", F.col("lang").alias("label"))
    graded = read(s, d, "labels").groupBy("doc_id").agg(F.max("quality").cast("string").alias("label"))
    return I.upsert(docs, graded, ["doc_id"])


def ranges(s, d):
    docs = read(s, d, "documents")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return P.range_counts(docs, "doc_id", P.id_ranges(low or 0, (high or -1) + 1, 7))


SCHEMA = {"sample_uid": "string", "native_source": "string", "doc_id": "string", "cleaned_char_count": "bigint", "subreddit": "string", "score": "bigint"}


def shards(s, d):
    left = read(s, d, "documents").select(sample_uid("doc_id").alias("uid"), "doc_id", F.sha2("text", 256).alias("sha"), "lang")
    right = left.where("doc_id % 10 <> 3").select("uid", F.when(F.col("doc_id") % 7 == 0, "bad").otherwise(F.col("sha")).alias("sha"), F.length("lang").alias("extra"))
    return left, right


def merged(s, d):
    left, _ = shards(s, d)
    return U.merge(left, left.select("uid", "sha", F.upper("lang").alias("label")), "uid", ["sha"], ["label"]).select("uid", "doc_id", "label")


QUERIES = {
    "month_quotas": lambda s, d: P.part_quotas(P.month_quotas(dated(s, d), CAP), PART),
    "month_byte_quota_accept": quota_accept,
    "round_robin_sample": lambda s, d: sampled(s, d),
    "round_robin_sample_past_cap": lambda s, d: sampled(s, d, True),
    "weighted_interleave": lambda s, d: P.weighted_interleave(read(s, d, "documents").select("doc_id", "source"), "source", "doc_id", weight()).select("doc_id", "source", F.col("place").cast("int").alias("place")),
    "part_packing": lambda s, d: P.fixed_parts(read(s, d, "documents").select("doc_id"), "doc_id", 64).groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")),
    "running_bytes": lambda s, d: P.running_total(sizes(s, d), "doc_id", "bytes", "running", by="source").select("doc_id", "source", F.col("running").cast("long").alias("running")),
    "id_ranges": ranges,
    "availability_sets": lambda s, d: P.availability(read(s, d, "documents"), read(s, d, "labels").where("quality = 1"), read(s, d, "labels").where("toxic = 1"), "doc_id"),
    "retained_index": built,
    "index_retraction": lambda s, d: I.retract(read(s, d, "documents").select("doc_id", "source"), duplicates(s, d)),
    "index_refresh_window": refreshed,
    "index_upsert": refresh_upsert,
    "unified_projection": lambda s, d: U.project(read(s, d, "documents").withColumn("sample_uid", sample_uid("doc_id")), SCHEMA, {"native_source": "source", "cleaned_char_count": "n_chars"}),
    "validated_merge": merged,
    "merge_audit": lambda s, d: U.audit(*shards(s, d), "uid", ["sha"]),
    "thread_reconstruction": lambda s, d: U.threads(read(s, d, "conversations"), "conv_id", "turn", "role", "text"),
    "thread_first_wins": lambda s, d: U.first_wins(read(s, d, "conversations").where("role = 'user'").select("conv_id", "turn", "text"), "conv_id", "turn").select("conv_id", "turn", F.length("text").alias("chars")),
    "lid_stopword": lambda s, d: L.by_stopwords(read(s, d, "documents")),
    "lid_primary_by_coverage": lambda s, d: L.primary_by_coverage(spans(corpus(s, d)), "doc_id", "spans"),
}

DATED = "(select doc_id, strlen(text) as bytes, strftime(ts, '%Y-%m-') || '0' || (doc_id % 3 + 1) as month from documents join events on event_id = doc_id)"
QUOTA = f"(select month, {CAP} // count(*) over () + case when row_number() over (order by month) - 1 < {CAP} % count(*) over () then 1 else 0 end as byte_quota from (select distinct month from {DATED} x))"
ROBIN = "(select doc_id, source, strlen(text) as bytes, row_number() over (partition by source order by doc_id) as turn from documents)"
ROBIN_SUM = f"(select *, sum(bytes) over (order by turn, source rows unbounded preceding) as running from {ROBIN})"
DUPLICATES = "(select doc_id from (select doc_id, min(doc_id) over (partition by text) as first from documents) where doc_id > first)"


def _stopword_votes() -> str:
    votes = ", ".join(f"len(list_filter(w, lambda x: x in ({', '.join(repr(x) for x in Q.STOPWORDS[c])}))) as {c}" for c in L.LANGUAGES)
    best = "greatest(" + ", ".join(L.LANGUAGES) + ")"
    cases = " ".join(f"when {c} = {best} then '{c}'" for c in L.LANGUAGES)
    word = Q.WORD.replace("'", "''")
    return f"with t as (select doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{word}'), lambda x: lower(x)) as w from documents), v as (select doc_id, {votes} from t) select doc_id, case when {best} = 0 then 'und' {cases} end as lid_label, {best} as votes from v"


ORACLES = {
    "month_quotas": f"""with p as (select *, greatest(cast(ceil(byte_quota / {PART}) as bigint), 1) as parts from {QUOTA} q where byte_quota > 0), x as (select *, unnest(range(parts)) as part from p)
        select month, cast(part as int) as part, byte_quota // parts + case when part < byte_quota % parts then 1 else 0 end as part_quota from x""",
    "month_byte_quota_accept": f"select doc_id, month, running, byte_quota from (select doc_id, month, byte_quota, cast(sum(bytes) over (partition by month order by doc_id rows unbounded preceding) as bigint) as running from {DATED} d join {QUOTA} q using (month)) where running <= byte_quota",
    "round_robin_sample": f"select doc_id, source, cast(turn as int) as turn, cast(running as bigint) as running from {ROBIN_SUM} r where running <= {SAMPLE_BYTES}",
    "round_robin_sample_past_cap": f"select doc_id, source, cast(turn as int) as turn, cast(running as bigint) as running from {ROBIN_SUM} r where running - bytes < {SAMPLE_BYTES}",
    "weighted_interleave": "with n as (select doc_id, source, row_number() over (partition by source order by doc_id) as n from documents) select doc_id, source, cast(row_number() over (order by (n - 1) // (case when source = 'src1' then 3 else 1 end), source, n) as int) as place from n",
    "part_packing": "select cast((n - 1) // 64 as bigint) as part, count(*) as rows, min(doc_id) as first, max(doc_id) as last from (select doc_id, row_number() over (order by doc_id) as n from documents) group by 1",
    "running_bytes": "select doc_id, source, cast(sum(strlen(text)) over (partition by source order by doc_id rows unbounded preceding) as bigint) as running from documents",
    "id_ranges": """with e as (select min(doc_id) as low, max(doc_id) - min(doc_id) + 1 as n from documents),
        r as (select k, low + k * (n // 7) + least(k, n % 7) as first, low + (k + 1) * (n // 7) + least(k + 1, n % 7) as stop from e, range(7) t(k))
        select cast(k as int) as worker, first, stop, (select count(*) from documents where doc_id >= first and doc_id < stop) as rows from r""",
    "availability_sets": "select doc_id, case when d.doc_id is null then 'orphan' when good then 'done' when bad then 'error_only' else 'missing' end as status from (select distinct doc_id from documents) d full join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as bad from labels group by 1) l using (doc_id) where d.doc_id is not null or good or bad",
    "index_retraction": f"select doc_id, source from documents where doc_id not in {DUPLICATES}",
    "index_refresh_window": f"select event_type, count(*) as rows from events where ts >= timestamp '{LAST}' - interval 24 hour and ts <= timestamp '{NOW}' group by 1",
    "index_upsert": "select doc_id, lang as label from documents where doc_id not in (select doc_id from labels) union all select doc_id, cast(max(quality) as varchar) from labels group by 1",
    "unified_projection": "select 'doc://' || doc_id as sample_uid, source as native_source, cast(doc_id as varchar) as doc_id, n_chars as cleaned_char_count, cast(null as varchar) as subreddit, cast(null as bigint) as score from documents",
    "validated_merge": "select 'doc://' || doc_id as uid, doc_id, upper(lang) as label from documents",
    "merge_audit": "select 'doc://' || doc_id as uid, case when doc_id % 10 = 3 then 'missing_right' else 'mismatch_sha' end as problem from documents where doc_id % 10 = 3 or doc_id % 7 = 0",
    "thread_reconstruction": "select conv_id, count(*) as posts, string_agg(role || ': ' || coalesce(text, ''), chr(10) order by turn, role || ': ' || coalesce(text, '')) as text from conversations group by 1",
    "thread_first_wins": "select conv_id, turn, cast(length(text) as int) as chars from (select *, row_number() over (partition by conv_id order by turn) as n from conversations where role = 'user') where n = 1",
    "lid_stopword": _stopword_votes(),
    "lid_primary_by_coverage": f"select doc_id, case when char_count // 2 >= greatest(char_count - char_count // 2 - 5, 0) then lang end as label, greatest(char_count // 2, char_count - char_count // 2 - 5) as covered from {CORPUS} c",
}

