"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .bpe import encode_documents
from .common import table
from .langid import fit, identify
from .linededup import line_report
from .packing import pack_documents
from .secrets import secret_report
from .sharding import shard_documents
from .simhash import near_duplicates
from .syncmers import fingerprint_documents
from .tokencount import count_tokens


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return identify(documents, fit(documents))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return nearest(embeddings, embeddings.where("vec_id % 20 = 0"), k=20)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_report(table(spark, sf_dir, "documents"))
    return report.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_language_id, op3_packing, op4_token_counts, op5_secret_scans, op6_fingerprints, op7_simhash, op8_byte_bpe, op9_nearest_neighbours, op10_line_dedup)}


#: CRC-32 by its table, the jump hash by a recursive query on wide integers, slots by lane and id.
SHARDING_SQL = """with recursive
crc_table as (select list(c order by n) as t from (select n, list_reduce(list_prepend(n::bigint, range(8)::bigint[]), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c from range(256) r(n))),
raw as (select doc_id, strlen(coalesce(text, '')) as n, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint) as b from documents),
crc as (select doc_id, n, case when n = 0 then 0 else xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::bigint) end as text_crc32 from raw, crc_table),
jumps(doc_id, state, spot, shard, grown) as (
  select doc_id, case when doc_id < 0 then doc_id::hugeint + 18446744073709551616 else doc_id::hugeint end, 0::bigint, 0::bigint, 0::bigint from documents
  union all
  select doc_id, s, floor((spot + 1)::double * (2147483648.0::double / ((s // 8589934592) + 1)::double))::bigint, case when spot < 40 then spot else shard end, spot
  from (select *, (state % 4294967296 * 2862933555777941757 + (state // 4294967296 * 2862933555777941757) % 4294967296 * 4294967296 + 1) % 18446744073709551616 as s from jumps where spot <= 40)),
placed as (select doc_id, max(shard)::int as shard, max(grown)::int as grown_shard from jumps group by 1),
lanes as (select doc_id, text_crc32, n + 16 as size, shard, grown_shard, (((case when doc_id < 0 then doc_id::hugeint + 18446744073709551616 else doc_id::hugeint end) % 4294967296 * 2862933555777941757 + 1) % 4294967296 * 64 // 4294967296)::int as lane from crc join placed using (doc_id))
select doc_id, size, text_crc32, 'key' as law, shard, row_number() over (partition by shard order by lane, doc_id) - 1 as slot, grown_shard from lanes"""


#: Lines within one edit share their first or last half with one of about their length; what stands before and after the edit is equal.
LINE_DEDUP_SQL = r"""with s as (select doc_id, string_split(text, chr(10)) as s from documents where doc_id is not null and text is not null),
l as (select doc_id, no, trim(raw, ' ' || chr(9) || chr(13)) as line from (select doc_id, unnest(s) as raw, unnest(range(len(s))) as no from s)),
o as (select * from l where length(line) > 0),
c as (select line, min(struct_pack(d := doc_id, n := no)) as first, length(line) as n from o group by line),
k as (select line, first, n, m, left(line, m // 2) as lh, right(line, m - m // 2) as rh from (select *, unnest([n, n - 1]) as m from c)),
p as (select a.line as x, b.line as y, a.n as xn, b.n as yn from k a join k b on a.m = b.m and a.lh = b.lh where a.first < b.first
  union select a.line, b.line, a.n, b.n from k a join k b on a.m = b.m and a.rh = b.rh where a.first < b.first),
near as (select distinct y as line from p where case when xn = yn then len(list_filter(range(xn), lambda i: left(x, i) = left(y, i) and substr(x, i + 2) = substr(y, i + 2))) > 0
  when xn < yn then len(list_filter(range(yn), lambda i: left(x, i) = left(y, i) and substr(x, i + 1) = substr(y, i + 2))) > 0
  else len(list_filter(range(xn), lambda i: left(x, i) = left(y, i) and substr(y, i + 1) = substr(x, i + 2))) > 0 end),
r as (select doc_id, string_agg(cast(no as varchar), ',' order by no) as removed, count(*) as n_removed from o join c using (line) where line in (select line from near) or (doc_id, no) <> (first.d, first.n) group by 1)
select doc_id, coalesce(len(string_split(text, chr(10))), 0) as n_lines, coalesce(n_removed, 0) as n_removed, coalesce(removed, '') as removed from documents left join r using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": SHARDING_SQL, "op10_line_dedup": LINE_DEDUP_SQL}
