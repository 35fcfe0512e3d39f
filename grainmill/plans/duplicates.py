"""Queries of exact and near duplicates, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from grainmill.operators import neardup as N
from grainmill.plans.corpus import read


def banded(s, d):
    return N.bands(read(s, d, "documents"))


def found(s, d):
    return N.clusters(banded(s, d))


def rate(s, d):
    docs = read(s, d, "documents").join(found(s, d).select("doc_id", "canonical"), "doc_id", "left")
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count("canonical").alias("duplicates"), F.round(F.count("canonical") * 100.0 / F.count(F.lit(1)), 6).alias("percent"))


QUERIES = {
    "exact_dedup": lambda s, d: N.exact_duplicates(read(s, d, "documents")),
    "minhash_bands": banded,
    "lsh_buckets": lambda s, d: N.bucket_sizes(banded(s, d)),
    "lsh_star_links": lambda s, d: N.star_links(banded(s, d)),
    "near_dup_clusters": found,
    "near_dup_rate_by_source": rate,
    "near_dup_chain_check": lambda s, d: N.chains(found(s, d)),
    "near_dup_cluster_sizes": lambda s, d: found(s, d).groupBy("canonical").agg((F.count(F.lit(1)) + 1).alias("members"), F.max("shared_bands").alias("most_shared")),
    "keep_canonical": lambda s, d: N.keep_canonical(read(s, d, "documents"), found(s, d)).select("doc_id", "source"),
    "bands_incremental": lambda s, d: N.bands(read(s, d, "documents"), done=read(s, d, "labels")).groupBy("band_index").agg(F.countDistinct("doc_id").alias("documents")),
}

P = N.PRIME


def _fold(row: str, factor: int) -> str:
    return reduce(lambda acc, r: f"(({acc} * {factor} + {row}[{r}]) % {P})", range(1, N.ROWS + 1), "0")


PAIRS = ", ".join(f"({n}, {a}, {b})" for n, (a, b) in enumerate(N.coefficients()))
BANDS = rf"""with w as (select doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w from documents where text is not null and length(text) > {N.LEAST_CHARS}),
    g as (select doc_id, unnest(list_distinct(list_transform(range(1, len(w) - {N.WORDS} + 2), lambda i: array_to_string(w[i:i + {N.WORDS - 1}], ' ')))) as g from w where len(w) >= {N.WORDS}),
    h as (select doc_id, cast('0x' || substr(md5(g), 1, 8) as bigint) % {P} as h from g), f(n, a, b) as (values {PAIRS}),
    m as (select doc_id, n, min((a::bigint * h + b) % {P}) as m from h, f group by doc_id, n),
    r as (select doc_id, n // {N.ROWS} as band_index, list(m::hugeint order by n) as r from m group by 1, 2),
    bands as (select doc_id, cast(band_index as int) as band_index, cast({_fold('r', 65_599)} * {P} + {_fold('r', 31_337)} as bigint) as band_hash from r)"""
FIRST = f"""{BANDS}, firsts as (select band_index, band_hash, min(doc_id) as root, count(*) as size from bands group by 1, 2 having count(*) > 1),
    star as (select b.doc_id, root, count(*) as shared_bands from bands b join firsts using (band_index, band_hash) where b.doc_id > root group by 1, 2)"""
FOUND = f"""with recursive {FIRST[5:]}, edges as (select doc_id as x, root as y from star union select root, doc_id from star),
    reach(x, y) as (select x, x from edges union select r.x, e.y from reach r join edges e on r.y = e.x),
    comp as (select x as doc_id, min(y) as canonical from reach group by 1),
    found as (select c.doc_id, canonical, (select count(*) from bands p join bands q using (band_index, band_hash) where p.doc_id = c.doc_id and q.doc_id = canonical) as shared_bands from comp c where c.doc_id <> canonical)"""

ORACLES = {
    "exact_dedup": "with f as (select sha256(coalesce(text, '')) as sha, min(doc_id) as canonical, count(*) as copies from documents group by 1) select doc_id, sha, canonical, copies, doc_id = canonical as kept from (select doc_id, sha256(coalesce(text, '')) as sha from documents) join f using (sha)",
    "minhash_bands": f"{BANDS} select * from bands",
    "lsh_buckets": f"{BANDS} select band_index, band_hash, count(*) as size, min(doc_id) as first, max(doc_id) as last from bands group by 1, 2 having count(*) > 1",
    "lsh_star_links": f"{FIRST} select * from star",
    "near_dup_clusters": f"{FOUND} select * from found",
    "near_dup_rate_by_source": f"{FOUND} select source, count(*) as documents, count(canonical) as duplicates, round(count(canonical) * 100.0 / count(*), 6) as percent from documents left join found using (doc_id) group by 1",
    "near_dup_chain_check": f"{FOUND} select distinct canonical from found where canonical in (select doc_id from found)",
    "near_dup_cluster_sizes": f"{FOUND} select canonical, count(*) + 1 as members, max(shared_bands) as most_shared from found group by 1",
    "keep_canonical": f"{FOUND} select doc_id, source from documents where doc_id not in (select doc_id from found)",
    "bands_incremental": f"{BANDS} select band_index, count(distinct doc_id) as documents from bands where doc_id not in (select doc_id from labels) group by 1",
}
