"""Queries of cleaning and quality, with their SQL built from the same fixed patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions.text import text_of
from grainmill.operators import cleaning as C
from grainmill.operators import quality as Q
from grainmill.operators import sequential as S
from grainmill.plans.corpus import read


def cleaned(spark, sf_dir, table, id_col, text_col, source) -> DataFrame:
    """Digest of a cleaning run: the text's hash and the metadata."""
    out = C.clean(read(spark, sf_dir, table).select(id_col, F.col(text_col).alias("text")), source)
    m = F.col("_cleaning")
    return out.select(
        id_col, F.sha2("text", 256).alias("cleaned_sha256"), m["dropped"].alias("dropped"), m["original_char_count"].alias("original_char_count"),
        m["cleaned_char_count"].alias("cleaned_char_count"), m["removed_char_count"].alias("removed_char_count"), m["approximate_cleaned_token_count"].alias("cleaned_tokens"), F.concat_ws(",", m["rules_triggered"]).alias("rules"),
    )


def rounded(df: DataFrame, keep: list[str], names: list[str]) -> DataFrame:
    return df.select(*keep, *(F.round(F.col(n).cast("double"), 6).alias(n) for n in names))


LINE = ["paragraph_count", "line_count", "non_empty_line_count", "text_char_count", "newline_count", "duplicate_line_count", "duplicate_line_fraction", "duplicated_line_character_ratio", "line_punctuation_fraction", "bullet_line_ratio", "ending_ellipsis_line_ratio"]
WORD = ["word_count", "non_symbol_word_count", "average_non_symbol_word_length", "hash_symbol_ratio", "ellipsis_ratio", "alpha_word_ratio", "newline_word_ratio", "stopword_count"]
GRAM = Q.GRAMS.names


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def filtered(profile: str):
    return lambda s, d: Q.retained(Q.quality(documents(s, d)), Q.PROFILES[profile]).select("doc_id", "source", "word_count")


def rule_totals(spark, sf_dir) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select(F.regexp_replace("html", r"<[^>]*>", "\n").alias("text"))
    counts = C.rule_counts(text_of("text"), "hplt-malay") | C.rule_counts(text_of("text"), "lowyat")
    return pages.agg(*(F.sum(n).alias(rule.replace(".", "__")) for rule, n in counts.items()))


QUERIES = {
    "clean_web": lambda s, d: cleaned(s, d, "pages", "page_id", "html", "hplt-malay"),
    "clean_forum": lambda s, d: cleaned(s, d, "pages", "page_id", "html", "lowyat"),
    "clean_cari": lambda s, d: cleaned(s, d, "pages", "page_id", "html", "cari"),
    "clean_reddit": lambda s, d: cleaned(s, d, "documents", "doc_id", "text", "reddit_bolehland"),
    "clean_books": lambda s, d: cleaned(s, d, "documents", "doc_id", "text", "books"),
    "clean_rule_counts": rule_totals,
    "clean_metrics": lambda s, d: C.metrics(read(s, d, "pages").select(F.col("html").alias("text")), "hplt-indonesia"),
    "drop_predicate": lambda s, d: documents(s, d).select("doc_id", C.should_drop(text_of("text")).alias("dropped")),
    "clean_lines": lambda s, d: read(s, d, "pages").select("page_id", S.clean_lines(F.col("html"), "lowyat").alias("c")).select("page_id", F.sha2("c.text", 256).alias("cleaned_sha256"), F.to_json("c.rule_counts").alias("rule_counts"), "c.drop_reason"),
    "ocr_cleanup": lambda s, d: documents(s, d).select("doc_id", S.clean_ocr(F.col("text")).alias("c")).select("doc_id", F.sha2("c.text", 256).alias("cleaned_sha256"), F.to_json("c.removed_counts").alias("removed_counts")),
    "reference_tail": lambda s, d: documents(s, d).select("doc_id", S.remove_references(F.col("text"), ocr=True).alias("c")).select("doc_id", "c.removed", "c.method", "c.removed_chars"),
    "chunk_to_budget": lambda s, d: documents(s, d).select("doc_id", F.posexplode(S.chunked(F.col("text"), 256)).alias("chunk", "text")),
    "quality_lines": lambda s, d: rounded(Q.line_metrics(documents(s, d)), ["doc_id"], LINE),
    "quality_words": lambda s, d: rounded(Q.word_metrics(documents(s, d)), ["doc_id"], WORD),
    "quality_dup_ngrams": lambda s, d: rounded(Q.quality(documents(s, d)), ["doc_id"], GRAM),
    "quality_top_ngrams": lambda s, d: Q.top_ngrams(documents(s, d), 2),
    "quality_stopwords": lambda s, d: Q.word_metrics(documents(s, d), stopwords=Q.STOPWORDS["de"]).select("doc_id", "stopword_count", "at_least_2_stopwords"),
    "quality_filter_retained": filtered("retained"),
    "quality_filter_strict": filtered("strict"),
    "quality_pass_counts": lambda s, d: Q.pass_counts(Q.quality(documents(s, d)), Q.STRICT),
}


def lit(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def chain(expr: str, steps) -> str:
    for pattern, new in steps:
        expr = f"replace({expr}, {lit(pattern)}, {lit(new)})" if (pattern, new) in C.ENTITIES else f"regexp_replace({expr}, {lit(pattern)}, {lit(new)}, 'g')"
    return expr


def hits(expr: str, pattern: str) -> str:
    return f"cast(len(regexp_extract_all({expr}, {lit(pattern)})) as bigint)"


TOKEN = r"[^ \t\n\x0B\f\r]+"
STRIP = r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$"


def drop(expr: str) -> str:
    t = f"regexp_replace({expr}, {lit(STRIP)}, '', 'g')"
    rest = chain(t, C.URLS)
    words, left, n, m = hits(t, C.LETTER), hits(rest, f"{C.LETTER}+"), f"length({t})", f"length({rest})"
    share = f"(coalesce(({n} - {m}) / nullif({n}, 0), 0))"
    return f"({t} = '' or {words} = 0 or coalesce({words} / nullif({n}, 0), 0) < {C.LEAST_WORD_SHARE} or ({n} > {m} and ({left} = 0 or ({left} <= 2 and {share} >= {C.SOME_LINKS}) or {share} >= {C.MOST_LINKS})))"


def clean_sql(table: str, id_col: str, text: str, source: str) -> str:
    steps = [*C.chain_of(source), *C.NORMALIZE]
    rules = ", ".join(f"case when {hits('lower(old)' if p is C.PHRASE else 'old', p)} > 0 then '{r}' end" for r, p in C.counted_of(source))
    return f"""with o as (select {id_col}, coalesce({text}, '') as old from {table}), n as (select *, {chain('old', steps)} as new from o), d as (select *, {drop('new')} as dropped from n),
        f as (select {id_col}, old, dropped, case when dropped then '' else new end as new from d)
        select {id_col}, sha256(new) as cleaned_sha256, dropped, cast(length(old) as bigint) as original_char_count, cast(length(new) as bigint) as cleaned_char_count, cast(length(old) - length(new) as bigint) as removed_char_count,
        {hits('new', TOKEN)} as cleaned_tokens, array_to_string(list_filter([{rules}], lambda x: x is not null), ',') as rules from f"""


PAGES = r"(select regexp_replace(html, '<[^>]*>', chr(10), 'g') as text from pages)"
ALL_RULES = [*C.counted_of("hplt-malay"), *C.counted_of("lowyat")]
HPLT = [*C.chain_of("hplt-indonesia"), *C.NORMALIZE]
METRICS = f"""with o as (select coalesce(html, '') as old from pages), n as (select *, {chain('old', HPLT)} as new from o), d as (select *, {drop('new')} as dropped from n),
    f as (select old, dropped, case when dropped then '' else new end as new from d),
    g as (select count(*) as total_records, count(*) filter (not dropped) as records_written, count(*) filter (dropped) as records_dropped, count(*) filter (old <> new) as records_modified,
    cast(sum(length(old)) as bigint) as original_total_characters, cast(sum(length(new)) as bigint) as cleaned_total_characters, cast(sum({hits('old', TOKEN)}) as bigint) as approximate_original_tokens, cast(sum({hits('new', TOKEN)}) as bigint) as approximate_cleaned_tokens,
    {", ".join(f"cast(sum({hits('lower(old)' if p is C.PHRASE else 'old', p)}) as bigint) as {r.replace('.', '__')}" for r, p in C.counted_of("hplt-indonesia"))} from f)
    select *, greatest(original_total_characters - cleaned_total_characters, 0) as removed_characters, round(100.0 * greatest(original_total_characters - cleaned_total_characters, 0) / original_total_characters, 6) as percent_characters_removed,
    greatest(approximate_original_tokens - approximate_cleaned_tokens, 0) as removed_tokens, round(100.0 * greatest(approximate_original_tokens - approximate_cleaned_tokens, 0) / approximate_original_tokens, 6) as percent_tokens_removed from g"""
NL = "chr(10)"
LINES = rf"""with t as (select doc_id, coalesce(text, '') as t from documents),
    s as (select doc_id, t, regexp_split_to_array(t, '\n+') as lines, list_filter(string_split(t, {NL}), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) as fl,
      string_split(regexp_replace(t, '\n$', ''), {NL}) as pl, regexp_split_to_array(regexp_replace(t, {lit(STRIP)}, '', 'g'), '\n{{2,}}') as paras from t),
    m as (select *, replace(t, {NL}, '') as bare, len(lines) - len(list_distinct(lines)) as rep, list_filter(fl, lambda x: {" or ".join(f"ends_with(x, '{m}')" for m in Q.TERMINAL)}) as punct from s)
    select doc_id, len(paras)::double as paragraph_count, len(lines)::double as line_count, len(fl)::double as non_empty_line_count, length(t)::double as text_char_count, (length(t) - length(bare))::double as newline_count,
    rep::double as duplicate_line_count, round(rep / len(lines), 6) as duplicate_line_fraction,
    round((coalesce(list_sum(list_transform(fl, lambda x: length(x))), 0) - coalesce(list_sum(list_transform(list_distinct(fl), lambda x: length(x))), 0)) / greatest(length(bare), 1), 6) as duplicated_line_character_ratio,
    round(coalesce(len(punct) / nullif(len(fl), 0), 0), 6) as line_punctuation_fraction,
    round(len(list_filter(pl, lambda x: regexp_matches(x, '^[ \t]*[•-]'))) / len(pl), 6) as bullet_line_ratio, round(len(list_filter(pl, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) / len(pl), 6) as ending_ellipsis_line_ratio from m"""


def words_sql(stopwords: tuple[str, ...]) -> str:
    marks = Q.PUNCTUATION + "".join(Q.TERMINAL)
    stops = ", ".join(lit(w) for w in stopwords)
    return rf"""with t as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {lit(Q.WORD)}) as w from documents),
        m as (select *, greatest(len(w), 1) as n, list_filter(w, lambda x: length(translate(x, {lit(marks)}, '')) > 0) as c, len(list_intersect(list_distinct(list_transform(w, lambda x: lower(x))), [{stops}])) as hits from t)
        select doc_id, len(w)::double as word_count, len(c)::double as non_symbol_word_count, round(coalesce(list_sum(list_transform(c, lambda x: length(x))) / nullif(len(c), 0), 0), 6) as average_non_symbol_word_length,
        round((length(t) - length(replace(t, '#', ''))) / n, 6) as hash_symbol_ratio, round(((length(t) - length(replace(t, '...', ''))) / 3 + length(t) - length(replace(t, '…', ''))) / n, 6) as ellipsis_ratio,
        round(len(list_filter(w, lambda x: regexp_matches(x, '[\p{{L}}]'))) / n, 6) as alpha_word_ratio, round((length(t) - length(replace(t, {NL}, ''))) / n, 6) as newline_word_ratio, hits::double as stopword_count, hits >= 2 as at_least_2_stopwords from m"""


ORACLES = {
    "clean_web": clean_sql("pages", "page_id", "html", "hplt-malay"),
    "clean_forum": clean_sql("pages", "page_id", "html", "lowyat"),
    "clean_cari": clean_sql("pages", "page_id", "html", "cari"),
    "clean_reddit": clean_sql("documents", "doc_id", "text", "reddit-bolehland"),
    "clean_rule_counts": f"select {', '.join(f'cast(sum({hits("lower(text)" if p is C.PHRASE else "text", p)}) as bigint) as {r.replace(".", "__")}' for r, p in ALL_RULES)} from {PAGES}",
    "clean_metrics": METRICS,
    "drop_predicate": f"select doc_id, {drop("coalesce(text, '')")} as dropped from documents",
    "quality_lines": LINES,
    "quality_words": f"select * exclude (at_least_2_stopwords) from ({words_sql(Q.STOPWORDS['en'])})",
    "quality_stopwords": f"select doc_id, cast(stopword_count as bigint) as stopword_count, at_least_2_stopwords from ({words_sql(Q.STOPWORDS['de'])})",
    "quality_top_ngrams": f"""with t as (select doc_id, length(coalesce(text, '')) as chars, regexp_extract_all(coalesce(text, ''), {lit(Q.WORD)}) as w from documents),
        g as (select doc_id, chars, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as gram, unnest(range(1, len(w))) as place from t where len(w) >= 2),
        c as (select doc_id, chars, gram, count(*) as count, min(place) as first from g group by all), r as (select *, row_number() over (partition by doc_id order by count desc, first) as k from c)
        select doc_id, gram, count, round(length(gram) * count / greatest(chars, 1), 6) as fraction from r where k = 1""",
}
