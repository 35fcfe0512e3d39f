"""Source-specific cleaning as chains of built-in replacements, with rule counts, a drop test and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import count_of, percent, safe_ratio, stripped, text_of, token_count

# Patterns and word lists of the cleaning rules. Classes are ASCII, so that they mean
# the same to other engines; $ is the end of a line ending in a newline alone.
IMAGE_MARKDOWN = r"!\[[^\]]*\]\([^)]*\)"
PAGE_ASSET = r"(?i)_page_\d+_[A-Za-z]+_\d+\.(?:jpeg|jpg|png)"
URL_OR_DOI = r"(?i)(?:https?://|www\.)[^ \t\n\x0B\f\r]+|\bdoi[ \t\n\x0B\f\r]*[:.]?[ \t\n\x0B\f\r]*10\.[^ \t\n\x0B\f\r]+|\b10\.\d{4,9}/[^ \t\n\x0B\f\r]+"
TRUNCATED_URL = r"(?i)\b(?:https?://|www\.)[^ \t\n\x0B\f\r]*\.{2,}[^ \t\n\x0B\f\r]*"
HTML_MEDIA = r"(?is)<(?:iframe|script|video|source|embed|object|img)\b[^>]*(?:>.*?</(?:iframe|script|video|object)>|/?>)"
HTML_TAG = r"(?s)<[^>]+>"
LINE_BREAK_TAG = r"(?i)<br[ \t\n]*/?>"
ATTACHMENT = r"(?is)<!--[ \t\n]*IBF\.ATTACHMENT_[^>]*-->"
QUOTE = r"(?is)\bQUOTE[ \t\n]*\([^)]{0,160}\)"
REPLIED = r"(?is)^[ \t\n]*[A-Za-z0-9_.~@+-]{2,40}[ \t\n]+replied[ \t\n]+at[ \t\n]+\d{1,2}-\d{1,2}-\d{4}[ \t\n]+\d{1,2}:\d{2}[ \t\n]+[AP]M[ \t\n]+"
EDIT_LINE = r"(?im)^[ \t\n]*(?:this post has been edited by|edited by)\b[^\n]*\n?"
SPOILER_LINE = r"(?im)^[ \t\n]*(?:show|hide)?[ \t\n]*spoiler[ \t\n]*:?[ \t\n]*$\n?"
SMILEY_FILE = r"(?i)\b(?:static/image/smiley/)?[A-Za-z0-9_-]+\.(?:gif|jpe?g|png|webp)\b"
MEDIA_MARKDOWN = r"(?is)!\[(?:gif|img|image|video)?\]\([^)]*\)"
DELETED_LINE = r"(?im)^[ \t\n]*\[(?:deleted|removed)\][ \t\n]*$\n?"
MEDIA_URL_LINE = r"(?im)^[ \t\n]*(?:https?://)?(?:preview\.redd\.it|i\.redd\.it|v\.redd\.it|giphy\.com|media\.giphy\.com|imgur\.com|i\.imgur\.com)/[^ \t\n\x0B\f\r]+[ \t\n]*$\n?"
BARE_MEDIA_LINE = r"(?im)^[ \t\n]*[A-Za-z0-9_.-]+\.(?:gif|jpe?g|png|webp|mp4)[ \t\n]*$\n?"
BOILERPLATE_LINE = (
    r"(?im)^[ \t\n]*(?:home|menu|search|login|log in|sign in|sign up|register|subscribe|privacy policy|terms(?: of service)?|cookie policy|accept cookies|"
    r"all rights reserved|copyright|advertisement|share this|read more|previous|next|back to top|skip to content)[ \t\n]*$\n?"
)
COOKIE_LINE = r"(?im)^.{0,200}\b(?:cookies?|privacy policy|terms of service|accept all|manage consent)\b.{0,200}$\n?"
BOOKS_STRONG_METADATA_LINE = r"(?im)^.*(?:to cite this article|all rights reserved|creative commons|hak cipta|diperbolehkan.*memperbanyak|memperbanyak.*isi buku|izin penerbit).*$\n?"
BOOKS_METADATA_LINE = (
    r"(?im)^[^\n]{0,160}(?:\b(?:issn|e-issn|isbn|corresponding author|to cite this article|copyright|creative commons|all rights reserved)\b|"
    r"\b(?:published|received|accepted|tel\.?|faks|fax|e-?mail)[ \t\n]*:|\b[A-Za-z0-9_.+-]+@[A-Za-z0-9_.-]+\.[a-z]{2,}\b)[^\n]{0,160}$\n?"
)
BOOKS_CAPTION_LINE = r"(?im)^[ \t\n]*(?:\*\*)?[ \t\n]*(?:figure|fig\.?|table|gambar|rajah|jadual)[ \t\n]*\d+[.:]?[^\n]{0,220}$\n?"
REFERENCE_HEADING_LINE = r"(?im)^[ \t\n]{0,4}(?:#{1,6}[ \t\n]*)?(?:\*\*)?[ \t\n]*(?:references|bibliography|works cited|rujukan|daftar pustaka)[^\n]*\n?"
FIXED_PHRASES = ("sent from my iphone", "login to view this content", "log in to view this content", "register to view this content", r"\[embedded media\]", "embedded media", "attachment unavailable")
PHRASE = "|".join(FIXED_PHRASES)
PHRASE_LINE = rf"(?im)^.*(?:{PHRASE}).*$\n?"
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))
SOURCES = ("books-ocr", "lowyat", "reddit-bolehland", "reddit-indonesia", "cari", "hplt-malay", "hplt-indonesia")
ALIASES = {"books": "books-ocr", "books+ocr": "books-ocr", "books + ocr": "books-ocr"}

LEAST_WORD_SHARE, SOME_LINKS, MOST_LINKS = 0.12, 0.45, 0.75

DECODE = [*ENTITIES, (LINE_BREAK_TAG, "\n"), (HTML_TAG, " ")]
URLS = [(URL_OR_DOI, ""), (TRUNCATED_URL, "")]
MEDIA_AND_URLS = [(MEDIA_URL_LINE, "\n"), (BARE_MEDIA_LINE, "\n"), *URLS]
NORMALIZE = [(r"[ \t]+\n", "\n"), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n"), (r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")]
FORUM = [*DECODE, (HTML_MEDIA, ""), (REPLIED, ""), (EDIT_LINE, "\n")]
CHAINS = {
    "books-ocr": [(IMAGE_MARKDOWN, ""), (PAGE_ASSET, "")],
    "lowyat": [*DECODE, (ATTACHMENT, ""), (HTML_MEDIA, ""), (QUOTE, ""), (REPLIED, ""), (EDIT_LINE, "\n"), (SPOILER_LINE, "\n"), (PHRASE_LINE, "\n"), (SMILEY_FILE, ""), *MEDIA_AND_URLS],
    "reddit": [(MEDIA_MARKDOWN, ""), (DELETED_LINE, "\n"), (PHRASE_LINE, "\n"), *MEDIA_AND_URLS],
    "cari": [*FORUM, (PHRASE_LINE, "\n"), (SMILEY_FILE, ""), *MEDIA_AND_URLS],
    "hplt": [*DECODE, (HTML_MEDIA, ""), (HTML_TAG, " "), (BOILERPLATE_LINE, "\n"), (COOKIE_LINE, "\n"), (PHRASE_LINE, "\n"), *MEDIA_AND_URLS],
}
BOOKS_AFTER_TAIL = [(BOOKS_STRONG_METADATA_LINE, "\n"), (BOOKS_METADATA_LINE, "\n"), (BOOKS_CAPTION_LINE, "\n"), *URLS]
COUNTED = {
    "books-ocr": [("markdown_image", IMAGE_MARKDOWN), ("page_asset", PAGE_ASSET), ("url_or_doi", URL_OR_DOI), ("publication_metadata", BOOKS_METADATA_LINE), ("figure_table_caption", BOOKS_CAPTION_LINE), ("reference_heading", REFERENCE_HEADING_LINE)],
    "forum": [("url", URL_OR_DOI), ("edit_boilerplate", EDIT_LINE), ("fixed_boilerplate", PHRASE), ("smiley_or_media_filename", SMILEY_FILE)],
    "reddit": [("media_markdown", MEDIA_MARKDOWN), ("deleted_placeholder", DELETED_LINE), ("fixed_boilerplate", PHRASE), ("media_url_line", MEDIA_URL_LINE)],
    "hplt": [("boilerplate_line", BOILERPLATE_LINE), ("cookie_boilerplate", COOKIE_LINE), ("fixed_boilerplate", PHRASE), ("url", URL_OR_DOI)],
}


def source_of(name: str) -> str:
    """The canonical name of a source."""
    name = name.strip().lower().replace("_", "-")
    name = ALIASES.get(name, name)
    if name not in SOURCES:
        raise ValueError(f"unknown source {name!r}; there are {', '.join(SOURCES)}")
    return name


def chain_of(source: str) -> list[tuple[str, str]]:
    name = source_of(source)
    return CHAINS[name if name in CHAINS else name.split("-")[0]]


def counted_of(source: str) -> list[tuple[str, str]]:
    name = source_of(source)
    kind = "forum" if name in ("lowyat", "cari") else name if name in COUNTED else name.split("-")[0]
    return [(f"{name.replace('-', '_')}.{rule}", pattern) for rule, pattern in COUNTED[kind]]


def java(pattern: str) -> str:
    """In Java, a line ends at a newline alone only in the d mode."""
    return pattern.replace("(?im)", "(?imd)", 1) if pattern.startswith("(?im)") else pattern


def replaced(text: Column, chain: list[tuple[str, str]]) -> Column:
    for pattern, new in chain:
        plain = (pattern, new) in ENTITIES
        text = F.replace(text, F.lit(pattern), F.lit(new)) if plain else F.regexp_replace(text, java(pattern), new)
    return text


def normalized(text: Column) -> Column:
    return replaced(text, NORMALIZE)


def cleaned(text: Column, source: str) -> Column:
    """The cleaning chain of a source. For books it ends before the reference tail, which trim_reference_tail() of operators.sequential cuts off."""
    return normalized(replaced(text, chain_of(source)))


def books_after_tail(text: Column) -> Column:
    return normalized(replaced(text, BOOKS_AFTER_TAIL))


#: A letter, digit or underscore of any script.
LETTER = r"[\p{L}\p{N}_]"


def should_drop(text: Column) -> Column:
    """Empty, hardly any word characters, or hardly anything but links."""
    text = stripped(text)
    chars = F.length(text)
    words = count_of(text, LETTER)
    rest = replaced(text, URLS)
    left = count_of(rest, f"{LETTER}+")
    share = safe_ratio(chars - F.length(rest), chars)
    links = (chars > F.length(rest)) & ((left == 0) | ((left <= 2) & (share >= SOME_LINKS)) | (share >= MOST_LINKS))
    return (text == "") | (words == 0) | (safe_ratio(words, chars) < LEAST_WORD_SHARE) | links


def rule_counts(text: Column, source: str) -> dict[str, Column]:
    """Hits of each rule, on the text as it was."""
    return {rule: count_of(F.lower(text) if pattern is PHRASE else text, java(pattern)) for rule, pattern in counted_of(source)}


def clean(df: DataFrame, source: str, text_col: str = "text", keep_dropped: bool = True) -> DataFrame:
    """Replaces the text by its cleaned form and adds _cleaning, the metadata of what was done; dropped rows are kept with an empty text unless told otherwise."""
    old = text_of(text_col)
    df = df.withColumns({"__old": old, "__new": cleaned(old, source)})
    if source_of(source) == "books-ocr":
        from grainmill.operators.sequential import trim_reference_tail

        df = df.withColumn("__cut", trim_reference_tail(F.col("__new"))).withColumn("__tail", F.col("__cut") != F.col("__new")).withColumn("__new", books_after_tail(F.col("__cut"))).drop("__cut")
    df = df.withColumn("__drop", should_drop(F.col("__new"))).withColumn("__new", F.when(F.col("__drop"), "").otherwise(F.col("__new")))
    rules = [F.when(n > 0, F.lit(rule)) for rule, n in rule_counts(F.col("__old"), source).items()]
    if source_of(source) == "books-ocr":
        rules.append(F.when(F.col("__tail"), F.lit("books_ocr.reference_tail")))
    before, after = token_count(F.col("__old")), token_count(F.col("__new"))
    meta = F.struct(
        F.lit(source_of(source)).alias("source"), F.col("__drop").alias("dropped"), F.array_compact(F.array(*rules)).alias("rules_triggered"),
        F.length("__old").cast("long").alias("original_char_count"), F.length("__new").cast("long").alias("cleaned_char_count"), (F.length("__old") - F.length("__new")).cast("long").alias("removed_char_count"),
        before.alias("approximate_original_token_count"), after.alias("approximate_cleaned_token_count"), (before - after).alias("approximate_removed_token_count"),
    )
    df = df.withColumns({text_col: F.col("__new"), "_cleaning": meta}).drop("__new", "__drop", "__old", *(["__tail"] if source_of(source) == "books-ocr" else []))
    return df if keep_dropped else df.where(~F.col("_cleaning.dropped"))


def metrics(df: DataFrame, source: str, text_col: str = "text") -> DataFrame:
    """One row of totals, percentages removed and rule hits."""
    old = text_of(text_col)
    hits = rule_counts(F.col("__old"), source)
    rows = clean(df.withColumn("__was", old), source, text_col).withColumn("__old", F.col("__was"))
    m = F.col("_cleaning")
    names = {rule: rule.replace(".", "__") for rule in hits}
    out = rows.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(~m["dropped"]).alias("records_written"), F.count_if(m["dropped"]).alias("records_dropped"), F.count_if(F.col("__was") != F.col(text_col)).alias("records_modified"),
        F.coalesce(F.sum(m["original_char_count"]), F.lit(0)).alias("original_total_characters"), F.coalesce(F.sum(m["cleaned_char_count"]), F.lit(0)).alias("cleaned_total_characters"),
        F.coalesce(F.sum(m["approximate_original_token_count"]), F.lit(0)).alias("approximate_original_tokens"), F.coalesce(F.sum(m["approximate_cleaned_token_count"]), F.lit(0)).alias("approximate_cleaned_tokens"),
        *(F.coalesce(F.sum(n), F.lit(0)).alias(names[rule]) for rule, n in hits.items()),
    )
    for kind, short in (("total_characters", "characters"), ("tokens", "tokens")):
        before, after = (f"original_{kind}", f"cleaned_{kind}") if short == "characters" else (f"approximate_original_{kind}", f"approximate_cleaned_{kind}")
        gone = F.greatest(F.col(before) - F.col(after), F.lit(0))
        out = out.withColumns({f"removed_{short}": gone, f"percent_{short}_removed": percent(gone, F.col(before))})
    return out
