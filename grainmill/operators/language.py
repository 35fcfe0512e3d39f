"""Language labels: a detector to plug in, a stopword vote, and what follows from spans and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.operators.quality import STOPWORDS, words_of

LANGUAGES = ("de", "en", "es", "fr")


def stopword_votes(text: Column, languages=LANGUAGES) -> dict[str, Column]:
    """Words of a text that are stopwords of each language."""
    words = F.transform(words_of(text), F.lower)
    return {code: F.size(F.filter(words, lambda w: w.isin(*STOPWORDS[code]))).cast("long") for code in languages}


def by_stopwords(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lid_label, votes): the language with most stopwords, ties to the first code; 'und' without any."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(id_col, F.transform(words_of(text), F.lower).alias("w"))
    votes = [F.struct(F.size(F.filter("w", _among(code))).cast("long").alias("votes"), F.lit(-n).alias("n"), F.lit(code).alias("code")) for n, code in enumerate(LANGUAGES)]
    best = F.array_max(F.array(*votes))
    return rows.select(id_col, F.when(best["votes"] > 0, best["code"]).otherwise("und").alias("lid_label"), best["votes"].alias("votes"))


def _among(code: str):
    return lambda w: w.isin(*STOPWORDS[code])


def primary_by_coverage(df: DataFrame, id_col: str, spans: str) -> DataFrame:
    """(id, label, covered): of array<struct(start_index, end_index, language_label)> the label that covers most characters, ties to the one seen first."""
    rows = df.select(id_col, F.posexplode(spans).alias("place", "s"))
    cover = rows.groupBy(id_col, F.col("s.language_label").alias("label")).agg(F.sum(F.greatest(F.col("s.end_index") - F.col("s.start_index"), F.lit(0))).alias("covered"), F.min("place").alias("first"))
    return cover.groupBy(id_col).agg(F.max_by(F.struct("label", "covered"), F.struct("covered", -F.col("first"))).alias("b")).select(id_col, "b.label", F.col("b.covered").cast("long").alias("covered"))


def detect(df: DataFrame, detector, id_col: str = "doc_id", text_col: str = "text", done: DataFrame | None = None, least: int = 50) -> DataFrame:
    """Labels by a plugged-in function from a list of texts to (label, score) pairs; short, null and already labelled texts and empty labels are left out."""
    import pyarrow as pa

    rows = df.where(F.col(text_col).isNotNull() & (F.length(text_col) > least)).select(id_col, text_col)
    if done is not None:
        rows = rows.join(done.select(id_col), id_col, "left_anti")

    def run(batches):
        for batch in batches:
            found = detector(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([float(x[1]) for x in found], pa.float64())], names=[id_col, "lid_label", "confidence"])

    return rows.mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, lid_label string, confidence double").where("lid_label <> ''")
