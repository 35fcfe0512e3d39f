"""Named operations, their composition into recipes, and recipes from YAML or JSON."""

from __future__ import annotations

import copy
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("prepare", "transform", "export")


@dataclass(frozen=True)
class Op:
    name: str
    stage: str
    run: Callable[..., DataFrame]


REGISTRY: dict[str, Op] = {}


def register_op(name: str, stage: str = "transform"):
    """Registers a function from (DataFrame, **options) to a DataFrame under a unique name."""
    if stage not in STAGES:
        raise TypeError(f"stage must be one of {STAGES}")

    def wrap(f):
        if name in REGISTRY:
            raise TypeError(f"an operation named {name!r} exists")
        REGISTRY[name] = Op(name, stage, f)
        return f

    return wrap


@dataclass
class Recipe:
    """Exactly one prepare operation, one transform or more, at most one export, in that order."""

    steps: list[tuple[str, dict]] = field(default_factory=list)

    def __post_init__(self):
        unknown = [n for n, _ in self.steps if n not in REGISTRY]
        if unknown:
            raise ValueError(f"unknown operations: {', '.join(unknown)}")
        stages = [REGISTRY[n].stage for n, _ in self.steps]
        if stages.count("prepare") != 1 or "transform" not in stages or stages.count("export") > 1:
            raise ValueError("a recipe has one prepare operation, transforms, and at most one export")
        if stages != sorted(stages, key=STAGES.index):
            raise ValueError("operations have to be in the order prepare, transform, export")

    def __call__(self, df: DataFrame) -> DataFrame:
        for name, options in self.steps:
            df = df.transform(REGISTRY[name].run, **options)
        return df


def merged(base: dict, over: dict) -> dict:
    """Deep merge; lists and scalars are replaced."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def overridden(config: dict, settings: list[str]) -> dict:
    """Applies 'a.b=value' settings, values being JSON where they parse as such."""
    out = copy.deepcopy(config)
    for setting in settings:
        path, equals, text = setting.partition("=")
        if not equals:
            raise ValueError(f"{setting!r} is not key=value")
        try:
            value = json.loads(text)
        except ValueError:
            value = text
        *parents, last = path.split(".")
        at = out
        for p in parents:
            at = at.setdefault(p, {})
        at[last] = value
    return out


def load(paths: list[str], settings: list[str] = ()) -> Recipe:
    """A recipe from files, later ones over earlier ones, then settings; JSON, or YAML where that library is installed."""
    config: dict = {}
    for path in paths:
        with open(path, encoding="utf-8") as file:
            text = file.read()
        if path.endswith(".json"):
            part = json.loads(text)
        else:
            import yaml

            part = yaml.safe_load(text)
        config = merged(config, part or {})
    config = overridden(config, list(settings))
    return Recipe([(s["op"], s.get("options", {})) for s in config["steps"]])


@register_op("prepare_rows", "prepare")
def prepare_rows(df: DataFrame, done: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """All rows that are not in the table of what is done."""
    return df if done is None else df.join(done.select(key).distinct(), key, "left_anti")


@register_op("skip_existing")
def skip_existing(df: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    return df.join(done.select(key).distinct(), key, "left_anti")


@register_op("keep_where")
def keep_where(df: DataFrame, condition: str) -> DataFrame:
    return df.where(condition)


@register_op("clean_source")
def clean_source(df: DataFrame, source: str, text_col: str = "text", keep_dropped: bool = True) -> DataFrame:
    from grainmill.operators.cleaning import clean

    return clean(df, source, text_col, keep_dropped)


@register_op("clean_books_ocr_markdown")
def clean_books_ocr_markdown(df: DataFrame, text_column: str = "text", output_text_column: str = "cleaned_text") -> DataFrame:
    from grainmill.operators.sequential import clean_ocr

    out = df.withColumn("__ocr", clean_ocr(F.col(text_column)))
    removed = F.aggregate(F.map_values("__ocr.removed_counts"), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumns({output_text_column: F.col("__ocr.text"), "removed_char_count": removed, "removed_counts": F.col("__ocr.removed_counts"), "removed_examples": F.col("__ocr.examples")}).drop("__ocr")


@register_op("quality_metrics")
def quality_metrics(df: DataFrame, text_col: str = "text") -> DataFrame:
    from grainmill.operators.quality import quality

    return quality(df, text_col)


@register_op("near_duplicate_clusters")
def near_duplicate_clusters(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    from grainmill.operators.neardup import bands, clusters

    return clusters(bands(df, id_col, text_col), id_col)


@register_op("explode_chunks")
def explode_chunks(df: DataFrame, budget: int, text_col: str = "text") -> DataFrame:
    """One row per chunk of a text: an operation that returns more rows than it gets."""
    from grainmill.operators.sequential import chunked

    names = [c for c in df.columns if c != text_col]
    return df.select(*names, F.posexplode(chunked(F.col(text_col), budget)).alias("chunk", text_col))


@register_op("write_parquet", "export")
def write_parquet(df: DataFrame, path: str, partition_by: list[str] = (), compression: str = "zstd") -> DataFrame:
    writer = df.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def list_ops() -> list[tuple[str, str, str]]:
    """(name, stage, first line of its docstring) of all operations."""
    return [(op.name, op.stage, (op.run.__doc__ or "").split("\n")[0]) for op in sorted(REGISTRY.values(), key=lambda o: o.name)]
