"""Command line: list the operations, try one on JSON lines, or run a recipe over a parquet table.

    python -m grainmill list-ops
    python -m grainmill test-op keep_where --rows rows.jsonl --option condition="n > 1"
    python -m grainmill run recipe.yaml [overlay.yaml ...] --input documents.parquet --set steps=[]
"""

from __future__ import annotations

import argparse
import json

from grainmill.operators import recipe


def options_of(pairs: list[str]) -> dict:
    return recipe.overridden({}, pairs)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="grainmill", description=__doc__.split("\n")[0])
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list-ops")
    test = commands.add_parser("test-op")
    test.add_argument("name")
    test.add_argument("--rows", required=True)
    test.add_argument("--option", action="append", default=[])
    run = commands.add_parser("run")
    run.add_argument("recipes", nargs="+")
    run.add_argument("--input", required=True)
    run.add_argument("--set", dest="settings", action="append", default=[])
    args = parser.parse_args(argv)
    if args.command == "list-ops":
        for name, stage, about in recipe.list_ops():
            print(f"{name:28} {stage:10} {about}")
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    if args.command == "test-op":
        out = spark.read.json(args.rows).transform(recipe.REGISTRY[args.name].run, **options_of(args.option))
        for row in out.toLocalIterator():
            print(json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))
        return 0
    out = recipe.load(args.recipes, args.settings)(spark.read.parquet(args.input))
    print(f"{out.count()} rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
