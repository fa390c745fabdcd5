"""Command line: cp, count, schema conv, config, features, license."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from .config import Config
from .errors import TideError

LICENSE = "tabletide is free software. It uses Apache Spark (Apache License 2.0), Apache Arrow (Apache License 2.0), pandas (BSD) and NumPy (BSD).\n"


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("tabletide", description="Moves tables and converts their schemas.")
    p.add_argument("--enable-unstable", action="store_true", help="allow drivers that may change")
    commands = p.add_subparsers(dest="command", required=True)

    def source(c: argparse.ArgumentParser) -> None:
        c.add_argument("--schema", help="locator of the schema to use")
        c.add_argument("--temporary", action="append", default=[], help="a place for temporary data")
        c.add_argument("--from-arg", action="append", default=[], help="an argument of the source's driver, as NAME=VALUE")
        c.add_argument("--from-format", help="csv or jsonl")
        c.add_argument("--where", help="a condition on rows")

    cp = commands.add_parser("cp", help="copy a table")
    cp.add_argument("source")
    cp.add_argument("destination")
    cp.add_argument("--if-exists", default="error", help="error, append, overwrite or upsert-on:KEY,...")
    source(cp)
    cp.add_argument("--to-arg", action="append", default=[], help="an argument of the destination's driver, as NAME=VALUE")
    cp.add_argument("-F", "--to-format", help="csv or jsonl")
    cp.add_argument("--stream-size", type=int, help="about how many bytes each file should have")
    cp.add_argument("-J", "--max-streams", type=int, help="how many streams to work on at a time")
    cp.add_argument("--display-output-locators", action="store_true", help="print what was written")
    count = commands.add_parser("count", help="count rows")
    count.add_argument("source")
    source(count)
    conv = commands.add_parser("schema", help="schemas").add_subparsers(dest="what", required=True).add_parser("conv", help="convert a schema")
    conv.add_argument("source")
    conv.add_argument("destination")
    conv.add_argument("--if-exists", default="error")
    conv.add_argument("--from-arg", action="append", default=[])
    conv.add_argument("--to-arg", action="append", default=[])
    config = commands.add_parser("config", help="change settings").add_subparsers(dest="what", required=True)
    for what in ("add", "rm"):
        c = config.add_parser(what)
        c.add_argument("key", choices=["temporary"])
        c.add_argument("value")
    commands.add_parser("features", help="what drivers can do").add_argument("driver", nargs="?")
    commands.add_parser("license", help="licences").add_argument("out", nargs="?")
    return p


def main(arguments: Sequence[str] | None = None, spark=None) -> int:
    a = _parser().parse_args(arguments)
    try:
        return _run(a, spark)
    except TideError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


def _run(a: argparse.Namespace, spark) -> int:
    from .sources import locators

    if a.command == "features":
        print(locators.describe(a.driver), end="")
        return 0
    if a.command == "license":
        if a.out:
            with open(a.out, "w", encoding="utf-8") as f:
                f.write(LICENSE)
        else:
            print(LICENSE, end="")
        return 0
    if a.command == "config":
        config = Config()
        (config.add_temporary if a.what == "add" else config.remove_temporary)(a.value)
        return 0
    from pyspark.sql import SparkSession

    from .plans import copy

    spark = spark or SparkSession.builder.appName("tabletide").getOrCreate()
    if a.command == "cp":
        written = copy.copy(
            spark, a.source, a.destination, if_exists=a.if_exists, schema=a.schema, where=a.where, from_format=a.from_format, to_format=a.to_format, from_args=a.from_arg, to_args=a.to_arg,
            stream_size=a.stream_size, max_streams=a.max_streams, temporary=[*a.temporary, *Config().temporary], unstable=a.enable_unstable,
        )
        if a.display_output_locators:
            for w in written:
                print(locators.hidden_password(w))
    elif a.command == "count":
        print(copy.count(spark, a.source, schema=a.schema, where=a.where, from_format=a.from_format, from_args=a.from_arg, unstable=a.enable_unstable))
    else:
        copy.convert_schema(spark, a.source, a.destination, if_exists=a.if_exists, unstable=a.enable_unstable)
    return 0


if __name__ == "__main__":
    sys.exit(main())
