"""Command line for the layer jobs: each layer as a job of its own, or all of them in order.

    spark-submit --py-files lakehist.zip jobs.py bronze --base gs://lake --raw gs://drop/customers.parquet
    spark-submit --py-files lakehist.zip jobs.py gold --base gs://lake \\
        --gold-sink bigquery --gold-option table=project.dataset.customers --gold-option writeMethod=direct

A job that fails, for a missing source or a broken key contract, exits non-zero; running it again
is safe.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence

from pyspark.sql import SparkSession

from lakehist.functions import AsOf
from lakehist.functions.clock import BUSINESS_ZONE
from lakehist.plans import Entity, Lake, run_all, run_bronze, run_gold, run_ranking, run_silver
from lakehist.sources import SinkSpec


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lakehist", description="Maintain and serve the history of a table")
    parser.add_argument("job", choices=["bronze", "silver", "gold", "all"], help="gold includes the ranking")
    parser.add_argument("--base", required=True, help="root of the layers, any Hadoop URI")
    parser.add_argument("--entity", default="lakehist.plans.customers:CUSTOMERS", metavar="MODULE:NAME")
    parser.add_argument("--raw", help="raw snapshot (default: the raw layer under --base)")
    parser.add_argument("--as-of", help="wall clock in --zone, 'YYYY-MM-DD[ HH:MM:SS]' (default: now)")
    parser.add_argument("--zone", default=BUSINESS_ZONE)
    parser.add_argument("--batch", type=int, help="batch to write or repeat (default: the next one)")
    parser.add_argument("--buckets", type=int, help="co-locate bronze and silver by key (default: as the last batch)")
    parser.add_argument("--keep", type=int, help="states of a layer to leave on storage (default: all)")
    parser.add_argument("--null-safe", action="store_true", help="a change from or to NULL counts on its own")
    parser.add_argument("--null-keys", choices=["raise", "keep"], default="raise")
    parser.add_argument("--skip-key-check", action="store_true")
    for target in ("gold", "ranking"):
        parser.add_argument(f"--{target}-sink", metavar="FORMAT", help=f"also publish {target} in this format")
        parser.add_argument(f"--{target}-path", metavar="PATH")
        parser.add_argument(f"--{target}-option", metavar="KEY=VALUE", action="append", default=[])
    return parser


def _sinks(args: argparse.Namespace, target: str) -> tuple[SinkSpec, ...]:
    format = getattr(args, f"{target}_sink")
    if not format:
        return ()
    options = dict(option.split("=", 1) for option in getattr(args, f"{target}_option"))
    return (SinkSpec(format, options, getattr(args, f"{target}_path")),)


def _entity(address: str) -> Entity:
    module, _, name = address.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    lake = Lake(
        base=args.base,
        entity=_entity(args.entity),
        raw_path=args.raw,
        zone=args.zone,
        buckets=args.buckets,
        null_safe=args.null_safe,
        null_keys=args.null_keys == "keep",
        keep=args.keep,
        check_keys=not args.skip_key_check,
        gold_sinks=_sinks(args, "gold"),
        ranking_sinks=_sinks(args, "ranking"),
    )
    as_of = AsOf.at(args.as_of, args.zone) if args.as_of else AsOf.now(args.zone)
    spark = spark or SparkSession.builder.appName(f"lakehist-{args.job}").getOrCreate()
    if args.job == "bronze":
        run_bronze(spark, lake, as_of, args.batch)
    elif args.job == "silver":
        run_silver(spark, lake, as_of, args.batch)
    elif args.job == "gold":
        run_ranking(spark, lake, as_of, run_gold(spark, lake, as_of, args.batch))
    else:
        run_all(spark, lake, as_of, args.batch)
