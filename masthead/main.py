"""Command line of the two jobs, for spark-submit.

    spark-submit --py-files masthead.zip masthead/main.py generate \\
        --articles <folder> --out <folder> --model my_models:factory [--batch-size N]

``--model`` names a function without arguments that builds the model on the workers.
"""

from __future__ import annotations

import argparse
import time
from importlib import import_module

from pyspark.sql import SparkSession

from masthead.functions.payload import SNIPPET_CHARS
from masthead.operators.inference import CHARS_PER_TASK, ModelRunner
from masthead.plans.jobs import Run, run_audit, run_generation
from masthead.sources.articles import read_articles
from masthead.sources.store import is_store, read_store
from masthead.sources.templates import load_templates


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["generate", "audit"])
    parser.add_argument("--articles", required=True, help="folder of the stored article table")
    parser.add_argument("--out", required=True, help="new folder for decisions and rejections")
    parser.add_argument("--model", required=True, help="module:function that builds the model")
    parser.add_argument("--templates", help="folder with hook.txt, safe.txt and critic.txt")
    parser.add_argument("--as-of", type=int, help="epoch seconds the windows end at; default now")
    parser.add_argument("--batch-size", type=int, help="at most this many articles, the newest; default all of the window")
    parser.add_argument("--shard", type=int)
    parser.add_argument("--num-shards", type=int, default=1)
    parser.add_argument("--all-shards", action="store_true", help="the batches of all shards in one run")
    parser.add_argument("--model-partitions", type=int, help="partitions of every model call")
    parser.add_argument("--rows-per-task", type=int, help="rows of a model call per task; beats the former")
    parser.add_argument("--chars-per-task", type=int, default=CHARS_PER_TASK, help="characters of prompts per task, unless one of the former is given")
    parser.add_argument("--prompts-per-call", type=int, default=64)
    parser.add_argument("--snippet-chars", type=int, default=SNIPPET_CHARS, help="characters of an article in a prompt; 0: all")
    parser.add_argument("--in-place", action="store_true", help="write the decisions into the article table")
    args = parser.parse_args(argv)
    if args.all_shards and args.shard is not None:
        parser.error("--shard and --all-shards exclude each other")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> Run:
    module, function = args.model.split(":")
    factory = getattr(import_module(module), function)
    job = run_generation if args.job == "generate" else run_audit
    versioned = is_store(spark, args.articles)
    if args.in_place and args.shard is not None and not versioned:
        raise ValueError("a table without versions is replaced day by day, so runs of several shards would undo each other")
    return job(
        spark,
        read_store(spark, args.articles) if versioned else read_articles(spark, args.articles),
        ModelRunner(factory, args.prompts_per_call, args.model_partitions, args.rows_per_task, args.chars_per_task),
        load_templates(spark, args.templates),
        args.out,
        as_of=int(time.time()) if args.as_of is None else args.as_of,
        limit=args.batch_size,
        shards=args.num_shards,
        number=args.shard,
        store=args.articles if args.in_place else None,
        snippet_chars=args.snippet_chars or None,
        all_shards=args.all_shards,
    )


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName(f"masthead-{args.job}").getOrCreate()
    run(spark, args).summary.show()
    spark.stop()


if __name__ == "__main__":
    main()
