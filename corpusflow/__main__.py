"""Command line: ``python -m corpusflow <command>``, or the same through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusflow.plans.build import corpus_report, create_subset, tokenize_corpus, train_tokenizer
from corpusflow.sources.config import CorpusConfig, TokenizerConfig


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusflow", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    report = commands.add_parser("report", help="rows per split before and after the length filter")
    report.add_argument("--config", required=True, help="corpus config")
    report.add_argument("--min-length", type=int, default=10)
    train = commands.add_parser("train-tokenizer", help="learn and store a vocabulary")
    train.add_argument("--config", required=True, help="tokenizer config")
    tokenize = commands.add_parser("tokenize", help="encode a corpus into token files")
    tokenize.add_argument("--config", required=True, help="tokenizer config")
    tokenize.add_argument("--seed", type=int, default=42, help="used when there is no validation split")
    subset = commands.add_parser("subset", help="copy the first tokens of each split")
    subset.add_argument("--source", required=True)
    subset.add_argument("--target", required=True)
    subset.add_argument("--train-tokens", type=int, required=True)
    subset.add_argument("--val-tokens", type=int, required=True)
    subset.add_argument("--dtype", choices=["uint16", "uint32"], default="uint16")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"corpusflow {args.command}").getOrCreate()
    if args.command == "report":
        corpus_report(spark, CorpusConfig.from_file(args.config), args.min_length).show(truncate=False)
    elif args.command == "train-tokenizer":
        train_tokenizer(spark, TokenizerConfig.from_file(args.config)).report(spark).show(truncate=False)
    elif args.command == "tokenize":
        stream = tokenize_corpus(spark, TokenizerConfig.from_file(args.config), args.seed)
        print(", ".join(f"{split}: {count:,} tokens" for split, count in sorted(stream.totals.items())))
    else:
        limits = {"train": args.train_tokens, "validation": args.val_tokens}
        create_subset(spark, args.source, args.target, limits, args.dtype)


if __name__ == "__main__":
    main()
