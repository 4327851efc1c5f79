"""Run the whole pipeline or one stage: ``spark-submit`` or ``python -m textpipe``."""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from textpipe.config import STAGES, PipelineConfig
from textpipe.operators.metrics import metrics_lines
from textpipe.plans import stages
from textpipe.plans.run import resume, run, run_stage
from textpipe.sources.corpus import scan_corpus
from textpipe.sources.manifest import published

COMMANDS = ("run", "resume", *STAGES, "score")


def read_settings(base: str, path: str | None, pairs: list[str]) -> PipelineConfig:
    """Settings from a JSON file and from ``NAME=VALUE`` pairs, which come after it."""
    found: dict = {}
    if path:
        with open(path, encoding="utf-8") as file:
            found.update(json.load(file))
    for pair in pairs:
        name, given, value = pair.partition("=")
        if not given:
            raise ValueError(f"Not NAME=VALUE: {pair}")
        try:
            found[name] = json.loads(value)
        except json.JSONDecodeError:
            found[name] = value
    known = {field.name for field in fields(PipelineConfig)} - {"base", "versions"}
    if unknown := sorted(found.keys() - known):
        raise ValueError(f"Unknown settings: {', '.join(unknown)}")
    if isinstance(found.get("stop_words"), list):
        found["stop_words"] = tuple(found["stop_words"])
    if "label_names" in found:
        found["label_names"] = {int(label): name for label, name in found["label_names"].items()}
    return PipelineConfig(base=base, **found)


def _corpus(spark: SparkSession, args: argparse.Namespace, cfg: PipelineConfig) -> DataFrame:
    return scan_corpus(spark, args.corpus, args.format, cfg.raw_schema, cfg.raw_multi_line)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="textpipe", description=__doc__)
    parser.add_argument("stage", choices=COMMANDS)
    parser.add_argument("--base", required=True, help="folder or URI of the zones")
    parser.add_argument("--corpus", help="labelled corpus, for run, land and resume")
    parser.add_argument("--format", default="parquet", help="format of the corpus files")
    parser.add_argument("--raw", help="raw table for prepare, instead of the one of the raw zone")
    parser.add_argument("--out", help="table of predictions that score writes")
    parser.add_argument("--split", default="test", help="side that score predicts")
    parser.add_argument("--settings", help="JSON file with settings of the run")
    parser.add_argument(
        "--set",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="one setting, as JSON or as a plain word; names are those of PipelineConfig",
    )
    args = parser.parse_args(argv)
    if args.stage in ("run", "land") and not args.corpus:
        parser.error(f"{args.stage} needs --corpus")
    if args.stage == "score" and not args.out:
        parser.error("score needs --out")

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    try:
        cfg = read_settings(args.base, args.settings, args.set)
    except ValueError as error:
        parser.error(str(error))
    spark = SparkSession.builder.appName("textpipe").getOrCreate()
    report = None
    corpus = _corpus(spark, args, cfg) if args.corpus else None
    if args.stage == "run":
        report = run(spark, corpus, cfg)
    elif args.stage == "resume":
        report = resume(spark, cfg, corpus)
    elif args.stage == "score":
        stages.score(spark, published(spark, cfg), args.split).write.mode("errorifexists").parquet(args.out)
    else:
        report = run_stage(spark, cfg, args.stage, corpus, args.raw)
    if report is not None:
        stages.summarize(spark, report, published(spark, cfg))
        print("\n".join(metrics_lines(report)))


if __name__ == "__main__":
    main()
