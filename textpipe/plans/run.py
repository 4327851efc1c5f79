"""All stages in one process, from the first or from the first that is out of date."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from textpipe.config import STAGES, PipelineConfig
from textpipe.operators import classify
from textpipe.plans import stages
from textpipe.sources import manifest
from textpipe.sources.manifest import Entries

logger = logging.getLogger(__name__)


class _Work:
    """What each stage does. Vectors and model pass from stage to stage in one process; in another
    they are loaded."""

    def __init__(self, spark: SparkSession, corpus: DataFrame | None, raw_path: str | None = None) -> None:
        self.spark, self.corpus, self.raw_path = spark, corpus, raw_path
        self.train_vectors = self.test_vectors = self.model = self.report = None

    def land(self, cfg: PipelineConfig) -> None:
        stages.land(self.corpus, cfg)

    def prepare(self, cfg: PipelineConfig) -> None:
        stages.prepare(self.spark, cfg, self.raw_path)

    def featurize(self, cfg: PipelineConfig) -> None:
        _, self.train_vectors, self.test_vectors = stages.featurize(self.spark, cfg)

    def train(self, cfg: PipelineConfig) -> None:
        vectors = self.train_vectors or stages.stored_vectors(self.spark, cfg, "train")
        self.model = stages.train(vectors, cfg)

    def evaluate(self, cfg: PipelineConfig) -> None:
        model = self.model or stages.load_model(self.spark, cfg)
        vectors = self.test_vectors or stages.stored_vectors(self.spark, cfg, "test")
        self.report = stages.evaluate(classify.predict(model, vectors), cfg)

    def inputs(self, stage: str) -> list | None:
        """The files that a stage reads from elsewhere, where it does and they are known."""
        if stage == "land" and self.corpus is not None:
            return manifest.listing(self.spark, self.corpus.inputFiles()) or [uuid.uuid4().hex]
        if stage == "prepare" and self.raw_path:
            return manifest.listing(self.spark, [self.raw_path])
        return None


def _do(work: _Work, cfg: PipelineConfig, stage: str, entries: Entries) -> Entries:
    """Run a stage into a version of its own; the entries with that version."""
    print_of = manifest.fingerprint(cfg, stage, entries, work.inputs(stage))
    version = uuid.uuid4().hex[:16]
    at = replace(cfg, versions={**manifest.versions_of(entries), stage: version})
    getattr(work, stage)(at)
    return {**entries, stage: {"version": version, "fingerprint": print_of}}


def _out_of_date(work: _Work, cfg: PipelineConfig, stage: str, entries: Entries) -> bool:
    held = entries.get(stage)
    return held is None or held["fingerprint"] != manifest.fingerprint(cfg, stage, entries, work.inputs(stage))


def _go(work: _Work, cfg: PipelineConfig, entries: Entries, due: Callable[[str, Entries], bool]) -> DataFrame:
    ran = []
    for stage in STAGES:
        if not due(stage, entries):
            continue
        try:
            entries = _do(work, cfg, stage, entries)
        except Exception:
            logger.exception("Run failed in stage %s", stage)
            raise
        ran.append(stage)
        if stage != STAGES[-1]:
            manifest.note(work.spark, cfg, entries)
    if ran or entries != manifest.current(work.spark, cfg):
        manifest.publish(work.spark, cfg, entries)
    logger.info("Run finished; stages run: %s", ", ".join(ran) or "none")
    if work.report is not None:
        return work.report
    return work.spark.read.parquet(manifest.published(work.spark, cfg).metrics_table_path)


def run(spark: SparkSession, corpus: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Land, prepare, featurize, train and evaluate; returns the report.

    ``corpus`` has ``text`` and ``label``. The first failing stage is logged and raised. Until the
    last stage has ended, the former run is the one that counts (``manifest.published``).
    """
    return _go(_Work(spark, corpus), cfg, {}, lambda stage, entries: True)


def resume(spark: SparkSession, cfg: PipelineConfig, corpus: DataFrame | None = None) -> DataFrame:
    """Run what is out of date, and what comes after it; returns the report.

    Goes on where a run has been stopped, if one has, else from the run that counts. A stage is out
    of date if its settings, the version of the stage before or, for a ``corpus``, its files have
    changed. Without a ``corpus`` the raw table is the one that has been landed.
    """
    work = _Work(spark, corpus)
    entries = manifest.pending(spark, cfg)
    entries = manifest.current(spark, cfg) if entries is None else entries

    def due(stage: str, held: Entries) -> bool:
        if stage == "land" and corpus is None:
            return False
        return _out_of_date(work, cfg, stage, held)

    return _go(work, cfg, entries, due)


def run_stage(
    spark: SparkSession, cfg: PipelineConfig, stage: str, corpus: DataFrame | None = None, raw_path: str | None = None
) -> DataFrame | None:
    """One stage from what counts; what it writes counts at once. Returns the report, if it writes one."""
    work = _Work(spark, corpus, raw_path)
    manifest.publish(spark, cfg, _do(work, cfg, stage, manifest.current(spark, cfg)))
    return work.report
