"""Which version of each artifact counts, in a small file that is swapped as a whole.

A stage writes its artifacts into a folder of their own version. They count from the moment when the
manifest names that version: a file written beside the old one and renamed over it. Whoever reads
by the manifest therefore sees either the former version or the new one, complete, whenever a writer is
killed. Progress of a run that has not ended is kept in a second file of the same kind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import replace
from hashlib import sha256

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

from textpipe.config import STAGE_SETTINGS, STAGES, PipelineConfig

# Stage: its ``version``, and the ``fingerprint`` of what it was made from.
Entries = dict[str, dict[str, str]]
CURRENT, PENDING = "manifest.json", "pending.json"


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_json(spark: SparkSession, path: str) -> dict | None:
    at, system = _path(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def swap_json(spark: SparkSession, path: str, content: dict) -> None:
    """Put a file in the place of another, so that a reader finds the one or the other."""
    jvm = spark.sparkContext._jvm
    target, system = _path(spark, path)
    fresh, _ = _path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(fresh, True)
    try:
        stream.write(json.dumps(content, indent=1, sort_keys=True).encode())
        stream.hflush()
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(system.makeQualified(fresh), system.makeQualified(target), options)


def delete(spark: SparkSession, path: str) -> None:
    at, system = _path(spark, path)
    system.delete(at, True)


def listing(spark: SparkSession, files: list[str]) -> list[tuple[str, int, int]]:
    """Name, length and time of files, a folder at a time; of a folder, all files below it."""
    found: set[tuple[str, int, int]] = set()
    wanted = {_path(spark, f)[0].toUri().getPath() for f in files}
    todo = sorted({str(_path(spark, f)[0].getParent()) for f in files})
    while todo:
        at, system = _path(spark, todo.pop())
        for status in system.listStatus(at) if system.exists(at) else ():
            path = status.getPath().toUri().getPath()
            if not any(path == w or path.startswith(f"{w}/") for w in ({path} & wanted or wanted)):
                continue
            if status.isDirectory():
                todo.append(str(status.getPath()))
            else:
                found.add((path, status.getLen(), status.getModificationTime()))
    return sorted(found)


def fingerprint(cfg: PipelineConfig, stage: str, entries: Entries, inputs: list | None = None) -> str:
    """What a stage's artifacts follow from: its settings, and the version of the stage before or
    the listing of other files that it reads."""
    before = STAGES.index(stage) - 1
    made_from = inputs if inputs is not None or before < 0 else entries.get(STAGES[before], {}).get("version")
    settings = {name: getattr(cfg, name) for name in STAGE_SETTINGS[stage]}
    return sha256(json.dumps([stage, settings, made_from], default=str, sort_keys=True).encode()).hexdigest()


def _file(cfg: PipelineConfig, name: str) -> str:
    return f"{cfg.base.rstrip('/')}/{name}"


def current(spark: SparkSession, cfg: PipelineConfig) -> Entries:
    """The stages of the run that counts."""
    return (read_json(spark, _file(cfg, CURRENT)) or {}).get("stages", {})


def pending(spark: SparkSession, cfg: PipelineConfig) -> Entries | None:
    """The stages that a run which has not ended has finished, or None."""
    return (read_json(spark, _file(cfg, PENDING)) or {}).get("stages")


def versions_of(entries: Entries) -> Mapping[str, str]:
    return {stage: entry["version"] for stage, entry in entries.items()}


def published(spark: SparkSession, cfg: PipelineConfig) -> PipelineConfig:
    """The settings with the paths of the artifacts that count."""
    return replace(cfg, versions=versions_of(current(spark, cfg)))


def note(spark: SparkSession, cfg: PipelineConfig, entries: Entries) -> None:
    """Keep the progress of a run that has not ended."""
    swap_json(spark, _file(cfg, PENDING), {"stages": entries})


def publish(spark: SparkSession, cfg: PipelineConfig, entries: Entries) -> None:
    """Let these versions count. Those before them stay for who reads them; all others go, and with
    them what killed runs have left."""
    path = _file(cfg, CURRENT)
    former = current(spark, cfg)
    swap_json(spark, path, {"stages": entries, "former": former})
    delete(spark, _file(cfg, PENDING))
    kept = {f"v-{v}" for held in (entries, former) for v in versions_of(held).values()}
    for zone in cfg.zones:
        at, system = _path(spark, zone)
        for status in system.listStatus(at) if system.exists(at) else ():
            name = status.getPath().getName()
            if name.startswith("v-") and name not in kept:
                system.delete(status.getPath(), True)
