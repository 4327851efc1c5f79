"""Settings and zone paths of one run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# Names of the four topics.
LABEL_NAMES: Mapping[int, str] = MappingProxyType(
    {0: "World", 1: "Sports", 2: "Business", 3: "Sci/Tech"}
)


# The stages in their order, and the settings that what each writes depends on.
STAGES = ("land", "prepare", "featurize", "train", "evaluate")
STAGE_SETTINGS: Mapping[str, tuple[str, ...]] = MappingProxyType(
    {
        "land": ("raw_dir", "raw_name", "raw_format"),
        "prepare": (
            "raw_format", "raw_schema", "raw_multi_line", "min_raw_rows", "test_size", "seed",
            "processed_dir", "keyed_name", "numbered_name", "split_name",
        ),
        "featurize": (
            "max_features", "stop_words", "min_train_rows", "min_test_rows",
            "models_dir", "vectorizer_name", "vocabulary_name",
            "processed_dir", "term_counts_name", "counts_name",
        ),
        "train": ("inverse_regularization", "max_iter", "tol", "models_dir", "model_name", "vectors_name"),
        "evaluate": ("reports_dir", "metrics_name", "metrics_table_name"),
    }
)


@dataclass(frozen=True)
class PipelineConfig:
    """Where a run keeps its tables and how it is parametrised.

    ``base`` is any Hadoop URI (``hdfs://``, ``s3a://``, ``file:``); the writers create the
    directories, so building a config touches no file system. ``versions`` names the folder that
    the artifacts of a stage are in; those of a stage without one are in the folder of the zone.
    """

    base: str = "."
    # The folders of the four zones.
    raw_dir: str = "data/raw"
    processed_dir: str = "data/processed"
    models_dir: str = "models"
    reports_dir: str = "reports"

    raw_name: str = "corpus"
    raw_format: str = "parquet"
    # Whether cells of a CSV corpus may hold line breaks; without, its files are divided.
    raw_multi_line: bool = True
    # DDL of a JSON corpus; without, its files are read once more to find it.
    raw_schema: str | None = None
    keyed_name: str = "keyed.parquet"
    numbered_name: str = "numbered.parquet"
    split_name: str = "split.parquet"
    # Counts of the terms of the train side, and of those of each document.
    term_counts_name: str = "term_counts.parquet"
    counts_name: str = "counts.parquet"
    vectors_name: str = "vectors.parquet"
    vectorizer_name: str = "vectorizer"
    vocabulary_name: str = "vocabulary.parquet"
    model_name: str = "classifier"
    # Fixed value: the name of the text report.
    metrics_name: str = "metrics.txt"
    metrics_table_name: str = "metrics.parquet"
    runs_name: str = "runs.parquet"

    max_features: int = 5000
    # Whether a sketch chooses the terms to count; the vocabulary is the same.
    sketch_vocabulary: bool = False
    stop_words: str | tuple[str, ...] | None = "english"
    test_size: float = 0.2
    seed: int = 42
    inverse_regularization: float = 1.0
    max_iter: int = 1000
    tol: float = 1e-6

    min_raw_rows: int = 100
    min_train_rows: int = 10
    min_test_rows: int = 5

    label_names: Mapping[int, str] = field(default_factory=lambda: LABEL_NAMES)
    versions: Mapping[str, str] = field(default_factory=dict)

    def _path(self, *parts: str) -> str:
        return "/".join((self.base.rstrip("/") or "/", *parts))

    def _of(self, stage: str, *parts: str) -> str:
        *folder, name = parts
        version = self.versions.get(stage)
        return self._path(*folder, *([f"v-{version}"] if version else []), name)

    @property
    def raw_path(self) -> str:
        return self._of("land", self.raw_dir, f"{self.raw_name}.{self.raw_format}")

    @property
    def keyed_path(self) -> str:
        return self._of("prepare", self.processed_dir, self.keyed_name)

    @property
    def numbered_path(self) -> str:
        return self._of("prepare", self.processed_dir, self.numbered_name)

    @property
    def split_path(self) -> str:
        return self._of("prepare", self.processed_dir, self.split_name)

    @property
    def term_counts_path(self) -> str:
        return self._of("prepare", self.processed_dir, self.term_counts_name)

    @property
    def counts_path(self) -> str:
        return self._of("featurize", self.processed_dir, self.counts_name)

    @property
    def vectors_path(self) -> str:
        return self._of("train", self.processed_dir, self.vectors_name)

    @property
    def vectorizer_path(self) -> str:
        return self._of("featurize", self.models_dir, self.vectorizer_name)

    @property
    def vocabulary_path(self) -> str:
        return self._of("featurize", self.models_dir, self.vocabulary_name)

    @property
    def model_path(self) -> str:
        return self._of("train", self.models_dir, self.model_name)

    @property
    def metrics_path(self) -> str:
        return self._of("evaluate", self.reports_dir, self.metrics_name)

    @property
    def metrics_table_path(self) -> str:
        return self._of("evaluate", self.reports_dir, self.metrics_table_name)

    @property
    def runs_path(self) -> str:
        return self._path(self.reports_dir, self.runs_name)

    @property
    def zones(self) -> list[str]:
        return [self._path(d) for d in (self.raw_dir, self.processed_dir, self.models_dir, self.reports_dir)]
