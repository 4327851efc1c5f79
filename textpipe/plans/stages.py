"""The stages of a run. Each reads the tables and artifacts of the one before from its zone,
so a run can be resumed at any stage, in any process.

Writing a zone also ends the lineage: what was written is never computed again.
"""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textpipe.config import PipelineConfig
from textpipe.functions.labels import label_name
from textpipe.operators import classify, metrics
from textpipe.operators.split import RepeatedKeys, assign_split, find_cuts
from textpipe.operators.validate import (
    observe_text,
    require_text,
    validate_table,
    warn_about_text,
)
from textpipe.operators.terms import count_terms
from textpipe.operators.vectorize import COUNTS, Vectorizer, fit_counted, fit_vectorizer
from textpipe.sources import manifest
from textpipe.sources.corpus import land_corpus, read_split, read_table, scan_corpus, write_split

logger = logging.getLogger(__name__)
REQUIRED = ("text", "label")


def land(corpus: DataFrame, cfg: PipelineConfig) -> str:
    """Write the labelled corpus to the raw zone."""
    size = Observation("corpus size")
    counted = corpus.observe(size, F.count(F.lit(1)).alias("n_rows"))
    land_corpus(counted, cfg.raw_path, cfg.raw_format)
    logger.info(
        "Raw corpus with %d rows and %d columns written to %s",
        size.get["n_rows"], len(corpus.columns), cfg.raw_path,
    )
    return cfg.raw_path


def prepare(spark: SparkSession, cfg: PipelineConfig, raw_path: str | None = None) -> str:
    """Validate the raw table, split it and write train and test.

    Ids that repeat stay as they are. Where the cut would divide rows of one id, the rows are
    split by a number of their own, made once and stored.
    """
    raw = scan_corpus(
        spark, raw_path or cfg.raw_path, cfg.raw_format, cfg.raw_schema, cfg.raw_multi_line
    )
    validate_table(raw, REQUIRED, cfg.min_raw_rows)
    if cfg.raw_format != "parquet" or "doc_id" not in raw.columns:
        # The search for the cuts scans keys and labels a few times: give it a table of columns,
        # and ids that stay the same.
        raw = _store_keyed(raw, cfg.keyed_path, "doc_id")
    key = "doc_id"
    try:
        cuts = find_cuts(raw, test_size=cfg.test_size, seed=cfg.seed)
    except RepeatedKeys as error:
        logger.warning("%s: splitting by row", error)
        key = free_name(raw, "row_id")
        raw = _store_keyed(raw, cfg.numbered_path, key)
        cuts = find_cuts(raw, key, test_size=cfg.test_size, seed=cfg.seed)
    assigned = assign_split(raw, cuts, key, seed=cfg.seed)
    # The text check only warns, so it rides on the pass that writes the texts.
    observed, quality = observe_text(assigned.select("doc_id", "text", "label", "split"))
    # Terms that were counted for a former split in this place count no more.
    manifest.delete(spark, cfg.term_counts_path)
    write_split(observed, cfg.split_path)
    warn_about_text(quality.get)
    n_train = sum(c.n_train for c in cuts)
    logger.info(
        "Train with %d rows and test with %d rows written to %s",
        n_train, sum(c.n_rows for c in cuts) - n_train, cfg.split_path,
    )
    return cfg.split_path


def _store_keyed(raw: DataFrame, path: str, key: str) -> DataFrame:
    land_corpus(raw, path, key=key)
    return scan_corpus(raw.sparkSession, path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with ``_`` in front as long as a column has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def named_labels(split: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The table with the topic name of each label."""
    return split.withColumn("label_name", label_name("label", cfg.label_names))


def featurize(spark: SparkSession, cfg: PipelineConfig) -> tuple[Vectorizer, DataFrame, DataFrame]:
    """Fit the vectorizer on train, save it, and give the vectors of both sides.

    The texts are not cut again by later stages: counts of both sides are stored.
    """
    train = read_split(spark, cfg.split_path, "train")
    test = read_split(spark, cfg.split_path, "test")
    validate_table(train, REQUIRED, cfg.min_train_rows)
    validate_table(test, REQUIRED, cfg.min_test_rows)
    require_text(test)
    # Counting the rows of a stored table reads the footers of its files.
    n_train, n_test = train.count(), test.count()
    docs = read_table(spark, cfg.split_path)
    if cfg.sketch_vocabulary:
        vectorizer = fit_vectorizer(train, cfg.max_features, cfg.stop_words, n_docs=n_train, sketch=True)
        counted = vectorizer.count(docs).select("doc_id", "label", "split", COUNTS)
        counted.write.mode("overwrite").partitionBy("split").parquet(cfg.counts_path)
    else:
        require_text(train)
        vectorizer = fit_counted(
            docs, cfg.counts_path, cfg.max_features, cfg.stop_words,
            n_docs=n_train, term_counts=_term_counts(train, cfg),
        )
    vectorizer.save(cfg.vectorizer_path, cfg.vocabulary_path)
    n_terms = vectorizer.n_features
    logger.info(
        "Train matrix %d x %d, test matrix %d x %d; vectorizer saved to %s",
        n_train, n_terms, n_test, n_terms, cfg.vectorizer_path,
    )
    return vectorizer, *(_counted(spark, vectorizer, cfg, split) for split in ("train", "test"))


def _term_counts(train: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The stored counts of the terms of the train side, made once for a split: they depend on
    nothing else."""
    spark, path = train.sparkSession, cfg.term_counts_path
    # The mark of a finished write: a killed one is done again.
    if not _exists(spark, f"{path}/_SUCCESS"):
        count_terms(train).write.mode("overwrite").parquet(path)
    return read_table(spark, path)


def _counted(spark: SparkSession, vectorizer: Vectorizer, cfg: PipelineConfig, split: str) -> DataFrame:
    """Vectors of one side, from its stored counts."""
    counts = read_split(spark, cfg.counts_path, split)
    return vectorizer.weigh(counts).select("doc_id", "label", "features")


def stored_vectors(spark: SparkSession, cfg: PipelineConfig, split: str) -> DataFrame:
    """Vectors of one side, from the counts that ``featurize`` has stored and the saved vectorizer;
    from the texts where an older run has stored none."""
    if not _exists(spark, cfg.counts_path):
        return load_vectors(spark, cfg, split)
    for path in (cfg.vectorizer_path, cfg.vocabulary_path):
        require_artifact(spark, path)
    return _counted(spark, Vectorizer.load(spark, cfg.vectorizer_path, cfg.vocabulary_path), cfg, split)


def _vectors(vectorizer: Vectorizer, docs: DataFrame) -> DataFrame:
    return vectorizer.transform(docs).select("doc_id", "label", "features")


def require_artifact(spark: SparkSession, path: str) -> None:
    """Raise ``FileNotFoundError`` where a saved stage or table is missing."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"File not found: {path}")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def load_vectors(spark: SparkSession, cfg: PipelineConfig, split: str) -> DataFrame:
    """Vectors of one side, from the stored split and the saved vectorizer."""
    docs = read_split(spark, cfg.split_path, split)
    for path in (cfg.vectorizer_path, cfg.vocabulary_path):
        require_artifact(spark, path)
    require_text(docs)
    return _vectors(Vectorizer.load(spark, cfg.vectorizer_path, cfg.vocabulary_path), docs)


def train(vectors: DataFrame, cfg: PipelineConfig) -> PipelineModel:
    """Train the classifier on vectors and save it.

    The vectors are written to the processed zone first: the solver reads them more than once, and
    a lost executor then costs a few files read again, not texts cut again.
    """
    # Stored counts are few files; the solver's tasks get equal shares of these.
    files = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    vectors.repartition(files).write.mode("overwrite").parquet(cfg.vectors_path)
    stored = read_table(vectors.sparkSession, cfg.vectors_path)
    model = classify.train_classifier(
        stored,
        inverse_regularization=cfg.inverse_regularization,
        max_iter=cfg.max_iter,
        tol=cfg.tol,
    )
    classify.save_classifier(model, cfg.model_path)
    logger.info("Classifier saved to %s", cfg.model_path)
    return model


def evaluate(predictions: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Write the metrics table and text of any table with ``label`` and ``prediction``.

    Returns the stored report, so reading it does not score the test side again.
    """
    report = metrics.class_report(metrics.confusion_counts(predictions))
    report.coalesce(1).write.mode("overwrite").parquet(cfg.metrics_table_path)
    stored = predictions.sparkSession.read.parquet(cfg.metrics_table_path)
    metrics.write_metrics_text(stored, cfg.metrics_path)
    lines = metrics.metrics_lines(stored)
    logger.info("Metrics written to %s:\n%s", cfg.metrics_path, "\n".join(lines))
    return stored


def load_model(spark: SparkSession, cfg: PipelineConfig) -> PipelineModel:
    """The saved classifier."""
    require_artifact(spark, cfg.model_path)
    return classify.load_classifier(cfg.model_path)


def score(spark: SparkSession, cfg: PipelineConfig, split: str = "test") -> DataFrame:
    """Predictions for one side, from saved artifacts alone."""
    model = load_model(spark, cfg)
    return classify.predict(model, load_vectors(spark, cfg, split)).drop("features")


def summarize(spark: SparkSession, report: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Append one row about the finished run to the table of runs and return that row."""
    row = report.filter(F.col("row_name") == metrics.ACCURACY).select(
        F.lit("success").alias("status"),
        F.col("f1_score").alias("accuracy"),
        F.lit(cfg.metrics_path).alias("metrics_path"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    done = spark.createDataFrame(row.collect(), row.schema)
    done.write.mode("append").parquet(cfg.runs_path)
    return done
