"""Multinomial logistic regression with an L2 penalty, and scoring."""

from __future__ import annotations

import logging
import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from textpipe.operators.vectorize import FEATURES

logger = logging.getLogger(__name__)
PREDICTION = "prediction"
_INDEX = "_label_index"
_PREDICTED_INDEX = "_predicted_index"


# Bytes of stored vectors for which one task iterates at most, and for which a core is worth it.
MOST_BYTES = 512 << 20
LEAST_BYTES = 4 << 20
# Partial gradients that one task adds up.
GRADIENTS = 64
# MB of a block of rows in the solver, each of which has a dense gradient of its own.
BLOCK_MB = 16.0


def train_classifier(
    vectors: DataFrame,
    label: str = "label",
    features: str = FEATURES,
    inverse_regularization: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-6,
) -> PipelineModel:
    """Fit the classifier and return it with the mapping back to the labels.

    The objective is the mean log loss plus ``|W|^2 / (2 C n)`` with a free intercept: hence
    ``regParam = 1 / (C n)``, no elastic net and no standardization. The labels are numbered
    densely in ascending order, since the solver makes a class of every integer up to the
    largest. ``vectors`` should be a stored table: it is read three times.
    """
    # Each iteration reads the solver's own blocks, which it caches in memory and, where these do
    # not fit, on the disks of the executors; what is lost is read from the table again.
    vectors = vectors.select(label, features)
    classes = vectors.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    labels = _check_classes([row[label] for row in classes])
    n_rows = sum(row.n for row in classes)
    index = F.array_position(F.lit(labels), F.col(label)) - 1
    # The number of classes as column metadata saves the solver a pass to find it.
    metadata = {"ml_attr": {"type": "nominal", "name": _INDEX, "num_vals": len(labels)}}
    numbered = vectors.select(features, index.cast("double").alias(_INDEX, metadata=metadata))
    partitions = _solver_partitions(vectors)
    model = LogisticRegression(
        featuresCol=features,
        labelCol=_INDEX,
        predictionCol=_PREDICTED_INDEX,
        family="auto",
        regParam=1.0 / (inverse_regularization * n_rows),
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        maxIter=max_iter,
        tol=tol,
        maxBlockSizeInMB=BLOCK_MB,
        aggregationDepth=max(2, math.ceil(math.log(partitions, GRADIENTS))),
    ).fit(numbered.coalesce(partitions))
    logger.info(
        "Trained on %d rows x %d features in %d iterations",
        n_rows, model.numFeatures, model.summary.totalIterations,
    )
    # Scores and probabilities are not asked for, so they are not computed.
    model = model.setRawPredictionCol("").setProbabilityCol("")
    return PipelineModel([model, _label_namer(labels, vectors.schema[label].dataType)])


def _check_classes(found: list) -> list:
    if not found:
        raise ValueError("Cannot train on an empty table")
    if None in found:
        raise ValueError("Cannot train with null labels")
    if len(found) < 2:
        raise ValueError("Cannot train with a single class")
    return sorted(found)


def _solver_partitions(vectors: DataFrame) -> int:
    """Partitions to iterate over, from the bytes of the stored vectors.

    Each iteration runs a task and returns a gradient for each, so many small splits are coalesced,
    which moves no data through a shuffle; but no task gets more than fits an executor.
    """
    n_bytes = int(vectors._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    wanted = max(1, math.ceil(n_bytes / MOST_BYTES), min(cores, math.ceil(n_bytes / LEAST_BYTES)))
    return min(wanted, max(1, vectors.rdd.getNumPartitions()))


def _label_namer(labels: list, label_type: DataType) -> SQLTransformer:
    """The stage that turns class numbers back into labels."""
    quoted = (str(value).replace("\\", "\\\\").replace("'", "\\'") for value in labels)
    listed = ", ".join(f"'{value}'" for value in quoted)
    return SQLTransformer(
        statement=f"SELECT * EXCEPT ({_PREDICTED_INDEX}), CAST(element_at(array({listed}), "
        f"CAST({_PREDICTED_INDEX} AS INT) + 1) AS {label_type.simpleString()}) "
        f"AS {PREDICTION} FROM __THIS__"
    )


def predict(model: PipelineModel, vectors: DataFrame) -> DataFrame:
    """Add ``prediction``, a label in the terms of the training table."""
    return model.transform(vectors)


def save_classifier(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)
