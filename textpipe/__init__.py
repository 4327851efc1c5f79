"""Text classification on Spark: corpus scan, exact stratified split, TF-IDF,
multinomial logistic regression and a classification report."""

from textpipe.config import PipelineConfig
from textpipe.plans.run import run

__all__ = ["PipelineConfig", "run"]
