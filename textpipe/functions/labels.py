"""Class labels as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from textpipe.config import LABEL_NAMES


def label_name(label: Column | str, names: Mapping[int, str] = LABEL_NAMES) -> Column:
    """Name of a label; a label without a name gives null."""
    label = F.col(label) if isinstance(label, str) else label
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), label.try_cast("int"))
