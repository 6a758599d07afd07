"""Catalog of the layers in many files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LayerIdentifier = str | int | None


def select_layer(catalog: DataFrame, identifier: LayerIdentifier) -> DataFrame:
    """Catalog rows of the named layer, the layer at an index, or the first layer of each file."""
    if isinstance(identifier, str):
        return catalog.filter(F.col("layer_name") == identifier)
    index = 0 if identifier is None else identifier
    if index < 0:
        raise ValueError(f"Layer index {index} is below 0.")
    return catalog.filter(F.col("layer_index") == index)


def feature_counts(catalog: DataFrame) -> DataFrame:
    """``(path, layer_name, feature_count)`` of every readable layer."""
    return catalog.filter(F.col("error").isNull()).select("path", "layer_name", "feature_count")


def skipped_files(catalog: DataFrame) -> DataFrame:
    """``(path, error)`` of the files a tolerant read passes over."""
    return catalog.filter(F.col("error").isNotNull()).select("path", "error")
