"""Vector files as Spark DataFrames."""

from featureframe.reader import describe_layers, read_vector_files
from featureframe.types import OGR_TO_SPARK, ConcurrencyStrategy

__all__ = ["OGR_TO_SPARK", "ConcurrencyStrategy", "describe_layers", "read_vector_files"]
