"""Vector file formats, read inside Spark tasks or by Spark's own readers."""
