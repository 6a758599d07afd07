"""Boxes to read by, and which geometries meet them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from featureframe.functions.wkb import wkb_bounds


class Box(NamedTuple):
    """A box in the coordinates of the layer; its edges belong to it."""

    min_x: float
    min_y: float
    max_x: float
    max_y: float

    def meets(self, corners: np.ndarray) -> np.ndarray:
        """Whether each ``minx, maxx, miny, maxy`` has a point in common; corners that are no numbers have none."""
        min_x, max_x, min_y, max_y = corners.T
        return (min_x <= self.max_x) & (max_x >= self.min_x) & (min_y <= self.max_y) & (max_y >= self.min_y)

    def meets_wkb(self, geometry: Column) -> Column:
        """As :meth:`meets` for a column of well-known binary; null counts as not."""
        # one element of the bounds at a time, so the column is computed once
        inside = F.transform(
            F.array(wkb_bounds(geometry)),
            lambda own: (own[0] <= self.max_x) & (own[1] >= self.min_x) & (own[2] <= self.max_y) & (own[3] >= self.min_y),
        )
        return F.coalesce(inside[0], F.lit(False))


def box_of(values: Sequence[float] | None) -> Box | None:
    """``(min_x, min_y, max_x, max_y)`` as a box."""
    if values is None:
        return None
    found = Box(*map(float, values))
    if any(map(math.isnan, found)) or found.min_x > found.max_x or found.min_y > found.max_y:
        raise ValueError(f"{tuple(values)} is no box (min_x, min_y, max_x, max_y).")
    return found
