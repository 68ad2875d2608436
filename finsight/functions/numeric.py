"""Numeric publication helpers: ratios and averages are computed in DOUBLE and published
rounded, so that results do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PUBLISH_SCALE = 6


def to_double(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("double")


def pub(c: Column | str) -> Column:
    """Published double: cast to DOUBLE and round to PUBLISH_SCALE decimals."""
    return F.round(to_double(c), PUBLISH_SCALE)
