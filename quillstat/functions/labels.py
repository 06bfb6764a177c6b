"""Labels and scores of interactions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstat.fixed_values import ENGAGEMENT_POINTS, HIGH_VALUE_TYPES

PAID, FREE = "PAID COLLECT", "FREE COLLECT"


def paid_or_free(amount: Column) -> Column:
    """A collect with no amount is a free one."""
    return F.when(amount > 0, PAID).otherwise(FREE)


def value_tier(kind: Column, high: Sequence[str] = HIGH_VALUE_TYPES) -> Column:
    """``high_value`` or ``low_value``; a missing type is low."""
    return F.when(kind.isin(*high), "high_value").otherwise("low_value")


def engagement_points(kind: Column, points: Mapping[str, int] = ENGAGEMENT_POINTS) -> Column:
    score = F.lit(0)
    for name, value in points.items():
        score = F.when(kind == name, value).otherwise(score)
    return score
