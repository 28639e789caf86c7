"""Range tests and range labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def inside(value: Column, low: float, high: float) -> Column:
    """Closed-range test that is false, not NULL, for a missing value."""
    return F.coalesce(value.between(low, high), F.lit(False))


def step_label(value: Column, steps: Sequence[tuple[str, float]], beyond: str) -> Column:
    """Label of the first step whose upper bound lies above ``value``.

    Missing and NaN values lie under no bound and get the ``beyond`` label.
    """
    under = [F.when(value < F.lit(bound), F.lit(label)) for label, bound in steps]
    return F.coalesce(*under, F.lit(beyond))
