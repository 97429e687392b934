"""Columns worked out once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, *names: str) -> DataFrame:
    """Fix computed columns at this point of the plan.

    Catalyst moves filters below projections and copies the expressions they use; for
    parsers built in several steps that multiplies the work with every later filter. A
    one-row generator ends that: filters on its output stay above it.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))
