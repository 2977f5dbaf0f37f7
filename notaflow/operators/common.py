"""Plan-shape helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame) -> DataFrame:
    """Evaluate the projected columns once before filtering on them.

    Catalyst pushes a filter below the projection that computes its columns,
    substituting the expressions; expensive ones (document lookups, date and
    number parsing) then run twice, in the filter and in the projection.
    Predicates are not pushed through a Generate, so a one-element
    ``explode`` keeps the projection below and the filter above.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("__row")).select("__row.*")
