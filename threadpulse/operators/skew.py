"""Joins to unique parents that no hot or NULL key can unbalance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, how: str = "inner"
) -> DataFrame:
    """Join children to parents that are unique per ``parent_key``; ``how`` is inner or left_anti.

    Children under a hot key, or without one, are parted by adaptive execution, which can do so only where both
    sides of the join come straight from an exchange. Parents come from an aggregate, whose partitioning the join
    would take over; under a computed key they get an exchange of their own (two or three numbers a row).
    """
    keyed = parents.withColumn(parent_key, F.col(parent_key).bitwiseXOR(F.lit(0)))
    return children.join(keyed, F.expr(f"{child_key} = {parent_key}"), how)
