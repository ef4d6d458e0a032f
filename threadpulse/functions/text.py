"""Text expressions for raw comment lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def blank_to_null(field: Column) -> Column:
    """NULL for a field without any text."""
    return F.when(F.trim(field) != "", field)


def is_integer(field: Column, as_type: str = "int") -> Column:
    """True only for an optionally signed run of digits that fits ``as_type``.

    The cast alone is too lenient: it trims blanks and truncates decimals.
    """
    return F.coalesce(field.rlike(r"^[+-]?[0-9]+\z") & field.try_cast(as_type).isNotNull(), F.lit(False))

