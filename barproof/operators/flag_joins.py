"""Joins between flags and the explanations already stored."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.schemas import FLAG_COLUMNS, FLAG_KEY


def with_explanations(
    flags: DataFrame, explanations: DataFrame, first_only: bool = False
) -> DataFrame:
    """Add the stored explanations to flags; a NULL date matches nothing.

    Explanations have no key, so a flag with several of them appears several times.
    ``first_only`` keeps one per key instead.
    """
    stored = explanations.select(*FLAG_KEY, "explanation")
    if first_only:
        stored = stored.groupBy(*FLAG_KEY).agg(F.min("explanation").alias("explanation"))
    return flags.select(*FLAG_COLUMNS).join(stored, FLAG_KEY, "left")


def unexplained_flags(flags: DataFrame, explanations: DataFrame) -> DataFrame:
    """Flags whose (ticker, date, flag_type) has no stored explanation."""
    explained = explanations.select(*FLAG_KEY).distinct()
    return flags.select(*FLAG_COLUMNS).join(explained, FLAG_KEY, "left_anti").select(*FLAG_COLUMNS)
