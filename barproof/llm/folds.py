"""Folds of documents by the checksum of their ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; an id of null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(doc_id) == 0
