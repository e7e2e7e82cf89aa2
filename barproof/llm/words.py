"""The white space of the text contracts, as column expressions and as byte tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Space, and tab to carriage return.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def text_of(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_white_space(text: Column) -> Column:
    return F.translate(text, WHITE_SPACE, "")


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space.

    A word ends where a character is followed by white space or the end. All white space becomes
    a blank, runs of blanks shrink by halves, and the blanks between the words are counted.
    """
    blanks = F.trim(F.translate(text, WHITE_SPACE, " " * len(WHITE_SPACE)))
    shrunk = F.regexp_replace(blanks, "  +", " ")
    gaps = F.length(shrunk) - F.length(F.translate(shrunk, " ", ""))
    return F.when(blanks == "", F.lit(0)).otherwise(gaps + 1).cast("long")
