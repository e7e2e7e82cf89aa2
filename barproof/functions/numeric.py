"""Number and day arithmetic as SQL expressions, following IEEE and banker's rules under ANSI mode."""


def ieee_divide(numerator: str, denominator: str) -> str:
    """Divide doubles with IEEE results for a zero divisor (signed infinity, or NaN for 0/0).

    ANSI division raises on zero and ``try_divide`` gives NULL, which would drop the value from
    later window frames. ``pow(0, -1)`` is a signed infinity without an error.
    """
    return (
        f"CASE WHEN {denominator} <> 0D THEN {numerator} / {denominator} "
        f"ELSE {numerator} * pow({denominator}, -1D) END"
    )


def nan_to_null(value: str) -> str:
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


def round_to_bigint(value: str) -> str:
    """Round half to even, then cast; a plain cast would truncate."""
    return f"bigint(rint({nan_to_null(value)}))"


def weekdays_before(day: str) -> str:
    """Count Monday-Friday days from a fixed Monday up to, not including, ``day``."""
    offset = f"datediff({day}, DATE '1970-01-05')"
    return f"(floor({offset} / 7) * 5 + least(pmod({offset}, 7), 5))"


def is_weekday(day: str) -> str:
    return f"weekday({day}) < 5"
