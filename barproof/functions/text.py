"""Flag details, prompt text and report wording as SQL expressions.

Each function takes and returns SQL text, to be handed to ``expr`` once: one parsed expression
instead of some hundred Python-to-JVM calls, and it still runs inside generated code.
"""

from collections.abc import Callable

from barproof.functions.numeric import ieee_divide

# Wording that has to equal the expected output character for character.
HYPOTHESES = (
    "a genuine market move, an unadjusted stock split or dividend, "
    "a data provider glitch, or a stale/duplicate data artifact"
)
PROMPT_OPENING = "A data quality check flagged the following issue in a daily OHLCV dataset:"
PROMPT_HISTORY = (
    "Here is the surrounding trading-day price/volume history for this ticker "
    "(roughly 10 trading days before and after the flagged date):"
)
PROMPT_CLOSING = (
    f"Briefly consider what's most likely ({HYPOTHESES}), then state your conclusion in "
    "2-3 sentences total. Do not address every hypothesis individually — just reach and justify "
    "your best explanation, in plain prose with no markdown, bold text, bullet points, or headers."
)
HOLIDAY_NOTE = "Excluded: known market holiday"
NO_EXPLANATION_NOTE = "No explanation available"
NO_FLAGS_NOTE = "No flags recorded."
NO_TICKER_FLAGS_NOTE = "No flags for this ticker."


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def joined(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def fixed(value: str, decimals: int) -> str:
    """Format a double with fixed decimals, rounding its exact binary value half to even."""
    return (
        f"CASE WHEN {value} IS NULL OR isnan({value}) THEN 'nan' "
        f"WHEN {value} = double('Infinity') THEN 'inf' "
        f"WHEN {value} = double('-Infinity') THEN '-inf' "
        f"ELSE format_number({value}, '0.{'0' * decimals}') END"
    )


def missing_date_details(day: str) -> str:
    return joined("'No price row found for expected trading day '", f"string({day})", "'.'")


def stale_price_details(close: str, length: str) -> str:
    return joined(
        "'close unchanged at '",
        fixed(close, 2),
        "' for '",
        f"string({length})",
        "' consecutive trading days'",
    )


def deviations(ret: str, mean: str, deviation: str) -> str:
    return ieee_divide(f"({ret} - {mean})", deviation)


def outlier_return_details(ret: str, mean: str, deviation: str, distance: str = "") -> str:
    """``distance``: a column that holds the deviations already."""
    distance = distance or deviations(ret, mean, deviation)
    return joined(
        "'daily return '",
        fixed(ret, 2),
        "'% vs trailing 30-day mean '",
        fixed(mean, 2),
        "'% (std '",
        fixed(deviation, 2),
        "'%) — '",
        fixed(distance, 1),
        "' std devs from mean'",
    )


def duplicate_row_details(occurrences: str) -> str:
    return joined(
        f"string({occurrences})", "' duplicate rows found for this ticker/date combination'"
    )


# The bar rules, as (left column, comparison, right column) of a violation.
BAR_RULES = [
    ("high", "<", "low"),
    ("high", "<", "open"),
    ("high", "<", "close"),
    ("low", ">", "open"),
    ("low", ">", "close"),
]


def breaks_bar_rule() -> str:
    """True if any rule is violated; a NULL price hides only the rules it takes part in."""
    return "(" + " OR ".join(" ".join(rule) for rule in BAR_RULES) + ")"


def bar_rule_details(shown: Callable[[str], str] = lambda price: fixed(price, 2)) -> str:
    """Every violated rule with its two prices; ``concat_ws`` skips the NULLs of the others."""
    texts = [
        f"CASE WHEN {left} {sign} {right} THEN "
        + joined(f"'{left} ('", shown(left), f"') {sign} {right} ('", shown(right), "')'")
        + " END"
        for left, sign, right in BAR_RULES
    ]
    return f"concat_ws('; ', {', '.join(texts)})"


def history_line() -> str:
    """One line of price history for a prompt, from the columns of a bar."""
    parts = ["string(date)", "' 00:00:00  open='", fixed("open", 2)]
    for name in ("high", "low", "close"):
        parts += [f"' {name}='", fixed(name, 2)]
    parts += ["' volume='", "coalesce(string(volume), 'NA')"]
    parts += ["' adj_close='", fixed("adj_close", 2)]
    return joined(*parts)


def prompt_text(history: str) -> str:
    """The whole prompt of one flag; ``history`` holds the bar lines, already in date order."""
    return joined(
        quoted(PROMPT_OPENING + "\n\nTicker: "),
        "ticker",
        quoted("\nDate: "),
        "coalesce(concat(string(date), ' 00:00:00'), 'NaT')",
        quoted("\nFlag type: "),
        "flag_type",
        quoted("\nSeverity: "),
        "severity",
        quoted("\nDescription: "),
        "details",
        quoted("\n\n" + PROMPT_HISTORY + "\n\n"),
        f"array_join({history}, '\n')",
        quoted("\n\n" + PROMPT_CLOSING),
    )


def report_entry() -> str:
    """The lines of one flag in the report."""
    return joined(
        "'### '",
        "coalesce(string(date), 'NaT')",
        "' — '",
        "flag_type",
        "' ('",
        "severity",
        quoted(")\n- Details: "),
        "details",
        quoted("\n- Explanation: "),
        "explanation",
        quoted("\n"),
    )
