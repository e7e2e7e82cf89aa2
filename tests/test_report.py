import hashlib
from datetime import date
from pathlib import Path

import pytest
from tests.bars import bar, explanations_of, flags_of, prices_of, saved, weekdays

from barproof.operators.summaries import pass_rate
from barproof.plans.report import report_name, report_text, run_report, save_report, scope_hash
from barproof.sources.tables import append_table, replace_table, upsert_prices

DAYS = weekdays(date(2026, 1, 5), 4)


def document(spark, bars, flags=(), stored=(), **options):
    report = report_text(
        prices_of(spark, bars), flags_of(spark, list(flags)), explanations_of(spark, list(stored)), **options
    )
    return "".join(row.text + "\n" for row in report.collect())


def bars(*tickers, days=DAYS, base=10.0):
    return [bar(t, d, base + i) for t in tickers for i, d in enumerate(days)]


def test_whole_document(spark):
    flags = [
        ("BBB", DAYS[2], "OHLC_INCONSISTENCY", "high", "d2"),
        ("AAA", DAYS[3], "MISSING_DATES", "low", "gap"),
        ("AAA", DAYS[1], "STALE_PRICE", "medium", "d1"),
        ("AAA", DAYS[1], "OUTLIER_RETURN", "medium", "big move"),
        ("GONE", DAYS[1], "STALE_PRICE", "medium", "not in prices"),
    ]
    stored = [("AAA", DAYS[1], "OUTLIER_RETURN", "Earnings-driven move.")]
    assert document(spark, bars("BBB", "AAA", "CCC"), flags, stored) == f"""# Data Quality Report

## Summary

- Date range: {DAYS[0]} to {DAYS[3]}
- Tickers: AAA,
  BBB,
  CCC
- Total rows: 12

| Flag Type | Severity | Count |
|---|---|---|
| MISSING_DATES | low | 1 |
| OHLC_INCONSISTENCY | high | 1 |
| OUTLIER_RETURN | medium | 1 |
| STALE_PRICE | medium | 2 |

## AAA

### {DAYS[1]} — OUTLIER_RETURN (medium)
- Details: big move
- Explanation: Earnings-driven move.

### {DAYS[1]} — STALE_PRICE (medium)
- Details: d1
- Explanation: No explanation available

### {DAYS[3]} — MISSING_DATES (low)
- Details: gap
- Explanation: Excluded: known market holiday

## BBB

### {DAYS[2]} — OHLC_INCONSISTENCY (high)
- Details: d2
- Explanation: No explanation available

## CCC

No flags for this ticker.

## Result

66.7% of rows passed all validation checks.
"""


def test_no_flags(spark):
    text = document(spark, bars("AAA"))
    assert "No flags recorded.\n\n## AAA\n\nNo flags for this ticker.\n\n## Result\n\n100.0%" in text


def test_empty_prices(spark):
    assert document(spark, []) == """# Data Quality Report

## Summary

- Date range: None to None
- Tickers: 
- Total rows: 0

No flags recorded.


## Result

0.0% of rows passed all validation checks.
"""


def test_repeated_flags_stay_whole_entries(spark):
    same = ("AAA", DAYS[1], "STALE_PRICE", "medium", "d1")
    entry = f"### {DAYS[1]} — STALE_PRICE (medium)\n- Details: d1\n- Explanation: No explanation available\n\n"
    assert entry * 3 in document(spark, bars("AAA"), [same] * 3)


def test_two_explanations_give_two_entries(spark):
    flag = ("AAA", DAYS[1], "STALE_PRICE", "medium", "d1")
    stored = [("AAA", DAYS[1], "STALE_PRICE", text) for text in ("one", "two")]
    text = document(spark, bars("AAA"), [flag], stored)
    assert text.count("- Details: d1") == 2
    assert "- Explanation: one" in text and "- Explanation: two" in text


def test_flag_without_a_date_comes_last(spark):
    flags = [("AAA", None, "ODD", "low", "d"), ("AAA", DAYS[1], "STALE_PRICE", "medium", "d1")]
    text = document(spark, bars("AAA"), flags)
    assert text.index("STALE_PRICE (medium)") < text.index("### NaT — ODD (low)")


def test_many_tickers_are_listed_one_per_line(spark):
    assert "- Tickers: AAA,\n  BBB,\n  CCC\n- Total rows" in document(spark, bars("AAA", "BBB", "CCC"))


# --- pass rate ------------------------------------------------------------------------------


def test_pass_rate(spark):
    prices = prices_of(spark, bars("AAA"))
    one = ("AAA", DAYS[1], "STALE_PRICE", "medium", "d1")
    twice = [one, ("AAA", DAYS[1], "OUTLIER_RETURN", "medium", "d2")]
    assert tuple(pass_rate(prices, flags_of(spark, twice)).first()) == (4, 1, 75.0, 75.0)
    missing = [one, ("AAA", date(2026, 2, 2), "MISSING_DATES", "low", "d")]
    assert tuple(pass_rate(prices, flags_of(spark, missing)).first()) == (4, 2, 50.0, 75.0)
    undated = [("AAA", None, "ODD", "low", "d"), ("AAA", None, "ODD", "low", "e")]
    assert tuple(pass_rate(prices, flags_of(spark, undated)).first()) == (4, 1, 75.0, 100.0)
    assert tuple(pass_rate(prices.limit(0), flags_of(spark, [])).first()) == (0, 0, 0.0, 0.0)
    assert "75.0% of rows passed all validation checks." in document(spark, bars("AAA"), [one])


# --- names and files ------------------------------------------------------------------------


def hashed(spark, rows, **options):
    return scope_hash(prices_of(spark, rows), **options).first().scope_hash


def test_scope_hash_depends_on_tickers_and_dates_only(spark):
    base = hashed(spark, bars("AAA", "BBB"))
    assert hashed(spark, bars("BBB", "AAA", base=99.0)) == base
    others = {
        hashed(spark, bars("AAA")),
        hashed(spark, bars("AAA", "BBC")),
        hashed(spark, bars("AAA", "BBB", days=weekdays(date(2026, 2, 2), 4))),
    }
    assert len(others) == 3 and base not in others
    assert len(base) == 8


def test_scope_hash_value(spark):
    digests = sum(int(hashlib.sha256(t).hexdigest()[:15], 16) for t in (b"AAA", b"BBB"))
    basis = f"2,{digests}|{DAYS[0]}|{DAYS[3]}"
    assert hashed(spark, bars("BBB", "AAA")) == hashlib.sha256(basis.encode()).hexdigest()[:8]
    assert hashed(spark, []) == hashlib.sha256(b"0|None|None").hexdigest()[:8]


def test_report_name(spark):
    name = report_name(prices_of(spark, bars("AAA")), date(2026, 12, 25)).first().report_name
    assert name.startswith("market_data_quality_report_2026-12-25_") and name.endswith(".md")
    today = report_name(prices_of(spark, bars("AAA"))).first().report_name
    assert today.startswith(f"market_data_quality_report_{date.today().isoformat()}_")


def test_saved_report_reads_in_order(spark, tmp_path):
    rows = [bar(f"T{n:03}", d) for n in range(300) for d in DAYS[:2]]
    flags = [(f"T{n:03}", DAYS[n % 2], "STALE_PRICE", "medium", f"d{n}") for n in range(0, 300, 3)]
    report = report_text(prices_of(spark, rows), flags_of(spark, flags), explanations_of(spark, []))
    path = tmp_path / "nested" / "report.md"
    save_report(report, str(path))
    assert saved(path) == document(spark, rows, flags)
    save_report(report.limit(1), str(path))
    assert saved(path).startswith("# Data Quality Report\n")


def test_report_job(spark, tmp_path):
    prices, flags, stored = (str(tmp_path / n) for n in ("prices", "flags", "explanations"))
    upsert_prices(spark, prices_of(spark, bars("AAA")), prices)
    replace_table(spark, flags_of(spark, [("AAA", DAYS[1], "X", "low", "d1")]), flags)
    append_table(explanations_of(spark, [("AAA", DAYS[1], "X", "because")]), stored)
    path = run_report(spark, prices, flags, stored, str(tmp_path / "reports"), date(2026, 12, 25))
    assert Path(path).name.startswith("market_data_quality_report_2026-12-25_")
    assert "- Details: d1\n- Explanation: because\n" in saved(path)
