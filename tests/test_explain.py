from datetime import date

import pytest
from tests.bars import bar, explanations_of, flags_of, prices_of, weekdays

import comparison_sql as sql
from barproof.operators.flag_joins import unexplained_flags, with_explanations
from barproof.operators.price_window import price_window
from barproof.plans import explain as explain_plan
from barproof.plans.explain import RESULTS, explain, explain_counts, failures_path, prompts, run_explanations
from barproof.schemas import EXPLANATIONS
from barproof.sources.tables import append_table, exists, read_table, replace_table, upsert_prices
from tests.test_checks import expected, got, random_bars

DAYS = weekdays(date(2026, 1, 5), 30)


def series(ticker, base, days=DAYS):
    return [bar(ticker, d, base + i, volume=1000 + i) for i, d in enumerate(days)]


def flag(ticker, day, flag_type, severity="medium", details="d"):
    return (ticker, day, flag_type, severity, details)


# --- flags and explanations -----------------------------------------------------------------


def test_explained_flags_are_left_out(spark):
    flags = flags_of(
        spark,
        [
            flag("AAA", DAYS[0], "MISSING_DATES"),
            flag("AAA", DAYS[1], "STALE_PRICE"),
            flag("BBB", DAYS[2], "DUPLICATE_ROW"),
        ],
    )
    stored = explanations_of(spark, [("AAA", DAYS[0], "MISSING_DATES", "seen")])
    found = {(r.ticker, r.flag_type) for r in unexplained_flags(flags, stored).collect()}
    assert found == {("AAA", "STALE_PRICE"), ("BBB", "DUPLICATE_ROW")}
    assert unexplained_flags(flags, explanations_of(spark, [])).count() == 3


def test_null_dates_never_match(spark):
    flags = flags_of(spark, [flag("AAA", None, "X")])
    stored = explanations_of(spark, [("AAA", None, "X", "text")])
    assert unexplained_flags(flags, stored).count() == 1
    assert with_explanations(flags, stored).first().explanation is None


def test_several_explanations_fan_out(spark):
    flags = flags_of(spark, [flag("AAA", DAYS[0], "X"), flag("AAA", DAYS[0], "X", details="e")])
    stored = explanations_of(spark, [("AAA", DAYS[0], "X", "two"), ("AAA", DAYS[0], "X", "one")])
    assert with_explanations(flags, stored).count() == 4
    assert unexplained_flags(flags, stored).count() == 0
    single = with_explanations(flags, stored, first_only=True)
    assert [r.explanation for r in single.collect()] == ["one", "one"]


# --- price windows --------------------------------------------------------------------------


@pytest.mark.parametrize("keyed", [True, False])
def test_price_window(spark, keyed):
    prices = prices_of(spark, series("AAA", 10.0) + series("BBB", 200.0))
    targets = flags_of(spark, [flag("AAA", DAYS[15], "X"), flag("AAA", DAYS[15], "Y")])
    window = price_window(prices, targets, keyed=keyed).orderBy("date").collect()
    assert [r.date for r in window] == DAYS[5:26]
    assert {r.ticker for r in window} == {"AAA"} and all(r.close < 100 for r in window)
    assert {r.target_date for r in window} == {DAYS[15]}
    assert price_window(prices, targets, span=3, keyed=keyed).count() == 7


@pytest.mark.parametrize("keyed", [True, False])
def test_price_window_at_the_edges_and_without_a_bar(spark, keyed):
    prices = prices_of(spark, series("AAA", 10.0))
    targets = flags_of(
        spark,
        [
            flag("AAA", DAYS[0], "X"),
            flag("AAA", DAYS[29], "X"),
            flag("AAA", date(2026, 1, 10), "X"),
            flag("ZZZ", DAYS[3], "X"),
            flag("AAA", None, "X"),
        ],
    )
    window = price_window(prices, targets, keyed=keyed)
    counts = {r.target_date: r["count"] for r in window.groupBy("target_date").count().collect()}
    assert counts == {DAYS[0]: 11, DAYS[29]: 11}


@pytest.mark.parametrize("repeats, max_rows", [(0, 10**6), (0.3, 10**6), (0.3, 12), (0.3, 40)])
def test_price_window_equals_sql(spark, repeats, max_rows):
    bars = random_bars(max_rows, 4, 50, repeats)
    prices = prices_of(spark, bars)
    targets = prices.where("dayofmonth(date) % 4 = 1")
    window = price_window(prices, targets, span=4, max_rows=max_rows)
    query = f""", targets AS (SELECT * FROM bars WHERE day(date) % 4 = 1),
        {sql.price_window('targets', 4)} SELECT * FROM windows"""
    assert got(window) == expected(bars, query)
    if not repeats:
        assert got(price_window(prices, targets, span=4, keyed=True)) == got(window)


# --- prompts --------------------------------------------------------------------------------


def test_prompt(spark):
    bars = [
        bar("AAA", DAYS[0], 10.005, volume=None),
        bar("AAA", DAYS[1], 2.675, open=None, volume=12345678901),
    ]
    flags = flags_of(spark, [flag("AAA", DAYS[1], "STALE_PRICE", "medium", "it's flat")])
    prompt = prompts(prices_of(spark, bars), flags).first().prompt
    lines = prompt.split("\n")
    assert lines[:8] == [
        "A data quality check flagged the following issue in a daily OHLCV dataset:",
        "",
        "Ticker: AAA",
        "Date: 2026-01-06 00:00:00",
        "Flag type: STALE_PRICE",
        "Severity: medium",
        "Description: it's flat",
        "",
    ]
    assert lines[10:12] == [
        "2026-01-05 00:00:00  open=10.01 high=11.01 low=9.01 close=10.01 volume=NA adj_close=10.01",
        "2026-01-06 00:00:00  open=nan high=3.67 low=1.67 close=2.67 volume=12345678901 adj_close=2.67",
    ]
    assert "what's most likely (a genuine market move," in lines[13]
    assert len(lines) == 14


def test_prompt_without_history(spark):
    prices = prices_of(spark, series("AAA", 10.0))
    flags = flags_of(
        spark, [flag("AAA", date(2026, 1, 10), "MISSING_DATES"), flag("AAA", None, "ODD")]
    )
    found = {r.flag_type: r.prompt for r in prompts(prices, flags).collect()}
    assert "flagged date):\n\n\n\nBriefly" in found["MISSING_DATES"]
    assert "Date: NaT\n" in found["ODD"]


def test_prompts_refuse_repeated_days(spark):
    prices = prices_of(spark, series("AAA", 10.0) + [bar("AAA", DAYS[15], 99.0)])
    flags = flags_of(spark, [flag("AAA", DAYS[15], "X")])
    with pytest.raises(Exception, match="Repeated day in the bars of AAA"):
        prompts(prices, flags).collect()


# --- batches --------------------------------------------------------------------------------


@pytest.fixture
def paths(spark, tmp_path):
    prices, flags, stored = (str(tmp_path / n) for n in ("prices", "flags", "explanations"))
    upsert_prices(spark, prices_of(spark, series("AAA", 10.0)), prices)
    rows = [flag("AAA", DAYS[10], "STALE_PRICE"), flag("AAA", DAYS[15], "OUTLIER_RETURN")]
    replace_table(spark, flags_of(spark, rows), flags)
    return prices, flags, stored


def noting(folder):
    """A stub that leaves one file per call, so that calls can be counted across processes."""

    def call(prompt):
        import uuid

        (folder / uuid.uuid4().hex).write_text(prompt)
        return f"{prompt.count('adj_close=')} bars"

    return call


def test_batch_skips_explained_and_calls_once_per_new_flag(spark, paths, tmp_path):
    append_table(explanations_of(spark, [("AAA", DAYS[10], "STALE_PRICE", "before")]), paths[2])
    calls = tmp_path / "calls"
    calls.mkdir()
    counts = run_explanations(spark, *paths, noting(calls))
    assert counts == {"newly_explained": 1, "already_cached": 1, "failed": 0}
    assert len(list(calls.iterdir())) == 1
    stored = read_table(spark, paths[2], EXPLANATIONS).orderBy("date").collect()
    assert [tuple(r) for r in stored] == [
        ("AAA", DAYS[10], "STALE_PRICE", "before"),
        ("AAA", DAYS[15], "OUTLIER_RETURN", "21 bars"),
    ]
    again = run_explanations(spark, *paths, noting(calls))
    assert again == {"newly_explained": 0, "already_cached": 2, "failed": 0}
    assert len(list(calls.iterdir())) == 1


def test_failures_do_not_stop_the_batch_and_are_retried(spark, paths):
    def fail(prompt):
        raise RuntimeError("no answer")

    counts = run_explanations(spark, *paths, fail)
    assert counts == {"newly_explained": 0, "already_cached": 0, "failed": 2}
    assert not exists(spark, paths[2])
    reasons = read_table(spark, failures_path(paths[2]), RESULTS).collect()
    assert [r.error for r in reasons] == ["RuntimeError: no answer"] * 2

    def fail_sometimes(prompt):
        if "STALE_PRICE" in prompt:
            raise ValueError("odd")
        return "fine"

    counts = run_explanations(spark, *paths, fail_sometimes)
    assert counts == {"newly_explained": 1, "already_cached": 0, "failed": 1}
    counts = run_explanations(spark, *paths, lambda prompt: "late")
    assert counts == {"newly_explained": 1, "already_cached": 1, "failed": 0}


def test_answers_that_are_no_text_are_failures(spark, paths):
    for answer in (None, "  ", 7):
        counts = run_explanations(spark, *paths, lambda prompt, answer=answer: answer)
        assert counts == {"newly_explained": 0, "already_cached": 0, "failed": 2}
        assert all(r.error for r in read_table(spark, failures_path(paths[2]), RESULTS).collect())


def test_answers_of_finished_rounds_stay(spark, paths, tmp_path, monkeypatch):
    monkeypatch.setattr(explain_plan, "ROUND", 1)
    stores = iter(range(3))
    real = explain_plan.append_table

    def stopping(*args):
        if next(stores) == 1:
            raise OSError("stopped")
        return real(*args)

    monkeypatch.setattr(explain_plan, "append_table", stopping)
    with pytest.raises(OSError, match="stopped"):
        run_explanations(spark, *paths, lambda prompt: "text")
    monkeypatch.setattr(explain_plan, "append_table", real)
    again = run_explanations(spark, *paths, lambda prompt: "text")
    assert again == {"newly_explained": 1, "already_cached": 1, "failed": 0}


def test_rounds_do_not_grow_with_the_flags(spark, paths, monkeypatch):
    days = [date(2026, 3, day) for day in range(1, 13)]
    replace_table(spark, flags_of(spark, [flag("AAA", day, "X") for day in days]), paths[1])
    monkeypatch.setattr(explain_plan, "ROUND", 1)
    monkeypatch.setattr(explain_plan, "ROUNDS", 3, raising=False)
    real, stores = explain_plan.append_table, []
    monkeypatch.setattr(explain_plan, "append_table", lambda *args: (stores.append(1), real(*args)))
    counts = run_explanations(spark, *paths, lambda prompt: "text")
    assert counts == {"newly_explained": 12, "already_cached": 0, "failed": 0}
    assert len(stores) <= 3


def test_results_carry_the_error(spark):
    prices = prices_of(spark, series("AAA", 10.0))
    flags = flags_of(spark, [flag("AAA", DAYS[1], "X"), flag("AAA", DAYS[2], "Y")])

    def call(prompt):
        return {"X": "fine"}["X" if "Flag type: X" in prompt else "Y"]

    results = explain(prompts(prices, flags), call, parallelism=2)
    found = {r.flag_type: (r.status, r.explanation, r.error) for r in results.collect()}
    assert found == {"X": ("explained", "fine", None), "Y": ("failed", None, "KeyError: 'Y'")}
    assert tuple(explain_counts(flags, results).first()) == (1, 0, 1)


def test_batch_without_any_flags(spark, paths):
    replace_table(spark, flags_of(spark, []), paths[1])
    counts = run_explanations(spark, *paths, lambda prompt: "x")
    assert counts == {"newly_explained": 0, "already_cached": 0, "failed": 0}
