import json
from datetime import date
from pathlib import Path

import pytest

from barproof.operators.checks import all_flags
from barproof.plans.pipeline import Paths, StageFailed, run_pipeline
from barproof.plans.validate import run_validations
from barproof.schemas import FLAGS
from barproof.sources.tables import read_series, read_table, upsert_prices

from tests.bars import bar, prices_of, saved, weekdays

DAYS = [d for d in weekdays(date(2026, 1, 5), 20) if d != date(2026, 1, 19)]


@pytest.fixture
def setting(spark, tmp_path):
    config = tmp_path / "universe.json"
    tickers = [{"symbol": "AAA", "exchange": "NYSE"}, {"symbol": "BBB", "exchange": "LSE"}]
    config.write_text(json.dumps({"tickers": tickers, "period": "6mo"}))
    rows = [("AAA", d, 10.0, 11.0, 9.0, 7.0 + i % 2, 100.0) for i, d in enumerate(DAYS) if i != 4]
    rows += [("BBB", d, 10.0, 11.0, 9.0, 10.0, 100.0) for d in DAYS[:5]]
    raw = spark.createDataFrame(
        rows, "symbol string, Date date, Open double, High double, Low double, Close double, Volume double"
    )
    paths = Paths(*(str(tmp_path / n) for n in ("prices", "flags", "explanations", "reports")))
    return str(config), raw, paths


def test_whole_run_and_rerun(spark, calendar, setting):
    config, raw, paths = setting
    for newly in (len(DAYS) - 1 + 1 + 2, 0):
        outcome = run_pipeline(
            spark, config, raw, paths, calendar, lambda prompt: "because", report_date=date(2026, 3, 1)
        )
        assert outcome.ingested == {"rows": len(DAYS) - 1 + 5, "tickers": 2}
        assert [(r.ticker, r.rows) for r in outcome.tickers.collect()] == [("AAA", len(DAYS) - 1), ("BBB", 5)]
        assert {r.flag_type: r["count"] for r in outcome.flag_counts.collect()} == {
            "MISSING_DATES": 1,
            "OHLC_INCONSISTENCY": len(DAYS) - 1,
            "STALE_PRICE": 2,
        }
        assert outcome.explained["newly_explained"] == newly
        assert outcome.explained["failed"] == 0
    text = saved(outcome.report)
    assert f"### {DAYS[4]} — MISSING_DATES (low)" in text
    assert "- Explanation: because" in text and "No explanation available" not in text
    assert Path(outcome.report).name.startswith("market_data_quality_report_2026-03-01_")


def test_failing_stage_is_named(spark, calendar, setting):
    config, raw, paths = setting

    def run(**changed):
        settings = {"config_path": config, "raw": raw, "paths": paths, "calendar": calendar}
        return run_pipeline(spark, explain_fn=lambda prompt: "x", **{**settings, **changed})

    with pytest.raises(StageFailed, match="Ingestion failed: No data was found"):
        run(raw=raw.limit(0))
    with pytest.raises(StageFailed, match="Configuration failed: There is no configuration"):
        run(config_path="/nowhere/universe.json")
    with pytest.raises(StageFailed, match="Validation failed") as failure:
        run(calendar=type(calendar)(calendar.holidays, ("NYSE",)))
    assert failure.value.stage == "Validation"


def test_large_tables_get_more_tasks_and_still_one_shuffle(spark, calendar, tmp_path):
    path = str(tmp_path / "prices")
    upsert_prices(spark, prices_of(spark, [bar("AAA", d, 5.0) for d in DAYS]), path)
    small, large = read_series(spark, path), read_series(spark, path, task_bytes=100)
    flags = all_flags(large, calendar, keyed=True)
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    assert "Exchange" not in small._jdf.queryExecution().executedPlan().toString()
    assert flags.count() == all_flags(small, calendar, keyed=True).count() > 0


def test_rerun_of_checks_replaces_flags_and_failure_keeps_them(spark, calendar, tmp_path):
    prices, flags = str(tmp_path / "prices"), str(tmp_path / "flags")
    upsert_prices(spark, prices_of(spark, [bar("AAA", d, 5.0) for d in DAYS[:6]]), prices)
    for _ in range(2):
        assert run_validations(spark, prices, flags, calendar).count() == 3
    with pytest.raises(Exception, match="No trading calendar"):
        run_validations(spark, prices, flags, type(calendar)(calendar.holidays, ("LSE",)))
    assert read_table(spark, flags, FLAGS).count() == 3
    assert run_validations(spark, prices, flags, calendar, stale_price_n=4).count() == 2
