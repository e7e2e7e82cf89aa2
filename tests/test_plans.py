"""Scans and exchanges of the plans that cost most."""

from pathlib import Path

import pytest

import __spark_entry__ as registry

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables are not here")


def counts(df):
    """Scans of stored tables and exchanges, broadcasts included, in the plan before it runs."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    nodes = [line.lstrip(" :+-").split("*")[-1].split(") ", 1)[-1].strip() for line in lines]
    scans = sum(node.startswith(("FileScan", "Scan", "BatchScan")) for node in nodes)
    exchanges = sum(node.startswith(("Exchange", "BroadcastExchange")) for node in nodes)
    return scans, exchanges


@pytest.mark.parametrize(
    "name, scans, exchanges",
    [
        ("all_flags", 1, 3),
        ("unkeyed_all_flags", 1, 2),
        ("cut_all_flags", 3, 4),
        ("price_window", 3, 9),
        ("report_lines", 5, 8),
        ("scope_hash", 1, 3),
        ("normalize_bars", 2, 1),
    ],
)
def test_scans_and_exchanges(spark, name, scans, exchanges):
    found = counts(registry.queries()[name](spark, str(SF_DIR)))
    assert found[0] <= scans and found[1] <= exchanges, found
