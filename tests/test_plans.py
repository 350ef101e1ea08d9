"""The physical plans are the ones that scale: few exchanges, pruned scans, no cross joins."""

import re

import pytest

from barloom.plans import registry
from tests.conftest import SF


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def exchanges(text):
    return [m for m in re.findall(r"(?<!Broadcast)Exchange (\w+\([^)]*\))", text)]


@pytest.mark.parametrize("name,most", [("sma", 2), ("kdj", 2), ("crossup_sma", 2), ("trade_delay", 2), ("ledger_d", 3), ("p4_found", 2), ("p4_rolling", 2)])
def test_few_exchanges(spark, name, most):
    """One for the daily bar of each instrument, one by instrument for all windows (and one for the ledger)."""
    found = [e for e in exchanges(plan(registry.QUERIES[name](spark, SF))) if e.startswith("hashpartitioning(code")]
    assert 1 <= len(found) <= most, found


@pytest.mark.parametrize("name,most,scans", [("p1_found", 14, 6), ("p2_found", 5, 3), ("p3_found", 4, 1), ("p4_found", 3, 1), ("p5_found", 8, 3), ("p1_propagated", 3, 1)])
def test_exchanges_and_scans_of_data_queries(spark, name, most, scans):
    """Exchanges in all and scans of the bars as executed, beside the search for stand-ins."""
    df = registry.QUERIES[name](spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in text
    found = exchanges(text.replace("ReusedExchange", "Reused"))
    read = [x for x in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "," in x and "cal_date" not in x]
    assert len(found) <= most and len(read) <= scans, (len(found), len(read))


def test_daily_bars_aggregate_by_hash(spark):
    assert "SortAggregate" not in plan(registry.QUERIES["bars_daily"](spark, SF))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_products_and_no_full_scans(spark, name):
    text = registry.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for schema in re.findall(r"hs300etf_day.*?ReadSchema: struct<([^>]*)>", text):
        assert "loaded_at" not in schema


def test_filters_reach_the_scan(spark):
    text = registry.QUERIES["bars_daily"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(code\)", text)
