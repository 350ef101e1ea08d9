"""All queries of the core and their SQL."""

from __future__ import annotations

from barloom.plans import backtest, backtest_sql, data_quality, data_quality_sql

QUERIES = {**data_quality.QUERIES, **backtest.QUERIES}
ORACLES: dict[str, str] = {**data_quality_sql.ORACLES, **backtest_sql.ORACLES}
