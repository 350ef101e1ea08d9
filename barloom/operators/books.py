"""Stored account states and holdings as tables: history, latest state with broker settings, position book.

Repeated rows count once; of several states of one account and day the one
posted last counts.  An account's history is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MONEY = ("total_asset", "market_value", "float_profit_loss", "daily_profit_loss", "cash")


def account_history(accounts: DataFrame) -> DataFrame:
    """account_id, broker_id, date (null: the opening row), and the five amounts; a missing daily figure is
    the change of the total, a missing floating one the change since the opening."""
    last = F.max_by(F.struct("broker_id", *MONEY), F.struct(F.coalesce(F.col("posted_at"), F.lit("1900-01-01").cast("timestamp_ntz")), "total_asset"))
    rows = accounts.groupBy("account_id", "date").agg(last.alias("x")).select("account_id", "date", "x.*")
    w = Window.partitionBy("account_id").orderBy(F.col("date").asc_nulls_first())
    opening = F.first("total_asset").over(w.rowsBetween(Window.unboundedPreceding, 0))
    change = F.col("total_asset") - F.lag("total_asset").over(w)
    return rows.withColumns({"float_profit_loss": F.coalesce("float_profit_loss", F.col("total_asset") - opening), "daily_profit_loss": F.coalesce("daily_profit_loss", change, F.lit(0.0))})


def latest_accounts(history: DataFrame, brokers: DataFrame) -> DataFrame:
    """The last state of each account with its broker's settings (a fixed table, broadcast); NaN settings are null."""
    order = F.coalesce(F.col("date"), F.lit("1900-01-01").cast("timestamp_ntz"))
    last = history.groupBy("account_id").agg(F.max_by(F.struct("broker_id", "date", "total_asset", "cash"), order).alias("x")).select("account_id", "x.*")
    known = brokers.select("broker_id", F.when(~F.isnan("commission"), F.col("commission")).alias("commission"), "min_size", F.when(~F.isnan("pct_limit"), F.col("pct_limit")).alias("pct_limit"))
    return last.join(F.broadcast(known), "broker_id", "left")


def position_book(positions: DataFrame) -> DataFrame:
    """The last holding of each account and code, with its share of the account's holdings; a missing
    price is the value of one unit."""
    newest = F.max_by(F.struct("as_of", "name", "market_value", "hold_vol", "cost", "price"), F.struct("as_of", "position_id"))
    rows = positions.groupBy("account_id", "code").agg(newest.alias("x")).select("account_id", "code", "x.*")
    price = F.coalesce(F.when(~F.isnan("price"), F.col("price")), F.try_divide("market_value", F.abs("hold_vol")))
    share = F.try_divide("market_value", F.sum("market_value").over(Window.partitionBy("account_id")))
    return rows.withColumns({"price": price, "share": share})
