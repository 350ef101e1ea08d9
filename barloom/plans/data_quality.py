"""Queries p1 to p5 over the daily bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import fill, profile, regular, rolling, spikes
from barloom.operators import readings as R
from barloom.sources.tables import clean_readings, table


def p1_filled(spark: SparkSession, folder: str) -> DataFrame:
    bars = table(spark, folder, "hs300etf_day")
    return fill.fill_missing(bars, R.find_stand_ins(bars))


def p1_propagated(spark: SparkSession, folder: str) -> DataFrame:
    """The propagated open and close of every instrument and day that lacks one of them."""
    bars = table(spark, folder, "hs300etf_day")
    s = fill.propagate_states(fill.daily_states(fill.prepare(bars, R.find_stand_ins(bars))))
    return s.select("code", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("o", 6).alias("open"), F.round("c", 6).alias("close"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_filled(spark, folder).where(F.col("status").isin("filled", "unfilled")).select("bar_id", "field")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return spikes.score_readings(clean_readings(spark, folder, "open", "close"), only_flagged=True).select("bar_id", "field")


def p2_scored(spark: SparkSession, folder: str) -> DataFrame:
    return spikes.score_readings(clean_readings(spark, folder, "open", "close"))


def _series(spark: SparkSession, folder: str) -> DataFrame:
    return regular.regular_series(clean_readings(spark, folder, "open"), table(spark, folder, "trade_calendar"))


def p3_regular(spark: SparkSession, folder: str) -> DataFrame:
    return _series(spark, folder).withColumn("value", F.round("value", 9))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return regular.missing_days(_series(spark, folder))


def p4_rolling(spark: SparkSession, folder: str) -> DataFrame:
    totals = rolling.rolling_totals(clean_readings(spark, folder, "close"))
    totals = totals.withColumns({f"total_{p}": F.round(f"total_{p}", 4) + F.lit(0.0) for p in (7, 30)})
    return totals.withColumns({f"avg_{p}": F.when(F.col(f"n_{p}") > 0, F.col(f"total_{p}") / F.col(f"n_{p}")) for p in (7, 30)})


def p4_rolling_quarter(spark: SparkSession, folder: str) -> DataFrame:
    """Periods beyond a month: 90 and 250 days."""
    totals = rolling.rolling_totals(clean_readings(spark, folder, "close"), periods=(90, 250))
    return totals.select("code", "day", *(F.round(f"total_{p}", 3).alias(f"total_{p}") for p in (90, 250)), "n_90", "n_250")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.idle_days(p4_rolling(spark, folder))


def p5_profile(spark: SparkSession, folder: str) -> DataFrame:
    bars = table(spark, folder, "hs300etf_day")
    return profile.column_profile(bars, stand_ins=dict.fromkeys(("open", "close"), R.find_stand_ins(bars)))


def p5_profile_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of the bars, distinct values counted in full."""
    bars = table(spark, folder, "hs300etf_day")
    columns = ("code", "name", "date", "open", "high", "low", "close", "loaded_at")
    p = profile.column_profile(bars, columns, stand_ins=dict.fromkeys(("open", "close"), R.find_stand_ins(bars)), exact=True)
    return p.withColumn("null_rate", F.round("null_rate", 9))


def p5_divergent(spark: SparkSession, folder: str) -> DataFrame:
    """The changed loads with the mask most in excess and the share of rows."""
    bars = table(spark, folder, "hs300etf_day")
    return profile.divergent_loads(bars, R.find_stand_ins(bars))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return profile.changed_columns(p5_divergent(spark, folder))


QUERIES = {f.__name__: f for f in (p1_found, p1_filled, p1_propagated, p2_found, p2_scored, p3_found, p3_regular, p4_found, p4_rolling, p4_rolling_quarter, p5_found, p5_divergent, p5_profile, p5_profile_exact)}
