"""Tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import readings as R


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def clean_readings(spark: SparkSession, folder: str, *fields: str) -> DataFrame:
    """Readings of the daily bars with unusable prices set to null."""
    bars = table(spark, folder, "hs300etf_day")
    stand_ins = R.find_stand_ins(bars)
    cols = [R.usable(F.col(f), stand_ins).alias(f) for f in fields]
    return R.readings(bars, table(spark, folder, "etf_info"), table(spark, folder, "trade_calendar"), *cols)
