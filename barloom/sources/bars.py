"""Sources and sinks of price bars.

A bar frame has code (string), date, open, close and, where a source has them,
high and low; it is keyed by code and ordered by date.  Missing values are
NULL, never NaN.
"""

from __future__ import annotations

from collections.abc import Iterable
from html import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICES = ("open", "high", "low", "close")
#: A bar's high is at most this many times its low, and its prices lie within that range but for one in a hundred.
MOST_RANGE = 1.5
#: Beyond any price, and below NaN and infinity.
MOST_PRICE = 1e300


def _schema(columns: Iterable[str], date_type: T.DataType) -> T.StructType:
    kinds = {"date": date_type, "code": T.StringType()}
    return T.StructType([T.StructField(c, kinds.get(c, T.DoubleType())) for c in columns])


def read_csv_bars(spark: SparkSession, path: str, header: Iterable[str] = ("date", "code", "open", "close"), columns: Iterable[str] = ("date", "code", "open", "close"), parse_dates: bool = True) -> DataFrame:
    """Bars of a CSV file whose columns are ``header``; only ``columns`` are read.

    Codes stay strings, so leading zeros are kept.  Without ``parse_dates`` the date is the
    written text."""
    kind = T.TimestampNTZType() if parse_dates else T.StringType()
    raw = spark.read.schema(_schema(header, kind)).option("header", True).option("enforceSchema", False).csv(path)
    return no_nan(raw.select(*columns))


def read_csv_benchmark(spark: SparkSession, path: str) -> DataFrame:
    """date, close."""
    return read_csv_bars(spark, path, ("date", "close"), ("date", "close"))


def from_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    """An in-memory feed; a date index becomes a column."""
    if "date" not in frame.columns and frame.index.name == "date":
        frame = frame.reset_index()
    return no_nan(spark.createDataFrame(frame.assign(code=frame["code"].astype(str)) if "code" in frame else frame))


def union_bars(*frames: DataFrame) -> DataFrame:
    """Several feeds as one; columns that a feed lacks are null."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


def read_bars_folder(spark: SparkSession, folder: str, format: str = "csv", header: Iterable[str] = ("date", "open", "close")) -> DataFrame:  # noqa: A002
    """All bar files of a folder; where the files have no code, it is the file's name, or, of a folder with
    one folder named code=... for each, the name of that (with ``code`` in the header)."""
    header = list(header)
    if format == "csv":
        # columns go by position: files whose own header names others, or another order, are refused
        raw = spark.read.schema(_schema(header, T.TimestampNTZType())).option("header", True).option("enforceSchema", False).csv(folder)
    else:
        raw = spark.read.format(format).load(folder)
    if "code" not in raw.columns:
        raw = raw.withColumn("code", F.regexp_replace(F.col("_metadata.file_name"), r"\.[A-Za-z]+$", ""))
    return no_nan(raw)


def write_csv_bars(bars: DataFrame, path: str, by_code: bool = False) -> str:
    """The bars as CSV files with a header; ``by_code``: in a folder for each code."""
    out = bars.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    (out.partitionBy("code") if by_code else out).csv(path)
    return path


def no_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in all floating columns: NaN would compare as the largest value."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")}) if any(t in ("double", "float") for _, t in df.dtypes) else df


def sound_prices(bars: DataFrame) -> DataFrame:
    """The bars with open, high, low, close made sound, and clean: whether nothing had to be.

    A range counts if its high is at least its low and at most MOST_RANGE times as much; a price, if it is
    positive and within the range but for one in a hundred or, where there is no range, within MOST_RANGE
    of the other price.  What is not sound is taken from the other price, then from the middle of the
    range; a missing range is that of the two prices.  Bars with nothing sound have null prices."""
    low, high, open_, close = (F.col(c) for c in ("low", "high", "open", "close"))
    # NaN is above all numbers: comparisons with both sides leave it out
    ranged = F.coalesce((low > 0) & (low < MOST_PRICE) & (high >= low) & (high <= MOST_RANGE * low), F.lit(False))
    near = (open_ > 0) & (close > 0) & (open_ < MOST_PRICE) & (close < MOST_PRICE) & (open_ <= MOST_RANGE * close) & (close <= MOST_RANGE * open_)
    within = lambda c: F.when(F.col("_r"), c.between(0.99 * low, 1.01 * high)).otherwise(near)
    rows = bars.withColumn("_r", ranged)
    rows = rows.withColumns({"_o": F.when(within(open_), open_), "_c": F.when(within(close), close), "_l": F.when(F.col("_r"), low), "_h": F.when(F.col("_r"), high)})
    middle = (F.col("_l") + F.col("_h")) / 2
    rows = rows.withColumns({"clean": F.col("_r") & F.col("_o").isNotNull() & F.col("_c").isNotNull(), "open": F.coalesce("_o", "_c", middle), "close": F.coalesce("_c", "_o", middle)})
    rows = rows.withColumns({"low": F.coalesce("_l", F.least("open", "close")), "high": F.coalesce("_h", F.greatest("open", "close"))})
    return rows.drop("_r", "_l", "_h", "_o", "_c")


def daily_bars(spark: SparkSession, folder: str) -> DataFrame:
    """code, day and whole thousandths o, h, l, c of the daily bars of listed instruments: the last reading
    of each day, clean ones before those that had to be made sound.  No day with a sound price is lost.
    Averages of whole numbers are exact, so crosses never hang on a last bit.

    One partial hash aggregate per (code, day); a code with many readings a day is reduced map-side."""
    bars = spark.read.parquet(f"{folder}/hs300etf_day.parquet").select("bar_id", "code", "date", *PRICES)
    days = spark.read.parquet(f"{folder}/trade_calendar.parquet").where("is_open = 1").select(F.to_date("cal_date").alias("day"))
    listed = spark.read.parquet(f"{folder}/etf_info.parquet").select("code")
    own = sound_prices(bars.where("code is not null and date is not null")).withColumn("day", F.to_date("date")).join(F.broadcast(days), "day", "left_semi").join(listed, "code", "left_semi")
    # one number to order by, so that the aggregate can hash: clean first, then the time, then the bar
    moment = F.unix_micros(F.col("date").cast("timestamp")) + F.when(F.col("clean"), F.lit(1 << 60)).otherwise(F.lit(0))
    order = F.when(F.col("open").isNotNull(), (moment.cast("decimal(19, 0)") * F.lit("1" + 19 * "0").cast("decimal(20, 0)") + F.col("bar_id")).cast("decimal(38, 0)"))
    last = own.withColumn("order", order).groupBy("code", "day").agg(*(F.max_by(c, "order").alias(c) for c in PRICES))
    whole = {k: F.round(F.col(c) * 1000).cast("long") for k, c in zip("ohlc", PRICES, strict=True)}
    return last.where("open is not null").select("code", "day", *(x.alias(k) for k, x in whole.items()))


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """day, close: one row per day with a value; of repeated rows the smallest value."""
    b = spark.read.parquet(f"{folder}/hs300_bench.parquet").where("close is not null and not isnan(close) and date is not null")
    return b.groupBy(F.to_date("date").alias("day")).agg(F.min("close").alias("close"))


def write_report(metrics: DataFrame, path: str, title: str = "performance", most_rows: int = 10_000) -> str:
    """The metrics as an HTML page at a driver-local path; refuses more than ``most_rows`` rows."""
    rows = metrics.limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError("too many rows for a page")
    head = "".join(f"<th>{escape(c)}</th>" for c in metrics.columns)
    body = "".join("<tr>" + "".join(f"<td>{escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows)
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1><table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>")
    return path
