"""What counts as a reading and as a usable value.

A reading is a bar whose code is a listed instrument and whose time falls on an
open day.  A price is usable unless it is null, not a finite number or a stand-in: a constant
far above any price that recurs over unrelated instruments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_PATTERN = "^[0-9]{6}$"
#: A stand-in lies this many times above the 99th percentile of all low prices.
FAR_ABOVE = 10.0
#: It occurs with at least this share of the instruments, and no fewer than three.
LEAST_SHARE = 0.02
#: The low prices of its bars span at least this ratio: the instruments are unrelated.
UNRELATED = 3.0


def is_code(c: Column) -> Column:
    return F.coalesce(c.rlike(CODE_PATTERN), F.lit(False))


def find_stand_ins(bars: DataFrame, fields: tuple[str, ...] = ("open", "close")) -> list[float]:
    """The constants written instead of a price, mined from the bars themselves.

    Two small aggregates over pruned columns.  What comes to the driver is bounded: every
    stand-in must occur with two in a hundred instruments.  An empty table, or one without the
    columns code and low filled, has none."""
    valid = F.when(is_code(F.col("code")), F.col("code"))
    facts = bars.agg(F.percentile_approx(F.when((F.col("low") > 0) & ~F.isnan("low"), F.col("low")), 0.99, 1000).alias("high"), F.approx_count_distinct(valid).alias("codes")).first()
    if not facts["high"]:
        return []
    values = bars.select(valid.alias("code"), F.when((F.col("low") > 0) & ~F.isnan("low"), F.col("low")).alias("low"), F.explode(F.array(*fields)).alias("v"))
    values = values.where((F.col("v") > FAR_ABOVE * facts["high"]) & ~F.isnan("v"))
    spread = F.percentile_approx("low", F.array(F.lit(0.1), F.lit(0.9)), 100)
    found = values.groupBy("v").agg(F.approx_count_distinct("code").alias("codes"), spread.alias("p"))
    least = max(3, round(LEAST_SHARE * facts["codes"]))
    found = found.where((F.col("codes") >= least) & (F.col("p")[1] >= UNRELATED * F.col("p")[0]))
    return sorted(r["v"] for r in found.select("v").collect())


def usable(c: Column, stand_ins: list[float]) -> Column:
    """The price, or null where it has no usable value.  Zero and negative prices are values."""
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    for v in stand_ins:
        bad = bad | (c == F.lit(v))
    return F.when(~bad, c)


def open_days(calendar: DataFrame) -> DataFrame:
    """day, day_no: the open days, numbered.  The calendar does not grow with the bars; a
    number of years gives a few thousand rows, so it is broadcast."""
    days = calendar.where("is_open = 1").select(F.to_date("cal_date").alias("day")).distinct()
    return days.select("day", F.expr("cast(row_number() over (order by day) as int)").alias("day_no"))


def readings(bars: DataFrame, instruments: DataFrame, calendar: DataFrame, *columns: Column | str) -> DataFrame:
    """bar_id, code, date, day and the given columns of all readings.

    The calendar is broadcast (fixed); instruments grow, so the join is left to the planner, which
    knows their size.  Null codes and dates are no readings."""
    own = bars.select("bar_id", "code", "date", F.to_date("date").alias("day"), *columns).where("code is not null and date is not null")
    listed = instruments.select("code").where("code is not null")
    days = calendar.where("is_open = 1").select(F.to_date("cal_date").alias("day"))
    return own.join(F.broadcast(days), "day", "left_semi").join(listed, "code", "left_semi")


def moment(time: Column, bar_id: Column) -> Column:
    """A number that orders by time, then by bar_id; unlike a struct it can be aggregated by hash."""
    return (F.unix_micros(time.cast("timestamp")).cast("decimal(38, 0)") * F.lit("1" + 19 * "0").cast("decimal(20, 0)") + bar_id).cast("decimal(38, 0)")


def latest(rows: DataFrame, value: str) -> DataFrame:
    """One row per code, day and time: of bars delivered again, the one delivered last that has a value.

    Partitioned by code and day, which the aggregates that follow reuse; a hot code is spread over its
    days.  Times hardly repeat, so every reading is sent once."""
    return rows.select("code", "day", "date", "bar_id", value).repartition("code", "day").groupBy("code", "day", "date").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("bar_id"))).alias(value))
