"""Filling missing values from similar records, by label propagation.

Nodes are bars and the (instrument, day) states they belong to.  Edges join a
bar to its instrument's state on its day, the open of a state to its close, and
the close to the open of the instrument's next state, the weaker the more days
lie between.  Observed values are clamped; a missing number is the weighted
average of its neighbours.  Repeating that average until nothing moves gives on
such a chain the line between the nearest observed values on both sides, drawn
over the resistance of the edges; so the fixed point is taken at once, without
rounds, however long the gap.  A missing code takes the category distribution
of its neighbours, iteratively: the bars of the same name, and, where there is
no name, the instruments whose state around that day is nearest in price.  Bars
that want the same instrument on the same day share what it can give, round
after round; a label is taken if it has most of the weight of its bar.

Scale: states are aggregated map-side, at most one per instrument and day; the
nearest observed values are running windows on one partitioning by instrument,
bounded by the calendar.  Holes meet states by instrument and day, so that a hot
instrument is spread over its days; rows without a name or a code never meet on
a null key.  Similarity edges for codes are an equi-join on day and price
bucket of the few bars without code and name: a bar meets the instruments
within 1.2 per cent of its price on that day, never all pairs of a day.

Defined results: every cell of the three fields without a usable value is a
row, also if it cannot be filled (status "unfilled", value null); cells with a
value are never changed; an all-null column, an empty table or a bar without
date, code and name stay unfilled; repeated rows are filled alike; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.readings import is_code, usable

CODE_ROUNDS = 2
#: Resistance of the edge from an open to its close, and of that from a close to the next day's open; a day in between adds both.
WITHIN, OVERNIGHT = 1.0, 0.5
#: A state stands for its instrument up to the next one, at most for so many days; after FADES days its weight is half.
LAST_DAYS, FADES = 30, 7.0
#: Share of the weight that a code must have among the candidates of a bar: of those of its name, and of the nearest in price.
MAJORITY, NEAREST = 0.5, 0.7
#: Width of a price bucket for similarity edges, as a relative difference.
SIMILAR = 0.004


def _near(c: str, low: str, high: str):
    """A price is a neighbour's label only if it is plausible within its own bar, so that spikes do not spread."""
    ok = (F.col(c) > 0) & ((F.col(low).isNull()) | (F.col(c) >= 0.8 * F.col(low))) & ((F.col(high).isNull()) | (F.col(c) <= 1.25 * F.col(high)))
    return F.when(ok, F.col(c))


def prepare(bars: DataFrame, stand_ins: list[float]) -> DataFrame:
    clean = lambda c: F.when(~F.isnan(c) & (F.col(c) > 0), F.col(c))
    rows = bars.select("bar_id", F.when(is_code(F.col("code")), F.col("code")).alias("code"), F.when(F.trim("name") != "", F.col("name")).alias("name"), F.to_date("date").alias("day"),
                       usable(F.col("open"), stand_ins).alias("open"), usable(F.col("close"), stand_ins).alias("close"), clean("high").alias("high"), clean("low").alias("low"))
    return rows.withColumns({"o": _near("open", "low", "high"), "c": _near("close", "low", "high")})


def propagate_states(states: DataFrame) -> DataFrame:
    """The fixed point of the propagation for states with a missing value: code, day, o, c (null where the
    instrument has no value at all).

    states: code, day, o, c (null: missing); several rows of one state count as one.  The aggregate and
    both running windows share one exchange."""
    states = states.repartition("code").groupBy("code", "day").agg(F.avg("o").alias("o"), F.avg("c").alias("c"))
    place = F.datediff("day", F.lit("1970-01-01")) * F.lit(WITHIN + OVERNIGHT)
    s = states.select("code", "day", "o", "c", place.alias("x"))
    node = lambda v, at: F.when(v.isNotNull(), F.struct(v.alias("v"), at.alias("x")))
    o, c = node(F.col("o"), F.col("x")), node(F.col("c"), F.col("x") + WITHIN)
    w = Window.partitionBy("code")
    up = w.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    down = w.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("before", F.last(F.coalesce(c, o), True).over(up)).withColumn("behind", F.last(F.coalesce(o, c), True).over(down))
    s = s.where("o is null or c is null")

    def between(left, right, at):
        share = (at - left["x"]) / (right["x"] - left["x"])
        return F.coalesce(left["v"] + (right["v"] - left["v"]) * share, left["v"], right["v"])

    filled_o = between(F.col("before"), F.coalesce(c, F.col("behind")), F.col("x"))
    filled_c = between(F.coalesce(o, F.col("before")), F.col("behind"), F.col("x") + WITHIN)
    return s.select("code", "day", F.coalesce("o", filled_o).alias("o"), F.coalesce("c", filled_c).alias("c"))


def name_codes(rows: DataFrame) -> DataFrame:
    """name, name_code, name_weight: the code most bars of a name have, where it has most of them."""
    votes = rows.where("code is not null and name is not null").groupBy("name", "code").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("name").agg(F.max_by("code", F.struct("n", "code")).alias("name_code"), (F.max("n") / F.sum("n")).alias("name_weight"))
    return best.where(F.col("name_weight") >= MAJORITY)


def nearest_codes(asked: DataFrame, states: DataFrame) -> DataFrame:
    """bar_id, near_code for bars without code and name, from similarity edges.

    asked: bar_id, day, p (a price); states: code, day, o, c, n."""
    bucket = lambda x: F.floor(F.log(x) / SIMILAR)
    edges = asked.select("bar_id", "day", "p", F.explode(F.array(*(bucket(F.col("p")) + k for k in (-1, 0, 1)))).alias("bucket"))
    w = Window.partitionBy("code").orderBy("day")
    # its close is what the next open lies near
    around = states.select("code", "day", "n", F.coalesce("c", "o").alias("v")).withColumn("next_day", F.lead("day").over(w)).where("v > 0")
    # a state stands for the days up to the next one, on which a bar of its instrument may be the lost one
    around = around.select("code", "v", "n", F.explode(F.sequence("day", F.greatest(F.col("day"), F.least(F.date_sub("next_day", 1), F.date_add("day", LAST_DAYS))))).alias("day"), F.col("day").alias("at"))
    pairs = edges.join(around.withColumn("bucket", bucket(F.col("v"))), ["day", "bucket"])
    # what an instrument can give that day: one bar where it has none, else the more the more often it is read
    n, apart = F.col("n").cast("double"), F.datediff("day", "at")
    room = F.when(apart > 0, 1.0).otherwise(n * n / (n + 10))
    alike = F.exp(-F.abs(F.log(F.col("p") / F.col("v"))) / SIMILAR) / (1 + apart / FADES)
    cand = pairs.groupBy("bar_id", "day", "code").agg(F.sum(alike * room).alias("p"), F.max(room).alias("room"))
    for _ in range(CODE_ROUNDS):
        # a distribution over the candidates of a bar, then over the bars that want the same instrument on the same day
        bar, state = Window.partitionBy("bar_id"), Window.partitionBy("code", "day")
        cand = cand.withColumn("p", F.col("p") / F.sum("p").over(bar))
        cand = cand.withColumn("p", F.col("p") * F.least(F.lit(1.0), F.greatest("room", F.lit(1.0)) * F.col("p") / F.sum("p").over(state)))
    best = cand.groupBy("bar_id").agg(F.max_by("code", F.struct("p", "code")).alias("near_code"), (F.max("p") / F.sum("p")).alias("weight"))
    return best.where(F.col("weight") >= NEAREST).select("bar_id", "near_code")


def daily_states(rows: DataFrame) -> DataFrame:
    """code, day, o, c (averages), n: one row per instrument and day."""
    return rows.where("code is not null and day is not null").groupBy("code", "day").agg(F.avg("o").alias("o"), F.avg("c").alias("c"), F.count(F.lit(1)).alias("n"))


def fill_missing(bars: DataFrame, stand_ins: list[float]) -> DataFrame:
    """bar_id, field, value (string), status (filled, unfilled), source (bar, state, code): a row for
    every cell of open, close and code that has no usable value."""
    rows = prepare(bars, stand_ins)
    states = daily_states(rows)
    # a key of its own for rows that need no name or have none: they spread and match nothing
    own_key = F.concat(F.lit("\x00"), F.pmod(F.xxhash64("bar_id"), F.lit(4096)).cast("string"))
    holes = rows.where("open is null or close is null or code is null").withColumn("name", F.when(F.col("code").isNull() & F.col("name").isNotNull(), F.col("name")).otherwise(own_key))
    holes = holes.join(name_codes(rows), "name", "left")
    asked = holes.where("code is null and name_code is null and day is not null and coalesce(o, c) > 0").select("bar_id", "day", F.coalesce("o", "c").alias("p"))
    holes = holes.join(nearest_codes(asked, states), "bar_id", "left").withColumn("filled_code", F.when(F.col("code").isNull(), F.coalesce("name_code", "near_code")))
    at_code = F.coalesce("code", "filled_code")
    holes = holes.select("bar_id", "day", "open", "close", "high", "low", "o", "c", F.col("code").isNull().alias("lost"), "filled_code", F.coalesce(at_code, own_key).alias("at_code"))
    # filled codes may name a state that has no other bar: it is a missing state of its own
    none = F.lit(None).cast("double")
    extra = holes.where("lost and filled_code is not null and day is not null").select(F.col("filled_code").alias("code"), "day", none.alias("o"), none.alias("c"))
    smooth = propagate_states(states.select("code", "day", "o", "c").unionByName(extra)).select(F.col("code").alias("at_code"), "day", F.col("o").alias("po"), F.col("c").alias("pc"))
    seen = states.select(F.col("code").alias("at_code"), "day", F.col("o").alias("so"), F.col("c").alias("sc"))
    joined = holes.join(seen, ["at_code", "day"], "left").join(smooth, ["at_code", "day"], "left")
    middle = (F.col("high") + F.col("low")) / 2
    own = lambda x: F.coalesce(x, middle, "high", "low")
    cell = lambda f, missing, value, source: F.when(missing, F.struct(F.lit(f).alias("field"), value.cast("string").alias("value"), source.alias("source")))
    o, c = F.coalesce("so", "po", own("c")), F.coalesce("sc", "pc", own("o"))
    via = lambda s, p, v: F.when(F.col(s).isNotNull() | F.col(p).isNotNull(), "state").when(v.isNotNull(), "bar")
    cells = F.array_compact(F.array(cell("open", F.col("open").isNull(), o, via("so", "po", o)), cell("close", F.col("close").isNull(), c, via("sc", "pc", c)), cell("code", F.col("lost"), F.col("filled_code"), F.when(F.col("filled_code").isNotNull(), "code"))))
    long = joined.select("bar_id", F.explode(cells).alias("x")).select("bar_id", "x.*")
    return long.select("bar_id", "field", "value", F.when(F.col("value").isNotNull(), "filled").otherwise("unfilled").alias("status"), "source")
