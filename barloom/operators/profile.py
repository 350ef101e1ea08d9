"""Column-level data quality profile of loads, by character-class masks.

Every value is generalised to a mask: digits become 9 and keep their number,
runs of capital and of small letters become A and a, runs of Han characters 字,
runs of blanks one blank; signs, points and all else stay.  Missing values have
a mask of their own.  Dominant masks are mined per column; values of a rare
mask are violations.

For loads, the masks of prices are set against the instrument's own habit: a
price whose digits are shifted against the usual level has the shift as its
mask ("e+2"), others the digits behind the point (".999"); a time keeps its hour
("15h").  The mask distribution of a load is then set against what the other
loads lead one to expect for the same mix of instruments, and a divergence of
about a tenth of the rows is reported with the mask that is most in excess.

The expectation: instruments are put into strata by their own dominant mask and,
in twentieths, how far it dominates; a load is expected to show, stratum by
stratum, the masks of the other loads.  A changed mix of instruments thus
changes the expectation too: as instruments of a stratum differ by at most a
twentieth in how often they show its mask, a mix alone moves less than that.

Scale: one narrow pass with partial aggregation finds usual levels and dominant
masks of every instrument, a second one counts masks by load and stratum,
aggregated map-side; everything after works on counts, in a task for each
column: loads x strata x masks numbers, however many rows the loads have.

Defined results: null and NaN and stand-ins are missing; values without a code
belong to a stratum of their own; an empty table gives no loads; a single load
diverges from nothing; columns of any other type are profiled as text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.readings import is_code, usable

MISSING = "missing"
FIELDS = ("open", "close", "date")
#: A load is reported from this estimated share of its rows: a tenth, less what estimates of a tenth fall short by.
LEAST_SHARE = 0.08
#: A mask below this share of a column is rare; its values are violations.
RARE = 0.001
#: Steps of how far a dominant mask dominates.
STEPS = 20
#: Rounds in which divergent loads are left out of what is expected of others.
ROUNDS = 10


def written(c: Column) -> Column:
    """A number as one writes it, never in exponent form; ten places behind the point at most."""
    plain = (c == 0) | ((F.abs(c) >= 1e-3) & (F.abs(c) < 1e7))
    return F.when(plain, c.cast("string")).otherwise(F.rtrim(c.cast("decimal(38, 10)").cast("string"), F.lit("0")))


def value_mask(c: Column) -> Column:
    """The written number with its digits generalised to 9: -12.5 is -99.9."""
    return F.translate(written(c), "012345678", "999999999")


def fraction_mask(value: Column) -> Column:
    """The part of the mask after the point: the written precision."""
    return F.concat(F.lit("."), F.substring_index(value_mask(value), ".", -1))


def time_mask(c: Column) -> Column:
    """15h for any time from 15:00:00 to 15:59:59, midnight for a date without a time."""
    bare = (F.hour(c) == 0) & (F.minute(c) == 0) & (F.second(c) == 0)
    return F.when(bare, "midnight").when(c.isNotNull(), F.concat(F.hour(c).cast("string"), F.lit("h")))


def text_mask(c: Column) -> Column:
    """Fund 12 is Aa 99, 红利01 is 字99."""
    m = F.translate(c, "012345678", "999999999")
    for pattern, mask in ((r"\p{IsHan}+", "字"), (r"\p{Lu}+", "A"), (r"[\p{L}&&[^\p{Lu}\p{IsHan}]]+", "a"), (r"\s+", " ")):
        m = F.regexp_replace(m, pattern, mask)
    return m


def digit_shift(value: Column, usual: Column) -> Column:
    """Places by which a price's digits are shifted against the instrument's usual level: 0, or the nearest
    power of ten from a factor of 5.6 on; null for zero."""
    tens = F.log10(F.abs(value) / usual)
    return F.when(value == 0, F.lit(None)).when(F.abs(tens) < 0.75, F.lit(0)).otherwise(F.greatest(F.lit(-6), F.least(F.lit(6), F.rint(tens).cast("int"))))


def _explode_masks(rows: DataFrame, fields: list[tuple], *keep: str) -> DataFrame:
    packed = F.array(*(F.struct(F.lit(name).alias("field"), *(c.alias(a) for a, c in cols)) for name, *cols in fields))
    return rows.select(*keep, F.explode(packed).alias("x")).select(*keep, "x.*").where("mask is not null")


def instrument_habits(bars: DataFrame, stand_ins: list[float]) -> DataFrame:
    """code, u_open, u_close (usual level) and, for each field, the stratum of the instrument: its dominant
    mask and how far it dominates.  One narrow row per instrument."""
    rows = bars.where(is_code(F.col("code")))
    good = {f: usable(F.col(f), stand_ins) for f in ("open", "close")}
    usual = rows.groupBy("code").agg(*(F.percentile_approx(F.when(good[f] > 0, F.col(f)), 0.5, 50).alias(f"u_{f}") for f in good))
    fields = [(f, ("mask", fraction_mask(good[f]))) for f in good] + [("date", ("mask", time_mask(F.col("date"))))]
    counts = _explode_masks(rows, fields, "code").groupBy("code", "field", "mask").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("code", "field").agg(F.max_by("mask", F.struct("n", "mask")).alias("top"), F.max("n").alias("m"), F.sum("n").alias("t"))
    stratum = F.concat_ws("/", "top", F.floor(F.col("m") / F.col("t") * STEPS).cast("string"))
    wide = top.groupBy("code").agg(*(F.max(F.when(F.col("field") == f, stratum)).alias(f"s_{f}") for f in FIELDS))
    return wide.join(usual, "code").select("code", F.col("u_open").cast("float").alias("u_open"), F.col("u_close").cast("float").alias("u_close"), *(f"s_{f}" for f in FIELDS))


def mask_counts(bars: DataFrame, stand_ins: list[float]) -> DataFrame:
    """field, load_id, stratum, mask, n; aggregated map-side to a few thousand rows a task.

    The habits grow with the instruments: the planner broadcasts them only if their measured size
    is below its limit."""
    habits = instrument_habits(bars, stand_ins)
    rows = bars.select("load_id", F.when(is_code(F.col("code")), F.col("code")).alias("code"), *(usable(F.col(f), stand_ins).alias(f) for f in ("open", "close")), "date").join(habits, "code", "left")
    fields = []
    for f in ("open", "close"):
        shift = digit_shift(F.col(f), F.col(f"u_{f}"))
        mask = F.when(F.col(f).isNull(), MISSING).when(F.col(f) == 0, "zero").when(shift > 0, F.concat(F.lit("e+"), shift.cast("string"))).when(shift < 0, F.concat(F.lit("e"), shift.cast("string"))).otherwise(fraction_mask(F.col(f)))
        fields.append((f, ("stratum", F.coalesce(f"s_{f}", F.lit("none"))), ("mask", mask)))
    fields.append(("date", ("stratum", F.coalesce("s_date", F.lit("none"))), ("mask", F.coalesce(time_mask(F.col("date")), F.lit(MISSING)))))
    return _explode_masks(rows, fields, "load_id").groupBy("load_id", "field", "stratum", "mask").agg(F.count(F.lit(1)).alias("n"))


def divergence(seen: np.ndarray, stratum: np.ndarray, mask: np.ndarray, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each load the share of its rows whose masks the loads of the pool (but for itself) do not lead one
    to expect, and the number of the mask most in excess.

    seen: loads x cells; stratum and mask of each cell.  The share is the total variation distance less
    what chance alone makes of it, so that small loads and large ones are held to one measure."""
    of_stratum = np.eye(stratum.max() + 1)[stratum]
    of_mask = np.eye(mask.max() + 1)[mask]
    own = seen * pool[:, None]
    mix, own_mix = seen @ of_stratum, own @ of_stratum
    rest_mix = own_mix.sum(axis=0) - own_mix
    rest = own.sum(axis=0) - own
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(rest_mix > 0, mix / rest_mix, np.nan)[:, stratum]
    expected = np.where(np.isnan(scale), seen, scale * rest)
    s, e = seen @ of_mask, expected @ of_mask
    rows = s.sum(axis=1)
    with np.errstate(invalid="ignore"):
        chance = np.sqrt(np.maximum(2 / np.pi * e * (1 - e / rows[:, None]), 0)).sum(axis=1) / 2
    return (np.abs(s - e).sum(axis=1) / 2 - chance) / np.maximum(rows, 1), np.argmax(s - e, axis=1)


def divergent_loads(bars: DataFrame, stand_ins: list[float], least_share: float = LEAST_SHARE) -> DataFrame:
    """load_id, field, mask, share: the loads that delivered a column differently, and the mask most in excess.

    In rounds: loads that stand out say nothing of what to expect of the others, so that several changed
    loads do not hide, or smear, each other; the first round leaves out those that stand out most."""
    cells = mask_counts(bars, stand_ins)

    def judge(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        load, loads = pd.factorize(p["load_id"].fillna(""))
        (in_stratum, _), (in_mask, masks) = pd.factorize(p["stratum"]), pd.factorize(p["mask"])
        cells, cell = np.unique(in_stratum * len(masks) + in_mask, return_inverse=True)
        stratum, mask = cells // len(masks), cells % len(masks)
        seen = np.zeros((len(loads), len(cells)))
        np.add.at(seen, (load, cell), p["n"].to_numpy(float))
        out = np.zeros(len(loads), bool)
        for k in range(ROUNDS):
            share, most = divergence(seen, stratum, mask, ~out)
            now = share >= (least_share if k else max(least_share, share.max() / 2))
            if k > 1 and (now == out).all():
                break
            out = now
        found = np.flatnonzero(out)
        return pd.DataFrame({"load_id": np.array(loads, object)[found], "field": key[0], "mask": np.array(masks, object)[most[found]], "share": share[found]})

    found = cells.select(F.col("load_id").cast("string").alias("load_id"), "field", "stratum", "mask", "n").groupBy("field").applyInPandas(judge, "load_id string, field string, mask string, share double")
    return found.withColumn("load_id", F.when(F.col("load_id") != "", F.col("load_id")).cast("long"))


def changed_columns(divergent: DataFrame) -> DataFrame:
    return divergent.select("load_id", "field")


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.TimestampType | T.TimestampNTZType | T.DateType):
        return "time"
    return "number" if isinstance(t, T.NumericType) else "text"


def column_masks(table: DataFrame, columns: tuple[str, ...], by: str = "load_id", stand_ins: dict[str, list[float]] | None = None) -> DataFrame:
    """by, field, missing, number, value, mask: the values of the columns, of any type, one a row.

    number: of numbers, and of times in seconds, else null; value: as text."""
    parts = []
    for f in columns:
        kind, c = _kind(table.schema[f].dataType), F.col(f"`{f}`")
        if kind == "time":
            t = c.cast("timestamp_ntz")
            text, number = F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.unix_micros(t.cast("timestamp")) / 1e6
            mask, value = F.when(F.date_format(t, "HH:mm:ss") == "00:00:00", F.lit("9999-99-99 midnight")).otherwise(F.translate(text, "0123456789", "9999999999")), number.cast("string")
        elif kind == "number":
            number = usable(c.cast("double"), (stand_ins or {}).get(f, []))
            mask, value = value_mask(number), number.cast("string")
        else:
            value = c.cast("string")
            number, mask = F.lit(None).cast("double"), text_mask(value)
        parts.append(F.struct(F.lit(f).alias("field"), value.isNull().alias("missing"), number.alias("number"), value.alias("value"), mask.alias("mask")))
    return table.select(F.col(f"`{by}`").alias("_by"), F.explode(F.array(*parts)).alias("_x")).select(F.col("_by").alias(by), "_x.*")


def column_profile(table: DataFrame, columns: tuple[str, ...] = FIELDS, by: str = "load_id", stand_ins: dict[str, list[float]] | None = None, exact: bool = False) -> DataFrame:
    """A row per load and column: rows, null rate, distinct values (HyperLogLog, or, if ``exact``, counted
    in full), range of numbers and times, dominant mask and values of a rare mask.

    ``columns``: of any type; ``by``: the column that tells the loads apart."""
    long = column_masks(table, columns, by, stand_ins)
    masks = long.groupBy(by, "field", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("missing").cast("int")).alias("nulls"), F.min("number").alias("lo"), F.max("number").alias("hi"))
    column = masks.groupBy("field", "mask").agg(F.sum("n").alias("all_n"))
    total = masks.groupBy("field").agg(F.sum("n").alias("total"))
    rare = column.join(F.broadcast(total), "field").where(F.col("mask").isNotNull()).select("field", "mask", (F.col("all_n") < RARE * F.col("total")).alias("rare"))
    if exact:
        distinct = long.where("not missing").groupBy(by, "field", "value").agg(F.lit(1).alias("one")).groupBy(by, "field").agg(F.count("one").alias("distinct_values"))
    else:
        distinct = long.groupBy(by, "field").agg(F.approx_count_distinct("value").alias("distinct_values"))
    grouped = masks.join(rare, ["field", "mask"], "left").groupBy(by, "field").agg(
        F.sum("n").alias("rows"), (F.sum("nulls") / F.sum("n")).alias("null_rate"), F.min("lo").alias("least"), F.max("hi").alias("largest"),
        F.max_by("mask", F.when(F.col("mask").isNotNull(), F.struct("n", "mask"))).alias("dominant_mask"), F.sum(F.when(F.col("rare"), F.col("n")).otherwise(0)).alias("violations"))
    same = F.col(f"g.{by}").eqNullSafe(F.col(f"d.{by}")) & (F.col("g.field") == F.col("d.field"))
    return grouped.alias("g").join(distinct.alias("d"), same, "left").select("g.*", F.coalesce("d.distinct_values", F.lit(0)).cast("long").alias("distinct_values"))
