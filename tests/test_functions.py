import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.functions import indicators as I
from barloom.operators import grid_search, signals
from barloom.operators.ledger import RULES, Settings, final_asset, replay, with_ledger
from barloom.operators.recursive import ema, with_ema, with_macd


def frame(spark, xs, code="1"):
    return spark.createDataFrame([(code, k, None if x is None else float(x)) for k, x in enumerate(xs)], "code string, day int, x double")


def column(df, c):
    return [r[c] for r in df.orderBy("code", "day").collect()]


def test_cross_golden(spark):
    rows = [("1", k, float(a), float(b)) for k, (a, b) in enumerate(zip(range(1, 8), (1, 3, 0, 5, -2, -3, 8), strict=True))]
    df = spark.createDataFrame(rows, "code string, day int, a double, b double")
    assert column(df.withColumn("s", I.crossed("a", "b", I.series())), "s") == [None, -1, 1, -1, 1, None, -1]


def test_sma_and_ema_golden(spark):
    x = [10, 11, 12, 13, 12, 11, 10, 12]
    got = column(frame(spark, x).withColumn("s", I.sma("x", 3, I.series())), "s")
    assert got[:2] == [None, None] and np.allclose(got[2:], [11, 12, 37 / 3, 12, 11, 11])
    assert np.allclose(ema(np.array(x, float), 3)[2:], [11, 12, 12, 11.5, 10.75, 11.375])
    assert column(with_ema(frame(spark, x), (3, 20), "x"), "ema_20") == [None] * 8


def test_ema_skips_leading_missing_and_keeps_short_series_empty():
    x = np.array([np.nan, np.nan, 1.0, 2.0, 3.0])
    assert np.isnan(ema(x, 2)[:3]).all() and ema(x, 2)[3] == 1.5
    assert np.isnan(ema(x, 4)).all() and len(ema(np.array([]), 3)) == 0


def test_warm_up_lengths_rows_and_nulls(spark):
    rng = np.random.default_rng(1)
    n = 30
    rows = [("1", k, float(c), float(c + 1), float(c - 1)) for k, c in enumerate(rng.normal(10, 2, n))]
    df = I.with_kdj(spark.createDataFrame(rows, "code string, day int, close double, high double, low double"), I.series(), 9, 3, 3)
    got = {c: column(df, c) for c in ("rsv", "k", "d", "j")}
    assert [sum(v is None for v in got[c]) for c in ("rsv", "k", "d", "j")] == [8, 10, 12, 12]
    assert all(0 <= v <= 100 for v in got["rsv"] if v is not None)
    assert column(frame(spark, [1, None, 3, 4, 5]).withColumn("m", I.lowest("x", 2, I.series())), "m") == [None, None, None, 3.0, 4.0]
    flat = frame(spark, [5.0] * 4)
    assert column(flat.withColumn("r", I.rsv("x", "x", "x", 2, I.series())), "r") == [None] * 4


def test_short_and_empty_series(spark):
    assert column(frame(spark, [1, 2]).withColumn("s", I.sma("x", 5, I.series())), "s") == [None, None]
    assert frame(spark, []).withColumn("s", I.sma("x", 5, I.series())).count() == 0
    assert with_macd(frame(spark, []), value="x").count() == 0


def test_pct_change_pads_nulls_and_zero(spark):
    assert column(frame(spark, [2, None, 3, 0, 1]).withColumn("p", I.pct_change("x", I.series())), "p") == [0.0, 0.0, 0.5, -1.0, 0.0]


def test_lot_floor_is_that_of_floats(spark):
    df = spark.createDataFrame([(1.0, 0.1), (250.0, 100.0), (99.9, 100.0)], "v double, lot double")
    assert [r[0] for r in df.select(F.col("v") - F.pmod("v", "lot")).collect()] == [pytest.approx(1.0 // 0.1 * 0.1), 200.0, 0.0]
    assert df.limit(1).select(I.lot_floor(F.lit(250.0), 100)).first()[0] == 200.0


OPEN = np.array([3.00, 3.10, 3.05, 2.90, 3.00, 2.95, 3.02])
CHANGE = np.r_[0, OPEN[1:] / OPEN[:-1] - 1]
GOLDEN = {
    ("a", (0, 1, 0, -1, 0, 1, 0)): {1: (32000, 99520, 280.96, 99800.96), 3: (-33900, 97971, 28.8567, 97999.8567), 5: (32000, 94720, -287.8936, 94432.1064), 6: (32000, 96967.5932, -287.8936, 96679.6996)},
    ("b", (0, 1, 0, -1, 0, 1, 0)): {5: (31900, 94424, 8.6984, 94432.6984), 6: (31900, 96664.5695, 8.6984, 96673.2679)},
    ("c", (0, 1, 0, -1, 0, 1, 0)): {3: (-31900, 92191, 839.338, 93030.338), 5: (31800, 94128, 121.51, 94249.51), 6: (31800, 96361.5458, 121.51, 96483.0558)},
    ("a", (0, -1, 0, 1, 0, -1, 0)): {1: (-32100, 99189, 612.622, 99801.622), 3: (34800, 101268, -69.0914, 101198.9086), 6: (-35500, 101893.4237, 112.1686, 102005.5923)},
    ("b", (0, -1, 0, 1, 0, -1, 0)): {1: (-32200, 99498, 303.004, 99801.004), 3: (34700, 100977, 226.8565, 101203.8565), 6: (-35500, 101893.4237, 107.082, 102000.5057)},
    ("c", (0, -1, 0, 1, 0, -1, 0)): {1: (-3.09, 9.5481, 99990.4328, 99999.9809), 3: (34200, 99522, 278.301, 99800.301), 6: (-34100, 97875.0915, 853.329, 98728.4206)},
    ("c", (0, 1, 0, 1, 0, -1, 0)): {3: (32000, 93099.3548, 280.96, 93380.3148), 5: (-31900, 93786, 837.948, 94623.948)},
}


@pytest.mark.parametrize("key", GOLDEN)
def test_ledger_golden(key):
    rows = replay(OPEN, CHANGE, np.array(key[1]), Settings(), RULES[key[0]])
    for k, want in GOLDEN[key].items():
        assert np.allclose(rows[k], want, atol=6e-5)


def test_repeated_side_is_lost_or_held(spark):
    trade = np.array([0, 1, 0, 1, 0, -1, 0])
    assert np.isnan(replay(OPEN, CHANGE, trade, Settings(), RULES["a"])[3:]).all()
    assert not np.isnan(replay(OPEN, CHANGE, trade, Settings(), RULES["d"])).any()
    df = spark.createDataFrame([("1", k, float(o), float(c), int(t)) for k, (o, c, t) in enumerate(zip(OPEN, CHANGE, trade, strict=True))], "code string, day int, open double, open_pct_change double, trade int")
    assert column(with_ledger(df, "b"), "total_asset")[3:] == [None] * 4
    assert with_ledger(df.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(500, 9000), st.sampled_from([0, 0, 0, 1, -1])), min_size=2, max_size=60), st.sampled_from("abcd"))
def test_ledger_properties(rows, rules):
    price = np.array([r[0] for r in rows]) / 1000.0
    change = np.r_[0, price[1:] / price[:-1] - 1]
    trade = np.array([r[1] for r in rows])
    out = replay(price, change, trade, Settings(), RULES[rules])
    ok = ~np.isnan(out[:, 0])
    moving = ok & (out[:, 0] != 0)
    assert np.allclose(out[moving, 1] + out[moving, 2], out[moving, 3])
    assert ok[0] and (np.diff(ok.astype(int)) <= 0).all()  # once lost, lost to the end
    up, down = np.cumprod(1 + change), np.cumprod(1 - change)
    if (np.abs(down) > 1e-6).all() and (np.abs(1 - change) > 1e-6).all() and rules != "c":
        places = np.flatnonzero(trade[1:]) + 1
        total = final_asset(price.tolist(), up.tolist(), down.tolist(), places.tolist(), trade[places].tolist(), Settings(), RULES[rules])
        assert np.isnan(total) == np.isnan(out[-1, 3])
        if not np.isnan(total):
            assert total == pytest.approx(out[-1, 3], rel=1e-6) or any(abs(v / 100 - round(v / 100)) < 1e-6 for v in out[:, 0])


def test_grid_has_780_pairs_and_ties_go_to_the_smaller(spark):
    assert grid_search.pairs(spark).count() == 780
    df = spark.createDataFrame([("1", 10, 20, 5.0), ("1", 5, 30, 5.0), ("1", 5, 20, 5.0), ("2", 5, 20, -1.0)], grid_search.RETURNS_SCHEMA)
    assert sorted(map(tuple, grid_search.best_pairs(df).collect())) == [("1", 5, 20, 5.0), ("2", 5, 20, -1.0)]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6))
def test_one_instrument_alone_equals_its_part_of_all(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(c, k, int(o), int(o), int(o), int(x)) for c in "12" for k, (o, x) in enumerate(rng.integers(900, 1100, (60, 2)))]
    df = spark.createDataFrame(rows, "code string, day int, o long, h long, l long, c long")
    both = signals.average_cross(df.orderBy(F.rand(seed)), 3, 7).where("code = '1'")
    alone = signals.average_cross(df.where("code = '1'"), 3, 7)
    assert sorted(map(str, both.collect())) == sorted(map(str, alone.collect()))


def brute_returns(o, c, fast, slow):
    """One back-test under rules d, row by row."""
    if len(o) <= slow:
        return None
    mean = lambda t, n: sum(c[t - n + 1 : t + 1]) * (fast * slow // n)  # noqa: E731  the averages as whole numbers
    side = {t: np.sign(mean(t, fast) - mean(t, slow)) for t in range(slow - 1, len(o))}
    signal = {t: 1 if side[t - 1] <= 0 < side[t] else -1 if side[t] < 0 <= side[t - 1] else 0 for t in range(slow, len(o))}
    held, worth, cash = 0.0, 0.0, 100_000.0
    for t in range(slow + 1, len(o)):
        trade, price = signal[t - 1], o[t] / 1000
        if trade and trade * held <= 0:
            cash += worth
            own = price + 0.01 * trade
            held = trade * (cash * 0.998 / own // 100 * 100)
            worth = abs(held) * own
            cash -= worth + worth * 0.002
        else:
            worth *= 1 + np.sign(held) * (o[t] / o[t - 1] - 1)
    return worth + cash - 100_000.0


def test_all_pairs_equal_a_walk_row_by_row(spark):
    rng = np.random.default_rng(12)
    rows, want = [], {}
    for code, days in (("1", 230), ("2", 120), ("3", 9)):
        c = np.round(3000 * np.exp(np.cumsum(rng.normal(0, 0.02, days)))).astype(int).tolist()
        o = [max(1, x + int(rng.integers(-20, 20))) for x in c]
        rows += [(code, k, o[k], c[k]) for k in range(days)]
        for s in grid_search.SLOW:
            for f in grid_search.FAST:
                if f < s and (x := brute_returns(o, c, f, s)) is not None:
                    want[code, f, s] = x
    df = spark.createDataFrame(rows, "code string, day int, o long, c long")
    got = {(r["code"], r["period_fast"], r["period_slow"]): r["total_returns"] for r in grid_search.grid_returns(df).collect()}
    assert got.keys() == want.keys() and sum(k[0] == "1" for k in got) == 780
    assert all(got[k] == pytest.approx(want[k], abs=1e-3) for k in want)
    best = {r["code"]: (r["period_fast"], r["period_slow"]) for r in grid_search.best_pairs(grid_search.grid_returns(df)).collect()}
    assert all(got[code, *p] == max(v for k, v in got.items() if k[0] == code) for code, p in best.items())
