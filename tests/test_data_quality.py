"""p1 to p5 on small inputs with nulls, ties, repeated rows, empty tables and further columns."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import fill, profile, regular, rolling, spikes
from barloom.operators import readings as R

BAR = "bar_id long, code string, name string, date timestamp_ntz, open double, high double, low double, close double, load_id long, loaded_at timestamp_ntz"
START = dt.datetime(2021, 1, 4, 15, 0)


def bar(bar_id, code, day, open_, close, name=None, load=1, hour=15, high=None, low=None):
    at = None if day is None else START.replace(hour=hour) + dt.timedelta(days=day)
    return (bar_id, code, name, at, open_, high, low, close, load, START)


def bars(spark, rows):
    return spark.createDataFrame(rows, BAR)


def calendar(spark, closed=()):
    return spark.createDataFrame([(START.replace(hour=0) + dt.timedelta(days=k), int(k not in closed)) for k in range(-5, 400)], "cal_date timestamp_ntz, is_open int")


def listed(spark, *codes):
    return spark.createDataFrame([(c,) for c in codes], "code string")


def market(n_codes=12, days=120, seed=1, **wrong):
    """Clean random walks; rows as tuples of bar."""
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for c in range(n_codes):
        level = 2.0 * 1.6**c
        walk = level * np.exp(np.cumsum(rng.normal(0, 0.008, days + 1)))
        for d in range(days):
            k += 1
            o, cl = round(float(walk[d]), 3), round(float(walk[d + 1]), 3)
            rows.append(bar(k, f"{100000 + c}", d, o, cl, f"fund {c}", 1 + d * 6 // days, high=max(o, cl) + 0.002, low=min(o, cl) - 0.002))
    return rows


def put(rows, bar_id, **values):
    at = {"code": 1, "name": 2, "date": 3, "open": 4, "high": 5, "low": 6, "close": 7, "load_id": 8}
    r = list(rows[bar_id - 1])
    for k, v in values.items():
        r[at[k]] = v
    rows[bar_id - 1] = tuple(r)


def pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ---- stand-ins ---------------------------------------------------------------
def test_stand_ins_recur_over_unrelated_instruments(spark):
    rows = market()
    for c in range(12):
        put(rows, c * 120 + 5, open=99999.999)
    for d in range(10, 20):
        put(rows, d, close=88888.0)  # one instrument only
    df = bars(spark, rows)
    assert R.find_stand_ins(df) == [99999.999]
    assert R.find_stand_ins(df.limit(0)) == []
    assert R.find_stand_ins(df.withColumn("low", F.lit(None).cast("double"))) == []


def test_usable(spark):
    df = spark.createDataFrame([(1.5,), (0.0,), (-2.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (9.0,), (None,)], "v double")
    assert [r[0] for r in df.select(R.usable(F.col("v"), [9.0])).collect()] == [1.5, 0.0, -2.0, None, None, None, None, None]


# ---- p1 ----------------------------------------------------------------------
def test_fill_marks_every_cell_and_leaves_observed_ones(spark):
    rows = market()
    put(rows, 50, open=None)
    put(rows, 51, close=float("nan"), open=None)
    put(rows, 60, code=None)
    put(rows, 61, code=" ", name=None)
    put(rows, 70, code="NA", name=None, date=None)
    for c in range(12):
        put(rows, c * 120 + 5, open=99999.999)
    df = bars(spark, rows).withColumn("value", F.lit("clash")).withColumn("status", F.lit(1)).withColumn("day", F.lit(2))
    out = {(r["bar_id"], r["field"]): r for r in fill.fill_missing(df, [99999.999]).collect()}
    want = {(50, "open"), (51, "close"), (51, "open"), (60, "code"), (61, "code"), (70, "code")} | {(c * 120 + 5, "open") for c in range(12)}
    assert set(out) == want
    assert out[(60, "code")]["value"] == "100000" and out[(61, "code")]["value"] == "100000"
    assert out[(70, "code")]["status"] == "unfilled" and out[(70, "code")]["value"] is None
    clean = {r[0]: r for r in market()}
    for b, f in ((50, "open"), (51, "close"), (51, "open"), (125, "open")):
        assert float(out[(b, f)]["value"]) == pytest.approx(clean[b][4 if f == "open" else 7], rel=0.05)


def test_fill_of_nothing_and_of_all_null_columns(spark):
    empty = bars(spark, [])
    assert fill.fill_missing(empty, []).collect() == []
    rows = [bar(1, None, None, None, None), bar(1, None, None, None, None), bar(2, "100000", 3, None, None)]
    out = fill.fill_missing(bars(spark, rows), [])
    assert sorted((r["bar_id"], r["field"], r["status"]) for r in out.collect()) == sorted([(1, f, "unfilled") for f in ("open", "close", "code")] * 2 + [(2, "open", "unfilled"), (2, "close", "unfilled")])


def relaxed(days, o, c, rounds=60_000):
    """Label propagation by hand: the weighted average of the neighbours, observed values clamped, until nothing moves."""
    value, edges = {}, []
    for k, d in enumerate(days):
        value[k, "o"], value[k, "c"] = o[k], c[k]
        edges.append(((k, "o"), (k, "c"), 1 / fill.WITHIN))
        if k:
            edges.append(((k - 1, "c"), (k, "o"), 1 / (fill.OVERNIGHT + (d - days[k - 1] - 1) * (fill.WITHIN + fill.OVERNIGHT))))
    fixed = {n for n, v in value.items() if v is not None}
    known = [v for v in value.values() if v is not None]
    value = {n: v if v is not None else sum(known) / len(known) for n, v in value.items()}
    free = [n for n in value if n not in fixed]
    around = {n: [(a if b == n else b, w) for a, b, w in edges if n in (a, b)] for n in free}
    for _ in range(rounds):
        moved = 0.0
        for n in free:
            new = sum(value[x] * w for x, w in around[n]) / sum(w for _, w in around[n])
            moved, value[n] = max(moved, abs(new - value[n])), new
        if moved < 1e-13:
            break
    return [(value[k, "o"], value[k, "c"]) for k in range(len(days))]


def test_propagation_has_converged(spark):
    rng = np.random.default_rng(8)
    for _ in range(4):
        days = sorted(rng.choice(60, 14, replace=False).tolist())
        o = [None if rng.random() < 0.6 else float(round(rng.uniform(5, 9), 3)) for _ in days]
        c = [None if rng.random() < 0.6 else float(round(rng.uniform(5, 9), 3)) for _ in days]
        c[5] = 7.0
        df = spark.createDataFrame([("1", dt.date(2021, 1, 1) + dt.timedelta(days=d), a, b) for d, a, b in zip(days, o, c, strict=True)], "code string, day date, o double, c double")
        got = [(r["o"], r["c"]) for r in fill.propagate_states(df).orderBy("day").collect()]
        want = [x for x, a, b in zip(relaxed(days, o, c), o, c, strict=True) if a is None or b is None]
        assert np.allclose(got, want, atol=1e-6)


def test_a_long_gap_is_a_line(spark):
    for gap in (10, 40, 300):
        rows = [("1", dt.date(2021, 1, 1) + dt.timedelta(days=k), x, x) for k, x in enumerate([10.0] + [None] * gap + [20.0])]
        got = [r["o"] for r in fill.propagate_states(spark.createDataFrame(rows, "code string, day date, o double, c double")).orderBy("day").collect()]
        assert len(got) == gap and np.allclose(np.diff(got), (got[-1] - got[0]) / (gap - 1)) and got[0] < 10 + 20 / gap and got[-1] > 20 - 20 / gap
    alone = spark.createDataFrame([("1", dt.date(2021, 1, 1), None, None), ("2", dt.date(2021, 1, 1), None, 3.0)], "code string, day date, o double, c double")
    assert sorted(map(tuple, fill.propagate_states(alone).select("code", "o", "c").collect())) == [("1", None, None), ("2", 3.0, 3.0)]


# ---- p2 ----------------------------------------------------------------------
def readings(spark, rows, codes, *cols):
    return R.readings(bars(spark, rows), listed(spark, *codes), calendar(spark), *cols)


def test_spikes_units_stuck_and_limits(spark):
    rows = market(days=150)
    put(rows, 30, open=rows[29][4] * 1.4)
    put(rows, 300, close=0.0)
    put(rows, 301, close=-3.0)
    for d in range(40, 100):
        put(rows, 450 + d, open=rows[449 + d][4] * 100)  # a long stretch of one field in another unit
    for d in range(21, 28):
        put(rows, 600 + d, close=rows[619][7])
    for d in range(50, 90):
        r = rows[1050 + d - 1]
        put(rows, 1050 + d, open=r[4] / 10, close=r[7] / 10)  # both fields for long
    for d in range(75, 150):
        r = rows[750 + d]
        put(rows, 751 + d, open=r[4] / 2, close=r[7] / 2)  # a split
    again = list(rows[29])
    again[0] = 99_999
    rows += [tuple(again), bar(99_998, "100001", 10, None, float("nan")), bar(99_997, "999999", 10, -1.0, -1.0), bar(99_996, "100001", None, -1.0, -1.0)]
    codes = [f"{100000 + c}" for c in range(12)]
    scored = spikes.score_readings(readings(spark, rows, codes, "open", F.when(~F.isnan("close"), F.col("close")).alias("close")))
    got = {(r["bar_id"], r["field"]): r["rule"] for r in scored.where("rule is not null").collect()}
    want = {(30, "open"): "excursion", (99_999, "open"): "excursion", (300, "close"): "limit", (301, "close"): "limit"}
    want |= {(450 + d, "open"): "unit" for d in range(40, 100)} | {(600 + d, "close"): "stuck" for d in range(21, 28)}
    want |= {(1050 + d, f): "unit" for d in range(50, 90) for f in ("open", "close")}
    assert got == want
    assert scored.where("score is null").count() == 0
    few = spikes.score_readings(readings(spark, rows, codes, "open", F.when(~F.isnan("close"), F.col("close")).alias("close")), block_rows=20, only_flagged=True)
    assert {(r["bar_id"], r["field"]): r["rule"] for r in few.collect()} == want  # salted groups


def test_quiet_instruments_are_not_stuck_and_small_tables_work(spark):
    rows = [bar(k + 1, "100000", k, 100.001 + (k // 10) * 0.001, 100.001 + (k // 10) * 0.001) for k in range(80)]
    assert spikes.score_readings(readings(spark, rows, ["100000"], "open", "close"), only_flagged=True).count() == 0
    one = readings(spark, rows[:1], ["100000"], "open", "close")
    assert spikes.score_readings(one).count() == 2
    assert spikes.score_readings(one.limit(0)).count() == 0
    nulls = readings(spark, [bar(1, "100000", 1, None, None)], ["100000"], "open", "close")
    assert spikes.score_readings(nulls).count() == 0


def test_forest_isolates_what_is_far():
    rng = np.random.default_rng(0)
    x, far = np.abs(rng.normal(0, 1, (500, 4))), np.array([[9.0, 9.0, 0.0, 0.0]])
    s = spikes.forest_scores(spikes.grow_forest(x, 1, np.repeat(far, 8, axis=0)), np.r_[x, far])
    assert s[-1] == s.max() and s[-1] > 0.6 and np.median(s) < 0.5
    same = np.ones((20, 4))
    assert np.allclose(spikes.forest_scores(spikes.grow_forest(same, 1), same), spikes.forest_scores(spikes.grow_forest(same, 1), same)[0])


def test_scores_equal_a_walk_down_every_tree():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (90, 4)).astype(np.float32)
    forest = spikes.grow_forest(x, 5)
    total = np.zeros(len(x))
    for t in range(len(forest["feature"])):
        for k, row in enumerate(x):
            node = 0
            for _ in range(forest["depth"]):
                node = 2 * node + 1 + int(row[forest["feature"][t, node]] >= forest["cut"][t, node])
            total[k] += forest["path"][t, node - (2 ** forest["depth"] - 1)]
    assert np.allclose(spikes.forest_scores(forest, x, chunk=7), 2 ** (-total / len(forest["feature"]) / forest["norm"]), atol=1e-5)


def history(days=400, seed=0, move=0.01):
    rng = np.random.default_rng(seed)
    walk = 5 * np.exp(np.cumsum(rng.normal(0, move, days)))
    h = {"day": np.arange(18000, 18000 + days)}
    return h | {f"{f}_{w}": np.round(walk * (1.001 if f == "open" else 1.0), 3) for f in spikes.FIELDS for w in ("least", "most")}


def test_the_score_decides():
    """Among readings that pass the exact check the forest tells errors from moves of the market; without it all are flagged."""
    flagged = constant = errors = 0
    for seed in range(12):
        h = history(seed=seed)
        for d, size in ((50, 9.0), (120, 10.0), (200, 11.0), (280, 30.0), (340, 45.0)):
            move = float(np.median(np.abs(np.diff(np.log(h["close_least"])))))
            for w in ("least", "most"):
                h[f"close_{w}"] = h[f"close_{w}"].copy()
                h[f"close_{w}"][d] *= np.exp(size * move)
        m = spikes.source_model(h)
        prices = {f: h[f"{f}_least"] for f in spikes.FIELDS}
        rules = lambda model: dict((f, rule) for f, _, _, rule in spikes.judge(h["day"], prices, model))
        mine, loose = rules(m), rules(m | {"limits": dict.fromkeys(spikes.SLACK, 0.0)})
        assert {280, 340} <= set(np.flatnonzero(mine["close"])) and not np.any(mine["open"])
        flagged += int((mine["close"] > 0).sum())
        constant += int((loose["close"] > 0).sum())
        errors += 2
    assert flagged <= 1.2 * errors and constant >= 1.5 * errors


def test_held_out_planted_errors_are_recalled():
    rng = np.random.default_rng(1)
    for seed in (1, 2, 3):
        m = spikes.source_model(history(seed=seed))
        for kind, x in zip(spikes.SLACK, spikes._plant(m, 500, rng, spikes.MOST_EXCURSION, spikes.MOST_STUCK), strict=True):
            assert np.mean(spikes.forest_scores(m["forest"], x) >= m["limits"][kind]) > 0.9


def test_sources_without_a_positive_price_offend_limits_only(spark):
    rows = [bar(k + 1, "100000", k, 0.0, -1.0 if k else None) for k in range(4)]
    out = spikes.score_readings(readings(spark, rows, ["100000"], "open", "close")).collect()
    assert len(out) == 7 and all(r["score"] is None and r["rule"] == "limit" for r in out)


# ---- p3 ----------------------------------------------------------------------
def brute_grid(rows, closed, limit_days=9):
    """(code, day) -> has a reading, for open days from the first to the last."""
    seen = {}
    for r in rows:
        if r[1] is not None and r[3] is not None:
            d = (r[3] - START.replace(hour=0)).days
            if d not in closed:
                seen.setdefault(r[1], set()).add(d)
    return {c: [d for d in range(min(s), max(s) + 1) if d not in closed and d not in s] for c, s in seen.items()}


def test_regular_grid(spark):
    closed = {5, 6, 12, 13}
    rows = [
        bar(1, "100000", 0, 10.0, 1.0), bar(2, "100000", 1, None, 1.0), bar(3, "100000", 3, 13.0, 1.0, hour=9), bar(4, "100000", 3, 14.0, 1.0, hour=15), bar(5, "100000", 3, 14.5, 1.0, hour=15, load=2),
        bar(6, "100000", 40, 20.0, 1.0), bar(7, "100000", 5, 99.0, 1.0), bar(8, None, 2, 5.0, 1.0), bar(9, "100001", 7, 3.0, 1.0), bar(10, "100000", None, 1.0, 1.0),
    ]
    rd = R.readings(bars(spark, rows), listed(spark, "100000", "100001"), calendar(spark, closed), "open")
    out = {(r["code"], r["day"]): r for r in regular.regular_series(rd, calendar(spark, closed)).collect()}
    day = lambda k: (START + dt.timedelta(days=k)).strftime("%Y-%m-%d")
    assert out[("100000", day(0))]["value"] == 10.0 and out[("100000", day(0))]["status"] == "observed"
    assert out[("100000", day(1))]["status"] == "observed_without_value"
    assert out[("100000", day(2))]["status"] == "filled"
    assert out[("100000", day(1))]["value"] == pytest.approx(10 + 3 * 24 / 66) and out[("100000", day(2))]["value"] == pytest.approx(10 + 3 * 48 / 66)
    assert out[("100000", day(3))]["value"] == 14.5  # the later delivery of the tie
    assert out[("100000", day(20))]["status"] == "gap" and out[("100000", day(20))]["value"] is None
    assert out[("100001", day(7))]["value"] == 3.0 and len([k for k in out if k[0] == "100001"]) == 1
    want = brute_grid([r for r in rows if r[1] in ("100000", "100001")], closed)
    got = regular.missing_days(regular.regular_series(rd, calendar(spark, closed)))
    assert pairs(got, "code", "day") == sorted((c, day(d)) for c, ds in want.items() for d in ds)
    assert regular.regular_series(rd.limit(0), calendar(spark)).count() == 0


# ---- p4 ----------------------------------------------------------------------
@pytest.mark.parametrize("period", [*range(1, 34), 64, 90, 250, 1000])
def test_blocks_cover_a_period_once(period):
    days = [d for block, shift in rolling.shifted_blocks(period) for d in range(shift, shift + block)]
    assert sorted(days) == list(range(period))


def test_rolling_equals_pandas(spark):
    rng = np.random.default_rng(4)
    rows = [bar(k + 1, c, int(d), 1.0, round(float(v), 3) if v > -0.5 else None, hour=int(hh)) for k, (c, d, v, hh) in enumerate(zip(rng.choice(["100000", "100001"], 90), rng.integers(0, 120, 90), rng.normal(1, 1, 90), rng.integers(9, 16, 90), strict=True))]
    rows.append((500, *rows[0][1:]))  # delivered again: counts once
    rd = R.readings(bars(spark, rows), listed(spark, "100000", "100001"), calendar(spark), "close")
    got = rolling.rolling_totals(rd, periods=(7, 30, 3, 50)).toPandas()
    p = pd.DataFrame(rows, columns=[x.split()[0] for x in BAR.split(", ")]).dropna(subset=["close"]).sort_values("bar_id").drop_duplicates(["code", "date"], keep="last")
    for code, g in p.groupby("code"):
        daily = g.groupby(g.date.dt.floor("D")).close.agg(["sum", "count"]).asfreq("D", fill_value=0)
        mine = got[got.code == code].sort_values("day", ignore_index=True)
        assert list(mine.day) == [d.strftime("%Y-%m-%d") for d in daily.index]
        for n in (3, 7, 30, 50):
            assert np.allclose(mine[f"total_{n}"], daily["sum"].rolling(n, min_periods=1).sum(), atol=1e-9)
            assert (mine[f"n_{n}"].to_numpy() == daily["count"].rolling(n, min_periods=1).sum().to_numpy()).all()
            assert (mine[f"avg_{n}"].isna() == (mine[f"n_{n}"] == 0)).all()
    assert rolling.rolling_totals(rd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        rolling.shifted_blocks(0)


# ---- p5
def test_masks(spark):
    df = spark.createDataFrame([(-12.5, dt.datetime(2020, 1, 1)), (100.123, dt.datetime(2020, 1, 1, 15, 2)), (12_345_678.25, None), (0.00012, None), (0.0, None), (None, None)], "v double, t timestamp_ntz")
    got = df.select(profile.value_mask(F.col("v")), profile.fraction_mask(F.col("v")), profile.time_mask(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("-99.9", ".9", "midnight"), ("999.999", ".999", "15h"), ("99999999.99", ".99", None), ("9.99999", ".99999", None), ("9.9", ".9", None), (None, None, None)]
    texts = spark.createDataFrame([("Fund 012",), ("红利ETF01",), ("a\t b-C",), ("",), ("Ångström",), (None,)], "s string")
    assert [r[0] for r in texts.select(profile.text_mask(F.col("s"))).collect()] == ["Aa 999", "字A99", "a a-A", "", "Aa", None]


def test_changed_loads_are_found_and_a_changed_mix_is_not(spark):
    rows = market(days=360)  # six loads of 60 days
    rng = np.random.default_rng(2)
    for r in list(rows):
        k, load = r[0], r[8]
        if load == 2 and rng.random() < 0.3:
            put(rows, k, open=None)
        if load == 3 and rng.random() < 0.4:
            put(rows, k, close=round(r[7] * 100, 3))
        if load == 4:
            put(rows, k, date=r[3].replace(hour=7))
        if load == 5 and rng.random() < 0.6:
            put(rows, k, open=round(r[4], 1))
    rows = [r for r in rows if not (r[8] == 6 and r[1] > "100004")]  # another mix
    df = bars(spark, rows)
    found = profile.divergent_loads(df, [])
    assert pairs(found, "load_id", "field", "mask") == [(2, "open", "missing"), (3, "close", "e+2"), (4, "date", "7h"), (5, "open", ".9")]
    shares = {r["load_id"]: r["share"] for r in found.collect()}
    assert shares[2] == pytest.approx(0.3, abs=0.05) and shares[3] == pytest.approx(0.4, abs=0.05) and shares[4] > 0.9 and shares[5] == pytest.approx(0.6, abs=0.1)
    assert profile.divergent_loads(df.limit(0), []).count() == 0
    assert profile.divergent_loads(df.where("load_id = 1"), []).count() == 0
    lost = df.withColumn("load_id", F.when(F.col("load_id") != 4, F.col("load_id")))
    assert pairs(profile.changed_columns(profile.divergent_loads(lost, [])).where("field = 'date'"), "load_id", "field") == [(None, "date")]


def test_divergence_equals_the_plain_sum():
    rng = np.random.default_rng(6)
    seen = rng.integers(0, 40, (5, 6)).astype(float)
    stratum, mask, pool = np.array([0, 0, 0, 1, 1, 1]), np.array([0, 1, 2, 0, 1, 3]), np.array([True, True, False, True, True])
    share, most = profile.divergence(seen, stratum, mask, pool)
    for k in range(5):
        others = [j for j in range(5) if pool[j] and j != k]
        expected, got = np.zeros(4), np.zeros(4)
        for c in range(6):
            mine = seen[k, stratum == stratum[c]].sum()
            expected[mask[c]] += mine * seen[others, c].sum() / seen[others][:, stratum == stratum[c]].sum()
            got[mask[c]] += seen[k, c]
        chance = np.sqrt(2 / np.pi * expected * (1 - expected / got.sum())).sum() / 2
        assert share[k] == pytest.approx((np.abs(got - expected).sum() / 2 - chance) / got.sum()) and most[k] == np.argmax(got - expected)


def test_loads_of_chance_do_not_diverge_whatever_their_size():
    rng = np.random.default_rng(9)
    sizes = np.array([30, 60, 100, 1000, 20_000] * 40)
    seen = np.stack([rng.multinomial(n, [0.5, 0.3, 0.15, 0.05]) for n in sizes]).astype(float)
    share, _ = profile.divergence(seen, np.zeros(4, int), np.arange(4), np.ones(len(sizes), bool))
    assert abs(share.mean()) < 0.01 and np.mean(share > profile.LEAST_SHARE) < 0.06 and not np.any(share[sizes >= 1000] > 0.02)


def test_profile_counts(spark):
    rows = [bar(1, "100000", 0, 1.5, None), bar(2, None, 1, float("nan"), 2.25), bar(2, None, 1, float("nan"), 2.25), bar(3, "x", None, 99.0, -1.0)]
    df = bars(spark, rows).withColumn("field", F.lit("clash")).withColumn("mask", F.lit(1)).withColumn("a.b", F.lit("Q 1"))
    for exact in (False, True):
        out = {(r["load_id"], r["field"]): r for r in profile.column_profile(df, ("open", "close", "date", "code", "a.b", "name"), stand_ins={"open": [99.0]}, exact=exact).collect()}
        o, c, d, code = out[(1, "open")], out[(1, "close")], out[(1, "date")], out[(1, "code")]
        assert (o["rows"], o["null_rate"], o["distinct_values"], o["least"], o["largest"]) == (4, 0.75, 1, 1.5, 1.5)
        assert (c["null_rate"], c["distinct_values"], c["least"], c["dominant_mask"]) == (0.25, 2, -1.0, "9.99")
        assert d["null_rate"] == 0.25 and d["dominant_mask"] == "9999-99-99 99:99:99"
        assert (code["null_rate"], code["distinct_values"], code["dominant_mask"], code["least"]) == (0.5, 2, "a", None)
        assert out[(1, "a.b")]["dominant_mask"] == "A 9" and (out[(1, "name")]["null_rate"], out[(1, "name")]["distinct_values"], out[(1, "name")]["dominant_mask"]) == (1.0, 0, None)
    assert profile.column_profile(df.limit(0)).count() == 0
