"""Implausible spikes, stuck values and impossible readings, per source.

One isolation forest is fitted for every source (instrument) on four features
of a reading: level (distance from the source's own level around that day),
difference (distance from the levels just before and just after, on the nearer
side), seasonal (distance relative to the usual move of that weekday) and run
length (days on which the same value repeats).  Every reading is scored.

The score decides.  Each source's forest is calibrated on errors planted among
its own ordinary days: some, of all sizes, are in the forest's sample, others,
of the least size that matters, are held out and give the score from which a
reading is flagged.  What the forest flags must then pass an exact check that
is looser than the planted errors (it leaves both sides and returns by at least
half as much, or is a run of six days of a source that seldom repeats its
price).  Beside that stand the explicit physical limits: zero and negative.

Scale: readings are first reduced to at most one row per source and day with
map-side partial aggregates (count, least and largest value of each field), so
a source's history is bounded by the days of the calendar however many
readings it has.  The model of a source is built from that bounded history;
readings are scored in salted groups of at most about ``block_rows`` rows, so a
source holding a third of all rows is spread over as many tasks as it needs.

Defined results: null, NaN and stand-in prices are never scored or flagged;
rows whose source or day is not known are ignored; ties and repeated rows are
each scored; a source that never had a positive price has no forest, so its
readings have a null score and offend the limits only; an empty table gives an
empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("open", "close")
#: The smallest and largest planted excursion, in robust day moves.  The exact check asks for half the smallest,
#: and half as much again of excursions of more than LONG_DAYS days, which may be moves of the market.
EXCURSION, MOST_EXCURSION, LONG_DAYS = 14.0, 60.0, 2
#: A stuck run has at least this many days of readings; planted ones up to MOST_STUCK.
STUCK_DAYS, MOST_STUCK = 6, 14
#: Sources that repeat their price on more than this share of days are quiet, not stuck.
QUIET_SHARE = 0.25
#: Trees of a forest, rows of each one's sample, levels.
TREES, SAMPLE, DEPTH = 48, 64, 5
#: Share of planted errors in the sample; number of held-out ones of each kind.
PLANTED, HELD_OUT = 0.02, 64
#: A reading is flagged from the score that all but this share of the held-out errors reach, less this part of the
#: way down to the median of the source (runs are scored closer together than excursions are).
MISSED, SLACK = 0.05, {"spike": 0.0, "stuck": 0.15}
HALF, SIDE = 10, 2
#: Logarithmic distance within which the prices of a day agree.
ALIKE = 0.3
#: A stretch in another unit has at most this many days of readings; a longer one is a lasting change.
UNIT_DAYS = 90
RULES = (None, "stuck", "excursion", "unit", "limit")
RULE_NAMES = pa.array(RULES)
FOUND = pa.schema([("bar_id", pa.int64()), ("code", pa.string()), ("day", pa.date32()), ("field", pa.string()), ("value", pa.float64()), ("score", pa.float64()), ("rule", pa.string())])
FOUND_SCHEMA = "bar_id long, code string, day date, field string, value double, score double, rule string"


def _sides(values: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each day the medians of the last and of the next ``half`` days that have a value
    (the day itself left out), and the places of the nearest of them (-1 and days: none)."""
    days = len(values)
    have = ~np.isnan(values).all(axis=1)
    places = np.flatnonzero(have)
    before = np.searchsorted(places, np.arange(days), "left")
    after = np.searchsorted(places, np.arange(days), "right")
    left, right = np.full(days, np.nan), np.full(days, np.nan)
    if len(places):
        v = values[places]
        k = v.shape[1]
        pad = np.full((half, k), np.nan)
        w = np.lib.stride_tricks.sliding_window_view(np.concatenate([pad, v, pad]), half, axis=0).reshape(-1, half * k)
        med = _row_nanmedian(w)
        left = med[before]  # the half values before place `before`
        right = med[np.minimum(after + half, len(med) - 1)]
    near_l = np.where(before > 0, places[np.maximum(before - 1, 0)] if len(places) else -1, -1)
    near_r = np.where(after < len(places), places[np.minimum(after, len(places) - 1)] if len(places) else days, days)
    return left, right, near_l, near_r


def _row_nanmedian(w: np.ndarray) -> np.ndarray:
    w = np.sort(w, axis=1)
    n = np.sum(~np.isnan(w), axis=1)
    at, last = np.arange(len(w)), w.shape[1] - 1
    out = (w[at, np.maximum((n - 1) // 2, 0)] + w[at, np.minimum(n // 2, last)]) / 2
    out[n == 0] = np.nan
    return out


def grow_forest(x: np.ndarray, seed: int, planted: np.ndarray | None = None, trees: int = TREES, sample: int = SAMPLE, depth: int = DEPTH) -> dict:
    """An isolation forest on the rows of ``x``, all trees grown together level by level.

    Each tree gets a subsample, rows of ``planted`` among it in the share they have of both."""
    rng = np.random.default_rng(seed)
    x = x if planted is None else np.concatenate([x, planted])
    rows, dims = x.shape
    size = min(sample, rows)
    s = x[rng.integers(0, rows, (trees, size))]  # trees, size, dims
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int8)
    cut = np.full((trees, nodes), np.inf)
    node = np.zeros((trees, size), np.int64)
    tree = np.arange(trees)[:, None]
    for level in range(depth):
        first, width = 2**level - 1, 2**level
        key = (tree * width + node - first).ravel()
        live = ((node >= first) & (node < first + width)).ravel()
        key = key[live]
        order = np.argsort(key, kind="stable")
        k = key[order]
        if not len(k):
            break
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        v = s.reshape(-1, dims)[np.flatnonzero(live)[order]]
        lo, hi = np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)
        room = hi - lo
        splits = (room > 1e-12).any(axis=1)
        choice = np.argmax(np.where(room > 1e-12, rng.random(room.shape), -1.0), axis=1)
        here = np.arange(len(starts))
        at = lo[here, choice] + room[here, choice] * rng.random(len(starts))
        t, n = k[starts] // width, k[starts] % width + first
        feature[t[splits], n[splits]] = choice[splits]
        cut[t[splits], n[splits]] = at[splits]
        f = np.take_along_axis(feature, node, 1)
        move = (f >= 0) & (node >= first)
        value = np.take_along_axis(s, np.maximum(f, 0)[..., None].astype(np.int64), 2)[..., 0]
        node = np.where(move, 2 * node + 1 + (value >= np.take_along_axis(cut, node, 1)), node)
    counts = np.zeros((trees, nodes))
    np.add.at(counts, (np.broadcast_to(tree, node.shape), node), 1)
    deep = np.floor(np.log2(np.arange(nodes) + 1))
    path = np.where(counts > 0, deep + _average_path(counts), deep)
    # what a leaf above the last level says is handed down on the left, where an infinite cut leads
    for n in range(2**depth - 1):
        leaf = feature[:, n] < 0
        path[leaf, 2 * n + 1] = path[leaf, n]
    last = 2**depth - 1
    return {"feature": np.maximum(feature[:, :last], 0), "cut": cut[:, :last].astype(np.float32), "path": path[:, last:].astype(np.float32), "norm": max(float(_average_path(np.array([float(size)]))[0]), 1e-9), "depth": depth}


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n keys, the usual correction for leaves."""
    with np.errstate(divide="ignore", invalid="ignore"):
        big = 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def forest_scores(forest: dict, x: np.ndarray, chunk: int = 1024) -> np.ndarray:
    """2 ** (-mean path / norm): near 1 is lonely, 0.5 and less is ordinary."""
    trees, last = forest["feature"].shape
    feature, cut, path = forest["feature"].astype(np.int32).ravel(), forest["cut"].ravel(), forest["path"].ravel()
    first, leaf = (np.arange(trees, dtype=np.int32) * last)[:, None], (np.arange(trees, dtype=np.int32) * (last + 1) - last)[:, None]
    total = np.empty(len(x), np.float32)
    for a in range(0, len(x), chunk):
        part = x[a : a + chunk].astype(np.float32)
        flat, rows = part.ravel(), np.arange(len(part), dtype=np.int32) * np.int32(part.shape[1])
        node = np.zeros((trees, len(part)), np.int32)
        for _ in range(forest["depth"]):
            at = first + node
            right = flat.take(feature.take(at) + rows) >= cut.take(at)
            node += node
            node += 1
            node += right
        total[a : a + chunk] = path.take(leaf + node).mean(axis=0)
    return 2.0 ** (-total.astype(float) / forest["norm"])


def _features(lv: np.ndarray, d: np.ndarray, m: dict, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of readings with logarithm ``lv`` at history places ``d``; their excursions; their levels."""
    level, s = m["level"][d], m["scale"]
    off = lv - level
    a, b = (lv - m["left"][d]) / (s * m["gap_l"][d]), (lv - m["right"][d]) / (s * m["gap_r"][d])
    one = np.where(np.isnan(a), b, a)
    other = np.where(np.isnan(b), a, b)
    same = np.sign(one) == np.sign(other)
    exc = np.where(same, np.minimum(np.abs(one), np.abs(other)), 0.0)
    exc = np.where(np.isnan(exc), 0.0, exc)
    z = np.abs(np.where(np.isnan(off), 0.0, off)) / s
    x = np.stack([np.log1p(z), np.log1p(exc), np.log1p(z / m["season"][(m["day"][d] + 3) % 7]), np.log1p(run)], axis=1)
    return x, exc, level


def source_model(h: dict[str, np.ndarray]) -> dict:
    """The model of one source from its history: a row a day (number of the day) and for each field the
    least and the largest of its positive usable values (NaN: none)."""
    order = np.argsort(h["day"], kind="stable")
    h = {k: v[order] for k, v in h.items()}
    days = len(order)
    with np.errstate(invalid="ignore"):
        stack = np.log(np.stack([h[f"{f}_{k}"] for f in FIELDS for k in ("least", "most")], axis=1))
    base = _base_level(stack)
    reps = []
    for k in range(len(FIELDS)):
        cand = stack[:, 2 * k : 2 * k + 2]
        gap = np.abs(cand - base[:, None])
        gap[np.isnan(gap)] = np.inf
        reps.append(cand[np.arange(days), np.argmin(gap, axis=1)])
    both = np.stack(reps, axis=1)
    level = _level(both, base, ALIKE)
    moves = np.abs(np.diff(both, axis=0)).ravel()
    moves = moves[~np.isnan(moves)]
    tick = 0.001 / np.exp(np.nanmedian(level)) if np.isfinite(level).any() else 1e-4
    scale = max(float(np.median(moves)) if len(moves) else 0.0, tick)
    with np.errstate(invalid="ignore"):
        clean = np.where(np.abs(both - level[:, None]) < max(12 * scale, 3e-3), both, np.nan)
    level = _level(clean, level, np.inf)
    date = h["day"]
    left, right, near_l, near_r = _sides(clean, SIDE)
    padded = np.r_[date, date[-1]]
    gap_l = np.sqrt(np.clip((date - np.where(near_l >= 0, date[near_l], date)) / 4.0, 1, None))
    gap_r = np.sqrt(np.clip((np.where(near_r < days, padded[np.minimum(near_r, days)], date) - date) / 4.0, 1, None))
    small = lambda v: v.astype(np.float32)
    m = {"day": date, "level": small(level), "left": small(left), "right": small(right), "gap_l": small(gap_l), "gap_r": small(gap_r), "scale": scale}
    move = np.abs(np.diff(np.nan_to_num(level, nan=0.0), prepend=level[:1]))
    usual = np.median(move) or scale
    weekday = (date + 3) % 7
    season = np.ones(7)
    for k in range(7):
        mine = weekday == k
        if n := mine.sum():  # few such days say little
            season[k] = np.clip((n * (np.median(move[mine]) or usual) + 8 * usual) / (n + 8) / usual, 0.5, 2.0)
    m["season"] = season
    xs, plain = [], []
    for k, f in enumerate(FIELDS):
        one = _run_values(h[f"{f}_least"], h[f"{f}_most"])
        n = ~np.isnan(stack[:, 2 * k])  # days without a usable value do not break a run
        v = one[n]
        same = np.r_[False, v[1:] == v[:-1]] if len(v) else np.zeros(0, bool)
        rid = np.cumsum(~same)
        run = np.ones(days, np.int16)
        later = np.zeros(days, bool)
        run[n], later[n] = np.bincount(rid)[rid] if len(v) else 0, same
        m[f + "_run"], m[f + "_later"], m[f + "_one"] = run, later, np.where(run > 1, one, np.nan)
        m[f + "_quiet"] = float(same.mean()) if len(v) > 1 else 0.0
        away = np.where(np.isnan(clean[:, k]), np.nan_to_num(np.sign(both[:, k] - level)), 0.0)
        stretch = np.cumsum(np.r_[True, away[1:] != away[:-1]])
        m[f + "_need"] = np.where((away != 0) & (np.bincount(stretch)[stretch] > LONG_DAYS), 0.75 * EXCURSION, 0.5 * EXCURSION).astype(np.float32)
        for w in ("least", "most"):
            at = np.flatnonzero(n)
            value = h[f"{f}_{w}"][at]
            length = np.where(m[f + "_one"][at] == value, run[at], 1.0)
            x, excursion, _ = _features(np.log(value), at, m, length)
            xs.append(x)
            plain.append((excursion < EXCURSION) & ((length < STUCK_DAYS) | (m[f + "_quiet"] > QUIET_SHARE)))
    return {**m, **_calibrated(np.concatenate(xs), np.concatenate(plain), m)}


def _plant(m: dict, n: int, rng: np.random.Generator, most: float, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of ``n`` spikes (from EXCURSION to ``most``) and of ``n`` stuck readings (from STUCK_DAYS to
    ``longest`` days) planted on days of the source."""
    days = np.flatnonzero(np.isfinite(m["level"]))
    sided = days[np.isfinite(m["left"][days]) & np.isfinite(m["right"][days])]
    d = rng.choice(sided if len(sided) else days, n)
    level = m["level"][d]
    left, right = (np.where(np.isnan(m[k][d]), level, m[k][d]) for k in ("left", "right"))
    up = rng.random(n) < 0.5
    size = np.exp(rng.uniform(np.log(EXCURSION), np.log(most), n)) * m["scale"] * np.maximum(m["gap_l"][d], m["gap_r"][d])
    spikes = _features(np.where(up, np.maximum(left, right) + size, np.minimum(left, right) - size), d, m, np.ones(n))[0]
    d = rng.choice(days, n)
    stuck = _features(m["level"][d] + m["scale"] * rng.normal(0, 1, n), d, m, rng.integers(STUCK_DAYS, longest + 1, n).astype(float))[0]
    return spikes, stuck


def _calibrated(x: np.ndarray, plain: np.ndarray, m: dict) -> dict:
    """The forest of a source and the scores from which it flags spikes and stuck readings.

    Grown on the plain readings, so that a long stretch of wrong ones does not pass for the source's
    habit, and on planted errors, so that it knows their range."""
    if not len(x):
        return {"forest": None, "limits": {}}
    rng = np.random.default_rng(int(m["day"][0]))
    planted = np.concatenate(_plant(m, max(1, round(len(x) * PLANTED)), rng, MOST_EXCURSION, MOST_STUCK))
    forest = grow_forest(x[plain], int(m["day"][0]), planted)
    usual = float(np.median(forest_scores(forest, x[plain] if plain.any() else x)))
    limits = {}
    for kind, errors in zip(SLACK, _plant(m, HELD_OUT, rng, 1.5 * EXCURSION, MOST_STUCK), strict=True):
        low = float(np.quantile(forest_scores(forest, errors), MISSED))
        limits[kind] = low - SLACK[kind] * (low - usual)
    return {"forest": forest, "limits": limits}


def _base_level(stack: np.ndarray) -> np.ndarray:
    """The level of each day from the days around on which all prices agree.

    A stretch on which one field is in another unit, however long, has no such day and takes the
    level of the nearest one."""
    days = len(stack)
    with np.errstate(invalid="ignore"):
        spread = np.fmax.reduce(stack, axis=1) - np.fmin.reduce(stack, axis=1)
    agree = np.flatnonzero(spread < ALIKE)
    if not len(agree):
        agree = np.flatnonzero(~np.isnan(spread))
    if not len(agree):
        return np.full(days, np.nan)
    level = _row_nanmedian(_windows(_in_one_unit(stack[agree]), HALF))
    after = np.clip(np.searchsorted(agree, np.arange(days)), 0, len(agree) - 1)
    before = np.maximum(after - 1, 0)
    nearer = np.where(np.abs(agree[before] - np.arange(days)) <= np.abs(agree[after] - np.arange(days)), before, after)
    return level[np.where(agree[after] == np.arange(days), after, nearer)]


def _in_one_unit(stack: np.ndarray) -> np.ndarray:
    """The rows with stretches in another unit, of up to UNIT_DAYS days, put back: a jump by a power of ten
    and, later, the same jump back enclose one.  A jump that is not taken back is a lasting change."""
    tens = np.diff(_row_nanmedian(stack)) / np.log(10.0)
    jumps = np.flatnonzero((np.abs(tens) > 0.88) & (np.abs(tens - np.round(tens)) < 0.12))
    opened: list[tuple[int, int]] = []
    out = stack
    for at in jumps.tolist():
        size = int(np.round(tens[at]))
        if opened and opened[-1][1] == -size and at - opened[-1][0] <= UNIT_DAYS:
            first, up = opened.pop()
            if out is stack:
                out = stack.copy()
            out[first + 1 : at + 1] -= up * np.log(10.0)
        else:
            opened.append((at, size))
    return out


def _level(both: np.ndarray, base: np.ndarray, within: float) -> np.ndarray:
    """Median of the values around that are not far from the base; where there is none, the base."""
    with np.errstate(invalid="ignore"):
        near = np.where(np.abs(both - base[:, None]) < within, both, np.nan)
    level = _row_nanmedian(_windows(near, HALF))
    return np.where(np.isnan(level), base, level)


def _run_values(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The one value of each day that a run may hold: the only one, or, of a day with several
    (a bar delivered again with a correction), the one shared with the day before or after."""
    one = np.where(least == most, least, np.nan)
    valued = np.flatnonzero(~np.isnan(least))
    for k in np.flatnonzero(np.isnan(one[valued])):
        d = valued[k]
        near = ([one[valued[k - 1]]] if k else []) + ([least[valued[k + 1]], most[valued[k + 1]]] if k + 1 < len(valued) else [])
        one[d] = next((x for x in near if x in (least[d], most[d])), np.nan)
    return one


def _windows(values: np.ndarray, half: int) -> np.ndarray:
    pad = np.full((half, values.shape[1]), np.nan)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pad, values, pad]), 2 * half + 1, axis=0).reshape(len(values), -1)


def judge(day: np.ndarray, prices: dict[str, np.ndarray], m: dict) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """For each field: the places of the readings that have a value, their scores, and the number in
    RULES of the rule each offends (0: none)."""
    d = np.clip(np.searchsorted(m["day"], day), 0, len(m["day"]) - 1)
    for f in FIELDS:
        have = np.flatnonzero(~np.isnan(prices[f]))
        v, at = prices[f][have], d[have]
        positive = v > 0
        level = m["level"][at]
        lv = np.where(positive, np.log(np.where(positive, v, 1.0)), np.nan_to_num(level, nan=0.0) - 50.0)
        in_run = m[f + "_one"][at] == v
        run = np.where(in_run, m[f + "_run"][at], 1.0)
        x, exc, level = _features(lv, at, m, run)
        score = forest_scores(m["forest"], x) if m["forest"] else np.full(len(v), np.nan)
        lonely = {kind: score >= m["limits"].get(kind, np.inf) for kind in SLACK}
        tens = np.abs(lv - level) / np.log(10.0)
        returns = exc > m[f + "_need"][at]
        unit = (np.round(tens) >= 1) & (np.abs(tens - np.round(tens)) < 0.12) & (exc > EXCURSION / 2)
        rule = np.zeros(len(v), np.int8)
        rule[lonely["stuck"] & in_run & m[f + "_later"][at] & (run >= STUCK_DAYS) & (m[f + "_quiet"] <= QUIET_SHARE)] = RULES.index("stuck")
        rule[lonely["spike"] & returns] = RULES.index("excursion")
        rule[lonely["spike"] & unit] = RULES.index("unit")
        rule[~positive] = RULES.index("limit")
        yield f, have, score, rule


def daily_history(readings: DataFrame) -> DataFrame:
    """At most a narrow row per source and day; all aggregates combine map-side."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in FIELDS:
        positive = F.when(F.col(f) > 0, F.col(f))
        aggs += [F.min(positive).alias(f"{f}_least"), F.max(positive).alias(f"{f}_most")]
    return readings.groupBy("code", "day").agg(*aggs)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Doubles with NaN for null, or days as numbers."""
    if pa.types.is_date(column.type):
        return column.cast(pa.int32()).to_numpy()
    return column.to_numpy().astype(float, copy=False)


def score_readings(readings: DataFrame, block_rows: int = 50_000, only_flagged: bool = False) -> DataFrame:
    """Score every reading.

    readings: bar_id, code, day (date), open, close; prices null where not usable.
    Returns a row per reading and field that has a value: its isolation score and the rule it
    offends (null: none).  ``only_flagged`` leaves out rows that offend no rule."""

    def model(h: pa.Table) -> pa.Table:
        parts = int(sum(h["n"].to_numpy()) // block_rows) + 1
        blob = pickle.dumps(source_model({c: _numbers(h[c]) for c in h.column_names if c not in ("code", "n")}), protocol=5)
        return pa.table({"code": [h["code"][0].as_py()] * parts, "part": pa.array(range(parts), pa.int32()), "model": pa.array([blob] * parts, pa.binary())})

    def apply(rows: pa.Table, models: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(models):
            keys = rows.select(["bar_id", "code", "day"])
            for f, have, score, rule in judge(_numbers(rows["day"]), {f: _numbers(rows[f]) for f in FIELDS}, pickle.loads(models["model"][0].as_py())):
                keep = np.flatnonzero(rule) if only_flagged else slice(None)
                have, score, rule = have[keep], score[keep], rule[keep]
                if len(have):
                    part = keys.take(have).append_column("field", pa.array([f] * len(have))).append_column("value", rows[f].take(have))
                    out.append(part.append_column("score", pa.array(score, pa.float64(), from_pandas=True)).append_column("rule", RULE_NAMES.take(pa.array(rule))))
        return pa.concat_tables(out) if out else FOUND.empty_table()

    models = daily_history(readings).groupBy("code").applyInArrow(model, "code string, part int, model binary")
    sizes = readings.groupBy("code").agg((F.floor(F.count(F.lit(1)) / block_rows) + 1).cast("int").alias("parts"))
    salted = readings.join(sizes, "code").withColumn("part", F.pmod(F.hash("bar_id"), F.col("parts"))).drop("parts")
    return salted.select("bar_id", "code", "day", *FIELDS, "part").groupBy("code", "part").cogroup(models.groupBy("code", "part")).applyInArrow(apply, FOUND_SCHEMA)
