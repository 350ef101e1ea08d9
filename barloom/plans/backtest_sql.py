"""The SQL of the queries in backtest: plain windows, and recursive queries for the recurrences."""

from __future__ import annotations

BARS = """
q0 AS (
  SELECT code, CAST(date AS DATE) AS day, date, bar_id, CASE WHEN open > 0 AND NOT isnan(open) THEN open END AS po, CASE WHEN close > 0 AND NOT isnan(close) THEN close END AS pc,
    CASE WHEN low > 0 AND high >= low AND high <= 1.5::DOUBLE * low AND NOT isnan(high) THEN low END AS pl, CASE WHEN low > 0 AND high >= low AND high <= 1.5::DOUBLE * low AND NOT isnan(high) THEN high END AS ph
  FROM hs300etf_day WHERE code IN (SELECT code FROM etf_info) AND CAST(date AS DATE) IN (SELECT CAST(cal_date AS DATE) FROM trade_calendar WHERE is_open = 1)),
q1 AS (
  SELECT *, CASE WHEN po BETWEEN 0.99::DOUBLE * pl AND 1.01::DOUBLE * ph OR pl IS NULL AND po <= 1.5::DOUBLE * pc AND pc <= 1.5::DOUBLE * po THEN po END AS so,
    CASE WHEN pc BETWEEN 0.99::DOUBLE * pl AND 1.01::DOUBLE * ph OR pl IS NULL AND po <= 1.5::DOUBLE * pc AND pc <= 1.5::DOUBLE * po THEN pc END AS sc
  FROM q0),
q2 AS (SELECT *, so IS NOT NULL AND sc IS NOT NULL AND pl IS NOT NULL AS clean, coalesce(so, sc, (pl + ph) / 2) AS oo, coalesce(sc, so, (pl + ph) / 2) AS cc FROM q1),
q3 AS (SELECT *, coalesce(pl, least(oo, cc)) AS ll, coalesce(ph, greatest(oo, cc)) AS hh, row_number() OVER (PARTITION BY code, day ORDER BY clean DESC, date DESC, bar_id DESC) AS k FROM q2 WHERE oo IS NOT NULL),
q AS (SELECT code, day, CAST(round(oo * 1000) AS BIGINT) AS o, CAST(round(hh * 1000) AS BIGINT) AS h, CAST(round(ll * 1000) AS BIGINT) AS l, CAST(round(cc * 1000) AS BIGINT) AS c FROM q3 WHERE k = 1),
bars AS (SELECT code, day, o, h, l, c, row_number() OVER (PARTITION BY code ORDER BY day) AS n FROM q)"""


def _full(f: str, x: str, n: int) -> str:
    frame = f"OVER (PARTITION BY code ORDER BY day ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({x}) {frame} = {n} THEN {f}({x}) {frame} END"


def _cross(x: str, y: str) -> str:
    lag = lambda c: f"lag({c}) OVER (PARTITION BY code ORDER BY day)"
    return f"CASE WHEN {lag(x)} <= {lag(y)} AND {x} > {y} THEN 1 WHEN {lag(x)} >= {lag(y)} AND {x} < {y} THEN -1 END"


CHANGE = "coalesce(CAST(o AS DOUBLE) / lag(o) OVER (PARTITION BY code ORDER BY day) - 1, 0.0)"


def _average_trades(fast: int, slow: int, at: str = "") -> str:
    return f"""
ma{at} AS (SELECT code, day, n, o / 1000.0::DOUBLE AS open, {CHANGE} AS r, {_full('avg', 'c', fast)} AS f, {_full('avg', 'c', slow)} AS s FROM bars),
sg{at} AS (SELECT *, {_cross('f', 's')} AS signal, lag(s) OVER (PARTITION BY code ORDER BY day) AS ps FROM ma{at}),
x{at} AS (SELECT code, day, open, r, signal, coalesce(lag(signal) OVER (PARTITION BY code ORDER BY day), 0) AS trade, row_number() OVER (PARTITION BY code ORDER BY day) AS i FROM sg{at} WHERE ps IS NOT NULL)"""


MACD = """
e AS (
  SELECT b.code, b.n, b.day, CASE WHEN b.n = 12 THEN s.a12 END AS e12, CAST(NULL AS DOUBLE) AS e26 FROM bars b JOIN seeds s ON s.code = b.code WHERE b.n = 12
  UNION ALL
  SELECT b.code, b.n, b.day, e.e12 + 2.0::DOUBLE / 13 * (b.c / 1000.0::DOUBLE - e.e12), CASE WHEN b.n = 26 THEN s.a26 ELSE e.e26 + 2.0::DOUBLE / 27 * (b.c / 1000.0::DOUBLE - e.e26) END
  FROM e JOIN bars b ON b.code = e.code AND b.n = e.n + 1 JOIN seeds s ON s.code = b.code),
dif AS (SELECT code, n, day, e12 - e26 AS dif FROM e WHERE n >= 26),
dseed AS (SELECT code, avg(dif) AS a9, count(*) AS k FROM dif WHERE n <= 34 GROUP BY code),
g AS (
  SELECT d.code, d.n, s.a9 AS dea FROM dif d JOIN dseed s ON s.code = d.code WHERE d.n = 34
  UNION ALL
  SELECT d.code, d.n, g.dea + 0.2::DOUBLE * (d.dif - g.dea) FROM g JOIN dif d ON d.code = g.code AND d.n = g.n + 1),
m AS (SELECT b.code, b.day, b.n, b.o, d.dif, g.dea, 2 * (d.dif - g.dea) AS macd FROM bars b LEFT JOIN dif d ON d.code = b.code AND d.n = b.n LEFT JOIN g ON g.code = b.code AND g.n = b.n)"""
SEEDS = "seeds AS (SELECT code, avg(CASE WHEN n <= 12 THEN c END) / 1000.0::DOUBLE AS a12, avg(CASE WHEN n <= 26 THEN c END) / 1000.0::DOUBLE AS a26 FROM bars GROUP BY code)"
MACD_TRADES = f"""
sg AS (SELECT code, day, o / 1000.0::DOUBLE AS open, {CHANGE} AS r, dea, {_cross('dif', 'dea')} AS signal, lag(dea) OVER (PARTITION BY code ORDER BY day) AS pd FROM m),
x AS (SELECT code, day, open, r, signal, coalesce(lag(signal) OVER (PARTITION BY code ORDER BY day), 0) AS trade, row_number() OVER (PARTITION BY code ORDER BY day) AS i FROM sg WHERE pd IS NOT NULL)"""

_SIZES = {
    "a": ("own", "raw", "raw", "own"),
    "b": ("own", "own", "own", "own"),
    "c": ("own", "unit", "own", "far"),
    "d": ("own", "own", "own", "own"),
}


def _ledger(rules: str, units: float | None = None, at: str = "", opening: float = 100000.0, fee: float = 0.002, lot: float = 100.0, slip: float = 0.01, share: float = 1.0) -> str:
    """One row a bar: position p, market value m, cash c, total t."""
    price = {"own": "own", "raw": "open", "far": "far", "unit": "own"}
    fl, fs, sl, ls = _SIZES[rules]
    sized = f"CASE WHEN p = 0 AND trade > 0 THEN {price[fl]} WHEN p = 0 THEN {price[fs]} WHEN trade > 0 THEN {price[sl]} ELSE {price[ls]} END"
    back = "c + m" if rules != "c" else f"c + v - v * {fee}::DOUBLE"
    lots = f"trade * (CASE WHEN w < 0 AND w % {lot}::DOUBLE <> 0 THEN w - w % {lot}::DOUBLE - {lot} ELSE w - w % {lot}::DOUBLE END)"
    if units is not None:
        lots = f"{units}::DOUBLE"
    elif "unit" in _SIZES[rules]:
        lots = f"CASE WHEN p = 0 AND trade < 0 THEN -own ELSE {lots} END"
    lost = "NULL" if rules in "ab" else "'hold'"
    return f"""
l{at} AS (
  SELECT code, i, 0.0::DOUBLE AS p, 0.0::DOUBLE AS m, {opening}::DOUBLE AS c, {opening}::DOUBLE AS t FROM x{at} WHERE i = 1
  UNION ALL
  SELECT code, i,
    CASE act WHEN 'hold' THEN p WHEN 'deal' THEN u END,
    CASE act WHEN 'hold' THEN CASE WHEN p > 0 THEN m * (1 + r) WHEN p < 0 THEN m * (1 - r) ELSE 0 END WHEN 'deal' THEN abs(u) * own END,
    CASE act WHEN 'hold' THEN c WHEN 'deal' THEN k - abs(u) * own - abs(u) * own * {fee}::DOUBLE END,
    CASE act WHEN 'hold' THEN CASE WHEN p > 0 THEN m * (1 + r) + c WHEN p < 0 THEN m * (1 - r) + c ELSE t END WHEN 'deal' THEN abs(u) * own + (k - abs(u) * own - abs(u) * own * {fee}::DOUBLE) END
  FROM (SELECT *, {lots} AS u FROM (SELECT *, k * {share}::DOUBLE * {1 - fee}::DOUBLE / ({sized}) AS w FROM (SELECT *, CASE WHEN p = 0 THEN c ELSE {back} END AS k FROM (
    SELECT x.code, x.i, x.open, x.r, x.trade, l.p, l.m, l.c, l.t,
      CASE WHEN x.trade > 0 THEN x.open + {slip}::DOUBLE ELSE x.open - {slip}::DOUBLE END AS own, CASE WHEN x.trade > 0 THEN x.open - {slip}::DOUBLE ELSE x.open + {slip}::DOUBLE END AS far,
      (CASE WHEN l.p > 0 THEN x.open + {slip}::DOUBLE ELSE x.open - {slip}::DOUBLE END) * abs(l.p) AS v,
      CASE WHEN l.p IS NULL THEN NULL WHEN x.trade = 0 THEN 'hold' WHEN x.trade * l.p > 0 THEN {lost} ELSE 'deal' END AS act
    FROM l{at} l JOIN x{at} x ON x.code = l.code AND x.i = l.i + 1))))),
led{at} AS (SELECT x.code, x.day, x.open, x.trade, l.i, l.p AS position, l.m AS market_value, l.c AS cash, l.t AS total_asset FROM l{at} l JOIN x{at} x ON x.code = l.code AND x.i = l.i)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + " "


def _round(c: str, places: int = 6, name: str | None = None) -> str:
    return f"round({c}, {places}) + 0.0 AS {name or c}"


D = "CAST(day AS VARCHAR) AS day"
_T = _average_trades(5, 20)
_L = _with(BARS, _T, _ledger("d"))


def _show(places: int = 4) -> str:
    return f"SELECT code, {D}, trade, {', '.join(_round(c, places) for c in ('position', 'market_value', 'cash', 'total_asset'))} FROM led"


_FINAL = f"SELECT code, CAST(max(day) AS VARCHAR) AS day, round(arg_max(total_asset, day), 4) + 0.0 AS total_asset FROM led GROUP BY code"  # noqa: F541
_RETURNS = "ret AS (SELECT code, day, coalesce(total_asset / nullif(lag(total_asset) OVER (PARTITION BY code ORDER BY day), 0) - 1, 0.0) AS x FROM led)"
_BENCH = "bday AS (SELECT CAST(date AS DATE) AS day, min(close) AS close FROM hs300_bench WHERE close IS NOT NULL AND NOT isnan(close) AND date IS NOT NULL GROUP BY 1), bench AS (SELECT day, coalesce(close / lag(close) OVER (ORDER BY day) - 1, 0.0) AS b FROM bday)"


def _grid(fasts: tuple[int, ...], slows: tuple[int, ...]) -> str:
    parts, rows = [], []
    for f in fasts:
        for s in slows:
            at = f"_{f}_{s}"
            parts += [_average_trades(f, s, at), _ledger("d", at=at)]
            rows.append(f"SELECT code, {f} AS period_fast, {s} AS period_slow, round(round(arg_max(total_asset, day), 4) - 100000, 4) + 0.0 AS total_returns FROM led{at} GROUP BY code")
    return _with(BARS, *parts, "grid AS (" + " UNION ALL ".join(rows) + ")")


_GRID = _grid((5, 10), (20, 30))

_REPORT = (
    _with(
        BARS, _T, _ledger("d"), _RETURNS, _BENCH,
        "wl AS (SELECT ret.code, ret.day, x, coalesce(b, 0.0) AS b, exp(sum(ln(greatest(1 + x, 1e-12))) OVER (PARTITION BY ret.code ORDER BY ret.day)) AS wealth FROM ret LEFT JOIN bench ON bench.day = ret.day)",
        "dr AS (SELECT *, wealth / greatest(max(wealth) OVER (PARTITION BY code ORDER BY day), 1.0) - 1 AS drawdown FROM wl)",
        "ag AS (SELECT code, count(*) AS days, arg_max(wealth, day) AS wealth, avg(x) AS mean, stddev_samp(x) AS sd, sqrt(avg(power(least(x, 0.0), 2))) AS down, min(drawdown) AS dd, avg(CAST(x > 0 AS INTEGER)) AS wins, covar_samp(x, b) AS cov, var_samp(b) AS v, avg(b) AS bm FROM dr GROUP BY code)",
    )
    + "SELECT code, days, round(wealth - 1, 5) + 0.0 AS cumulative_return, round(power(wealth, 252.0 / days) - 1, 5) + 0.0 AS yearly_growth, round(sd * sqrt(252.0), 5) + 0.0 AS volatility, round(mean / nullif(sd, 0) * sqrt(252.0), 5) + 0.0 AS sharpe, "
    "round(mean / nullif(down, 0) * sqrt(252.0), 5) + 0.0 AS sortino, round(dd, 5) + 0.0 AS max_drawdown, round(wins, 5) + 0.0 AS win_rate, round(cov / nullif(v, 0), 5) + 0.0 AS beta, round((mean - cov / nullif(v, 0) * bm) * 252.0, 5) + 0.0 AS alpha FROM ag"
)

ORACLES = {
    "bars_daily": _with(BARS) + f"SELECT code, {D}, o / 1000.0::DOUBLE AS open, h / 1000.0::DOUBLE AS high, l / 1000.0::DOUBLE AS low, c / 1000.0::DOUBLE AS close FROM bars",
    "pct_change_open": _with(BARS) + f"SELECT code, {D}, round({CHANGE}, 6) + 0.0 AS open_pct_change FROM bars",
    "sma": _with(BARS) + f"SELECT code, {D}, round(({_full('avg', 'c', 5)}) / 1000.0::DOUBLE, 6) + 0.0 AS sma_5, round(({_full('avg', 'c', 20)}) / 1000.0::DOUBLE, 6) + 0.0 AS sma_20 FROM bars",
    "sma_warmup_drop": _with(BARS) + f"SELECT * FROM (SELECT code, {D}, round(({_full('avg', 'c', 5)}) / 1000.0::DOUBLE, 6) + 0.0 AS sma_5, round(({_full('avg', 'c', 20)}) / 1000.0::DOUBLE, 6) + 0.0 AS sma_20 FROM bars) WHERE sma_5 IS NOT NULL AND sma_20 IS NOT NULL",
    "llv": _with(BARS) + f"SELECT code, {D}, ({_full('min', 'l', 9)}) / 1000.0::DOUBLE AS llv_9 FROM bars",
    "hhv": _with(BARS) + f"SELECT code, {D}, ({_full('max', 'h', 9)}) / 1000.0::DOUBLE AS hhv_9 FROM bars",
    "rsv": _with(BARS) + f"SELECT code, {D}, round(CAST(c - a AS DOUBLE) / nullif(b - a, 0) * 100, 6) + 0.0 AS rsv_9 FROM (SELECT *, {_full('min', 'l', 9)} AS a, {_full('max', 'h', 9)} AS b FROM bars)",
    "kdj": _with(BARS, f"v AS (SELECT code, day, CAST(c - a AS DOUBLE) / nullif(b - a, 0) * 100 AS rsv FROM (SELECT *, {_full('min', 'l', 9)} AS a, {_full('max', 'h', 9)} AS b FROM bars))", f"kk AS (SELECT code, day, {_full('avg', 'rsv', 3)} AS k FROM v)", f"dd AS (SELECT code, day, k, {_full('avg', 'k', 3)} AS d FROM kk)")
    + f"SELECT code, {D}, round(k, 6) + 0.0 AS k, round(d, 6) + 0.0 AS d, round(3 * k - 2 * d, 6) + 0.0 AS j FROM dd",
    "crossup_sma": _with(BARS, f"ma AS (SELECT code, day, {_full('avg', 'c', 5)} AS f, {_full('avg', 'c', 20)} AS s FROM bars)") + f"SELECT code, {D}, {_cross('f', 's')} AS signal FROM ma",
    "trade_delay": _with(BARS, _T) + f"SELECT code, {D}, signal, trade FROM x",
    "ema": _with(BARS, SEEDS, MACD) + f"SELECT b.code, CAST(b.day AS VARCHAR) AS day, round(e12, 6) + 0.0 AS ema_12, round(e26, 6) + 0.0 AS ema_26 FROM bars b LEFT JOIN e ON e.code = b.code AND e.n = b.n",
    "macd": _with(BARS, SEEDS, MACD) + f"SELECT code, {D}, {_round('dif')}, {_round('dea')}, {_round('macd')} FROM m",
    "macd_signal": _with(BARS, SEEDS, MACD, MACD_TRADES) + f"SELECT code, {D}, signal, trade FROM x",
    "max_pos": _with(BARS) + f"SELECT code, {D}, w - w % 100.0::DOUBLE AS position FROM (SELECT code, day, 100000.0::DOUBLE * 0.998::DOUBLE / (c / 1000.0::DOUBLE) AS w FROM bars)",
    "ledger_a": _with(BARS, _T, _ledger("a")) + _show(),
    "ledger_b": _with(BARS, _T, _ledger("b")) + _show(),
    "ledger_c": _with(BARS, _T, _ledger("c")) + _show(3),
    "ledger_d": _L + _show(),
    "ledger_c_fixed_volume": _with(BARS, _T, _ledger("c", 1.0)) + _show(6),
    "online_sma": _L + _show(),
    "final_asset": _L + _FINAL,
    "backtest_sma": _with(BARS, _average_trades(30, 100), _ledger("d")) + _FINAL,
    "backtest_macd": _with(BARS, SEEDS, MACD, MACD_TRADES, _ledger("c")) + _FINAL.replace("day), 4)", "day), 3)"),
    "param_grid": "SELECT CAST(f.f AS INTEGER) AS period_fast, CAST(s.s AS INTEGER) AS period_slow FROM range(5, 200, 5) f(f), range(10, 205, 5) s(s) WHERE f.f < s.s",
    "param_returns": _GRID + "SELECT * FROM grid",
    "param_best": _GRID + "SELECT code, period_fast, period_slow, total_returns FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY total_returns DESC, period_fast, period_slow) AS k FROM grid) WHERE k = 1",
    "strategy_returns": _with(BARS, _T, _ledger("d"), _RETURNS) + f"SELECT code, {D}, round(x, 8) + 0.0 AS stra_pct_returns FROM ret",
    "benchmark_returns": _with(_BENCH) + f"SELECT {D}, round(b, 8) + 0.0 AS bench_pct_returns FROM bench",
    "report_metrics": _REPORT,
    "account_view": _with(
        BARS, _T, _ledger("d"), "ch AS (SELECT *, CASE WHEN position <> coalesce(lag(position) OVER (PARTITION BY code ORDER BY day), 0) THEN i END AS turn FROM led)",
        "og AS (SELECT *, max(turn) OVER (PARTITION BY code ORDER BY day) AS since FROM ch)",
    )
    + f"SELECT a.code, CAST(a.day AS VARCHAR) AS day, round(a.total_asset, 4) + 0.0 AS total_asset, round(a.market_value, 4) + 0.0 AS market_value, round(CASE WHEN a.position <> 0 THEN a.market_value - s.market_value ELSE 0 END, 4) + 0.0 AS float_profit_loss, "  # noqa: F541
    "round(coalesce(a.total_asset - lag(a.total_asset) OVER (PARTITION BY a.code ORDER BY a.day), 0), 4) + 0.0 AS daily_profit_loss, round(a.cash, 4) + 0.0 AS cash FROM og a LEFT JOIN led s ON s.code = a.code AND s.i = a.since",
    "position_view": _with(
        BARS, _T, _ledger("d"), "ch AS (SELECT *, total_asset - lag(total_asset) OVER (PARTITION BY code ORDER BY day) AS daily, CASE WHEN position <> coalesce(lag(position) OVER (PARTITION BY code ORDER BY day), 0) THEN i END AS turn FROM led)",
        "og AS (SELECT *, max(turn) OVER (PARTITION BY code ORDER BY day) AS since, row_number() OVER (PARTITION BY code ORDER BY day DESC) AS back FROM ch)",
    )
    + "SELECT a.code, round(a.market_value, 5) + 0.0 AS market_value, round(a.position, 5) + 0.0 AS hold_vol, round(CASE WHEN a.position <> 0 THEN s.open END, 5) + 0.0 AS cost, round(a.open, 5) + 0.0 AS price, round(coalesce(a.daily, 0), 5) + 0.0 AS daily_profit_loss, "
    "round(a.market_value / nullif(a.total_asset, 0), 5) + 0.0 AS position_ratio, CASE WHEN a.position <> 0 THEN a.i - a.since + 1 ELSE 0 END AS hold_days FROM og a LEFT JOIN led s ON s.code = a.code AND s.i = a.since WHERE a.back = 1",
    "feed_csv": _with(BARS) + f"SELECT code, {D}, o / 1000.0::DOUBLE AS open, c / 1000.0::DOUBLE AS close FROM bars",
    "feed_csv_text": _with(BARS) + "SELECT code, CAST(day AS VARCHAR) || ' 00:00:00' AS date, c / 1000.0::DOUBLE AS close FROM bars",
    "feed_folder": _with(BARS) + f"SELECT code, {D}, o / 1000.0::DOUBLE AS open, c / 1000.0::DOUBLE AS close FROM bars",
    "feed_united": _with(BARS, _BENCH) + f"SELECT code, {D}, o / 1000.0::DOUBLE AS open, c / 1000.0::DOUBLE AS close FROM bars UNION ALL SELECT 'benchmark', {D}, NULL, close FROM bday",
    "ledger_settings": _with(BARS, _T, _ledger("d", opening=1000000.0, fee=0.003, lot=200.0, slip=0.02, share=0.5)) + _show(),
    "facade_macd": _with(BARS, SEEDS, MACD, MACD_TRADES, _ledger("c")) + _FINAL.replace("day), 4)", "day), 3)"),
    "facade_report": _REPORT,
    "param_lines": _GRID + "SELECT code, period_fast || '-' || period_slow AS pair, printf('%d-%d: final asset %.4f, total returns %.4f', period_fast, period_slow, total_returns + 100000, total_returns) AS line FROM grid",
    "monthly_returns": _with(BARS, _T, _ledger("d"), _RETURNS) + "SELECT code, strftime(day, '%Y-%m') AS month, round(product(1 + x) - 1, 6) + 0.0 AS monthly_return, count(*) AS days FROM ret GROUP BY ALL",
    "drawdowns": _with(
        BARS, _T, _ledger("d"), "pk AS (SELECT code, day, total_asset, max(total_asset) OVER (PARTITION BY code ORDER BY day) AS peak FROM led)",
        "ud AS (SELECT *, max(CASE WHEN total_asset >= peak THEN day END) OVER (PARTITION BY code ORDER BY day) AS peak_day FROM pk)",
    )
    + "SELECT code, CAST(peak_day AS VARCHAR) AS peak_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS days, round(min(total_asset / peak - 1), 6) + 0.0 AS depth FROM ud WHERE total_asset < peak GROUP BY code, peak_day",
    "account_history": """
WITH d AS (SELECT *, row_number() OVER (PARTITION BY account_id, date ORDER BY posted_at DESC NULLS LAST, total_asset DESC) AS k FROM qt_account), h AS (SELECT * FROM d WHERE k = 1)
SELECT account_id, broker_id, CAST(CAST(date AS DATE) AS VARCHAR) AS day, round(total_asset, 4) + 0.0 AS total_asset, round(market_value, 4) + 0.0 AS market_value,
  round(coalesce(float_profit_loss, total_asset - first_value(total_asset) OVER w), 4) + 0.0 AS float_profit_loss, round(coalesce(daily_profit_loss, total_asset - lag(total_asset) OVER w, 0), 4) + 0.0 AS daily_profit_loss, round(cash, 4) + 0.0 AS cash
FROM h WINDOW w AS (PARTITION BY account_id ORDER BY date NULLS FIRST)""",
    "account_latest": """
WITH d AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY date DESC NULLS LAST, posted_at DESC NULLS LAST, total_asset DESC) AS k FROM qt_account)
SELECT d.account_id, d.broker_id, CAST(CAST(d.date AS DATE) AS VARCHAR) AS day, d.total_asset, d.cash, CASE WHEN NOT isnan(b.commission) THEN b.commission END AS commission, b.min_size, CASE WHEN NOT isnan(b.pct_limit) THEN b.pct_limit END AS pct_limit
FROM d LEFT JOIN qt_broker b ON b.broker_id = d.broker_id WHERE k = 1""",
    "position_book": """
WITH d AS (SELECT *, row_number() OVER (PARTITION BY account_id, code ORDER BY as_of DESC, position_id DESC) AS k FROM qt_position), h AS (SELECT * FROM d WHERE k = 1)
SELECT account_id, code, CAST(CAST(as_of AS DATE) AS VARCHAR) AS as_of, name, market_value, hold_vol, cost, round(coalesce(CASE WHEN NOT isnan(price) THEN price END, market_value / nullif(abs(hold_vol), 0)), 6) + 0.0 AS price,
  round(market_value / nullif(sum(market_value) OVER (PARTITION BY account_id), 0), 6) + 0.0 AS share FROM h""",
}
