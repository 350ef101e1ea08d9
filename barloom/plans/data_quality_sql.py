"""The SQL of those queries of data_quality that SQL can express."""

from __future__ import annotations

#: Constants far above any price that recur over unrelated instruments.
STAND_INS = """
facts AS (SELECT 10 * quantile_disc(low, 0.99) AS high, greatest(3, 0.02 * count(DISTINCT CASE WHEN regexp_full_match(code, '[0-9]{6}') THEN code END)) AS least FROM hs300etf_day WHERE low > 0 AND NOT isnan(low)),
wide AS (
  SELECT v, code, low FROM (SELECT open AS v, code, low FROM hs300etf_day UNION ALL SELECT close, code, low FROM hs300etf_day), facts WHERE v > facts.high AND NOT isnan(v)),
stand_ins AS (
  SELECT v FROM wide, facts GROUP BY v, least
  HAVING count(DISTINCT CASE WHEN regexp_full_match(code, '[0-9]{6}') THEN code END) >= least AND quantile_disc(low, 0.9) >= 3 * quantile_disc(low, 0.1))"""
READINGS = """
r AS (
  SELECT h.bar_id, h.code, h.date, CAST(h.date AS DATE) AS day,
    CASE WHEN NOT isnan(open) AND open NOT IN (SELECT v FROM stand_ins) THEN open END AS open, CASE WHEN NOT isnan(close) AND close NOT IN (SELECT v FROM stand_ins) THEN close END AS close
  FROM hs300etf_day h WHERE h.code IN (SELECT code FROM etf_info) AND CAST(h.date AS DATE) IN (SELECT CAST(cal_date AS DATE) FROM trade_calendar WHERE is_open = 1))"""
ROLLING = """
u AS (SELECT code, day, date, arg_max(close, bar_id) AS close FROM r WHERE close IS NOT NULL GROUP BY ALL),
d AS (SELECT code, day, sum(close) AS s, count(*) AS n FROM u GROUP BY ALL),
g AS (SELECT code, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY code),
w AS (
  SELECT g.code, g.day, CAST(coalesce(sum(d.n) OVER p7, 0) AS INTEGER) AS n_7, coalesce(sum(d.s) OVER p7, 0) AS total_7, CAST(coalesce(sum(d.n) OVER p30, 0) AS INTEGER) AS n_30, coalesce(sum(d.s) OVER p30, 0) AS total_30
  FROM g LEFT JOIN d ON d.code = g.code AND d.day = g.day
  WINDOW p7 AS (PARTITION BY g.code ORDER BY g.day ROWS 6 PRECEDING), p30 AS (PARTITION BY g.code ORDER BY g.day ROWS 29 PRECEDING))"""

#: Neighbours of a state's missing open and close on the chain open, close, next open, ...: the nearest observed values.
CHAIN = """
b AS (
  SELECT code, CAST(date AS DATE) AS day, CASE WHEN NOT isnan(open) AND open > 0 AND open NOT IN (SELECT v FROM stand_ins) AND isfinite(open) THEN open END AS o,
    CASE WHEN NOT isnan(close) AND close > 0 AND close NOT IN (SELECT v FROM stand_ins) AND isfinite(close) THEN close END AS c,
    CASE WHEN NOT isnan(low) AND low > 0 THEN low END AS l, CASE WHEN NOT isnan(high) AND high > 0 THEN high END AS h
  FROM hs300etf_day WHERE regexp_full_match(code, '[0-9]{6}') AND date IS NOT NULL),
s AS (
  SELECT code, day, avg(CASE WHEN (l IS NULL OR o >= 0.8::DOUBLE * l) AND (h IS NULL OR o <= 1.25::DOUBLE * h) THEN o END) AS o, avg(CASE WHEN (l IS NULL OR c >= 0.8::DOUBLE * l) AND (h IS NULL OR c <= 1.25::DOUBLE * h) THEN c END) AS c
  FROM b GROUP BY ALL),
n AS (SELECT *, 1.5::DOUBLE * (day - DATE '1970-01-01') AS x FROM s),
k AS (
  SELECT *, last_value(coalesce(c, o) IGNORE NULLS) OVER up AS pv, last_value(CASE WHEN c IS NOT NULL THEN x + 1 WHEN o IS NOT NULL THEN x END IGNORE NULLS) OVER up AS px,
    first_value(coalesce(o, c) IGNORE NULLS) OVER down AS nv, first_value(CASE WHEN o IS NOT NULL THEN x WHEN c IS NOT NULL THEN x + 1 END IGNORE NULLS) OVER down AS nx
  FROM n WINDOW up AS (PARTITION BY code ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), down AS (PARTITION BY code ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
e AS (
  SELECT code, day, o, c, x, pv AS ov, px AS ox, coalesce(c, nv) AS ow, CASE WHEN c IS NOT NULL THEN x + 1 ELSE nx END AS oz, coalesce(o, pv) AS cv, CASE WHEN o IS NOT NULL THEN x ELSE px END AS cx, nv AS cw, nx AS cz
  FROM k WHERE o IS NULL OR c IS NULL)"""

def _number_mask(v: str) -> str:
    return f"regexp_replace(CASE WHEN {v} = 0 OR abs({v}) >= 0.001 AND abs({v}) < 1e7 THEN CAST({v} AS VARCHAR) ELSE rtrim(CAST(CAST({v} AS DECIMAL(38, 10)) AS VARCHAR), '0') END, '[0-9]', '9', 'g')"


def _profile_part(f: str) -> str:
    if f in ("code", "name"):
        mask = f"regexp_replace({f}, '[0-8]', '9', 'g')"
        for pattern, to in (("\\p{Han}+", "字"), ("\\p{Lu}+", "A"), ("\\p{Ll}+", "a"), ("\\s+", " ")):
            mask = f"regexp_replace({mask}, '{pattern}', '{to}', 'g')"
        return f"SELECT load_id, '{f}' AS field, CAST(NULL AS DOUBLE) AS number, {f} AS value, {mask} AS mask FROM hs300etf_day"
    if f in ("date", "loaded_at"):
        t = f"strftime({f}, '%Y-%m-%d %H:%M:%S')"
        return f"SELECT load_id, '{f}', epoch_us({f}) / 1e6::DOUBLE, CAST({f} AS VARCHAR), CASE WHEN {t} LIKE '%00:00:00' THEN '9999-99-99 midnight' ELSE regexp_replace({t}, '[0-9]', '9', 'g') END FROM hs300etf_day"
    lost = f" AND {f} NOT IN (SELECT v FROM stand_ins)" if f in ("open", "close") else ""
    return f"SELECT load_id, '{f}', v, CAST(v AS VARCHAR), {_number_mask('v')} FROM (SELECT load_id, CASE WHEN isfinite({f}){lost} THEN {f} END AS v FROM hs300etf_day)"


ORACLES = {
    "p5_profile_exact": f"""WITH {STAND_INS},
x AS ({" UNION ALL ".join(_profile_part(f) for f in ("code", "name", "date", "open", "high", "low", "close", "loaded_at"))}),
m AS (SELECT field, mask, count(*) < 0.001 * sum(count(*)) OVER (PARTITION BY field) AS rare FROM x GROUP BY field, mask),
c AS (SELECT load_id, field, mask, count(*) AS n FROM x WHERE mask IS NOT NULL GROUP BY ALL),
d AS (SELECT load_id, field, mask AS dominant_mask FROM c QUALIFY row_number() OVER (PARTITION BY load_id, field ORDER BY n DESC, mask DESC) = 1),
v AS (SELECT c.load_id, c.field, sum(CASE WHEN m.rare THEN n ELSE 0 END) AS violations FROM c JOIN m ON m.field = c.field AND m.mask = c.mask GROUP BY ALL),
g AS (SELECT load_id, field, count(*) AS rows, round(CAST(count(*) - count(value) AS DOUBLE) / count(*), 9) AS null_rate, min(number) AS least, max(number) AS largest, count(DISTINCT value) AS distinct_values FROM x GROUP BY ALL)
SELECT g.*, d.dominant_mask, CAST(coalesce(v.violations, 0) AS BIGINT) AS violations FROM g LEFT JOIN d ON d.load_id IS NOT DISTINCT FROM g.load_id AND d.field = g.field LEFT JOIN v ON v.load_id IS NOT DISTINCT FROM g.load_id AND v.field = g.field""",
    "p1_propagated": f"""WITH {STAND_INS}, {CHAIN}
SELECT code, CAST(day AS VARCHAR) AS day, round(coalesce(o, ov + (ow - ov) * (x - ox) / (oz - ox), ov, ow), 6) AS open, round(coalesce(c, cv + (cw - cv) * (x + 1 - cx) / (cz - cx), cv, cw), 6) AS close FROM e""",
    "p1_found": f"""WITH {STAND_INS}
SELECT bar_id, 'open' AS field FROM hs300etf_day WHERE open IS NULL OR isnan(open) OR open IN (SELECT v FROM stand_ins)
UNION ALL SELECT bar_id, 'close' FROM hs300etf_day WHERE close IS NULL OR isnan(close) OR close IN (SELECT v FROM stand_ins)
UNION ALL SELECT bar_id, 'code' FROM hs300etf_day WHERE code IS NULL OR NOT regexp_full_match(code, '[0-9]{{6}}')""",
    "p3_found": f"""WITH {STAND_INS}, {READINGS},
s AS (SELECT code, min(day) AS lo, max(day) AS hi FROM r GROUP BY code)
SELECT s.code, CAST(CAST(c.cal_date AS DATE) AS VARCHAR) AS day FROM s JOIN trade_calendar c ON c.is_open = 1 AND CAST(c.cal_date AS DATE) > s.lo AND CAST(c.cal_date AS DATE) < s.hi
WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.code = s.code AND r.day = CAST(c.cal_date AS DATE))""",
    "p3_regular": f"""WITH {STAND_INS}, {READINGS},
days AS (SELECT day, row_number() OVER (ORDER BY day) AS no FROM (SELECT DISTINCT CAST(cal_date AS DATE) AS day FROM trade_calendar WHERE is_open = 1)),
u AS (SELECT r.code, r.day, r.date, d.no, arg_max(r.open, r.bar_id) AS v FROM r JOIN days d ON d.day = r.day WHERE r.open > 0 GROUP BY ALL),
seen AS (SELECT code, day, count(open) FILTER (open > 0) AS k FROM r GROUP BY ALL),
g AS (SELECT s.code, d.day, d.no, CAST(d.day AS TIMESTAMP) + INTERVAL 15 HOUR AS tick FROM (SELECT code, min(day) AS lo, max(day) AS hi FROM r GROUP BY code) s JOIN days d ON d.day BETWEEN s.lo AND s.hi),
a AS (SELECT g.*, p.date AS pt, p.v AS pv, p.no AS pn, p.day AS pd FROM g ASOF LEFT JOIN u p ON p.code = g.code AND p.date <= g.tick),
m AS (SELECT a.*, n.date AS nt, n.v AS nv, n.no AS nn, n.day AS nd, CASE WHEN n.no IS NOT NULL AND a.pn IS NOT NULL THEN greatest(n.no - a.pn - 1, 0) END AS gap FROM a ASOF LEFT JOIN u n ON n.code = a.code AND n.date >= a.tick)
SELECT m.code, CAST(m.day AS VARCHAR) AS day, CAST(gap AS INTEGER) AS gap_days,
  CASE WHEN s.k > 0 THEN 'observed' WHEN s.k = 0 THEN 'observed_without_value' WHEN gap <= 5 THEN 'filled' ELSE 'gap' END AS status,
  round(CASE WHEN gap <= 5 THEN CASE WHEN pt = nt THEN pv ELSE pv + (nv - pv) * (epoch_us(tick) - epoch_us(pt)) / CAST(epoch_us(nt) - epoch_us(pt) AS DOUBLE) END WHEN pd = m.day THEN pv WHEN nd = m.day THEN nv END, 9) AS value
FROM m LEFT JOIN seen s ON s.code = m.code AND s.day = m.day""",
    "p4_rolling_quarter": f"""WITH {STAND_INS}, {READINGS}, {ROLLING}
SELECT code, CAST(day AS VARCHAR) AS day, round(coalesce(sum(s) OVER p90, 0), 3) AS total_90, round(coalesce(sum(s) OVER p250, 0), 3) AS total_250, CAST(coalesce(sum(n) OVER p90, 0) AS INTEGER) AS n_90, CAST(coalesce(sum(n) OVER p250, 0) AS INTEGER) AS n_250
FROM (SELECT g.code, g.day, d.s, d.n FROM g LEFT JOIN d ON d.code = g.code AND d.day = g.day)
WINDOW p90 AS (PARTITION BY code ORDER BY day ROWS 89 PRECEDING), p250 AS (PARTITION BY code ORDER BY day ROWS 249 PRECEDING)""",
    "p4_found": f"WITH {STAND_INS}, {READINGS}, {ROLLING} SELECT code, CAST(day AS VARCHAR) AS day FROM w WHERE n_7 = 0",
    "p4_rolling": f"""WITH {STAND_INS}, {READINGS}, {ROLLING},
t AS (SELECT code, day, n_7, n_30, round(CASE WHEN n_7 = 0 THEN 0 ELSE total_7 END, 4) + 0.0 AS total_7, round(CASE WHEN n_30 = 0 THEN 0 ELSE total_30 END, 4) + 0.0 AS total_30 FROM w)
SELECT code, CAST(day AS VARCHAR) AS day, total_7, total_7 / nullif(n_7, 0) AS avg_7, n_7, total_30, total_30 / nullif(n_30, 0) AS avg_30, n_30 FROM t""",
}
