"""Named steps of the oracle queries."""

from __future__ import annotations

SENSORS = ("T1", "T2", "T3", "moist")
TEMPS = ("T1", "T2", "T3")
IMPS = ("T1_imp", "T2_imp", "T3_imp")


def strict(agg: str, x: str) -> str:
    return f"CASE WHEN count({x}) = count(*) THEN {agg}({x}) END"


def r2(x: str) -> str:
    """Two decimals, halves up, after the noise of the summation order is gone."""
    return f"CAST(round(CAST({x} AS DECIMAL(18, 9)), 2) AS DOUBLE)"


def slot(minutes: int) -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTES, ts)"


VALUES = "value / 8 - 5 AS T1, value / 4 - 20 AS T2, value / 4 - 10 AS T3, value * 20 + 150 AS moist"
CODE = "CASE WHEN event_type = 'error' THEN event_id % 11 ELSE 0 END"
SEASON = "abs(dayofyear(l_shipdate) - 200)"
T1 = f"10 - {SEASON} / 16e0 + (l_quantity - 25) / 32e0 + (l_linenumber - 4) / 8e0"
PARTS = "year(date) AS year, month(date) AS month, dayofyear(date) AS doy, year(date + INTERVAL 122 DAYS) AS hydyear"
MASK = {
    "T1": "(1, 2, 4, 9)",
    "T2": "(1, 2, 7, 8)",
    "T3": "(1, 2, 4, 5, 7, 8, 10)",
    "moist": "(1, 2, 6, 8, 9, 10)",
}

CTES: dict[str, str] = {
    # ------------------------------------------------------------- readings
    "rd": f"""SELECT l_returnflag AS site, l_suppkey AS tomst_id, l_shipdate + to_hours(l_linenumber * 3) AS datetime,
        {T1} AS T1,
        12 - {SEASON} / 8e0 + (l_quantity - 25) / 16e0 + (l_linenumber - 4) / 4e0 AS T2,
        15 - {SEASON} / 8e0 + (l_quantity - 25) / 4e0 + (l_linenumber - 4) / 2e0 AS T3,
        CASE WHEN {T1} >= 1 THEN l_extendedprice / 50e0 END AS moist,
        CASE WHEN l_linenumber = 7 THEN 1e0 ELSE 0e0 END AS T1_imp,
        CASE WHEN l_linenumber >= 6 THEN 1e0 ELSE 0e0 END AS T2_imp,
        CASE WHEN l_linenumber = 1 THEN 1e0 ELSE 0e0 END AS T3_imp,
        CASE WHEN {T1} >= 1 THEN CASE WHEN l_linenumber = 7 THEN 1e0 ELSE 0e0 END END AS moist_imp FROM lineitem""",
    "rh": f"""SELECT site, user_id AS tomst_id, datetime, {VALUES}, {CODE} AS error_tomst FROM
        (SELECT *, 'S' || (user_id // 5) AS site, {slot(15)} AS datetime FROM events)
        QUALIFY row_number() OVER (PARTITION BY site, datetime ORDER BY ts, event_id) = 1""",
    "rl": f"""SELECT 'S' || (tomst_id // 5) AS site, tomst_id, datetime, {VALUES}, {CODE} AS probl FROM
        (SELECT *, user_id // 5 AS tomst_id, {slot(5)} AS datetime FROM events)
        QUALIFY row_number() OVER (PARTITION BY tomst_id, datetime ORDER BY ts, event_id) = 1""",
    "rt": f"""SELECT site, datetime, {VALUES} FROM
        (SELECT event_type AS site, {slot(15)} AS datetime, round(avg(value), 4) AS value FROM events GROUP BY ALL)""",
    "idle": f"""SELECT 'S' || (tomst_id // 5) AS site, tomst_id, datetime, 5 + (i % 5) / 16e0 AS T1, 5.25 + (i % 7) / 16e0 AS T2,
        5 + (i % 3) / 32e0 + CASE WHEN i % 17 = 0 THEN 1 ELSE 0 END AS T3, 500e0 + i % 13 AS moist,
        CASE WHEN day(datetime) % 2 = 0 THEN 2 ELSE 0 END AS probl FROM
        (SELECT user_id // 5 AS tomst_id, {slot(5)} AS datetime, min(event_id) AS i FROM events GROUP BY ALL)""",
    "ledger": """SELECT DISTINCT 'S' || (user_id // 5) AS site, user_id AS tomst_id, CAST(ts AS DATE) AS start_date,
        CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS end_date, event_id % 11 AS probl FROM events WHERE event_type = 'error'""",
    "visits": f"""SELECT DISTINCT 'S' || (user_id // 5) AS site, user_id AS tomst_id, {slot(15)} AS maxdt
        FROM events WHERE event_type = 'signup'""",
    "bias": """SELECT DISTINCT user_id AS tomst_id, (user_id % 7 - 3) / 16e0 AS T1,
        CASE WHEN user_id % 5 <> 0 THEN (user_id % 3 - 1) / 8e0 END AS T2, (user_id % 11 - 5) / 32e0 AS T3
        FROM events WHERE user_id % 4 <> 0""",
    "manifest": """SELECT *, '/in/' || folder || '/' || kind || '_' || name AS path FROM
        (SELECT 94000000 + doc_id // 5 AS logger, CASE doc_id % 5 WHEN 0 THEN 'binary' WHEN 1 THEN 'command' ELSE 'data' END AS kind,
         CASE WHEN (doc_id // 5) % 9 = 0 THEN CAST(94000000 + doc_id // 5 AS VARCHAR) ELSE 's' || ((doc_id // 5) % 40) END AS folder,
         (94000000 + doc_id // 5) || '_' || (CASE WHEN doc_id % 5 >= 3 THEN doc_id % 5 - 2 ELSE 0 END) || '.csv' AS name
         FROM documents WHERE doc_id % 5 < 2 OR n_chars % 2 = 0)""",
    "files": "SELECT path AS file, upper(folder) AS site1, logger AS tomst_id FROM manifest WHERE kind = 'data'",
    "mreg": """SELECT 'S' || (CASE WHEN (doc_id // 5) % 7 = 0 THEN (doc_id // 5) % 40 + 1 ELSE (doc_id // 5) % 40 END) AS site,
        94000000 + doc_id // 5 AS tomst_id, TIMESTAMP '2023-01-01' + to_minutes(n_chars * 15) AS maxdt
        FROM documents WHERE doc_id % 5 = 3 AND doc_id % 11 <> 0""",
    "raw_rows": f"""SELECT event_id, CAST(event_id AS VARCHAR) AS V1, '/in/L' || (logger % 10) || '/data_' || (94000000 + logger) || '_0.csv' AS path,
        stamp, CASE WHEN logger % 4 = 0 AND strftime(stamp, '%H:%M') = '00:00' THEN strftime(stamp, '%Y.%m.%d')
        WHEN logger % 4 = 0 THEN strftime(stamp, '%Y.%m.%d %H:%M:%S') WHEN logger % 4 = 1 THEN strftime(stamp, '%d.%m.%Y %H:%M:%S')
        WHEN logger % 4 = 2 THEN strftime(stamp, '%Y/%m/%d %H:%M') ELSE strftime(stamp, '%d/%m/%Y %H:%M') END AS V2,
        value AS V4, value AS V5, value AS V6, event_id % 4000 AS V7 FROM
        (SELECT event_id, CAST(value AS VARCHAR) AS value, {slot(15)} AS stamp, CASE WHEN user_id % 3 = 0 THEN user_id ELSE 1000 + user_id % 5 END AS logger FROM events)""",
    "file_lines": f"""SELECT event_id, 's' || (n % 10) AS folder, 'data_' || (CASE WHEN alone THEN 95000000 + user_id ELSE 94000000 + n END) || '_0.csv' AS file,
        CASE WHEN alone THEN 95000000 + user_id ELSE 94000000 + n END AS logger, n, NOT alone AND n % 7 = 6 AS header, stamp, value,
        CASE WHEN event_id % 101 = 1 THEN 'fields' WHEN event_id % 97 = 0 THEN 'time' END AS reason FROM
        (SELECT event_id, user_id, user_id // 5 AS n, user_id % 50 = 7 AS alone, {slot(15)} AS stamp, value FROM events)""",
    "file_kinds": """SELECT file, folder, logger, count(*) + CAST(bool_or(header) AS INT) AS n_rows, CASE n % 3 WHEN 0 THEN ';' WHEN 1 THEN 'tab' ELSE ',' END AS sep,
        n % 2 = 0 AS year_first, CASE WHEN count(*) + CAST(bool_or(header) AS INT) <= 100 THEN 'short' WHEN bool_or(header) THEN 'header' END AS reject
        FROM file_lines GROUP BY file, folder, logger, n""",
    "tree": """SELECT folder, 'data' AS kind, logger, '0' AS copy FROM file_kinds
        UNION ALL SELECT folder, 'binary', logger, '0' FROM file_kinds WHERE logger % 2 = 0
        UNION ALL SELECT folder, 'command', logger, '0' FROM file_kinds WHERE logger % 3 = 0
        UNION ALL SELECT folder, 'command', logger, '9' FROM file_kinds WHERE logger % 5 = 0""",
    "coords": """SELECT DISTINCT 'S' || (user_id // 5) AS site, 60 + (user_id // 5 % 40) / 8e0 AS Lat, 20 + (user_id // 5 % 40) / 4e0 AS Lon
        FROM events WHERE user_id // 5 % 10 <> 9""",
    "rules": """SELECT 'S' || (user_id // 5) AS site, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END AS after,
        CAST(ts AS DATE) + 3 AS before, CASE WHEN event_id % 4 < 2 THEN 'moist' ELSE 'T1' END AS col,
        CASE event_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN 'delete' ELSE 'rename' END AS action, 'XS' || (user_id // 5) AS target
        FROM events WHERE event_type = 'purchase' AND value > 200 AND (event_id % 2 = 0 OR event_id % 16 = 1)""",
    # ------------------------------------------------------------- cleaning
    "rh_codes": "SELECT site, tomst_id, datetime, "
    + ", ".join(f"CASE WHEN error_tomst NOT IN {MASK[s]} THEN {s} END AS {s}" for s in SENSORS)
    + ", error_tomst FROM rh",
    "rh_bias": """SELECT r.site, r.tomst_id, r.datetime, r.T1 - coalesce(b.T1, 0) AS T1, r.T2 - coalesce(b.T2, 0) AS T2,
        r.T3 - coalesce(b.T3, 0) AS T3, r.moist, r.error_tomst FROM rh r LEFT JOIN bias b ON b.tomst_id = r.tomst_id""",
    "rh_visits": "SELECT site, tomst_id, datetime, "
    + ", ".join(f"CASE WHEN near = 0 THEN {s} END AS {s}" for s in SENSORS)
    + """, error_tomst FROM (SELECT *, sum(visit) OVER (PARTITION BY site, tomst_id ORDER BY datetime ROWS BETWEEN 1 PRECEDING
        AND 1 FOLLOWING) AS near FROM (SELECT *, (SELECT count(*) FROM visits v WHERE v.site = r.site AND v.tomst_id = r.tomst_id
        AND v.maxdt = r.datetime) AS visit FROM rh r))""",
    "numbered": "SELECT *, row_number() OVER (PARTITION BY site ORDER BY datetime) AS r FROM rh_codes",
    # -------------------------------------------------------- daily, hourly
    "cal": """SELECT site, CAST(d AS DATE) AS date FROM (SELECT DISTINCT site FROM rd), (SELECT unnest(generate_series(
        (SELECT date_trunc('year', min(datetime)) FROM rd), (SELECT make_date(CAST(year(max(datetime)) AS INT), 12, 31)::TIMESTAMP FROM rd),
        INTERVAL 1 DAY)) AS d)""",
    "daily_u": f"""SELECT *, {PARTS} FROM (SELECT site, CAST(datetime AS DATE) AS date, """
    + ", ".join(f"{strict('avg', v)} AS {v}, {strict('avg', v + '_imp')} AS {v}_imp" for v in SENSORS)
    + " FROM rd GROUP BY ALL)",
    # Readings with one empty row for each missing day; moisture is calibrated where it is used.
    "rdp": f"""SELECT *, {PARTS} FROM (SELECT site, datetime, CAST(datetime AS DATE) AS date, * EXCLUDE (site, datetime) FROM rd
        UNION ALL BY NAME SELECT site, date FROM cal WHERE (site, date) NOT IN (SELECT site, CAST(datetime AS DATE) FROM rd))""",
    "daily": "SELECT site, date, year, month, doy, hydyear, "
    + ", ".join(f"{strict('avg', v)} AS {v}, {strict('avg', v + '_imp')} AS {v}_imp" for v in SENSORS)
    + ", "
    + ", ".join(f"{strict('min', v)} AS lo_{v}, {strict('max', v)} AS hi_{v}" for v in TEMPS)
    + " FROM rdp GROUP BY ALL",
    "hourly": "SELECT site, date, hour(datetime) AS hour, year, hydyear, "
    + ", ".join(f"{strict('avg', v)} AS {v}, {strict('avg', v + '_imp')} AS {v}_imp" for v in TEMPS)
    + " FROM rdp GROUP BY ALL",
    # --------------------------------------------------------- temperatures
    "annual": "SELECT site, 'mean' AS var, 'annual' AS period, year, "
    + ", ".join(f"{strict('avg', t)} AS {t}" for t in TEMPS)
    + ", "
    + ", ".join(f"{r2('100 * ' + strict('avg', i))} AS {i}" for i in IMPS)
    + " FROM rdp GROUP BY site, year HAVING "
    + " AND ".join(f"count({t}) = count(*)" for t in TEMPS),
    "annual_long": " UNION ALL ".join(
        f"SELECT site, var, period, year, '{t}' AS sensor, {t} AS value, {t}_imp AS imputed_percentage FROM annual" for t in TEMPS
    ),
    "month_means": "SELECT site, 'mean' AS var, any_value(strftime(date, '%b')) AS period, year, "
    + ", ".join(f"{strict('avg', t)} AS {t}" for t in TEMPS)
    + ", "
    + ", ".join(f"{r2('100 * ' + strict('avg', i))} AS {i}" for i in IMPS)
    + " FROM rdp GROUP BY site, year, month HAVING "
    + " AND ".join(f"count({t}) = count(*)" for t in TEMPS),
    "mean_range": "SELECT site, 'mean_daily_range' AS var, any_value(strftime(date, '%b')) AS period, year, "
    + ", ".join(f"avg(hi_{t} - lo_{t}) AS {t}" for t in TEMPS)
    + ", "
    + ", ".join(f"{r2('avg(' + r2('100 * ' + i) + ')')} AS {i}" for i in IMPS)
    + " FROM daily GROUP BY site, year, month HAVING "
    + " AND ".join(f"count(hi_{t}) = count(*)" for t in TEMPS),
    "month_ranked": " UNION ALL ".join(
        f"""SELECT site, year, month, strftime(date, '%b') AS period, '{t}' AS sensor, {t} AS value, {t}_imp * 100 AS pct,
        row_number() OVER (PARTITION BY site, year, month ORDER BY {t} ASC NULLS LAST, datetime, {t}_imp) AS up,
        row_number() OVER (PARTITION BY site, year, month ORDER BY {t} DESC NULLS LAST, datetime, {t}_imp) AS down,
        greatest(round_even(count(*) OVER m * 0.001e0, 0), 1) AS k_min, greatest(round_even(count(*) OVER m * (1e0 - 0.999e0), 0), 1) AS k_max,
        count(T1) OVER m = count(*) OVER m AS ok_min, count({t}) OVER m = count(*) OVER m AS ok_max
        FROM rdp WINDOW m AS (PARTITION BY site, year, month)"""
        for t in TEMPS
    ),
    "month_picked": """SELECT site, 'min' AS var, period, year, month, sensor, value, pct FROM month_ranked WHERE ok_min AND up = k_min
        UNION ALL SELECT site, 'max', period, year, month, sensor, value, pct FROM month_ranked WHERE ok_max AND down = k_max""",
    "month_ext": "SELECT site, var, any_value(period) AS period, year, month, "
    + ", ".join(f"max(CASE WHEN sensor = '{t}' THEN value END) AS {t}" for t in TEMPS)
    + ", "
    + ", ".join(f"max(CASE WHEN sensor = '{t}' THEN pct END) AS {t}_imp" for t in TEMPS)
    + " FROM month_picked GROUP BY site, var, year, month",
    "annual_ext": "SELECT site, var, 'annual' AS period, year, "
    + ", ".join(
        f"CASE WHEN var = 'min' THEN arg_min({c}, ({t}, month)) ELSE arg_min({c}, (-{t}, month)) END AS {c}"
        for t in TEMPS
        for c in (t, f"{t}_imp")
    )
    + " FROM month_ext GROUP BY site, var, year HAVING count(*) = 12",
    "annual_rng": "SELECT site, 'range' AS var, 'annual' AS period, year, "
    + ", ".join(f"max({t}) - min({t}) AS {t}" for t in TEMPS)
    + ", "
    + ", ".join(f"max({t}_imp) AS {t}_imp" for t in TEMPS)
    + " FROM annual_ext GROUP BY site, year",
    "days_whole": "SELECT * FROM daily WHERE (site, year) IN (SELECT site, year FROM annual)",
    "freeze_thaw": " UNION ALL ".join(
        f"""SELECT site, 'freeze_thaw_freq' AS var, 'annual' AS period, hydyear AS year, '{t}' AS sensor, sum(c) AS value,
        {r2('100 * ' + strict('avg', 'imp'))} AS imputed_percentage FROM
        (SELECT site, hydyear, imp, CASE WHEN (v >= 0) <> (lag(v) OVER w >= 0) AND abs(v - lag(v) OVER w) > 0.5 THEN 1 ELSE 0 END AS c FROM
         (SELECT site, hydyear, date, 1 AS k, hi_{t} AS v, {t}_imp AS imp FROM daily
          UNION ALL SELECT site, hydyear, date, 2, lo_{t}, {t}_imp FROM daily)
         WINDOW w AS (PARTITION BY site, hydyear ORDER BY date, k)) GROUP BY site, hydyear HAVING count(imp) = count(*)"""
        for t in ("T1", "T3")
    ),
    # ------------------------------------------------------------- moisture
    "rdc": """SELECT site, date, year, month, doy, T1, T3, moist_imp,
        round((-1.34e-8 * (moist * moist) + 2.50e-4 * moist + (-1.58e-1)) * 100e0, 1) AS moist FROM rdp""",
    "moist_top": "SELECT site, max(moist) AS top FROM rdc GROUP BY site",
    "mdays": f"""SELECT d.*, d.moist / top * 100 AS moistsat FROM (SELECT site, date, year, month, doy, {strict('avg', 'T1')} AS T1,
        {strict('avg', 'T3')} AS T3, {strict('avg', 'moist')} AS moist, {strict('avg', 'moist_imp')} AS moist_imp
        FROM rdc GROUP BY ALL) d JOIN moist_top USING (site)""",
    "mdaily": "SELECT *, avg(CASE WHEN moist IS NULL THEN 1e0 ELSE 0e0 END) OVER (PARTITION BY site, year, month) AS na_prop FROM mdays",
    "t1_years": "SELECT site, year FROM rdp GROUP BY site, year HAVING count(T1) = count(*)",
    "whole_days": "SELECT * FROM mdays WHERE (site, year) IN (SELECT site, year FROM t1_years)",
    "bounds": """SELECT site, year, min(doy) AS start_of_season, max(doy) AS end_of_season FROM
        (SELECT *, count(*) OVER (PARTITION BY site, year, run) AS n FROM (SELECT *, sum(c) OVER (PARTITION BY site, year ORDER BY date) AS run
         FROM (SELECT *, CASE WHEN (T3 >= 3) IS DISTINCT FROM lag(T3 >= 3) OVER (PARTITION BY site, year ORDER BY date) THEN 1 ELSE 0 END AS c
          FROM whole_days))) WHERE T3 >= 3 AND n > 5 GROUP BY site, year""",
    "from_start": "SELECT w.*, b.start_of_season, b.end_of_season FROM whole_days w JOIN bounds b USING (site, year) WHERE doy >= start_of_season",
    "start_rank": "SELECT *, row_number() OVER (PARTITION BY site, year ORDER BY date) AS k FROM from_start",
    "season_days": "SELECT * FROM from_start WHERE doy <= end_of_season",
    # ----------------------------------------------------------------- snow
    "minmax": f"""SELECT site, CAST(datetime AS DATE) AS date, {strict('min', 'T2')} AS T2_min, {strict('max', 'T2')} AS T2_max,
        {strict('avg', 'T2_imp')} AS T2_imp FROM rd GROUP BY ALL""",
    "cores": "SELECT *, "
    + ", ".join(
        f"""CAST(max(T2_max) OVER {n} < 1 AND max(T2_max) OVER {n} - min(T2_min) OVER {n} < 10 AS INT) AS core_{n}"""
        for n in ("center", "right_", "left_")
    ).replace("core_right_", "core_right").replace("core_left_", "core_left")
    + """ FROM minmax WINDOW center AS (PARTITION BY site ORDER BY date ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING),
        right_ AS (PARTITION BY site ORDER BY date ROWS BETWEEN 8 PRECEDING AND CURRENT ROW),
        left_ AS (PARTITION BY site ORDER BY date ROWS BETWEEN CURRENT ROW AND 8 FOLLOWING)""",
    "snow_flags": """SELECT site, date, T2_imp, max(core_center) OVER (PARTITION BY site ORDER BY date ROWS BETWEEN 4 PRECEDING
        AND 4 FOLLOWING) AS snow FROM cores""",
    "midsummer": "SELECT site, CAST(round_even(median(dayofyear(date)), 0) AS INT) AS midsummer_doy FROM snow_flags WHERE snow = 0 GROUP BY site",
    "snow_cal": """SELECT site, date, year(s) AS hydyear, dayofyear(date) AS doy, dayofyear(s) AS hyddoy, snow,
        CASE WHEN count(*) OVER w = 15 AND count(T2_imp) OVER w = 15 THEN 100 * avg(T2_imp) OVER w END AS T2_imp FROM
        (SELECT c.site, c.date, f.snow, f.T2_imp, c.date + CAST(365 - m.midsummer_doy AS INT) AS s FROM cal c
         LEFT JOIN snow_flags f ON f.site = c.site AND f.date = c.date LEFT JOIN midsummer m ON m.site = c.site)
        WINDOW w AS (PARTITION BY site ORDER BY date ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)""",
    "on_off": """SELECT site, hydyear AS year, var, value, T2_imp FROM (SELECT site, hydyear, 'newsnow_doy' AS var, doy AS value, T2_imp,
        row_number() OVER (PARTITION BY site, hydyear ORDER BY date) AS r FROM snow_cal WHERE snow = 1
        UNION ALL SELECT site, hydyear, 'snowmelt_doy', doy, T2_imp,
        row_number() OVER (PARTITION BY site, hydyear ORDER BY date DESC) FROM snow_cal WHERE snow = 1)
        WHERE r = 1 AND T2_imp IS NOT NULL AND hydyear IS NOT NULL""",
    "snow_years": """SELECT site, hydyear, sum(n) AS n_snow_days, max(n) AS max_snow_period_length, count(*) AS n_snow_period,
        sum(imp * n) / sum(n) AS T2_imp FROM (SELECT site, hydyear, run, count(*) AS n, avg(T2_imp) AS imp FROM
         (SELECT *, sum(c) OVER (PARTITION BY site, hydyear ORDER BY date) AS run FROM
          (SELECT *, CASE WHEN snow IS DISTINCT FROM lag(snow) OVER (PARTITION BY site, hydyear ORDER BY date) THEN 1 ELSE 0 END AS c
           FROM snow_cal WHERE snow IS NOT NULL AND T2_imp IS NOT NULL)) WHERE snow = 1 GROUP BY ALL) GROUP BY site, hydyear""",
    "snow_runs": " UNION ALL ".join(
        f"""SELECT site, hydyear AS year, '{v}' AS var, {v} AS value, T2_imp FROM snow_years
        WHERE (site, hydyear) IN (SELECT site, year FROM on_off GROUP BY site, year HAVING count(*) = 2)"""
        for v in ("n_snow_days", "max_snow_period_length", "n_snow_period")
    ),
}


def season_days(table: str, warm: str, keep: str, columns: str) -> str:
    """Days of ``table`` inside runs of equal ``warm``, with the run length ``n``."""
    return f"""SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY site, year, run) AS n FROM
        (SELECT *, sum(c) OVER (PARTITION BY site, year ORDER BY date) AS run FROM
         (SELECT {columns}, CASE WHEN ({warm}) IS DISTINCT FROM lag({warm}) OVER (PARTITION BY site, year ORDER BY date)
          THEN 1 ELSE 0 END AS c FROM {table}))) WHERE {keep}"""


for _t, _warm, _keep in (("T1", "T1 > 1", "T1 >= 1 AND n >= 5"), ("T3", "T3 >= 3", "T3 >= 3 AND n > 5")):
    CTES[f"season_{_t.lower()}"] = f"""SELECT site, u.var, 'growing_season' AS period, year, '{_t}' AS sensor, u.value, imputed_percentage FROM
        (SELECT site, year, min(doy) AS a, max(doy) AS b, {r2('100 * ' + strict('avg', _t + '_imp'))} AS imputed_percentage
         FROM ({season_days('days_whole', _warm, _keep, '*')}) GROUP BY site, year) s,
        LATERAL (SELECT 'start_of_season' AS var, s.a AS value UNION ALL SELECT 'end_of_season', s.b
         UNION ALL SELECT 'season_length', s.b - s.a) u"""


def _frost(name: str, days: str, value: str) -> str:
    return f"""SELECT site, '{name}' AS var, 'growing_season' AS period, year, 'T3' AS sensor, {value} AS value,
        {r2('100 * ' + strict('avg', 'T3_imp'))} AS imputed_percentage FROM ({days}) GROUP BY site, year"""


_COLD = "CASE WHEN count(lo_T3) = count(*) THEN sum(CASE WHEN lo_T3 <= 0 THEN lo_T3 ELSE 0 END) END"
CTES["gst1_frost"] = _frost("GST1_frost", season_days("days_whole", "T1 >= 1", "T1 >= 1 AND n > 5 AND doy <= 212", "*"), _COLD)
CTES["gst3_frost"] = _frost("GST3_frost", season_days("days_whole", "T3 >= 3", "T3 >= 3 AND n > 5", "*"), _COLD)
CTES["summer_frost"] = _frost(
    "summer_frost_freq",
    season_days("(SELECT * FROM days_whole WHERE month IN (6, 7, 8))", "T1 > 1", "T1 >= 1 AND n >= 5", "*"),
    "sum(CASE WHEN lo_T3 < 0 THEN 1 ELSE 0 END)",
)
for _name, _table in (("rolled_whole", "whole_days"), ("rolled_season", "season_days")):
    CTES[_name] = f"""SELECT * FROM (SELECT site, year, doy, CASE WHEN count(*) OVER w = 13 THEN avg(moist) OVER w END AS moist,
        CASE WHEN count(*) OVER w = 13 THEN avg(moistsat) OVER w END AS moistsat,
        CASE WHEN count(*) OVER w = 13 THEN 100 * avg(moist_imp) OVER w END AS imputed_percentage FROM {_table}
        WHERE moist IS NOT NULL AND moistsat IS NOT NULL AND moist_imp IS NOT NULL
        WINDOW w AS (PARTITION BY site, year ORDER BY doy ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)) WHERE moist IS NOT NULL"""

# name: (threshold, above, count, strict comparison, grouping year, table)
DEGREES = {
    "TDD": (0, True, False, False, "year", "daily"),
    "TDD_days": (0, True, True, True, "year", "daily"),
    "GDD3": (3, True, False, False, "year", "daily"),
    "GDD3_days": (3, True, True, False, "year", "daily"),
    "GDD5": (5, True, False, False, "year", "daily"),
    "GDD5_days": (5, True, True, False, "year", "daily"),
    "FDD": (0, False, False, False, "hydyear", "daily"),
    "FDD_days": (0, False, True, True, "year", "daily"),
    "TDH": (0, True, False, False, "year", "hourly"),
    "GDH3": (3, True, False, False, "year", "hourly"),
    "GDH5": (5, True, False, False, "year", "hourly"),
    "FDH": (0, False, False, False, "hydyear", "hourly"),
}


def degree_select(name: str) -> str:
    threshold, above, count, exclusive, group, table = DEGREES[name]
    sign = ">" if above else "<"
    test = f"{sign}{'' if exclusive else '='} {threshold}"
    parts = []
    for t in TEMPS:
        hit = f"CASE WHEN {t} {test} THEN {'1' if count else t} ELSE 0 END"
        parts.append(f"CASE WHEN count({t}) = count(*) THEN sum({hit}) END AS {t}")
        imp = r2(f"100 * avg(CASE WHEN {t} {sign}= {threshold} THEN {t}_imp END)")
        if not above:
            imp = f"CASE WHEN sum({hit}) = 0 THEN coalesce({imp}, 0) ELSE {imp} END"
        parts.append(f"{imp} AS {t}_imp")
    known = " AND ".join(f"{c} IS NOT NULL" for c in (*TEMPS, *IMPS))
    return f"""SELECT site, '{name}' AS var, 'annual' AS period, year, {', '.join((*TEMPS, *IMPS))} FROM
        (SELECT site, {group} AS year, {', '.join(parts)} FROM {table} GROUP BY site, {group}) WHERE {known}"""


def bundle_select(table: str, keys: str, extra: str = "NULL") -> str:
    """The 13 statistics of ``x`` per group, by name; ``extra`` is an aggregate returned as ``imp``."""
    return f"""SELECT {keys}, any_value(imp) AS imp, avg(x) AS mean, median(x) AS median, max(x) AS max, min(x) AS min, stddev_samp(x) AS sd, var_samp(x) AS var,
        1.4826 * median(abs(x - m)) AS mad, stddev_samp(x) / nullif(avg(x), 0) AS cvsd, var_samp(x) / nullif(avg(x), 0) AS cvvar,
        1.4826 * median(abs(x - m)) / nullif(avg(x), 0) AS cvmad,
        (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / nullif(quantile_cont(x, 0.75) + quantile_cont(x, 0.25), 0) AS qcd,
        quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr50, quantile_cont(x, 0.95) - quantile_cont(x, 0.05) AS iqr90
        FROM (SELECT a.*, g.m, g.imp FROM {table} a JOIN (SELECT {keys}, median(x) AS m, {extra} AS imp FROM {table} GROUP BY {keys}) g
         USING ({keys})) GROUP BY {keys}"""


# sensor: (sd factor, high, low, roll, previous, next, rise, rise roll, drop, drop roll, signed)
RULES = {
    ("", "T1"): (6, 10, -20, 5, 5, 5, 2, 2, 2, 2),
    ("", "T2"): (8, 20, -20, 10, 10, 10, 5, 5, 5, 5),
    ("", "T3"): (8, 20, -20, 10, 10, 10, 8, 8, 8, 8),
    ("", "moist"): (None, None, None, 1500, 2000, 1000, 1000, 1000, 500, 500),
    ("2023", "T1"): (6, 10, -20, 5, 5, 5, 2, None, 2, None),
    ("2023", "T2"): (8, 20, -20, 10, 10, 10, 5, None, 5, None),
    ("2023", "T3"): (8, 20, -20, 10, 10, 10, 5, None, 5, None),
    ("2023", "moist"): (None, None, None, 1000, 1500, 1000, 300, None, 100, None),
}
RULES |= {("2023 VIN", s): RULES[("2023", s)] for s in TEMPS}
RULES[("2023 VIN", "moist")] = (None, None, None, 1000, 2000, 1000, 500, None, 200, None)


def peaks_select(table: str, s: str, version: str = "") -> str:
    """Flags of one sensor: the last rule with a condition that is not false decides; unknown is no."""
    sd, high, low, roll, prev, foll, rise, rise_roll, drop, drop_roll = RULES[(version, s)]
    signed = s == "moist" and version != "2023"
    size = (lambda x: x) if signed else (lambda x: f"abs({x})")
    conditions: list[tuple[str, str]] = []
    if sd:
        conditions += [(f"abs(d) > sd * {sd} AND d > {high}", "true"), (f"abs(d) > sd * {sd} AND d < {low}", "true")]
    conditions += [(f"abs(d - roll) > {roll}", "true"), (f"{size('h')} > {prev}", "true"), (f"{size('l')} > {foll}", "true")]
    up = f"h > {rise} AND l > {rise}"
    if s == "T2" and not version:
        conditions.append((up, f"abs(d - roll) > {rise_roll}"))
    else:
        conditions.append((up + (f" AND abs(d - roll) > {rise_roll}" if rise_roll else ""), "true"))
    conditions.append((f"h < -{drop} AND l < -{drop}" + (f" AND abs(d - roll) > {drop_roll}" if drop_roll else ""), "true"))
    flag = "CASE " + " ".join(
        f"WHEN ({c}) IS NULL THEN false WHEN {c} THEN coalesce({v}, false)" for c, v in reversed(conditions)
    ) + " ELSE false END"
    return f"""SELECT site, datetime, {s}, {flag} AS {s}_peak FROM (SELECT *,
        CASE WHEN count(*) OVER nine = 9 THEN (coalesce(sum(d) OVER before4, 0) + coalesce(sum(d) OVER after4, 0))
        / nullif(count(d) OVER before4 + count(d) OVER after4, 0) END AS roll,
        {s} - lag({s}) OVER line AS h, {s} - lead({s}) OVER line AS l FROM
        (SELECT a.site, a.datetime, a.{s}, a.{s} - b.m AS d, b.sd FROM {table} a JOIN
         (SELECT datetime, avg({s}) AS m, stddev_samp({s}) AS sd FROM {table} GROUP BY datetime) b USING (datetime))
        WINDOW line AS (PARTITION BY site ORDER BY datetime),
        nine AS (PARTITION BY site ORDER BY datetime ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING),
        before4 AS (PARTITION BY site ORDER BY datetime ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
        after4 AS (PARTITION BY site ORDER BY datetime ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING))"""
