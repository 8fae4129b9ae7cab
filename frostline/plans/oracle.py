"""The same queries as plain SQL, written against the test tables.

Shared steps are named CTEs; a query pulls in the ones it names.
"""

from __future__ import annotations

import re

from frostline.plans.oracle_ctes import CTES, SENSORS, TEMPS, bundle_select, degree_select, peaks_select, r2, strict

ORACLE: dict[str, str] = {}
_TABLE = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)")


def _needed(sql: str) -> list[str]:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_TABLE.findall(text)):
            if name in CTES and name not in order:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def add(name: str, columns: str, body: str) -> None:
    """Register ``body`` with its output columns, ``name:kind`` (s text, i whole, d double, t time, D day, b flag).

    Doubles are compared to six places; the nudge keeps exact halves, which sixteenths of a degree
    produce all the time, from going up in one engine and down in the other.
    """
    forms = {
        "s": "{0}",
        "t": "{0}",
        "b": "{0}",
        "i": "CAST({0} AS BIGINT)",
        "d": "ROUND(CAST({0} AS DOUBLE) + 1e-9, 6) + 0e0",
        "D": "strftime({0}, '%Y-%m-%d')",
    }
    select = ", ".join(
        f'{forms[kind].format(col)} AS "{col}"' for col, kind in (c.split(":") for c in columns.replace(" ", "").split(","))
    )
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in _needed(body))
    head = f"WITH {ctes}\n" if ctes else ""
    ORACLE[name] = f"{head}SELECT {select} FROM ({body}) AS result"


WIDE = "site:s,var:s,period:s,year:i,T1:d,T2:d,T3:d,T1_imp:d,T2_imp:d,T3_imp:d"
LONG = "site:s,var:s,period:s,year:i,sensor:s,value:d,imputed_percentage:d"
MOIST = "site:s,var:s,period:s,year:i,imputed_percentage:d,moist_type:s,value:d"
SNOW = "site:s,year:i,var:s,value:d,T2_imp:d"
HF = "site:s,tomst_id:i,datetime:t,T1:d,T2:d,T3:d,moist:d,error_tomst:i"

# ---------------------------------------------------------------- sources
add(
    "scan_logger_files",
    "tomst_id:i,datetime:t,zone:i,T1:d,T2:d,T3:d,moist:d",
    """SELECT CAST(regexp_extract(path, 'data_([0-9]+)', 1) AS BIGINT) AS tomst_id, stamp AS datetime, 4 AS zone,
       CAST(replace(V4, ',', '.') AS DOUBLE) AS T1, CAST(replace(V5, ',', '.') AS DOUBLE) AS T2,
       CAST(replace(V6, ',', '.') AS DOUBLE) AS T3, CAST(V7 AS DOUBLE) AS moist
       FROM (SELECT *, row_number() OVER (PARTITION BY path, stamp ORDER BY CAST(V1 AS BIGINT) DESC) AS r,
             count(*) OVER (PARTITION BY path) AS n FROM raw_rows) WHERE r = 1 AND n > 100""",
)
add("reject_short_files", "path:s,V1:s,V2:s", "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY path) AS n FROM raw_rows) WHERE n > 100")
add("logger_id_from_path", "path:s,tomst_id:i", "SELECT path, CASE WHEN kind = 'data' THEN logger END AS tomst_id FROM manifest")
add("parse_logger_time", "V1:s,datetime:t", "SELECT V1, stamp AS datetime FROM raw_rows")
add("parse_decimal_comma", "V1:s,T1:d", "SELECT CAST(event_id AS VARCHAR) AS V1, value AS T1 FROM events")
add(
    "dedup_keep_last",
    "path:s,V2:s,V1:s",
    """SELECT path, V2, CAST(max(CAST(V1 AS BIGINT)) AS VARCHAR) AS V1 FROM raw_rows GROUP BY path, V2""",
)
# --------------------------------------------------- manifest and registry
add("manifest_parse", "file:s,site1:s,tomst_id:i", "SELECT file, site1, tomst_id FROM files")
add(
    "orphan_sidecars",
    "file:s",
    """SELECT path AS file FROM manifest m WHERE kind <> 'data'
       AND NOT EXISTS (SELECT 1 FROM manifest x WHERE x.kind = 'data' AND x.folder = m.folder AND x.name = m.name)""",
)
add(
    "latest_logger_per_site",
    "site:s,tomst_id:i,maxdt:t",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY maxdt DESC, tomst_id DESC) AS r FROM visits)
       WHERE r = 1""",
)
add("unknown_loggers", "file:s,tomst_id:i", "SELECT file, tomst_id FROM files WHERE tomst_id NOT IN (SELECT tomst_id FROM mreg)")
RECONCILED = """SELECT coalesce(f.tomst_id, k.tomst_id) AS tomst_id, f.file, f.site1, k.site,
    CASE WHEN f.file IS NULL THEN 'no_file' WHEN k.site IS NULL THEN 'not_registered' ELSE 'both' END AS status
    FROM files f FULL JOIN (SELECT DISTINCT tomst_id, site FROM mreg) k ON f.tomst_id = k.tomst_id"""
RECONCILED_COLUMNS = "tomst_id:i,file:s,site1:s,site:s,status:s"
add("reconcile_manifest", RECONCILED_COLUMNS, RECONCILED)
add("site_conflicts", RECONCILED_COLUMNS, f"SELECT * FROM ({RECONCILED}) WHERE site1 <> site")
add(
    "multi_logger_sites",
    "site:s,tomst_id:i",
    """SELECT DISTINCT site, tomst_id FROM visits
       WHERE site IN (SELECT site FROM visits GROUP BY site HAVING count(DISTINCT tomst_id) > 1)""",
)
add(
    "duplicate_logger_files",
    "file:s,tomst_id:i",
    "SELECT file, tomst_id FROM (SELECT *, count(*) OVER (PARTITION BY tomst_id) AS n FROM files) WHERE n > 1",
)
add(
    "site_fallback",
    "file:s,tomst_id:i,site1:s,site2:s",
    """SELECT file, tomst_id, 'PIS' || CASE WHEN length(s) < 3 THEN lpad(s, 3, '0') ELSE s END AS site1, site2 FROM
       (SELECT f.file, coalesce(f.tomst_id, k.tomst_id) AS tomst_id, k.site AS site2,
        coalesce(CASE WHEN length(f.site1) <> 8 THEN f.site1 END, k.site) AS s
        FROM files f FULL JOIN (SELECT DISTINCT tomst_id, site FROM mreg) k ON f.tomst_id = k.tomst_id)""",
)
add(
    "map_uniqueness",
    "n_rows:i,n_sites:i,n_loggers:i,sites_unique:b,loggers_unique:b",
    """SELECT count(*) AS n_rows, count(DISTINCT site1) AS n_sites, count(DISTINCT tomst_id) AS n_loggers,
       count(DISTINCT site1) = count(*) AS sites_unique, count(DISTINCT tomst_id) = count(*) AS loggers_unique
       FROM (SELECT DISTINCT site1, tomst_id FROM files)""",
)
add(
    "initial_site_codes",
    "site:s,tomst_id:i",
    "SELECT DISTINCT 'PAL' || CASE WHEN length(site1) < 3 THEN lpad(site1, 3, '0') ELSE site1 END AS site, tomst_id FROM files",
)
add(
    "site_overrides",
    "site:s,tomst_id:i,maxdt:t",
    """SELECT DISTINCT CASE WHEN tomst_id % 10 = 1 THEN site || 'A' ELSE site END AS site, tomst_id, maxdt FROM
       (SELECT site, tomst_id, maxdt FROM mreg UNION
        SELECT 'M' || substr(site, 2), tomst_id + 500000, maxdt FROM mreg WHERE tomst_id % 10 = 0)""",
)
# --------------------------------------------------------------- filters
add("plausible_dates", "site:s,datetime:t,T1:d", "SELECT * FROM rh WHERE datetime > DATE '2024-01-05' AND datetime < DATE '2024-01-25'")
add(
    "sites_without_log",
    "site:s",
    """SELECT DISTINCT 'U' || user_id AS site FROM events
       WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 150)""",
)
add("any_measured", HF, "SELECT * FROM rh_codes WHERE T1 IS NOT NULL OR T2 IS NOT NULL OR T3 IS NOT NULL OR moist IS NOT NULL")
add("exclude_prefix", "site:s,datetime:t,moist:d", "SELECT * FROM rh WHERE site NOT LIKE 'S1%' AND site NOT LIKE 'S7%'")
add(
    "month_completeness",
    "site:s,year:i,month:i,na_prop:d",
    """SELECT site, year, month, avg(CASE WHEN moist IS NULL THEN 1e0 ELSE 0e0 END) AS na_prop
       FROM daily GROUP BY ALL HAVING avg(CASE WHEN moist IS NULL THEN 1e0 ELSE 0e0 END) < 0.5""",
)
add(
    "timestamp_coverage",
    "datetime:t,n_observed:i,n_sites:i",
    """SELECT datetime, count(moist) AS n_observed, (SELECT count(DISTINCT site) FROM rt) AS n_sites FROM rt GROUP BY datetime
       HAVING 5 * count(moist) > (SELECT count(DISTINCT site) FROM rt)""",
)
add(
    "scan_written_files",
    "file:s,row:i,tomst_id:i,datetime:t,zone:i,T1:d,T2:d,T3:d,moist:d",
    """SELECT file, event_id AS row, logger AS tomst_id, stamp AS datetime, 4 AS zone, value AS T1, value AS T2, value AS T3,
        CAST(event_id % 4000 AS DOUBLE) AS moist FROM
       (SELECT *, row_number() OVER (PARTITION BY file, stamp ORDER BY event_id DESC) AS k FROM file_lines
        WHERE reason IS NULL AND file IN (SELECT file FROM file_kinds WHERE reject IS NULL)) WHERE k = 1""",
)
add(
    "scan_rejects",
    "file:s,row:i,reason:s,n_rows:i",
    """SELECT file, NULL AS row, reject AS reason, n_rows FROM file_kinds WHERE reject IS NOT NULL
       UNION ALL SELECT file, event_id, reason, 1 FROM file_lines WHERE reason IS NOT NULL AND file IN (SELECT file FROM file_kinds WHERE reject IS NULL)""",
)
add("written_file_layouts", "file:s,n_rows:i,sep:s,year_first:b,reject:s", "SELECT * FROM file_kinds")
add(
    "listed_manifest",
    "file:s,site1:s,tomst_id:i",
    "SELECT '/in/' || folder || '/data_' || logger || '_0.csv' AS file, upper(folder) AS site1, logger AS tomst_id FROM tree WHERE kind = 'data'",
)
add(
    "listed_orphans",
    "file:s",
    "SELECT '/in/' || folder || '/' || kind || '_' || logger || '_' || copy || '.csv' AS file FROM tree WHERE copy = '9'",
)
# ----------------------------------------------------------------- joins
add(
    "assign_site",
    "site:s,tomst_id:i,datetime:t,T1:d",
    """SELECT v.site, r.tomst_id, r.datetime, r.T1 FROM rh r LEFT JOIN
       (SELECT tomst_id, site FROM (SELECT *, row_number() OVER (PARTITION BY tomst_id ORDER BY maxdt DESC, site DESC) AS k
        FROM visits) WHERE k = 1) v ON r.tomst_id = v.tomst_id""",
)
add(
    "ledger_interval_join",
    "site:s,tomst_id:i,datetime:t,T1:d,T2:d,T3:d,moist:d,probl:i",
    """SELECT r.* EXCLUDE (error_tomst), coalesce((SELECT min(nullif(l.probl, 0)) FROM ledger l WHERE l.site = r.site
        AND l.tomst_id = r.tomst_id AND CAST(r.datetime AS DATE) BETWEEN l.start_date AND l.end_date), 0) AS probl
       FROM rh r""",
)
add(
    "ledger_interval_bins",
    "site:s,tomst_id:i,datetime:t,T1:d,T2:d,T3:d,moist:d,probl:i",
    """SELECT r.* EXCLUDE (error_tomst), coalesce((SELECT min(nullif(l.probl, 0)) FROM ledger l WHERE l.site = r.site
        AND l.tomst_id = r.tomst_id AND CAST(r.datetime AS DATE) BETWEEN l.start_date AND l.end_date), 0) AS probl
       FROM rh r""",
)
add(
    "ledger_segments",
    "site:s,tomst_id:i,start_date:D,end_date:D,probl:i",
    """SELECT site, tomst_id, min(day) AS start_date, max(day) AS end_date, probl FROM
       (SELECT *, day - CAST(row_number() OVER (PARTITION BY site, tomst_id, probl ORDER BY day) AS INT) AS run FROM
        (SELECT site, tomst_id, day, coalesce(min(nullif(probl, 0)), 0) AS probl FROM
         (SELECT site, tomst_id, probl, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS day FROM ledger)
         GROUP BY site, tomst_id, day)) GROUP BY site, tomst_id, probl, run""",
)
add("apply_bias", HF, "SELECT * FROM rh_bias")
add(
    "reference_series",
    "datetime:t," + ",".join(f"{s}_mean:d,{s}_sd:d" for s in SENSORS),
    "SELECT datetime, " + ", ".join(f"avg({s}) AS {s}_mean, stddev_samp({s}) AS {s}_sd" for s in SENSORS) + " FROM rt GROUP BY datetime",
)
add(
    "calendar_pad",
    "site:s,date:D,n:i",
    "SELECT c.site, c.date, k.n FROM cal c LEFT JOIN (SELECT site, CAST(datetime AS DATE) AS date, count(*) AS n FROM rd GROUP BY ALL) k USING (site, date)",
)
add("rows_in_season", "site:s,date:D,moist:d,moistsat:d,start_of_season:i,end_of_season:i", "SELECT * FROM season_days")
add("loggers_to_calibrate", "tomst_id:i", "SELECT DISTINCT tomst_id FROM rh WHERE tomst_id NOT IN (SELECT tomst_id FROM bias)")
# ---------------------------------------------------------- aggregations
add("daily_strict_mean", "site:s,date:D,T1:d,T2:d,T3:d,moist:d,T1_imp:d,moist_imp:d", "SELECT * FROM daily_u")
add(
    "hourly_strict_mean",
    "site:s,date:D,hour:i,T1:d,T3:d,moist:d,T2_imp:d",
    f"""SELECT site, CAST(datetime AS DATE) AS date, hour(datetime) AS hour, {strict('avg', 'T1')} AS T1, {strict('avg', 'T3')} AS T3,
        {strict('avg', 'moist')} AS moist, {strict('avg', 'T2_imp')} AS T2_imp FROM rd GROUP BY ALL""",
)
add(
    "therm_sum",
    "site:s,year:i,above5:d,below0:d,moist100:d",
    """SELECT site, year, CASE WHEN count(T3) = count(*) THEN sum(CASE WHEN T3 >= 5 THEN T3 ELSE 0 END) END AS above5,
       CASE WHEN count(T3) = count(*) THEN sum(CASE WHEN T3 <= 0 THEN T3 ELSE 0 END) END AS below0,
       CASE WHEN count(moist) = count(*) THEN sum(CASE WHEN moist >= 100 THEN moist ELSE 0 END) END AS moist100
       FROM daily_u GROUP BY ALL""",
)
add(
    "daily_range",
    "site:s,date:D,T1:d,T2:d,T3:d,moist:d",
    "SELECT site, CAST(datetime AS DATE) AS date, "
    + ", ".join(f"CASE WHEN count({v}) = count(*) THEN max({v}) - min({v}) END AS {v}" for v in SENSORS)
    + " FROM rd GROUP BY ALL",
)
add("mean_daily_range", WIDE, "SELECT * FROM mean_range")
add("latest_reading", "site:s,tomst_id:i,maxdt:t", "SELECT site, tomst_id, max(datetime) AS maxdt FROM rh GROUP BY ALL")
STATS = ("mean", "median", "max", "min", "sd", "var", "mad", "cvsd", "cvvar", "cvmad", "qcd", "iqr50", "iqr90")
add(
    "distribution_bundle",
    "site:s,year:i,month:i," + ",".join(f"{s}:d" for s in STATS),
    bundle_select("(SELECT *, moist AS x FROM daily_u)", "site, year, month"),
)
add("scaled_mad", "site:s,year:i,mad:d", f"SELECT site, year, mad FROM ({bundle_select('(SELECT *, T2 AS x FROM daily_u)', 'site, year')})")
add("robust_month_min", WIDE, "SELECT * FROM month_ext WHERE var = 'min'")
add("robust_month_max", WIDE, "SELECT * FROM month_ext WHERE var = 'max'")
add(
    "strict_quantile",
    "site:s,year:i,t1_q25:d,moist_q90:d",
    """SELECT site, year, CASE WHEN count(T1) = count(*) THEN quantile_cont(T1, 0.25) END AS t1_q25,
       CASE WHEN count(moist) = count(*) THEN quantile_cont(moist, 0.9) END AS moist_q90 FROM daily_u GROUP BY ALL""",
)


def trend(table: str, value: str) -> str:
    return f"""SELECT site, u.var, 'ice_free_season' AS period, year, imputed_percentage, '{value}' AS moist_type, u.value FROM
      (SELECT site, year, 100 * avg(moist_imp) AS imputed_percentage, regr_slope({value}, doy) AS slope,
       CASE WHEN var_pop({value}) > 0 THEN regr_r2({value}, doy) END AS r2
       FROM {table} WHERE {value} IS NOT NULL AND moist_imp IS NOT NULL GROUP BY site, year) t,
      LATERAL (SELECT 'trend_slope' AS var, t.slope AS value UNION ALL SELECT 'trend_r2', t.r2) u
      WHERE u.value IS NOT NULL"""


add("trend_ols", MOIST, trend("whole_days", "moist"))
add("trend_ols_gs", MOIST, trend("season_days", "moistsat"))
add(
    "minute_shares",
    "tomst_id:i,mins:i,n:i,share:d",
    """SELECT tomst_id, minute(datetime) AS mins, count(*) AS n, count(*) / (SELECT count(*) FROM rl x WHERE x.tomst_id = rl.tomst_id)::DOUBLE AS share
       FROM rl GROUP BY tomst_id, minute(datetime)""",
)
add(
    "temporal_resolution",
    "tomst_id:i,Temporal_resolution:d,modal_step:d",
    """SELECT tomst_id, max(CASE WHEN a = 1 THEN step END) AS Temporal_resolution, max(CASE WHEN b = 1 THEN step END) AS modal_step FROM
       (SELECT *, row_number() OVER (PARTITION BY tomst_id ORDER BY n, step) AS a,
        row_number() OVER (PARTITION BY tomst_id ORDER BY n DESC, step) AS b FROM
        (SELECT tomst_id, step, count(*) AS n FROM (SELECT tomst_id,
         date_diff('second', lag(datetime) OVER (PARTITION BY tomst_id ORDER BY datetime), datetime) / 60.0 AS step FROM rl)
         WHERE step IS NOT NULL GROUP BY ALL)) GROUP BY tomst_id""",
)
add(
    "step_sizes",
    "site:s,step:d,n:i",
    """SELECT site, step, count(*) AS n FROM (SELECT site,
       date_diff('second', lag(datetime) OVER (PARTITION BY site ORDER BY datetime), datetime) / 60.0 AS step FROM rh)
       WHERE step IS NOT NULL GROUP BY ALL""",
)
# --------------------------------------------------------------- windows
W = "PARTITION BY site ORDER BY datetime"
add(
    "neighbour_diffs",
    "site:s,datetime:t,T1:d,lag1:d,lag2:d,lag5:d,lead1:d,lead3:d",
    "SELECT site, datetime, T1, "
    + ", ".join(f"T1 - lag(T1, {k}) OVER ({W}) AS lag{k}" for k in (1, 2, 5))
    + ", "
    + ", ".join(f"T1 - lead(T1, {k}) OVER ({W}) AS lead{k}" for k in (1, 3))
    + " FROM rh",
)


def hit(flag: str, back: int, width: int, order: str = W, lenient: bool = False) -> str:
    frame = f"OVER ({order} ROWS BETWEEN {back} PRECEDING AND {back} FOLLOWING)"
    worst = f"coalesce(max(CAST({flag} AS INT)) {frame}, 0)" if lenient else (
        f"CASE WHEN count({flag}) {frame} = count(*) {frame} THEN max(CAST({flag} AS INT)) {frame} END"
    )
    return f"CASE WHEN count(*) {frame} < {width} THEN 0 ELSE {worst} END"


add(
    "roll_mask",
    "site:s,datetime:t,k3:i,k5:i,k5_lenient:i",
    f"""SELECT site, datetime, {hit('(T1 > 10)', 1, 3)} AS k3, {hit('(T1 > 10)', 2, 5)} AS k5,
        {hit('(T1 > 10)', 2, 5, lenient=True)} AS k5_lenient FROM rh_codes""",
)
add(
    "roll_mean_excl_middle",
    "site:s,datetime:t,roll:d",
    f"""SELECT a.site, a.datetime, CASE WHEN a.n >= 9 THEN (SELECT avg(b.T1) FROM numbered b WHERE b.site = a.site AND b.r <> a.r
        AND b.r BETWEEN a.r - 4 AND a.r + 4) END AS roll FROM
        (SELECT *, count(*) OVER ({W} ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS n FROM numbered) a""",
)
add(
    "roll_aligned",
    "site:s,date:D,T2_min:d,T2_max:d,core_center:i,core_right:i,core_left:i",
    "SELECT site, date, T2_min, T2_max, core_center, core_right, core_left FROM cores",
)
add("roll13", "site:s,year:i,doy:i,moist:d,moistsat:d,imputed_percentage:d", "SELECT * FROM rolled_whole")
add(
    "run_ids",
    "site:s,date:D,run:i,run_length:i",
    """SELECT site, date, run, count(*) OVER (PARTITION BY site, year, run) AS run_length FROM
       (SELECT site, year, date, 1 + sum(c) OVER (PARTITION BY site, year ORDER BY date) AS run FROM
        (SELECT site, year, date, CASE WHEN row_number() OVER w = 1 THEN 0
         WHEN (T3 >= 3) IS DISTINCT FROM lag(T3 >= 3) OVER w THEN 1 ELSE 0 END AS c
         FROM daily_u WINDOW w AS (PARTITION BY site, year ORDER BY date)))""",
)
add(
    "locf",
    "site:s,datetime:t,code:i",
    f"""SELECT site, datetime, last_value(CASE WHEN error_tomst > 0 THEN error_tomst END IGNORE NULLS)
        OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS code FROM rh""",
)
add(
    "interp_short_gaps",
    "site:s,datetime:t,T1:d",
    f"""SELECT site, datetime, coalesce(x, p + (f - p) * (epoch(datetime) - epoch(pt)) / (epoch(ft) - epoch(pt))) AS T1 FROM
        (SELECT site, datetime, x, lag(x) OVER w AS p, lead(x) OVER w AS f, lag(datetime) OVER w AS pt, lead(datetime) OVER w AS ft
         FROM (SELECT site, datetime, CASE WHEN T1 < 4 THEN T1 END AS x FROM rh) WINDOW w AS ({W}))""",
)
add(
    "rescale_max",
    "site:s,datetime:t,moist:d,moistsat:d",
    "SELECT site, datetime, moist, moist / max(moist) OVER (PARTITION BY site) * 100 AS moistsat FROM rh",
)
# ---------------------------------------------------- dedup and set operations
add(
    "first_last_in_group",
    "user_id:i,first_id:i,first_type:s,last_id:i,last_type:s",
    """SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_id, arg_min(event_type, (ts, event_id)) AS first_type,
       arg_max(event_id, (ts, event_id)) AS last_id, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id""",
)
add(
    "first_k_days",
    "site:s,date:D,moist:d",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, year ORDER BY date) AS k FROM from_start) WHERE k <= 14",
)
add(
    "dedup_readings",
    "tomst_id:i,datetime:t,T1:d,T2:d,T3:d,moist:d",
    """SELECT * FROM (SELECT user_id % 30 AS tomst_id, time_bucket(INTERVAL 15 MINUTES, ts) AS datetime, event_id % 4 = 0 AS bare,
        2024 - event_id % 3 AS year, event_id, CASE WHEN event_id % 4 <> 0 AND event_id % 5 <> 0 THEN value / 8 END AS T1,
        CASE WHEN event_id % 4 <> 0 THEN value / 4 END AS T2, CASE WHEN event_id % 4 <> 0 AND event_id % 3 <> 0 THEN value / 2 END AS T3,
        CASE WHEN event_id % 4 <> 0 AND event_id % 7 <> 0 THEN value * 20 END AS moist FROM events)
       QUALIFY row_number() OVER (PARTITION BY tomst_id, datetime ORDER BY bare, year, event_id) = 1""",
)
add("dedup_keep_first", HF, "SELECT * FROM rh")
add(
    "merge_archive",
    "site:s,datetime:t,tomst_id:i,T1:d,T2:d,T3:d,moist:d,datanew:b",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, datetime ORDER BY datanew, tomst_id, T1) AS r FROM
       (SELECT site, datetime, tomst_id, T1, T2, T3, moist, tomst_id % 3 <> 0 AS datanew FROM rl
        WHERE tomst_id % 3 <> 0 OR T2 < 0)) WHERE r = 1""",
)
add(
    "schema_diff",
    "name:s,side:s",
    """SELECT name, CASE WHEN bool_or(g) THEN 'missing' ELSE 'extra' END AS side FROM
       (SELECT source AS name, false AS g FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
        UNION ALL SELECT source, true FROM documents WHERE lang = 'de') GROUP BY name
       HAVING bool_or(g) <> bool_or(NOT g)""",
)
# --------------------------------------------------------------- scalars
add(
    "pad_site_code",
    "user_id:i,site:s",
    """SELECT DISTINCT user_id, 'VAR' || CASE WHEN length(CAST(user_id AS VARCHAR)) < 3 THEN lpad(CAST(user_id AS VARCHAR), 3, '0')
       ELSE CAST(user_id AS VARCHAR) END AS site FROM events""",
)
add(
    "hydro_year",
    "date:D,hydyear:i,hyddoy:i",
    "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, year(l_shipdate + INTERVAL 122 DAYS) AS hydyear, dayofyear(l_shipdate + INTERVAL 122 DAYS) AS hyddoy FROM lineitem",
)
add(
    "month_sequence",
    "l_suppkey:i,month:D",
    """SELECT l_suppkey, unnest(generate_series(date_trunc('month', a), CASE WHEN date_trunc('month', b) = b THEN date_trunc('month', b)
       ELSE date_trunc('month', b) + INTERVAL 1 MONTH END, INTERVAL 1 MONTH)) AS month
       FROM (SELECT l_suppkey, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem GROUP BY l_suppkey)""",
)
CALIBRATED = "(-1.34e-8 * (moist * moist) + 2.50e-4 * moist + (-1.58e-1)) * 100e0"
add(
    "calibrate_moisture",
    "site:s,datetime:t,moist:d,percent:d",
    f"SELECT site, datetime, round({CALIBRATED}, 1) AS moist, {CALIBRATED} AS percent FROM rh",
)
# --------------------------------------------------------------- reshape
TYPES = ("click", "error", "purchase", "signup", "view")
PIVOT = "SELECT datetime, " + ", ".join(f"max(CASE WHEN site = '{t}' THEN T1 END) AS \"{t}\"" for t in TYPES) + " FROM rt GROUP BY datetime"
add("pivot_sites", "datetime:t," + ",".join(f"{t}:d" for t in TYPES), PIVOT)
GRID = """SELECT g.site, g.datetime, rt.T1, rt.moist, rt.T1 IS NULL AS T1_imp, rt.moist IS NULL AS moist_imp FROM
    (SELECT a.site, b.datetime FROM (SELECT DISTINCT site FROM rt) a, (SELECT DISTINCT datetime FROM rt) b) g
    LEFT JOIN rt ON rt.site = g.site AND rt.datetime = g.datetime"""
add("unpivot_sites", "datetime:t,site:s,T1:d", GRID)
add("unpivot_sensors", LONG, "SELECT * FROM annual_long")
add("dense_grid", "site:s,datetime:t,T1:d,moist:d,T1_imp:b,moist_imp:b", GRID)


# -------------------------------------------------------------- cleaning
def filled(table: str, key: str, carried: list[str], blank: list[str]) -> str:
    columns = ", ".join([f"CASE WHEN k = 0 THEN {c} END AS {c}" for c in blank])
    carry = [
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in carried
    ]
    return f"""SELECT {', '.join([key, *carried])}, datetime + to_minutes(CAST(k * step AS BIGINT)) AS datetime, {columns} FROM
      (SELECT *, unnest(CASE WHEN gap > 15 THEN generate_series(0, CAST(ceil(gap / step::DOUBLE) - 1 AS BIGINT)) ELSE [0] END) AS k FROM
       (SELECT *, CASE WHEN coalesce(prev, 15) % 15 = 0 THEN 15 ELSE 10 END AS step FROM
        (SELECT {', '.join([key, 'datetime', *carry, *blank])},
         date_diff('second', lag(datetime) OVER (PARTITION BY {key} ORDER BY datetime), datetime) / 60.0 AS prev,
         date_diff('second', datetime, lead(datetime) OVER (PARTITION BY {key} ORDER BY datetime)) / 60.0 AS gap FROM {table})))"""


VALUES = list(SENSORS)
add(
    "fill_gaps_logger",
    "site:s,tomst_id:i,datetime:t,T1:d,T2:d,T3:d,moist:d,probl:i",
    filled("rl", "tomst_id", ["site", "probl"], VALUES),
)
add("fill_gaps_site", HF, filled("rh", "site", ["tomst_id", "error_tomst"], VALUES))
CTES["file_registry"] = """SELECT DISTINCT 'S' || (n % 7) AS site, 94000000 + n AS tomst_id,
    CASE WHEN n % 5 <> 2 THEN TIMESTAMP '2023-06-01' + to_hours(n) END AS maxdt FROM (SELECT user_id // 5 AS n FROM events) WHERE n % 11 <> 3"""
CTES["file_errors"] = """SELECT DISTINCT 'S' || (user_id // 5 % 7) AS site, 94000000 + user_id // 5 AS tomst_id, CAST(ts AS DATE) AS start_date,
    CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS end_date, event_id % 11 AS probl, event_id % 2 AS new FROM events
    WHERE event_type = 'error' AND event_id % 16 < 2"""
CTES["file_readings"] = """SELECT s.site, r.logger AS tomst_id, r.stamp AS datetime, r.value AS T1, r.value AS T2, r.value AS T3,
    CAST(r.event_id % 4000 AS DOUBLE) AS moist FROM (SELECT *, row_number() OVER (PARTITION BY file, stamp ORDER BY event_id DESC) AS k FROM file_lines
     WHERE reason IS NULL AND file IN (SELECT file FROM file_kinds WHERE reject IS NULL)) r
    LEFT JOIN (SELECT DISTINCT site, tomst_id FROM file_registry) s ON s.tomst_id = r.logger WHERE k = 1"""
CTES["file_labelled"] = """SELECT r.*, coalesce((SELECT min(nullif(l.probl, 0)) FROM file_errors l WHERE l.site = r.site AND l.tomst_id = r.tomst_id
    AND CAST(r.datetime AS DATE) BETWEEN l.start_date AND l.end_date), 0) AS probl FROM file_readings r
    WHERE site IS NOT NULL AND datetime > DATE '2018-06-01' AND datetime < DATE '2024-01-25'"""
CTES["file_regular"] = filled("file_labelled", "tomst_id", ["site", "probl"], VALUES)
CTES["file_kept"] = f"""SELECT site, datetime, tomst_id, {", ".join(VALUES)}, probl AS error_tomst FROM
    (SELECT *, count(*) OVER (PARTITION BY tomst_id, minute(datetime)) / CAST(count(*) OVER (PARTITION BY tomst_id) AS DOUBLE) AS share
     FROM file_regular WHERE probl <> 2) WHERE share >= 0.0001 QUALIFY row_number() OVER (PARTITION BY site, datetime ORDER BY tomst_id) = 1"""
add("stage02_raw", HF, filled("file_kept", "site", ["tomst_id", "error_tomst"], VALUES))
NEWEST = "SELECT * FROM file_registry UNION SELECT site, tomst_id, max(datetime) AS maxdt FROM file_readings GROUP BY site, tomst_id"
add("stage02_registry", "site:s,tomst_id:i,maxdt:t", f"SELECT * FROM ({NEWEST}) AS newest WHERE site IS NOT NULL AND maxdt IS NOT NULL")
add("stage02_registry_keeping_nulls", "site:s,tomst_id:i,maxdt:t", NEWEST)
add("stage02_ledger", "site:s,tomst_id:i,start_date:D,end_date:D,probl:i", "SELECT DISTINCT * FROM file_errors WHERE new = 1")
add(
    "stage02_bias",
    "tomst_id:i,T1:d,T2:d,T3:d",
    """SELECT DISTINCT 94000000 + n AS tomst_id, (n % 7 - 3) / 16e0 AS T1, (n % 3 - 1) / 8e0 AS T2, (n % 5 - 2) / 32e0 AS T3
       FROM (SELECT user_id // 5 AS n FROM events) WHERE n % 2 = 0 AND n % 3 <> 0""",
)
add(
    "local_readings",
    "file:s,row:i,datetime:t",
    """SELECT file, event_id AS row, stamp + INTERVAL 2 HOUR AS datetime FROM (SELECT *, row_number() OVER (PARTITION BY file, stamp ORDER BY event_id DESC) AS k
       FROM file_lines WHERE reason IS NULL AND file IN (SELECT file FROM file_kinds WHERE reject IS NULL)) WHERE k = 1""",
)
add("registry_from_csv", "site:s,tomst_id:i,maxdt:t", "SELECT * FROM file_registry")
add(
    "bias_from_csv",
    "tomst_id:i,T1:d,T2:d,T3:d",
    """SELECT DISTINCT 94000000 + n AS tomst_id, CASE WHEN (94000000 + n) % 7 NOT IN (3, 4) THEN (n % 7 - 3) / 16e0 END AS T1,
       CASE WHEN n % 3 <> 0 THEN (n % 3 - 1) / 8e0 END AS T2, (n % 5 - 2) / 32e0 AS T3 FROM (SELECT user_id // 5 AS n FROM events) WHERE n % 2 = 0""",
)
add(
    "combine_sensors",
    "site:s,datetime:t," + ",".join(f"{s}:d" for s in SENSORS) + "," + ",".join(f"{s}_imp:b" for s in SENSORS),
    "SELECT * FROM "
    + " FULL JOIN ".join(
        f"(SELECT site, datetime, {s}, hour(datetime) % 2 = {k % 2} AS {s}_imp FROM rt WHERE hour(datetime) % {k + 2} <> 1)" + (" USING (site, datetime)" if k else "")
        for k, s in enumerate(SENSORS)
    ),
)
ORACLE["stage02_rejects"] = ORACLE["scan_rejects"]
CTES["exact"] = "SELECT user_id, date_trunc('second', ts)::TIMESTAMP AS datetime, max(value) AS value FROM events GROUP BY ALL"
add("fill_gaps_seconds", "user_id:i,datetime:t,value:d", filled("exact", "user_id", [], ["value"]))
add(
    "step_sizes_seconds",
    "user_id:i,step:d,n:i",
    """SELECT user_id, step, count(*) AS n FROM (SELECT user_id,
       date_diff('second', lag(datetime) OVER (PARTITION BY user_id ORDER BY datetime), datetime) / 60.0 AS step FROM exact)
       WHERE step IS NOT NULL GROUP BY ALL""",
)
add(
    "drop_stray_minutes",
    "tomst_id:i,datetime:t,event_id:i",
    """SELECT user_id % 30 AS tomst_id, ts AS datetime, event_id FROM events QUALIFY
       count(*) OVER (PARTITION BY user_id % 30, minute(ts)) / CAST(count(*) OVER (PARTITION BY user_id % 30) AS DOUBLE) >= 0.012""",
)
NEAR = [f"abs(T3 - lag(T3, {k}) OVER w)" for k in range(1, 7)] + [f"abs(T3 - lead(T3, {k}) OVER w)" for k in (1, 3)]
add(
    "estimate_bias",
    "tomst_id:i,T1:d,T2:d,T3:d",
    f"""SELECT tomst_id, round(a - m, 4) AS T1, round(b - m, 4) AS T2, round(c - m, 4) AS T3 FROM
        (SELECT *, list_sort([a, b, c])[2] AS m FROM
         (SELECT tomst_id, avg(T1) AS a, avg(T2) AS b, avg(T3) AS c FROM
          (SELECT *, {' AND '.join(f'({n}) <= 0.125' for n in NEAR)} AS stable FROM idle
           WHERE (tomst_id, CAST(datetime AS DATE)) IN (SELECT tomst_id, d FROM
             (SELECT tomst_id, CAST(datetime AS DATE) AS d, max(CAST(datetime AS DATE)) OVER (PARTITION BY tomst_id) AS last
              FROM idle WHERE probl = 2) WHERE d < last)
           WINDOW w AS (PARTITION BY tomst_id ORDER BY datetime)) WHERE stable GROUP BY tomst_id))""",
)
add("mask_visits", HF, "SELECT * FROM rh_visits")
LIMITS = {"T1": "T1 < -40 OR T1 > 30", "T2": "T2 < -60 OR T2 > 50", "T3": "T3 < -60 OR T3 > 50", "moist": "moist < 200 OR moist >= 4080"}


def ranged(table: str, order: str) -> str:
    masks = ", ".join(f"CASE WHEN {hit(f'({c})', 1, 3, order)} = 0 THEN {s} END AS {s}" for s, c in LIMITS.items())
    return f"SELECT site, tomst_id, datetime, {masks}, error_tomst FROM {table}"


add("mask_range", HF, ranged("rh_codes", W))
add("mask_codes", HF, "SELECT * FROM rh_codes")


def regular(table: str, sensors: tuple[str, ...]) -> str:
    """Grid by hand: all stamps of grid and data, interpolation over lone nulls, grid rows kept."""
    near = ", ".join(f"lag({s}) OVER w AS p_{s}, lead({s}) OVER w AS f_{s}" for s in sensors)
    value = ", ".join(
        f"""CASE WHEN mixed THEN coalesce({s}, p_{s} + (f_{s} - p_{s}) * (epoch(datetime) - epoch(pt)) / (epoch(ft) - epoch(pt)))
        ELSE {s} END AS {s}"""
        for s in sensors
    )
    carry = ", ".join(
        f"""CASE WHEN mixed THEN last_value({c} IGNORE NULLS) OVER (PARTITION BY site ORDER BY datetime ROWS BETWEEN UNBOUNDED
        PRECEDING AND CURRENT ROW) ELSE {c} END AS {c}"""
        for c in ("tomst_id", "error_tomst")
    )
    return f"""SELECT site, {carry}, datetime, {', '.join(sensors)} FROM
      (SELECT site, datetime, tomst_id, error_tomst, mixed, keep, {value} FROM
       (SELECT *, {near}, lag(datetime) OVER w AS pt, lead(datetime) OVER w AS ft FROM
        (SELECT coalesce(x.site, g.site) AS site, coalesce(x.datetime, g.datetime) AS datetime, x.tomst_id, x.error_tomst,
         {', '.join('x.' + s for s in sensors)}, coalesce(x.mixed, g.mixed) AS mixed, g.site IS NOT NULL AS keep FROM
         (SELECT a.*, p.mixed FROM {table} a JOIN plan p USING (site)) x FULL JOIN
         (SELECT site, mixed, unnest(generate_series(t0, t1, INTERVAL 15 MINUTES)) AS datetime FROM plan WHERE mixed) g
         ON x.site = g.site AND x.datetime = g.datetime)
        WINDOW w AS (PARTITION BY site ORDER BY datetime))) WHERE keep OR NOT mixed"""


def plan(table: str) -> str:
    return f"""SELECT site, min(datetime) AS t0, max(datetime) AS t1,
        coalesce(count(DISTINCT step) > 1 OR bool_or(step = 10), false) AS mixed
        FROM (SELECT site, datetime, date_diff('second', lag(datetime) OVER (PARTITION BY site ORDER BY datetime), datetime) / 60.0 AS step
        FROM {table}) GROUP BY site"""


ROWS15 = """SELECT 'L' || tomst_id AS site, tomst_id, datetime, CASE WHEN T1 < 4 THEN T1 END AS T1, T2, T3, moist, probl AS error_tomst FROM rl"""
CTES["rows15"] = ROWS15
CTES["plan"] = plan("rows15")
add("regularise_15min", HF, regular("rows15", SENSORS))
add(
    "apply_overrides",
    HF,
    """SELECT coalesce(target, site) AS site, tomst_id, datetime, CASE WHEN NOT b_t1 THEN T1 END AS T1, T2, T3,
       CASE WHEN NOT b_moist THEN moist END AS moist, error_tomst FROM
       (SELECT r.*, (SELECT min(target) FROM rules u WHERE u.site = r.site AND u.action = 'rename' AND covers(r.datetime, u.after, u.before)) AS target,
        EXISTS (SELECT 1 FROM rules u WHERE u.site = r.site AND u.action = 'delete' AND covers(r.datetime, u.after, u.before)) AS gone,
        EXISTS (SELECT 1 FROM rules u WHERE u.site = r.site AND u.action = 'null' AND u.col = 'T1' AND covers(r.datetime, u.after, u.before)) AS b_t1,
        EXISTS (SELECT 1 FROM rules u WHERE u.site = r.site AND u.action = 'null' AND u.col = 'moist' AND covers(r.datetime, u.after, u.before)) AS b_moist
        FROM rh r) WHERE NOT gone""".replace(
        "covers(r.datetime, u.after, u.before)",
        "(u.after IS NULL OR CAST(r.datetime AS DATE) > u.after) AND CAST(r.datetime AS DATE) < u.before",
    ),
)
for sensor in SENSORS:
    add(
        f"peaks_{sensor.lower()}",
        f"site:s,datetime:t,{sensor}_peak:b,{sensor}_masked:b",
        f"SELECT site, datetime, {sensor}_peak, {hit(f'{sensor}_peak', 2, 5)} = 1 AS {sensor}_masked FROM ({peaks_select('rt', sensor)})",
    )
add(
    "peak_counts",
    "sensor:s,n_peaks:i",
    " UNION ALL ".join(
        f"SELECT '{s}' AS sensor, sum(CAST({s}_peak AS INT)) AS n_peaks FROM ({peaks_select('rt', s)})" for s in SENSORS
    ),
)
add(
    "peaks_v2023",
    "site:s,datetime:t," + ",".join(f"{s}_peak:b" for s in SENSORS),
    f"SELECT * FROM ({peaks_select('rt', 'T1', '2023')}) a "
    + " ".join(f"JOIN ({peaks_select('rt', s, '2023')}) USING (site, datetime)" for s in SENSORS[1:]),
)
add(
    "registry_update",
    "site:s,tomst_id:i,maxdt:t",
    "SELECT site, tomst_id, maxdt FROM visits UNION SELECT site, tomst_id, max(datetime) FROM rh GROUP BY ALL",
)
add("ledger_update", "site:s,tomst_id:i,start_date:D,end_date:D,probl:i", "SELECT * FROM ledger WHERE probl < 7 UNION SELECT * FROM ledger WHERE probl > 4")

# The cleaning chains, step by step.
L = "PARTITION BY site, tomst_id ORDER BY datetime"
CTES["c_visits"] = CTES["rh_visits"].replace("FROM rh ", "FROM rh_bias ")
CTES["c_range"] = ranged("c_visits", L)
CTES["c_codes"] = CTES["rh_codes"].replace("FROM rh", "FROM c_range")
CTES["c_plan"] = plan("c_codes")
CTES["c_regular"] = regular("c_codes", SENSORS).replace("plan", "c_plan")
CTES["c_flags"] = "SELECT a.* FROM (SELECT site, datetime, tomst_id, error_tomst FROM c_regular) a"
for sensor in SENSORS:
    CTES[f"c_peak_{sensor}"] = (
        f"SELECT site, datetime, CASE WHEN {hit(f'{sensor}_peak', 2, 5)} = 0 THEN {sensor} END AS {sensor} FROM ({peaks_select('c_regular', sensor)})"
    )
CTES["c_masked"] = "SELECT * FROM c_flags " + " ".join(f"JOIN c_peak_{s} USING (site, datetime)" for s in SENSORS)
CTES["c_codes2"] = "SELECT site, tomst_id, datetime, CASE WHEN error_tomst <> 2 THEN T2 END AS T2, error_tomst FROM c_range"
CTES["c_plan2"] = plan("c_codes2")
CTES["c_regular2"] = regular("c_codes2", ("T2",)).replace("plan", "c_plan2")
add("clean_series", HF, filled("c_masked", "site", ["tomst_id", "error_tomst"], VALUES))
add("clean_append", HF, filled("c_masked", "site", ["tomst_id", "error_tomst"], VALUES))
CHAIN = ["rh", "rh_bias", "c_visits", "c_range", "c_codes", "c_plan", "c_regular", "c_flags", *[f"c_peak_{s}" for s in SENSORS], "c_masked"]
AREA_SITES = {"MAT": ("", "0 AND 3", "4080"), "VIN": ("2023 VIN", "4 AND 6", "4096"), "RAS": ("2023", "7 AND 9", "4096")}
for code, (version, numbers, ceiling) in AREA_SITES.items():
    for name in CHAIN[1:]:
        body = CTES[name].replace("moist >= 4080", f"moist >= {ceiling}")
        if name.startswith("c_peak_"):
            sensor = name.removeprefix("c_peak_")
            body = f"SELECT site, datetime, CASE WHEN {hit(f'{sensor}_peak', 2, 5)} = 0 THEN {sensor} END AS {sensor} FROM ({peaks_select('c_regular', sensor, version)})"
        CTES[f"{name}_{code}"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(CHAIN)})\b", rf"\1 \2_{code}", body)
    CTES[f"rh_{code}"] = f"SELECT * FROM rh WHERE CAST(substr(site, 2) AS INT) % 10 BETWEEN {numbers}"
    CTES[f"filled_{code}"] = filled(f"c_masked_{code}", "site", ["tomst_id", "error_tomst"], VALUES)
add("clean_areas", "area:s," + HF, " UNION ALL ".join(f"SELECT *, '{a}' AS area FROM filled_{a}" for a in AREA_SITES))
add(
    "clean_areas_peaks",
    "area:s,sensor:s,n_peaks:i",
    " UNION ALL ".join(
        f"SELECT '{a}' AS area, '{s}' AS sensor, coalesce(sum(CAST({s}_peak AS INT)), 0) AS n_peaks FROM ({peaks_select(f'c_regular_{a}', s, v)})"
        for a, (v, _, _) in AREA_SITES.items()
        for s in SENSORS
    ),
)
ORACLE["peak_counts_observed"] = ORACLE["peak_counts"]
add(
    "clean_t2_for_snow",
    "site:s,tomst_id:i,datetime:t,T2:d,error_tomst:i",
    f"""SELECT site, tomst_id, datetime, CASE WHEN {hit('T2_peak', 2, 5)} = 0 THEN T2 END AS T2, error_tomst FROM
        ({peaks_select('c_regular2', 'T2')}) JOIN (SELECT site, datetime, tomst_id, error_tomst FROM c_regular2) USING (site, datetime)""",
)
# ------------------------------------------------------------ imputation
add(
    "pmm_match",
    "event_id:i,matched:d",
    """SELECT event_id, coalesce(observed, arg_min(v, k)) AS matched FROM
       (SELECT q.event_id, q.observed, d.v, (abs(d.p - q.p), d.t) AS k FROM
        (SELECT event_id, event_type, floor(value * 2) / 2 AS p, CASE WHEN event_id % 7 = 0 THEN value END AS observed FROM events) q
        LEFT JOIN (SELECT event_type, floor(value * 2) / 2 AS p, min(ts) AS t, arg_min(value, ts) AS v FROM events
         WHERE event_id % 7 = 0 GROUP BY ALL) d ON d.event_type = q.event_type AND q.observed IS NULL)
       GROUP BY event_id, observed""",
)
add(
    "pmm_match_draw",
    "event_id:i,matched:d",
    """SELECT event_id, coalesce(observed, vs[1 + h % len(vs)]) AS matched FROM
       (SELECT q.event_id, q.observed, q.h, list(d.v ORDER BY abs(d.p - q.p), d.t, d.v)[1:3] AS vs FROM
        (SELECT event_id, event_type, floor(value * 2) / 2 AS p, CASE WHEN event_id % 7 = 0 THEN value END AS observed,
         CAST('0x' || substr(md5('5 ' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 8) AS BIGINT) AS h FROM events) q
        LEFT JOIN (SELECT event_type, floor(value * 2) / 2 AS p, ts AS t, value AS v FROM events WHERE event_id % 7 = 0) d
         ON d.event_type = q.event_type AND q.observed IS NULL
        GROUP BY q.event_id, q.observed, q.h)""",
)
add(
    "impute_invariants",
    "site:s,n:i,n_imputed:i,n_null:i,kept:d,n_invented:i",
    """SELECT site, (SELECT count(DISTINCT datetime) FROM rt) AS n, (SELECT count(DISTINCT datetime) FROM rt) - count(T1) AS n_imputed,
       0 AS n_null, sum(T1) AS kept, 0 AS n_invented FROM rt GROUP BY site""",
)
CTES["grid"] = GRID
add(
    "frozen_moisture",
    "site:s,datetime:t,moist:d,moist_imp:b",
    """SELECT site, datetime, m AS moist, CASE WHEN m IS NULL THEN NULL WHEN covered THEN hidden IS NULL ELSE false END AS moist_imp FROM
       (SELECT *, CASE WHEN t >= 1 THEN CASE WHEN covered THEN coalesce(hidden, 500) ELSE moist END END AS m FROM
        (SELECT *, 5 * count(hidden) OVER (PARTITION BY datetime) > (SELECT count(DISTINCT site) FROM rt) AS covered FROM
         (SELECT *, coalesce(T1, 2) AS t, CASE WHEN T1 >= 1 THEN moist END AS hidden FROM grid)))""",
)
# --------------------------------------------------- temperature indices
for name in ("TDD", "TDD_days", "GDD3", "GDD3_days", "GDD5", "GDD5_days", "FDD", "FDD_days", "TDH", "GDH3", "GDH5", "FDH"):
    add(f"idx_{name.lower()}", WIDE, degree_select(name))
add("idx_annual_mean", WIDE, "SELECT * FROM annual")
add("idx_month_mean", WIDE, "SELECT * FROM month_means")
add("idx_season_t1", LONG, "SELECT * FROM season_t1")
add("idx_season_t3", LONG, "SELECT * FROM season_t3")
for name in ("gst1_frost", "gst3_frost", "summer_frost", "freeze_thaw"):
    add(f"idx_{name}", LONG, f"SELECT * FROM {name}")
add("idx_annual_min", WIDE, "SELECT * FROM annual_ext WHERE var = 'min'")
add("idx_annual_max", WIDE, "SELECT * FROM annual_ext WHERE var = 'max'")
add("idx_annual_range", WIDE, "SELECT * FROM annual_rng")
WIDE_COLUMNS = "site, var, period, year, T1, T2, T3, T1_imp, T2_imp, T3_imp"
ALL_WIDE = " UNION ALL ".join(
    [f"SELECT {WIDE_COLUMNS} FROM {t}" for t in ("annual", "annual_ext", "annual_rng", "month_means", "mean_range", "month_ext")]
    + [degree_select(n) for n in ("TDD", "TDD_days", "GDD3", "GDD3_days", "GDD5", "GDD5_days", "FDD", "FDD_days", "TDH", "GDH3", "GDH5", "FDH")]
)
CTES["all_wide"] = ALL_WIDE
add(
    "temperature_indices",
    LONG,
    " UNION ALL ".join(
        [
            f"""SELECT site, var, period, year, '{t}' AS sensor, {t} AS value, {t}_imp AS imputed_percentage FROM all_wide
            WHERE {t} IS NOT NULL AND {t}_imp IS NOT NULL"""
            for t in TEMPS
        ]
        + [f"SELECT * FROM {n} WHERE value IS NOT NULL AND imputed_percentage IS NOT NULL"
           for n in ("season_t1", "season_t3", "gst1_frost", "gst3_frost", "summer_frost", "freeze_thaw")]
    ),
)
# ------------------------------------------------------ moisture indices
add("complete_years", "site:s,year:i", "SELECT site, year FROM t1_years")


def statistics(days: str) -> str:
    """The 13 statistics per period label of a table of days, as rows."""
    both = f"""SELECT site, year, period, 'moist' AS moist_type, moist AS x, moist_imp FROM ({days})
      UNION ALL SELECT site, year, period, 'moistsat', moistsat, moist_imp FROM ({days})"""
    wide = bundle_select(f"({both})", "site, year, period, moist_type", r2("100 * avg(moist_imp)"))
    known = " AND ".join(f"{s} IS NOT NULL" for s in STATS)
    rows = " UNION ALL ".join(f"SELECT '{s}' AS var, w.{s} AS value" for s in STATS)
    return f"""SELECT site, u.var, period, year, imp AS imputed_percentage, moist_type, u.value FROM
      (SELECT *, count(CASE WHEN {known} AND imp IS NOT NULL THEN 1 END) OVER (PARTITION BY site, year, period) AS ok FROM ({wide})) w,
      LATERAL ({rows}) u WHERE ok = 2"""


DAYS = {
    "monthly": "SELECT site, year, strftime(date, '%b') AS period, moist, moistsat, moist_imp FROM mdaily WHERE na_prop < 0.5",
    "ice_free": "SELECT site, year, 'ice_free_season' AS period, moist, moistsat, moist_imp FROM whole_days",
    "growing": "SELECT site, year, 'growing_season' AS period, moist, moistsat, moist_imp FROM season_days",
    "first14": "SELECT site, year, 'first_two_weeks_of_GS' AS period, moist, moistsat, moist_imp FROM start_rank WHERE k <= 14",
    "first28": "SELECT site, year, 'first_four_weeks_of_GS' AS period, moist, moistsat, moist_imp FROM start_rank WHERE k <= 28",
    "quarters": """SELECT site, year, CASE q WHEN 1 THEN '1st' WHEN 2 THEN '2nd' WHEN 3 THEN '3rd' ELSE '4th' END || '_quartile_growing_season' AS period,
        moist, moistsat, moist_imp FROM (SELECT *, ntile(4) OVER (PARTITION BY site, year ORDER BY doy) AS q FROM season_days
        WHERE moist IS NOT NULL AND moistsat IS NOT NULL AND moist_imp IS NOT NULL)""",
}
add("moist_monthly", MOIST, statistics(DAYS["monthly"]))
add("moist_ice_free", MOIST, statistics(DAYS["ice_free"]))
add("season_bounds", "site:s,year:i,start_of_season:i,end_of_season:i", "SELECT * FROM bounds")
add("moist_growing", MOIST, statistics(DAYS["growing"]))
add("moist_first14", MOIST, statistics(DAYS["first14"]))
add("moist_first28", MOIST, statistics(DAYS["first28"]))
add("season_quartiles", MOIST, statistics(DAYS["quarters"]))


def weeks(table: str, period: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{v}' AS var, '{t}' AS moist_type, {x} AS value"
        for v, t, x in (
            ("name", "moist", "b.moist"), ("name", "moistsat", "b.moistsat"),
            ("timing", "moist", "b.doy"), ("timing", "moistsat", "b.doy"),
        )
    )
    return f"""SELECT site, CASE WHEN u.var = 'timing' THEN CASE WHEN dry THEN 'driest_two_weeks_timing' ELSE 'wettes_two_weeks_timing' END
      WHEN dry THEN 'driest_two_weeks' ELSE 'wettest_two_weeks' END AS var, '{period}' AS period, year, imputed_percentage, moist_type, u.value
      FROM (SELECT *, true AS dry, row_number() OVER (PARTITION BY site, year ORDER BY moist, doy) AS r FROM {table}
       UNION ALL SELECT *, false, row_number() OVER (PARTITION BY site, year ORDER BY moist DESC, doy) FROM {table}) b,
      LATERAL ({rows}) u WHERE r = 1"""


add("moist_extreme_weeks", MOIST, weeks("rolled_whole", "ice_free_season"))
add("moist_extreme_weeks_gs", MOIST, weeks("rolled_season", "growing_season"))
add(
    "moisture_indices",
    MOIST,
    " UNION ALL ".join(
        [f"SELECT * FROM ({statistics(x)})" for x in DAYS.values()]
        + [f"SELECT * FROM ({weeks('rolled_whole', 'ice_free_season')})", f"SELECT * FROM ({weeks('rolled_season', 'growing_season')})"]
        + [f"SELECT * FROM ({trend('whole_days', 'moist')})", f"SELECT * FROM ({trend('season_days', 'moistsat')})"]
    ),
)
# ---------------------------------------------------------- snow indices
add("daily_minmax", "site:s,date:D,T2_min:d,T2_max:d,T2_imp:d", "SELECT * FROM minmax")
add("snow_day_flags", "site:s,date:D,snow:i", "SELECT * FROM snow_flags")
add("midsummer_doy", "site:s,midsummer_doy:i", "SELECT * FROM midsummer")
add("snow_year", "site:s,date:D,hydyear:i,doy:i,hyddoy:i,snow:i,T2_imp:d", "SELECT * FROM snow_cal")
add("snow_on_off", SNOW, "SELECT * FROM on_off")
add("snow_periods", SNOW, "SELECT * FROM snow_runs")
add("snow_indices", SNOW, "SELECT * FROM on_off UNION ALL SELECT * FROM snow_runs")
# ---------------------------------------------------------------- export
CTES["e_range"] = ranged("rh_visits", L).replace("T1 < -40", "T1 < -30")
CTES["e_codes"] = CTES["rh_codes"].replace("FROM rh", "FROM e_range")
CTES["e_any"] = "SELECT * FROM e_codes WHERE coalesce(T1, T2, T3, moist) IS NOT NULL"
CTES["series"] = (
    "SELECT site AS Site_id, tomst_id AS Raw_data_identifier, datetime, T1, T2, T3, moist AS Soil_moisture FROM ("
    + filled("e_any", "site", ["tomst_id"], VALUES)
    + ")"
)
EXPORT_SENSORS = ("T1", "T2", "T3", "Soil_moisture")
CTES["series_long"] = " UNION ALL ".join(
    f"SELECT Site_id, Raw_data_identifier, datetime, '{s}' AS Sensor_code, {s} AS value FROM series" for s in EXPORT_SENSORS
)
CTES["spans"] = """SELECT Site_id, Raw_data_identifier, Sensor_code, year(fd) AS Start_date_year, month(fd) AS Start_date_month,
    day(fd) AS Start_date_day, year(ld) AS End_date_year, month(ld) AS End_date_month, day(ld) AS End_date_day FROM
    (SELECT Site_id, Raw_data_identifier, Sensor_code, min(datetime) + INTERVAL 1 DAY AS fd, max(datetime) AS ld
     FROM series_long WHERE value IS NOT NULL AND Raw_data_identifier IS NOT NULL GROUP BY ALL)"""
add("export_clean", "Site_id:s,Raw_data_identifier:i,datetime:t,T1:d,T2:d,T3:d,Soil_moisture:d", "SELECT * FROM series")
PARTS = "Start_date_year:i,Start_date_month:i,Start_date_day:i,End_date_year:i,End_date_month:i,End_date_day:i"
add("sensor_spans", "Site_id:s,Raw_data_identifier:i,Sensor_code:s," + PARTS, "SELECT * FROM spans")
add(
    "export_metadata",
    "meta_id:i,Country_code:s,Experiment_name:s,Experimental_manipulation:s,Experiment_insitu:s,Experiment_climate:s,"
    "Experiment_citizens:s,Experiment_design:s,Experiment_doi:s,Experiment_comment:s,Site_id:s,Elevation:d,Habitat_type:i,"
    "Habitat_sub_type:i,Site_comments:s,Logger_code:i,Raw_data_identifier:i,Latitude:d,Longitude:d,EPSG:i,GPS_accuracy:i,"
    "Logger_serial_number:i,Logger_brand:s,Logger_type:s,Logger_age:i,Logger_comment:s,Sensor_code:s,Sensor_shielding:s,"
    "Sensor_shielding_type:s,Microclimate_measurement:s,Unit:s,Sensor_accuracy:d,Temporal_resolution:d,Sensor_height:d,"
    "Sensor_length:d," + PARTS + ",Timezone:s,Time_difference:i,Licence:s,Sensor_comments:s,Species_composition:s,Species_trait:s",
    """SELECT row_number() OVER (ORDER BY s.Site_id, s.Raw_data_identifier, s.Sensor_code) AS meta_id, 'NO' AS Country_code,
       'Test' AS Experiment_name, 'No' AS Experimental_manipulation, 'Yes' AS Experiment_insitu, 'No' AS Experiment_climate,
       'No' AS Experiment_citizens, '' AS Experiment_design, '' AS Experiment_doi, '' AS Experiment_comment, s.*,
       NULL AS Elevation, 4 AS Habitat_type, 1 AS Habitat_sub_type, '' AS Site_comments, s.Raw_data_identifier AS Logger_code,
       c.Lat AS Latitude, c.Lon AS Longitude, 4326 AS EPSG, 5 AS GPS_accuracy, s.Raw_data_identifier AS Logger_serial_number,
       'B' AS Logger_brand, 'L' AS Logger_type, 2021 AS Logger_age, '' AS Logger_comment,
       CASE WHEN Sensor_code IN ('T2', 'T3') THEN 'Yes' ELSE 'No' END AS Sensor_shielding,
       CASE WHEN Sensor_code IN ('T2', 'T3') THEN 'No' ELSE '-' END AS Sensor_shielding_type,
       CASE WHEN Sensor_code = 'Soil_moisture' THEN 'Soil_moisture' ELSE 'Temperature' END AS Microclimate_measurement,
       CASE WHEN Sensor_code = 'Soil_moisture' THEN 'raw' ELSE '°C' END AS Unit,
       CASE WHEN Sensor_code = 'Soil_moisture' THEN 1 ELSE 0.5 END AS Sensor_accuracy, f.Temporal_resolution,
       CASE Sensor_code WHEN 'T1' THEN -6 WHEN 'T2' THEN 2 WHEN 'T3' THEN 15 ELSE -7.5 END AS Sensor_height,
       CASE WHEN Sensor_code = 'Soil_moisture' THEN 15 END AS Sensor_length, 'UTC' AS Timezone, 0 AS Time_difference,
       'CC-BY' AS Licence, '' AS Sensor_comments, 'Yes' AS Species_composition, 'Yes' AS Species_trait
       FROM spans s LEFT JOIN coords c ON c.site = s.Site_id LEFT JOIN
       (SELECT Raw_data_identifier, arg_min(step, (n, step)) AS Temporal_resolution FROM
        (SELECT Raw_data_identifier, step, count(*) AS n FROM (SELECT Raw_data_identifier, date_diff('second', lag(datetime) OVER (PARTITION BY Raw_data_identifier ORDER BY datetime), datetime) / 60.0 AS step FROM series)
         WHERE step IS NOT NULL GROUP BY ALL) GROUP BY ALL) f ON f.Raw_data_identifier = s.Raw_data_identifier""",
)
add(
    "habitat_lookup",
    "Site_id:s,tomst_id:i,Habitat_type:i,Habitat_sub_type:i",
    """SELECT DISTINCT r.site AS Site_id, tomst_id, CASE WHEN c.Lat > 60.5 THEN 5 ELSE 1 END AS Habitat_type,
       CASE WHEN c.Lat > 60.5 THEN 4 ELSE 1 END AS Habitat_sub_type FROM rh r LEFT JOIN coords c ON c.site = r.site""",
)
add(
    "export_series",
    "Raw_data_identifier:i,Year:i,Month:i,Day:i,Time:s,T1:d,T2:d,T3:d,Soil_moisture:d",
    """SELECT *, year(datetime) AS Year, month(datetime) AS Month, day(datetime) AS Day, strftime(datetime, '%H:%M') AS Time FROM series""",
)
add(
    "export_metadata_legacy",
    "Country_code:s,Location_code:s,Logger_code:s,Sensor_code:s,Sensor_height:i,Raw_data_identifier:s,Microclimate_measurement:s,"
    "Latitude:d,Longitude:d,EPSG:i,GPS_accuracy:i,Sensor_accuracy:d,Logger_shielding:s,Habitat_type:s,Habitat_sub_type:s,"
    "Start_date_year:i,Start_date_month:i,Start_date_date:i,End_date_year:i,End_date_month:i,End_date_date:i,Temporal_resolution:i,"
    "Timezone:s,Species_composition:s,Species_trait:s,Plot_size:d,Forest_canopy_cover:d,Data_open_access:s,Meta_data_open_access:s",
    """SELECT 'NO' AS Country_code, Site_id AS Location_code, Site_id || '_tomst' AS Logger_code, Sensor_code,
       CASE Sensor_code WHEN 'T1' THEN -6 WHEN 'T2' THEN 2 WHEN 'T3' THEN 15 ELSE -15 END AS Sensor_height,
       Site_id || '_tomst' AS Raw_data_identifier,
       CASE WHEN Sensor_code = 'Soil_moisture' THEN 'Soil_moisture' ELSE 'Temperature' END AS Microclimate_measurement,
       Lat AS Latitude, Lon AS Longitude, 4326 AS EPSG, 5 AS GPS_accuracy, 0.5 AS Sensor_accuracy,
       CASE WHEN Sensor_code IN ('T1', 'Soil_moisture') THEN 'No shield' ELSE 'Shield' END AS Logger_shielding,
       '4' AS Habitat_type, '4.2' AS Habitat_sub_type, year(a) AS Start_date_year, month(a) AS Start_date_month,
       day(a) AS Start_date_date, year(b) AS End_date_year, month(b) AS End_date_month, day(b) AS End_date_date,
       15 AS Temporal_resolution, 'UTC' AS Timezone, 'yes' AS Species_composition, 'no' AS Species_trait,
       NULL AS Plot_size, NULL AS Forest_canopy_cover, 'yes' AS Data_open_access, 'yes' AS Meta_data_open_access FROM
       (SELECT Site_id, Sensor_code, min(CASE WHEN value IS NOT NULL THEN datetime END) AS a,
        max(CASE WHEN value IS NOT NULL THEN datetime END) AS b FROM series_long GROUP BY ALL) LEFT JOIN coords c ON c.site = Site_id""",
)

ORACLE["drop_stray_minutes_default"] = ORACLE["drop_stray_minutes"].replace("0.012", "0.0001")
