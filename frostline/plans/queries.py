"""Every operator as a query over the test tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline import config
from frostline.config import AREAS
from frostline.functions import scalars
from frostline.functions.nulls import strict_quantile, thermal_sum
from frostline.functions.stats import STAT_NAMES, bundle_aggregates, bundle_columns
from frostline.operators import (
    bias,
    chunks,
    dedup,
    export,
    gaps,
    impute,
    ledger,
    manifest,
    masks,
    moisture,
    peaks,
    periods,
    quality,
    registry,
    resample,
    reshape,
    rolling,
    runs,
    snow,
    thermal,
)
from frostline.plans import append, areas, pipelines, standins as st
from frostline.session import new_stage_path, stage
from frostline.sources import logger_files, published, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places, whole numbers to long, dates to text: one form in both engines.

    The nudge keeps exact halves, which sixteenths of a degree produce all the time, from rounding
    up in one engine and down in the other.
    """

    def form(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double") + F.lit(1e-9), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        return c.alias(f.name)

    return df.select(*[form(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


def register(name: str, fn: Query) -> None:
    fn.__name__ = name
    query(fn)


# ---------------------------------------------------------------- sources (A)


def _raw_rows(spark, d):
    return logger_files.split_logger_lines(st.logger_lines(spark, d).select("path", "value"))


@query
def scan_logger_files(spark, d):
    return logger_files.readings_from_rows(_raw_rows(spark, d), ntz=True)


@query
def reject_short_files(spark, d):
    return logger_files.reject_short_files(_raw_rows(spark, d)).select("path", "V1", "V2")


@query
def logger_id_from_path(spark, d):
    return st.manifest(spark, d).select("path", scalars.logger_id_from_path(F.col("path")).alias("tomst_id"))


@query
def parse_logger_time(spark, d):
    return _raw_rows(spark, d).select("V1", scalars.parse_logger_time(F.col("V2"), ntz=True).alias("datetime"))


@query
def parse_decimal_comma(spark, d):
    return _raw_rows(spark, d).select("V1", scalars.parse_decimal_comma(F.col("V4")).alias("T1"))


@query
def dedup_keep_last(spark, d):
    return logger_files.dedup_in_file(_raw_rows(spark, d)).select("path", "V2", "V1")


def _written_lines(spark, d):
    return logger_files.read_logger_lines(spark, st.written_logger_files(spark, d), "part-*", r"/file=data_[^/]*/[^/]*$")


def _scanned(spark, d):
    return logger_files.readings_and_rejects(_written_lines(spark, d))


def _file():
    return F.element_at(F.split("path", "/"), -1).alias("file")


@query
def scan_written_files(spark, d):
    return _scanned(spark, d)[0].select(_file(), "row", "tomst_id", "datetime", "zone", "T1", "T2", "T3", "moist")


@query
def scan_rejects(spark, d):
    return _scanned(spark, d)[1].select(_file(), "row", "reason", "n_rows")


@query
def written_file_layouts(spark, d):
    return logger_files.file_layouts(_written_lines(spark, d)).select(_file(), "n_rows", F.when(F.col("sep") == "\t", "tab").otherwise(F.col("sep")).alias("sep"), "year_first", "reject")


@query
def local_readings(spark, d):
    return logger_files.local_time(_scanned(spark, d)[0].select(_file(), "row", "datetime"))


def _through_csv(spark, df, kind):
    path = new_stage_path(spark)
    tables.write_csv(df, path)
    return tables.read_csv(spark, path, kind)


@query
def registry_from_csv(spark, d):
    rows = _through_csv(spark, st.file_registry(spark, d), "registry")
    zone = spark.conf.get("spark.sql.session.timeZone")
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("maxdt").cast("timestamp_ntz"))
    return rows.withColumn("maxdt", utc)


@query
def bias_from_csv(spark, d):
    """Offsets written as NaN and infinity come back as nulls."""
    n = F.col("tomst_id") % 7
    odd = F.when(n == 3, F.lit("NaN").cast("double")).when(n == 4, F.lit("-Infinity").cast("double")).otherwise(F.col("T1"))
    return _through_csv(spark, st.file_bias(spark, d).withColumn("T1", odd), "bias")


AREA_OF_FILES = {c: replace(AREAS[c], last_day="2024-01-25") for c in ("MAT", "EVO", "PAL")}


def _second_stage(spark, d, code, name):
    """Files to the published tables of an area, and one of them read again."""
    readings, rejects = _scanned(spark, d)
    registry = st.file_registry(spark, d)
    acquired = pipelines.acquire(
        readings.drop("path", "row"),
        rejects.select(_file(), "row", "reason", "n_rows"),
        registry,
        st.file_ledger(spark, d, False),
        st.file_ledger(spark, d, True),
        st.file_bias(spark, d),
        AREA_OF_FILES[code],
        site_map=registry.select("site", "tomst_id"),
    )
    root = new_stage_path(spark)
    published.publish(spark, acquired, root, code)
    return published.read_published(spark, root, code, name)


@query
def stage02_raw(spark, d):
    return _second_stage(spark, d, "MAT", "raw")


@query
def stage02_registry(spark, d):
    return _second_stage(spark, d, "PAL", "registry")


@query
def stage02_registry_keeping_nulls(spark, d):
    return _second_stage(spark, d, "EVO", "registry")


@query
def stage02_ledger(spark, d):
    return _second_stage(spark, d, "EVO", "ledger")


@query
def stage02_bias(spark, d):
    return _second_stage(spark, d, "PAL", "bias")


@query
def stage02_rejects(spark, d):
    return _second_stage(spark, d, "MAT", "rejects")


# --------------------------------------------------- manifest and registry (B)


def _listed(spark, d):
    root = st.written_logger_files(spark, d)
    found = logger_files.list_files(spark, root)
    return found.withColumn("path", F.concat(F.lit("/in"), F.substring_index("path", root.rsplit("/", 1)[-1], -1)))


@query
def listed_manifest(spark, d):
    return manifest.manifest_parse(_listed(spark, d).filter("bytes > 0"))


@query
def listed_orphans(spark, d):
    return manifest.orphan_sidecars(_listed(spark, d))



def _files(spark, d):
    return manifest.manifest_parse(st.manifest(spark, d))


@query
def manifest_parse(spark, d):
    return _files(spark, d)


@query
def orphan_sidecars(spark, d):
    return manifest.orphan_sidecars(st.manifest(spark, d))


@query
def latest_logger_per_site(spark, d):
    return registry.latest_logger_per_site(st.visits(spark, d))


@query
def unknown_loggers(spark, d):
    return manifest.unknown_loggers(_files(spark, d), st.manifest_registry(spark, d))


@query
def reconcile_manifest(spark, d):
    return manifest.reconcile(_files(spark, d), st.manifest_registry(spark, d))


@query
def site_conflicts(spark, d):
    return manifest.site_conflicts(manifest.reconcile(_files(spark, d), st.manifest_registry(spark, d)))


@query
def multi_logger_sites(spark, d):
    return registry.multi_logger_sites(st.visits(spark, d))


@query
def duplicate_logger_files(spark, d):
    return manifest.duplicate_logger_files(_files(spark, d))


@query
def site_fallback(spark, d):
    return manifest.site_fallback(_files(spark, d), st.manifest_registry(spark, d), "PIS")


@query
def map_uniqueness(spark, d):
    return manifest.map_uniqueness(manifest.site_map(_files(spark, d)))


@query
def initial_site_codes(spark, d):
    return manifest.initial_site_codes(_files(spark, d), "PAL")


@query
def site_overrides(spark, d):
    reg = st.manifest_registry(spark, d)
    n = F.col("tomst_id") % 10
    manual = reg.filter(n == 0).select(
        F.concat(F.lit("M"), F.substring("site", 2, 9)).alias("site"), (F.col("tomst_id") + 500000).alias("tomst_id"), "maxdt"
    )
    renames = reg.filter(n == 1).select("site", "tomst_id", F.concat(F.col("site"), F.lit("A")).alias("new_site"))
    return registry.site_overrides(reg, manual, renames)


# --------------------------------------------------------------- filters (C)


@query
def plausible_dates(spark, d):
    return quality.plausible_dates(st.readings_hf(spark, d), "2024-01-05", "2024-01-25").select("site", "datetime", "T1")


@query
def sites_without_log(spark, d):
    events = st.table(spark, d, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("site"), "event_type", "value"
    )
    return ledger.sites_without_log(events, events.filter("event_type = 'error' AND value > 150"))


@query
def any_measured(spark, d):
    return masks.any_measured(masks.mask_codes(st.readings_hf(spark, d)))


@query
def exclude_prefix(spark, d):
    return quality.exclude_prefix(st.readings_hf(spark, d), ("S1", "S7")).select("site", "datetime", "moist")


@query
def month_completeness(spark, d):
    return quality.month_completeness(moisture.daily_table(st.readings_daily(spark, d)), "moist")


@query
def timestamp_coverage(spark, d):
    return quality.timestamp_coverage(st.readings_by_type(spark, d))


# ----------------------------------------------------------------- joins (D)


@query
def assign_site(spark, d):
    rows = st.readings_hf(spark, d).select("tomst_id", "datetime", "T1")
    return registry.assign_site(rows, st.visits(spark, d))


@query
def ledger_interval_join(spark, d):
    return ledger.label_errors(st.readings_hf(spark, d).drop("error_tomst"), st.ledger(spark, d))


@query
def ledger_interval_bins(spark, d):
    return ledger.label_errors_bins(st.readings_hf(spark, d).drop("error_tomst"), st.ledger(spark, d))


@query
def ledger_segments(spark, d):
    return ledger.ledger_segments(st.ledger(spark, d))


@query
def apply_bias(spark, d):
    return bias.apply_bias(st.readings_hf(spark, d), st.bias(spark, d))


@query
def reference_series(spark, d):
    return peaks.reference_series(st.readings_by_type(spark, d))


@query
def calendar_pad(spark, d):
    rows = st.readings_daily(spark, d)
    daily = rows.groupBy("site", F.to_date("datetime").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return resample.calendar_pad(daily)


def _moist_tables(spark, d):
    daily = moisture.daily_table(moisture.calibrate(st.readings_daily(spark, d)))
    years = moisture.complete_years(daily)
    return daily, years, moisture.growing_bounds(daily, years)


def _season(spark, d, until_end=True):
    daily, _, bounds = _moist_tables(spark, d)
    return moisture.rows_in_season(daily, bounds, until_end)


def _whole(spark, d):
    daily, years, _ = _moist_tables(spark, d)
    return daily.join(years, ["site", "year"], "left_semi")


@query
def rows_in_season(spark, d):
    return _season(spark, d).select("site", "date", "moist", "moistsat", "start_of_season", "end_of_season")


@query
def loggers_to_calibrate(spark, d):
    return bias.loggers_to_calibrate(st.readings_hf(spark, d), st.bias(spark, d))


# ---------------------------------------------------------- aggregations (E)


def _daily(spark, d):
    return thermal.daily_table(st.readings_daily(spark, d))


def _unpadded(spark, d):
    values = ("T1", "T2", "T3", "moist")
    part = periods.daily_partials(st.readings_daily(spark, d), values, values)
    return periods.with_calendar(periods.with_means(part, values, values))


@query
def daily_strict_mean(spark, d):
    return _unpadded(spark, d).select("site", "date", "T1", "T2", "T3", "moist", "T1_imp", "moist_imp")


@query
def hourly_strict_mean(spark, d):
    values = ("T1", "T2", "T3", "moist")
    part = periods.hourly_partials(st.readings_daily(spark, d), values, values)
    return periods.with_means(part, values, values).select("site", "date", "hour", "T1", "T3", "moist", "T2_imp")


@query
def therm_sum(spark, d):
    return _unpadded(spark, d).groupBy("site", "year").agg(
        thermal_sum(F.col("T3"), 5.0).alias("above5"),
        thermal_sum(F.col("T3"), 0.0, above=False).alias("below0"),
        thermal_sum(F.col("moist"), 100.0).alias("moist100"),
    )


@query
def daily_range(spark, d):
    return _unpadded(spark, d).select(
        "site", "date", *[(periods.strict_of(v, "hi") - periods.strict_of(v, "lo")).alias(v) for v in ("T1", "T2", "T3", "moist")]
    )


@query
def mean_daily_range(spark, d):
    return thermal.mean_daily_range(_daily(spark, d))


@query
def latest_reading(spark, d):
    return registry.latest_reading(st.readings_hf(spark, d))


@query
def distribution_bundle(spark, d):
    stats = _unpadded(spark, d).groupBy("site", "year", "month").agg(*bundle_aggregates("moist"))
    columns = bundle_columns("moist")
    return stats.select("site", "year", "month", *[columns[s].alias(s) for s in STAT_NAMES])


@query
def scaled_mad(spark, d):
    stats = _unpadded(spark, d).groupBy("site", "year").agg(*bundle_aggregates("T2"))
    return stats.select("site", "year", bundle_columns("T2")["mad"].alias("mad"))


def _extremes(spark, d):
    rows = st.readings_daily(spark, d)
    return thermal.month_extremes(rows, thermal.daily_table(rows))


@query
def robust_month_min(spark, d):
    return thermal.month_extreme_rows(_extremes(spark, d).filter("var = 'min'"))


@query
def robust_month_max(spark, d):
    return thermal.month_extreme_rows(_extremes(spark, d).filter("var = 'max'"))


@query
def strict_quantile_year(spark, d):
    return _unpadded(spark, d).groupBy("site", "year").agg(
        strict_quantile(F.col("T1"), 0.25).alias("t1_q25"), strict_quantile(F.col("moist"), 0.9).alias("moist_q90")
    )


QUERIES["strict_quantile"] = QUERIES.pop("strict_quantile_year")


@query
def trend_ols(spark, d):
    return moisture.trend(_whole(spark, d), "moist")


@query
def minute_shares(spark, d):
    return quality.minute_shares(st.readings_logger(spark, d))


@query
def temporal_resolution(spark, d):
    rows = st.readings_logger(spark, d)
    modal = quality.temporal_resolution(rows, modal=True).withColumnRenamed("Temporal_resolution", "modal_step")
    return quality.temporal_resolution(rows).join(modal, "tomst_id")


@query
def step_sizes(spark, d):
    return resample.step_sizes(st.readings_hf(spark, d))


# --------------------------------------------------------------- windows (F)


@query
def neighbour_diffs(spark, d):
    rows = st.readings_hf(spark, d).select("site", "datetime", "T1")
    halo = chunks.row_halo(rows, ["site"], "datetime", 5, 3)
    w = halo.window
    out = halo.df.withColumns(
        {
            **{f"lag{k}": F.col("T1") - F.lag("T1", k).over(w) for k in (1, 2, 5)},
            **{f"lead{k}": F.col("T1") - F.lead("T1", k).over(w) for k in (1, 3)},
        }
    )
    return halo.own(out)


@query
def roll_mask(spark, d):
    rows = masks.mask_codes(st.readings_hf(spark, d)).select("site", "datetime", "T1")
    halo = chunks.row_halo(rows, ["site"], "datetime", 2, 2)
    hot = F.col("T1") > 10
    out = halo.df.withColumns(
        {
            "k3": rolling.mask_hit(hot, halo.frame(1, 1), 3),
            "k5": rolling.mask_hit(hot, halo.frame(2, 2), 5),
            "k5_lenient": rolling.mask_hit(hot, halo.frame(2, 2), 5, skip_null=True),
        }
    )
    return halo.own(out).drop("T1")


@query
def roll_mean_excl_middle(spark, d):
    rows = masks.mask_codes(st.readings_hf(spark, d)).select("site", "datetime", "T1")
    halo = chunks.row_halo(rows, ["site"], "datetime", 4, 4)
    return halo.own(halo.df.withColumn("roll", rolling.mean_excluding_middle(F.col("T1"), halo.frame(4, 4), 9))).drop("T1")


def _minmax(spark, d):
    return snow.daily_minmax(st.readings_daily(spark, d))


@query
def roll_aligned(spark, d):
    return snow.core_flags(_minmax(spark, d), ("center", "right", "left")).drop("T2_imp")


@query
def roll13(spark, d):
    return moisture.rolled(_whole(spark, d))


@query
def run_ids(spark, d):
    days = _unpadded(spark, d).select("site", "year", "date", "T3")
    return runs.with_runs(days, ["site", "year"], "date", F.col("T3") >= 3).drop("T3", "year")


@query
def season_quartiles(spark, d):
    return moisture.bundle(moisture.quarter_days(_season(spark, d)))


@query
def locf(spark, d):
    rows = st.readings_hf(spark, d).select(
        "site", "datetime", F.when(F.col("error_tomst") > 0, F.col("error_tomst")).alias("code")
    )
    return chunks.locf(rows, ["site"], "datetime", ["code"])


@query
def interp_short_gaps(spark, d):
    rows = st.readings_hf(spark, d).select("site", "datetime", F.when(F.col("T1") < 4, F.col("T1")).alias("T1"))
    return resample.interpolate_short_gaps(rows, ["site"], "datetime", ["T1"])


@query
def rescale_max(spark, d):
    return moisture.rescale_max(st.readings_hf(spark, d).select("site", "datetime", "moist"))


# ---------------------------------------------------- dedup and set operations


@query
def first_last_in_group(spark, d):
    e = st.table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    order = [F.col("ts"), F.col("event_id")]
    first = dedup.keep_first(e, ["user_id"], order).select("user_id", F.col("event_id").alias("first_id"), F.col("event_type").alias("first_type"))
    last = dedup.keep_last(e, ["user_id"], order).select("user_id", F.col("event_id").alias("last_id"), F.col("event_type").alias("last_type"))
    return first.join(last, "user_id")


@query
def first_k_days(spark, d):
    return moisture.first_days(_season(spark, d, until_end=False), 14).select("site", "date", "moist")


@query
def dedup_readings(spark, d):
    """Yearly downloads overlap: a logger's stamp comes in up to three files, some rows without values."""
    e, i = st.table(spark, d, "events"), F.col("event_id")
    empty = F.col("event_id") % 4 == 0
    rows = e.select(
        (F.col("user_id") % 30).alias("tomst_id"),
        st.slot(F.col("ts"), 15).alias("datetime"),
        F.concat(F.lit("/in/"), (2024 - i % 3).cast("string"), F.lit("/data.csv")).alias("path"),
        i.alias("row"),
        F.when(~empty & (i % 5 != 0), F.col("value") / 8).alias("T1"),
        F.when(~empty, F.col("value") / 4).alias("T2"),
        F.when(~empty & (i % 3 != 0), F.col("value") / 2).alias("T3"),
        F.when(~empty & (i % 7 != 0), F.col("value") * 20).alias("moist"),
    )
    return dedup.first_reading(rows)


@query
def dedup_keep_first(spark, d):
    return st.readings_hf(spark, d)


@query
def merge_archive(spark, d):
    rows = st.readings_logger(spark, d).select(
        "site", "datetime", F.col("tomst_id").alias("tomst_id"), "T1", "T2", "T3", "moist"
    )
    old = rows.filter(F.col("tomst_id") % 3 == 0).withColumn("T2", F.when(F.col("T2") < 0, F.col("T2")))
    return dedup.merge_archive(old, rows.filter(F.col("tomst_id") % 3 != 0))


@query
def schema_diff(spark, d):
    docs = st.table(spark, d, "documents")
    toxic = st.table(spark, d, "labels").filter("toxic = 1").select("doc_id")
    names = docs.join(toxic, "doc_id", "left_semi").select(F.col("source").alias("name"))
    german = docs.filter("lang = 'de'").select(F.col("source").alias("name"))
    return export.schema_diff(names, german)


# --------------------------------------------------------------- scalars (I)


@query
def pad_site_code(spark, d):
    users = st.table(spark, d, "events").select("user_id").distinct()
    return users.select("user_id", scalars.pad_site_code(F.col("user_id"), "VAR").alias("site"))


@query
def hydro_year(spark, d):
    days = st.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    shifted = scalars.hydro_date(F.col("date"))
    return days.select("date", F.year(shifted).alias("hydyear"), F.dayofyear(shifted).alias("hyddoy"))


@query
def month_sequence(spark, d):
    spans = st.table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b")
    )
    return spans.select("l_suppkey", F.explode(scalars.month_sequence(F.col("a"), F.col("b"))).alias("month"))


@query
def calibrate_moisture(spark, d):
    rows = st.readings_hf(spark, d).select("site", "datetime", "moist")
    return moisture.calibrate(rows.withColumn("percent", scalars.calibrate_moisture(F.col("moist"))))


# --------------------------------------------------------------- reshape (J)


@query
def pivot_sites(spark, d):
    rows = st.readings_by_type(spark, d)
    return reshape.pivot_sites(rows, "T1", pipelines.sites_of(rows))


@query
def unpivot_sites(spark, d):
    rows = st.readings_by_type(spark, d)
    sites = pipelines.sites_of(rows)
    return reshape.unpivot_sites(reshape.pivot_sites(rows, "T1", sites), sites, "T1")


@query
def unpivot_sensors(spark, d):
    return reshape.unpivot_sensors(thermal.annual_mean(_daily(spark, d)), config.TEMPERATURES)


@query
def dense_grid(spark, d):
    return resample.dense_grid(st.readings_by_type(spark, d), ["T1", "moist"])


# -------------------------------------------------------------- cleaning (K)


@query
def fill_gaps_logger(spark, d):
    return gaps.fill_gaps_logger(st.readings_logger(spark, d))


@query
def fill_gaps_site(spark, d):
    return gaps.fill_gaps_site(st.readings_hf(spark, d))


@query
def fill_gaps_seconds(spark, d):
    return gaps.fill_gaps(st.readings_exact(spark, d), ["user_id"])


@query
def step_sizes_seconds(spark, d):
    return resample.step_sizes(st.readings_exact(spark, d), "user_id")


@query
def drop_stray_minutes(spark, d):
    e = st.table(spark, d, "events").select((F.col("user_id") % 30).alias("tomst_id"), F.col("ts").alias("datetime"), "event_id")
    return quality.drop_stray_minutes(e, share=0.012)


@query
def drop_stray_minutes_default(spark, d):
    e = st.table(spark, d, "events").select((F.col("user_id") % 30).alias("tomst_id"), F.col("ts").alias("datetime"), "event_id")
    return quality.drop_stray_minutes(e)


@query
def estimate_bias(spark, d):
    return bias.estimate_bias(st.readings_idle(spark, d))


@query
def mask_visits(spark, d):
    return masks.mask_visits(st.readings_hf(spark, d), st.visits(spark, d))


@query
def mask_range(spark, d):
    return masks.mask_range(masks.mask_codes(st.readings_hf(spark, d)), keys=("site",))


@query
def mask_codes(spark, d):
    return masks.mask_codes(st.readings_hf(spark, d))


@query
def regularise_15min(spark, d):
    rows = st.readings_logger(spark, d).withColumn("site", F.concat(F.lit("L"), F.col("tomst_id").cast("string")))
    rows = rows.withColumn("T1", F.when(F.col("T1") < 4, F.col("T1"))).withColumnRenamed("probl", "error_tomst")
    return resample.regularise(rows)


@query
def apply_overrides(spark, d):
    day = F.to_date("ts")
    kind = F.element_at(F.array(F.lit("null"), F.lit("delete"), F.lit("rename")), (F.col("event_id") % 3 + 1).cast("int"))
    rules = (
        st.table(spark, d, "events")
        .filter("event_type = 'purchase' AND value > 200")
        .select(
            st.site_of().alias("site"),
            F.when(F.col("event_id") % 2 == 0, day).alias("after"),
            F.date_add(day, 3).alias("before"),
            F.when(F.col("event_id") % 4 < 2, "moist").otherwise("T1").alias("column"),
            kind.alias("action"),
            F.concat(F.lit("X"), st.site_of()).alias("target"),
        )
        .filter("after is not null or event_id % 16 = 1")
    )
    return registry.apply_overrides(st.readings_hf(spark, d), rules)


def _peaks(sensor):
    def fn(spark, d):
        flagged = peaks.flag_peaks(st.readings_by_type(spark, d), sensors=(sensor,))
        return flagged.select("site", "datetime", f"{sensor}_peak", f"{sensor}_masked")

    return fn


for _s in config.SENSORS:
    register(f"peaks_{_s.lower()}", _peaks(_s))


@query
def peak_counts(spark, d):
    return peaks.peak_counts(peaks.flag_peaks(st.readings_by_type(spark, d)))


@query
def peak_counts_observed(spark, d):
    """The same numbers, counted while the masked series are written."""
    flagged, seen = peaks.observe_peaks(peaks.flag_peaks(st.readings_by_type(spark, d)))
    stage(peaks.mask_peaks(flagged))
    return spark.createDataFrame(sorted(seen.get.items()), "sensor string, n_peaks long")


@query
def peaks_v2023(spark, d):
    flagged = peaks.flag_peaks(st.readings_by_type(spark, d), config.PEAK_RULES_2023)
    return flagged.select("site", "datetime", *[f"{s}_peak" for s in config.SENSORS])


@query
def registry_update(spark, d):
    return registry.registry_update(st.visits(spark, d), st.readings_hf(spark, d))


@query
def ledger_update(spark, d):
    rows = st.ledger(spark, d)
    return ledger.ledger_update(rows.filter("probl < 7"), rows.filter("probl > 4"))


@query
def clean_series(spark, d):
    return pipelines.clean_series(st.readings_hf(spark, d), st.bias(spark, d), st.visits(spark, d))


@query
def clean_append(spark, d):
    """The last two days of each month come later and are appended to what was cleaned before."""
    raw, late = st.readings_hf(spark, d), F.col("datetime") >= F.date_sub(F.last_day("datetime"), 1)
    old, bias, visits = stage(raw.filter(~late)), st.bias(spark, d), st.visits(spark, d)
    cleaned, summary = stage(pipelines.clean_series(old, bias, visits)), stage(append.summary_of(old, 3))
    return append.append_cleaned(old, raw.filter(late), cleaned, summary, bias, visits, days=3)[0]


POLICIES = {"MAT": areas.CURRENT, "VIN": areas.OF_2023_VIN, "RAS": areas.OF_2023}


def _with_area(df):
    number = F.substring("site", 2, 9).cast("int") % 10
    return df.withColumn("area", F.when(number < 4, "MAT").when(number < 7, "VIN").otherwise("RAS"))


def _three_areas(spark, d):
    return areas.clean_areas(_with_area(st.readings_hf(spark, d)), st.bias(spark, d), _with_area(st.visits(spark, d)), POLICIES)


@query
def clean_areas(spark, d):
    return stage(_three_areas(spark, d)[0])


@query
def clean_areas_peaks(spark, d):
    """Peaks by area and sensor, as the masking job counted them."""
    seen = _three_areas(spark, d)[1].get
    return spark.createDataFrame([(a, s, seen[f"{s}_{a}"]) for a in POLICIES for s in config.SENSORS], "area string, sensor string, n_peaks long")


@query
def clean_t2_for_snow(spark, d):
    return pipelines.clean_t2_for_snow(st.readings_hf(spark, d), st.bias(spark, d), st.visits(spark, d))


# ------------------------------------------------------------ imputation (L)


@query
def impute_forest(spark, d):
    rows = st.readings_by_type(spark, d)
    return impute.impute_forest(rows, "T1", pipelines.sites_of(rows))


@query
def impute_invariants(spark, d):
    """Per site: rows, imputed cells, nulls, the sum of the kept values and values never observed there.

    These hold for any forest, so this check of the operator grows small ones; ``impute_forest`` is the full run.
    """
    rows = st.readings_by_type(spark, d)
    out = impute.impute_forest(rows, "T1", pipelines.sites_of(rows), num_trees=10, max_iter=2, max_depth=8)
    seen = rows.filter("T1 IS NOT NULL").groupBy("site", "T1").agg(F.lit(1).alias("known"))
    return (
        out.join(seen, ["site", "T1"], "left")
        .groupBy("site")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("T1_imp").alias("n_imputed"),
            F.count_if(F.col("T1").isNull()).alias("n_null"),
            F.sum(F.when(~F.col("T1_imp"), F.col("T1"))).alias("kept"),
            F.count_if(F.col("T1_imp") & F.col("known").isNull()).alias("n_invented"),
        )
    )


def _matched(spark, d, **options):
    rows = st.table(spark, d, "events").select(
        F.col("event_type").alias("site"),
        "event_id",
        F.col("ts").alias("datetime"),
        (F.floor(F.col("value") * 2) / 2).alias("prediction"),
        F.when(F.col("event_id") % 7 == 0, F.col("value")).alias("observed"),
    )
    return impute.pmm_match(rows, keys=("site",), width=8.0, **options).select("event_id", "matched")


@query
def pmm_match(spark, d):
    return _matched(spark, d)


@query
def pmm_match_draw(spark, d):
    return _matched(spark, d, k=3, seed=5)


@query
def combine_sensors(spark, d):
    """Each sensor has rows that others lack."""
    rows = st.readings_by_type(spark, d)
    hour = F.hour("datetime")
    parts = [
        rows.filter(hour % (k + 2) != 1).select("site", "datetime", s, (hour % 2 == k % 2).alias(f"{s}_imp"))
        for k, s in enumerate(config.SENSORS)
    ]
    return impute.combine_sensors(parts)


@query
def frozen_moisture(spark, d):
    grid = resample.dense_grid(st.readings_by_type(spark, d), ["T1", "moist"])
    t1 = grid.select("site", "datetime", F.coalesce("T1", F.lit(2.0)).alias("T1"))
    covered = impute.covered_rows(impute.hide_frozen(grid.select("site", "datetime", "T1", "moist")))
    filled = covered.select(
        "site", "datetime", F.coalesce("moist", F.lit(500.0)).alias("moist"), F.col("moist").isNull().alias("moist_imp")
    )
    return impute.frozen_moisture(grid, filled, t1)


# --------------------------------------------------- temperature indices (M)


def _degree(name):
    def fn(spark, d):
        rows = st.readings_daily(spark, d)
        if name in thermal.DAY_INDICES:
            return thermal.degree_indices(thermal.daily_table(rows), {name: thermal.DAY_INDICES[name]})
        return thermal.degree_indices(thermal.hourly_table(rows), {name: thermal.HOUR_INDICES[name]})

    return fn


for _v in (*thermal.DAY_INDICES, *thermal.HOUR_INDICES):
    register(f"idx_{_v.lower()}", _degree(_v))


@query
def idx_annual_mean(spark, d):
    return thermal.annual_mean(_daily(spark, d))


@query
def idx_month_mean(spark, d):
    return thermal.month_mean(_daily(spark, d))


def _seasonal(fn):
    def run(spark, d):
        daily = _daily(spark, d)
        return fn(daily, thermal.complete_years(daily))

    return run


register("idx_season_t1", _seasonal(lambda daily, years: thermal.season_index(daily, years, "T1")))
register("idx_season_t3", _seasonal(lambda daily, years: thermal.season_index(daily, years, "T3")))
register("idx_gst1_frost", _seasonal(lambda daily, years: thermal.season_frost(daily, years, "T1")))
register("idx_gst3_frost", _seasonal(lambda daily, years: thermal.season_frost(daily, years, "T3")))
register("idx_summer_frost", _seasonal(thermal.summer_frost))


@query
def idx_freeze_thaw(spark, d):
    daily = _daily(spark, d)
    return thermal.freeze_thaw(daily, "T1").unionByName(thermal.freeze_thaw(daily, "T3"))


def _annual(spark, d):
    return thermal.annual_extremes(_extremes(spark, d))


@query
def idx_annual_min(spark, d):
    return _annual(spark, d).filter("var = 'min'")


@query
def idx_annual_max(spark, d):
    return _annual(spark, d).filter("var = 'max'")


@query
def idx_annual_range(spark, d):
    return thermal.annual_range(_annual(spark, d))


@query
def temperature_indices(spark, d):
    return thermal.temperature_indices(st.readings_daily(spark, d))


# ------------------------------------------------------ moisture indices (N)


@query
def complete_years(spark, d):
    return _moist_tables(spark, d)[1]


@query
def moist_monthly(spark, d):
    return moisture.bundle(moisture.monthly_days(_moist_tables(spark, d)[0]))


@query
def moist_ice_free(spark, d):
    daily, years, _ = _moist_tables(spark, d)
    return moisture.bundle(moisture.ice_free_days(daily, years))


@query
def season_bounds(spark, d):
    return _moist_tables(spark, d)[2]


@query
def moist_growing(spark, d):
    return moisture.bundle(moisture.labelled(_season(spark, d), moisture.GROWING))


@query
def moist_extreme_weeks(spark, d):
    return moisture.extreme_weeks(_whole(spark, d), moisture.ICE_FREE)


@query
def moist_extreme_weeks_gs(spark, d):
    return moisture.extreme_weeks(_season(spark, d), moisture.GROWING)


@query
def moist_first14(spark, d):
    days = moisture.first_days(_season(spark, d, until_end=False), 14)
    return moisture.bundle(moisture.labelled(days, moisture.FIRST14))


@query
def moist_first28(spark, d):
    days = moisture.first_days(_season(spark, d, until_end=False), 28)
    return moisture.bundle(moisture.labelled(days, moisture.FIRST28))


@query
def trend_ols_gs(spark, d):
    return moisture.trend(_season(spark, d), "moistsat")


@query
def moisture_indices(spark, d):
    return moisture.moisture_indices(moisture.calibrate(st.readings_daily(spark, d)))


# ---------------------------------------------------------- snow indices (O)


@query
def daily_minmax(spark, d):
    return _minmax(spark, d)


@query
def snow_day_flags(spark, d):
    return snow.snow_days(_minmax(spark, d)).select("site", "date", "snow")


@query
def midsummer_doy(spark, d):
    return snow.midsummer_doy(snow.snow_days(_minmax(spark, d)))


def _snow(spark, d):
    return snow.snow_year(snow.snow_days(_minmax(spark, d)))


@query
def snow_year(spark, d):
    return _snow(spark, d)


@query
def snow_on_off(spark, d):
    return snow.snow_on_off(_snow(spark, d))


@query
def snow_periods(spark, d):
    days = _snow(spark, d)
    return snow.snow_periods(days, snow.snow_on_off(days))


@query
def snow_indices(spark, d):
    return snow.snow_indices(st.readings_daily(spark, d))


# ---------------------------------------------------------------- export (P)


def _series(spark, d):
    return export.export_clean(st.readings_hf(spark, d), st.visits(spark, d), "MAT")


@query
def export_clean(spark, d):
    return _series(spark, d)


@query
def sensor_spans(spark, d):
    return export.sensor_spans(_series(spark, d))


@query
def export_metadata(spark, d):
    return export.export_metadata(
        _series(spark, d), st.coordinates(spark, d), Country_code="NO", Experiment_name="Test", Logger_brand="B", Logger_type="L"
    ).withColumns({"Elevation": F.col("Elevation").cast("double"), "Sensor_shielding_type": F.coalesce("Sensor_shielding_type", F.lit("-"))})


@query
def habitat_lookup(spark, d):
    lookup = (
        st.coordinates(spark, d)
        .filter("Lat > 60.5")
        .select("site", F.lit(5).alias("Habitat_type"), F.lit(4).alias("Habitat_sub_type"))
    )
    rows = st.readings_hf(spark, d).select(F.col("site").alias("Site_id"), "tomst_id").distinct()
    return export.habitat_lookup(rows, lookup, (1, 1))


@query
def export_series(spark, d):
    return export.export_series(_series(spark, d))


@query
def export_metadata_legacy(spark, d):
    return export.export_metadata_legacy(_series(spark, d), st.coordinates(spark, d))
