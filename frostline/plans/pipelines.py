"""The stages a user runs, each from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.config import AREAS, ERROR_CODES, PEAK_RULES, PLAUSIBLE, SENSORS, Area
from frostline.operators.bias import apply_bias, extend_bias
from frostline.operators.dedup import first_reading, keep_first, measured_first, merge_archive
from frostline.operators.gaps import fill_gaps_logger, fill_gaps_site
from frostline.operators.impute import impute_forest, impute_series
from frostline.operators.ledger import drop_not_in_field, label_errors_bins, ledger_update
from frostline.operators.masks import mask_codes, mask_visits_and_range
from frostline.operators.moisture import calibrate, moisture_indices
from frostline.operators.peaks import flag_peaks, mask_peaks
from frostline.operators.quality import drop_stray_minutes, plausible_dates
from frostline.operators.registry import assign_site, assign_site_from_map, registry_update
from frostline.operators.resample import dense_grid, regularise
from frostline.operators.snow import snow_indices
from frostline.operators.thermal import temperature_indices
from frostline.session import stage


def _area(area: Area | str) -> Area:
    return AREAS[area] if isinstance(area, str) else area


def _assigned(readings: DataFrame, sites: DataFrame, area: Area) -> DataFrame:
    assign = assign_site if area.site_source == "registry" else assign_site_from_map
    return assign(first_reading(readings), sites)


def _labelled(assigned: DataFrame, ledger: DataFrame, area: Area, chunk: Column | None) -> DataFrame:
    """Regular stamps per logger, with the error code of each day."""
    df = plausible_dates(assigned.filter("site is not null"), area.first_day, area.last_day)
    return stage(fill_gaps_logger(stage(label_errors_bins(df, ledger)), chunk=chunk))


def _raw(labelled: DataFrame, archive: DataFrame | None, chunk: Column | None) -> DataFrame:
    df = drop_stray_minutes(drop_not_in_field(labelled)).drop("zone").withColumnRenamed("probl", "error_tomst")
    if archive is not None:
        df = merge_archive(archive, df).drop("datanew")
    else:
        df = keep_first(df, ["site", "datetime"], [F.col("tomst_id"), *measured_first(*SENSORS)])
    return fill_gaps_site(stage(df), chunk=chunk)


def raw_table(
    readings: DataFrame,
    registry: DataFrame,
    ledger: DataFrame,
    area: Area | str,
    archive: DataFrame | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Logger readings to the raw table: site, plausible dates, error code, regular stamps.

    ``registry`` is the reading-time registry, or the site map for areas that use one.
    """
    area = _area(area)
    return _raw(_labelled(_assigned(readings, registry, area), ledger, area, chunk), archive, chunk)


def acquire(
    readings: DataFrame,
    rejects: DataFrame,
    registry: DataFrame,
    ledger: DataFrame,
    new_ledger: DataFrame,
    bias: DataFrame,
    area: Area | str,
    site_map: DataFrame | None = None,
    archive: DataFrame | None = None,
    chunk: Column | None = None,
) -> dict[str, DataFrame]:
    """The whole second stage of an area: ``raw, registry, ledger, bias, rejects``, by the area's own policy.

    The registry gains the newest reading of each logger, the ledger its new intervals (or is replaced by them), and the
    bias table estimates for loggers that have none; areas differ in whether rows with nulls stay. Sites come from the
    registry as it was, or from ``site_map`` where the area uses one. Publish the result with
    :func:`frostline.sources.published.publish`.
    """
    area = _area(area)
    sites = registry if area.site_source == "registry" else site_map
    assigned = stage(_assigned(readings, sites, area))
    book = ledger_update(ledger, new_ledger, area.ledger_replaces)
    labelled = _labelled(assigned, book, area, chunk)
    return {
        "raw": _raw(labelled, archive, chunk),
        "registry": registry_update(registry, assigned, area.registry_drops_null),
        "ledger": book,
        "bias": extend_bias(bias, labelled, drop_null=area.bias_drops_null),
        "rejects": rejects,
    }


def unassigned_readings(readings: DataFrame, registry: DataFrame, area: Area | str) -> DataFrame:
    """Readings of loggers without a site, which ``raw_table`` leaves out."""
    area = AREAS[area] if isinstance(area, str) else area
    assign = assign_site if area.site_source == "registry" else assign_site_from_map
    return assign(readings, registry).filter("site is null")


def clean_series(
    raw: DataFrame,
    bias: DataFrame,
    visits: DataFrame,
    sensors: Sequence[str] = SENSORS,
    limits: Mapping[str, tuple[float, float]] = PLAUSIBLE,
    codes: Mapping[str, Sequence[int]] = ERROR_CODES,
    rules=PEAK_RULES,
    fill: bool = True,
    chunk: Column | None = None,
    grid: DataFrame | None = None,
) -> DataFrame:
    """Raw to cleaned: bias, visits, range, codes, 15-minute grid, peaks, gap fill.

    Each step looks at neighbouring rows of the step before, so the steps are staged as tables: the
    plan stays small and no step runs twice. The last one is staged too, so its tasks hold no more rows as the table grows.
    """
    limits = {s: limits[s] for s in sensors}
    codes = {s: codes[s] for s in sensors}
    df = apply_bias(raw, bias)
    df = stage(mask_codes(mask_visits_and_range(df, visits, limits, sensors, chunk=chunk), codes))
    df = stage(regularise(df, sensors=sensors, chunk=chunk, grid=grid))
    df = mask_peaks(flag_peaks(df, rules, sensors, chunk=chunk), sensors)
    return stage(fill_gaps_site(stage(df), chunk=chunk) if fill else df)


def clean_t2_for_snow(
    raw: DataFrame, bias: DataFrame, visits: DataFrame, area: Area | str = "MAT", chunk: Column | None = None
) -> DataFrame:
    """The short chain that feeds the snow indices: T2 alone, only the area's snow codes."""
    area = AREAS[area] if isinstance(area, str) else area
    t2 = raw.select("site", "tomst_id", "datetime", "T2", "error_tomst")
    return clean_series(
        t2, bias, visits, sensors=("T2",), codes={"T2": area.snow_t2_codes}, fill=False, chunk=chunk
    )


def sites_of(df: DataFrame) -> list[str]:
    """Site codes of one area, sorted; they become columns, so Spark's pivot limit applies."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = [r["site"] for r in df.select("site").distinct().filter("site is not null").limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} sites: run one area at a time")
    return sorted(found)


def imputed_table(cleaned: DataFrame, area: Area | str, **options) -> DataFrame:
    """Cleaned to imputed, with the area's numbers of trees and filters."""
    area = AREAS[area] if isinstance(area, str) else area
    out = impute_series(
        cleaned,
        sites_of(cleaned),
        area.trees,
        drop_null=area.drop_null_before_pivot,
        min_observed=area.min_observed_sites,
        **options,
    )
    return out.filter("T3 is not null") if area.keep_only_t3 else out


def snow_table(
    raw: DataFrame, bias: DataFrame, visits: DataFrame, area: Area | str, chunk: Column | None = None, **options
) -> DataFrame:
    """Raw to snow indices: T2 cleaned by its own chain, imputed with 100 trees."""
    t2 = stage(clean_t2_for_snow(raw, bias, visits, area, chunk))
    return snow_indices(impute_forest(dense_grid(t2, ["T2"]), "T2", sites_of(t2), num_trees=100, **options))


def index_tables(imputed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Imputed series to the temperature and moisture index tables."""
    df = calibrate(imputed.filter("datetime is not null and site is not null"))
    return temperature_indices(df), moisture_indices(df)
