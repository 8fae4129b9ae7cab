"""Exchange-format export: metadata and series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.config import ERROR_CODES, EXPORT_COLUMNS, EXPORT_T1_FLOOR, PLAUSIBLE, SENSOR_CONSTANTS, SENSORS
from frostline.operators.dedup import keep_first
from frostline.operators.gaps import fill_gaps_site
from frostline.operators.masks import any_measured, mask_codes, mask_visits_and_range
from frostline.operators.quality import temporal_resolution
from frostline.session import LOCAL_ZONE, cut_lineage, stage

SERIES_SENSORS = ("T1", "T2", "T3", "Soil_moisture")
KEYS = ("Site_id", "Raw_data_identifier")

# Constants of the metadata that hold for every area; pass others by keyword.
METADATA_CONSTANTS = {
    "Experimental_manipulation": "No",
    "Experiment_insitu": "Yes",
    "Experiment_climate": "No",
    "Experiment_citizens": "No",
    "Experiment_design": "",
    "Experiment_doi": "",
    "Experiment_comment": "",
    "Habitat_type": 4,
    "Habitat_sub_type": 1,
    "Site_comments": "",
    "EPSG": 4326,
    "GPS_accuracy": 5,
    "Elevation": None,
    "Logger_age": 2021,
    "Logger_comment": "",
    "Timezone": "UTC",
    "Time_difference": 0,
    "Licence": "CC-BY",
    "Sensor_comments": "",
    "Species_composition": "Yes",
    "Species_trait": "Yes",
}


def export_limits(area: str) -> dict[str, tuple[float, float]]:
    return {**PLAUSIBLE, "T1": (EXPORT_T1_FLOOR.get(area, PLAUSIBLE["T1"][0]), PLAUSIBLE["T1"][1])}


def export_codes(area: str) -> Mapping[str, Sequence[int]]:
    """Code table of the export stage; one area also hides unshielded T3."""
    return {**ERROR_CODES, "T3": (*ERROR_CODES["T3"], 3)} if area == "RAS" else ERROR_CODES


def export_clean(raw: DataFrame, visits: DataFrame, area: str = "MAT", chunk: Column | None = None) -> DataFrame:
    """Masked, gap-filled series without bias correction, in export names."""
    df = mask_visits_and_range(raw, visits, export_limits(area), chunk=chunk)
    df = any_measured(mask_codes(df, export_codes(area)))
    df = keep_first(df, ["site", "datetime"], [F.col("tomst_id"), *[F.col(s) for s in SENSORS]])
    return fill_gaps_site(stage(df), chunk=chunk).select(
        F.col("site").alias("Site_id"),
        F.col("tomst_id").alias("Raw_data_identifier"),
        "datetime",
        "T1",
        "T2",
        "T3",
        F.col("moist").alias("Soil_moisture"),
    )


def sensor_spans(series: DataFrame) -> DataFrame:
    """First day after the start and last day with data, per (site, logger, sensor)."""
    long = series.unpivot([*KEYS, "datetime"], list(SERIES_SENSORS), "Sensor_code", "value").dropna(how="any")
    spans = long.groupBy(*KEYS, "Sensor_code").agg(
        F.date_add(F.to_date(F.min("datetime")), 1).alias("fd"), F.to_date(F.max("datetime")).alias("ld")
    )
    return spans.select(
        *KEYS,
        "Sensor_code",
        *[
            part(F.col(d)).alias(f"{side}_date_{name}")
            for d, side in (("fd", "Start"), ("ld", "End"))
            for part, name in ((F.year, "year"), (F.month, "month"), (F.dayofmonth, "day"))
        ],
    )


def number_rows(df: DataFrame, order: Sequence[str], name: str = "meta_id") -> DataFrame:
    """Number rows 1..n along ``order`` without gathering them in one task.

    The sorted table is written once; its partitions are then numbered from their row counts.
    """
    sorted_df = cut_lineage(df.orderBy(*order)).withColumn("_mid", F.monotonically_increasing_id())
    sorted_df = sorted_df.withColumns(
        {"_pid": F.shiftright("_mid", 33), "_pos": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"))
    numbered = sorted_df.join(starts, "_pid")
    return numbered.select((F.col("_start") + F.col("_pos") + 1).alias(name), *df.columns)


def habitat_lookup(df: DataFrame, lookup: DataFrame, default: tuple[int, int], site: str = "Site_id") -> DataFrame:
    """Habitat classes of listed sites, ``default`` for the others."""
    joined = df.drop("Habitat_type", "Habitat_sub_type").join(
        lookup.select(F.col("site").alias(site), "Habitat_type", "Habitat_sub_type"), site, "left"
    )
    return joined.withColumns(
        {
            "Habitat_type": F.coalesce("Habitat_type", F.lit(default[0])),
            "Habitat_sub_type": F.coalesce("Habitat_sub_type", F.lit(default[1])),
        }
    )


def sensor_constants(spark) -> DataFrame:
    """The fixed four-row table of sensor properties."""
    schema = (
        "Sensor_code string, Sensor_shielding string, Sensor_shielding_type string, Microclimate_measurement string, "
        "Unit string, Sensor_accuracy double, Sensor_height double, Sensor_length double"
    )
    return spark.createDataFrame(list(SENSOR_CONSTANTS), schema)


def export_metadata(
    series: DataFrame, coordinates: DataFrame, chunk: Column | None = None, **constants
) -> DataFrame:
    """One row per (site, logger, sensor) with the 47 columns of the exchange format.

    ``constants`` sets the project's values, such as Country_code, Experiment_name, Logger_brand and
    Logger_type, and overrides the defaults.
    """
    values = {
        "Country_code": None,
        "Experiment_name": None,
        "Logger_brand": None,
        "Logger_type": None,
        **METADATA_CONSTANTS,
        **constants,
    }
    series = stage(series.select(*KEYS, "datetime", *SERIES_SENSORS))  # read by spans and steps
    spans = sensor_spans(series)
    steps = temporal_resolution(series.filter("Raw_data_identifier is not null"), "Raw_data_identifier", "datetime", chunk=chunk)
    places = coordinates.select(
        F.col("site").alias("Site_id"), F.col("Lat").alias("Latitude"), F.col("Lon").alias("Longitude")
    )
    meta = spans.join(places, "Site_id", "left").join(steps, "Raw_data_identifier", "left")
    meta = number_rows(meta, ["Site_id", "Raw_data_identifier", "Sensor_code"])
    meta = meta.withColumns(
        {
            **{k: F.lit(v) for k, v in values.items()},
            "Logger_code": F.col("Raw_data_identifier"),
            "Logger_serial_number": F.col("Raw_data_identifier"),
        }
    )
    meta = meta.join(F.broadcast(sensor_constants(series.sparkSession)), "Sensor_code")
    return meta.select(*EXPORT_COLUMNS)


def schema_diff(names: DataFrame, expected: DataFrame) -> DataFrame:
    """Names on one side only, as (name, side)."""
    a, b = names.select("name").distinct(), expected.select("name").distinct()
    extra = a.join(b, "name", "left_anti").withColumn("side", F.lit("extra"))
    missing = b.join(a, "name", "left_anti").withColumn("side", F.lit("missing"))
    return extra.unionByName(missing)


def check_columns(df: DataFrame, expected: Sequence[str] = EXPORT_COLUMNS) -> tuple[list[str], list[str]]:
    """Column names that are extra, and names that are missing."""
    return [c for c in df.columns if c not in expected], [c for c in expected if c not in df.columns]


def export_series(series: DataFrame, time: str = "datetime") -> DataFrame:
    """Series layout with local date parts and the clock time in UTC."""
    stamp = F.col(time)
    if dict(series.dtypes)[time] == "timestamp":
        stamp = F.to_utc_timestamp(stamp, LOCAL_ZONE)
    return series.select(
        "Raw_data_identifier",
        F.year(time).alias("Year"),
        F.month(time).alias("Month"),
        F.dayofmonth(time).alias("Day"),
        F.date_format(stamp, "HH:mm").alias("Time"),
        *SERIES_SENSORS,
    )


def export_metadata_legacy(series: DataFrame, coordinates: DataFrame, country: str = "NO", **people) -> DataFrame:
    """Older metadata layout; contributor columns are taken from ``people``."""
    long = series.unpivot([*KEYS, "datetime"], list(SERIES_SENSORS), "Sensor_code", "value")
    spans = long.groupBy("Site_id", "Sensor_code").agg(
        F.to_date(F.min(F.when(F.col("value").isNotNull(), F.col("datetime")))).alias("a"),
        F.to_date(F.max(F.when(F.col("value").isNotNull(), F.col("datetime")))).alias("b"),
    )
    soil = F.col("Sensor_code") == "Soil_moisture"
    height = (
        F.when(soil, -15)
        .when(F.col("Sensor_code") == "T1", -6)
        .when(F.col("Sensor_code") == "T2", 2)
        .when(F.col("Sensor_code") == "T3", 15)
    )
    identifier = F.concat(F.col("Site_id"), F.lit("_tomst"))
    places = coordinates.select(
        F.col("site").alias("Site_id"), F.col("Lat").alias("Latitude"), F.col("Lon").alias("Longitude")
    )
    out = spans.join(places, "Site_id", "left").select(
        F.lit(country).alias("Country_code"),
        F.col("Site_id").alias("Location_code"),
        identifier.alias("Logger_code"),
        "Sensor_code",
        height.alias("Sensor_height"),
        identifier.alias("Raw_data_identifier"),
        F.when(soil, "Soil_moisture").otherwise("Temperature").alias("Microclimate_measurement"),
        "Latitude",
        "Longitude",
        F.lit(4326).alias("EPSG"),
        F.lit(5).alias("GPS_accuracy"),
        F.lit(0.5).alias("Sensor_accuracy"),
        F.when(F.col("Sensor_code").isin("T1", "Soil_moisture"), "No shield").otherwise("Shield").alias("Logger_shielding"),
        F.lit("4").alias("Habitat_type"),
        F.lit("4.2").alias("Habitat_sub_type"),
        F.year("a").alias("Start_date_year"),
        F.month("a").alias("Start_date_month"),
        F.dayofmonth("a").alias("Start_date_date"),
        F.year("b").alias("End_date_year"),
        F.month("b").alias("End_date_month"),
        F.dayofmonth("b").alias("End_date_date"),
        F.lit(15).alias("Temporal_resolution"),
        F.lit("UTC").alias("Timezone"),
        F.lit("yes").alias("Species_composition"),
        F.lit("no").alias("Species_trait"),
        F.lit(None).cast("double").alias("Plot_size"),
        F.lit(None).cast("double").alias("Forest_canopy_cover"),
        F.lit("yes").alias("Data_open_access"),
        F.lit("yes").alias("Meta_data_open_access"),
    )
    return out.withColumns({k: F.lit(v) for k, v in people.items()}) if people else out
