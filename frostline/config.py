"""Per-area parameters and fixed lookup values."""

from __future__ import annotations

from dataclasses import dataclass

SENSORS = ("T1", "T2", "T3", "moist")
TEMPERATURES = ("T1", "T2", "T3")

# Error codes and the sensors each one invalidates.
ERROR_CODES = {
    "T1": (1, 2, 4, 9),
    "T2": (1, 2, 7, 8),
    "T3": (1, 2, 4, 5, 7, 8, 10),
    "moist": (1, 2, 6, 8, 9, 10),
}
NOT_IN_FIELD = 2

# Plausible limits, (lowest, highest) kept; the moisture ceiling itself is masked.
PLAUSIBLE = {"T1": (-40.0, 30.0), "T2": (-60.0, 50.0), "T3": (-60.0, 50.0), "moist": (200.0, 4080.0)}
PLAUSIBLE_2023 = {**PLAUSIBLE, "moist": (200.0, 4096.0)}

# Lowest T1 kept by the export stage, per area.
EXPORT_T1_FLOOR = {"MAT": -30.0, "OUL": -30.0, "VIN": -40.0, "RAS": -20.0}


@dataclass(frozen=True)
class PeakRules:
    """Thresholds of the peak rules of one sensor; ``None`` leaves a rule out."""

    sd_factor: float | None
    high: float | None
    low: float | None
    roll: float
    previous: float
    following: float
    rise: float
    rise_roll: float | None
    drop: float
    drop_roll: float | None
    signed_steps: bool = False
    rise_guard_clears: bool = False


# Peak thresholds per sensor.
PEAK_RULES = {
    "T1": PeakRules(6, 10, -20, 5, 5, 5, 2, 2, 2, 2),
    "T2": PeakRules(8, 20, -20, 10, 10, 10, 5, 5, 5, 5, rise_guard_clears=True),
    "T3": PeakRules(8, 20, -20, 10, 10, 10, 8, 8, 8, 8),
    "moist": PeakRules(None, None, None, 1500, 2000, 1000, 1000, 1000, 500, 500, signed_steps=True),
}

# The 2023 rule sets; the moisture thresholds differ between two areas.
PEAK_RULES_2023 = {
    "T1": PeakRules(6, 10, -20, 5, 5, 5, 2, None, 2, None),
    "T2": PeakRules(8, 20, -20, 10, 10, 10, 5, None, 5, None),
    "T3": PeakRules(8, 20, -20, 10, 10, 10, 5, None, 5, None),
    "moist": PeakRules(None, None, None, 1000, 1500, 1000, 300, None, 100, None),
}
PEAK_RULES_2023_VIN = {
    **PEAK_RULES_2023,
    "moist": PeakRules(None, None, None, 1000, 2000, 1000, 500, None, 200, None, signed_steps=True),
}


@dataclass(frozen=True)
class Area:
    """What differs between study areas."""

    code: str
    first_day: str = "2018-06-01"
    last_day: str = "2023-11-01"
    site_source: str = "registry"
    merges_archive: bool = False
    ledger_replaces: bool = False
    bias_drops_null: bool = False
    registry_drops_null: bool = False
    snow_t2_codes: tuple[int, ...] = (2,)
    trees: tuple[int, int, int, int] = (100, 50, 50, 50)
    drop_null_before_pivot: bool = False
    keep_only_t3: bool = False
    min_observed_sites: int | None = None


# The study areas.
AREAS = {
    a.code: a
    for a in (
        Area("EVO", ledger_replaces=True, bias_drops_null=True, drop_null_before_pivot=True),
        Area("HYY", merges_archive=True, drop_null_before_pivot=True),
        Area("KAR", last_day="2023-10-01", merges_archive=True),
        Area("KIL", first_day="2021-04-01", last_day="2023-10-01", site_source="map", merges_archive=True,
             trees=(50, 50, 50, 50), keep_only_t3=True, min_observed_sites=20),
        Area("MAT", last_day="2023-10-04"),
        Area("OUL", last_day="2023-10-04", ledger_replaces=True),
        Area("PAL", site_source="initial_codes", bias_drops_null=True, registry_drops_null=True,
             snow_t2_codes=(2, 7, 8), drop_null_before_pivot=True),
        Area("PIS", merges_archive=True, drop_null_before_pivot=True),
        Area("RAS", last_day="2023-08-01", merges_archive=True),
        Area("TII", merges_archive=True, drop_null_before_pivot=True),
        Area("ULV", site_source="initial_codes", ledger_replaces=True, bias_drops_null=True,
             registry_drops_null=True, drop_null_before_pivot=True),
        Area("VAR", last_day="2023-10-01", merges_archive=True),
        Area("VIN", last_day="2023-10-04", trees=(100, 100, 100, 100)),
    )
}

# Month names used as period labels.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Sensor constants of the exchange format.
# sensor, shielding, shielding type, measurement, unit, accuracy, height, length
SENSOR_CONSTANTS = (
    ("T1", "No", None, "Temperature", "°C", 0.5, -6.0, None),
    ("T2", "Yes", "No", "Temperature", "°C", 0.5, 2.0, None),
    ("T3", "Yes", "No", "Temperature", "°C", 0.5, 15.0, None),
    ("Soil_moisture", "No", None, "Soil_moisture", "raw", 1.0, -7.5, 15.0),
)

# Columns of the exchange metadata, in order.
EXPORT_COLUMNS = (
    "meta_id", "Country_code", "Experiment_name", "Experimental_manipulation", "Experiment_insitu",
    "Experiment_climate", "Experiment_citizens", "Experiment_design", "Experiment_doi",
    "Experiment_comment", "Site_id", "Elevation", "Habitat_type", "Habitat_sub_type", "Site_comments",
    "Logger_code", "Raw_data_identifier", "Latitude", "Longitude", "EPSG", "GPS_accuracy",
    "Logger_serial_number", "Logger_brand", "Logger_type", "Logger_age", "Logger_comment", "Sensor_code",
    "Sensor_shielding", "Sensor_shielding_type", "Microclimate_measurement", "Unit", "Sensor_accuracy",
    "Temporal_resolution", "Sensor_height", "Sensor_length", "Start_date_year", "Start_date_month",
    "Start_date_day", "End_date_year", "End_date_month", "End_date_day", "Timezone", "Time_difference",
    "Licence", "Sensor_comments", "Species_composition", "Species_trait",
)
