"""All study areas in one job (section 2.12): what differs between them is looked up by each row's area.

The area is part of the site key, so it leads every window and join of the cleaning chain, and sites of the same number in
two areas stay apart. Limits, error codes and peak rules are chosen by the area in the expressions themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from frostline.config import (
    ERROR_CODES,
    PEAK_RULES,
    PEAK_RULES_2023,
    PEAK_RULES_2023_VIN,
    PLAUSIBLE,
    PLAUSIBLE_2023,
    SENSORS,
    PeakRules,
)
from frostline.operators.bias import apply_bias
from frostline.operators.gaps import fill_gaps_site
from frostline.operators.masks import mask_visits_and_range
from frostline.operators.peaks import flag_peaks, mask_peaks
from frostline.operators.resample import regularise
from frostline.session import stage


@dataclass(frozen=True)
class CleaningPolicy:
    """How an area's readings are cleaned."""

    limits: Mapping[str, tuple[float, float]] = field(default_factory=lambda: PLAUSIBLE)
    codes: Mapping[str, Sequence[int]] = field(default_factory=lambda: ERROR_CODES)
    rules: Mapping[str, PeakRules] = field(default_factory=lambda: PEAK_RULES)


CURRENT = CleaningPolicy()
OF_2023 = CleaningPolicy(limits=PLAUSIBLE_2023, rules=PEAK_RULES_2023)
OF_2023_VIN = CleaningPolicy(limits=PLAUSIBLE_2023, rules=PEAK_RULES_2023_VIN)


def by_area(area: Column, policies: Mapping[str, CleaningPolicy], value: Callable[[CleaningPolicy], object]) -> Column:
    """What ``value`` gives for the policy of a row's area; areas of one value share a branch."""
    groups: list[tuple[object, list[str]]] = []
    for name, policy in policies.items():
        own = value(policy)
        same = next((names for known, names in groups if not isinstance(own, Column) and known == own), None)
        if same is None:
            groups.append((own, [name]))
        else:
            same.append(name)
    out = F.raise_error(F.concat(F.lit("no policy for area "), F.coalesce(area, F.lit("null")))).cast("double")
    if isinstance(groups[0][0], Column):
        out = out.cast("boolean")
    for own, names in reversed(groups):
        out = F.when(area.isin(*names), own if isinstance(own, Column) else F.lit(own)).otherwise(out)
    return out


def _keyed(df: DataFrame) -> DataFrame:
    """The area moves into the site key."""
    key = F.struct(F.col("area").alias("area"), F.col("site").alias("site"))
    return df.select(*[key.alias("site") if c == "site" else F.col(c) for c in df.columns if c != "area"])


def clean_areas(
    raw: DataFrame,
    bias: DataFrame,
    visits: DataFrame,
    policies: Mapping[str, CleaningPolicy],
    sensors: Sequence[str] = SENSORS,
    chunk: Column | None = None,
) -> tuple[DataFrame, Observation]:
    """``clean_series`` over all areas of ``raw`` at once, and the numbers of peaks, counted by area in the masking job.

    ``raw`` and ``visits`` have an ``area``; a row of an area without a policy is an error, and rows without a site are left out. The reference series of an area is
    that of its own sites. The result has the columns of ``raw``. The observation holds ``<sensor>_<area>`` of every area.
    """
    area = F.col("site.area")
    columns = raw.columns
    df = apply_bias(_keyed(raw.filter("site IS NOT NULL")), bias)
    limits = {s: tuple(by_area(area, policies, lambda p, s=s, k=k: p.limits[s][k]) for k in (0, 1)) for s in sensors}
    marks = _keyed(visits.filter("area IS NOT NULL AND site IS NOT NULL"))
    df = mask_visits_and_range(df, marks, limits, sensors, chunk=chunk)

    def valid(s: str) -> Column:
        bad = by_area(area, policies, lambda p: F.coalesce(F.col("error_tomst").isin(*p.codes[s]), F.lit(False)))
        return F.when(~bad, F.col(s)).alias(s)

    df = stage(df.select(*[valid(c) if c in sensors else F.col(c) for c in df.columns]))
    df = stage(regularise(df, sensors=sensors, chunk=chunk)).withColumn("area", F.col("site.area"))
    default, *others = list(policies.items())
    cases = [(F.col("area") == name, policy.rules) for name, policy in others]
    flagged = flag_peaks(df, default[1].rules, sensors, chunk=chunk, by=("area",), cases=cases)
    seen = Observation()
    counts = [F.count_if(F.col(f"{s}_peak") & (F.col("area") == a)).alias(f"{s}_{a}") for s in sensors for a in policies]
    masked = stage(mask_peaks(flagged.observe(seen, *counts), sensors).drop("area"))
    out = fill_gaps_site(masked, chunk=chunk)
    return out.select(*[F.col(f"site.{c}").alias(c) if c in ("area", "site") else F.col(c) for c in columns]), seen

