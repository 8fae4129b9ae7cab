"""Peaks against a network-wide reference series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from frostline.config import PEAK_RULES, SENSORS, PeakRules
from frostline.operators.chunks import row_halo
from frostline.operators.rolling import mask_hit, mean_of_others, rows_in

ROLL = 9
SPREAD = 5


def reference_series(df: DataFrame, sensors: Sequence[str] = SENSORS, time: str = "datetime", by: Sequence[str] = ()) -> DataFrame:
    """Mean and standard deviation over all sites (of each ``by``) at each time; nulls are skipped."""
    return df.groupBy(*by, time).agg(
        *[F.avg(s).alias(f"{s}_mean") for s in sensors],
        *[F.stddev_samp(s).alias(f"{s}_sd") for s in sensors],
    )


def rule_conditions(rules: PeakRules, d: Column, sd: Column, roll: Column, h: Column, l: Column) -> list:
    """The rules in order, as (condition, flag it sets)."""
    off = F.abs(d - roll)
    yes = F.lit(True)
    out = []
    if rules.sd_factor is not None:
        far = F.abs(d) > sd * rules.sd_factor
        out += [(far & (d > rules.high), yes), (far & (d < rules.low), yes)]
    size = (lambda x: x) if rules.signed_steps else F.abs
    out += [(off > rules.roll, yes), (size(h) > rules.previous, yes), (size(l) > rules.following, yes)]
    rise = (h > rules.rise) & (l > rules.rise)
    drop = (h < -rules.drop) & (l < -rules.drop)
    if rules.rise_guard_clears:
        out.append((rise, off > rules.rise_roll))
    else:
        out.append((rise if rules.rise_roll is None else rise & (off > rules.rise_roll), yes))
    out.append((drop if rules.drop_roll is None else drop & (off > rules.drop_roll), yes))
    return out


def chain(conditions: list, any_rule: bool = False) -> Column:
    """Apply rules one after the other; an unknown condition overwrites an earlier flag with null.

    ``any_rule`` flags a row as soon as one rule holds instead.
    """
    flag = F.lit(False)
    for condition, sets in conditions:
        if any_rule:
            flag = flag | F.coalesce(condition & sets, F.lit(False))
        else:
            flag = F.when(condition.isNull(), None).when(condition, sets).otherwise(flag)
    return F.coalesce(flag, F.lit(False))


def flag_peaks(
    df: DataFrame,
    rules: Mapping[str, PeakRules] = PEAK_RULES,
    sensors: Sequence[str] = SENSORS,
    site: str = "site",
    time: str = "datetime",
    any_rule: bool = False,
    chunk: Column | None = None,
    by: Sequence[str] = (),
    cases: Sequence[tuple[Column, Mapping[str, PeakRules]]] = (),
) -> DataFrame:
    """Add ``<sensor>_peak`` (a rule fired) and ``<sensor>_masked`` (within two rows of a peak).

    All sensors share one pass: the rolling mean reaches four rows, its spread two more. ``by`` splits the network that the
    reference series is taken from; ``cases`` are other rules for rows that meet a condition, the first that holds.
    """
    reach = ROLL // 2 + SPREAD // 2
    sensors = [s for s in sensors if s in df.columns]
    halo = row_halo(df, [site], time, reach, reach, chunk)
    reference = reference_series(df, sensors, time, by)
    joined = halo.df.join(reference, [*by, time], "left")
    w, wide, narrow = halo.window, halo.frame(ROLL // 2, ROLL // 2), halo.frame(SPREAD // 2, SPREAD // 2)
    out = joined.withColumns({f"_d_{s}": F.col(s) - F.col(f"{s}_mean") for s in sensors})
    # Each window once, as a column: the rules name them many times, and Spark would run every mention.
    out = out.withColumns(
        {
            "_in_wide": rows_in(wide),
            "_in_narrow": rows_in(narrow),
            **{f"_n_{s}": F.count(f"_d_{s}").over(wide) for s in sensors},
            **{f"_sum_{s}": F.sum(f"_d_{s}").over(wide) for s in sensors},
            **{f"_lag_{s}": F.lag(s).over(w) for s in sensors},
            **{f"_lead_{s}": F.lead(s).over(w) for s in sensors},
        }
    )
    out = out.withColumns(
        {
            f"_roll_{s}": mean_of_others(F.col(f"_d_{s}"), F.col(f"_n_{s}"), F.col(f"_sum_{s}"), F.col("_in_wide"), ROLL)
            for s in sensors
        }
    )

    def flag(s: str) -> Column:
        d, sd, roll = F.col(f"_d_{s}"), F.col(f"{s}_sd"), F.col(f"_roll_{s}")
        steps = (F.col(s) - F.col(f"_lag_{s}"), F.col(s) - F.col(f"_lead_{s}"))
        found = chain(rule_conditions(rules[s], d, sd, roll, *steps), any_rule)
        for condition, other in reversed(cases):
            found = F.when(condition, chain(rule_conditions(other[s], d, sd, roll, *steps), any_rule)).otherwise(found)
        return found

    out = out.withColumns({f"{s}_peak": flag(s) for s in sensors})
    out = out.withColumns(
        {f"{s}_masked": mask_hit(F.col(f"{s}_peak"), narrow, SPREAD, rows=F.col("_in_narrow")) == 1 for s in sensors}
    )
    return halo.own(out).select(
        *df.columns, *[f"{s}_peak" for s in sensors], *[f"{s}_masked" for s in sensors]
    )


def observe_peaks(flagged: DataFrame, sensors: Sequence[str] = SENSORS) -> tuple[DataFrame, Observation]:
    """The flagged rows, and the numbers of peaks per sensor that their first action counts on the way: no job of their own."""
    seen = Observation()
    counts = [F.count_if(F.col(f"{s}_peak")).alias(s) for s in sensors if f"{s}_peak" in flagged.columns]
    return flagged.observe(seen, *counts), seen


def mask_peaks(flagged: DataFrame, sensors: Sequence[str] = SENSORS) -> DataFrame:
    """Null the flagged readings and drop the flags."""
    sensors = [s for s in sensors if f"{s}_masked" in flagged.columns]
    extra = {f"{s}_{e}" for s in sensors for e in ("peak", "masked")}
    return flagged.select(
        *[
            F.when(~F.col(f"{c}_masked"), F.col(c)).alias(c) if c in sensors else F.col(c)
            for c in flagged.columns
            if c not in extra
        ]
    )


def remove_peaks(df: DataFrame, rules=PEAK_RULES, sensors: Sequence[str] = SENSORS, **options) -> DataFrame:
    return mask_peaks(flag_peaks(df, rules, sensors, **options), sensors)


def peak_counts(flagged: DataFrame, sensors: Sequence[str] = SENSORS) -> DataFrame:
    """Number of peaks per sensor, as (sensor, n_peaks)."""
    counts = flagged.agg(*[F.sum(F.col(f"{s}_peak").cast("long")).alias(s) for s in sensors])
    return counts.unpivot([], list(sensors), "sensor", "n_peaks")
