"""Snow indices from T2 (O1-O8). Windows run over the daily rows of one site."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions.nulls import strict_max, strict_mean, strict_min
from frostline.functions.scalars import round_half_even
from frostline.operators.resample import calendar_pad
from frostline.operators.rolling import full_mean
from frostline.operators.rolling import strict_max as roll_max
from frostline.operators.rolling import strict_min as roll_min
from frostline.operators.runs import with_runs
from frostline.session import stage

LONG = ("site", "year", "var", "value", "T2_imp")
CORE_DAYS = 9
CORE_BELOW = 1.0
CORE_RANGE = 10.0
SPREAD = 4
IMP_DAYS = 15

# Frames of the nine-day window per alignment.
ALIGNMENTS = {"center": (-4, 4), "right": (-8, 0), "left": (0, 8)}


def daily_minmax(df: DataFrame) -> DataFrame:
    """Strict daily min and max of T2 and the share of imputed readings."""
    imp = F.col("T2_imp").cast("double")
    return df.groupBy("site", F.to_date("datetime").alias("date")).agg(
        strict_min(F.col("T2")).alias("T2_min"),
        strict_max(F.col("T2")).alias("T2_max"),
        strict_mean(imp).alias("T2_imp"),
    )


def core_flags(daily: DataFrame, alignments=("center",)) -> DataFrame:
    """1 where nine days stay cold and stable, per alignment of the window."""
    w = Window.partitionBy("site").orderBy("date")
    flags = {}
    for name in alignments:
        frame = w.rowsBetween(*ALIGNMENTS[name])
        top, bottom = roll_max(F.col("T2_max"), frame), roll_min(F.col("T2_min"), frame)
        core = (top < CORE_BELOW) & (top - bottom < CORE_RANGE)
        flags[f"core_{name}"] = F.when(core.isNotNull(), core.cast("int"))
    return daily.withColumns(flags)


def snow_days(daily: DataFrame) -> DataFrame:
    """Add ``snow``: within four days of a core day; null where a day in reach is unknown."""
    w = Window.partitionBy("site").orderBy("date")
    cores = core_flags(daily)
    return cores.withColumn("snow", roll_max(F.col("core_center"), w.rowsBetween(-SPREAD, SPREAD))).drop("core_center")


def midsummer_doy(days: DataFrame) -> DataFrame:
    """Rounded median day of year of a site's snow-free days (366 distinct values at most)."""
    free = days.filter("snow = 0")
    return free.groupBy("site").agg(
        round_half_even(F.median(F.dayofyear("date"))).cast("int").alias("midsummer_doy")
    )


def snow_year(days: DataFrame) -> DataFrame:
    """Add doy and the site's hydrological year, which turns half a year from midsummer.

    Calendar days without readings are added, and ``T2_imp`` becomes the 15-day share in percent.
    """
    padded = calendar_pad(days, "site", "date")
    w = Window.partitionBy("site").orderBy("date").rowsBetween(-(IMP_DAYS // 2), IMP_DAYS // 2)
    joined = padded.join(midsummer_doy(days), "site", "left")
    shifted = F.date_add(F.col("date"), F.lit(365) - F.col("midsummer_doy"))
    return joined.select(
        "site",
        "date",
        F.year(shifted).alias("hydyear"),
        F.dayofyear("date").alias("doy"),
        F.dayofyear(shifted).alias("hyddoy"),
        "snow",
        (full_mean(F.col("T2_imp"), w, IMP_DAYS) * 100).alias("T2_imp"),
    )


def snow_on_off(days: DataFrame) -> DataFrame:
    """Day of year of the first and last snow day of each hydrological year."""
    row = F.struct("doy", "T2_imp")
    ends = (
        days.filter("snow = 1 AND hydyear IS NOT NULL")
        .groupBy("site", F.col("hydyear").alias("year"))
        .agg(F.min_by(row, "date").alias("on"), F.max_by(row, "date").alias("off"))
    )
    cells = F.array(
        F.struct(F.lit("newsnow_doy").alias("var"), F.col("on.doy").cast("double").alias("value"), F.col("on.T2_imp").alias("T2_imp")),
        F.struct(F.lit("snowmelt_doy").alias("var"), F.col("off.doy").cast("double").alias("value"), F.col("off.T2_imp").alias("T2_imp")),
    )
    return ends.select("site", "year", F.inline(cells)).select(*LONG).dropna(how="any")


def snow_periods(days: DataFrame, on_off: DataFrame) -> DataFrame:
    """Number of snow days, longest period and number of periods, for years with both dates."""
    known = days.dropna(how="any")
    runs = with_runs(known, ["site", "hydyear"], "date", F.col("snow"))
    periods = (
        runs.filter("snow = 1")
        .groupBy("site", F.col("hydyear").alias("year"), "run")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("T2_imp").alias("T2_imp"))
    )
    both = on_off.groupBy("site", "year").agg(F.count(F.lit(1)).alias("k")).filter("k = 2")
    sums = periods.groupBy("site", "year").agg(
        F.sum("n").cast("double").alias("n_snow_days"),
        F.max("n").cast("double").alias("max_snow_period_length"),
        F.count(F.lit(1)).cast("double").alias("n_snow_period"),
        (F.sum(F.col("T2_imp") * F.col("n")) / F.sum("n")).alias("T2_imp"),
    )
    names = ("n_snow_days", "max_snow_period_length", "n_snow_period")
    cells = F.array(*[F.struct(F.lit(v).alias("var"), F.col(v).alias("value")) for v in names])
    return (
        sums.join(both.select("site", "year"), ["site", "year"], "left_semi")
        .select("site", "year", "T2_imp", F.inline(cells))
        .select(*LONG)
    )


def snow_indices(df: DataFrame) -> DataFrame:
    """All snow indices of imputed T2 series, long."""
    days = stage(snow_year(stage(snow_days(daily_minmax(df)))))
    on_off = snow_on_off(days)
    return reduce(DataFrame.unionByName, [on_off, snow_periods(days, on_off)])
