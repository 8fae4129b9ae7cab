"""Soil-moisture indices (N1-N13) from calibrated, imputed series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions.nulls import ratio
from frostline.functions.scalars import calibrate_moisture, month_label, round2
from frostline.functions.stats import STAT_NAMES, bundle_aggregates, bundle_columns
from frostline.operators import periods
from frostline.operators.rolling import full_mean
from frostline.operators.thermal import season_bounds
from frostline.session import stage

TYPES = ("moist", "moistsat")
VALUES = ("T1", "T3", "moist")
FLAGS = ("moist",)
LONG = ("site", "var", "period", "year", "imputed_percentage", "moist_type", "value")
ICE_FREE = "ice_free_season"
GROWING = "growing_season"
FIRST14 = "first_two_weeks_of_GS"
FIRST28 = "first_four_weeks_of_GS"
ROLL_DAYS = 13


def calibrate(df: DataFrame) -> DataFrame:
    """Raw counts to percent, one decimal."""
    return df.withColumn("moist", F.round(calibrate_moisture(F.col("moist")), 1))


def rescale_max(df: DataFrame, value: str = "moist", site: str = "site", name: str = "moistsat") -> DataFrame:
    """``value`` in percent of the site's largest value."""
    top = df.groupBy(site).agg(F.max(value).alias("_top"))
    return df.join(top, site).select(*df.columns, (ratio(F.col(value), F.col("_top")) * 100).alias(name))


def daily_table(df: DataFrame, staged: bool = False) -> DataFrame:
    """Padded daily T1, T3, moist, moistsat and the imputed share of moist.

    The site's maximum is taken from the daily maxima. With ``staged`` the daily sums are written
    first, so the readings are read once, not also for the calendar and the maximum.
    """
    partials = periods.daily_partials(df, VALUES, FLAGS)
    daily = periods.padded_daily(stage(partials) if staged else partials, VALUES, FLAGS)
    top = daily.groupBy("site").agg(F.max("hi_moist").alias("_top"))
    return daily.join(top, "site").select(
        "site", "date", "year", "month", "doy", "n", "c_T1", *VALUES,
        (ratio(F.col("moist"), F.col("_top")) * 100).alias("moistsat"), "moist_imp",
    )


def complete_years(daily: DataFrame) -> DataFrame:
    """(site, year) pairs with a complete T1."""
    sums = daily.groupBy("site", "year").agg((F.sum("c_T1") == F.sum("n")).alias("ok"))
    return sums.filter("ok").select("site", "year")


def labelled(days: DataFrame, period: str | Column) -> DataFrame:
    """Days with the label of the period they count for."""
    period = F.lit(period) if isinstance(period, str) else period
    return days.select("site", "year", period.alias("period"), *TYPES, "moist_imp")


def bundle(days: DataFrame) -> DataFrame:
    """The 13 statistics of both moisture types per site, year and period label.

    A period with any undefined statistic is dropped as a whole.
    """
    aggs = [a for t in TYPES for a in bundle_aggregates(t)]
    stats = days.groupBy("site", "year", "period").agg(
        *aggs, round2(F.avg("moist_imp") * 100).alias("imputed_percentage")
    )
    columns = {t: bundle_columns(t) for t in TYPES}
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("moist_type"), F.lit(s).alias("var"), columns[t][s].alias("value"))
            for t in TYPES
            for s in STAT_NAMES
        ]
    )
    whole = F.col("imputed_percentage").isNotNull() & F.forall("cells", lambda c: c["value"].isNotNull())
    return (
        stats.select("site", "year", "period", "imputed_percentage", cells.alias("cells"))
        .filter(whole)
        .select("site", "year", "period", "imputed_percentage", F.inline("cells"))
        .select(*LONG)
    )


def monthly_days(daily: DataFrame) -> DataFrame:
    """Days of months with less than half of their days missing."""
    share = F.avg(F.col("moist").isNull().cast("double"))
    kept = daily.groupBy("site", "year", "month").agg(share.alias("p")).filter("p < 0.5")
    days = daily.join(kept.select("site", "year", "month"), ["site", "year", "month"], "left_semi")
    return labelled(days, month_label(F.col("month")))


def ice_free_days(daily: DataFrame, years: DataFrame) -> DataFrame:
    return labelled(daily.join(years, ["site", "year"], "left_semi"), ICE_FREE)


def growing_bounds(daily: DataFrame, years: DataFrame) -> DataFrame:
    """Season bounds from T3, complete years only."""
    return season_bounds(daily.join(years, ["site", "year"], "left_semi"), "T3").select(
        "site", "year", "start_of_season", "end_of_season"
    )


def rows_in_season(daily: DataFrame, bounds: DataFrame, until_end: bool = True) -> DataFrame:
    """Days from the start of the season, to its end unless told otherwise."""
    rows = daily.join(bounds, ["site", "year"])
    inside = F.col("doy") >= F.col("start_of_season")
    if until_end:
        inside = inside & (F.col("doy") <= F.col("end_of_season"))
    return rows.filter(inside)


def rolled(days: DataFrame) -> DataFrame:
    """13-day means over the days that have data, whole frames only."""
    w = Window.partitionBy("site", "year").orderBy("doy")
    half = ROLL_DAYS // 2
    frame = w.rowsBetween(-half, half)
    days = days.select("site", "year", "doy", "moist", "moistsat", "moist_imp").dropna(how="any")
    out = days.select(
        "site", "year", "doy",
        *[full_mean(F.col(c), frame, ROLL_DAYS, strict=False).alias(c) for c in ("moist", "moistsat")],
        (full_mean(F.col("moist_imp"), frame, ROLL_DAYS, strict=False) * 100).alias("imputed_percentage"),
    )
    return out.dropna(how="any")


def extreme_weeks(days: DataFrame, period: str, fix_labels: bool = False) -> DataFrame:
    """Driest and wettest two weeks with their timing; the row is chosen by ``moist``."""
    row = F.struct("doy", "moist", "moistsat", "imputed_percentage")
    best = rolled(days).groupBy("site", "year").agg(
        F.min_by(row, F.struct("moist", "doy")).alias("dry"),
        F.min_by(row, F.struct((-F.col("moist")).alias("m"), F.col("doy"))).alias("wet"),
    )
    # Index names, the last one spelled as the published tables have it.
    wet_timing = "wettest_two_weeks_timing" if fix_labels else "wettes_two_weeks_timing"
    cells = []
    for side, name, timing in (("dry", "driest_two_weeks", "driest_two_weeks_timing"), ("wet", "wettest_two_weeks", wet_timing)):
        for t in TYPES:
            cells += [
                F.struct(F.lit(name).alias("var"), F.lit(t).alias("moist_type"), F.col(f"{side}.{t}").alias("value"),
                         F.col(f"{side}.imputed_percentage").alias("imputed_percentage")),
                F.struct(F.lit(timing).alias("var"), F.lit(t).alias("moist_type"),
                         F.col(f"{side}.doy").cast("double").alias("value"),
                         F.col(f"{side}.imputed_percentage").alias("imputed_percentage")),
            ]
    return best.select("site", "year", F.lit(period).alias("period"), F.inline(F.array(*cells))).select(*LONG)


def first_days(from_start: DataFrame, k: int) -> DataFrame:
    """First ``k`` calendar days of the season."""
    w = Window.partitionBy("site", "year").orderBy("date")
    return from_start.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= k).drop("_k")


# Labels of the quarters of the growing season.
QUARTERS = (
    "1st_quartile_growing_season",
    "2nd_quartile_growing_season",
    "3rd_quartile_growing_season",
    "4th_quartile_growing_season",
)


def with_quarters(season: DataFrame) -> DataFrame:
    """Split the days that have data into four parts; the first parts take the extra days."""
    days = season.select("site", "year", "doy", "moist", "moistsat", "moist_imp").dropna(how="any")
    return days.withColumn("quarter", F.ntile(4).over(Window.partitionBy("site", "year").orderBy("doy")))


def quarter_days(season: DataFrame) -> DataFrame:
    label = F.element_at(F.array(*[F.lit(q) for q in QUARTERS]), F.col("quarter"))
    return labelled(with_quarters(season), label)


def trend(days: DataFrame, value: str, period: str = ICE_FREE) -> DataFrame:
    """Slope and R2 of ``value`` over the day of year."""
    days = days.select("site", "year", "doy", value, "moist_imp").dropna(how="any")
    fit = days.groupBy("site", "year").agg(
        F.regr_slope(F.col(value), F.col("doy")).alias("slope"),
        F.when(F.var_pop(value) > 0, F.regr_r2(F.col(value), F.col("doy"))).alias("r2"),
        (F.avg("moist_imp") * 100).alias("imputed_percentage"),
    )
    cells = F.array(
        F.struct(F.lit("trend_slope").alias("var"), F.col("slope").alias("value")),
        F.struct(F.lit("trend_r2").alias("var"), F.col("r2").alias("value")),
    )
    return (
        fit.select(
            "site", "year", F.lit(period).alias("period"), "imputed_percentage", F.lit(value).alias("moist_type"), F.inline(cells)
        )
        .select(*LONG)
        .dropna(how="any")
    )


def moisture_indices(df: DataFrame, fix_labels: bool = False) -> DataFrame:
    """All moisture indices, long; ``df`` holds calibrated moisture.

    The statistics of all periods come from one aggregate over labelled days.
    """
    daily = stage(daily_table(df, staged=True))
    years = complete_years(daily)
    bounds = stage(growing_bounds(daily, years))
    whole = stage(daily.join(years, ["site", "year"], "left_semi"))
    from_start = rows_in_season(daily, bounds, until_end=False)
    season = stage(rows_in_season(daily, bounds))
    days = [
        monthly_days(daily),
        labelled(whole, ICE_FREE),
        labelled(season, GROWING),
        labelled(first_days(from_start, 14), FIRST14),
        labelled(first_days(from_start, 28), FIRST28),
        quarter_days(season),
    ]
    parts = [
        bundle(reduce(DataFrame.unionByName, days)),
        extreme_weeks(whole, ICE_FREE, fix_labels),
        extreme_weeks(season, GROWING, fix_labels),
        trend(whole, "moist"),
        trend(season, "moistsat", GROWING if fix_labels else ICE_FREE),
    ]
    return reduce(DataFrame.unionByName, parts)
