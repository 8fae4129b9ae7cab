"""Temperature indices (M1-M28). Wide rows hold T1..T3 with their imputed share in percent."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.config import TEMPERATURES
from frostline.functions.nulls import strict, strict_mean, thermal_sum
from frostline.functions.scalars import month_label, round2
from frostline.operators import periods
from frostline.operators.reshape import INDEX_COLUMNS, unpivot_sensors
from frostline.operators.runs import with_runs
from frostline.session import stage

SEASON = "growing_season"
IMPS = tuple(f"{t}_imp" for t in TEMPERATURES)
LONG = (*INDEX_COLUMNS, "sensor", "value", "imputed_percentage")


@dataclass(frozen=True)
class DegreeIndex:
    """A threshold index: sum of the values or number of periods beyond ``threshold``."""

    threshold: float
    above: bool
    count: bool = False
    inclusive: bool = True
    group: str = "year"
    zero_when_unhit: bool = False

    def value(self, x: Column) -> Column:
        if not self.count:
            return thermal_sum(x, self.threshold, self.above)
        t = self.threshold
        if self.above:
            hit = (x >= t) if self.inclusive else (x > t)
        else:
            hit = (x <= t) if self.inclusive else (x < t)
        return strict(F.sum(hit.cast("double")), x)

    def imputed(self, x: Column, imp: Column) -> Column:
        near = (x >= self.threshold) if self.above else (x <= self.threshold)
        return round2(F.avg(F.when(near, imp)) * 100)


# Threshold indices over days and over hours.
DAY_INDICES = {
    "TDD": DegreeIndex(0.0, True),
    "TDD_days": DegreeIndex(0.0, True, count=True, inclusive=False),
    "GDD3": DegreeIndex(3.0, True),
    "GDD3_days": DegreeIndex(3.0, True, count=True),
    "GDD5": DegreeIndex(5.0, True),
    "GDD5_days": DegreeIndex(5.0, True, count=True),
    "FDD": DegreeIndex(0.0, False, group="hydyear", zero_when_unhit=True),
    "FDD_days": DegreeIndex(0.0, False, count=True, inclusive=False, zero_when_unhit=True),
}
HOUR_INDICES = {
    "TDH": DegreeIndex(0.0, True),
    "GDH3": DegreeIndex(3.0, True),
    "GDH5": DegreeIndex(5.0, True),
    "FDH": DegreeIndex(0.0, False, group="hydyear", zero_when_unhit=True),
}


def daily_table(df: DataFrame) -> DataFrame:
    """Padded daily temperatures of imputed series."""
    return periods.padded_daily(periods.daily_partials(df, TEMPERATURES, TEMPERATURES), TEMPERATURES, TEMPERATURES)


def hourly_table(df: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """Hourly temperatures with an empty row for each missing day."""
    hourly = periods.hourly_partials(df, TEMPERATURES, TEMPERATURES)
    daily = daily_table(df) if daily is None else daily
    return periods.padded_hourly(hourly, daily, TEMPERATURES, TEMPERATURES)


def _wide(df: DataFrame, var: str, period: str | Column, keep_null: bool = False) -> DataFrame:
    period = F.lit(period) if isinstance(period, str) else period
    out = df.select(
        "site", F.lit(var).alias("var"), period.alias("period"), "year", *TEMPERATURES, *IMPS
    )
    return out if keep_null else out.dropna(how="any")


def _pooled(keys: Sequence[str]) -> list[Column]:
    """Strict means over all readings of a longer period, from daily partials."""
    n = F.sum("n")
    return [
        F.when(F.sum(f"c_{t}") == n, F.sum(f"s_{t}") / n).alias(t) for t in TEMPERATURES
    ] + [
        round2(F.when(F.sum(f"ci_{t}") == n, F.sum(f"si_{t}") / n) * 100).alias(f"{t}_imp") for t in TEMPERATURES
    ]


def annual_mean(daily: DataFrame) -> DataFrame:
    return _wide(daily.groupBy("site", "year").agg(*_pooled(["site", "year"])), "mean", "annual")


def month_mean(daily: DataFrame) -> DataFrame:
    out = daily.groupBy("site", "year", "month").agg(*_pooled(["site", "year", "month"]))
    return _wide(out, "mean", month_label(F.col("month")))


def degree_indices(table: DataFrame, indices: dict[str, DegreeIndex]) -> DataFrame:
    """All threshold indices of one table: one aggregate per grouping year."""
    parts = []
    for group in ("year", "hydyear"):
        chosen = {k: i for k, i in indices.items() if i.group == group}
        if not chosen:
            continue
        aggs = []
        for k, i in chosen.items():
            aggs += [i.value(F.col(t)).alias(f"{k}__{t}") for t in TEMPERATURES]
            aggs += [i.imputed(F.col(t), F.col(f"{t}_imp")).alias(f"{k}__{t}_imp") for t in TEMPERATURES]
        sums = table.groupBy("site", F.col(group).alias("year")).agg(*aggs)

        def imputed(k: str, i: DegreeIndex, t: str) -> Column:
            x = F.col(f"{k}__{t}_imp")
            if i.zero_when_unhit:
                x = F.when((F.col(f"{k}__{t}") == 0) & x.isNull(), F.lit(0.0)).otherwise(x)
            return x.alias(f"{t}_imp")

        rows = F.array(
            *[
                F.struct(
                    F.lit(k).alias("var"),
                    *[F.col(f"{k}__{t}").alias(t) for t in TEMPERATURES],
                    *[imputed(k, i, t) for t in TEMPERATURES],
                )
                for k, i in chosen.items()
            ]
        )
        parts.append(
            sums.select("site", "year", F.inline(rows)).select(
                "site", "var", F.lit("annual").alias("period"), "year", *TEMPERATURES, *IMPS
            )
        )
    return reduce(DataFrame.unionByName, parts).dropna(how="any")


def mean_daily_range(daily: DataFrame) -> DataFrame:
    days = daily.select(
        "site",
        "year",
        "month",
        *[(periods.strict_of(t, "hi") - periods.strict_of(t, "lo")).alias(t) for t in TEMPERATURES],
        *[round2(F.col(i) * 100).alias(i) for i in IMPS],
    )
    out = days.groupBy("site", "year", "month").agg(
        *[strict_mean(F.col(t)).alias(t) for t in TEMPERATURES],
        *[round2(strict_mean(F.col(i))).alias(i) for i in IMPS],
    )
    return _wide(out, "mean_daily_range", month_label(F.col("month")))


RANK_KEYS = ("site", "year", "month", "sensor")


def _month_cells(df: DataFrame) -> DataFrame:
    """A row per reading and sensor, with the whole degree it lies in; NaN counts as warmest, as in Spark's order."""
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("sensor"), F.col(t).cast("double").alias("value"), F.col(f"{t}_imp").cast("boolean").alias("imp"))
            for t in TEMPERATURES
        ]
    )
    degree = F.floor(F.least(F.greatest(F.col("value"), F.lit(-1e6)), F.lit(1e6)))
    rows = df.select("site", F.year("datetime").alias("year"), F.month("datetime").alias("month"), "datetime", F.inline(cells))
    return rows.withColumn("degree", F.when(F.col("value").isNotNull(), degree))


def _picked(counts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Of counts ``m`` per group and ``var``, the one that holds the rank asked for; ``rank`` is then the rank within it.

    ``order`` begins with the column of values, which falls for ``max``; the others rise.
    """

    def below(var: str, sign: str) -> Column:
        by = [getattr(F, sign)(order[0]), *order[1:]]
        return F.sum("m").over(Window.partitionBy(*RANK_KEYS, "var").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1))

    parts = []
    for var, sign in (("min", "asc"), ("max", "desc")):
        before = F.coalesce(below(var, sign), F.lit(0))
        part = counts.filter(F.col("var") == var).withColumn("_before", before)
        here = (F.col("_before") < F.col("rank")) & (F.col("_before") + F.col("m") >= F.col("rank"))
        parts.append(part.filter(here).withColumn("rank", F.col("rank") - F.col("_before")).drop("_before", "m"))
    return parts[0].unionByName(parts[1])


def month_ranks(df: DataFrame, quant_min: float = 0.001, quant_max: float = 0.999) -> DataFrame:
    """The k-th smallest and largest reading per (site, month, sensor), ``k = max(1, round(n q))``, by selection.

    Counts per whole degree tell in which degree the rank falls, counts per value and day in that degree tell the value
    and the day, and only the readings of that value and day are put in order. Counts combine before every shuffle, so
    no reading is exchanged or sorted but the few of the last step; the bounds of a step are as many rows as there are
    site-months and are staged, so Spark knows their size and broadcasts them where they are small. Nulls count for n and rank last; where the rank falls
    among them there is no row. Equal values rank by time, then measured before imputed.
    """
    cells = _month_cells(df)
    degrees = cells.groupBy(*RANK_KEYS, "degree").agg(F.count(F.lit(1)).alias("m"))
    sized = degrees.withColumn("n", F.sum("m").over(Window.partitionBy(*RANK_KEYS)))
    ranks = F.array(
        F.struct(F.lit("min").alias("var"), F.greatest(F.bround(F.col("n") * F.lit(quant_min), 0), F.lit(1.0)).alias("rank")),
        F.struct(F.lit("max").alias("var"), F.greatest(F.bround(F.col("n") * (F.lit(1.0) - F.lit(quant_max)), 0), F.lit(1.0)).alias("rank")),
    )
    asked = sized.filter("degree IS NOT NULL").select(*RANK_KEYS, "degree", "m", F.inline(ranks))
    bounds = stage(_picked(asked, ["degree"]))
    inside = cells.withColumn("day", F.dayofmonth("datetime")).join(bounds, [*RANK_KEYS, "degree"])
    values = inside.groupBy(*RANK_KEYS, "var", "rank", "value", "day").agg(F.count(F.lit(1)).alias("m"))
    days = stage(_picked(values, ["value", "day"]))
    last = cells.withColumn("day", F.dayofmonth("datetime")).join(days, [*RANK_KEYS, "value", "day"])
    stamps = last.groupBy(*RANK_KEYS, "var", "rank", "value", "datetime", "imp").agg(F.count(F.lit(1)).alias("m"))
    pct = F.when(F.col("imp"), 100.0).when(~F.col("imp"), 0.0).alias("pct")
    return _picked(stamps, ["value", "datetime", "imp"]).select("site", "year", "month", "sensor", "var", "value", pct)


def month_extremes(df: DataFrame, daily: DataFrame, quant_min: float = 0.001, quant_max: float = 0.999) -> DataFrame:
    """Robust monthly min and max, with the month number kept.

    A month counts for ``min`` when T1 is complete, for ``max`` when the sensor itself is.
    """
    whole = daily.groupBy("site", "year", "month").agg(
        *[(F.sum(f"c_{t}") == F.sum("n")).alias(f"ok_{t}") for t in TEMPERATURES]
    )
    own = reduce(
        lambda acc, t: acc.when(F.col("sensor") == t, F.col(f"ok_{t}")), TEMPERATURES, F.when(F.lit(False), F.lit(False))
    )
    picked = (
        month_ranks(df, quant_min, quant_max)
        .join(whole, ["site", "year", "month"])
        .filter(F.when(F.col("var") == "min", F.col("ok_T1")).otherwise(own))
        .dropna(how="any", subset=["value", "pct"])
    )
    return picked.groupBy("site", "year", "month", "var").agg(
        *[F.max(F.when(F.col("sensor") == t, F.col("value"))).alias(t) for t in TEMPERATURES],
        *[F.max(F.when(F.col("sensor") == t, F.col("pct"))).alias(f"{t}_imp") for t in TEMPERATURES],
    )


def month_extreme_rows(extremes: DataFrame) -> DataFrame:
    return extremes.select(
        "site", "var", month_label(F.col("month")).alias("period"), "year", *TEMPERATURES, *IMPS
    )


def annual_extremes(extremes: DataFrame) -> DataFrame:
    """Smallest monthly min and largest monthly max of years with twelve months."""
    aggs = [F.count(F.lit(1)).alias("n_months")]
    for t in TEMPERATURES:
        row = F.struct(F.col(t).alias("v"), F.col(f"{t}_imp").alias("i"))
        present = F.col(t).isNotNull()
        low = F.when(present & (F.col("var") == "min"), F.struct(F.col(t).alias("k"), F.col("month").alias("m")))
        high = F.when(present & (F.col("var") == "max"), F.struct((-F.col(t)).alias("k"), F.col("month").alias("m")))
        aggs.append(F.coalesce(F.min_by(row, low), F.min_by(row, high)).alias(f"_{t}"))
    best = extremes.groupBy("site", "year", "var").agg(*aggs).filter("n_months = 12")
    return best.select(
        "site",
        "var",
        F.lit("annual").alias("period"),
        "year",
        *[F.col(f"_{t}.v").alias(t) for t in TEMPERATURES],
        *[F.col(f"_{t}.i").alias(f"{t}_imp") for t in TEMPERATURES],
    )


def annual_range(annual: DataFrame) -> DataFrame:
    """Max minus min of the annual extremes; the imputed share is the larger of both."""
    out = annual.groupBy("site", "year").agg(
        *[strict(F.max(t) - F.min(t), F.col(t)).alias(t) for t in TEMPERATURES],
        *[strict(F.max(i), F.col(i)).alias(i) for i in IMPS],
    )
    return _wide(out, "range", "annual", keep_null=True)


def complete_years(daily: DataFrame) -> DataFrame:
    """(site, year) pairs in which all three sensors and their flags are complete."""
    return annual_mean(daily).select("site", "year")


def season_runs(days: DataFrame, warm: Column, keep: Column, min_days: int) -> DataFrame:
    """Days meeting ``keep`` inside runs of equal ``warm`` of at least ``min_days`` days."""
    runs = with_runs(days, ["site", "year"], "date", warm)
    return runs.filter(keep & (F.col("run_length") >= min_days))


def season_bounds(days: DataFrame, sensor: str = "T3") -> DataFrame:
    """First and last season day per (site, year), from runs of the sensor's daily mean."""
    x = F.col(sensor)
    warm, keep, length = (x > 1, x >= 1, 5) if sensor == "T1" else (x >= 3, x >= 3, 6)
    return (
        season_runs(days, warm, keep, length)
        .groupBy("site", "year")
        .agg(
            F.min("doy").alias("start_of_season"),
            F.max("doy").alias("end_of_season"),
            *([round2(strict_mean(F.col(f"{sensor}_imp")) * 100).alias("imp")] if f"{sensor}_imp" in days.columns else []),
        )
    )


def _long(df: DataFrame, var: str, sensor: str, value: Column, imp: Column, period: str = SEASON) -> DataFrame:
    return df.select(
        "site",
        F.lit(var).alias("var"),
        F.lit(period).alias("period"),
        "year",
        F.lit(sensor).alias("sensor"),
        value.cast("double").alias("value"),
        imp.alias("imputed_percentage"),
    )


def season_index(daily: DataFrame, years: DataFrame, sensor: str) -> DataFrame:
    """Start, end and length of the season of complete years."""
    bounds = season_bounds(daily.join(years, ["site", "year"], "left_semi"), sensor)
    rows = F.array(
        F.struct(F.lit("start_of_season").alias("var"), F.col("start_of_season").alias("value")),
        F.struct(F.lit("end_of_season").alias("var"), F.col("end_of_season").alias("value")),
        F.struct(
            F.lit("season_length").alias("var"),
            (F.col("end_of_season") - F.col("start_of_season")).alias("value"),
        ),
    )
    return bounds.select("site", "year", "imp", F.inline(rows)).select(
        "site",
        "var",
        F.lit(SEASON).alias("period"),
        "year",
        F.lit(sensor).alias("sensor"),
        F.col("value").cast("double").alias("value"),
        F.col("imp").alias("imputed_percentage"),
    )


def _frost_days(daily: DataFrame) -> DataFrame:
    return daily.withColumn("T3_low", periods.strict_of("T3", "lo"))


def season_frost(daily: DataFrame, years: DataFrame, by: str) -> DataFrame:
    """Sum of frost (daily T3 minima at or below 0) in the season seen by T1 or T3."""
    days = _frost_days(daily).join(years, ["site", "year"], "left_semi")
    if by == "T1":
        kept = season_runs(days, F.col("T1") >= 1, F.col("T1") >= 1, 6).filter("doy <= 212")
    else:
        kept = season_runs(days, F.col("T3") >= 3, F.col("T3") >= 3, 6)
    sums = kept.groupBy("site", "year").agg(
        thermal_sum(F.col("T3_low"), 0.0, above=False).alias("v"),
        round2(strict_mean(F.col("T3_imp")) * 100).alias("i"),
    )
    name = "GST1_frost" if by == "T1" else "GST3_frost"
    return _long(sums, name, "T3", F.col("v"), F.col("i")).dropna(how="any")


def summer_frost(daily: DataFrame, years: DataFrame) -> DataFrame:
    """June to August days with frost at T3 while T1 shows no snow cover."""
    days = _frost_days(daily).filter(F.col("month").isin(6, 7, 8)).join(years, ["site", "year"], "left_semi")
    kept = season_runs(days, F.col("T1") > 1, F.col("T1") >= 1, 5)
    sums = kept.groupBy("site", "year").agg(
        F.sum((F.col("T3_low") < 0).cast("double")).alias("v"),
        round2(strict_mean(F.col("T3_imp")) * 100).alias("i"),
    )
    return _long(sums, "summer_frost_freq", "T3", F.col("v"), F.col("i"))


def freeze_thaw(daily: DataFrame, sensor: str, amplitude: float = 0.5) -> DataFrame:
    """Sign changes larger than ``amplitude`` along max, min, max, min ... per hydrological year."""
    w = Window.partitionBy("site", "hydyear").orderBy("date")
    high, low = periods.strict_of(sensor, "hi"), periods.strict_of(sensor, "lo")
    days = daily.select("site", "hydyear", "date", f"{sensor}_imp", high.alias("hi"), low.alias("lo")).withColumn(
        "before", F.lag("lo").over(w)
    )

    def crossing(a: str, b: str) -> Column:
        change = ((F.col(a) >= 0) != (F.col(b) >= 0)) & (F.abs(F.col(a) - F.col(b)) > amplitude)
        return F.coalesce(change.cast("int"), F.lit(0))

    sums = (
        days.groupBy("site", F.col("hydyear").alias("year"))
        .agg(
            F.sum(crossing("before", "hi") + crossing("hi", "lo")).alias("v"),
            round2(strict_mean(F.col(f"{sensor}_imp")) * 100).alias("i"),
        )
    )
    return _long(sums, "freeze_thaw_freq", sensor, F.col("v"), F.col("i"), "annual").dropna(how="any")


def temperature_indices(df: DataFrame, quant_max: float = 0.999, quant_min: float = 0.001) -> DataFrame:
    """All temperature indices of imputed series, long.

    The hourly partials are staged once: a quarter of the readings
    or less, and some twenty aggregates read them.
    """
    partials = stage(periods.hourly_partials(df, TEMPERATURES, TEMPERATURES))
    daily = stage(
        periods.padded_daily(
            periods.daily_from_hourly(partials, TEMPERATURES, TEMPERATURES), TEMPERATURES, TEMPERATURES
        )
    )
    hourly = periods.padded_hourly(partials, daily, TEMPERATURES, TEMPERATURES)
    years = complete_years(daily)
    extremes = stage(month_extremes(df, daily, quant_min, quant_max))
    annual = annual_extremes(extremes)
    wide = reduce(
        DataFrame.unionByName,
        [
            annual_mean(daily),
            annual,
            annual_range(annual),
            degree_indices(daily, DAY_INDICES),
            degree_indices(hourly, HOUR_INDICES),
            month_mean(daily),
            mean_daily_range(daily),
            month_extreme_rows(extremes),
        ],
    )
    long = [
        unpivot_sensors(wide, TEMPERATURES),
        season_index(daily, years, "T1"),
        season_index(daily, years, "T3"),
        season_frost(daily, years, "T1"),
        season_frost(daily, years, "T3"),
        summer_frost(daily, years),
        freeze_thaw(daily, "T1"),
        freeze_thaw(daily, "T3"),
    ]
    return reduce(DataFrame.unionByName, [p.select(*LONG) for p in long]).dropna(how="any")
