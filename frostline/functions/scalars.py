"""Row-level functions: identifiers, times, calibration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from frostline.config import MONTHS
from frostline.functions.nulls import no_nan

# Accepted layouts of a logger's time text, after "/" became "."; seconds are optional.
YEAR_FIRST = r"^(\d{4})\.(\d{1,2})\.(\d{1,2}) (\d{1,2}:\d{2}(:\d{2})?)$"
DAY_FIRST = r"^(\d{1,2})\.(\d{1,2})\.(\d{4}) (\d{1,2}:\d{2}(:\d{2})?)$"

HYDRO_SHIFT_DAYS = 122


def pad_site_code(x: Column, area: str | Column) -> Column:
    """Area code followed by the site number, zero-padded to three characters."""
    prefix = F.lit(area) if isinstance(area, str) else area
    x = x.cast("string")
    return F.concat(prefix, F.when(F.length(x) < 3, F.lpad(x, 3, "0")).otherwise(x))


def logger_id_from_path(path: Column) -> Column:
    """Numeric id of a file named ``data_<id>_...``."""
    return F.regexp_extract(path, r"data_(\d+)[^/]*$", 1).try_cast("long")


def parent_folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def parse_decimal_comma(x: Column) -> Column:
    """Number with a decimal comma or point; NaN and infinities are null."""
    return no_nan(F.regexp_replace(x, ",", ".").try_cast("double"))


def normalise_time_text(x: Column) -> Column:
    """Slashes become dots; a bare date means midnight."""
    x = F.translate(x, "/", ".")
    return F.when(F.length(x) == 10, F.concat(x, F.lit(" 00:00:00"))).otherwise(x)


def parse_logger_time(x: Column, ntz: bool = False) -> Column:
    """Time of a text in one of the accepted layouts; null when none fits.

    The text is put in ISO order and cast, which costs no exception for layouts that do not fit.
    """
    text = normalise_time_text(x)
    iso = (
        F.when(text.rlike(YEAR_FIRST), F.regexp_replace(text, YEAR_FIRST, "$1-$2-$3 $4"))
        .when(text.rlike(DAY_FIRST), F.regexp_replace(text, DAY_FIRST, "$3-$2-$1 $4"))
    )
    return iso.try_cast("timestamp_ntz" if ntz else "timestamp")


def hydro_date(date: Column) -> Column:
    """Shift that moves 1 September to 1 January."""
    return F.date_add(date, HYDRO_SHIFT_DAYS)


def month_label(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month.cast("int"))


def calibrate_moisture(x: Column) -> Column:
    """Volumetric moisture (percent) from the raw count, unknown soils."""
    return ((-1.34e-8) * (x * x) + 2.50e-4 * x + (-1.58e-1)) * 100.0


def round2(x: Column) -> Column:
    """Two decimals, halves up. Nine decimals first, so the order of a sum cannot tip a half."""
    return F.round(F.round(x, 9), 2)


def round_half_even(x: Column) -> Column:
    return F.bround(x, 0)


def middle_of_three(a: Column, b: Column, c: Column) -> Column:
    return F.get(F.sort_array(F.array(a, b, c)), F.lit(1))


def minutes_between(later: Column, earlier: Column) -> Column:
    """Minutes from ``earlier`` to ``later``, to the second: a fraction where stamps carry seconds."""
    return F.timestamp_diff("SECOND", earlier, later) / F.lit(60.0)


def add_minutes(time: Column, minutes: Column | int) -> Column:
    minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
    return F.timestamp_add("MINUTE", minutes.cast("long"), time)


def month_sequence(first: Column, last: Column) -> Column:
    """First days of the months from ``first`` to the end of the month that covers ``last``.

    A ``last`` that is not itself a first of a month rounds up, as a calendar ceiling does.
    """
    start = F.trunc(first, "month")
    floor = F.trunc(last, "month")
    ceiling = F.when(floor == last, floor).otherwise(F.add_months(floor, 1))
    return F.sequence(start, ceiling, F.expr("interval 1 month"))
