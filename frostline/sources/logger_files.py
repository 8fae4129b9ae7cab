"""Raw logger files (A1-A9): semicolon-separated text without a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.functions.scalars import (
    DAY_FIRST,
    YEAR_FIRST,
    logger_id_from_path,
    normalise_time_text,
    parse_decimal_comma,
    parse_logger_time,
)
from frostline.operators.dedup import keep_last
from frostline.session import LOCAL_ZONE, settings, stage

MIN_ROWS = 100
FIELDS = 7
# Accepted column separators of a logger file.
SEPARATORS = ";,\t"


def logical_path(path: Column) -> Column:
    """Path of a logger file; one that Spark wrote is a folder ``name=<file>`` of parts, and the folder is the file."""
    return F.regexp_replace(F.regexp_replace(path, r"/part-[^/]*$", ""), "/[^/=]+=", "/")


def listing(spark: SparkSession):
    """Options while Spark lists a tree: a few tasks per core share its folders, where Spark would run a task per folder."""
    return settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": 4 * spark.sparkContext.defaultParallelism})


def read_logger_lines(
    spark: SparkSession, paths: Sequence[str] | str, pattern: str = "data_*", within: str | None = None
) -> DataFrame:
    """Lines of all matching files below ``paths``, with the file they come from and their place ``at`` in it.

    Files whose whole path doesn't hold the expression ``within`` are not opened.
    """
    place = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    with listing(spark):
        found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(paths)
    if within is not None:
        found = found.filter(F.col("_metadata.file_path").rlike(within))
    return found.select(
        logical_path(F.col("_metadata.file_path")).alias("path"),
        "value",
        F.struct(*[c.alias(n) for c, n in zip(place, ("part", "block", "line"), strict=True)]).alias("at"),
    )


def file_layouts(lines: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per file: ``path, n_rows, sep, year_first, reject``.

    The lines of a file's first block vote for its separator, by having seven fields, and then for the order of its
    dates; ties go to the semicolon and to the year. One aggregate over the path, combined before the shuffle, so a file
    with a third of all lines is no burden. ``reject`` is ``header`` for a file whose first field is no row index, ``short``
    for one of ``min_rows`` rows or fewer, else null.
    """
    first = F.col("at.block") == 0
    # Each step is a projection of its own: named in the aggregate, a line would be split and its time read once for each mention.
    split = lines.withColumns({f"_v{k}": F.split("value", sep) for k, sep in enumerate(SEPARATORS)})
    full = [F.when(first & (F.size(f"_v{k}") >= FIELDS), F.trim(F.get(f"_v{k}", F.lit(1)))) for k in range(len(SEPARATORS))]
    timed = split.withColumns({f"_t{k}": full[k] for k in range(len(SEPARATORS))})
    timed = timed.withColumns({f"_t{k}": normalise_time_text(F.col(f"_t{k}")) for k in range(len(SEPARATORS))})
    votes = []
    for k in range(len(SEPARATORS)):
        time = F.col(f"_t{k}")
        votes += [F.count(time).alias(f"n{k}"), F.count_if(time.rlike(YEAR_FIRST)).alias(f"y{k}"), F.count_if(time.rlike(DAY_FIRST)).alias(f"d{k}")]
    counted = timed.groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"), F.min_by("value", "at").alias("_first"), *votes)
    most = F.greatest(*[F.col(f"n{k}") for k in range(len(SEPARATORS))])
    sep, year = F.lit(SEPARATORS[0]), F.col("y0") >= F.col("d0")
    for k in reversed(range(len(SEPARATORS))):
        sep = F.when(F.col(f"n{k}") == most, F.lit(SEPARATORS[k])).otherwise(sep)
        year = F.when(F.col(f"n{k}") == most, F.col(f"y{k}") >= F.col(f"d{k}")).otherwise(year)
    laid = counted.select("path", "n_rows", sep.alias("sep"), year.alias("year_first"), "_first")
    index = F.get(F.split("_first", F.col("sep")), F.lit(0)).try_cast("long")
    reject = F.when(F.col("n_rows") <= min_rows, "short").when(index.isNull(), "header")
    return laid.select("path", "n_rows", "sep", "year_first", reject.alias("reject"))


def parse_by_layout(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    """Every line of the files that are not rejected, parsed as its file is laid out, with the ``reason`` if it is no reading.

    ``fields``: fewer than seven; ``time``: the time doesn't fit the file's layout or no calendar. Times are UTC without zone.
    """
    good = layouts.filter("reject IS NULL").select("path", "sep", "year_first")
    v = lines.select("path", "value").join(good, "path").withColumn("_v", F.split("value", F.col("sep")))
    field = [F.get("_v", F.lit(i)) for i in range(FIELDS)]
    # Each step is a projection of its own, so that the field is cut, put in order and read once a line.
    v = v.withColumn("_time", F.trim(field[1])).withColumn("V2", normalise_time_text(F.col("_time")))
    text = F.col("V2")
    iso = F.when(F.col("year_first") & text.rlike(YEAR_FIRST), F.regexp_replace(text, YEAR_FIRST, "$1-$2-$3 $4")).when(
        ~F.col("year_first") & text.rlike(DAY_FIRST), F.regexp_replace(text, DAY_FIRST, "$3-$2-$1 $4")
    )
    parsed = v.select(
        "path",
        "value",
        field[0].try_cast("long").alias("row"),
        "V2",
        logger_id_from_path(F.col("path")).alias("tomst_id"),
        iso.try_cast("timestamp_ntz").alias("datetime"),
        field[2].try_cast("int").alias("zone"),
        *[parse_decimal_comma(field[3 + k]).alias(f"T{k + 1}") for k in range(3)],
        field[6].try_cast("double").alias("moist"),
        (F.size("_v") < FIELDS).alias("_short"),
    )
    reason = F.when(F.col("_short"), "fields").when(F.col("datetime").isNull(), "time")
    return parsed.withColumn("reason", reason).drop("_short")


def readings_and_rejects(lines: DataFrame, min_rows: int = MIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """Readings of logger files, and what was left out: ``path, row, reason, n_rows``.

    A file is rejected whole with one row (``row`` null), a line by itself. Of repeated times in a file the row of the
    greatest index stays. Lines, layouts and parsed lines are staged, so the files are opened once and a line is parsed once;
    readings and rejects read the parsed lines. A filter on the parsed lines would else be pushed down to the raw ones, and
    there name the split of a line a dozen times.
    """
    lines = stage(lines)
    layouts = stage(file_layouts(lines, min_rows))
    parsed = stage(parse_by_layout(lines, layouts).drop("value"))
    good = parsed.filter("reason IS NULL")
    readings = keep_last(good, ["path", "V2"], [F.col("row")]).select(
        "path", "row", "tomst_id", "datetime", "zone", "T1", "T2", "T3", "moist"
    )
    files = layouts.filter("reject IS NOT NULL").select("path", F.lit(None).cast("long").alias("row"), F.col("reject").alias("reason"), "n_rows")
    rows = parsed.filter("reason IS NOT NULL").select("path", "row", "reason", F.lit(1).cast("long").alias("n_rows"))
    return readings, files.unionByName(rows)


def local_time(readings: DataFrame, zone: str = LOCAL_ZONE, time: str = "datetime") -> DataFrame:
    """UTC clock times, as files have them, as clock times of a zone; winter time all year by default."""
    return readings.withColumn(time, F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(time)))


def list_files(spark: SparkSession, paths: Sequence[str] | str, pattern: str = "*") -> DataFrame:
    """The manifest of a folder tree: ``path, bytes, modified`` per file, without reading any content.

    Spark lists the folders as tasks; parts of one file that Spark wrote count as one.
    """
    with listing(spark):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(paths)
    parts = found.select(logical_path(F.col("path")).alias("path"), "length", "modificationTime")
    return parts.groupBy("path").agg(F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified"))


def split_logger_lines(lines: DataFrame) -> DataFrame:
    """Columns V1..V7 of each line. The separator is the semicolon, or the tab, or the comma.

    A line with semicolons or tabs may hold decimal commas, so those separators go first.
    """
    sep = (
        F.when(F.contains(F.col("value"), F.lit(";")), F.split("value", ";"))
        .when(F.contains(F.col("value"), F.lit("\t")), F.split("value", "\t"))
        .otherwise(F.split("value", ","))
    )
    return lines.withColumn("_v", sep).select(
        "path", *[F.get("_v", F.lit(i)).alias(f"V{i + 1}") for i in range(7)]
    )


def reject_short_files(rows: DataFrame, min_rows: int = MIN_ROWS, path: str = "path") -> DataFrame:
    """Rows of files with more than ``min_rows`` rows."""
    long = rows.groupBy(path).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_rows)
    return rows.join(long.select(path), path, "left_semi").select(*rows.columns)


def dedup_in_file(rows: DataFrame) -> DataFrame:
    """Last row of each repeated time text of a file; V1 is the row index."""
    return keep_last(rows, ["path", "V2"], [F.col("V1").try_cast("long")])


def typed_rows(rows: DataFrame, ntz: bool = False) -> DataFrame:
    """File, row index and time text, with the values as numbers and the time parsed."""
    return rows.select(
        "path",
        "V1",
        "V2",
        logger_id_from_path(F.col("path")).alias("tomst_id"),
        parse_logger_time(F.col("V2"), ntz).alias("datetime"),
        F.col("V3").try_cast("int").alias("zone"),
        parse_decimal_comma(F.col("V4")).alias("T1"),
        parse_decimal_comma(F.col("V5")).alias("T2"),
        parse_decimal_comma(F.col("V6")).alias("T3"),
        F.col("V7").try_cast("double").alias("moist"),
    )


def bad_rows(rows: DataFrame) -> DataFrame:
    """Rows of an unknown layout: their time text does not parse."""
    return rows.filter(parse_logger_time(F.col("V2")).isNull())


def readings_from_rows(rows: DataFrame, ntz: bool = False, origin: bool = False) -> DataFrame:
    """Short files out, text to values, repeated times of a file out; with ``origin`` the file and row stay as ``path, row``.

    Rows whose time does not parse are left out (see :func:`bad_rows`). Values are parsed before the
    repeats go, so that filter is not pushed down as one huge expression over the raw line.
    """
    rows = reject_short_files(rows.withColumn("V2", normalise_time_text(F.col("V2"))))
    readings = dedup_in_file(typed_rows(rows, ntz)).filter("datetime is not null")
    if origin:
        return readings.withColumn("row", F.col("V1").try_cast("long")).drop("V1", "V2")
    return readings.drop("path", "V1", "V2")


def scan_logger_files(
    spark: SparkSession, paths: Sequence[str] | str, pattern: str = "data_*", origin: bool = False
) -> DataFrame:
    """All readings of a folder tree in one job, with ``path`` and ``row`` if ``origin``. Times are UTC in the files.

    The session zone must be UTC while the text is parsed, so times are read as UTC instants here
    whatever zone the session shows.
    """
    readings = readings_from_rows(split_logger_lines(read_logger_lines(spark, paths, pattern)), ntz=True, origin=origin)
    zone = spark.conf.get("spark.sql.session.timeZone")
    return readings.withColumn(
        "datetime", F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("datetime")).cast("timestamp")
    )
