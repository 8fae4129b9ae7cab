"""Sensor tables derived from the general test tables.

Temperatures are built from halves, quarters and so on, so their sums are exact in any order and
thresholds are met or missed alike in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.operators.dedup import keep_first
from frostline.session import new_stage_path, settings, stage_settings

# Creating a logger file costs far more than its bytes, so tasks that write them get less than other stages.
TREE_PART_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slot(ts: Column, minutes: int) -> Column:
    """``ts`` floored to a block of minutes within its hour."""
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    step = (F.floor(F.minute(ts) / minutes) * minutes).cast("long")
    return F.timestamp_add("MINUTE", step, hour)


def readings_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of readings at three sites, with flags; moisture is null where T1 < 1."""
    q, line = F.col("l_quantity") - 25, F.col("l_linenumber") - 4
    season = F.abs(F.dayofyear("l_shipdate") - 200)
    t1 = 10 - season / 16 + q / 32 + line / 8
    t2 = 12 - season / 8 + q / 16 + line / 4
    t3 = 15 - season / 8 + q / 4 + line / 2
    moist = F.when(t1 >= 1, F.col("l_extendedprice") / 50)
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        F.col("l_suppkey").alias("tomst_id"),
        F.timestamp_add("HOUR", (n * 3).cast("long"), F.col("l_shipdate")).alias("datetime"),
        t1.alias("T1"),
        t2.alias("T2"),
        t3.alias("T3"),
        moist.alias("moist"),
        (n == 7).alias("T1_imp"),
        (n >= 6).alias("T2_imp"),
        (n == 1).alias("T3_imp"),
        F.when(moist.isNotNull(), n == 7).alias("moist_imp"),
    )


def _sensors(v: Column) -> list[Column]:
    return [
        (v / 8 - 5).alias("T1"),
        (v / 4 - 20).alias("T2"),
        (v / 4 - 10).alias("T3"),
        (v * 20 + 150).alias("moist"),
    ]


def _code() -> Column:
    return F.when(F.col("event_type") == "error", F.col("event_id") % 11).otherwise(0).cast("int")


def fifth(user: str = "user_id") -> Column:
    """One series per five users, so their number grows with the events and few events share a slot."""
    return F.floor(F.col(user) / 5).cast("long")


def site_of(user: str = "user_id") -> Column:
    return F.concat(F.lit("S"), fifth(user).cast("string"))


def readings_hf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute readings of one site per five users, the first event of each slot."""
    e = table(spark, sf_dir, "events").select(
        site_of().alias("site"), slot(F.col("ts"), 15).alias("datetime"), "ts", "event_id", "user_id", "event_type", "value"
    )
    first = keep_first(e, ["site", "datetime"], [F.col("ts"), F.col("event_id")])
    return first.select(
        "site", F.col("user_id").alias("tomst_id"), "datetime", *_sensors(F.col("value")), _code().alias("error_tomst")
    )


def readings_logger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute readings of one logger per five users, with an error code."""
    e = table(spark, sf_dir, "events").select(
        fifth().alias("tomst_id"), slot(F.col("ts"), 5).alias("datetime"), "ts", "event_id", "event_type", "value"
    )
    first = keep_first(e, ["tomst_id", "datetime"], [F.col("ts"), F.col("event_id")])
    return first.select(
        site_of("tomst_id").alias("site"), "tomst_id", "datetime", *_sensors(F.col("value")), _code().alias("probl")
    )


def readings_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of every user at the second they were taken; series grow in number with the events."""
    e = table(spark, sf_dir, "events").select("user_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("datetime"), "value")
    return e.groupBy("user_id", "datetime").agg(F.max("value").alias("value"))


def readings_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute means of five sites, one per event type."""
    e = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("site"), slot(F.col("ts"), 15).alias("datetime"), "value"
    )
    mean = e.groupBy("site", "datetime").agg(F.round(F.avg("value"), 4).alias("v"))
    return mean.select("site", "datetime", *_sensors(F.col("v")))


def readings_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute readings of loggers that lie on a shelf every other day."""
    e = table(spark, sf_dir, "events").select(
        fifth().alias("tomst_id"), slot(F.col("ts"), 5).alias("datetime"), "event_id"
    )
    first = keep_first(e, ["tomst_id", "datetime"], [F.col("event_id")])
    i = F.col("event_id")
    return first.select(
        site_of("tomst_id").alias("site"),
        "tomst_id",
        "datetime",
        (5 + (i % 5) / 16).alias("T1"),
        (5.25 + (i % 7) / 16).cast("double").alias("T2"),
        (5 + (i % 3) / 32 + F.when(i % 17 == 0, 1.0).otherwise(0.0)).alias("T3"),
        (F.lit(500.0) + i % 13).alias("moist"),
        F.when(F.dayofmonth("datetime") % 2 == 0, 2).otherwise(0).alias("probl"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of one to three days with a code, one per error event; they may overlap."""
    day = F.to_date("ts")
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'error'")
        .select(
            site_of().alias("site"),
            F.col("user_id").alias("tomst_id"),
            day.alias("start_date"),
            F.date_add(day, (F.col("event_id") % 3).cast("int")).alias("end_date"),
            (F.col("event_id") % 11).cast("int").alias("probl"),
        )
        .distinct()
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading times of loggers, one per signup event."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'signup'")
        .select(site_of().alias("site"), F.col("user_id").alias("tomst_id"), slot(F.col("ts"), 15).alias("maxdt"))
        .distinct()
    )


def bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets for three quarters of the loggers, some without T2."""
    u = F.col("user_id")
    users = table(spark, sf_dir, "events").select("user_id").distinct().filter(u % 4 != 0)
    return users.select(
        u.alias("tomst_id"),
        ((u % 7 - 3) / 16).alias("T1"),
        F.when(u % 5 != 0, (u % 3 - 1) / 8).alias("T2"),
        ((u % 11 - 5) / 32).alias("T3"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File paths: data files with binary and command sidecars, some folders named by logger."""
    d = F.col("doc_id")
    group = F.floor(d / 5).cast("long")
    folder = F.when(group % 9 == 0, (94000000 + group).cast("string")).otherwise(
        F.concat(F.lit("s"), (group % 40).cast("string"))
    )
    kind = F.when(d % 5 == 0, "binary").when(d % 5 == 1, "command").otherwise("data")
    copy = F.when(d % 5 >= 3, d % 5 - 2).otherwise(0)
    path = F.concat(
        F.lit("/in/"), folder, F.lit("/"), kind, F.lit("_"), (94000000 + group).cast("string"), F.lit("_"), copy.cast("string"), F.lit(".csv")
    )
    return (
        table(spark, sf_dir, "documents")
        .filter((d % 5 < 2) | (F.col("n_chars") % 2 == 0))
        .select(path.alias("path"))
    )


def manifest_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows for the manifest's loggers; every seventh sits elsewhere."""
    d = F.col("doc_id")
    group = F.floor(d / 5).cast("long")
    number = F.when(group % 7 == 0, group % 40 + 1).otherwise(group % 40)
    return (
        table(spark, sf_dir, "documents")
        .filter((d % 5 == 3) & (d % 11 != 0))
        .select(
            F.concat(F.lit("S"), number.cast("string")).alias("site"),
            (94000000 + group).alias("tomst_id"),
            F.timestamp_add("MINUTE", (F.col("n_chars") * 15).cast("long"), F.lit("2023-01-01").cast("timestamp_ntz")).alias("maxdt"),
        )
    )


def logger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of logger files as text: four time layouts, decimal commas, repeated times."""
    u = F.col("user_id")
    logger = F.when(u % 3 == 0, u).otherwise(1000 + u % 5)
    at = slot(F.col("ts"), 15)
    layout = logger % 4
    midnight = F.date_format(at, "HH:mm") == "00:00"
    text = (
        F.when(midnight & (layout == 0), F.date_format(at, "yyyy.MM.dd"))
        .when(layout == 0, F.date_format(at, "yyyy.MM.dd HH:mm:ss"))
        .when(layout == 1, F.date_format(at, "dd.MM.yyyy HH:mm:ss"))
        .when(layout == 2, F.date_format(at, "yyyy/MM/dd HH:mm"))
        .otherwise(F.date_format(at, "dd/MM/yyyy HH:mm"))
    )
    number = F.regexp_replace(F.col("value").cast("string"), r"\.", ",")
    value = F.concat_ws(
        ";",
        F.col("event_id").cast("string"),
        text,
        F.lit("4"),
        number,
        number,
        number,
        (F.col("event_id") % 4000).cast("string"),
        F.lit(""),
    )
    path = F.concat(F.lit("/in/L"), (logger % 10).cast("string"), F.lit("/data_"), (94000000 + logger).cast("string"), F.lit("_0.csv"))
    return table(spark, sf_dir, "events").select("event_id", path.alias("path"), value.alias("value"))


def logger_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of logger files by folder and file: one file per five users, and per user of every fiftieth.

    Date order, seconds and separator differ between files; some lines have another layout or too few fields, and some
    files begin with a header.
    """
    u, e = F.col("user_id"), F.col("event_id")
    alone = u % 50 == 7
    n = F.floor(u / 5).cast("long")
    at = slot(F.col("ts"), 15)
    order = n % 4
    text = (
        F.when(e % 97 == 0, F.date_format(at, "yyyy-MM-dd HH:mm"))
        .when((F.date_format(at, "HH:mm") == "00:00") & (order == 0), F.date_format(at, "yyyy.MM.dd"))
        .when(order == 0, F.date_format(at, "yyyy.MM.dd HH:mm:ss"))
        .when(order == 1, F.date_format(at, "dd.MM.yyyy HH:mm:ss"))
        .when(order == 2, F.date_format(at, "yyyy/MM/dd HH:mm"))
        .otherwise(F.date_format(at, "dd/MM/yyyy HH:mm"))
    )
    number = F.col("value").cast("string")
    number = F.when(n % 3 == 2, number).otherwise(F.translate(number, ".", ","))
    whole = F.array(e.cast("string"), text, F.lit("4"), number, number, number, (e % 4000).cast("string"))
    fields = F.when(e % 101 == 1, F.slice(whole, 1, 3)).otherwise(whole)
    logger = F.when(alone, 95000000 + u).otherwise(94000000 + n).cast("string")
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), (n % 10).cast("string")).alias("folder"),
        F.concat(F.lit("data_"), logger, F.lit("_0.csv")).alias("file"),
        e.alias("event_id"),
        F.when(n % 3 == 0, F.array_join(fields, ";")).when(n % 3 == 1, F.array_join(fields, "\t")).otherwise(F.array_join(fields, ",")).alias("value"),
        (~alone & (n % 7 == 6)).alias("_header"),
    )
    heads = rows.filter("_header").select("folder", "file").distinct()
    heads = heads.select("folder", "file", F.lit(-1).cast("long").alias("event_id"), F.lit("index;time;zone;a;b;c;moist").alias("value"))
    return rows.drop("_header").unionByName(heads)


def written_logger_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder tree with the files of :func:`logger_file_lines` and sidecars of some, written in the stage folder.

    Tasks are dealt out by little data each, so their number follows that of the files and all cores write to the end.
    """
    lines = logger_file_lines(spark, sf_dir)
    names = lines.select("folder", "file").distinct()
    number = F.regexp_extract("file", r"_(\d+)_", 1).cast("long")
    sidecars = names.select(
        "folder",
        F.inline(
            F.array(
                F.struct(F.regexp_replace("file", "data_", "binary_").alias("file"), (number % 2 == 0).alias("_has")),
                F.struct(F.regexp_replace("file", "data_", "command_").alias("file"), (number % 3 == 0).alias("_has")),
                F.struct(F.regexp_replace("file", r"data_(\d+)_0", "command_$1_9").alias("file"), (number % 5 == 0).alias("_has")),
            )
        ),
    )
    sidecars = sidecars.filter("_has").select("folder", "file", F.lit(0).cast("long").alias("event_id"), F.lit("x").alias("value"))
    root = new_stage_path(spark)
    parts = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    with settings(spark, stage_settings(spark) | dict.fromkeys(parts, TREE_PART_BYTES)):
        ordered = lines.unionByName(sidecars).repartition("file").sortWithinPartitions("folder", "file", "event_id")
        ordered.select("folder", "file", "value").write.partitionBy("folder", "file").text(root)
    return root


def file_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of most loggers of the written files; some rows have no reading time."""
    n = fifth()
    last = F.timestamp_add("HOUR", n, F.lit("2023-06-01").cast("timestamp_ntz"))
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("S"), (n % 7).cast("string")).alias("site"), (94000000 + n).alias("tomst_id"), F.when(n % 5 != 2, last).alias("maxdt"), n.alias("n")
    )
    return rows.filter("n % 11 <> 3").drop("n").distinct()


def file_ledger(spark: SparkSession, sf_dir: str, new: bool) -> DataFrame:
    """Intervals with a code for loggers of the written files: the old half, or the new one."""
    n, e, day = fifth(), F.col("event_id"), F.to_date("ts")
    rows = table(spark, sf_dir, "events").filter((F.col("event_type") == "error") & (e % 2 == int(new)) & (e % 16 < 2))
    return rows.select(
        F.concat(F.lit("S"), (n % 7).cast("string")).alias("site"),
        (94000000 + n).alias("tomst_id"),
        day.alias("start_date"),
        F.date_add(day, (e % 3).cast("int")).alias("end_date"),
        (e % 11).cast("int").alias("probl"),
    ).distinct()


def file_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of half the loggers of the written files, some without T2."""
    n = fifth()
    rows = table(spark, sf_dir, "events").filter(n % 2 == 0)
    return rows.select(
        (94000000 + n).alias("tomst_id"), ((n % 7 - 3) / 16).alias("T1"), F.when(n % 3 != 0, (n % 3 - 1) / 8).alias("T2"), ((n % 5 - 2) / 32).alias("T3")
    ).distinct()


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of the sites, every tenth missing."""
    s = site_of()
    n = fifth()
    return (
        table(spark, sf_dir, "events")
        .filter(n % 10 != 9)
        .select(s.alias("site"), F.lit("A").alias("area"), (60 + n % 40 / 8).alias("Lat"), (20 + n % 40 / 4).alias("Lon"))
        .distinct()
    )
