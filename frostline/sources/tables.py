"""Stage tables and small CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.functions.nulls import no_nan

ZONED = r"(Z|[+-]\d{2}:?\d{2})$"

SCHEMAS = {
    "registry": "site string, tomst_id long, maxdt timestamp",
    "ledger": "site string, tomst_id long, start_date date, end_date date, probl int",
    "legacy_ledger": "site string, tomst_id long, start_date date, end_date date, probl int",
    "site_map": "site string, tomst_id long",
    "bias": "tomst_id long, T1 double, T2 double, T3 double",
    "coordinates": "site string, area string, Lat double, Lon double",
    "raw": "site string, tomst_id long, datetime timestamp, T1 double, T2 double, T3 double, moist double, error_tomst int",
    "imputed": (
        "site string, datetime timestamp, T1 double, T2 double, T3 double, moist double, "
        "T1_imp boolean, T2_imp boolean, T3_imp boolean, moist_imp boolean"
    ),
}


def read_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """CSV with a header; columns are matched by name, so their order may vary.

    Times are UTC, or in the zone their text ends with. NaN and infinities are null.
    """
    fields = [f.strip().split() for f in SCHEMAS[kind].split(",")]
    session_zone = spark.conf.get("spark.sql.session.timeZone")
    raw = spark.read.option("header", "true").option("nullValue", "NA").csv(path)

    def typed(name: str, kind: str):
        c = F.col(name)
        if kind == "timestamp":
            utc = F.convert_timezone(F.lit("UTC"), F.lit(session_zone), c.try_cast("timestamp_ntz")).cast("timestamp")
            return F.when(c.rlike(ZONED), c.try_cast("timestamp")).otherwise(utc).alias(name)
        return (no_nan(c.try_cast(kind)) if kind == "double" else c.try_cast(kind)).alias(name)

    return raw.select(*[typed(n, k) for n, k in fields])


def read_stage(spark: SparkSession, path: str, area: str | None = None) -> DataFrame:
    """Stage table as parquet, one area at a time if asked."""
    df = spark.read.parquet(path)
    return df.filter(F.col("area") == area) if area else df


def write_stage(df: DataFrame, path: str, area: str, mode: str = "overwrite") -> None:
    """Replace the area's partition of a stage table."""
    (
        df.withColumn("area", F.lit(area))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("area")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, as a folder of part files; nulls are empty."""
    df.write.mode("overwrite").option("header", "true").csv(path)
