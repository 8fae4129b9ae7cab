"""Reports over a table of file paths (stage 01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.functions.scalars import logger_id_from_path, pad_site_code, parent_folder


def manifest_parse(manifest: DataFrame, path: str = "path") -> DataFrame:
    """Data files with the site their folder names and the logger their name holds."""
    return manifest.filter(F.element_at(F.split(path, "/"), -1).startswith("data_")).select(
        F.col(path).alias("file"),
        F.upper(parent_folder(F.col(path))).alias("site1"),
        logger_id_from_path(F.col(path)).alias("tomst_id"),
    )


def orphan_sidecars(manifest: DataFrame, path: str = "path") -> DataFrame:
    """Binary and command files without the data file of the same name."""
    name = F.element_at(F.split(path, "/"), -1)
    sidecars = manifest.filter(name.startswith("binary_") | name.startswith("command_")).select(
        F.col(path).alias("file"),
        F.regexp_replace(F.col(path), r"(binary|command)_([^/]*)$", "data_$2").alias("_data"),
    )
    data = manifest.filter(name.startswith("data_")).select(F.col(path).alias("_data"))
    return sidecars.join(data, "_data", "left_anti").select("file")


def unknown_loggers(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose logger the registry does not know."""
    return files.join(registry.select("tomst_id"), "tomst_id", "left_anti").select("file", "tomst_id")


def reconcile(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Full join of files and registry on the logger, with where each row is missing."""
    known = registry.select("tomst_id", "site").distinct()
    return files.join(known, "tomst_id", "full_outer").select(
        "tomst_id",
        "file",
        "site1",
        "site",
        F.when(F.col("file").isNull(), "no_file").when(F.col("site").isNull(), "not_registered").otherwise("both").alias("status"),
    )


def site_conflicts(reconciled: DataFrame, folder: str = "site1", registered: str = "site") -> DataFrame:
    """Rows where folder and registry name different sites."""
    return reconciled.filter((F.col(folder) != F.col(registered)) & F.col(registered).isNotNull())


def duplicate_logger_files(files: DataFrame) -> DataFrame:
    """All files of loggers that have several."""
    doubled = files.groupBy("tomst_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return files.join(doubled.select("tomst_id"), "tomst_id", "left_semi").select("file", "tomst_id")


def site_fallback(files: DataFrame, registry: DataFrame, area: str) -> DataFrame:
    """Site from the folder, or from the registry where the folder is an 8-character logger id."""
    known = registry.select("tomst_id", F.col("site").alias("site2")).distinct()
    folder = F.when(F.length("site1") != 8, F.col("site1"))
    return (
        files.withColumn("site1", folder)
        .join(known, "tomst_id", "full_outer")
        .select(
            "file", "tomst_id", pad_site_code(F.coalesce("site1", "site2"), area).alias("site1"), "site2"
        )
    )


def site_map(files: DataFrame) -> DataFrame:
    """Distinct (site, logger) pairs of the manifest."""
    return files.select(F.col("site1").alias("site"), "tomst_id").distinct()


def map_uniqueness(pairs: DataFrame) -> DataFrame:
    """One row: numbers of rows, sites and loggers, and whether each side is unique."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("site").alias("n_sites"),
        F.count_distinct("tomst_id").alias("n_loggers"),
    ).withColumns(
        {"sites_unique": F.expr("n_sites = n_rows"), "loggers_unique": F.expr("n_loggers = n_rows")}
    )


def initial_site_codes(files: DataFrame, area: str) -> DataFrame:
    """Padded site codes with their loggers."""
    return files.select(pad_site_code(F.col("site1"), area).alias("site"), "tomst_id").distinct()
