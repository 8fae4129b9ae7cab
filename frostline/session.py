"""Session defaults and the shared folder for staged tables and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LOCAL_ZONE = "Etc/GMT-2"

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": LOCAL_ZONE,
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime options the library relies on."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="frostline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_folder(spark: SparkSession) -> str:
    """Folder of this application's staged tables, below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages-{spark.sparkContext.applicationId}"


def new_stage_path(spark: SparkSession) -> str:
    """A path in the stage folder that nothing uses yet."""
    return f"{stage_folder(spark)}/{uuid.uuid4().hex}"


# Jobs that stage a table: shuffles start with many parts, which Spark joins to this size, so the rows of a task do not grow
# with the input; and generated methods stay below what the JVM compiles (it interprets those beyond 8,000 bytes).
STAGE_PARTS = 1000
STAGE_PART_BYTES = 8 << 20
STAGE_METHOD_BYTES = 8000


@contextmanager
def settings(spark: SparkSession, options: Mapping[str, object]) -> Iterator[None]:
    """Runtime options for a block; the session's own ones come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in options}
    for key, value in options.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stage_settings(spark: SparkSession) -> dict[str, object]:
    """Runtime options of the jobs that stage a table."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    parts, target = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    method = "spark.sql.codegen.hugeMethodLimit"
    most = max(STAGE_PARTS, int(spark.conf.get(parts, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return {
        parts: most,
        target: min(STAGE_PART_BYTES, size(spark.conf.get(target))),
        method: min(STAGE_METHOD_BYTES, int(spark.conf.get(method))),
    }


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet in the shared checkpoint folder and read it back. Runs a job.

    For tables that several branches of a plan read: later readers scan only their columns, and a
    lost executor costs no more than the tasks it ran. ``drop_stages`` removes the files.
    """
    path = new_stage_path(df.sparkSession)
    with settings(df.sparkSession, stage_settings(df.sparkSession)):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this application's stages through the Hadoop file system."""
    if not path.startswith(stage_folder(spark)):
        raise ValueError(f"not a staged folder: {path}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def unstage(df: DataFrame) -> None:
    """Delete the files of a table that ``stage`` returned, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        name = folder.rsplit("/", 1)[-1]
        remove_path(spark, f"{stage_folder(spark)}/{name}")


def drop_stages(spark: SparkSession) -> None:
    """Delete all staged tables of this application; results not yet written can't be read after it."""
    remove_path(spark, stage_folder(spark))
