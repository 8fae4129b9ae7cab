"""Tables of one area published together, as whole versions.

A version is written aside, counted again from what was written, and then named by a small file; readers follow the
newest such file, so they see all tables of a version or none. A failed or lost writer leaves files that no version
names. Everything goes through Spark's writers and the Hadoop file system of the path.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class IncompleteWrite(RuntimeError):
    """What was written is not what was meant to be written; no version names it."""


def _folder(root: str, area: str) -> str:
    return f"{root.rstrip('/')}/_versions/area={area}"


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, root: str, area: str) -> list[int]:
    """Numbers of the area's versions, oldest first."""
    system, folder = _system(spark, _folder(root, area))
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _named(spark: SparkSession, root: str, area: str, version: int) -> dict:
    text = spark.read.option("wholetext", "true").text(f"{_folder(root, area)}/{version:08d}.json").first()["value"]
    return json.loads(text)


def _name(spark: SparkSession, root: str, area: str, version: int, content: dict) -> None:
    """Create the version file: written under another name, then renamed, which fails if the number is taken."""
    folder = _folder(root, area)
    system, draft = _system(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.writeBytes(json.dumps(content))
    out.close()
    _, final = _system(spark, f"{folder}/{version:08d}.json")
    if system.exists(final) or not system.rename(draft, final):
        system.delete(draft, False)
        raise IncompleteWrite(f"version {version} of {area} was published by another writer")


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, area: str) -> int:
    """Write all tables as the area's next version and return its number.

    The rows of each table are counted while they are written and again from the files; if they differ nothing is
    published. Old versions stay until :func:`vacuum`.
    """
    version = max(versions(spark, root, area), default=0) + 1
    run = uuid.uuid4().hex
    written = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}/area={area}/run={run}"
        seen = Observation(f"{name}-{run}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        meant, found = seen.get["n"], spark.read.schema(df.schema).parquet(path).count()
        if meant != found:
            raise IncompleteWrite(f"{name}: {meant} rows went in, {found} are there")
        written[name] = {"path": path, "rows": found, "schema": df.schema.json()}
    _name(spark, root, area, version, written)
    return version


def read_published(spark: SparkSession, root: str, area: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the area's newest version, or of an older one."""
    known = versions(spark, root, area)
    if not known or version is not None and version not in known:
        raise ValueError(f"no such version of {area}: {version}; there are {known}")
    from pyspark.sql.types import StructType

    entry = _named(spark, root, area, known[-1] if version is None else version)[name]
    return spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(entry["path"])


def vacuum(spark: SparkSession, root: str, area: str, keep: int = 1) -> int:
    """Remove all but the newest ``keep`` versions and what failed writers left; returns the number of folders removed.

    Not to be run beside a writer of the same area.
    """
    known = versions(spark, root, area)
    for version in known[: len(known) - keep]:
        system, path = _system(spark, f"{_folder(root, area)}/{version:08d}.json")
        system.delete(path, False)
    live = {e["path"].rsplit("/", 1)[-1] for v in known[len(known) - keep :] for e in _named(spark, root, area, v).values()}
    gone = 0
    system, top = _system(spark, root)
    for table in system.listStatus(top):
        if table.getPath().getName() == "_versions":
            continue
        _, mine = _system(spark, f"{table.getPath()}/area={area}")
        for run in system.listStatus(mine) if system.exists(mine) else ():
            if run.getPath().getName() not in live:
                gone += bool(system.delete(run.getPath(), True))
    return gone
