"""Versions of an area's tables: whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from frostline.plans import pipelines
from frostline.sources import published
from frostline.sources.published import IncompleteWrite, publish, read_published, vacuum, versions


@pytest.fixture
def tables(spark):
    return {"raw": spark.range(5).withColumn("area", F.lit("text")), "ledger": spark.range(0)}


def test_versions_follow_each_other(spark, tmp_path, tables):
    root = str(tmp_path)
    assert versions(spark, root, "MAT") == []
    assert publish(spark, tables, root, "MAT") == 1
    assert publish(spark, {"raw": spark.range(7)}, root, "EVO") == 1
    assert publish(spark, {**tables, "raw": spark.range(9)}, root, "MAT") == 2
    assert read_published(spark, root, "MAT", "raw").count() == 9 and read_published(spark, root, "EVO", "raw").count() == 7
    old = read_published(spark, root, "MAT", "raw", version=1)
    assert old.columns == ["id", "area"] and old.count() == 5
    assert read_published(spark, root, "MAT", "ledger").count() == 0
    with pytest.raises(ValueError, match="no such version"):
        read_published(spark, root, "MAT", "raw", version=3)


def test_a_failed_write_between_two_tables_shows_nothing(spark, tmp_path, tables):
    root = str(tmp_path)
    publish(spark, tables, root, "MAT")
    broken = {"raw": spark.range(99), "ledger": spark.range(3).select(F.raise_error(F.lit("lost")).cast("int").alias("x"))}
    with pytest.raises(Exception, match="lost"):
        publish(spark, broken, root, "MAT")
    assert versions(spark, root, "MAT") == [1] and read_published(spark, root, "MAT", "raw").count() == 5
    assert publish(spark, tables, root, "MAT") == 2


def test_lost_files_are_seen_before_a_version_is_named(spark, tmp_path, tables, monkeypatch):
    """Rows that went in but can't be read again: the version is not named."""
    read = published.SparkSession.read.fget

    class Lossy:
        def __init__(self, reader):
            self.reader = reader

        def schema(self, schema):
            return self if "_versions" not in str(schema) else self.reader

        def parquet(self, path):
            return read(spark).parquet(path).limit(2)

    monkeypatch.setattr(type(spark), "read", property(lambda s: Lossy(read(s))))
    with pytest.raises(IncompleteWrite, match="5 rows went in, 2 are there"):
        publish(spark, tables, str(tmp_path), "MAT")
    monkeypatch.undo()
    assert versions(spark, str(tmp_path), "MAT") == []


def test_two_writers_of_one_version(spark, tmp_path, tables):
    root = str(tmp_path)
    publish(spark, tables, root, "MAT")
    with pytest.raises(IncompleteWrite, match="another writer"):
        published._name(spark, root, "MAT", 1, {})
    assert read_published(spark, root, "MAT", "raw").count() == 5
    assert [n for n in os.listdir(f"{root}/_versions/area=MAT") if "json" in n and "crc" not in n] == ["00000001.json"]


def test_vacuum_keeps_what_versions_name(spark, tmp_path, tables):
    root = str(tmp_path)
    for k in range(3):
        publish(spark, {**tables, "raw": spark.range(k)}, root, "MAT")
    publish(spark, tables, root, "EVO")
    spark.range(4).write.parquet(f"{root}/raw/area=MAT/run=left")
    assert vacuum(spark, root, "MAT", keep=2) == 3
    assert versions(spark, root, "MAT") == [2, 3]
    assert [read_published(spark, root, "MAT", "raw", v).count() for v in (2, 3)] == [1, 2]
    assert read_published(spark, root, "EVO", "raw").count() == 5


def test_second_stage_of_areas_that_differ(spark, tmp_path):
    """Registry rows with nulls, replaced ledgers and bias rows without T2, by the area's policy."""
    times = [f"2023-05-01 {h:02d}:{m:02d}:00" for h in range(3) for m in (0, 15, 30, 45)]
    readings = spark.createDataFrame([(1, t, 1, 2.0, 3.0, 4.0, 500.0) for t in times] + [(2, times[0], 1, 1.0, 1.0, 1.0, 300.0)], "tomst_id long, t string, zone int, T1 double, T2 double, T3 double, moist double")
    readings = readings.select("tomst_id", F.col("t").cast("timestamp_ntz").alias("datetime"), "zone", "T1", "T2", "T3", "moist")
    registry = spark.createDataFrame([("A", 1, None)], "site string, tomst_id long, maxdt timestamp_ntz")
    old = spark.createDataFrame([("A", 1, "2023-05-01", "2023-05-01", 2)], "site string, tomst_id long, s string, e string, probl int")
    old = old.select("site", "tomst_id", F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date"), "probl")
    bias = spark.createDataFrame([(1, 0.5, None, 0.0), (9, 0.0, 0.0, 0.0)], "tomst_id long, T1 double, T2 double, T3 double")
    rejects = spark.createDataFrame([], "path string, row long, reason string, n_rows long")

    def run(area, new):
        out = pipelines.acquire(readings, rejects, registry, old, new, bias, area, site_map=registry.select("site", "tomst_id"))
        publish(spark, out, str(tmp_path), area)
        return {name: read_published(spark, str(tmp_path), area, name) for name in out}

    kept = run("MAT", old.limit(0))
    assert kept["raw"].count() == 0 and kept["ledger"].count() == 1 and kept["bias"].count() == 2  # the day is not in the field
    assert sorted((str(r.site), r.tomst_id, r.maxdt is None) for r in kept["registry"].collect()) == [("A", 1, False), ("A", 1, True), ("None", 2, False)]
    replaced = run("EVO", old.limit(0))
    assert replaced["ledger"].count() == 0 and replaced["raw"].count() == 12 and replaced["bias"].count() == 1
    dropped = run("PAL", old.limit(0))
    assert [(r.site, r.maxdt is None) for r in dropped["registry"].collect()] == [("A", False)]
