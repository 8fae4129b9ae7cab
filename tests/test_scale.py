"""What a step costs by its plan: windows run once, rows shuffled once, files opened once, parts that follow the rows."""

import os

from pyspark.sql import functions as F

from frostline.config import PEAK_RULES
from frostline.operators import gaps, peaks
from frostline.plans import standins
from frostline.session import settings, stage, stage_folder
from frostline.sources import logger_files


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(spark, n=40):
    t = F.timestamp_add("MINUTE", F.col("id") * 15, F.lit("2024-01-01").cast("timestamp_ntz"))
    values = [(F.col("id") % k).cast("double").alias(s) for s, k in (("T1", 3), ("T2", 5), ("T3", 7), ("moist", 11))]
    return spark.range(n).select(F.lit("S1").alias("site"), F.lit(1).cast("long").alias("tomst_id"), t.alias("datetime"), *values, F.lit(0).alias("error_tomst"))


def test_peak_rules_share_their_windows(spark):
    """each rule named its windows anew, and Spark ran every mention."""
    one = plan_of(peaks.flag_peaks(rows(spark))).count("windowspecdefinition(")
    cases = [(F.col("tomst_id") == 1, PEAK_RULES), (F.col("tomst_id") == 2, PEAK_RULES)]
    three = plan_of(peaks.flag_peaks(rows(spark), cases=cases)).count("windowspecdefinition(")
    assert three == one < 60


def test_gap_fill_copies_no_rows(spark):
    """borders pass one value per chunk, so rows are not collected, joined back and sorted again."""
    plan = plan_of(gaps.fill_gaps_site(rows(spark)))
    assert "collect_list" not in plan and plan.count("\n") < 60


def test_gap_fill_over_borders(spark):
    day = F.to_date("datetime")
    df = rows(spark, 400).filter("minute(datetime) = 0 AND hour(datetime) IN (0, 3, 23)")
    got = {tuple(r) for r in gaps.fill_gaps_site(df, chunk=F.datediff(day, F.lit("2024-01-01"))).collect()}
    assert got == {tuple(r) for r in gaps.fill_gaps_site(df, chunk=F.lit(0)).collect()}
    assert len(got) > df.count()


def test_staged_parts_follow_the_rows(spark):
    """a session of four shuffle parts had four tasks for any number of rows."""
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    staged = stage(spark.range(6_000_000).repartition("id"))
    assert len(staged.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_settings_come_back(spark):
    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    try:
        with settings(spark, {key: 77}):
            assert spark.conf.get(key) == "77"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(key) == was


def test_files_are_opened_once(spark, tmp_path):
    """layouts, readings and rejects each opened all files, and sidecars with them."""
    for k in range(40):
        os.makedirs(tmp_path / f"f{k}")
        (tmp_path / f"f{k}" / f"data_{k}_0.csv").write_text("".join(f"{i};2024.01.{1 + i // 24:02d} {i % 24:02d}:00;4;1,5;2;3;400\n" for i in range(120)))
        (tmp_path / f"f{k}" / f"command_{k}_0.csv").write_text("x\n")
    lines = logger_files.read_logger_lines(spark, str(tmp_path), "*.csv", r"/data_[^/]*$")
    assert {r["path"].rsplit("/", 1)[-1][:5] for r in lines.select("path").distinct().collect()} == {"data_"}
    readings, rejects = logger_files.readings_and_rejects(lines)
    assert all(stage_folder(spark) in f for f in [*readings.inputFiles(), *rejects.inputFiles()])
    assert readings.count() == 40 * 120 and rejects.count() == 0


def test_lines_are_parsed_once(spark, tmp_path):
    """Readings and rejects parsed all lines each, and a pushed-down filter split a line a dozen times."""
    (tmp_path / "data_1_0.csv").write_text("".join(f"{i};2024.01.{1 + i // 24:02d} {i % 24:02d}:00;4;1,5;2;3;400\n" for i in range(120)) + "120;rubbish\n")
    lines = logger_files.read_logger_lines(spark, str(tmp_path))
    assert plan_of(logger_files.file_layouts(lines)).count("split(value") == len(logger_files.SEPARATORS)
    readings, rejects = logger_files.readings_and_rejects(lines)
    assert not any("split(" in plan_of(df) or "RLIKE" in plan_of(df) for df in (readings, rejects))
    assert readings.count() == 120 and [r.reason for r in rejects.collect()] == ["fields"]


def test_tree_writers_follow_the_files(spark, tmp_path):
    """A file costs more than its bytes, and the session's shuffle parts (four here) bounded the tasks that create them."""
    events = spark.range(60_000).select(
        F.col("id").alias("event_id"),
        (F.col("id") % 3000).alias("user_id"),
        F.timestamp_add("MINUTE", F.col("id"), F.lit("2024-01-01").cast("timestamp")).alias("ts"),
        F.rand(1).alias("value"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    root = standins.written_logger_files(spark, str(tmp_path))
    parts = {f.rsplit("part-", 1)[1][:5] for f in spark.read.option("recursiveFileLookup", "true").text(root).inputFiles()}
    assert len(parts) > int(spark.conf.get("spark.sql.shuffle.partitions"))
