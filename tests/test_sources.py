"""Readers: time zones, NaN, round trips; nulls in repeated readings."""

from datetime import datetime, timedelta

from frostline.config import SENSORS
from frostline.functions.scalars import parse_decimal_comma
from frostline.operators.dedup import keep_first, measured_first
from frostline.session import drop_stages, new_stage_path, stage, stage_folder
from frostline.sources.logger_files import file_layouts, list_files, read_logger_lines, readings_and_rejects
from frostline.sources.tables import read_csv, read_stage, write_csv, write_stage
from pyspark.sql import functions as F


def test_times_without_a_zone_are_utc(spark, tmp_path):
    (tmp_path / "r.csv").write_text("tomst_id,site,maxdt\n1,A,2023-05-01 08:00:00\n2,B,2023-05-01T08:00:00Z\n3,C,2023-05-01T10:00:00+02:00\n4,D,x\n")
    rows = read_csv(spark, str(tmp_path / "r.csv"), "registry").select("tomst_id", F.unix_timestamp("maxdt").alias("s")).collect()
    at = int((datetime(2023, 5, 1, 8) - datetime(1970, 1, 1)).total_seconds())
    assert {r.tomst_id: r.s for r in rows} == {1: at, 2: at, 3: at, 4: None}


def test_nan_is_null_in_both_readers(spark, tmp_path):
    (tmp_path / "b.csv").write_text("tomst_id,T1,T2,T3\n1,NaN,Infinity,0.5\n")
    r = read_csv(spark, str(tmp_path / "b.csv"), "bias").first()
    assert (r.T1, r.T2, r.T3) == (None, None, 0.5)
    texts = spark.createDataFrame([("NaN",), ("-Infinity",), ("1,5",)], "x string").select(parse_decimal_comma(F.col("x")).alias("v"))
    assert [r.v for r in texts.collect()] == [None, None, 1.5]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, 0.5, None, -1.0)], "site string, tomst_id long, T1 double, T2 double, T3 double").drop("site")
    write_csv(df, str(tmp_path / "csv"))
    assert read_csv(spark, str(tmp_path / "csv"), "bias").collect() == df.collect()
    for area in ("MAT", "KIL", "MAT"):
        write_stage(df, str(tmp_path / "stage"), area)
    assert read_stage(spark, str(tmp_path / "stage"), "MAT").drop("area").collect() == df.collect()
    assert read_stage(spark, str(tmp_path / "stage")).count() == 2


def test_a_measured_reading_beats_a_null(spark):
    df = spark.createDataFrame([(1, None, 1.0, None, 1.0), (1, 5.0, 2.0, None, 1.0)], "k int, " + ", ".join(f"{s} double" for s in SENSORS))
    assert keep_first(df, ["k"], measured_first(*SENSORS)).first()[1] == 5.0


def test_stages_can_be_dropped(spark):
    import os

    df = stage(spark.range(3))
    assert df.count() == 3 and new_stage_path(spark).startswith(stage_folder(spark))
    folder = stage_folder(spark).removeprefix("file:")
    assert os.listdir(folder)
    drop_stages(spark)
    assert not os.path.exists(folder)


def write_logger(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_layout_of_each_file_and_rejects(spark, tmp_path):
    """Four layouts, a header, a short file, rows that fit no layout and rows that fit the layout of another file."""
    stamp = lambda i, form: (datetime(2023, 2, 3) + timedelta(minutes=15 * i)).strftime(form)
    forms = {"1": (";", "%Y.%m.%d %H:%M", "{},5"), "2": ("\t", "%d.%m.%Y %H:%M:%S", "{},5"), "3": (",", "%Y/%m/%d %H:%M:%S", "{}.5"), "4": (";", "%d/%m/%Y %H:%M", "{},5")}
    for k, (sep, form, number) in forms.items():
        rows = [sep.join([str(i), stamp(i, form), "4", *[number.format(i % 7)] * 3, str(i + 200), "202"]) for i in range(120)]
        rows[7] = sep.join(["7", "rubbish", "4"])
        rows[8] = sep.join(["8", "2023.13.45 00:00" if k in "13" else "45.13.2023 00:00", "4", "1", "2", "3", "4"])
        rows[9] = sep.join(["9", stamp(9, "%d.%m.%Y %H:%M" if k in "13" else "%Y.%m.%d %H:%M"), "4", "1", "2", "3", "4"])
        rows[10] = sep.join(["10", stamp(11, form), "4", *[number.format(99)] * 3, "1"])  # row 11 has the same time and wins
        write_logger(tmp_path / f"site{k}" / "deep", f"data_9400000{k}_x_0.csv", rows)
    write_logger(tmp_path / "h", "data_94000005_0.csv", ["index;time;zone;a;b;c;d", *[f"{i};{stamp(i, '%Y.%m.%d %H:%M')};4;1;2;3;4" for i in range(150)]])
    write_logger(tmp_path / "s", "data_94000006_0.csv", [f"{i};{stamp(i, '%Y.%m.%d %H:%M')};4;1;2;3;4" for i in range(100)])
    write_logger(tmp_path / "e", "data_94000007_0.csv", ["x"] * 101)
    write_logger(tmp_path / "s", "binary_94000006_0.csv", ["x"])
    lines = read_logger_lines(spark, str(tmp_path))
    layouts = {r.path[-10]: r for r in file_layouts(lines).collect() if "_x_" in r.path}
    assert len(layouts) == 1 and {(r.sep, r.year_first, r.reject) for r in file_layouts(lines).collect() if "_x_" in r.path} == {(";", True, None), ("\t", False, None), (",", True, None), (";", False, None)}
    readings, rejects = readings_and_rejects(lines)
    rows = readings.collect()
    assert sorted({r.tomst_id for r in rows}) == [94000001, 94000002, 94000003, 94000004] and len(rows) == 4 * 116
    for r in rows:
        assert r.datetime == datetime(2023, 2, 3) + timedelta(minutes=15 * r.row) and r.T1 == r.T2 == r.T3 == r.row % 7 + 0.5 and r.moist == r.row + 200
    assert 11 in {r.row for r in rows} and not {7, 8, 9, 10} & {r.row for r in rows}
    found = sorted((r.path.rsplit("data_", 1)[1][:8], r.row, r.reason, r.n_rows) for r in rejects.filter("row IS NOT NULL").collect())
    assert found == [(f"9400000{k}", row, reason, 1) for k in "1234" for row, reason in ((7, "fields"), (8, "time"), (9, "time"))]
    whole = {(r.path.rsplit("data_", 1)[1][:8], r.reason, r.n_rows) for r in rejects.filter("row IS NULL").collect()}
    assert whole == {("94000005", "header", 151), ("94000006", "short", 100), ("94000007", "header", 101)}


def test_parts_of_a_written_file_are_one_file(spark, tmp_path):
    rows = [("s1", "data_94000001_0.csv", f"{i};2023.01.{1 + i // 24:02d} {i % 24:02d}:00;4;1;2;3;4") for i in range(240)]
    df = spark.createDataFrame(rows, "folder string, file string, value string").repartition(3)
    df.write.partitionBy("folder", "file").text(str(tmp_path / "tree"))
    lines = read_logger_lines(spark, str(tmp_path / "tree"), "part-*")
    readings, rejects = readings_and_rejects(lines)
    assert readings.count() == 240 and rejects.count() == 0 and readings.select("path").distinct().count() == 1
    listed = list_files(spark, str(tmp_path / "tree"), "part-*").collect()
    assert [(r.path.endswith("/s1/data_94000001_0.csv"), r.bytes) for r in listed] == [(True, sum(len(v) + 1 for _, _, v in rows))]


def test_listing_reads_no_content(spark, tmp_path):
    write_logger(tmp_path / "a" / "b", "data_1_0.csv", ["x" * 5])
    write_logger(tmp_path / "a", "binary_1_0.csv", [])
    found = list_files(spark, str(tmp_path))
    assert sorted((r.path.split(str(tmp_path))[1], r.bytes) for r in found.collect()) == [("/a/b/data_1_0.csv", 6), ("/a/binary_1_0.csv", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<" in plan and "content" not in plan.split("ReadSchema: ")[1].split(">")[0]
    assert all(r.modified is not None for r in found.collect())
