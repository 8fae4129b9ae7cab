import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="frostline-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Build a one-series table from values at a fixed step: series([1, None, 3], step=15)."""

    def build(values, step=15, start="2024-01-01 00:00:00", site="S1", name="T1", stamps=None, **extra):
        from datetime import datetime, timedelta

        t0 = datetime.fromisoformat(start)
        rows = []
        for i, v in enumerate(values):
            t = stamps[i] if stamps else t0 + timedelta(minutes=step * i)
            t = datetime.fromisoformat(t) if isinstance(t, str) else t
            rows.append((site, 1, t, None if v is None else float(v), *[e[i] for e in extra.values()]))
        schema = f"site string, tomst_id long, datetime timestamp_ntz, {name} double" + "".join(
            f", {k} {'int' if k in ('error_tomst', 'probl') else 'double'}" for k in extra
        )
        return spark.createDataFrame(rows, schema)

    return build


def column(df, name, order="datetime"):
    return [r[name] for r in df.orderBy(order).collect()]
