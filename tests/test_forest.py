"""Forests in tree groups: bags, out-of-bag cells, chaining, what the driver holds."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frostline.operators import impute

T0 = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "site string, datetime timestamp_ntz, T1 double")


@pytest.mark.parametrize("groups", [3, 5, 8])
def test_every_row_is_out_of_some_bag(spark, groups):
    times = spark.range(4000).select(F.timestamp_add("MINUTE", F.col("id") * 15, F.lit(T0)).alias("t"))
    bags = times.select(*[impute.bag_weight(F.col("t"), g, groups, 1, 2).alias(f"w{g}") for g in range(groups)])
    out = sum((F.col(f"w{g}") == 0).cast("int") for g in range(groups))
    stats = bags.agg(
        F.min(out).alias("least"),
        F.max(out).alias("most"),
        F.avg(out).alias("mean_out"),
        *[F.avg(f"w{g}").alias(f"m{g}") for g in range(groups)],
        *[F.var_pop(f"w{g}").alias(f"v{g}") for g in range(groups)],
    ).first()
    assert stats["least"] >= 1 and stats["most"] < groups and abs(stats["mean_out"] - 0.3679 * groups) < 0.1
    assert all(abs(stats[f"m{g}"] - 1) < 0.08 and abs(stats[f"v{g}"] - 1) < 0.15 for g in range(groups))
    assert bags.collect() == times.repartition(7).select("t").orderBy("t").select(*[impute.bag_weight(F.col("t"), g, groups, 1, 2).alias(f"w{g}") for g in range(groups)]).collect()


def test_group_sizes():
    assert impute._group_sizes(100, 20) == [20] * 5 and impute._group_sizes(50, 20) == [17, 17, 16]
    assert impute._group_sizes(2, 20) == [1, 1] and impute._group_sizes(1, 20) == [1] and impute._group_sizes(10, 20) == [4, 3, 3]


def test_out_of_bag_predictions(spark):
    """Noise that can't be learned: trees that have seen a cell come near it, those that haven't don't."""
    import random

    rng = random.Random(1)
    rows = [(T0 + timedelta(hours=k), float(k), rng.uniform(-10, 10) if k % 9 else None, rng.random()) for k in range(900)]
    table = spark.createDataFrame(rows, "datetime timestamp_ntz, f_time double, o_0 double, x_1 double")
    cells = impute.grow_site(table, 0, ["f_time", "x_1"], [5] * 4, 30, 1, 7, "datetime", 4).cache()
    got = cells.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("o").isNotNull() & F.col("oob").isNull()).alias("unjudged"),
        F.count_if(F.col("o").isNull() & F.col("oob").isNotNull()).alias("wrong"),
        F.avg(F.abs(F.col("p") - F.col("o"))).alias("seen"),
        F.avg(F.abs(F.col("oob") - F.col("o"))).alias("unseen"),
    ).first()
    assert (got["n"], got["unjudged"], got["wrong"]) == (900, 0, 0)
    assert got["unseen"] > 4.5 > 3.5 > got["seen"]


def test_sites_are_chained_within_a_pass(spark, monkeypatch):
    """Fewer nulls first, and a later site learns from what was filled before it."""
    rows = []
    for k in range(300):
        v = float(k % 24)
        rows += [("A", T0 + timedelta(hours=k), None if k % 5 == 0 else v), ("B", T0 + timedelta(hours=k), None if k % 50 == 0 else v + 1), ("C", T0 + timedelta(hours=k), v + 2)]
    seen = []
    grow = impute.grow_site

    def spy(table, i, *rest, **options):
        seen.append((i, table.agg(F.avg(F.when(F.col("o_1").isNull(), F.col("x_1")))).first()[0]))
        return grow(table, i, *rest, **options)

    monkeypatch.setattr(impute, "grow_site", spy)
    out = impute.impute_forest(frame(spark, rows), "T1", ["A", "B", "C"], num_trees=6, max_iter=1, max_depth=8)
    assert [i for i, _ in seen] == [1, 0]
    assert seen[0][1] != seen[1][1]  # the means of B have given way when A is visited
    wrong = out.filter("T1_imp").select(F.col("T1"), (F.hour("datetime") + F.when(F.col("site") == "B", 1).otherwise(0)).alias("want"))
    assert wrong.agg(F.avg(F.abs(F.col("T1") - F.col("want")))).first()[0] < 2


def test_all_observed_cells_teach_and_leaves_are_bounded(spark, monkeypatch):
    """No observed cell is withheld from all groups, and no tree has more leaves than asked for."""
    rows = [(s, T0 + timedelta(hours=k), None if k % 31 == 0 else float((k * 37 + len(s)) % 101)) for k in range(600) for s in ("A", "BB")]
    taught, leaves = [], []
    fit = impute.RandomForestRegressor.fit

    def spy(self, data, params=None):
        taught.append({r.datetime for r in data.select("datetime").collect()})
        model = fit(self, data, params)
        leaves.extend((t.numNodes + 1) // 2 for t in model.trees)
        return model

    monkeypatch.setattr(impute.RandomForestRegressor, "fit", spy)
    impute.impute_forest(frame(spark, rows), "T1", ["A", "BB"], num_trees=8, max_iter=1, group=2, most_leaves=40).count()
    assert max(leaves) <= 40
    assert len(taught) == 8 and all(len(t) < 580 for t in taught)
    assert len(set.union(*taught[:4])) == len(set.union(*taught[4:])) == sum(k % 31 != 0 for k in range(600))
