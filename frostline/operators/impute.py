"""Chained random-forest imputation with predictive mean matching."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.operators.chunks import carry, row_halo
from frostline.operators.quality import timestamp_coverage
from frostline.operators.reshape import pivot_sites
from frostline.operators.resample import dense_grid
from frostline.session import stage, unstage

FROZEN_BELOW = 1.0


def _nearby(donors: DataFrame, keys: Sequence[str], prediction: str, k: int, block: Column) -> DataFrame:
    """Per distinct prediction with donors: lists of the donors of the ``k`` predictions up to it and from it on."""
    if k == 1:
        return donors.select(*keys, prediction, F.col("_donors").alias("_low"), F.col("_donors").alias("_high"))
    halo = row_halo(donors, keys, prediction, k - 1, k - 1, block)
    low = F.flatten(F.collect_list("_donors").over(halo.frame(k - 1, 0)))
    high = F.flatten(F.collect_list("_donors").over(halo.frame(0, k - 1)))
    return halo.own(halo.df.withColumns({"_low": low, "_high": high})).select(*keys, prediction, "_low", "_high")


def pmm_match(
    df: DataFrame,
    prediction: str = "prediction",
    observed: str = "observed",
    time: str = "datetime",
    keys: Sequence[str] = (),
    width: float = 0.5,
    k: int = 1,
    seed: int = 0,
) -> DataFrame:
    """Give every row without ``observed`` the observed value of one of the ``k`` donors whose predictions are nearest.

    Nearest comes first, then the earlier donor; a hash of ``seed`` and the row's time draws one of them, the same in
    every run. Donors are first reduced to the ``k`` earliest of each distinct prediction, then looked up in both
    directions along the prediction, which is cut into blocks of ``width``. The result has all rows, with the match (or
    the own observation) as ``matched``.
    """
    keys = list(keys)
    block = F.floor(F.col(prediction) / F.lit(width)).cast("long")
    place = F.row_number().over(Window.partitionBy(*keys, prediction).orderBy(time, observed))
    few = df.filter(F.col(observed).isNotNull()).withColumn("_place", place).filter(F.col("_place") <= k)
    donor = F.struct(F.col(time).alias("t"), F.col(prediction).alias("p"), F.col(observed).alias("v"))
    donors = few.groupBy(*keys, prediction).agg(F.collect_list(donor).alias("_donors"))  # k at most
    lists = _nearby(donors, keys, prediction, k, block)
    distinct = df.select(*keys, prediction).distinct()
    same = [distinct[c].eqNullSafe(lists[c]) for c in (*keys, prediction)]
    both = distinct.join(lists, same, "left").select(*[distinct[c] for c in (*keys, prediction)], "_low", "_high")
    near = carry(both, keys, prediction, {"_below": F.col("_low")}, {"_above": F.col("_high")}, block)
    empty = F.array().cast(lists.schema["_low"].dataType)
    found = F.array_distinct(F.concat(F.coalesce("_below", empty), F.coalesce("_above", empty)))
    ranked = F.array_sort(
        F.transform(found, lambda c: F.struct(F.abs(c["p"] - F.col(prediction)).alias("d"), c["t"].alias("t"), c["v"].alias("v")))
    )
    picks = near.select(*keys, prediction, F.slice(ranked, 1, k).alias("_picks"))
    stamp = F.concat(F.lit(f"{seed} "), F.date_format(time, "yyyy-MM-dd HH:mm:ss"))
    draw = F.conv(F.substring(F.md5(stamp.cast("binary")), 1, 8), 16, 10).cast("long")
    one = F.get("_picks", F.pmod(draw, F.greatest(F.size("_picks"), F.lit(1))).cast("int"))["v"]
    return df.join(picks, [*keys, prediction], "left").select(
        *df.columns, F.coalesce(F.col(observed), one).alias("matched")
    )


#: Share of a Poisson variable of mean 1 that is at most 0, 1, 2 ...
POISSON = (0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153, 0.999405815, 0.999916759)


def bag_weight(time: Column, group: int, groups: int, seed: int, site: int) -> Column:
    """How often the bag of a group holds the row of a time: a Poisson draw of mean 1 by hashes, the same in every run.

    Draws are stratified: of ``groups`` equal parts of the distribution one group, chosen by a hash of the time, draws from
    the lowest, the next one from the highest, the others from the rest. With three groups or more the lowest part means
    zero and the highest doesn't, so every row is out of some bag and in another.
    """
    lot = F.pmod(F.xxhash64(F.lit(seed), F.lit(site), time), F.lit(groups))
    u = F.pmod(F.xxhash64(F.lit(seed), F.lit(site), F.lit(group), time), F.lit(1 << 30)) / float(1 << 30)
    if groups > 1:
        part = 1.0 / groups
        low, high = lot == group, lot == (group - 1) % groups
        u = F.when(low, u * part).when(high, 1.0 - part + u * part).otherwise(part + u * (1.0 - 2 * part))
    return reduce(lambda n, bound: n + (u >= bound).cast("int"), POISSON, F.lit(0))


def _group_sizes(trees: int, group: int) -> list[int]:
    """Trees of each group: as even as can be, ``group`` at most, and three groups at least if there are trees for them."""
    groups = max(min(3, trees), -(-trees // group))
    return [trees // groups + (g < trees % groups) for g in range(groups)]


def grow_site(
    table: DataFrame, i: int, inputs: Sequence[str], trees: Sequence[int], max_depth: int, leaf: int, seed: int, time: str, parallel: int
) -> DataFrame:
    """``time, o, p, oob`` of one site: what is observed, the forest's prediction, and that of the trees that have not
    seen the cell (null where it is not observed, or where there are fewer than three groups and all have seen it).

    Each group of trees learns from its own bag of the observed rows; its predictions are written and its model is
    dropped, so the driver holds ``parallel`` groups at most, never a forest.
    """
    ready = VectorAssembler(inputCols=list(inputs), outputCol="_features").transform(table)

    def predicted(g: int) -> DataFrame:
        rows = ready.withColumn("_w", bag_weight(F.col(time), g, len(trees), seed, i).cast("double"))
        forest = RandomForestRegressor(
            featuresCol="_features",
            labelCol=f"o_{i}",
            predictionCol="_p",
            weightCol="_w",
            numTrees=trees[g],
            bootstrap=False,
            maxDepth=max_depth,
            maxBins=64,
            minInstancesPerNode=leaf,
            featureSubsetStrategy="sqrt",
            maxMemoryInMB=512,
            cacheNodeIds=True,
            seed=seed + 1009 * i + g,
        )
        model = forest.fit(rows.filter(F.col(f"o_{i}").isNotNull() & (F.col("_w") > 0)))
        unseen = F.col(f"o_{i}").isNotNull() & (F.col("_w") == 0)
        n = float(trees[g])
        return stage(
            model.transform(rows).select(
                time, (F.col("_p") * n).alias("p"), F.when(unseen, F.col("_p") * n).alias("oob"), F.when(unseen, n).alias("n")
            )
        )

    with ThreadPoolExecutor(parallel) as pool:
        parts = list(pool.map(predicted, range(len(trees))))
    summed = (
        reduce(DataFrame.unionByName, parts)
        .groupBy(time)
        .agg((F.sum("p") / float(sum(trees))).alias("p"), (F.sum("oob") / F.sum("n")).alias("oob"))
    )
    cells = stage(table.select(time, F.col(f"o_{i}").alias("o")).join(summed, time))
    for part in parts:
        unstage(part)
    return cells


def impute_forest(
    df: DataFrame,
    value: str,
    sites: Sequence[str],
    num_trees: int = 100,
    max_iter: int = 10,
    max_depth: int = 30,
    donors: int = 3,
    seed: int = 1,
    site: str = "site",
    time: str = "datetime",
    width: float = 0.5,
    leaf: int = 5,
    group: int = 20,
    parallel: int = 8,
    most_leaves: int = 1 << 14,
) -> DataFrame:
    """Impute ``value`` per site from time, day of year, hour and all other sites.

    In a pass the sites with nulls are visited by rising number of nulls. A forest learns from the site's observed cells
    and the other sites as they are now, those filled earlier in the pass included; the site's nulls then get the observed
    value of one of ``donors`` donors, which are told by the predictions of trees that have not seen them. Passes repeat
    until the out-of-bag error stops falling, ``max_iter`` times at most; the table of the best pass counts. All observed
    cells teach.

    Trees grow in groups of ``group``, ``parallel`` groups side by side, which changes no result. Leaves hold ``leaf`` cells at
    least, and more where a tree would have over ``most_leaves``, so what the driver holds has a bound whatever the rows.
    Every site's table is staged: lost executors cost one group of trees at most. Returns (site, time, value, <value>_imp)
    on the dense grid of ``sites``; a site without any observation stays null.
    """
    ids = {s: i for i, s in enumerate(sites)}
    base = pivot_sites(df.select(site, time, value), value, sites, site, time)
    # o_i: observed, x_i: filled, f_*: time index, day of year and hour.
    base = stage(
        base.select(
            time,
            F.unix_seconds(F.col(time).cast("timestamp")).cast("double").alias("f_time"),
            F.dayofyear(time).cast("double").alias("f_yd"),
            F.hour(time).cast("double").alias("f_hour"),
            *[F.col(f"`{s}`").alias(f"o_{i}") for s, i in ids.items()],
        )
    )
    stats = base.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            f(F.col(f"o_{i}")).alias(f"{name}_{i}")
            for i in ids.values()
            for name, f in (("count", F.count), ("mean", F.avg), ("var", F.var_pop))
        ],
    ).first()
    usable = [i for i in ids.values() if stats[f"count_{i}"] > 0]
    targets = sorted((i for i in usable if stats[f"count_{i}"] < stats["n"]), key=lambda i: (-stats[f"count_{i}"], i))
    trees = _group_sizes(num_trees, group)

    def visited(table: DataFrame, i: int) -> tuple[DataFrame, float]:
        """The table with the site filled anew, and the share of the site's variance that unseen trees miss."""
        inputs = ["f_time", "f_yd", "f_hour", *[f"x_{j}" for j in usable if j != i]]
        least = max(leaf, -(-stats[f"count_{i}"] // most_leaves))
        cells = grow_site(table, i, inputs, trees, max_depth, least, seed, time, parallel)
        missed = cells.agg(F.avg(F.pow(F.col("oob") - F.col("o"), 2))).first()[0]
        known = cells.select(time, "o", F.coalesce("oob", "p").alias("p"))
        matched = pmm_match(known, "p", "o", time, [], width, donors, seed).select(time, F.col("matched").alias("_new"))
        fresh = stage(table.join(matched, time).withColumn(f"x_{i}", F.col("_new")).select(*table.columns))
        unstage(cells)
        return fresh, (missed or 0.0) / (stats[f"var_{i}"] or 1.0)

    means = [F.coalesce(F.col(f"o_{i}"), F.lit(stats[f"mean_{i}"])).alias(f"x_{i}") for i in ids.values()]
    best, best_error = stage(base.select("*", *means)), None
    unstage(base)
    for _ in range(max_iter if targets else 0):
        table, error = best, 0.0
        for i in targets:
            fresh, missed = visited(table, i)
            if table is not best:
                unstage(table)
            table, error = fresh, error + missed
        if best_error is not None and error >= best_error:
            unstage(table)
            break
        unstage(best)
        best, best_error = table, error
    out = F.array(
        *[
            F.struct(F.lit(s).alias(site), F.col(f"x_{i}").alias(value), F.col(f"o_{i}").isNull().alias(f"{value}_imp"))
            for s, i in ids.items()
        ]
    )
    return best.select(time, F.inline(out)).select(site, time, value, f"{value}_imp")


def hide_frozen(df: DataFrame, t1: str = "T1", moist: str = "moist") -> DataFrame:
    """Moisture becomes null where T1 is below 1 degree or unknown."""
    return df.withColumn(moist, F.when(F.col(t1) >= FROZEN_BELOW, F.col(moist)))


def covered_rows(df: DataFrame, value: str = "moist", time: str = "datetime", **options) -> DataFrame:
    """Rows at times where enough sites are observed."""
    times = timestamp_coverage(df, value, time, **options).select(time)
    return df.join(times, time, "left_semi").select(*df.columns)


def frozen_moisture(original: DataFrame, imputed: DataFrame, t1: DataFrame) -> DataFrame:
    """Final moisture: the imputed value, else the original, null where imputed T1 is below 1.

    The flag is false where the original is kept and null where moisture is null.
    """
    keys = ["site", "datetime"]
    joined = (
        t1.select(*keys, "T1")
        .join(original.select(*keys, F.col("moist").alias("_orig")), keys, "full_outer")
        .join(imputed.select(*keys, F.col("moist").alias("_new"), F.col("moist_imp").alias("_imp")), keys, "full_outer")
    )
    moist = F.when(F.col("T1") >= FROZEN_BELOW, F.coalesce("_new", "_orig"))
    flag = F.when(F.col("_new").isNull(), F.lit(False)).otherwise(F.col("_imp"))
    return joined.select(*keys, moist.alias("moist"), F.when(moist.isNotNull(), flag).alias("moist_imp"))


def combine_sensors(parts: Sequence[DataFrame]) -> DataFrame:
    """Full join of the sensors on (site, datetime), flags last."""
    joined = reduce(lambda a, b: a.join(b, ["site", "datetime"], "full_outer"), parts)
    values = [c for c in joined.columns if not c.endswith("_imp")]
    return joined.select(*values, *[c for c in joined.columns if c.endswith("_imp")])


def impute_series(
    df: DataFrame,
    sites: Sequence[str],
    trees: Sequence[int] = (100, 50, 50, 50),
    drop_null: bool = False,
    min_observed: int | None = None,
    **options,
) -> DataFrame:
    """All four sensors of cleaned series, with the frozen-soil rules for moisture.

    ``drop_null`` leaves out times at which no site was measured; ``min_observed`` replaces the
    share of observed sites that moisture needs by a number of sites.
    """
    temps = {
        t: impute_forest(dense_grid(df, [t], drop_null=drop_null), t, sites, num_trees=n, **options)
        for t, n in zip(("T1", "T2", "T3"), trees)
    }
    grid = dense_grid(df, ["T1", "moist"], drop_null=drop_null)
    open_soil = covered_rows(hide_frozen(grid.select("site", "datetime", "T1", "moist")), min_observed=min_observed)
    moist = impute_forest(open_soil, "moist", sites, num_trees=trees[3], width=50.0, **options)
    final = frozen_moisture(grid, moist, temps["T1"])
    return combine_sensors([temps["T1"], temps["T2"], temps["T3"], final])
