"""Forests of all groups at once, against slow trees and MLlib's."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazecast.models import evaluate, forest, trees
from tests.test_models import NAMES, SERIES, training


def slow_tree(x, y, w, depth):
    """Nested (feature, cut, left, right) or a mean, every split tried."""
    keep = w > 0
    x, y, w = x[keep], y[keep], w[keep]
    mean = np.average(y, weights=w)
    best = (-1.0,)
    if depth and len(y) > 1 and y.min() < y.max():
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for a, b in zip(values, values[1:], strict=False):
                low = x[:, j] <= a
                gain = sum(w[s].sum() * (np.average(y[s], weights=w[s]) - mean) ** 2 for s in (low, ~low))
                if gain > best[0] + 1e-9:
                    best = gain, j, (a + b) / 2, low
    if len(best) == 1:
        return mean
    _, j, cut, low = best
    return j, cut, slow_tree(x[low], y[low], w[low], depth - 1), slow_tree(x[~low], y[~low], w[~low], depth - 1)


def follow(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2 + (row[tree[0]] > tree[1])]
    return tree


@pytest.mark.parametrize("depth", [0, 1, 3, 30])
def test_one_tree_against_every_split(depth):
    rng = np.random.default_rng(depth)
    x = np.column_stack((rng.normal(size=60), rng.integers(0, 4, 60), np.ones(60)))
    y, w = rng.normal(size=60) + x[:, 1], rng.integers(0, 3, 60).astype(float)
    piece = tuple(map(np.array, forest.grown(x, y, w, depth)))
    tree = slow_tree(x, y, w, depth)
    got = forest.walked(piece, x)
    np.testing.assert_allclose(got, [follow(tree, r) for r in x])


def test_draws_are_like_n_of_n():
    ids = np.arange(200_000, dtype=np.int64) * 7919
    counts = np.bincount(forest.draws(ids, 3, True).astype(int), minlength=4)[:4] / len(ids)
    np.testing.assert_allclose(counts, np.exp(-1) / np.array([1, 1, 2, 6]), atol=0.005)
    assert (forest.draws(ids, 3, True) != forest.draws(ids, 4, True)).any()


def odd_training(spark, n=120):
    """A third station with one row, rows without station, time, target or a feature, and ties."""
    frame = training(n)
    one = frame.iloc[:1].assign(city="one")
    lost = [frame.iloc[:1].assign(**{c: None}) for c in ("city", "f0", "us_aqi")]
    df = spark.createDataFrame(pd.concat([frame, one]))
    for part in lost:
        df = df.unionByName(spark.createDataFrame(part, df.schema))
    return df.unionByName(df.where("city = 'a'").limit(1).withColumn("date", F.lit(None).cast("timestamp")))


def test_a_single_tree_learns_its_rows(spark):
    df = odd_training(spark)
    pieces = forest.fit_forest(df, NAMES, series=SERIES, trees=1, bootstrap=False)
    assert {r.city for r in pieces.collect()} == {"a", "b", "one"}
    scored = forest.score_forest(df, pieces, NAMES, SERIES)
    assert scored.columns == [*df.columns, "random_forest_pred"] and scored.count() == df.count()
    assert scored.where("abs(random_forest_pred - us_aqi) > 1e-9").count() == 0
    assert scored.where("random_forest_pred IS NULL").count() == 2  # no station, no f0
    other = df.withColumn("city", F.lit("elsewhere"))
    assert forest.score_forest(other, pieces, NAMES, SERIES).where("random_forest_pred IS NOT NULL").count() == 0
    assert forest.score_forest(df.limit(0), pieces, NAMES, SERIES).count() == 0


def test_partitioning_changes_nothing(spark):
    df = spark.createDataFrame(training(80))
    fits = [forest.fit_forest(d, NAMES, series=SERIES, trees=5) for d in (df, df.repartition(7))]
    one, two = [sorted(map(str, f.collect())) for f in fits]
    assert one == two


def test_large_nodes_are_split_by_histograms(spark):
    df = spark.createDataFrame(training(600))
    exact = forest.fit_forest(df, NAMES, series=SERIES, trees=4, depth=8)
    cut = forest.fit_forest(df, NAMES, series=SERIES, trees=4, depth=8, small=100)
    assert cut.where("left IS NULL").count() > 8 and exact.where("left IS NULL").count() == 0
    def rmse(pieces):
        return {r.city: r.rmse for r in evaluate.regression_metrics(forest.score_forest(df, pieces, NAMES, SERIES), ["city"], "random_forest_pred").collect()}
    a, b = rmse(exact), rmse(cut)
    assert all(b[c] < 1.2 * a[c] + 0.05 for c in a)
    # a tree that ends among the large nodes: its leaves hold the means of what they split
    shallow = forest.fit_forest(df, NAMES, series=SERIES, trees=1, depth=2, small=50, bootstrap=False)
    scored = forest.score_forest(df, shallow, NAMES, SERIES)
    for r in scored.groupBy("city", "random_forest_pred").agg(F.avg("us_aqi").alias("mean")).collect():
        assert abs(r.mean - r.random_forest_pred) < 1e-9
    assert scored.select("city", "random_forest_pred").distinct().count() == 8


def test_a_large_group_without_any_split(spark):
    df = spark.createDataFrame(training(90)).withColumn("us_aqi", F.lit(3.5))
    scored = forest.score_forest(df, forest.fit_forest(df, NAMES, series=SERIES, trees=2, small=20), NAMES, SERIES)
    assert {r.random_forest_pred for r in scored.collect()} == {3.5}


def test_as_good_as_the_library(spark):
    df = spark.createDataFrame(training(1200))
    _, own = forest.cross_validated_forest(df, NAMES, series=SERIES, trees=30, depth=6)
    _, other = trees.cross_validated_trees(df, trees.random_forest(trees=30, depth=6), NAMES, series=SERIES)
    one, two = [evaluate.cv_average(m).orderBy("city").toPandas() for m in (own, other)]
    assert own.count() == 10 and list(one.city) == list(two.city)
    assert (one.avg_rmse < 1.1 * two.avg_rmse).all()


def jobs_and_scans(spark, stations):
    df = spark.createDataFrame(training(40, [f"c{i}" for i in range(stations)])).cache()
    tracker, group = spark.sparkContext.statusTracker(), f"fit {stations}"
    spark.sparkContext.setJobGroup(group, group)
    pieces = forest.fit_forest(df, NAMES, series=SERIES, trees=2)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = forest.score_forest(df, pieces, NAMES, SERIES)._jdf.queryExecution().optimizedPlan().toString()
    return jobs, plan.count("InMemoryRelation"), plan.count("MapInArrow")


def test_jobs_and_plan_do_not_grow_with_stations(spark):
    few, many = jobs_and_scans(spark, 3), jobs_and_scans(spark, 30)
    assert few == many and few[2] == 1


def test_batches_without_rows_of_large_nodes(spark):
    """Small batches: from some level on many hold no row of a node that is still split."""
    df = spark.createDataFrame(training(300))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        pieces = forest.fit_forest(df, NAMES, series=SERIES, trees=1, depth=60, small=20, bootstrap=False)
        rows = df.union(df).union(odd_training(spark, 3).where("f0 IS NULL OR city = 'one'").select(*df.columns))
        scored = forest.score_forest(rows, pieces, NAMES, SERIES).collect()
    finally:
        spark.conf.set(setting, before)
    assert len(scored) == rows.count()
    known = [r for r in scored if r.random_forest_pred is not None]
    assert len(known) == 2 * df.count() and all(abs(r.random_forest_pred - r.us_aqi) < 1e-9 for r in known)


def test_subtrees_meet_only_the_rows_of_their_node(spark):
    """No task gets the pieces of a whole group that has large nodes, and trees are averaged as in the walk."""
    df = spark.createDataFrame(training(300))
    pieces = forest.fit_forest(df, NAMES, series=SERIES, trees=3, depth=12, small=40)
    held = {"a": forest.Pieces(), "b": forest.Pieces()}
    for r in pieces.collect():
        held[r.city].add(r.asDict())
    scored = forest.score_forest(df, pieces, NAMES, SERIES).collect()
    assert len(scored) == df.count()
    for city, own in held.items():
        rows = [r for r in scored if r.city == city]
        want = own.predicted(np.array([[r[c] for c in NAMES] for r in rows]))
        np.testing.assert_allclose([r.random_forest_pred for r in rows], want)


def test_trees_grow_side_by_side_as_alone():
    rng = np.random.default_rng(5)
    for weights in (1, 3):
        sizes, depths = rng.integers(1, 90, 60), rng.integers(0, 9, 60)
        x = np.column_stack((rng.normal(size=sizes.sum()), rng.integers(0, 6, sizes.sum()), rng.integers(0, 30, sizes.sum())))
        y, w = rng.integers(0, 9, len(x)).astype(float), rng.integers(1, weights + 1, len(x)).astype(float)
        begins, found = forest.grown_together(x, y, w, sizes, depths)
        stop = np.cumsum(sizes)
        for k, (a, b, depth) in enumerate(zip(stop - sizes, stop, depths, strict=True)):
            piece = tuple(c[begins[k] : begins[k + 1]] for c in found)
            alone = forest.grown(x[a:b], y[a:b], w[a:b], depth)
            assert all(np.array_equal(one, other) for one, other in zip(piece, alone, strict=True))
            tree = slow_tree(x[a:b], y[a:b], w[a:b], depth)
            if depth < 3:  # deeper, equally good splits may differ
                np.testing.assert_allclose(forest.walked(piece, x[a:b]).mean(), np.mean([follow(tree, r) for r in x[a:b]]))


def whole_numbers(n):
    """Sums of these don't depend on their order."""
    frame = training(n)
    return frame.assign(us_aqi=(frame.us_aqi * 8).round())


@pytest.mark.parametrize("bootstrap", [False, True])
def test_nodes_split_over_all_tasks_as_in_one(spark, bootstrap):
    df = spark.createDataFrame(whole_numbers(500))
    settings = {"series": SERIES, "trees": 2, "depth": 9, "small": 25, "bootstrap": bootstrap}
    one = forest.fit_forest(df, NAMES, **settings)
    for middle in (60, 200):
        many = forest.fit_forest(df.repartition(5), NAMES, middle=middle, **settings)
        found = [{(r.city, r.tree, r.node): r for r in pieces.collect()} for pieces in (one, many)]
        assert found[0].keys() == found[1].keys() and sum(r.left is None for r in found[0].values()) > 20
        for key, a in found[0].items():
            b = found[1][key]
            assert (a.feature, a.left) == (b.feature, b.left)
            np.testing.assert_allclose(a.threshold + a.value, b.threshold + b.value)


def test_a_group_of_many_levels_takes_no_job_for_each(spark):
    df = spark.createDataFrame(whole_numbers(400)).cache()
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for depth in (2, 10):
        group = f"levels {depth}"
        spark.sparkContext.setJobGroup(group, group)
        pieces = forest.fit_forest(df, NAMES, series=SERIES, trees=1, depth=depth, small=20, bootstrap=False)
        jobs.append(len(tracker.getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert pieces.where("left IS NULL").selectExpr("max(node)").first()[0] >= 16  # large nodes four levels down
    assert jobs[0] == jobs[1]


def test_a_large_group_that_is_one_leaf(spark):
    """Without depth, and over all tasks: nothing of the group is gathered."""
    df = spark.createDataFrame(whole_numbers(200))
    for depth, target in ((0, "us_aqi"), (5, "f9")):
        flat = df.withColumn("f9", F.lit(2.0))
        pieces = forest.fit_forest(flat, NAMES, target, SERIES, trees=2, depth=depth, small=10, middle=30, bootstrap=False)
        assert {(r.city, r.tree, r.node, *r.feature, *r.left) for r in pieces.collect()} == {(c, t, 1, -1, -1) for c in "ab" for t in (0, 1)}
        scored = forest.score_forest(flat, pieces, NAMES, SERIES)
        wrong = scored.groupBy("city").agg((F.max("random_forest_pred") - F.avg(target)).alias("d"), F.countDistinct("random_forest_pred").alias("n"))
        assert all(abs(r.d) < 1e-9 and r.n == 1 for r in wrong.collect())


def test_groups_with_and_without_large_nodes_side_by_side(spark):
    """One tree: rows of large groups go to their nodes, small groups, strangers and incomplete rows stay whole."""
    frame = whole_numbers(300)
    few = frame[frame.city == "a"].head(15).assign(city="few")
    df = spark.createDataFrame(pd.concat([frame, few]))
    pieces = forest.fit_forest(df, NAMES, series=SERIES, trees=1, depth=60, small=30, middle=100, bootstrap=False)
    assert {r.city for r in pieces.where("left IS NULL").collect()} == {"a", "b"}
    odd = df.limit(1).withColumn("city", F.lit("elsewhere")).union(df.limit(1).withColumn("city", F.lit(None).cast("string")))
    odd = odd.union(df.where("city = 'a'").limit(3).withColumn("f0", F.lit(None).cast("double")).select(*df.columns))
    scored = forest.score_forest(df.union(df).union(odd), pieces, NAMES, SERIES).collect()
    assert len(scored) == 2 * df.count() + 5
    known = [r for r in scored if r.random_forest_pred is not None]
    assert len(known) == 2 * df.count() and all(abs(r.random_forest_pred - r.us_aqi) < 1e-9 for r in known)
