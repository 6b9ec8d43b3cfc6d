import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.operators import features as X
from fleetlens.operators import profile as R
from fleetlens.operators.features import to_long
from fleetlens.operators.running import heavy_groups, quantile_boundaries, running_totals, with_previous, with_range_bucket


def skewed(spark, n=2000):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", rng.randrange(10**6) / 7.0, i % 5) for i in range(n)]
    return spark.createDataFrame(rows, "k string, x double, v long").repartition(16)


def test_running_totals_equal_plain_window(spark):
    df = skewed(spark)
    bounds = quantile_boundaries(df, "x", 16)
    assert 8 <= len(bounds) <= 15
    ranged = with_range_bucket(df, "x", bounds, "b")
    for descending in (False, True):
        order = F.col("x").desc() if descending else F.col("x")
        mine = running_totals(ranged, ["k"], F.col("b"), [order], {"cum": "v"}, descending).drop("b")
        plain = df.withColumn("cum", F.sum("v").over(
            W.partitionBy("k").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)))
        assert mine.exceptAll(plain.select(mine.columns)).count() == 0 and mine.count() == plain.count()


def test_with_previous_equals_lag(spark):
    df = skewed(spark).dropDuplicates(["k", "x"])
    ranged = with_range_bucket(df, "x", quantile_boundaries(df, "x", 16), "b")
    window = W.partitionBy("k").orderBy("x")
    plain = df.withColumns({"previous": F.lag("v").over(window), "n": F.row_number().over(window)}).where("n > 1").drop("n")
    for bucket in (None, F.col("b")):
        mine = with_previous(ranged, ["k"], ["x"], "v", bucket).drop("b").select(plain.columns)
        assert sorted(mine.collect()) == sorted(plain.collect())


def test_hot_series_is_split_over_tasks(spark):
    """A key with a third of the rows does not end in one window group."""
    df = skewed(spark)
    ranged = with_range_bucket(df, "x", quantile_boundaries(df, "x", 16), "b")
    largest = ranged.groupBy("k", "b").count().agg(F.max("count")).first()[0]
    assert largest < df.where("k = 'hot'").count() / 5


def test_step_differences_keep_gaps(spark):
    rows = [(1, float(t), "397_0", v) for t, v in enumerate([1.0, 2.0, None, 5.0, 4.0])]
    long = spark.createDataFrame(rows, "vehicle_id long, time_step double, sensor string, value double")
    for segments in (1, 4):
        found = R.step_differences(long, segments).orderBy("time_step").collect()
        assert [r["difference"] for r in found] == [1.0, None, None, -1.0]


def test_monotonicity_and_profile(spark):
    rows = [(v, float(t), "100_0", float(t)) for v in (1, 2) for t in range(5)]
    rows += [(1, float(t), "397_0", float(-t)) for t in range(5)] + [(2, 0.0, "397_0", 1.0)]
    rows += [(1, 0.0, "397_1", None)]
    long = spark.createDataFrame(rows, "vehicle_id long, time_step double, sensor string, value double")
    profile = {r["family"]: r for r in R.sensor_profile(long).collect()}
    assert profile["100"]["monotonicity"] == 1.0 and profile["100"]["role"].startswith("CUMULATIVE")
    assert profile["397"]["monotonicity"] == 0.0 and profile["397"]["sensors"] == ["397_0", "397_1"]
    assert profile["397"]["role"].startswith("SINGLE-VALUE") and profile["397"]["n_bins"] == 2


def test_wide_profile_equals_long(spark, readouts):
    from fleetlens.operators.features import to_long

    assert R.wide_sensor_profile(readouts).collect() == R.sensor_profile(to_long(readouts)).collect()

def test_heavy_vehicle_is_cut_and_others_lie_together(spark):
    rows = spark.range(900).selectExpr("if(id < 400, 1, id % 50) AS vehicle_id", "cast(id AS double) AS time_step", "id % 7 AS a")
    assert heavy_groups(rows, "vehicle_id", 8) == [1]
    measures = {"100_0": F.col("a") * 2.0, "100_1": F.when(F.col("a") != 3, F.col("a") + 0.5)}
    wide = rows.select("vehicle_id", "time_step", *[c.alias(n) for n, c in measures.items()])
    for part in (rows, rows.where("vehicle_id <> 1")):
        full = wide.join(part.select("vehicle_id", "time_step"), ["vehicle_id", "time_step"])
        want = R.step_differences(to_long(full))
        got = R.wide_step_differences(part, measures=measures).select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert sorted(map(str, X.wide_features(part, measures=measures).collect())) == sorted(map(str, X.wide_features(full).collect()))


def test_narrow_rows_are_moved(spark):
    """Sensors are worked out after the one exchange of readouts, and no partial result a vehicle and sensor is shuffled."""
    rows = spark.range(600).selectExpr("id % 50 AS vehicle_id", "cast(id AS double) AS time_step", "id % 7 AS a")
    measures = {f"100_{i}": F.col("a") * float(i) for i in range(8)}
    features = X.wide_features(rows, measures=measures)._jdf.queryExecution().executedPlan().toString()
    assert features.count("Exchange hashpartitioning") == 1
    profile = R.wide_step_differences(rows, measures=measures)._jdf.queryExecution().executedPlan().toString()
    assert profile.count("Exchange") == 1 and profile.count("Sort ") == 1
    assert profile.index("array(") < profile.index("Exchange")
