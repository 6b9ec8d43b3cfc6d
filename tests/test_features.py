import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.operators import features as X


def stats(df):
    return X.long_statistics(df).first().asDict()


def test_plain_statistics(long_of):
    row = stats(long_of([1.0, 2.0, 3.0]))
    assert row["n"] == 3 and row["mean"] == 2.0 and row["last"] == 3.0 and row["missing_count"] == 0
    row = stats(long_of([5.0, 10.0, 3.0]))
    assert (row["min"], row["max"], row["range"]) == (3.0, 10.0, 7.0)


def test_running_state_sums(long_of):
    row = X.running_state(long_of([1.0, 2.0, 3.0])).first()
    assert (row["count"], row["sum"], row["sum_sq"], row["last_val"]) == (3, 6.0, 14.0, 3.0)
    row = X.running_state(long_of([2.0, 4.0], [1, 2])).first()
    assert (row["sum_x"], row["sum_xy"], row["sum_x_sq"]) == (3.0, 10.0, 5.0)


def test_missing_values_do_not_count(long_of):
    row = stats(long_of([1.0, None, 3.0]))
    assert row["n"] == 2 and row["missing_count"] == 1 and row["mean"] == 2.0
    row = stats(long_of([1.0, 4.0, None]))
    assert row["last"] == 4.0
    row = stats(long_of([1.0, float("nan"), float("inf")]))
    assert row["n"] == 1 and row["max"] == 1.0 and row["missing_count"] == 2


def test_never_valid_sensor(long_of):
    row = stats(long_of([None, None]))
    assert row["n"] == 0 and row["missing_count"] == 0 and row["trend_slope"] == 0.0
    assert all(row[c] is None for c in ("mean", "max", "min", "std", "last", "range", "coeff_variation"))


@pytest.mark.parametrize("times, values, slope", [
    ([0, 1, 2], [1.0, 3.0, 5.0], 2.0), ([0], [1.0], 0.0), ([1, 1, 1], [1.0, 2.0, 3.0], 0.0),
    ([0, 1, 2, 3], [4.0, 3.0, 2.0, 1.0], -1.0),
])
def test_slope(long_of, times, values, slope):
    assert stats(long_of(values, times))["trend_slope"] == pytest.approx(slope, abs=1e-12)


def test_spread_and_variation(long_of):
    values = [3.0, 4.0, 8.0, 1.0]
    row = stats(long_of(values))
    assert row["std"] == pytest.approx(statistics.pstdev(values))
    assert row["coeff_variation"] == pytest.approx(statistics.pstdev(values) / 4.0)
    assert stats(long_of([1.0, -1.0]))["coeff_variation"] == 0.0


def test_merged_states_equal_batch(long_of):
    first, second = long_of([1.0, 2.0]), long_of([3.0, 4.0], [2, 3])
    merged = X.merge_states(X.running_state(first).unionByName(X.running_state(second)))
    assert (merged.first()["count"], merged.first()["sum"]) == (4, 10.0)
    whole, parts = stats(first.unionByName(second)), X.finish_states(merged).first().asDict()
    for key, value in whole.items():
        assert parts[key] == (pytest.approx(value) if isinstance(value, float) else value)


def test_wide_features_columns_and_values(readouts):
    wide = X.wide_features(readouts)
    expected = ["vehicle_id"] + [f"s_{s}_{x}" for s in ("397_0", "397_1", "459_0") for x in P.STATISTICS]
    assert wide.columns == expected and wide.count() == 3
    row = wide.where("vehicle_id = 2").first()
    assert row["s_397_0_mean"] == 21.0 and row["s_459_0_max"] == 210.0 and row["s_397_1_trend_slope"] == 2.0


def test_wide_equals_long(spark, readouts):
    wide = X.wide_features(readouts).orderBy("vehicle_id").collect()
    again = X.features_from_long(X.to_long(readouts), ["397_0", "397_1", "459_0"]).orderBy("vehicle_id").collect()
    assert wide == again


def test_unknown_family_and_no_sensors(readouts):
    assert X.select_family(readouts, "999").columns == ["vehicle_id", "time_step"]
    empty = X.wide_features(readouts.select("vehicle_id", "time_step"))
    assert empty.columns == ["vehicle_id"] and empty.count() == 0
    assert X.features_from_long(X.to_long(readouts), []).count() == 0


def test_absent_sensor_reads_as_never_valid(spark, long_of):
    long = long_of([1.0, 2.0]).unionByName(long_of([5.0], vehicle=2, sensor="459_0"))
    row = X.features_from_long(long, ["397_0", "459_0"]).where("vehicle_id = 2").first()
    assert row["s_397_0_mean"] is None and row["s_397_0_missing_count"] == 0 and row["s_397_0_trend_slope"] == 0.0
    assert row["s_459_0_mean"] == 5.0


def test_null_vehicle_is_dropped(spark):
    long = spark.createDataFrame([(None, 0.0, "397_0", 1.0)], "vehicle_id long, time_step double, sensor string, value double")
    assert X.long_statistics(long).count() == 0


def test_tie_break(spark):
    rows = [(1, 5.0, 2, "397_0", 7.0), (1, 5.0, 9, "397_0", 3.0), (1, 4.0, 99, "397_0", 8.0)]
    long = spark.createDataFrame(rows, "vehicle_id long, time_step double, row_key int, sensor string, value double")
    assert X.long_statistics(long, tie_break=["row_key"]).first()["last"] == 3.0
    wide = long.withColumnRenamed("value", "397_0").drop("sensor")
    assert X.wide_features(wide, tie_break=["row_key"]).first()["s_397_0_last"] == 3.0


def test_assemble_keeps_vehicles_without_readouts(spark, readouts, specs, labels):
    known = readouts.where("vehicle_id <> 3")
    table = X.assemble(specs, labels.where("vehicle_id <> 2"), X.wide_features(known))
    rows = {r["vehicle_id"]: r for r in table.collect()}
    assert set(rows) == {1, 3} and rows[3]["s_397_0_mean"] is None and rows[3]["s_397_0_missing_count"] is None
    assert "spec_0" in table.columns and "Spec_0" not in table.columns


def test_hot_vehicle_against_brute_force(spark):
    """One vehicle holds most rows; every statistic still equals a direct computation."""
    rng = random.Random(7)
    rows = [(1 if i % 10 < 7 else i % 5, float(i), None if i % 6 == 0 else rng.gauss(50, 9)) for i in range(3000)]
    wide = spark.createDataFrame(rows, "vehicle_id long, time_step double, `1_0` double").repartition(16)
    for r in X.wide_statistics(wide).collect():
        mine = [(t, v) for k, t, v in rows if k == r["vehicle_id"]]
        valid = [(t, v) for t, v in mine if v is not None]
        values = [v for _, v in valid]
        mean_t, mean_v = sum(t for t, _ in valid) / len(valid), sum(values) / len(values)
        slope = sum((t - mean_t) * (v - mean_v) for t, v in valid) / sum((t - mean_t) ** 2 for t, _ in valid)
        assert r["n"] == len(valid) and r["missing_count"] == len(mine) - len(valid)
        assert r["last"] == max(valid)[1] and r["max"] == max(values)
        assert math.isclose(r["std"], statistics.pstdev(values), rel_tol=1e-9)
        assert math.isclose(r["trend_slope"], slope, rel_tol=1e-7)


def test_infinities_to_null(spark):
    df = spark.createDataFrame([(1, float("inf"), "a"), (2, 1.0, "b")], "id long, v double, s string")
    assert [tuple(r) for r in X.infinities_to_null(df).orderBy("id").collect()] == [(1, None, "a"), (2, 1.0, "b")]


def test_families_in(readouts):
    rows = X.families_in(X.to_long(readouts)).collect()
    assert [(r["family"], r["n_bins"]) for r in rows] == [("397", 2), ("459", 1)]
    assert X.to_long(readouts).where(F.col("sensor") == "459_0").count() == 6


def test_moments_survive_large_offsets(spark):
    """y = 2x + c at epoch times in seconds and milliseconds and values near 1e9, in one state and in merged ones."""
    for offset in (1.7e9, 1.7e12):
        rows = [(1, offset + k, "397_0", 1e9 + 2.0 * k) for k in range(100)]
        long = spark.createDataFrame(rows, "vehicle_id long, time_step double, sensor string, value double")
        whole = X.finish_states(X.merge_states(X.running_state(long))).first()
        parts = [X.running_state(long.where(f"time_step % 3 = {k}")) for k in range(3)]
        merged = X.finish_states(X.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))).first()
        for row in (whole, merged):
            assert row["trend_slope"] == pytest.approx(2.0, abs=1e-6)
            assert row["std"] == pytest.approx(2 * ((100**2 - 1) / 12) ** 0.5, rel=1e-6)
            assert row["mean"] == pytest.approx(1e9 + 99.0)
    narrow = [(1, 1.7e9 + k, "397_0", 1e9 + k / 100) for k in range(100)]
    long = spark.createDataFrame(narrow, "vehicle_id long, time_step double, sensor string, value double")
    row = X.finish_states(X.merge_states(X.running_state(long))).first()
    assert row["std"] == pytest.approx(0.288661, abs=1e-5)
