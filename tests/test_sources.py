import os
import time

import pytest

from fleetlens.operators import features as X
from fleetlens.plans import flows
from fleetlens.sources import materialize, readers, writers
from fleetlens.streaming import (
    FeatureSink, compact_states, features_so_far, latest_statistics, run_features, run_state_deltas, run_statistics,
    states_so_far,
)


def touch(path, when):
    for folder, _, names in os.walk(path):
        for name in names:
            os.utime(os.path.join(folder, name), (when, when))


def test_cache_gate(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    spark.range(3).write.parquet(source)
    assert not materialize.is_fresh(spark, target, [source])
    spark.range(3).write.parquet(target)  # a table without a completion record is not a build
    assert not materialize.is_fresh(spark, target, [source])
    target = str(tmp_path / "built")
    assert materialize.load_or_build(spark, target, [source], lambda: spark.range(3)).count() == 3
    assert materialize.is_fresh(spark, target, [source])
    assert not materialize.is_fresh(spark, target, [source, str(tmp_path / "missing")])
    touch(source, time.time() + 100)
    assert not materialize.is_fresh(spark, target, [source])


def test_load_or_build(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    spark.range(3).write.parquet(source)
    touch(source, time.time() - 100)
    built = []

    def build():
        built.append(1)
        return spark.range(5)

    assert materialize.load_or_build(spark, target, [source], build).count() == 5
    assert materialize.load_or_build(spark, target, [source], build).count() == 5 and len(built) == 1
    materialize.load_or_build(spark, target, [source], build, force=True)
    assert len(built) == 2


def test_csv_round_trip_and_feature_flow(spark, tmp_path, readouts, specs, labels):
    paths = {}
    for name, df in (("readouts", readouts), ("specs", specs), ("labels", labels)):
        paths[name] = str(tmp_path / name)
        writers.write_csv(df, paths[name])
    assert readers.csv_families(spark, paths["readouts"]) == ["397", "459"]
    again = readers.read_csv(spark, paths["readouts"])
    assert again.schema == readouts.schema and again.exceptAll(readouts).count() == 0
    table = flows.features_from_csv(spark, **paths, target=str(tmp_path / "features"))
    assert table.where("vehicle_id = 1").first()["s_397_0_mean"] == 11.0 and table.count() == 3
    assert {"spec_0", "in_study_repair"} <= set(table.columns)


def test_blank_and_nan_cells(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("vehicle_id,time_step,397_0\n1,0,\n1,1,NaN\n1,2,4.5\n")
    rows = readers.read_csv(spark, str(folder)).orderBy("time_step").collect()
    assert [r["397_0"] for r in rows] == [None, None, 4.5]


def test_tables(spark, tmp_path):
    names = {"accounts": "t_accounts", "vehicles": "t_vehicles", "features": "t_features"}
    writers.create_master_tables(spark, names["accounts"], names["vehicles"], names["features"], "t_telemetry", str(tmp_path))
    assert spark.table("t_vehicles").columns[:2] == ["vehicle_id", "account_id"] and spark.table("t_accounts").count() == 0
    vehicle = spark.sql("SELECT 1 vehicle_id, 10 account_id, 2.5D vehicle_age_years, 'Q' vehicle_model, 'E' engine_family, 2015 manufacture_year")
    writers.append_table(vehicle, "t_vehicles")
    writers.append_table(vehicle, "t_vehicles")
    assert readers.read_table(spark, "t_vehicles").count() == 2
    features = spark.createDataFrame([(1, float("inf"))], "vehicle_id long, s_1_0_mean double")
    accounts = spark.createDataFrame([(10, "n")], "account_id int, company_name string")
    flows.publish(spark, features, vehicle, accounts, {k: f"p_{k}" for k in names}, location=str(tmp_path / "published"))
    assert spark.table("p_accounts").first()["fleet_size"] == 1 and spark.table("p_features").first()[1] is None


def test_importance_is_optional(spark, tmp_path):
    assert readers.read_importance(spark, str(tmp_path / "none")) is None


@pytest.mark.parametrize("kind", ["stateful", "states"])
def test_stream_equals_batch_and_resumes(spark, tmp_path, readouts, kind):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    runner, result = (run_statistics, latest_statistics) if kind == "stateful" else (run_state_deltas, states_so_far)
    readouts.where("time_step = 0").coalesce(1).write.parquet(source)
    runner(spark, source, readouts.schema, X.to_long, target, checkpoint)
    readouts.where("time_step = 1").coalesce(1).write.mode("append").parquet(source)
    runner(spark, source, readouts.schema, X.to_long, target, checkpoint)
    found = result(spark, target).orderBy("vehicle_id", "sensor").collect()
    expected = X.long_statistics(X.to_long(readouts)).orderBy("vehicle_id", "sensor").collect()
    assert len(found) == len(expected) == 9
    for a, b in zip(found, expected):
        for c, v in b.asDict().items():
            assert a[c] == (pytest.approx(v) if isinstance(v, float) else v), c


def test_whole_labels_written_as_decimals(spark, tmp_path):
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "a.csv").write_text("vehicle_id,in_study_repair,length_of_study_time_step\n1,1.0,5\n2.0,0,\n3,,1\n")
    rows = readers.read_csv(spark, str(tmp_path / "labels")).orderBy("vehicle_id").collect()
    assert [(r[0], r[1]) for r in rows] == [(1, 1), (2, 0), (3, None)]


@pytest.mark.parametrize("text", ["vehicle_id,time_step,397_0\n1,0,abc\n", "vehicle_id,time_step,397_0\n1.5,0,1\n"])
def test_cells_of_the_wrong_type_are_refused(spark, tmp_path, text):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text(text)
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error, at read time
        readers.read_csv(spark, str(tmp_path / "raw")).collect()


def test_another_header_order_is_refused(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("vehicle_id,time_step,397_0,459_0\n1,0,1,2\n")
    (tmp_path / "raw" / "b.csv").write_text("vehicle_id,time_step,459_0,397_0\n2,0,2,1\n")
    with pytest.raises(Exception):  # noqa: B017
        readers.read_csv(spark, str(tmp_path / "raw")).collect()


def test_half_written_and_outdated_tables_are_rebuilt(spark, tmp_path):
    import os

    from fleetlens.sources import materialize

    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    spark.range(1000).repartition(4).write.parquet(source)
    builds = []

    def build():
        builds.append(1)
        return spark.read.parquet(source)

    assert materialize.load_or_build(spark, target, [source], build).count() == 1000
    assert materialize.load_or_build(spark, target, [source], build).count() == 1000 and len(builds) == 1
    folder = next(f for f in os.listdir(target) if f.startswith("build-"))
    part = next(f for f in os.listdir(f"{target}/{folder}") if f.startswith("part-"))
    os.rename(f"{target}/{folder}/{part}", str(tmp_path / "lost"))
    assert materialize.load_or_build(spark, target, [source], build).count() == 1000 and len(builds) == 2
    spark.range(5).write.mode("append").parquet(source)
    assert materialize.load_or_build(spark, target, [source], build).count() == 1005 and len(builds) == 3


def test_jdbc_needs_a_parallel_scan(spark):
    with pytest.raises(ValueError, match="partitionColumn"):
        readers.read_table(spark, "t", {"url": "jdbc:none"})


def test_compacted_states_take_later_batches(spark, tmp_path, readouts):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for time_step in (0, 1):
        readouts.where(f"time_step = {time_step}").coalesce(1).write.mode("append").option("header", True).csv(source)
        run_state_deltas(spark, source, readouts.schema, X.to_long, target, checkpoint, kind="csv")
        if time_step == 0:
            compact_states(spark, target)
    sensors = ["397_0", "397_1", "459_0"]
    found = features_so_far(spark, target, sensors).orderBy("vehicle_id").collect()
    expected = X.features_from_long(X.to_long(readouts), sensors).orderBy("vehicle_id").collect()
    for a, b in zip(found, expected, strict=True):
        for c, v in b.asDict().items():
            assert a[c] == (pytest.approx(v) if isinstance(v, float) else v), c


def same_rows(found, expected):
    for a, b in zip(found.orderBy("vehicle_id").collect(), expected.orderBy("vehicle_id").collect(), strict=True):
        for c, v in b.asDict().items():
            assert a[c] == (pytest.approx(v) if isinstance(v, float) else v), c


def test_the_sink_updates_touched_buckets_only(spark, tmp_path, readouts):
    sensors = ["397_0", "397_1", "459_0"]
    sink = FeatureSink(spark, str(tmp_path / "sink"), sensors, buckets=5)
    with pytest.raises(FileNotFoundError):
        sink.features()
    long = X.to_long(readouts)
    first = long.where("time_step < 1")
    assert sink.upsert(X.running_state(first), 0)
    same_rows(sink.features(), X.features_from_long(first, sensors))
    before = sink.files()
    vehicle = readouts.where("time_step >= 1").select("vehicle_id").first()[0]
    second = long.where("time_step >= 1").where(f"vehicle_id = {vehicle}")
    touched = sink.upsert(X.running_state(second), 1)
    assert len(touched) == 1
    assert set(before) - set(sink.files()) == {f for f in before if f.endswith(f"bucket={touched[0]}")}
    both = X.features_from_long(first.unionByName(second), sensors)
    same_rows(sink.features(), both)
    # Replayed, out of date, and empty batches change nothing.
    assert sink.upsert(X.running_state(second), 1) == touched
    assert sink.upsert(X.running_state(second), 0) == [] and sink.upsert(X.running_state(second.where("false")), 2) == []
    same_rows(sink.features(), both)


def test_a_stream_into_the_sink(spark, tmp_path, readouts):
    sensors = ["397_0", "397_1", "459_0"]
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    sink = FeatureSink(spark, str(tmp_path / "sink"), sensors, buckets=3)
    for time_step in (0, 1):
        readouts.where(f"time_step = {time_step}").coalesce(1).write.mode("append").parquet(source)
        run_features(spark, source, readouts.schema, X.to_long, sink, checkpoint)
    same_rows(sink.features(), X.features_from_long(X.to_long(readouts.where("time_step < 2")), sensors))
