"""File, table and streaming round trips; every one starts from the driver tables and ends in a checked relation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.catalog.evaluation import _ONE_SQL, evaluation_sql, one_model
from fleetlens.catalog.evaluation import _METRICS as METRICS
from fleetlens.catalog.features import _DOUBLES, double_features, long_statistics_sql, pivoted_statistics_sql
from fleetlens.catalog.fleet import _FEATURES_SQL, features
from fleetlens.catalog.registry import query, rounded, rounded_sql
from fleetlens.catalog.scoring import RANKED_SQL, _EXTRACT_SQL, extract, importance
from fleetlens.operators import evaluate as E
from fleetlens.operators import reports as D
from fleetlens.operators.features import running_state
from fleetlens.session import scratch_path
from fleetlens.sources import materialize, readers, roles, writers
from fleetlens.sources.roles import table
from fleetlens.streaming import (
    FeatureSink, compact_states, features_so_far, latest_statistics, run_state_deltas, run_statistics, states_so_far,
)


@query("csv_readouts", roles.READOUTS_WIDE)
def csv_readouts(spark, sf_dir):
    """Readouts written as CSV and read back with the schema taken from the header."""
    path = scratch_path(spark, "readouts-csv")
    writers.write_csv(roles.readouts_wide(table(spark, sf_dir, "events")), path)
    return readers.read_csv(spark, path)


@query("csv_header_families", f"""
  SELECT DISTINCT regexp_extract(sensor, '^(\\d+)_(\\d+)$', 1) AS family
  FROM (SELECT unnest([{', '.join(f"'{s}'" for s in roles.SENSORS)}]) AS sensor)""")
def csv_header_families(spark, sf_dir):
    """Families named by the header of a readouts file."""
    path = scratch_path(spark, "readouts-header")
    writers.write_csv(roles.readouts_wide(table(spark, sf_dir, "events")), path)
    return spark.createDataFrame([(f,) for f in readers.csv_families(spark, path)], "family string")


@query("csv_extract", _EXTRACT_SQL)
def csv_extract(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    written = extract(spark, sf_dir)
    writers.write_csv(written, path)
    return spark.read.schema(written.schema).option("header", True).csv(path)


@query("json_report", rounded_sql(evaluation_sql(_ONE_SQL), METRICS))
def json_report(spark, sf_dir):
    """Nested report written, read back and flattened."""
    path = scratch_path(spark, "report")
    report = E.evaluation_report(E.evaluation(one_model(spark, sf_dir)))
    writers.write_report(report, path)
    nested = readers.read_report(spark, path, report.schema)
    matrix = {"tn": "true_negative", "fp": "false_positive", "fn": "false_negative", "tp": "true_positive"}
    return rounded(nested.select(*METRICS, *[F.col(f"confusion_matrix.{v}").alias(k) for k, v in matrix.items()]))


@query("importance_lookup", RANKED_SQL)
def importance_lookup(spark, sf_dir):
    path = scratch_path(spark, "importance")
    writers.write_csv(D.rank_importance(importance(spark, sf_dir)), path)
    return readers.read_importance(spark, path)


@query("materialized_features", rounded_sql(_FEATURES_SQL, double_features(roles.SENSORS)))
def materialized_features(spark, sf_dir):
    """Built once, then served from the fresh copy."""
    target = scratch_path(spark, "features")
    sources = [f"{sf_dir}/events.parquet"]

    def rebuild():
        raise AssertionError("a fresh table must not be rebuilt")

    materialize.load_or_build(spark, target, sources, lambda: features(spark, sf_dir))
    return rounded(materialize.load_or_build(spark, target, sources, rebuild))


@query("table_sinks", f"SELECT * FROM ({roles.VEHICLES})")
def table_sinks(spark, sf_dir):
    """Replace with one half of the vehicles, append the other, read the table."""
    path = scratch_path(spark, "vehicles")
    name = "fleetlens_" + path.rsplit("-", 1)[1]
    vehicles = roles.vehicles(table(spark, sf_dir, "customer"))
    writers.replace_table(vehicles.where(F.col("vehicle_id") % 2 == 0), name, path=path)
    writers.append_table(vehicles.where(F.col("vehicle_id") % 2 != 0), name, path=path)
    return readers.read_table(spark, name)


def _arrivals(spark, sf_dir, parts: int = 5):
    """The events table laid out as several arriving files."""
    path = scratch_path(spark, "arrivals")
    events = table(spark, sf_dir, "events")
    events.repartition(parts, F.col("event_id") % parts).write.mode("overwrite").parquet(path)
    return path, events.schema


@query("streaming_stats", rounded_sql(long_statistics_sql(), _DOUBLES))
def streaming_stats(spark, sf_dir):
    """Stateful micro-batches over all events equal the batch statistics."""
    source, schema = _arrivals(spark, sf_dir)
    target = scratch_path(spark, "stream-statistics")
    run_statistics(spark, source, schema, roles.readouts_long, target, scratch_path(spark, "stream-checkpoint"))
    return rounded(latest_statistics(spark, target))


@query("streaming_states", rounded_sql(long_statistics_sql(), _DOUBLES, 7))
def streaming_states(spark, sf_dir):
    """Per-batch states, folded at read time, equal the batch statistics."""
    source, schema = _arrivals(spark, sf_dir)
    target = scratch_path(spark, "stream-states")
    run_state_deltas(spark, source, schema, roles.readouts_long, target, scratch_path(spark, "stream-checkpoint"))
    return rounded(states_so_far(spark, target), 7)


@query("streaming_features", rounded_sql(pivoted_statistics_sql(roles.SENSORS), double_features(roles.SENSORS), 6))
def streaming_features(spark, sf_dir):
    """CSV files arrive in batches; half of the batches are compacted; the feature table holds all of them."""
    source = scratch_path(spark, "arrivals-csv")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    events.repartition(4, F.col("event_id") % 4).write.option("header", True).csv(source)
    target, checkpoint = scratch_path(spark, "stream-features"), scratch_path(spark, "stream-checkpoint")
    run_state_deltas(spark, source, events.schema, roles.readouts_long, target, checkpoint, 2, "csv")
    compact_states(spark, target)
    return rounded(features_so_far(spark, target, roles.SENSORS), 6)


@query("streaming_sink", rounded_sql(pivoted_statistics_sql(roles.SENSORS), double_features(roles.SENSORS), 6))
def streaming_sink(spark, sf_dir):
    """The feature table as five batches left it, the last of them written twice."""
    events = table(spark, sf_dir, "events")
    sink = FeatureSink(spark, scratch_path(spark, "sink"), roles.SENSORS)
    for batch_id in (0, 1, 2, 3, 4, 4):
        sink.upsert(running_state(roles.readouts_long(events.where(F.col("event_id") % 5 == batch_id))), batch_id)
    return rounded(sink.features(), 6)


@query("created_tables", f"SELECT CAST(vehicle_id AS INTEGER) AS vehicle_id, CAST(account_id AS INTEGER) AS account_id, vehicle_age_years FROM ({roles.VEHICLES})")
def created_tables(spark, sf_dir):
    """Drop and create the master tables, append all vehicles to the empty one, read it."""
    path = scratch_path(spark, "master")
    names = {k: f"fleetlens_{k}_" + path.rsplit("-", 1)[1] for k in ("accounts", "vehicles", "features", "telemetry")}
    writers.create_master_tables(spark, *names.values(), location=path)
    columns = spark.table(names["vehicles"]).schema
    vehicles = roles.vehicles(table(spark, sf_dir, "customer"))
    rows = vehicles.select(*[
        F.col(f.name).cast(f.dataType) if f.name in vehicles.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in columns])
    writers.append_table(rows, names["vehicles"])
    return readers.read_table(spark, names["vehicles"]).select("vehicle_id", "account_id", "vehicle_age_years")
