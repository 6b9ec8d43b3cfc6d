import hashlib

from pyspark.sql import functions as F

from fleetlens.operators import joins as J


def test_duplicates_and_orphans(spark):
    vehicles = spark.createDataFrame([(1, 10), (1, 10), (2, 11), (3, 99), (4, None), (None, 10)], "vehicle_id long, account_id int")
    accounts = spark.createDataFrame([(10,), (11,)], "account_id int")
    bad = {r["vehicle_id"]: r["occurrences"] for r in J.duplicate_keys(vehicles, "vehicle_id").collect()}
    assert bad == {1: 2, None: 1}
    assert [r["vehicle_id"] for r in J.orphans(vehicles, accounts, "account_id").collect()] == [3]


def test_fleet_sizes_and_accounts(spark):
    vehicles = spark.createDataFrame([(1, 10), (2, 10), (2, 10), (3, 11)], "vehicle_id long, account_id int")
    accounts = spark.createDataFrame([(10,), (11,), (12,)], "account_id int")
    sizes = {r["account_id"]: r["fleet_size"] for r in J.accounts_with_size(accounts, vehicles).collect()}
    assert sizes == {10: 2, 11: 1, 12: None}
    assert J.active_accounts(vehicles).first()[0] == 2


def test_local_fleet_defaults(spark, specs, labels):
    partial = labels.where("vehicle_id = 1")
    rows = {r["vehicle_id"]: r for r in J.local_fleet(specs, partial).collect()}
    assert rows[1]["in_study_repair"] == 1 and rows[2]["in_study_repair"] == 0
    assert rows[2]["length_of_study_time_step"] is None
    for absent in (None, labels.drop("in_study_repair")):
        assert {r["in_study_repair"] for r in J.local_fleet(specs, absent).collect()} == {0}


def test_weighted_assignment_against_brute_force(spark):
    """One account owns more than a third of the weight."""
    weights = [(1, 500), (2, 0), (3, 100), (4, 250), (5, 1), (6, 149)]
    table = spark.createDataFrame(weights, "account_id int, weight long")
    ids = spark.range(2000).withColumnRenamed("id", "vehicle_id")
    found = {r["vehicle_id"]: r["account_id"] for r in J.assign_accounts(ids, J.account_intervals(table), parts=64).collect()}
    assert len(found) == 2000
    total = sum(w for _, w in weights)
    for key, account in found.items():
        u = int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) / 2**32
        upper = 0
        for candidate, weight in weights:
            upper += weight
            if u < upper / total:
                assert account == candidate
                break


def test_assignment_covers_cell_edges(spark):
    table = spark.createDataFrame([(1, 1), (2, 1)], "account_id int, weight long")
    ids = spark.createDataFrame([(1, 0.0), (2, 0.5), (3, 0.4999999), (4, 0.9999999)], "vehicle_id long, u double")
    for cells in (1, 2, 3, 1024):
        rows = J.assign_accounts(ids, J.account_intervals(table), F.col("u"), cells).collect()
        assert {r["vehicle_id"]: r["account_id"] for r in rows} == {1: 1, 2: 2, 3: 1, 4: 2}
