import random
import statistics

import pytest

from fleetlens.operators import preprocess as X


def test_median_is_exact(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a double, b double")
    assert X.fit_medians(df, ["a", "b"]) == {"a": 2.5, "b": None}


def test_median_on_many_and_repeated_values(spark):
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1), float(i % 3), 7.0 if i % 3 else rng.random()) for i in range(4001)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(8)
    found = X.fit_medians(df, ["a", "b", "c"], error=0.01)
    for i, c in enumerate("abc"):
        assert found[c] == statistics.median(r[i] for r in rows)


def test_median_widens_a_wrong_bracket(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "a double")
    monkeypatch.setattr(type(df), "approxQuantile", lambda self, c, q, e: [[90.0, 95.0]])
    assert X.fit_medians(df, ["a"]) == {"a": 50.0}


def test_median_of_many_distinct_values(spark):
    """More passes than one, no order of a whole column, and few rows for any task to put in order."""
    n = 300_001
    df = spark.range(n).selectExpr("CAST(id * id AS DOUBLE) AS a", "CAST(pow(1.002, id) AS DOUBLE) AS b", "-CAST(id % 2 AS DOUBLE) AS c")
    found = X.fit_medians(df, ["a", "b", "c"], error=0.05)
    rows = df.selectExpr("percentile(a, 0.5) AS a", "percentile(b, 0.5) AS b", "percentile(c, 0.5) AS c").first()
    assert found == {"a": rows.a, "b": pytest.approx(rows.b), "c": rows.c}


def test_medians_are_counted_without_windows(spark):
    df = spark.range(50).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b")
    brackets = [X._Bracket(0, 10.0, 40.0, whole=True), X._Bracket(1, 0.0, 6.0, whole=True)]
    plan = X._in_brackets(df, ["a", "b"], brackets)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    cells = X._counted_cells(df, ["a", "b"], brackets)
    assert sum(n for _, n, _, _ in cells[0]) == 50 and dict((c, n) for c, n, _, _ in cells[0])[-1] == 10
    assert len(cells[1]) == 7


@pytest.mark.parametrize("values", [
    [-1.7e308, 1.7e308, 5.0], [float("inf")] * 3 + [1.0], [float("-inf"), 1.0, 2.0], [0.0, 5e-324], [float("inf"), 1.0],
    [-0.0, 0.0, 3.0], [7.0]])
def test_medians_of_extreme_values(spark, values, monkeypatch):
    monkeypatch.setattr(X, "ORDERED", 1)
    df = spark.createDataFrame([(v,) for v in values], "a double")
    wanted = statistics.median(values)
    assert X.fit_medians(df, ["a"]) == {"a": wanted if abs(wanted) != float("inf") else None}


def test_impute(spark):
    df = spark.createDataFrame([(1, None, None), (2, 4.0, "A"), (3, float("nan"), "B")], "id int, a double, c string")
    rows = X.impute(df, {"a": 9.0}, ["c"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 9.0, "missing"), (2, 4.0, "A"), (3, 9.0, "B")]


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = X.fit_scaler(df, ["a", "b"])
    assert scaler == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert [tuple(r) for r in X.scale(df, scaler).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_category_cap(spark):
    rows = [(f"c{i:02d}", "x") for i in range(60) for _ in range(60 - i)] + [(None, "y")]
    df = spark.createDataFrame(rows, "a string, b string")
    kept = X.fit_category_cap(df, ["a", "b"], 50)
    assert set(kept) == {"a"} and len(kept["a"]) == 49 and kept["a"][0] == "c00"
    capped = {r["a"]: r["count"] for r in X.cap_categories(df, kept).groupBy("a").count().collect()}
    assert len(capped) == 50 and capped[X.POOLED] == sum(60 - i for i in range(49, 60)) + 1
    assert X.fit_category_cap(df, ["a"], 100) == {}


def test_column_kinds_and_strict_drop(spark):
    df = spark.createDataFrame([(1, 0, 1.0, "A", True)], "vehicle_id long, in_study_repair int, n double, c string, f boolean")
    assert X.column_kinds(df) == (["c"], ["n"])
    assert X.feature_columns(df, strict=False).columns == ["n", "c", "f"]
    with pytest.raises(ValueError):
        X.feature_columns(df)
