import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.plans import boosting as B
from fleetlens.plans import ensembles as T
from fleetlens.plans import models as M


def boosted(trees=8, depth=4, leaf=5, weight="ratio"):
    return M.ModelSpec("boosted", lambda: M.boosted_trees(P.TrainParams(trees=trees, depth=depth, min_leaf=leaf)), weight=weight)


@pytest.fixture(scope="module")
def labelled(spark):
    """Numbers, categories with gaps, and columns that nearly all rows have missing."""
    rng, rows = random.Random(5), []
    for i in range(1500):
        a, b, c, rare = rng.gauss(0, 1), rng.random(), rng.choice("abcde"), i % 9 == 0
        y = int(1.5 * a - (c in "ab") + 2 * (b > 0.7) * (a < 0) + rare * (i % 2) + rng.gauss(0, 0.5) > 0.8)
        rows.append((i, y, 100.0, c, rng.choice(["u", "v", None]), a, b if rng.random() < 0.9 else None, rng.gauss(0, 1),
                     rng.gauss(i % 2, 1) if rare else None, rng.gauss(0, 1) if rare else None))
    columns = "vehicle_id long, in_study_repair int, length_of_study_time_step double, c1 string, c2 string, " + ", ".join(
        f"n{k} double" for k in range(5))
    return spark.createDataFrame(rows, columns).cache()


@pytest.fixture(scope="module")
def prepared(labelled):
    return M._prepare(labelled, boosted())


def probabilities(model, rows):
    return np.array([float(r[0][1]) for r in model.transform(rows).select("probability").collect()])


def set_to(estimator, **params):
    return estimator.copy({estimator.getParam(k): v for k, v in params.items()})


def alike(ours, theirs, tree):
    """Nodes of one tree in both models that split alike; elsewhere the gains are equal, so that either split is best."""
    first, second = ({r.node: r for r in T.node_table(m).where(F.col("tree") == tree).collect()} for m in (ours, theirs))
    same, others, pending = 0, 0, [(0, 0)]
    while pending:
        x, y = (nodes[k] for nodes, k in zip((first, second), pending.pop()))
        assert x.rows == y.rows and x.value == pytest.approx(y.value, abs=1e-9) and x.share == y.share
        if (x.feature, x.threshold, x.categories) == (y.feature, y.threshold, y.categories):
            same += 1
            if x.feature >= 0:
                assert x.gain == pytest.approx(y.gain, abs=1e-9)
                pending += [(x.left, y.left), (x.right, y.right)]
        else:
            others += 1
            assert max(x.gain, 0.0) == pytest.approx(max(y.gain, 0.0), abs=1e-9)
    return same, others


def test_a_fit_is_a_few_jobs_however_many_trees(spark, prepared):
    """Boosting was two jobs and more for every level of every tree."""
    context = spark.sparkContext
    counted = []
    for trees in (2, 12):
        context.setJobGroup(f"boosting-{trees}", "")
        model = prepared.model(boosted(trees=trees))
        counted.append(len(context.statusTracker().getJobIdsForGroup(f"boosting-{trees}")))
        assert model.pipeline.stages[-1].getNumTrees == trees
    context._jsc.clearJobGroup()
    assert counted[0] == counted[1] <= 20


@pytest.mark.parametrize("settings", [
    {}, {"stepSize": 0.05, "minInstancesPerNode": 20}, {"maxDepth": 0}, {"maxBins": 8, "maxIter": 2}, {"minInfoGain": 0.02}])
def test_the_trees_are_those_of_sparks_estimator(prepared, settings):
    estimator = set_to(boosted().estimator(), **settings)
    ours, theirs = B.fit(estimator, prepared.rows, prepared.cuts), estimator.fit(prepared.rows)
    assert ours.treeWeights == theirs.treeWeights and ours.numFeatures == theirs.numFeatures and ours.uid == estimator.uid
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
    assert probabilities(ours, prepared.rows) == pytest.approx(probabilities(theirs, prepared.rows), abs=1e-9)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    assert ours.extractParamMap().keys() == theirs.extractParamMap().keys()
    assert ours.getMaxDepth() == theirs.getMaxDepth() and ours.trees[0].getMaxDepth() == theirs.trees[0].getMaxDepth()


@pytest.mark.parametrize("weight", ["1.0", "CASE WHEN n % 5 = 0 THEN 0.0 ELSE n % 4 + 0.5 END"])
def test_deep_trees_differ_in_ties_only(labelled, prepared, weight):
    """Leaves of single rows, weights of one or of many kinds; nothing is kept from one level for the next."""
    rows = prepared.rows.withColumn("n", F.monotonically_increasing_id()).withColumn(M.WEIGHT, F.expr(weight).cast("double")).drop("n")
    estimator = set_to(boosted().estimator(), maxDepth=9, minInstancesPerNode=1, maxIter=1)
    ours, theirs = B.fit(estimator, rows), estimator.fit(rows)
    same, others = alike(ours, theirs, 0)
    assert same > 50 and others < same / 4
    area = lambda m: abs(probabilities(m, rows) - np.array([r[0] for r in rows.select(P.LABEL).collect()])).mean()
    assert area(ours) == pytest.approx(area(theirs), rel=0.05)


def test_sums_that_are_not_kept_are_counted_again(prepared, monkeypatch):
    estimator = boosted().estimator()
    kept = B.fit(estimator, prepared.rows, prepared.cuts)
    monkeypatch.setattr(B, "KEPT_BYTES", 0)
    monkeypatch.setattr(B, "_FEW", 0.0)
    monkeypatch.setattr(B, "_SEARCHED", 1)
    again = B.fit(estimator, prepared.rows, prepared.cuts)
    assert probabilities(again, prepared.rows) == pytest.approx(probabilities(kept, prepared.rows), abs=1e-9)


def test_drawn_rows_and_features(prepared):
    """As many as asked for, other ones for every tree, and the same ones again."""
    spec = boosted(trees=6)
    setting = {"subsamplingRate": 0.5, "featureSubsetStrategy": "0.3"}
    first, second = (prepared.model(spec, setting).pipeline.stages[-1] for _ in range(2))
    assert (probabilities(first, prepared.rows) == probabilities(second, prepared.rows)).all()
    roots = T.node_table(first).where("node = 0").orderBy("tree").collect()
    assert len({r.rows for r in roots}) > 1 and all(0.4 * 1500 < r.rows < 0.6 * 1500 for r in roots)
    whole = prepared.model(spec).pipeline.stages[-1]
    assert {r.feature for r in roots} != {r.feature for r in T.node_table(whole).where("node = 0").collect()}
    assert [B.features_per_node(s, 100) for s in ("all", "auto", "sqrt", "log2", "onethird", "7", "0.6", "1.0")] == [
        100, 100, 10, 7, 34, 7, 60, 100]


def test_what_one_task_cannot_hold_stays_with_spark(prepared, monkeypatch):
    """Rows beyond a task's cells, and settings that only Spark's estimator knows."""
    estimator = boosted(trees=2).estimator()
    assert B.fits_a_task(estimator, prepared.cuts)
    assert not B.fits_a_task(set_to(estimator, minWeightFractionPerNode=0.1), prepared.cuts)
    ours = B.fit(estimator, prepared.rows, prepared.cuts)
    monkeypatch.setattr(B, "TASK_CELLS", 1)
    monkeypatch.setattr(B, "grow", None)
    assert probabilities(B.fit(estimator, prepared.rows, prepared.cuts), prepared.rows) == pytest.approx(
        probabilities(ours, prepared.rows), abs=1e-9)


def test_rows_that_sparks_fit_refuses_are_refused(spark, prepared):
    with pytest.raises(Exception, match="(?i)label"):
        B.fit(boosted().estimator(), prepared.rows.withColumn(P.LABEL, F.lit(2)))
    with pytest.raises(Exception, match="size of input|empty"):
        B.fit(boosted().estimator(), prepared.rows.where("false"))
    one_class = B.fit(boosted(trees=3).estimator(), prepared.rows.where(F.col(P.LABEL) == 0))
    assert [t.numNodes for t in one_class.trees] == [1, 1, 1]
