import random

import pytest
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.catalog import learning
from fleetlens.operators import splits as S
from fleetlens.plans import flows
from fleetlens.plans import ensembles as T
from fleetlens.plans import models as M
from fleetlens.plans.parallel import side_by_side
from fleetlens.sources import bundles

TINY = P.TrainParams(trees=5, depth=3, min_leaf=1)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        y = int(i % 4 == 0)
        rows.append((i, y, 100.0, "A" if (i // 4) % 2 else "B", rng.gauss(2.0 * y, 1.0), None if i % 10 == 0 else rng.random(), None))
    return spark.createDataFrame(
        rows, "vehicle_id long, in_study_repair int, length_of_study_time_step double, cat1 string, num1 double, num2 double, void double"
    ).cache()


def forest():
    return M.ModelSpec("forest", lambda: M.random_forest(TINY), weight="balanced")


@pytest.fixture(scope="module")
def model(labelled):
    return M.fit(labelled, forest())


def test_scores_keep_rows_and_inputs(labelled, model):
    scored = model.score(labelled)
    assert scored.count() == 200 and scored.columns == [*labelled.columns, "probability", "predicted"]
    assert scored.where("probability < 0 OR probability > 1").count() == 0
    assert scored.where("num2 IS NULL").count() == 20
    assert "void" not in model.medians and set(model.input_columns()) == {"num1", "num2", "cat1"}


def test_save_and_load(spark, labelled, model, tmp_path):
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        M.FittedModel.load(path)
    assert M.FittedModel.load_or_none(path) is None
    model.save(path)
    again = M.FittedModel.load(path)
    a = model.score(labelled).select("vehicle_id", "probability")
    assert a.exceptAll(again.score(labelled).select("vehicle_id", "probability")).count() == 0
    first = M.FittedModel.versions(path)
    M.FittedModel(model.medians, model.categorical, model.kept, model.pipeline, {"second": 1}).save(path)
    assert M.FittedModel.load(path).params == {"second": 1} and M.FittedModel.load(path, back=1).params == {}
    assert M.FittedModel.versions(path)[:1] == first


def test_unseen_category_and_missing_columns(spark, model):
    df = spark.createDataFrame([(1, "NEW"), (2, None)], "vehicle_id long, cat1 string")
    with pytest.raises(ValueError, match="absent"):
        model.score(df)
    assert model.score(df, fill_missing=True).where("probability IS NULL").count() == 0


def test_importance_is_ranked_and_named(model):
    from fleetlens.operators.reports import rank_importance

    rows = rank_importance(M.feature_importance(model)).orderBy("rank").collect()
    assert rows[0]["feature"] == "num1" and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert {"num1", "num2", "cat1_A", "cat1_B"} == {r["feature"] for r in rows}
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_weights(labelled):
    weights = {r[0]: r[1] for r in M.with_weight(labelled, "balanced").select(P.LABEL, M.WEIGHT).distinct().collect()}
    assert weights == {0: pytest.approx(200 / (2 * 150)), 1: 2.0}
    ratio = {r[0]: r[1] for r in M.with_weight(labelled, "ratio").select(P.LABEL, M.WEIGHT).distinct().collect()}
    assert ratio == {0: 1.0, 1: 3.0}


def test_out_of_fold_covers_every_row_once(labelled):
    scored = M.out_of_fold(S.stratified_folds(labelled, folds=2), forest())
    assert scored.count() == 200 and scored.select("vehicle_id").distinct().count() == 200


def test_sample_grid():
    grid = {"a": [1, 2, 3], "b": [1, 2]}
    drawn = M.sample_grid(grid, 4)
    assert len({tuple(sorted(d.items())) for d in drawn}) == 4 and drawn == M.sample_grid(grid, 4)
    assert len(M.sample_grid(grid, 99)) == 6


def test_training_flow(spark, labelled, tmp_path):
    grid = {"maxDepth": [2, 3], "numTrees": [3]}
    final, metrics = flows.train(labelled, forest(), grid, 2, str(tmp_path / "m"), P.TrainParams(folds=2))
    parts = {r["part"]: r for r in metrics.collect()}
    assert set(parts) == {"cv", "test"} and parts["test"]["roc_auc"] > 0.7
    assert sum(parts["test"][c] for c in ("tn", "fp", "fn", "tp")) == 40
    assert final.params["numTrees"] == 3 and M.FittedModel.load(str(tmp_path / "m")).params == final.params


def test_champion_challenger(labelled):
    blind = M.ModelSpec("blind", lambda: M.random_forest(P.TrainParams(trees=1, depth=0, min_leaf=1)))
    metrics, promoted = M.champion_challenger(labelled, blind, forest())
    assert promoted and metrics.where("promoted").first()["model"] == "challenger"
    _, kept = M.champion_challenger(labelled, forest(), blind)
    assert not kept
    _, first = M.champion_challenger(labelled, None, blind)
    assert first


def test_score_fleet_flow(spark, labelled, model):
    vehicles = labelled.select("vehicle_id", (F.col("vehicle_id") % 3).alias("account_id"))
    accounts = spark.createDataFrame([(0, "x"), (1, "y")], "account_id long, company_name string")
    extract = flows.score_fleet(model, labelled, vehicles, accounts)
    assert extract.count() == 200 and extract.first()["feature_importance_rank"] == -1
    assert extract.where("company_name IS NULL").count() > 0 and "total_operating_hours" in extract.columns


def test_registered_training_uses_the_full_settings(monkeypatch):
    """Estimators, draws and grids of the registered queries; nothing is fitted here."""
    forest_, boosted_ = learning.forest().estimator(), learning.boosted().estimator()
    assert (forest_.getNumTrees(), forest_.getMaxDepth()) == (P.TRAIN.trees, P.TRAIN.depth) == (300, 10)
    assert (boosted_.getMaxIter(), boosted_.getMaxDepth()) == (300, 10)
    seen = {}

    class Stop(Exception):
        pass

    def benchmark(folded, specs):
        for spec in specs:
            estimator = spec.estimator()
            if spec.name != "LogisticRegression":
                rounds = estimator.getNumTrees() if spec.name == "RandomForest" else estimator.getMaxIter()
                seen[spec.name] = (rounds, estimator.getMaxDepth())
        raise Stop

    def search(folded, spec, grid, n, seed=P.TRAIN.seed):
        seen["search"] = (grid, n)
        raise Stop

    monkeypatch.setattr(M, "benchmark", benchmark)
    monkeypatch.setattr(M, "randomized_search", search)
    for name in ("training_table", "written"):
        monkeypatch.setattr(learning, name, lambda *a: None)
    monkeypatch.setattr(S, "stratified_folds", lambda df: df)
    with pytest.raises(Stop):
        learning.benchmark_models(None, "")
    with pytest.raises(Stop):
        learning.cv_search(None, "")
    assert seen == {"RandomForest": (300, 10), "GradientBoosting": (100, 6), "search": (P.TREE_GRID, 10)}


def test_the_challenger_is_searched_over_all_its_axes(labelled, monkeypatch):
    """The search runs with every axis of the grid, here with few small trees, and its result is what is compared."""
    few = {**P.CHALLENGER_GRID, "maxIter": [2], "maxDepth": [2]}
    monkeypatch.setattr(P, "CHALLENGER_GRID", few)
    assert learning.CHALLENGER_DRAWN == 20
    monkeypatch.setattr(learning, "CHALLENGER_DRAWN", 2)
    monkeypatch.setattr(learning, "training_table", lambda *a: labelled)
    monkeypatch.setattr(learning, "forest", forest)
    taken, compare = [], M.champion_challenger
    monkeypatch.setattr(M, "champion_challenger", lambda df, champion, challenger, params=None: (
        taken.append(params), compare(df, champion, challenger, params))[1])
    found = {r.model: (r.held_out, r.consistent) for r in learning.champion_challenger(labelled.sparkSession, "").collect()}
    assert found == {"champion": (40, True), "challenger": (40, True)}
    assert taken[0] in M.sample_grid(few, 2) and set(taken[0]) == set(P.CHALLENGER_GRID)


# --- ensembles, side by side, bundles ---------------------------------------------------------------


def boosted(trees=6, depth=3):
    return M.ModelSpec("boosted", lambda: M.boosted_trees(P.TrainParams(trees=trees, depth=depth, min_leaf=1)), weight="ratio")


@pytest.fixture(scope="module")
def boosted_model(labelled):
    return M.fit(labelled, boosted())


def probabilities(model, rows):
    return {r[0]: r[1] for r in model.score(rows).select("vehicle_id", "probability").collect()}


@pytest.mark.parametrize("sampled", [{}, {"subsamplingRate": 0.7, "featureSubsetStrategy": "0.6"}])
def test_the_first_trees_are_the_model_of_fewer_rounds(labelled, sampled):
    prepared = M._prepare(labelled, boosted())
    longest = prepared.model(boosted(), sampled)
    for trees in (1, 4, 6):
        alone = prepared.model(boosted(), {**sampled, "maxIter": trees})
        cut = longest.first_trees(trees)
        assert cut.pipeline.stages[-1].getNumTrees == trees and cut.params["maxIter"] == trees
        assert probabilities(cut, labelled) == pytest.approx(probabilities(alone, labelled), abs=1e-12)


def test_staged_search_equals_separate_fits(labelled):
    grid = {"maxIter": [2, 3, 5], "maxDepth": [2]}
    folded = S.stratified_folds(labelled, folds=2)
    assert len(M._staged(M.sample_grid(grid, 3))) == 1
    best, score, scores = M.randomized_search(folded, boosted(), grid, 3)
    assert len(scores) == 3 and score == max(s for _, s in scores)
    for setting, area in scores:
        metrics = M.cross_validated_metrics(folded, boosted(), setting).first()
        assert area == pytest.approx(metrics["roc_auc"], abs=1e-12)


def test_node_tables_score_as_their_models(labelled, model, boosted_model):
    for fitted in (model, boosted_model):
        trees = fitted.pipeline.stages[-1]
        nodes = T.node_table(trees)
        assert nodes.count() == sum(t.numNodes for t in trees.trees)
        assert nodes.where("feature >= 0").count() == sum(t.numNodes // 2 for t in trees.trees)
        walked = T.score_by_nodes(fitted.features(labelled), trees, "vehicle_id").collect()
        assert {r[0]: r[1] for r in walked} == pytest.approx(probabilities(fitted, labelled), abs=1e-9)
    assert T.score_by_nodes(model.features(labelled).where("false"), model.pipeline.stages[-1], "vehicle_id").count() == 0


def test_importance_falls_back_to_splits(labelled, model):
    shares = {r.feature: r.importance for r in M.split_importance(model).collect()}
    assert set(shares) == {"num1", "num2", "cat1_A", "cat1_B"} and sum(shares.values()) == pytest.approx(1.0)
    stump = M.fit(labelled, M.ModelSpec("stump", lambda: M.random_forest(P.TrainParams(trees=2, depth=0, min_leaf=1))))
    assert {r.importance for r in M.feature_importance(stump).collect()} == {0.0}


def test_a_logistic_fit_is_at_its_minimum(labelled):
    spec = M.ModelSpec("lr", M.logistic_regression, weight="balanced", scaled=True)
    fitted = M.fit(labelled, spec)
    rows = fitted.features(M.with_weight(labelled, "balanced"))
    assert M.largest_slope(fitted, rows) < learning.SLOPE
    early = M.fit(labelled, M.ModelSpec("lr", lambda: M.logistic_regression(1), weight="balanced", scaled=True))
    assert M.largest_slope(early, rows) > learning.SLOPE


def test_the_slope_is_summed_without_unfolding_rows(labelled, monkeypatch):
    """Equal to the gradient worked out row by row, with no row for every slot of a vector."""
    import math

    spec = M.ModelSpec("lr", lambda: M.logistic_regression(1), weight="balanced", scaled=True)
    fitted = M.fit(labelled, spec)
    rows = fitted.features(M.with_weight(labelled, "balanced"))
    monkeypatch.delattr(F, "posexplode")
    line = fitted.pipeline.stages[-1]
    betas, listed = list(line.coefficients), rows.select("features", P.LABEL, M.WEIGHT).collect()
    total, slopes = sum(w for _, _, w in listed), [line.getRegParam() * b for b in betas] + [0.0]
    for cells, y, w in listed:
        cells = [*cells.toArray(), 1.0]
        off = w * (1.0 / (1.0 + math.exp(-sum(x * b for x, b in zip(cells, [*betas, line.intercept])))) - y) / total
        slopes = [s + off * x for s, x in zip(slopes, cells)]
    assert M.largest_slope(fitted, rows) == pytest.approx(max(map(abs, slopes)), abs=1e-12)
    assert M.largest_slope(fitted, rows.where(F.col(P.LABEL) == 1)) > 0
    assert M.largest_slope(fitted, rows.where("false")) == 0.0


def test_side_by_side_keeps_order_and_bounds(spark):
    import threading
    import time

    running, most, lock = [], [], threading.Lock()

    def task(k):
        with lock:
            running.append(k)
            most.append(len(running))
        time.sleep(0.05)
        with lock:
            running.remove(k)
        return spark.range(k).count()

    assert side_by_side(spark, [lambda k=k: task(k) for k in range(7)], most=3) == list(range(7))
    assert 1 < max(most) <= 3
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1 // 0, lambda: 1])


def test_small_training_rows_are_one_task(labelled):
    prepared = M._prepare(labelled.repartition(6), forest())
    assert prepared.rows.rdd.getNumPartitions() == 1


def test_bundles_take_a_number_each(spark, tmp_path):
    path = str(tmp_path / "bundles")
    write = lambda folder: spark.range(2).write.parquet(f"{folder}/part")
    assert bundles.latest(spark, path) is None
    first = bundles.publish(spark, path, write, {"by": "one"}, expected=0)
    assert (first.number, bundles.latest(spark, path)) == (1, first)
    # Two writers that began from the same state: one gets its number, the other nothing.
    raced = []

    def slow(folder):
        write(folder)
        raced.append(bundles.publish(spark, path, write, {"by": "other"}, expected=1).number)

    with pytest.raises(bundles.Conflict):
        bundles.publish(spark, path, slow, expected=1)
    assert raced == [2] and bundles.latest(spark, path).note == {"by": "other"}
    together = side_by_side(spark, [lambda: bundles.publish(spark, path, write).number for _ in range(4)], most=4)
    assert sorted(together) == [3, 4, 5, 6]

    def broken(folder):
        write(folder)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        bundles.publish(spark, path, broken)
    assert [r.number for r in bundles.records(spark, path)] == [1, 2, 3, 4, 5, 6]


def test_promotion_publishes_all_parts_or_nothing(spark, labelled, tmp_path, monkeypatch):
    path = str(tmp_path / "champion")
    blind = M.ModelSpec("blind", lambda: M.random_forest(P.TrainParams(trees=1, depth=0, min_leaf=1)))
    first = M.promote(labelled, path, None, blind)
    second = M.promote(labelled, path, blind, forest())
    assert (first.number, second.number) == (1, 2) and second.note["model"] == "forest"
    assert M.promote(labelled, path, forest(), blind) is None and bundles.latest(spark, path) == second
    assert spark.read.parquet(f"{second.folder}/metrics").where("promoted").count() == 1
    assert spark.read.parquet(f"{second.folder}/importance").count() == 4
    assert spark.read.json(f"{second.folder}/report").count() == 2
    assert M.FittedModel.load(path).score(labelled).count() == 200
    monkeypatch.setattr(M, "write_report", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        M.promote(labelled, path, blind, forest())
    assert bundles.latest(spark, path) == second and M.FittedModel.load(path).params == {}


def test_trees_are_walked_alike_by_arrays_and_by_joins(spark, labelled, model, monkeypatch):
    """Both walks give the model's probabilities; rows of one file are dealt over the shuffle partitions."""
    trees, rows = model.pipeline.stages[-1], model.features(labelled).coalesce(1)
    by_arrays = {r["vehicle_id"]: r["probability"] for r in T.score_by_nodes(rows, trees, "vehicle_id").collect()}
    outputs = T.tree_outputs(rows, T.node_table(trees), max(t.depth for t in trees.trees), "vehicle_id")
    assert outputs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(T, "BROADCAST_NODES", 0)
    by_joins = {r["vehicle_id"]: r["probability"] for r in T.score_by_nodes(rows, trees, "vehicle_id").collect()}
    want = {r["vehicle_id"]: r["probability"] for r in model.score(labelled).collect()}
    assert by_arrays.keys() == by_joins.keys() == want.keys()
    assert all(abs(by_arrays[k] - p) < 1e-9 and abs(by_joins[k] - p) < 1e-9 for k, p in want.items())


# --- layout of training rows ------------------------------------------------------------------------


def test_a_forest_has_its_rows_evenly_on_every_core(spark, labelled, monkeypatch):
    """One file of few rows is a task for every core where it is worth one; boosting keeps it in one."""
    monkeypatch.setattr(M, "FOREST_BYTES", 1)
    rows = M._prepare(labelled.coalesce(1), forest()).rows
    sizes = [r[1] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= 2 and sum(sizes) == 200
    assert M._prepare(labelled.coalesce(1), boosted()).rows.rdd.getNumPartitions() == 1


def test_many_bytes_are_whole_rounds_of_the_cores(spark):
    from fleetlens.sources.materialize import laid_out, written, written_bytes

    few = laid_out(spark.range(1000).repartition(3), "rows", 1 << 30, 1 << 30)
    assert few.rdd.getNumPartitions() == 1 and few.agg(F.sum("id")).first()[0] == 499500
    rows = written(spark.range(100_000).repartition(3), "rows")
    cores, size = spark.sparkContext.defaultParallelism, written_bytes(rows)
    assert size > 100_000
    dealt = laid_out(rows, "rows", 1, size // cores // 3)
    parts = dealt.rdd.getNumPartitions()
    assert parts >= cores and parts % cores == 0 and dealt.agg(F.sum("id")).first()[0] == 4999950000


def test_forests_keep_the_node_of_every_row(labelled):
    """Kept nodes change the time and not the trees."""
    assert learning.forest().estimator().getCacheNodeIds()
    prepared = M._prepare(labelled, forest())
    plain = lambda: M.random_forest(TINY).setCacheNodeIds(False)
    walked = prepared.model(M.ModelSpec("walked", plain, weight="balanced"))
    kept = prepared.model(forest())
    assert [t.toDebugString.split("\n", 1)[1] for t in walked.pipeline.stages[-1].trees] == [
        t.toDebugString.split("\n", 1)[1] for t in kept.pipeline.stages[-1].trees]


def test_large_forests_are_fitted_one_after_the_other(labelled, monkeypatch):
    from fleetlens.sources.materialize import written

    rows = written(labelled, "rows")
    assert M._abreast(rows, forest()) == M._abreast(rows, boosted()) == M.MOST
    monkeypatch.setattr(M, "ROWS_BYTES", 1 << 10)
    assert M._abreast(rows, boosted(), forest()) == 1 and M._abreast(rows, boosted()) == M.MOST
    taken = []
    monkeypatch.setattr(M, "side_by_side", lambda _, tasks, most=M.MOST: (taken.append(most), [t() for t in tasks])[1])
    assert M.out_of_fold(S.stratified_folds(labelled, folds=2), forest()).count() == 200
    assert taken == [1]


def test_a_batch_of_rows_goes_down_a_tree_together(spark, labelled, model, boosted_model, monkeypatch):
    """The walk is a few look-ups for a batch, not an expression for every row and step; odd rows go where they went."""
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("k", LongType()), StructField("features", VectorUDT())])
    nan = float("nan")
    odd = spark.createDataFrame([
        (1, Vectors.dense(nan, nan, nan, nan)), (None, Vectors.dense(1.0, 0.2, 1.0, 0.0)), (3, Vectors.dense(0.5, -1.0, 2.0, 1.0)),
        (4, Vectors.dense(2.5, 0.4, 0.5, -1.0)), (5, Vectors.sparse(4, [0], [3.0])), (5, Vectors.dense(-2.0, 0.9, 0.0, 1.0))], schema)
    for fitted in (model, boosted_model):
        trees = fitted.pipeline.stages[-1]
        assert trees.numFeatures == 4
        depth = max(t.depth for t in trees.trees)
        outputs = T.tree_outputs(odd, T.node_table(trees), depth, "k")
        assert "MapInArrow" in outputs._jdf.queryExecution().toString()
        by_arrays = sorted(map(str, outputs.collect()))
        with monkeypatch.context() as patched:
            patched.setattr(T, "BROADCAST_NODES", 0)
            assert by_arrays == sorted(map(str, T.tree_outputs(odd, T.node_table(trees), depth, "k").collect()))
        assert len(by_arrays) == 6 * trees.getNumTrees
        assert T.tree_outputs(odd.where("false"), T.node_table(trees), depth, "k").count() == 0
