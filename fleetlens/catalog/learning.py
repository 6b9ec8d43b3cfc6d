"""Model training queries.

Scores depend on the learner, so they are checked by properties in the tests. What does not depend on it (which rows
are scored by which fold, how categories are encoded) is checked by SQL.
"""

from __future__ import annotations

import zlib

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.catalog.fleet import _POSITIONS, accounts, vehicles
from fleetlens.catalog.registry import query
from fleetlens.catalog.scoring import scored_at
from fleetlens.operators import features as X
from fleetlens.operators import joins as J
from fleetlens.operators import scoring as G
from fleetlens.operators import splits as S
from fleetlens.plans import ensembles as T
from fleetlens.plans import flows
from fleetlens.plans import models as M
from fleetlens.session import scratch_path, shared_dir
from fleetlens.sources import bundles, roles
from fleetlens.sources.materialize import load_or_build, written
from fleetlens.sources.roles import table

# Part of the stored table's name; to be changed with what builds it.
TABLE_VERSION = 2
# Settings drawn by the two searches.
DRAWN = 10
CHALLENGER_DRAWN = 20


def order_readouts(orders):
    """Readouts every customer has: order value per order, so training features are not all missing."""
    return orders.select(
        F.col("o_custkey").alias("vehicle_id"), F.col("o_orderkey").cast("double").alias("time_step"),
        F.col("o_totalprice").alias("397_0"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("459_0"),
    )


def training_table(spark, sf_dir):
    """The labelled feature table, materialised in the shared folder and rebuilt when a source is newer.

    Training makes many passes over it; each reads the written columns instead of repeating the aggregation.
    """
    target = f"{shared_dir(spark)}/fleetlens/training-{TABLE_VERSION}-{zlib.crc32(sf_dir.encode())}"
    sources = [f"{sf_dir}/{name}.parquet" for name in ("customer", "orders", "events", "nation", "region")]
    return load_or_build(spark, target, sources, lambda: build_training_table(spark, sf_dir))


def build_training_table(spark, sf_dir):
    """All customers as labelled vehicles with order statistics, event statistics, specification and account."""
    customer = table(spark, sf_dir, "customer")
    ordered = X.wide_features(order_readouts(table(spark, sf_dir, "orders")))
    observed = X.wide_features(renamed_sensors(roles.readouts_wide(table(spark, sf_dir, "events"))))
    assembled = X.assemble(roles.specs(customer), roles.labels(customer), ordered).join(observed, P.ID, "left")
    master = vehicles(spark, sf_dir).join(accounts(spark, sf_dir), P.ACCOUNT, "left")
    return S.drop_unlabeled(assembled.join(master, P.ID, "inner"))


def renamed_sensors(wide):
    """All five event sensors, as bins of one family so that their names do not meet those of the order sensors."""
    return wide.select("vehicle_id", "time_step", *[F.col(f"`{s}`").alias(f"666_{i}") for i, s in enumerate(roles.SENSORS)])


def boosted() -> M.ModelSpec:
    return M.ModelSpec("GradientBoosting", M.boosted_trees, weight="ratio")


def forest() -> M.ModelSpec:
    return M.ModelSpec("RandomForest", M.random_forest, weight="balanced")


def logistic() -> M.ModelSpec:
    return M.ModelSpec("LogisticRegression", M.logistic_regression, weight="balanced", scaled=True, max_categories=50)


def held_out_scores(spark, sf_dir, spec):
    split = written(S.stratified_split(training_table(spark, sf_dir)), "split")
    model = M.fit(split.where(~F.col("is_test")).drop("is_test"), spec)
    return model.score(split.where("is_test")).select(P.ID, P.LABEL, "probability", "predicted")


_ROWS_SQL = f"""
  SELECT vehicle_id, in_study_repair, CAST(r % 5 AS INTEGER) AS fold, r <= ceil(CAST(0.2 AS DOUBLE) * n) AS is_test
  FROM ({_POSITIONS})"""


_HELD_OUT = f"SELECT vehicle_id, in_study_repair, true AS consistent FROM ({_ROWS_SQL}) WHERE is_test"


def consistent(scored):
    """Hold-out rows, and whether their probability is one and the label follows it."""
    fits = F.col("probability").between(0.0, 1.0) & (F.col("predicted") == (F.col("probability") >= 0.5).cast("int"))
    return scored.select(P.ID, P.LABEL, fits.alias("consistent"))


@query("train_gbt", _HELD_OUT)
def train_gbt(spark, sf_dir):
    return consistent(held_out_scores(spark, sf_dir, boosted()))


@query("train_rf", _HELD_OUT)
def train_rf(spark, sf_dir):
    return consistent(held_out_scores(spark, sf_dir, forest()))


# No component of a logistic fit's gradient is larger; the same bound ends the search in other libraries.
SLOPE = 1e-4


@query("train_lr", f"SELECT vehicle_id, in_study_repair, true AS consistent, true AS optimal FROM ({_ROWS_SQL}) WHERE is_test")
def train_lr(spark, sf_dir):
    """The hold-out rows, and whether the gradient over the training rows vanishes at the fitted coefficients."""
    split = written(S.stratified_split(training_table(spark, sf_dir)), "split")
    train = split.where(~F.col("is_test")).drop("is_test")
    model = M.fit(train, logistic())
    slope = M.largest_slope(model, model.features(M.with_weight(train, logistic().weight)))
    scored = model.score(split.where("is_test")).select(P.ID, P.LABEL, "probability", "predicted")
    return consistent(scored).withColumn("optimal", F.lit(slope <= SLOPE))


_SETTINGS = ", ".join(
    f"({s['maxIter']}, {s['maxDepth']}, {s['minInstancesPerNode']})" for s in M.sample_grid(P.TREE_GRID, DRAWN))


@query("cv_search", f"""
  SELECT max_iter, max_depth, min_instances, true AS in_range,
         (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 0) AS labelled
  FROM (VALUES {_SETTINGS}) s(max_iter, max_depth, min_instances)""")
def cv_search(spark, sf_dir):
    """The drawn settings, each with a mean area under the curve over five folds."""
    folded = S.stratified_folds(training_table(spark, sf_dir))
    _, best, scores = M.randomized_search(folded, boosted(), P.TREE_GRID, DRAWN)
    rows = [(s["maxIter"], s["maxDepth"], s["minInstancesPerNode"], 0.0 <= a <= best <= 1.0) for s, a in scores]
    found = spark.createDataFrame(rows, "max_iter int, max_depth int, min_instances int, in_range boolean")
    labelled = training_table(spark, sf_dir).agg(F.count(F.lit(1)).alias("labelled"))
    return found.join(labelled, F.lit(True))


@query("oof_coverage", f"SELECT vehicle_id, in_study_repair, fold, true AS in_range FROM ({_ROWS_SQL})")
def oof_coverage(spark, sf_dir):
    """Every labelled row once, under its own fold, with a probability."""
    scored = M.out_of_fold(S.stratified_folds(training_table(spark, sf_dir)), forest())
    return scored.select(P.ID, P.LABEL, "fold", F.col("probability").between(0.0, 1.0).alias("in_range"))


@query("hold_out_rows", f"SELECT vehicle_id, in_study_repair, true AS consistent FROM ({_ROWS_SQL}) WHERE is_test")
def hold_out_rows(spark, sf_dir):
    """The rows scored on the hold-out, and that the label follows the probability."""
    scored = held_out_scores(spark, sf_dir, forest())
    consistent = F.col("predicted") == (F.col("probability") >= 0.5).cast("int")
    return scored.select(P.ID, P.LABEL, consistent.alias("consistent"))


@query("one_hot", """
  WITH k AS (
    SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) AS INTEGER) AS slot FROM customer
    WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_mktsegment)
  SELECT c_custkey AS vehicle_id, coalesce(slot, 0) AS slot, CASE WHEN slot IS NULL THEN 0.0 ELSE 1.0 END AS ones
  FROM customer LEFT JOIN k USING (c_mktsegment)""")
def one_hot(spark, sf_dir):
    """One-hot slots, most frequent category first; a category unseen in fitting is all zeros."""
    specs = X.rename_specs(roles.specs(table(spark, sf_dir, "customer")))
    encoded = M.one_hot(specs.where(F.col("spec_0") != "MACHINERY"), specs, ["spec_0"])
    cells = vector_to_array("features")
    return encoded.select(
        P.ID, F.array_position(cells, F.lit(1.0)).cast("int").alias("slot"),
        F.aggregate(cells, F.lit(0.0), lambda a, b: a + b).alias("ones"),
    )


@query("oof_scores", f"SELECT vehicle_id, in_study_repair, fold, true AS consistent FROM ({_ROWS_SQL})")
def oof_scores(spark, sf_dir):
    """Out-of-fold scores of the boosted model."""
    scored = M.out_of_fold(S.stratified_folds(training_table(spark, sf_dir)), boosted())
    fits = F.col("probability").between(0.0, 1.0) & (F.col("predicted") == (F.col("probability") >= 0.5).cast("int"))
    return scored.select(P.ID, P.LABEL, "fold", fits.alias("consistent"))


@query("feature_importance", """
  SELECT (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_custkey % 50 <> 0) AS segments,
         (SELECT count(DISTINCT n_name) FROM customer JOIN nation ON c_nationkey = n_nationkey
          WHERE c_custkey % 50 <> 0) AS companies,
         true AS distinct_names, true AS in_range, true AS sums_to_one, true AS ranked""")
def feature_importance(spark, sf_dir):
    """What holds for the importances: a slot per category, distinct names, shares of one, ranks without gaps."""
    from fleetlens.operators.reports import rank_importance

    ranked = rank_importance(M.feature_importance(M.fit(training_table(spark, sf_dir), forest())))
    n = F.count(F.lit(1))
    return ranked.agg(
        F.count_if(F.col("feature").startswith("spec_0_")).alias("segments"),
        F.count_if(F.col("feature").startswith("company_name_")).alias("companies"),
        (F.countDistinct("feature") == n).alias("distinct_names"),
        F.min((F.col("importance") >= 0) & (F.col("importance") <= 1)).alias("in_range"),
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"),
        ((F.min("rank") == 1) & (F.max("rank") <= n)).alias("ranked"))


@query("node_scores", f"SELECT vehicle_id, true AS same FROM ({_POSITIONS})")
def node_scores(spark, sf_dir):
    """Every labelled vehicle: walking the forest's node table gives the probability that the model gives."""
    labelled = training_table(spark, sf_dir)
    model = M.fit(labelled, forest())
    prepared = written(model.features(labelled).select(P.ID, "features"), "features")
    walked = T.score_by_nodes(prepared, model.pipeline.stages[-1], P.ID).withColumnRenamed("probability", "walked")
    return model.score(labelled).select(P.ID, "probability").join(walked, P.ID, "left").select(
        P.ID, F.coalesce(F.abs(F.col("walked") - F.col("probability")) < 1e-9, F.lit(False)).alias("same"))


@query("split_importance", """
  SELECT (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_custkey % 50 <> 0) AS segments,
         (SELECT count(DISTINCT n_name) FROM customer JOIN nation ON c_nationkey = n_nationkey
          WHERE c_custkey % 50 <> 0) AS companies,
         true AS sums_to_one, true AS all_splits""")
def split_importance(spark, sf_dir):
    """Importance by splits: a slot per category, shares of one, and as many splits as the model's trees have."""
    model = M.fit(training_table(spark, sf_dir), forest())
    trees = model.pipeline.stages[-1]
    counted = T.split_counts(T.node_table(trees)).agg(F.coalesce(F.sum("splits"), F.lit(0)).alias("counted"))
    inner = sum(tree.numNodes // 2 for tree in trees.trees)
    return M.split_importance(model).agg(
        F.count_if(F.col("feature").startswith("spec_0_")).alias("segments"),
        F.count_if(F.col("feature").startswith("company_name_")).alias("companies"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one")).crossJoin(
        counted.select((F.col("counted") == inner).alias("all_splits")))


@query("promotion", """
  SELECT step, (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 0) AS scored, true AS consistent
  FROM (VALUES ('first'), ('second')) s(step)""")
def promotion(spark, sf_dir):
    """What a promotion leaves: the first always publishes, the second only if it wins; each is read back and scores all.

    Consistent: the number of the newest bundle follows from the decisions, and its metrics, importance and model are
    there and belong together.
    """
    labelled = training_table(spark, sf_dir)
    path = scratch_path(spark, "bundle")
    first = M.promote(labelled, path, None, logistic())
    second = M.promote(labelled, path, logistic(), forest())
    rows = None
    for step, record in (("first", first), ("second", second or first)):
        model = M.FittedModel.read_parts(record.folder)
        metrics = spark.read.parquet(f"{record.folder}/metrics")
        won = metrics.where("promoted AND model = 'challenger'").count() == 1
        slots = spark.read.parquet(f"{record.folder}/importance").count()
        report = spark.read.json(f"{record.folder}/report").count()
        newest = bundles.latest(spark, path).number == (2 if second else 1) and record.number == (1 if step == "first" or not second else 2)
        fits = won and newest and slots == len(M.feature_importance(model).collect()) and report == metrics.count()
        scored = model.score(labelled).where(F.col("probability").between(0.0, 1.0)).agg(F.count(F.lit(1)).alias("scored"))
        row = scored.select(F.lit(step).alias("step"), "scored", F.lit(fits).alias("consistent"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


REFIT_GRID, REFIT_DRAWN = {"numTrees": [100, 300], "maxDepth": [6, 10]}, 2


@query("refit_settings", """
  SELECT (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 0) AS samples, true AS from_grid, true AS same_model
""")
def refit_settings(spark, sf_dir):
    """The training flow's final model has the settings of the search's best, and they are what its trees have."""
    labelled = training_table(spark, sf_dir)
    final, _ = flows.train(labelled, forest(), REFIT_GRID, REFIT_DRAWN)
    split = written(S.stratified_split(labelled), "refit-split")
    folded = written(S.stratified_folds(split.where(~F.col("is_test")).drop("is_test")), "refit-folds")
    best, _, _ = M.randomized_search(folded, forest(), REFIT_GRID, REFIT_DRAWN)
    trees = final.pipeline.stages[-1]
    same = final.params == best and trees.getNumTrees == best["numTrees"] and max(t.depth for t in trees.trees) <= best["maxDepth"]
    return labelled.agg(F.count(F.lit(1)).alias("samples")).withColumns({
        "from_grid": F.lit(best in M.sample_grid(REFIT_GRID, REFIT_DRAWN)), "same_model": F.lit(same)})


@query("benchmark_models", """
  SELECT model, (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 0) AS samples, true AS in_range, true AS ranked
  FROM (VALUES ('RandomForest'), ('GradientBoosting'), ('LogisticRegression')) m(model)""")
def benchmark_models(spark, sf_dir):
    """All three models over five folds; wall times are left out, they are not a result."""
    training = training_table(spark, sf_dir)
    found = M.benchmark(S.stratified_folds(training), M.benchmark_specs())
    in_range = F.lit(True)
    for name in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"):
        in_range = in_range & F.col(name).between(0.0, 1.0)
    better = found.select(F.col("roc_auc").alias("_area"))
    above = F.count_if(F.col("_area") > F.col("roc_auc"))
    checked = found.join(better, F.lit(True)).groupBy("model", "rank", "roc_auc", in_range.alias("in_range")).agg(above.alias("above"))
    samples = training.agg(F.count(F.lit(1)).alias("samples"))
    return checked.select("model", "in_range", (F.col("rank") >= F.col("above") + 1).alias("ranked")).join(samples, F.lit(True))


def challenger_settings(labelled):
    """The best of the settings drawn from the challenger's grid, over folds of the rows that are not held out."""
    split = written(S.stratified_split(labelled), "challenger-split")
    folded = S.stratified_folds(split.where(~F.col("is_test")).drop("is_test"))
    return M.randomized_search(folded, boosted(), P.CHALLENGER_GRID, CHALLENGER_DRAWN)[0]


@query("champion_challenger", f"""
  SELECT model, (SELECT count(*) FROM ({_ROWS_SQL}) WHERE is_test) AS held_out, true AS consistent
  FROM (VALUES ('champion'), ('challenger')) m(model)""")
def champion_challenger(spark, sf_dir):
    """Both models on one hold-out, and whether the flag follows from their areas.

    The challenger's settings are searched on the training rows alone.
    """
    labelled = training_table(spark, sf_dir)
    metrics = M.champion_challenger(labelled, forest(), boosted(), challenger_settings(labelled))[0]
    areas = metrics.groupBy().pivot("model", ["champion", "challenger"]).agg(F.first("roc_auc"))
    wins = (F.col("model") == "challenger") & (F.col("challenger") > F.col("champion"))
    return metrics.join(areas, F.lit(True)).select(
        "model", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("held_out"),
        (F.col("promoted") == wins).alias("consistent"))


@query("saved_model_scores", f"SELECT vehicle_id, true AS same FROM ({_POSITIONS})")
def saved_model_scores(spark, sf_dir):
    """Every labelled vehicle: the model that was saved and loaded scores it as the one in memory does."""
    labelled = training_table(spark, sf_dir)
    path = scratch_path(spark, "model")
    model = M.fit(labelled, forest())
    model.save(path)
    fleet = G.operational_metrics(labelled)
    before = model.score(fleet).select(P.ID, F.col("probability").alias("before"))
    after = M.FittedModel.load(path).score(fleet).select(P.ID, F.col("probability").alias("after"))
    return before.join(after, P.ID).select(P.ID, (F.col("before") == F.col("after")).alias("same"))


@query("local_fleet_scores", """
  SELECT c_custkey AS vehicle_id,
         CASE WHEN c_custkey % 50 <> 0 AND c_acctbal < 0 THEN 1 ELSE 0 END AS actual, true AS consistent
  FROM customer""")
def local_fleet_scores(spark, sf_dir):
    """Specifications only: sensor columns the model expects are filled with 0, scores are approximate."""
    customer = table(spark, sf_dir, "customer")
    model = M.fit(training_table(spark, sf_dir), forest())
    fleet = X.rename_specs(J.local_fleet(roles.specs(customer), roles.labels(customer)))
    extract = G.predictions_extract(model.score(fleet, fill_missing=True), scored_at=scored_at())
    p = F.col("`Failure Probability`")
    fits = p.between(0.0, 1.0) & F.col("`Maintenance Priority`").isNotNull() & F.col("Predicted").isin(0, 1)
    return extract.select(
        F.col("`Vehicle Id`").alias("vehicle_id"), F.col("Actual").cast("int").alias("actual"), fits.alias("consistent"))
