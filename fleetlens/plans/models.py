"""Spark ML pipelines: preparation, estimators, cross-validation, search, comparison.

Preparation follows one recipe: exact median imputation for numbers, ``missing`` plus one-hot for strings, unused
columns dropped. Imputation and weights are relational passes fitted on the training rows; the rest is a
``Pipeline`` whose stages Spark trains over partitions.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import random
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.operators import evaluate as E
from fleetlens.operators import preprocess as X
from fleetlens.operators import splits as S
from fleetlens.operators.reports import rank_importance
from fleetlens.plans import boosting as B
from fleetlens.plans import ensembles as T
from fleetlens.plans.parallel import MOST, side_by_side
from fleetlens.session import cores, ensure_checkpoint_dir
from fleetlens.sources import bundles
from fleetlens.sources.materialize import laid_out, written, written_bytes
from fleetlens.sources.writers import write_report

WEIGHT = "_weight"
# Training passes over its rows once per tree level; each pass has a task per so many written bytes, up to one for every
# core. A pass of a forest is one over all its trees, so far fewer rows are worth a task.
PASS_BYTES = 4 << 20
FOREST_BYTES = 128 << 10
# Written bytes that a core has in one partition before there are more partitions than cores.
ROWS_BYTES = 16 << 20


# --- weights and estimators -----------------------------------------------------------------------


def with_weight(df: DataFrame, scheme: str | float | None) -> DataFrame:
    """Row weights: ``balanced``, ``ratio`` (positives weigh negatives / positives), a fixed positive weight or none."""
    if scheme == "balanced":
        weights = {r[P.LABEL]: r["weight"] for r in S.balanced_weights(df).collect()}
        cell = F.lit(1.0)
        for value, weight in weights.items():
            cell = F.when(F.col(P.LABEL) == value, F.lit(weight)).otherwise(cell)
        return df.withColumn(WEIGHT, cell)
    if scheme == "ratio":
        scheme = S.class_ratio(df).first()[0]
    positive = 1.0 if scheme is None else float(scheme)
    return df.withColumn(WEIGHT, F.when(F.col(P.LABEL) == 1, F.lit(positive)).otherwise(F.lit(1.0)))


def _columns() -> dict:
    return {"featuresCol": "features", "labelCol": P.LABEL, "weightCol": WEIGHT}


def boosted_trees(train: P.TrainParams = P.TRAIN, step: float = 0.3) -> GBTClassifier:
    return GBTClassifier(
        maxIter=train.trees, maxDepth=train.depth, minInstancesPerNode=train.min_leaf, stepSize=step,
        seed=train.seed, checkpointInterval=10, **_columns(),
    )


def random_forest(train: P.TrainParams = P.TRAIN) -> RandomForestClassifier:
    """The node that a row has come to in each tree is kept beside it; every pass would walk all trees from their roots."""
    return RandomForestClassifier(
        numTrees=train.trees, maxDepth=train.depth, minInstancesPerNode=train.min_leaf, seed=train.seed,
        checkpointInterval=10, cacheNodeIds=True, **_columns(),
    )


def _is_forest(spec: ModelSpec) -> bool:
    return isinstance(spec.estimator(), RandomForestClassifier)


def _abreast(rows: DataFrame, *specs: ModelSpec) -> int:
    """How many fits over most of ``rows``, a written relation, run side by side.

    A forest keeps its rows with a draw and a node for every tree, so together they have ROWS_BYTES a core at most;
    a single one of more rows than that keeps every core busy by itself.
    """
    if not any(map(_is_forest, specs)):
        return MOST
    return max(1, min(MOST, cores(rows.sparkSession) * ROWS_BYTES // max(1, written_bytes(rows))))


def logistic_regression(iterations: int = 2000) -> LogisticRegression:
    """L2 strength is left open: ``fit`` sets it to 1 / sum of weights, a unit penalty against the sum of losses.

    Spark's tolerance is on the change of the loss, so it is small here; ``largest_slope`` tells whether the fit is at
    its minimum.
    """
    return LogisticRegression(
        maxIter=iterations, tol=1e-10, elasticNetParam=0.0, standardization=False, **_columns()
    )


@dataclass(frozen=True)
class ModelSpec:
    """A named estimator with its weighting and preparation variant."""

    name: str
    estimator: Callable[[], object]
    weight: str | float | None = None
    scaled: bool = False
    max_categories: int | None = None


# Settings of the benchmark's boosting model.
BOOSTING = P.TrainParams(trees=100, depth=6)


def benchmark_specs(train: P.TrainParams = P.TRAIN, boosting: P.TrainParams = BOOSTING) -> list[ModelSpec]:
    """The three compared models; both tree models take their settings as given."""
    return [
        ModelSpec("RandomForest", lambda: random_forest(train), weight=5.0),
        ModelSpec("GradientBoosting", lambda: boosted_trees(boosting, step=0.1)),
        ModelSpec("LogisticRegression", logistic_regression, weight="balanced", scaled=True, max_categories=50),
    ]


# --- preparation and fitting ----------------------------------------------------------------------


@dataclass
class FittedModel:
    """Imputation values plus a fitted pipeline; saved and loaded together."""

    medians: dict[str, float | None]
    categorical: list[str]
    kept: dict[str, list[str]]
    pipeline: PipelineModel
    params: dict = field(default_factory=dict)

    def input_columns(self) -> dict[str, str]:
        """Every column the model reads, with its type."""
        return {**dict.fromkeys(self.medians, "double"), **dict.fromkeys(self.categorical, "string")}

    def prepare(self, df: DataFrame) -> DataFrame:
        return X.cap_categories(X.impute(df, self.medians, self.categorical), self.kept)

    def score(self, df: DataFrame, threshold: float = 0.5, fill_missing: bool = False) -> DataFrame:
        """``df`` plus ``probability`` of class 1 and the 0/1 ``predicted`` label; input columns keep their values.

        Columns the model reads and ``df`` lacks are an error, or zeros with ``fill_missing``.
        """
        from fleetlens.operators.scoring import fill_missing_columns

        inputs = self.input_columns()
        absent = sorted(set(inputs) - set(df.columns))
        if absent and not fill_missing:
            raise ValueError(f"columns the model reads are absent: {', '.join(absent[:10])}")
        original = {c: f"_in_{c}" for c in inputs if c in df.columns}
        kept_aside = df.withColumns({alias: F.col(f"`{c}`") for c, alias in original.items()})
        scored = self.pipeline.transform(self.prepare(fill_missing_columns(kept_aside, inputs)))
        probability = vector_to_array("probability")[1]
        return scored.select(
            *[F.col(original[c]).alias(c) if c in original else F.col(c) for c in df.columns],
            probability.alias("probability"), (probability >= F.lit(threshold)).cast("int").alias("predicted"),
        )

    def first_trees(self, trees: int) -> FittedModel:
        """The model after ``trees`` rounds of boosting."""
        stages = self.pipeline.stages
        return FittedModel(
            self.medians, self.categorical, self.kept,
            PipelineModel([*stages[:-1], T.first_trees(stages[-1], trees)]), {**self.params, "maxIter": trees})

    def features(self, df: DataFrame) -> DataFrame:
        """``df`` with the vector ``features`` that the estimator reads."""
        return PipelineModel(self.pipeline.stages[:-1]).transform(self.prepare(df))

    def write_parts(self, folder: str) -> None:
        """The pipeline and what preparation needs, below ``folder``."""
        spark = SparkSession.active()
        self.pipeline.write().save(f"{folder}/pipeline")
        meta = json.dumps({
            "medians": self.medians, "categorical": self.categorical, "kept": self.kept, "params": self.params,
        })
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{folder}/preparation")

    def save(self, path: str) -> str:
        """Write a new version below ``path`` and make it the current one; earlier versions stay.

        A version counts only once its record is there, after all of its parts, so a save that breaks off leaves the
        model that was there, and of two savers each gets a number of its own. Returns the version's folder.
        """
        return bundles.publish(SparkSession.active(), path, self.write_parts).folder

    @staticmethod
    def versions(path: str) -> list[str]:
        """Folders of the complete versions below ``path``, oldest first."""
        return [record.folder for record in bundles.records(SparkSession.active(), path)]

    @staticmethod
    def load(path: str, back: int = 0) -> FittedModel:
        """The current model at ``path``, or the one ``back`` versions before it; a missing model is an error."""
        folders = FittedModel.versions(path)
        if len(folders) <= back:
            raise FileNotFoundError(f"no model at {path}")
        return FittedModel.read_parts(folders[-1 - back])

    @staticmethod
    def read_parts(folder: str) -> FittedModel:
        meta = json.loads(SparkSession.active().read.text(f"{folder}/preparation").first()[0])
        return FittedModel(
            meta["medians"], meta["categorical"], meta["kept"], PipelineModel.load(f"{folder}/pipeline"), meta["params"]
        )

    @staticmethod
    def load_or_none(path: str) -> FittedModel | None:
        return FittedModel.load(path) if FittedModel.versions(path) else None


def _stages(categorical: Sequence[str], numeric: Sequence[str], scaled: bool) -> list:
    """Unseen categories encode to all zeros: the indexer's extra slot is the one the encoder drops."""
    stages, inputs = [], []
    if numeric:
        out = "_numbers"
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol=out, handleInvalid="keep"))
        if scaled:
            stages.append(StandardScaler(inputCol=out, outputCol="_scaled", withMean=True, withStd=True))
            out = "_scaled"
        inputs.append(out)
    if categorical:
        indexed, encoded = [f"_index_{c}" for c in categorical], [f"_hot_{c}" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded))
        inputs += encoded
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def one_hot(fitted_on: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with a ``features`` vector of one-hot ``columns``; categories come from ``fitted_on``."""
    known = X.impute(fitted_on, {}, columns)
    return Pipeline(stages=_stages(columns, [], False)).fit(known).transform(X.impute(df, {}, columns))


def _preparation(df: DataFrame, spec: ModelSpec) -> tuple[dict, list[str], dict]:
    categorical, numeric = X.column_kinds(df, (*P.NON_FEATURES, WEIGHT, "fold", "is_test"))
    medians = X.fit_medians(df, numeric) if numeric else {}
    medians = {c: m for c, m in medians.items() if m is not None}
    kept = X.fit_category_cap(df, categorical, spec.max_categories) if spec.max_categories and categorical else {}
    return medians, categorical, kept


@dataclass
class _Prepared:
    """Preparation fitted on training rows, and those rows as vectors, written once for all passes of training."""

    medians: dict[str, float | None]
    categorical: list[str]
    kept: dict[str, list[str]]
    features: PipelineModel
    rows: DataFrame
    cuts: B.Cuts | None = None

    def model(self, spec: ModelSpec, params: dict | None = None) -> FittedModel:
        estimator = spec.estimator()
        if params:
            estimator = estimator.copy({estimator.getParam(k): v for k, v in params.items()})
        if isinstance(estimator, LogisticRegression) and not estimator.isSet("regParam"):
            estimator.setRegParam(1.0 / max(1e-300, self.rows.agg(F.sum(WEIGHT)).first()[0] or 1.0))
        boosted = isinstance(estimator, GBTClassifier)
        classifier = B.fit(estimator, self.rows, self.cuts) if boosted else estimator.fit(self.rows)
        pipeline = PipelineModel([*self.features.stages, classifier])
        return FittedModel(self.medians, self.categorical, self.kept, pipeline, dict(params or {}))


def _prepare(df: DataFrame, spec: ModelSpec) -> _Prepared:
    ensure_checkpoint_dir(df.sparkSession)
    medians, categorical, kept = _preparation(df, spec)
    prepared = X.cap_categories(X.impute(df, medians, categorical), kept)
    features = Pipeline(stages=_stages(categorical, list(medians), spec.scaled)).fit(prepared)
    weighted = features.transform(with_weight(prepared, spec.weight)).select("features", P.LABEL, WEIGHT)
    least = FOREST_BYTES if _is_forest(spec) else PASS_BYTES
    rows, estimator = laid_out(weighted, "training-rows", least, ROWS_BYTES), spec.estimator()
    cuts = B.find_cuts(estimator, rows) if isinstance(estimator, GBTClassifier) else None
    return _Prepared(medians, categorical, kept, features, rows, cuts)


def fit(df: DataFrame, spec: ModelSpec, params: dict | None = None) -> FittedModel:
    """Fit preparation and estimator on labelled rows. Columns without any value are left out."""
    return _prepare(df, spec).model(spec, params)


# --- cross-validation, search, threshold ----------------------------------------------------------


def _fold_numbers(folded: DataFrame) -> list[int]:
    return sorted(r[0] for r in folded.select("fold").distinct().collect())


def _fold_scores(folded: DataFrame, spec: ModelSpec, params: dict | None, k: int) -> DataFrame:
    """Scores of one fold, written, so that no plan holds the trees of more than one fit."""
    model = fit(folded.where(F.col("fold") != k).drop("fold"), spec, params)
    scored = model.score(folded.where(F.col("fold") == k))
    return written(scored.select(P.ID, P.LABEL, "fold", "probability", "predicted"), "fold-scores")


def out_of_fold(folded: DataFrame, spec: ModelSpec, params: dict | None = None) -> DataFrame:
    """Score each row with the model that did not train on its ``fold``. The folds are fitted side by side."""
    folded = written(folded, "folds")
    parts = side_by_side(folded.sparkSession, [
        functools.partial(_fold_scores, folded, spec, params, k) for k in _fold_numbers(folded)], _abreast(folded, spec))
    return functools.reduce(DataFrame.unionByName, parts)


def cross_validated_metrics(folded: DataFrame, spec: ModelSpec, params: dict | None = None) -> DataFrame:
    """One row: the six metrics averaged over the folds, with the model name."""
    return _mean_metrics(out_of_fold(folded, spec, params), spec)


def _mean_metrics(scored: DataFrame, spec: ModelSpec) -> DataFrame:
    return E.mean_over_folds(E.evaluation(scored, by=["fold"]).withColumn("model", F.lit(spec.name)))


TREE_GRID, CHALLENGER_GRID = P.TREE_GRID, P.CHALLENGER_GRID


def sample_grid(grid: dict[str, list], n: int, seed: int = P.TRAIN.seed) -> list[dict]:
    """``n`` distinct settings drawn without replacement; the whole grid when it is smaller."""
    names = sorted(grid)
    everything = list(itertools.product(*[grid[k] for k in names]))
    chosen = random.Random(seed).sample(everything, min(n, len(everything)))
    return [dict(zip(names, values)) for values in chosen]


def _staged(settings: Sequence[dict]) -> list[tuple[dict, dict[int, list[int]]]]:
    """Settings that differ in their number of rounds only, as one: the longest, and which settings want how many."""
    groups: dict[tuple, dict[int, list[int]]] = {}
    for number, setting in enumerate(settings):
        others = tuple(sorted((k, v) for k, v in setting.items() if k != "maxIter"))
        groups.setdefault(others, {}).setdefault(setting.get("maxIter", 0), []).append(number)
    return [({**dict(others), **({"maxIter": max(rounds)} if max(rounds) else {})}, rounds) for others, rounds in groups.items()]


def randomized_search(
    folded: DataFrame, spec: ModelSpec, grid: dict[str, list], n: int, seed: int = P.TRAIN.seed
) -> tuple[dict, float, list[tuple[dict, float]]]:
    """Best setting, its mean ROC AUC and every sampled setting with its score.

    Imputation, categories, scaling and weights are fitted inside each fold, on its training rows alone, and shared by
    the settings. Boosted settings that differ in ``maxIter`` alone are one fit a fold, scored after as many trees as
    each of them asks for. Fits run side by side. The areas are exact. Nothing is refitted on all rows; ``fit`` does
    that where it is wanted.
    """
    settings = sample_grid(grid, n, seed)
    folded = written(folded, "search-folds")
    spark, folds = folded.sparkSession, _fold_numbers(folded)
    prepared = dict(zip(folds, side_by_side(spark, [
        functools.partial(_prepare, folded.where(F.col("fold") != k).drop("fold"), spec) for k in folds])))
    boosted = isinstance(spec.estimator(), GBTClassifier)
    stages = _staged(settings) if boosted else [(s, {0: [i]}) for i, s in enumerate(settings)]

    def scores(k: int, longest: dict, rounds: dict[int, list[int]]) -> list[DataFrame]:
        model = prepared[k].model(spec, longest)
        test, parts = folded.where(F.col("fold") == k), []
        for trees, numbers in rounds.items():
            part = (model.first_trees(trees) if trees else model).score(test).select(P.LABEL, "probability", "predicted")
            # Written at once, so that no plan holds the trees of more than one setting.
            parts.append(written(part.withColumns({
                "fold": F.lit(k), "setting": F.explode(F.array(*[F.lit(i) for i in numbers]))}), "search-scores"))
        return parts

    # The longest fits first, so that none of them is left over at the end.
    tasks = [(k, longest, rounds) for longest, rounds in sorted(
        stages, key=lambda s: -s[0].get("maxIter", 0) * s[0].get("maxDepth", 1)) for k in folds]
    done = side_by_side(spark, [functools.partial(scores, *t) for t in tasks], _abreast(folded, spec))
    scored = [part for parts in done for part in parts]
    everything = functools.reduce(DataFrame.unionByName, scored)
    areas = E.ranking_metrics(everything, by=["setting", "fold"]).groupBy("setting").agg(F.avg("roc_auc").alias("roc_auc"))
    means = {r["setting"]: r["roc_auc"] for r in areas.collect()}
    found = [(setting, means.get(number)) for number, setting in enumerate(settings)]
    best, score = max(found, key=lambda pair: -1.0 if pair[1] is None else pair[1])
    return best, score, found


def optimal_threshold(df: DataFrame, spec: ModelSpec, params: dict | None = None) -> DataFrame:
    """Best F2 threshold on a stratified hold-out of labelled rows."""
    split = written(S.stratified_split(df), "threshold-split")
    model = fit(split.where(~F.col("is_test")).drop("is_test"), spec, params)
    held_out = model.score(split.where("is_test").drop("is_test"))
    return E.best_threshold(E.threshold_sweep(held_out))


# --- importance -----------------------------------------------------------------------------------


def _slot_names(model: FittedModel) -> list[tuple[int, str]]:
    """(slot, name) of the feature vector, from its metadata."""
    spark = SparkSession.active()
    empty = spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in model.input_columns().items()))
    transformed = PipelineModel(model.pipeline.stages[:-1]).transform(empty)
    groups = transformed.schema["features"].metadata["ml_attr"]["attrs"]
    attributes = sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])
    numeric = list(model.medians)

    def name_of(attribute: dict) -> str:
        name = attribute["name"]
        for prefix in ("_hot_", "_numbers_", "_scaled_"):
            if name.startswith(prefix):
                tail = name[len(prefix):]
                return numeric[int(tail)] if prefix != "_hot_" and tail.isdigit() else tail
        return name

    return [(a["idx"], name_of(a)) for a in attributes]


def split_importance(model: FittedModel) -> DataFrame:
    """(feature, importance) by the share of the ensemble's splits that ask for a feature, counted on its node table."""
    spark = SparkSession.active()
    counts = T.split_counts(T.node_table(model.pipeline.stages[-1]))
    total = counts.agg(F.sum("splits").alias("total"))
    names = spark.createDataFrame(_slot_names(model), "slot int, name string")
    splits = F.coalesce(F.col("splits"), F.lit(0))
    return names.join(counts, F.col("slot") == F.col("feature"), "left").crossJoin(F.broadcast(total)).select(
        F.col("name").alias("feature"), F.coalesce(splits / F.col("total"), F.lit(0.0)).alias("importance"))


def feature_importance(model: FittedModel) -> DataFrame:
    """(feature, importance) named from the vector metadata; one row per vector slot.

    A tree model reports gains, or shares of splits where no split has a gain; a linear model reports the size of its
    coefficients.
    """
    classifier = model.pipeline.stages[-1]
    by_gain = hasattr(classifier, "featureImportances")
    weights = classifier.featureImportances if by_gain else classifier.coefficients
    if by_gain and not any(weights.toArray()):
        return split_importance(model)
    rows = [(name, float(abs(weights[slot]))) for slot, name in _slot_names(model)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def largest_slope(model: FittedModel, rows: DataFrame) -> float:
    """The largest component of the gradient of the logistic loss at the model's coefficients, over its training rows.

    The loss is the weighted mean of the rows' losses and half of ``regParam`` times the squared coefficients, without
    the intercept. Zero means that no change of the coefficients lowers it. One pass: vectors are summed whole where
    the rows are, those that pull up and those that pull down on their own, as weights of a sum are not negative; a
    task sends two vectors on. NaN where a row's loss has no slope.
    """
    fitted = model.pipeline.stages[-1]
    total = rows.agg(F.sum(WEIGHT)).first()[0]
    if not total:
        return 0.0
    claimed = fitted.transform(rows.select("features", P.LABEL, WEIGHT))
    off = F.col(WEIGHT) * (vector_to_array(fitted.getProbabilityCol())[1] - F.col(P.LABEL)) / total
    sized = claimed.select("features", off.alias("off")).where("off <> 0").withColumn("size", F.nanvl(F.abs("off"), F.lit(0.0)))
    halves = sized.groupBy(F.when(F.col("off") < 0, -1.0).otherwise(1.0).alias("sign")).agg(
        F.count_if(F.isnan("off")).alias("unknown"), F.sum("size").alias("sizes"),
        Summarizer.sum(F.col("features"), F.col("size")).alias("cells")).collect()
    if any(half["unknown"] for half in halves):
        return math.nan
    slopes = fitted.getRegParam() * fitted.coefficients.toArray()
    for half in halves:
        slopes = slopes + half["sign"] * half["cells"].toArray()
    # The intercept is a slot whose cell is always one.
    intercept = sum(half["sign"] * half["sizes"] for half in halves)
    return float(max(abs(slopes).max(initial=0.0), abs(intercept)))


# --- comparison -----------------------------------------------------------------------------------


@dataclass
class Comparison:
    """Metrics of both models on one hold-out with the flag ``promoted``, the fitted challenger, and the decision."""

    metrics: DataFrame
    challenger: FittedModel
    promoted: bool


def compare_models(
    df: DataFrame, champion: ModelSpec | None, challenger: ModelSpec, challenger_params: dict | None = None
) -> Comparison:
    """Both models on one hold-out.

    Both train on the same training rows, side by side. The challenger wins with a strictly higher ROC AUC, or without
    a champion.
    """
    split = written(S.stratified_split(df), "comparison-split")
    train, test = split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")
    roles = [r for r in (("champion", champion, None), ("challenger", challenger, challenger_params)) if r[1] is not None]
    models = side_by_side(
        df.sparkSession, [functools.partial(fit, train, spec, params) for _, spec, params in roles],
        _abreast(split, *[spec for _, spec, _ in roles]))
    scored = functools.reduce(DataFrame.unionByName, [
        written(model.score(test).select(P.ID, P.LABEL, "probability", "predicted"), "hold-out-scores")
        .withColumn("model", F.lit(role)) for model, (role, _, _) in zip(models, roles)])
    metrics = E.evaluation(scored, by=["model"])
    areas = {r["model"]: r["roc_auc"] for r in metrics.select("model", "roc_auc").collect()}
    promoted = champion is None or (areas["challenger"] or 0.0) > (areas["champion"] or 0.0)
    flagged = metrics.withColumn("promoted", (F.col("model") == "challenger") & F.lit(promoted))
    return Comparison(flagged, models[-1], promoted)


def champion_challenger(
    df: DataFrame, champion: ModelSpec | None, challenger: ModelSpec, challenger_params: dict | None = None
) -> tuple[DataFrame, bool]:
    """Metrics of both models on one hold-out, and whether the challenger is promoted."""
    found = compare_models(df, champion, challenger, challenger_params)
    return found.metrics, found.promoted


def promote(
    df: DataFrame, path: str, champion: ModelSpec | None, challenger: ModelSpec, challenger_params: dict | None = None
) -> bundles.Record | None:
    """Compare, and publish the challenger at ``path`` if it wins: model, metrics, importance and report as one bundle.

    The challenger is refitted on all labelled rows before it is published, as the model that was there was. What was
    there stays as the version before. The bundle appears with its record, after all of its parts; if another bundle
    was published since this comparison began, nothing is, and ``bundles.Conflict`` is raised. None if it does not win.
    """
    spark = df.sparkSession
    before = bundles.latest(spark, path)
    found = compare_models(df, champion, challenger, challenger_params)
    if not found.promoted:
        return None
    final = fit(df, challenger, challenger_params)

    def parts(folder: str) -> None:
        final.write_parts(folder)
        found.metrics.write.parquet(f"{folder}/metrics")
        rank_importance(feature_importance(final)).write.parquet(f"{folder}/importance")
        write_report(found.metrics, f"{folder}/report")

    return bundles.publish(
        spark, path, parts, {"model": challenger.name, "params": challenger_params or {}}, expected=before.number if before else 0)


def benchmark(folded: DataFrame, specs: Sequence[ModelSpec]) -> DataFrame:
    """Cross-validated metrics, best F2 threshold and time of the fits per model, ranked by ROC AUC.

    The folds and thresholds of all models are fitted side by side; a model's time is the sum of its folds' times.
    """
    folded = written(folded, "benchmark-folds")
    spark, folds = folded.sparkSession, _fold_numbers(folded)

    def timed(spec: ModelSpec, k: int) -> tuple[DataFrame, float]:
        started = time.monotonic()
        return _fold_scores(folded, spec, None, k), time.monotonic() - started

    def threshold(spec: ModelSpec) -> dict:
        return optimal_threshold(folded.drop("fold"), spec).first().asDict()

    tasks = [functools.partial(timed, spec, k) for spec in specs for k in folds]
    tasks += [functools.partial(threshold, spec) for spec in specs]
    done = side_by_side(spark, tasks, _abreast(folded, *specs))
    results = None
    for number, spec in enumerate(specs):
        parts = done[number * len(folds):(number + 1) * len(folds)]
        scored = functools.reduce(DataFrame.unionByName, [part for part, _ in parts])
        metrics = _mean_metrics(scored, spec).first().asDict()
        row = {**metrics, **done[len(specs) * len(folds) + number], "train_time_s": round(sum(t for _, t in parts), 1)}
        schema = "model string, " + ", ".join(f"{k} double" for k in row if k != "model")
        one = spark.createDataFrame([[row["model"], *[v for k, v in row.items() if k != "model"]]], schema)
        results = one if results is None else results.unionByName(one)
    return E.rank_models(results)
