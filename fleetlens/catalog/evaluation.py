"""Evaluation relations over three deterministic stand-in scorers of the customer fleet."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.catalog.fleet import labelled
from fleetlens.catalog.registry import query, rounded, rounded_sql
from fleetlens.catalog.scoring import IMPORTANCE_SQL, importance
from fleetlens.operators import evaluate as E
from fleetlens.operators import preprocess as X
from fleetlens.operators import reports as D
from fleetlens.operators import splits as S
from fleetlens.sources import roles
from fleetlens.sources.roles import table

STAMP = "2024-01-01 00:00:00"

_HASH = "CAST((c_custkey * 7919) % 10007 AS DOUBLE) / CAST(10007.0 AS DOUBLE)"
_MODELS = {
    "ledger": f"(CAST(9999.0 AS DOUBLE) - c_acctbal) / CAST(11000.0 AS DOUBLE) * CAST(0.5 AS DOUBLE) + {_HASH} * CAST(0.5 AS DOUBLE)",
    "hash": _HASH,
    "segment": "CAST((c_custkey * 31 + c_nationkey * 17) % 1009 AS DOUBLE) / CAST(1009.0 AS DOUBLE)",
}

_SCORES_SQL = " UNION ALL ".join(
    f"SELECT c_custkey AS vehicle_id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS in_study_repair, "
    f"'{name}' AS model, {sql} AS probability, CAST({sql} >= 0.5 AS INTEGER) AS predicted "
    f"FROM customer WHERE c_custkey % 50 <> 0"
    for name, sql in _MODELS.items()
)
_FOLDS_SQL = """
  SELECT c_custkey AS vehicle_id, CAST(row_number() OVER (PARTITION BY CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END
         ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) % 5 AS INTEGER) AS fold
  FROM customer WHERE c_custkey % 50 <> 0"""
_FOLDED_SQL = f"SELECT s.*, f.fold FROM ({_SCORES_SQL}) s JOIN ({_FOLDS_SQL}) f USING (vehicle_id)"
_ONE_SQL = f"SELECT * FROM ({_SCORES_SQL}) WHERE model = 'ledger'"


def model_scores(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 50 != 0)
    cells = F.array(*[F.struct(F.lit(n).alias("model"), F.expr(e).alias("probability")) for n, e in _MODELS.items()])
    scores = customer.select(
        F.col("c_custkey").alias("vehicle_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0)).alias(P.LABEL),
        F.inline(cells),
    )
    return E.predict_at(scores)


def folded_scores(spark, sf_dir):
    folds = S.stratified_folds(labelled(spark, sf_dir)).select("vehicle_id", "fold")
    return model_scores(spark, sf_dir).join(folds, "vehicle_id", "inner")


def one_model(spark, sf_dir):
    return model_scores(spark, sf_dir).where(F.col("model") == "ledger").drop("model")


def confusion_sql(relation: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    return f"""
      SELECT {keys}count(*) FILTER (WHERE in_study_repair = 0 AND predicted = 0) AS tn,
             count(*) FILTER (WHERE in_study_repair = 0 AND predicted = 1) AS fp,
             count(*) FILTER (WHERE in_study_repair = 1 AND predicted = 0) AS fn,
             count(*) FILTER (WHERE in_study_repair = 1 AND predicted = 1) AS tp
      FROM ({relation}){f" GROUP BY {by}" if by else ""}"""


def rates_sql() -> dict[str, str]:
    def safe(top: str, bottom: str) -> str:
        return f"CASE WHEN {bottom} <> 0 THEN ({top}) / ({bottom}) ELSE 0.0 END"

    return {
        "accuracy": safe("tp + tn", "(tn + fp + fn + tp)"), "precision": safe("tp", "(tp + fp)"),
        "recall": safe("tp", "(tp + fn)"), "f1": safe("2 * tp", "(2 * tp + fp + fn)"),
    }


def ranking_sql(relation: str, by: str = "") -> str:
    keys, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""
      SELECT {keys}CAST(sum(neg * (tp - pos / 2.0)) AS DOUBLE) / (sum(pos) * sum(neg)) AS roc_auc,
             sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / sum(pos) AS pr_auc
      FROM (SELECT *, sum(pos) OVER ({part}ORDER BY probability DESC) AS tp,
                   sum(neg) OVER ({part}ORDER BY probability DESC) AS fp
            FROM (SELECT {keys}probability, count(*) FILTER (WHERE in_study_repair = 1) AS pos,
                         count(*) FILTER (WHERE in_study_repair = 0) AS neg
                  FROM ({relation}) GROUP BY {keys}probability))
      {f"GROUP BY {by}" if by else ""}"""


def evaluation_sql(relation: str, by: str = "") -> str:
    rates = ", ".join(f"{sql} AS {name}" for name, sql in rates_sql().items())
    keys = ", ".join(f"c.{k.strip()}" for k in by.split(",")) + ", " if by else ""
    join = f"JOIN ({ranking_sql(relation, by)}) r USING ({by})" if by else f", ({ranking_sql(relation)}) r"
    return f"SELECT {keys}{rates}, roc_auc, pr_auc, tn, fp, fn, tp FROM ({confusion_sql(relation, by)}) c {join}"


_METRICS = E.METRICS


@query("threshold_predicate", f"SELECT vehicle_id, in_study_repair, probability, predicted FROM ({_ONE_SQL})")
def threshold_predicate(spark, sf_dir):
    return one_model(spark, sf_dir)


@query("confusion", f"SELECT *, tn + fp + fn + tp AS total FROM ({confusion_sql(_ONE_SQL)})")
def confusion(spark, sf_dir):
    return E.confusion(one_model(spark, sf_dir))


@query("evaluation", rounded_sql(evaluation_sql(_ONE_SQL), _METRICS))
def evaluation(spark, sf_dir):
    return rounded(E.evaluation(one_model(spark, sf_dir)))


@query("evaluation_by_fold", rounded_sql(evaluation_sql(_FOLDED_SQL, "model, fold"), _METRICS))
def evaluation_by_fold(spark, sf_dir):
    return rounded(E.evaluation(folded_scores(spark, sf_dir), by=["model", "fold"]))


_REPORT_SQL = f"""
  WITH c AS ({confusion_sql(_ONE_SQL)}),
  k AS (
    SELECT '0' AS class, tn AS own, fn AS wrong, fp AS missed FROM c
    UNION ALL SELECT '1', tp, fp, fn FROM c),
  r AS (
    SELECT class, CASE WHEN own + wrong <> 0 THEN own / (own + wrong) ELSE 0.0 END AS precision,
           CASE WHEN own + missed <> 0 THEN own / (own + missed) ELSE 0.0 END AS recall,
           CASE WHEN 2 * own + wrong + missed <> 0 THEN 2 * own / (2 * own + wrong + missed) ELSE 0.0 END AS f1_score,
           own + missed AS support FROM k)
  SELECT class, precision, recall, f1_score, support FROM r
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM r
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM r"""


@query("classification_report", rounded_sql(_REPORT_SQL, ("precision", "recall", "f1_score")))
def classification_report(spark, sf_dir):
    return rounded(E.classification_report(one_model(spark, sf_dir)))


_LEDGER_FOLDS_SQL = f"SELECT * FROM ({_FOLDED_SQL}) WHERE model = 'ledger'"


@query("full_report", rounded_sql(f"""
  SELECT r.*, c.* FROM ({_REPORT_SQL}) r, (
    SELECT {', '.join(f'avg({m}) AS cv_{m}' for m in _METRICS)} FROM ({evaluation_sql(_LEDGER_FOLDS_SQL, 'fold')})) c""",
    ("precision", "recall", "f1_score", *[f"cv_{m}" for m in _METRICS])))
def full_report(spark, sf_dir):
    """The complete report, flattened: a row per class and average, each with the cross-validated means."""
    folded = folded_scores(spark, sf_dir).where(F.col("model") == "ledger").drop("model")
    report = E.full_report(one_model(spark, sf_dir), folded)
    means = [F.col(f"cv_metrics.{m}").alias(f"cv_{m}") for m in _METRICS]
    return rounded(report.select(F.inline("classification_report"), *means))


_F2_SQL = "CASE WHEN 5 * tp + 4 * fn + fp <> 0 THEN 5 * tp / (5 * tp + 4 * fn + fp) ELSE 0.0 END"


def sweep_sql(relation: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    swept = f"""
      SELECT {keys}t AS threshold, count(*) FILTER (WHERE in_study_repair = 0 AND probability < t) AS tn,
             count(*) FILTER (WHERE in_study_repair = 0 AND probability >= t) AS fp,
             count(*) FILTER (WHERE in_study_repair = 1 AND probability < t) AS fn,
             count(*) FILTER (WHERE in_study_repair = 1 AND probability >= t) AS tp
      FROM ({relation}), (SELECT CAST(i AS DOUBLE) / 100.0 AS t FROM range(5, 55, 2) AS x(i)) GROUP BY {keys}t"""
    rates = ", ".join(f"round_even({rates_sql()[m]}, 4) AS {m}" for m in ("precision", "recall", "f1"))
    return f"SELECT {keys}threshold, tn, fp, fn, tp, {rates}, round_even({_F2_SQL}, 4) AS f2, {_F2_SQL} AS f2_exact FROM ({swept})"


def best_threshold_sql(relation: str, by: str = "") -> str:
    keys, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""
      SELECT {keys}threshold AS opt_threshold, f2 AS opt_f2, precision AS opt_precision, recall AS opt_recall,
             f1 AS opt_f1
      FROM (SELECT *, row_number() OVER ({part}ORDER BY f2_exact DESC, threshold) AS r
            FROM ({sweep_sql(relation, by)})) WHERE r = 1"""


@query("threshold_sweep", rounded_sql(sweep_sql(_ONE_SQL), ("f2_exact",)))
def threshold_sweep(spark, sf_dir):
    return rounded(E.threshold_sweep(one_model(spark, sf_dir)))


@query("best_threshold", best_threshold_sql(_ONE_SQL))
def best_threshold(spark, sf_dir):
    return E.best_threshold(E.threshold_sweep(one_model(spark, sf_dir)))


@query("f2_by_model", rounded_sql(f"SELECT model, {_F2_SQL} AS f2 FROM ({confusion_sql(_SCORES_SQL, 'model')})", ("f2",)))
def f2_by_model(spark, sf_dir):
    counts = E.confusion(model_scores(spark, sf_dir), by=["model"])
    return rounded(counts.select("model", E.f2(F.col("fp"), F.col("fn"), F.col("tp")).alias("f2")))


# --- model comparison -----------------------------------------------------------------------------

_BY_MODEL_SQL = evaluation_sql(_SCORES_SQL, "model")


def metrics_by_model(spark, sf_dir):
    return E.evaluation(model_scores(spark, sf_dir), by=["model"])


@query("fold_metric_means", rounded_sql(
    f"SELECT model, {', '.join(f'avg({m}) AS {m}' for m in _METRICS)} "
    f"FROM ({evaluation_sql(_FOLDED_SQL, 'model, fold')}) GROUP BY model", _METRICS))
def fold_metric_means(spark, sf_dir):
    return rounded(E.mean_over_folds(E.evaluation(folded_scores(spark, sf_dir), by=["model", "fold"])))


@query("model_ranking", rounded_sql(
    f"SELECT *, CAST(row_number() OVER (ORDER BY roc_auc DESC, model) AS INTEGER) AS rank FROM ({_BY_MODEL_SQL})",
    _METRICS))
def model_ranking(spark, sf_dir):
    return rounded(E.rank_models(metrics_by_model(spark, sf_dir)))


@query("model_deltas", rounded_sql(
    "SELECT model, " + ", ".join(
        f"{m} - first({m}) OVER (ORDER BY roc_auc DESC, model) AS delta_{m}" for m in _METRICS
    ) + f" FROM ({_BY_MODEL_SQL})", [f"delta_{m}" for m in _METRICS]))
def model_deltas(spark, sf_dir):
    return rounded(E.deltas_to_best(metrics_by_model(spark, sf_dir)))


@query("best_model", f"SELECT * FROM ({best_threshold_sql(_SCORES_SQL, 'model')}) ORDER BY opt_f2 DESC, model LIMIT 1")
def best_model(spark, sf_dir):
    return E.best_model(E.best_threshold(E.threshold_sweep(model_scores(spark, sf_dir), by=["model"]), by=["model"]))


@query("promotion", f"""
  SELECT model, round_even(roc_auc, 6) AS roc_auc,
         roc_auc > (SELECT roc_auc FROM ({_BY_MODEL_SQL}) WHERE model = 'hash') AS promoted
  FROM ({_BY_MODEL_SQL}) WHERE model <> 'hash'""")
def promotion(spark, sf_dir):
    """Challengers against the champion ``hash``: promoted on a strictly higher ROC AUC."""
    metrics = metrics_by_model(spark, sf_dir).select("model", "roc_auc", F.lit(1).alias("k"))
    champion = metrics.where(F.col("model") == "hash").select("k", F.col("roc_auc").alias("champion"))
    compared = metrics.where(F.col("model") != "hash").join(champion, "k", "left")
    return rounded(compared.select(
        "model", "roc_auc", (F.col("champion").isNull() | (F.col("roc_auc") > F.col("champion"))).alias("promoted")
    ))


# --- diagnostics ----------------------------------------------------------------------------------

_LABELS = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall", "f1": "F1 Score",
           "roc_auc": "ROC AUC", "pr_auc": "PR AUC"}
_COUNTS = {"tn": "True Negative", "fp": "False Positive", "fn": "False Negative", "tp": "True Positive"}


def metrics_long_sql(samples: str, features: str) -> str:
    rows = [f"SELECT '{label}' AS \"Metric\", CAST({c} AS VARCHAR) AS \"Value\" FROM m"
            for c, label in {**_LABELS, **_COUNTS}.items()]
    rows += [f"SELECT 'Training Samples', CAST({samples} AS VARCHAR) FROM m",
             f"SELECT 'Engineered Features', CAST({features} AS VARCHAR) FROM m",
             f"SELECT 'Hyperparameter Search', '{P.SEARCH_NAME}'", f"SELECT 'CV Folds', '{P.TRAIN.folds}'"]
    return f"""
      WITH m AS ({rounded_sql(evaluation_sql(_ONE_SQL), _METRICS)})
      SELECT "Metric", "Value", '{P.ALGORITHM_NAME}' AS "Algorithm", '{STAMP}' AS "Prediction Timestamp",
             '{P.MODEL_VERSION}' AS "Model Version"
      FROM ({" UNION ALL ".join(rows)})"""


@query("metrics_long", metrics_long_sql(
    "(SELECT count(*) FROM customer)", f"(SELECT count(*) FROM ({IMPORTANCE_SQL}))"))
def metrics_long(spark, sf_dir):
    return D.metrics_long(
        evaluation(spark, sf_dir), roles.specs(table(spark, sf_dir, "customer")), importance(spark, sf_dir),
        stamped_at=F.lit(STAMP),
    )


@query("metrics_long_fallback", metrics_long_sql("tn + fp + fn + tp", "0"))
def metrics_long_fallback(spark, sf_dir):
    """Neither specifications nor importance are available."""
    return D.metrics_long(evaluation(spark, sf_dir), stamped_at=F.lit(STAMP))


# --- preparation ----------------------------------------------------------------------------------

_GAPS_SQL = """
  SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN value END AS value,
         CASE WHEN event_id % 7 <> 0 THEN value * 2.0 + 1.0 END AS other,
         CASE WHEN event_id % 5 <> 0 THEN event_type END AS kind
  FROM events"""


def gappy(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 != 0, F.col("value") * 2.0 + 1.0).alias("other"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("kind"),
    )


@query("median_impute", rounded_sql(f"""
  SELECT event_id, coalesce(value, (SELECT median(value) FROM ({_GAPS_SQL}))) AS value,
         coalesce(other, (SELECT median(other) FROM ({_GAPS_SQL}))) AS other, kind
  FROM ({_GAPS_SQL})""", ("value", "other")))
def median_impute(spark, sf_dir):
    rows = gappy(spark, sf_dir)
    return rounded(X.impute(rows, X.fit_medians(rows, ["value", "other"])))


@query("constant_impute", f"SELECT event_id, value, other, coalesce(kind, 'missing') AS kind FROM ({_GAPS_SQL})")
def constant_impute(spark, sf_dir):
    return X.impute(gappy(spark, sf_dir), {}, ["kind"])


@query("scaled", rounded_sql(f"""
  SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value,
         (other - avg(other) OVER ()) / stddev_pop(other) OVER () AS other, kind
  FROM ({_GAPS_SQL})""", ("value", "other")))
def scaled(spark, sf_dir):
    rows = gappy(spark, sf_dir)
    return rounded(X.scale(rows, X.fit_scaler(rows, ["value", "other"])))


@query("category_cap", """
  WITH c AS (SELECT p_name, row_number() OVER (ORDER BY count(*) DESC, p_name) AS r, count(*) OVER () AS n
             FROM part GROUP BY p_name)
  SELECT p_partkey, p_brand, CASE WHEN n <= 50 OR r <= 49 THEN p_name ELSE 'infrequent' END AS p_name
  FROM part JOIN c USING (p_name)""")
def category_cap(spark, sf_dir):
    """``p_name`` has more than 50 values and is pooled; ``p_brand`` has not."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    return X.cap_categories(part, X.fit_category_cap(part, ["p_brand", "p_name"]))
