"""Model scores as aggregations: classification (accuracy, precision, recall,
F1 -- binary or macro), regression (MSE, RMSE, MAE, R2, max error, median
absolute error, MAPE) and cross-validation summaries. Each is one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .quantiles import global_quantiles
from .ranks import running_total

CLASSIFICATION = ["accuracy", "precision", "recall", "f1"]
AVERAGES = ["macro", "micro", "weighted"]
ALL_CLASSIFICATION = [*CLASSIFICATION, *(f"{m}_{a}" for a in AVERAGES for m in ("precision", "recall", "f1")),
                      "matthews_corrcoef"]
PROBABILISTIC = ["balanced_accuracy", "log_loss", "roc_auc"]
ALL_PROBABILISTIC = [*PROBABILISTIC, "brier_score_loss"]
EPS = 2.220446049250313e-16  # probability clipping for log loss (float64 machine epsilon)
REGRESSION = ["mse", "rmse", "neg_root_mean_squared_error", "mae", "r2", "max_error",
              "median_absolute_error", "mape"]
ALL_REGRESSION = [*REGRESSION, "explained_variance", "mean_squared_log_error", "root_mean_squared_log_error"]

#: public score names -> names used here; each keeps its own meaning
ALIASES = {"accuracy_score": "accuracy", "precision_score": "precision", "recall_score": "recall", "f1_score": "f1",
           "balanced_accuracy_score": "balanced_accuracy", "roc_auc_score": "roc_auc",
           "mean_squared_error": "mse", "root_mean_squared_error": "rmse", "mean_absolute_error": "mae",
           "r2_score": "r2", "mean_absolute_percentage_error": "mape", "explained_variance_score": "explained_variance",
           "brier_score": "brier_score_loss"}
#: scores of which less is better; "neg_" before one of their names (or aliases) turns the sign
LOSSES = ["log_loss", "brier_score_loss", "mse", "rmse", "mae", "max_error", "median_absolute_error", "mape",
          "mean_squared_log_error", "root_mean_squared_log_error"]
_FAMILIES = {"class": ALL_CLASSIFICATION, "probability": ALL_PROBABILISTIC, "error": ALL_REGRESSION}


def meaning(name: str) -> tuple[str, str, int]:
    """(family, score, sign) of a public score name; unknown names raise ValueError."""
    score, sign = ALIASES.get(name, name), 1
    if name.startswith("neg_") and ALIASES.get(name[4:], name[4:]) in LOSSES:
        score, sign = ALIASES.get(name[4:], name[4:]), -1
    for family, known in _FAMILIES.items():
        if score in known:
            return family, score, sign
    known = sorted({*ALL_CLASSIFICATION, *ALL_PROBABILISTIC, *ALL_REGRESSION, *ALIASES, *(f"neg_{x}" for x in LOSSES)})
    raise ValueError(f"unknown metric {name!r}; known: {known}")


def larger_is_better(name: str) -> bool:
    """Whether the model with the larger value of this score is the better one."""
    _, score, sign = meaning(name)
    return (score not in LOSSES) or sign < 0


def _safe(num, den):
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def _class_scores(df: DataFrame, label: str, prediction: str, positive=None) -> DataFrame:
    """All classification scores, long form, from one confusion table."""
    zero = F.lit(0).cast("long")
    conf = (df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("y"), F.col(prediction).alias("p"))
              .agg(F.count(F.lit(1)).alias("n")))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero)
    kind = conf.schema["y"].dataType
    sides = F.array(F.struct(F.col("y").cast(kind).alias("c"), hit.alias("tp"), F.col("n").alias("tc"), zero.alias("pc")),
                    F.struct(F.col("p").cast(kind).alias("c"), zero.alias("tp"), zero.alias("tc"), F.col("n").alias("pc")))
    per = (conf.select(F.explode(sides).alias("s")).select("s.*").where(F.col("c").isNotNull())
               .groupBy("c").agg(*[F.sum(x).cast("double").alias(x) for x in ("tp", "tc", "pc")]))
    per = per.withColumn("precision", _safe(F.col("tp"), F.col("pc"))).withColumn("recall", _safe(F.col("tp"), F.col("tc")))
    per = per.withColumn("f1", _safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))

    def plain(x):
        return F.avg(x) if positive is None else F.coalesce(
            F.max(F.when(F.col("c") == F.lit(positive), F.col(x))), F.lit(0.0))
    tp, tc, pc = (F.sum(x) for x in ("tp", "tc", "pc"))
    three = ("precision", "recall", "f1")
    spread = F.sqrt(tc * tc - F.sum(F.col("pc") * F.col("pc"))) * F.sqrt(tc * tc - F.sum(F.col("tc") * F.col("tc")))
    return per.agg(
        F.try_divide(tp, tc).alias("accuracy"), *[plain(x).alias(x) for x in three],
        *[F.avg(x).alias(f"{x}_macro") for x in three],
        F.try_divide(tp, pc).alias("precision_micro"), F.try_divide(tp, tc).alias("recall_micro"),
        F.try_divide(2 * tp, pc + tc).alias("f1_micro"),
        *[F.try_divide(F.sum(F.col(x) * F.col("tc")), tc).alias(f"{x}_weighted") for x in three],
        F.coalesce(F.try_divide(tp * tc - F.sum(F.col("pc") * F.col("tc")), spread), F.lit(0.0)).alias("matthews_corrcoef"),
    ).unpivot([], ALL_CLASSIFICATION, "metric", "value")


def classification_metrics(df: DataFrame, label: str, prediction: str,
                           positive=None) -> DataFrame:
    """Long form ``(metric, value)``. With ``positive`` the binary scores of
    that class; otherwise macro averages over the classes seen in either
    column. 0/0 scores are 0.0. A row without a prediction is a wrong answer; a
    row without a label is not scored. All scores come from one confusion
    table, so the input is computed once."""
    return _class_scores(df, label, prediction, positive).where(F.col("metric").isin(CLASSIFICATION))


def _error_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    pairs = materialize(df.select(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p"))
                          .where("y IS NOT NULL AND p IS NOT NULL"), "scored-pairs")
    e, y = F.col("p") - F.col("y"), F.col("y")
    logs = F.log1p("p") - F.log1p("y")
    s = pairs.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                  F.max(F.abs(e)).alias("max_error"),
                  F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))).alias("mape"),
                  F.sum(e * e).alias("ss_res"), (F.var_pop(y) * F.count(y)).alias("ss_tot"),
                  F.var_pop(e).alias("v_res"), F.var_pop(y).alias("v_tot"),
                  F.when(F.min(F.least("y", "p")) >= 0, F.avg(logs * logs)).alias("mean_squared_log_error"))
    medae = global_quantiles(pairs.select(F.abs(e).alias("ae")), "ae", {"m": 0.5})["m"]

    def share(res, tot):  # 1 - res / tot; of a constant label 1 for exact predictions, else 0
        return F.when(F.col(tot) == 0, F.when(F.col(res) == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(res, tot))
    s = s.select("mse", F.sqrt("mse").alias("rmse"), (-F.sqrt("mse")).alias("neg_root_mean_squared_error"),
                 "mae", share("ss_res", "ss_tot").alias("r2"),
                 "max_error", F.lit(medae).cast("double").alias("median_absolute_error"), "mape",
                 share("v_res", "v_tot").alias("explained_variance"), "mean_squared_log_error",
                 F.sqrt("mean_squared_log_error").alias("root_mean_squared_log_error"))
    return s.unpivot([], ALL_REGRESSION, "metric", "value")


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long form ``(metric, value)`` over the rows that have a label and a
    prediction; the median absolute error is exact. With a constant label R2 is
    1 for exact predictions, else 0; without any row every score is null. The
    logarithmic errors (by name) are null when a value is negative."""
    return _error_scores(df, label, prediction).where(F.col("metric").isin(REGRESSION))


def _probability_scores(df: DataFrame, label: str, prediction: str, probability: str, positive=1) -> DataFrame:
    y = (F.col(label) == F.lit(positive)).cast("double")
    counts = materialize(df.where(F.col(label).isNotNull()).groupBy(
        y.alias("y"), F.coalesce(F.col(prediction) == F.col(label), F.lit(False)).cast("double").alias("hit"),
        F.col(probability).cast("double").alias("pr")).agg(F.count(F.lit(1)).alias("n")), "score-counts")
    p = F.least(F.greatest(F.col("pr"), F.lit(EPS)), F.lit(1 - EPS))
    loss = -(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))
    off = (F.col("pr") - F.col("y")) * (F.col("pr") - F.col("y"))
    known = F.when(F.col("pr").isNotNull(), F.col("n"))
    s = counts.agg(
        F.try_divide(F.sum(loss * F.col("n")), F.sum(known)).alias("log_loss"),
        F.try_divide(F.sum(off * F.col("n")), F.sum(known)).alias("brier_score_loss"),
        F.try_divide(F.sum(F.col("hit") * F.col("y") * F.col("n")), F.sum(F.col("y") * F.col("n"))).alias("tpr"),
        F.try_divide(F.sum(F.col("hit") * (1 - F.col("y")) * F.col("n")), F.sum((1 - F.col("y")) * F.col("n"))).alias("tnr"))
    per = counts.where("pr IS NOT NULL").groupBy("pr").agg(
        F.sum(F.col("y") * F.col("n")).alias("pos"), F.sum((1 - F.col("y")) * F.col("n")).alias("neg"))
    auc = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    ranked = running_total(per.withColumn("all", F.col("pos") + F.col("neg")), [F.col("pr")], "all", "before")
    u = ranked.agg(F.sum(F.col("pos") * (F.col("before") + (F.col("all") + 1) / 2))).first()[0]
    area = (u - auc["P"] * (auc["P"] + 1) / 2) / (auc["P"] * auc["N"]) if auc["P"] and auc["N"] else None
    return s.select(((F.col("tpr") + F.col("tnr")) / 2).alias("balanced_accuracy"), "log_loss",
                    F.lit(area).cast("double").alias("roc_auc"), "brier_score_loss") \
        .unpivot([], ALL_PROBABILISTIC, "metric", "value")


def binary_scores(df: DataFrame, label: str, prediction: str, probability: str,
                  positive=1) -> DataFrame:
    """Balanced accuracy, log loss (probabilities clipped to [eps, 1-eps]) and
    exact ROC AUC for a binary task, long form ``(metric, value)``. Rows are
    reduced to counts per (label, prediction, probability) first; the AUC adds
    average ranks over the distinct probabilities in global order. A class
    without rows leaves the scores that need it null. A row without a
    prediction is a wrong answer; one without a probability only enters the
    balanced accuracy."""
    return _probability_scores(df, label, prediction, probability, positive).where(F.col("metric").isin(PROBABILISTIC))


def scores(df: DataFrame, label: str, prediction: str, names: Sequence[str], positive=None,
           probability: str = "probability") -> DataFrame:
    """Several named scores, ``(metric, value)``; each family of scores (classes,
    probabilities, errors) is computed once. ``df`` should be materialised.

    Names are the public ones of scores and of score functions. Plain ``precision``, ``recall``
    and ``f1`` are those of the class ``positive``, or macro averages when none is named;
    ``_macro``, ``_micro`` and ``_weighted`` always average, and ``neg_`` turns the sign of a loss."""
    wanted = [(n, *meaning(n)) for n in names]
    if not wanted:
        raise ValueError("no metric was named")
    one = 1 if positive is None else positive
    compute = {"class": lambda: _class_scores(df, label, prediction, positive),
               "probability": lambda: _probability_scores(df, label, prediction, probability, one),
               "error": lambda: _error_scores(df, label, prediction)}
    out = []
    for family, run in compute.items():
        if mine := [(n, score, sign) for n, f, score, sign in wanted if f == family]:
            pairs = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(score).alias("score"), F.lit(float(sign)).alias("sign"))
                              for n, score, sign in mine])
            out.append(run().withColumn("_p", F.explode(pairs)).where(F.col("metric") == F.col("_p.score"))
                       .select(F.col("_p.n").alias("metric"), (F.col("value") * F.col("_p.sign")).alias("value")))
    return reduce(DataFrame.unionByName, out)


def metric_by_name(df: DataFrame, label: str, prediction: str, name: str, positive=None,
                   probability: str = "probability") -> DataFrame:
    """A single named score (see ``scores``); unknown names raise ValueError. The result
    carries the name asked for."""
    return scores(df, label, prediction, [name], positive, probability)


def cv_mean(cv: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Mean of each requested metric per split; an unknown metric raises."""
    if metrics:
        known = {r["metric"] for r in cv.select("metric").distinct().collect()}
        bad = [m for m in metrics if m not in known]
        if bad:
            raise ValueError(f"{bad} not in the CV results; available: {sorted(known)}")
        cv = cv.where(F.col("metric").isin(list(metrics)))
    return cv.groupBy("split", "metric").agg(F.avg("value").alias("mean"))


def cv_summary(cv: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Mean and population standard deviation per (split, metric); an unknown
    metric among ``metrics`` raises."""
    if metrics:
        known = {r["metric"] for r in cv.select("metric").distinct().collect()}
        if bad := [m for m in metrics if m not in known]:
            raise ValueError(f"{bad} not in the CV results; available: {sorted(known)}")
        cv = cv.where(F.col("metric").isin(list(metrics)))
    return cv.groupBy("split", "metric").agg(F.avg("value").alias("mean"),
                                              F.stddev_pop("value").alias("std"))

