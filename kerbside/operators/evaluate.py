"""Multi-class evaluation from counts.

Input rows have ``model``, ``label``, ``prediction`` (0, 1, 2) and ``probability``, an array
of three doubles. Everything is aggregated to confusion counts or to counts per distinct score;
no window runs over the scored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions import columns as C
from kerbside.operators.prefix import running_totals
from kerbside.schema import LABELS, METRICS

CLASSES = range(len(LABELS))


def confusion_counts(scored: DataFrame) -> DataFrame:
    """One row per model with the nine cells c00..c22 (actual, predicted)."""
    return scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if((F.col("label") == i) & (F.col("prediction") == j)).alias(f"c{i}{j}")
          for i in CLASSES for j in CLASSES])


def _actual(i: int) -> Column:
    return F.col(f"c{i}0") + F.col(f"c{i}1") + F.col(f"c{i}2")


def _predicted(j: int) -> Column:
    return F.col(f"c0{j}") + F.col(f"c1{j}") + F.col(f"c2{j}")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def _per_class(i: int) -> dict[str, Column]:
    hit = F.col(f"c{i}{i}")
    precision, recall = _ratio(hit, _predicted(i)), _ratio(hit, _actual(i))
    return {"precision": precision, "recall": recall,
            "f1": _ratio(2.0 * precision * recall, precision + recall), "support": _actual(i)}


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Nine cells per model, with percent of the actual class."""
    lines = [F.struct(F.lit(LABELS[i]).alias("actual"), F.lit(LABELS[j]).alias("predicted"),
                      F.col(f"c{i}{j}").alias("n_rows"),
                      C.steady(100.0 * _ratio(F.col(f"c{i}{j}"), _actual(i)), 6).alias("pct"))
             for i in CLASSES for j in CLASSES]
    return (confusion_counts(scored).select("model", F.explode(F.array(*lines)).alias("r"))
            .select("model", "r.*"))


def class_report(scored: DataFrame, digits: int = 4) -> DataFrame:
    """Precision, recall, F1, support per class, then accuracy, macro and weighted averages."""
    measures = ["precision", "recall", "f1"]
    per = [_per_class(i) for i in CLASSES]
    n = F.col("n")

    def line(order: int, name: str, values: dict[str, Column], support: Column) -> Column:
        return F.struct(F.lit(order).alias("line"), F.lit(name).alias("class_name"),
                        *[F.round(values[m], digits).alias(m) for m in measures],
                        support.cast("long").alias("support"))

    accuracy = _ratio(sum((F.col(f"c{i}{i}") for i in (1, 2)), F.col("c00")), n)
    macro = {m: sum((per[i][m] for i in (1, 2)), per[0][m]) / 3.0 for m in measures}
    weighted = {m: _ratio(sum((per[i][m] * per[i]["support"] for i in (1, 2)),
                              per[0][m] * per[0]["support"]), n) for m in measures}
    lines = [line(i, LABELS[i], per[i], per[i]["support"]) for i in CLASSES]
    lines += [line(3, "accuracy", {m: accuracy for m in measures}, n),
              line(4, "macro avg", macro, n), line(5, "weighted avg", weighted, n)]
    return (confusion_counts(scored).select("model", F.explode(F.array(*lines)).alias("r"))
            .select("model", "r.*"))


def _score_counts(scored: DataFrame) -> DataFrame:
    """Positives and negatives per model, class and distinct score."""
    per_class = F.array(*[
        F.struct(F.lit(i).alias("class"), F.element_at("probability", i + 1).alias("score"),
                 (F.col("label") == i).cast("long").alias("hit")) for i in CLASSES])
    return (scored.select("model", F.explode(per_class).alias("s")).select("model", "s.*")
            .groupBy("model", "class", "score")
            .agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg")))


def _ranked(scored: DataFrame) -> DataFrame:
    return running_totals(_score_counts(scored), ["model", "class"], "score", ["pos", "neg"])


def class_auc(scored: DataFrame) -> DataFrame:
    """One-vs-rest AUC per class as the tie-corrected rank statistic, with its support."""
    ranked = _ranked(scored)
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + 0.5 * F.col("neg")))
    return ranked.groupBy("model", "class").agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
        F.sum("pos").alias("support"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Support-weighted mean of the class AUCs; null when a class never occurs."""
    return class_auc(scored).groupBy("model").agg(
        F.when(F.count("auc") == F.count(F.lit(1)),
               F.try_divide(F.sum(F.col("auc") * F.col("support")), F.sum("support")))
        .alias("roc_auc"))


def roc_curve(scored: DataFrame) -> DataFrame:
    """Points of each class curve from the highest score down, starting at (0, 0)."""
    ranked = _ranked(scored)
    points = ranked.select(
        "model", "class", C.steady("score", 6).alias("threshold"),
        C.steady(F.try_divide((F.col("neg_total") - F.col("neg_before")).cast("double"),
                             F.col("neg_total")), 6).alias("fpr"),
        C.steady(F.try_divide((F.col("pos_total") - F.col("pos_before")).cast("double"),
                             F.col("pos_total")), 6).alias("tpr"))
    start = ranked.select("model", "class").distinct().select(
        "model", "class", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, support-weighted precision, recall, F1 and AUC per model."""
    per = [_per_class(i) for i in CLASSES]
    n = F.col("n")
    weighted = {m: _ratio(sum((per[i][m] * per[i]["support"] for i in (1, 2)),
                              per[0][m] * per[0]["support"]), n)
                for m in ("precision", "recall", "f1")}
    accuracy = _ratio(F.col("c00") + F.col("c11") + F.col("c22"), n)
    base = confusion_counts(scored).select(
        "model", accuracy.alias("accuracy"), *[v.alias(m) for m, v in weighted.items()])
    return base.join(roc_auc(scored), "model").select(
        "model", *[C.steady(m, 6).alias(m) for m in METRICS])


def comparison(per_model: DataFrame) -> DataFrame:
    """Long model x metric table with the best of each metric marked and a 4-digit text.

    The window runs over one row per model.
    """
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                      for m in METRICS])
    best = F.max("value").over(Window.partitionBy("metric"))
    return (per_model.select("model", F.explode(lines).alias("r")).select("model", "r.*")
            .select("model", "metric", "value",
                    F.format_number("value", 4).alias("shown"),
                    (F.abs(F.col("value") - best) < 1e-6).cast("int").alias("is_best")))
