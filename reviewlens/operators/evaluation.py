"""Evaluation of scored rows.

The hub is the long form ``scored(model, sample_id, label, y_true, prob)``; any number of models and
labels is evaluated in one pass, since everything is keyed by (model, label).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions.text import label_vector, model_family, threshold_probs
from reviewlens.operators.ordered import with_running_sums
from reviewlens.schemas import LABELS
from reviewlens.sources.scratch import materialise

KEYS = ["model", "label"]

# 17 evenly spaced thresholds from 0.1 to 0.9.
GRID = [i * ((0.9 - 0.1) / 16) + 0.1 for i in range(16)] + [0.9]


def ratio(a: Column, b: Column) -> Column:
    """Quotient, or 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """tn, fp, fn, tp per (model, label)."""
    actual, predicted = F.col("y_true") == 1, F.col("prob") >= threshold
    return scored.groupBy(*KEYS).agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )


def _confusion(steps: DataFrame, threshold: float) -> DataFrame:
    """The same counts from rows already counted per score."""
    hit, negatives = F.col("prob") >= threshold, F.col("n") - F.col("pos")

    def total(c: Column, test: Column) -> Column:
        return F.sum(F.when(test, c).otherwise(0))

    return steps.groupBy(*KEYS).agg(
        total(negatives, ~hit).alias("tn"),
        total(negatives, hit).alias("fp"),
        total(F.col("pos"), ~hit).alias("fn"),
        total(F.col("pos"), hit).alias("tp"),
    )


def per_label(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from confusion counts; 0 where undefined."""
    return counts.withColumns(prf(F.col("tp"), F.col("fp"), F.col("fn")))


def macro(labelled: DataFrame) -> DataFrame:
    """Means over labels; the macro F1 is the mean of the F1s."""
    return labelled.groupBy("model").agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")])


def micro(counts: DataFrame) -> DataFrame:
    """Metrics of the counts pooled over labels."""
    pooled = counts.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return pooled.select("model", *[c.alias(n) for n, c in prf(F.col("tp"), F.col("fp"), F.col("fn")).items()])


def support(scored: DataFrame) -> DataFrame:
    return scored.groupBy(*KEYS).agg(
        F.count_if(F.col("y_true") == 1).alias("support"), F.count("*").alias("n_samples")
    )


def score_counts(scored: DataFrame) -> DataFrame:
    """Positives and rows per distinct score: ties meet here, before anything is ordered."""
    return scored.groupBy(*KEYS, "prob").agg(
        F.count_if(F.col("y_true") == 1).alias("pos"), F.count("*").alias("n")
    )


def average_precision(scored: DataFrame) -> DataFrame:
    """Area under the precision-recall steps, tied scores as one step; 0 with no positive."""
    return _average_precision(score_counts(scored))


def _average_precision(steps: DataFrame) -> DataFrame:
    down = steps.withColumn("_down", -F.col("prob"))
    upto = with_running_sums(down, KEYS, ["_down"], {"cum_pos": "pos", "cum_n": "n"})
    gained = F.col("pos") * F.col("cum_pos") / F.col("cum_n")
    return upto.groupBy(*KEYS).agg(ratio(F.sum(gained), F.sum("pos")).alias("ap"))


def threshold_sweep(scored: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """Threshold with the best F1 per (model, label), the first of equals; 0.5 for an empty grid.

    Every row is counted once, under the number of grid points it reaches; the counts at a threshold
    are sums over that small table.
    """
    points = sorted(GRID if grid is None else grid)
    if not points:
        return scored.select(*KEYS).distinct().select(*KEYS, F.lit(0.5).alias("threshold"), F.lit(None).cast("double").alias("f1"))
    reached = sum((F.col("prob") >= t).cast("int") for t in points)
    counted = scored.groupBy(*KEYS, reached.alias("_r")).agg(
        F.count_if(F.col("y_true") == 1).alias("pos"), F.count("*").alias("n")
    )
    at = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.lit(i + 1).alias("need"))
            for i, t in enumerate(points)
        ]
    )
    # at most len(grid) + 1 rows per (model, label) from here on
    positives = counted.withColumn("_p", F.explode(at)).groupBy(*KEYS, F.col("_p.t").alias("t")).agg(
        F.sum(F.when(F.col("_r") >= F.col("_p.need"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("_r") >= F.col("_p.need"), F.col("n") - F.col("pos")).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("_r") < F.col("_p.need"), F.col("pos")).otherwise(0)).alias("fn"),
    )
    scores = positives.withColumns(prf(F.col("tp"), F.col("fp"), F.col("fn")))
    best = F.max(F.struct("f1", (-F.col("t")).alias("down")))
    return scores.groupBy(*KEYS).agg(best.alias("_b")).select(
        *KEYS, (-F.col("_b.down")).alias("threshold"), F.col("_b.f1").alias("f1")
    )


def bce(scored: DataFrame, epsilon: float = 1e-12) -> DataFrame:
    """Mean binary cross-entropy per (model, label), scores clipped away from 0 and 1."""
    p = F.greatest(F.lit(epsilon), F.least(F.lit(1 - epsilon), F.col("prob")))
    y = F.col("y_true").cast("double")
    loss = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return scored.groupBy(*KEYS).agg(F.avg(loss).alias("loss"))


def align(
    predictions: DataFrame, truth: DataFrame, labels: list[str] = LABELS, key: str = "sample_id"
) -> DataFrame:
    """Long scored rows from (model, key, probs) and a truth table with one column per label.

    Met on the key, not on row position. The truth is shuffled once for all models.
    """
    y = truth.select(key, label_vector(labels).alias("_y"))
    met = predictions.select("model", key, "probs").join(y, key)
    entries = F.arrays_zip(
        F.array(*[F.lit(name) for name in labels]).alias("label"),
        F.col("_y").alias("y_true"),
        F.col("probs").alias("prob"),
    )
    return met.select("model", key, F.inline(entries))


def unaligned(predictions: DataFrame, truth: DataFrame, key: str = "sample_id") -> DataFrame:
    """Ids predicted without truth and ids of the truth without prediction, per model: both must be 0."""
    predictions, truth = predictions.select("model", key).distinct(), truth.select(key).distinct()
    models = predictions.groupBy("model").agg(F.count("*").alias("n"))
    found = (
        predictions.join(truth, key, "left_semi")
        .groupBy("model")
        .agg(F.count("*").alias("hit"))
    )
    size = truth.agg(F.count("*")).scalar()
    both = models.join(found, "model", "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    return both.select(
        "model", (F.col("n") - F.col("hit")).alias("no_truth"), (size - F.col("hit")).alias("no_prediction")
    )


def predictions_table(predictions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The prediction rows a report keeps: id, probabilities and 0/1 decisions."""
    return predictions.withColumn("pred", threshold_probs("probs", threshold))


def report(
    scored: DataFrame,
    threshold: float = 0.5,
    compat_fixed_half: bool = False,
    labels: list[str] = LABELS,
) -> DataFrame:
    """One nested report row per model.

    ``compat_fixed_half`` cuts the per-label precision/recall/F1 at 0.5 whatever the threshold.
    """
    # one pass over the rows; everything else works on counts per score
    steps = materialise(score_counts(scored), "steps")
    counts = _confusion(steps, threshold)
    cut = _confusion(steps, 0.5) if compat_fixed_half else counts
    metrics = per_label(cut).select(*KEYS, "precision", "recall", "f1")
    own = per_label(counts).select(
        *KEYS, "tn", "fp", "fn", "tp", *[F.col(c).alias(f"own_{c}") for c in ("precision", "recall", "f1")]
    )
    # a row per (model, label) on every side of these joins
    wide = (
        own.join(metrics, KEYS)
        .join(_average_precision(steps), KEYS)
        .withColumns(
            {"support": F.col("tp") + F.col("fn"), "n": F.col("tp") + F.col("fn") + F.col("fp") + F.col("tn")}
        )
    )
    entry = F.struct(
        "label",
        F.struct(
            "precision", "recall", "f1", "ap", "support", F.struct("tn", "fp", "fn", "tp").alias("confusion")
        ).alias("m"),
    )
    pooled = prf(F.sum("tp"), F.sum("fp"), F.sum("fn"))
    grouped = wide.groupBy("model").agg(
        F.max("n").alias("n_samples"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("per_label"),
        F.struct(*[F.avg(f"own_{c}").alias(c) for c in ("precision", "recall", "f1")]).alias("macro"),
        F.struct(*[c.alias(n) for n, c in pooled.items()]).alias("micro"),
    )
    return grouped.select(
        "model",
        model_family("model").alias("family"),
        F.array(*[F.lit(name) for name in labels]).alias("labels"),
        F.lit(float(threshold)).alias("threshold"),
        "n_samples",
        "per_label",
        "macro",
        "micro",
    )


def best_mark(metrics: DataFrame, by: str = "f1") -> DataFrame:
    """Marks the best model. The table has one row per model."""
    return metrics.withColumn("is_best", F.col(by) == F.max(by).over(Window.partitionBy(F.lit(1))))
