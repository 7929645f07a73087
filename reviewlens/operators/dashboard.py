"""Summary tables of the moderation dashboard.

Report tables have one row per model; confidence and series tables are aggregated before any window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.text import category_name, short_model_name, title_label
from reviewlens.sources.readers import report_labels

# Display names of the labels in the overview and in the model details.
OVERVIEW_NAMES = {
    "irrelevant_content": "Irrelevant",
    "advertisement": "Advertisement",
    "review_without_visit": "Rant without Visit",
}
DETAIL_NAMES = {
    "irrelevant_content": "Irrelevant Content",
    "advertisement": "Advertisement",
    "review_without_visit": "Review without Visit",
}

# Recommendation per risk level.
RECOMMENDATION = {
    "High": "Immediate review recommended.",
    "Medium": "Manual review suggested.",
    "Low": "No action required.",
}


def percent(c: Column, digits: int = 1) -> Column:
    return F.round(c * 100, digits)


def model_comparison(reports: DataFrame) -> DataFrame:
    return reports.select(
        short_model_name("model").alias("model"),
        "family",
        percent(F.col("micro.f1")).alias("micro_f1"),
        percent(F.col("micro.f1")).alias("accuracy"),
        percent(F.col("micro.precision")).alias("precision"),
        percent(F.col("micro.recall")).alias("recall"),
        percent(F.col("micro.f1")).alias("f1_score"),
    )


def category_distribution(reports: DataFrame) -> DataFrame:
    """Mean support per label, after the remainder row ``Relevant`` (negative if labels overlap)."""
    counts = report_labels(reports).groupBy("label").agg(
        F.floor(F.sum("support") / F.count("*")).cast("long").alias("count")
    )
    total = reports.agg(F.min_by("n_samples", "model")).scalar()
    rest = counts.agg(
        F.lit("Relevant").alias("category"),
        (F.max(total) - F.sum("count")).alias("count"),
        F.lit(0).alias("position"),
    )
    named = counts.select(
        category_name("label", OVERVIEW_NAMES).alias("category"), "count", F.lit(1).alias("position")
    )
    return rest.unionByName(named).orderBy("position", "category")


def overview(reports: DataFrame) -> DataFrame:
    """Best and worst model by micro F1, mean F1, models per family, violations of the best model."""
    supports = F.aggregate(
        F.map_values("per_label"), F.lit(0).cast("long"), lambda acc, m: acc + m["support"]
    )
    rows = reports.select(
        "model", "family", "n_samples", F.col("micro.f1").alias("f1"), supports.alias("violations")
    )
    # equal F1: the first by name
    best = F.min(F.struct((-F.col("f1")).alias("down"), "model", "family", "violations", "f1", "n_samples"))
    worst = F.min(F.struct("f1", "model"))
    return rows.agg(
        best.alias("b"),
        worst.alias("w"),
        F.count("*").alias("total_models"),
        F.avg("f1").alias("avg_f1"),
        F.count_if(F.col("family") == "encoder").alias("encoder_count"),
        F.count_if(F.col("family") == "sft").alias("sft_count"),
    ).select(
        F.col("b.n_samples").alias("total_reviews"),
        (F.col("b.n_samples") - F.col("b.violations")).alias("relevant_reviews"),
        F.col("b.violations").alias("violations"),
        short_model_name("b.model").alias("best_model"),
        F.col("b.family").alias("best_family"),
        F.col("b.f1").alias("best_f1"),
        short_model_name("w.model").alias("worst_model"),
        F.col("w.f1").alias("worst_f1"),
        "total_models",
        "avg_f1",
        "encoder_count",
        "sft_count",
    )


def activity(reports: DataFrame) -> DataFrame:
    """Summary lines over the overview."""
    # The lines.
    lines = [
        ("Model comparison completed", F.format_string("Best: %s (F1: %.3f)", "best_model", "best_f1")),
        (
            "All models evaluated",
            F.format_string("Avg F1: %.3f | Range: %.3f - %.3f", "avg_f1", "worst_f1", "best_f1"),
        ),
        ("SFT models analyzed", F.format_string("%d SFT models", "sft_count")),
        ("Encoder models analyzed", F.format_string("%d encoder models", "encoder_count")),
        (
            "Pipeline completed",
            F.format_string("Evaluated %d models on %d samples", "total_models", "total_reviews"),
        ),
    ]
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(a).alias("action"), d.alias("details"))
        for i, (a, d) in enumerate(lines)
    ]
    return overview(reports).select(F.inline(F.array(*rows)))


def model_list(reports: DataFrame) -> DataFrame:
    return reports.select(
        F.col("model").alias("id"),
        short_model_name("model").alias("name"),
        "family",
        F.col("micro.f1").alias("f1_score"),
        F.col("micro.precision").alias("precision"),
        F.col("micro.recall").alias("recall"),
    ).orderBy(F.desc("f1_score"), "id")


def model_details(reports: DataFrame, model: str) -> DataFrame:
    """One row per category of one model, the overall metrics repeated."""
    one = reports.filter(F.col("model") == model).select(
        "model",
        short_model_name("model").alias("name"),
        "family",
        "n_samples",
        "threshold",
        F.col("micro.precision").alias("micro_precision"),
        F.col("micro.recall").alias("micro_recall"),
        F.col("micro.f1").alias("micro_f1"),
        F.col("macro.precision").alias("macro_precision"),
        F.col("macro.recall").alias("macro_recall"),
        F.col("macro.f1").alias("macro_f1"),
        F.explode("per_label").alias("label", "m"),
    )
    return one.select(
        *[c for c in one.columns if c not in ("label", "m")],
        category_name("label", DETAIL_NAMES).alias("category"),
        "m.precision",
        "m.recall",
        F.col("m.f1").alias("f1_score"),
        "m.support",
        "m.ap",
        "m.confusion.*",
    )


def insights(reports: DataFrame, name: str | None = None) -> DataFrame:
    """Per category: of the first model whose id contains ``name``, else the mean over all models."""
    rows = report_labels(reports)
    if name is not None:
        hit = F.lower("model").contains(name.lower())
        chosen = reports.agg(F.min(F.when(hit, F.col("model")))).scalar()
        # no model by that name: all of them
        rows = rows.filter(chosen.isNull() | (F.col("model") == chosen))
    return rows.groupBy("label").agg(
        percent(F.avg("precision")).alias("precision"),
        percent(F.avg("recall")).alias("recall"),
        percent(F.avg("f1")).alias("f1_score"),
        F.floor(F.avg("support")).cast("long").alias("support"),
    ).select(title_label("label").alias("category"), "precision", "recall", "f1_score", "support")


def violation_severity(reports: DataFrame) -> DataFrame:
    mean = F.floor(F.sum("support") / F.count("*")).cast("long")
    counts = report_labels(reports).groupBy("label").agg(mean.alias("count"))
    severity = F.when(F.col("count") > 20, "High").when(F.col("count") > 15, "Medium").otherwise("Low")
    return counts.withColumn("severity", severity)


def risk(rows: DataFrame, threshold: float, labels: list[str], high: float = 0.8) -> DataFrame:
    """Risk level, categories and recommendation per row of ``probs`` (in label order).

    The labels are known here, so every step is a plain expression over one probability each, which
    stays in generated code; functions over arrays would not.
    """
    probs = {name: F.get("probs", F.lit(i)) for i, name in enumerate(labels)}
    titles = {name: title_label(F.lit(name)) for name in labels}
    nothing = F.array().cast("array<string>")

    def named(test) -> Column:
        """Titles of the labels passing the test, in label order."""
        return F.concat(*[F.when(test(p), F.array(titles[n])).otherwise(nothing) for n, p in probs.items()])

    def some(test) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(test(p), F.lit(False)) for p in probs.values()])

    hit, very = (lambda p: p >= threshold), (lambda p: p >= high)
    between = lambda p: (p >= threshold) & (p < high)
    violations = sum((F.coalesce(hit(p), F.lit(False)).cast("int") for p in probs.values()), F.lit(0))
    category = F.concat_ws(", ", *[F.when(hit(p), titles[n]) for n, p in probs.items()])
    level = F.when(some(very), "High").when(some(between), "Medium").otherwise("Low")
    # The explanation.
    lead = F.when(F.col("violations") == 0, F.lit(f"No labels exceeded threshold {threshold:g}. ")).otherwise(
        F.concat(F.col("violations").cast("string"), F.lit(f" label(s) exceeded threshold {threshold:g}. "))
    )
    shown = F.format_string("%.1f", F.col("confidence") * 100)
    advice = F.when(F.col("risk_level") == "High", RECOMMENDATION["High"])
    for other in ("Medium", "Low"):
        advice = advice.when(F.col("risk_level") == other, RECOMMENDATION[other])
    return rows.withColumns(
        {
            "high_risk": named(very),
            "medium_risk": named(between),
            "confidence": F.greatest(F.lit(0.0), *probs.values()),
            "violations": violations,
            "risk_level": level,
            "category": F.when(violations == 0, "Relevant").otherwise(category),
        }
    ).withColumns(
        {
            "explanation": F.concat(lead, F.lit("Highest probability "), shown, F.lit("%.")),
            "recommendation": advice,
        }
    )


def confidence_histogram(scored: DataFrame, model: str | None = None) -> DataFrame:
    rows = scored.filter(F.col("model") == model) if model else scored
    bin_start = (F.floor(F.col("prob") * 10) / 10).alias("bin")
    return rows.groupBy(bin_start).agg(F.count("*").alias("count"))


def confidence_stats(scored: DataFrame, model: str | None = None) -> DataFrame:
    """Mean, population standard deviation and number of scores per label."""
    rows = scored.filter(F.col("model") == model) if model else scored
    return rows.groupBy("label").agg(
        F.avg("prob").alias("mean_confidence"),
        F.stddev_pop("prob").alias("std_confidence"),
        F.count("*").alias("sample_count"),
    )


def daily_series(
    df: DataFrame, ts: str, days: int = 180, value: Column | None = None, end: Column | None = None
) -> DataFrame:
    """One row per day of the trailing window, days without rows at 0. ``value`` defaults to a count.

    ``end`` defaults to the last day present.
    """
    measure = F.count("*") if value is None else value
    last = (F.lit(end) if end is not None else df.agg(F.max(F.to_date(ts))).scalar()).cast("date")
    first = F.date_sub(last, days - 1)
    inside = df.filter((F.col(ts) >= first) & (F.col(ts) < F.date_add(last, 1)))
    daily = inside.groupBy(F.to_date(ts).alias("day")).agg(measure.cast("double").alias("value"))
    spine = df.sparkSession.range(days).select(
        F.date_add(first, F.col("id").cast("int")).alias("day")
    )
    return spine.join(daily, "day", "left").select(
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        F.greatest(F.coalesce("value", F.lit(0.0)), F.lit(0.0)).alias("value"),
    )


def series_summary(series: DataFrame) -> DataFrame:
    """Mean, trend sign and size, peak and volatility of a daily series."""
    first, last = F.min_by("value", "date"), F.max_by("value", "date")
    many = F.count("*") > 1
    return series.agg(
        F.coalesce(F.avg("value"), F.lit(0.0)).alias("avg_value"),
        F.when(many, F.when(last > first, "up").otherwise("down")).otherwise("none").alias("trend"),
        F.when(many, F.abs(F.try_divide(last - first, first) * 100)).otherwise(0.0).alias("trend_pct"),
        F.coalesce(F.max("value"), F.lit(0.0)).alias("peak"),
        F.coalesce(F.try_divide(F.stddev_pop("value"), F.avg("value")), F.lit(0.0)).alias("volatility"),
    )


def last_points(series: DataFrame, n: int = 30) -> DataFrame:
    return series.orderBy(F.desc("date")).limit(n).orderBy("date")


def category_share(counts: DataFrame, category: str, count: str = "count") -> DataFrame:
    """Share of the total per category, over an already aggregated table."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.select(category, count, (F.col(count) / total * 100).alias("share_pct"))
