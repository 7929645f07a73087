"""Evaluation of scored rows (inventory group L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators import evaluation as ev
from reviewlens.plans.adapters import predictions, scored, truth, with_views
from reviewlens.plans.registry import query

METRICS = ("precision", "recall", "f1")


def rounded(df, *names: str, digits: int = 9):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("l1_confusion", with_views("SELECT * FROM confusion", "confusion"))
def confusion(spark, sf):
    return ev.confusion(scored(spark, sf))


@query(
    "l2_per_label",
    with_views(
        'SELECT model, label, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1'
        " FROM labelled",
        "labelled",
    ),
)
def per_label(spark, sf):
    found = ev.per_label(ev.confusion(scored(spark, sf))).select("model", "label", *METRICS)
    return rounded(found, *METRICS)


@query(
    "l3_average_precision",
    with_views("SELECT model, label, round(ap, 9) AS ap FROM average_precisions", "average_precisions"),
)
def average_precision(spark, sf):
    return rounded(ev.average_precision(scored(spark, sf)), "ap")


@query(
    "l4_macro",
    with_views(
        'SELECT model, round(avg("precision"), 9) AS "precision", round(avg(recall), 9) AS recall,'
        " round(avg(f1), 9) AS f1 FROM labelled GROUP BY model",
        "labelled",
    ),
)
def macro(spark, sf):
    return rounded(ev.macro(ev.per_label(ev.confusion(scored(spark, sf)))), *METRICS)


@query(
    "l5_micro",
    with_views(
        'SELECT model, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1 FROM micros',
        "micros",
    ),
)
def micro(spark, sf):
    return rounded(ev.micro(ev.confusion(scored(spark, sf))), *METRICS)


@query(
    "l6_support",
    with_views(
        "SELECT model, label, count(*) FILTER (y_true = 1) AS support, count(*) AS n_samples FROM scored"
        " GROUP BY model, label",
        "scored",
    ),
)
def support(spark, sf):
    return ev.support(scored(spark, sf))


@query(
    "l7_report",
    with_views(
        """SELECT l.model, split_part(l.model, '/', 1) AS family, 0.5::DOUBLE AS threshold, m.n_samples,
                  round(m.f1, 9) AS micro_f1, round(avg(l.f1), 9) AS macro_f1,
                  string_agg(l.label || ':' || tn || '/' || fp || '/' || fn || '/' || tp, ' ' ORDER BY l.label) AS counts,
                  round(sum(ap), 9) AS ap_sum, CAST(sum(tp + fn) AS BIGINT) AS support
           FROM labelled l JOIN average_precisions a ON l.model = a.model AND l.label = a.label
                JOIN micros m ON l.model = m.model GROUP BY l.model, m.n_samples, m.f1""",
        "labelled",
        "average_precisions",
        "micros",
    ),
)
def report(spark, sf):
    rows = ev.report(scored(spark, sf))
    entries = F.sort_array(F.map_entries("per_label"))

    def shown(e):
        c = e["value"]["confusion"]
        return F.concat(e["key"], F.lit(":"), F.concat_ws("/", c["tn"], c["fp"], c["fn"], c["tp"]))

    def total(kind, zero):
        return F.aggregate(F.map_values("per_label"), zero, lambda a, m: a + m[kind])

    return rows.select(
        "model",
        "family",
        "threshold",
        "n_samples",
        F.round("micro.f1", 9).alias("micro_f1"),
        F.round("macro.f1", 9).alias("macro_f1"),
        F.array_join(F.transform(entries, shown), " ").alias("counts"),
        F.round(total("ap", F.lit(0.0)), 9).alias("ap_sum"),
        total("support", F.lit(0).cast("long")).alias("support"),
    )


@query(
    "l8_threshold_sweep",
    with_views(
        """SELECT model, label, arg_max(t, (f1, -t)) AS threshold, round(max(f1), 9) AS f1 FROM (
             SELECT model, label, t, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (2 * tp + fp + fn) END AS f1
             FROM (SELECT model, label, t, sum(pos) FILTER (prob >= t) AS tp, sum(n - pos) FILTER (prob >= t) AS fp,
                          coalesce(sum(pos) FILTER (prob < t), 0) AS fn
                   FROM score_steps, (SELECT unnest(["""
        + ", ".join(f"{t!r}::DOUBLE" for t in ev.GRID)
        + """]) AS t) GROUP BY model, label, t)) GROUP BY model, label""",
        "score_steps",
    ),
)
def sweep(spark, sf):
    return rounded(ev.threshold_sweep(scored(spark, sf)), "f1")


@query(
    "l9_align",
    with_views(
        "SELECT model, label, count(*) AS n, CAST(sum(y_true) AS BIGINT) AS positives, round(sum(prob), 3) AS mass"
        " FROM scored GROUP BY model, label",
        "scored",
    ),
)
def align(spark, sf):
    met = ev.align(predictions(spark, sf), truth(spark, sf))
    return met.groupBy("model", "label").agg(
        F.count("*").alias("n"),
        F.sum("y_true").alias("positives"),
        F.round(F.sum("prob"), 3).alias("mass"),
    )


@query(
    "l9_unaligned",
    with_views(
        """SELECT model, count(DISTINCT sample_id) FILTER (right(sample_id, 1)::BIGINT % 3 <> 0 AND right(sample_id, 1)::BIGINT % 4 = 0) AS no_truth,
                  count(DISTINCT sample_id) FILTER (right(sample_id, 1)::BIGINT % 3 = 0 AND right(sample_id, 1)::BIGINT % 4 <> 0) AS no_prediction
           FROM scored GROUP BY model""",
        "scored",
    ),
)
def unaligned(spark, sf):
    digit = F.right("sample_id", F.lit(1)).cast("long")
    return ev.unaligned(predictions(spark, sf).filter(digit % 3 != 0), truth(spark, sf).filter(digit % 4 != 0))


@query(
    "l10_many_models",
    with_views(
        """SELECT l.model, l.label, round(l.f1, 9) AS f1, round(a.ap, 9) AS ap FROM labelled l
           JOIN average_precisions a ON l.model = a.model AND l.label = a.label""",
        "labelled",
        "average_precisions",
    ),
)
def many_models(spark, sf):
    met = ev.align(predictions(spark, sf), truth(spark, sf))
    found = ev.per_label(ev.confusion(met)).join(ev.average_precision(met), ["model", "label"])
    return rounded(found.select("model", "label", "f1", "ap"), "f1", "ap")


@query(
    "l11_loss",
    with_views(
        """SELECT model, label, round(avg(-(y_true * ln(p) + (1 - y_true) * ln(1 - p))), 6) AS loss FROM (
             SELECT model, label, y_true, greatest(1e-12::DOUBLE, least(1::DOUBLE - 1e-12::DOUBLE, prob)) AS p FROM scored)
           GROUP BY model, label""",
        "scored",
    ),
)
def loss(spark, sf):
    return rounded(ev.bce(scored(spark, sf)), "loss", digits=6)
