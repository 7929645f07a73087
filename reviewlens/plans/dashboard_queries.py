"""Dashboard tables (inventory group N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators import dashboard as da
from reviewlens.operators import evaluation as ev
from reviewlens.plans.adapters import predictions, scored, table, with_views
from reviewlens.plans.registry import query
from reviewlens.schemas import LABELS


def reports(spark, sf):
    return ev.report(scored(spark, sf))


SUPPORTS = "SELECT model, label, count(*) FILTER (y_true = 1) AS support FROM scored GROUP BY model, label"
TITLE = """CASE label WHEN 'irrelevant_content' THEN 'Irrelevant Content' WHEN 'advertisement' THEN 'Advertisement'
           ELSE 'Review Without Visit' END"""


@query(
    "n1_model_comparison",
    with_views(
        """SELECT short_name AS model, family, round(f1 * 100, 1) AS micro_f1, round(f1 * 100, 1) AS accuracy,
                  round("precision" * 100, 1) AS "precision", round(recall * 100, 1) AS recall,
                  round(f1 * 100, 1) AS f1_score FROM micros""",
        "micros",
    ),
)
def model_comparison(spark, sf):
    return da.model_comparison(reports(spark, sf))


@query(
    "n2_category_distribution",
    with_views(
        """SELECT category, "count", position FROM (
             SELECT CASE label WHEN 'irrelevant_content' THEN 'Irrelevant' WHEN 'advertisement' THEN 'Advertisement'
                    ELSE 'Rant without Visit' END AS category, floor(avg(support))::BIGINT AS "count", 1 AS position
             FROM supports GROUP BY label
             UNION ALL SELECT 'Relevant', ((SELECT min(n_samples) FROM pooled) - sum(c))::BIGINT, 0
             FROM (SELECT floor(avg(support)) AS c FROM supports GROUP BY label))""",
        "scored",
        "pooled",
        supports=SUPPORTS,
    ),
)
def category_distribution(spark, sf):
    return da.category_distribution(reports(spark, sf))


OVERVIEW = """SELECT n_samples AS total_reviews, (n_samples - violations)::BIGINT AS relevant_reviews,
                     violations::BIGINT AS violations, best_model, best_family, round(best_f1, 9) AS best_f1,
                     worst_model, round(worst_f1, 9) AS worst_f1, total_models, round(avg_f1, 9) AS avg_f1,
                     1::BIGINT AS encoder_count, 1::BIGINT AS sft_count
              FROM (SELECT arg_max(short_name, f1) AS best_model, arg_max(family, f1) AS best_family, max(f1) AS best_f1,
                           arg_min(short_name, f1) AS worst_model, min(f1) AS worst_f1, count(*) AS total_models,
                           avg(f1) AS avg_f1, arg_max(n_samples, f1) AS n_samples, arg_max(model, f1) AS m FROM micros),
                   (SELECT model, sum(support) AS violations FROM supports GROUP BY model) WHERE model = m"""


@query("n3_overview", with_views(OVERVIEW, "micros", supports=SUPPORTS))
def overview(spark, sf):
    found = da.overview(reports(spark, sf))
    return found.withColumns({c: F.round(c, 9) for c in ("best_f1", "worst_f1", "avg_f1")})


@query(
    "n4_activity",
    with_views(
        """SELECT unnest([0, 1, 2, 3, 4]) AS position,
                  unnest(['Model comparison completed', 'All models evaluated', 'SFT models analyzed',
                          'Encoder models analyzed', 'Pipeline completed']) AS action,
                  unnest([printf('Best: %s (F1: %.3f)', best_model, best_f1),
                          printf('Avg F1: %.3f | Range: %.3f - %.3f', avg_f1, worst_f1, best_f1),
                          printf('%d SFT models', sft_count), printf('%d encoder models', encoder_count),
                          printf('Evaluated %d models on %d samples', total_models, total_reviews)]) AS details
           FROM summary""",
        "micros",
        supports=SUPPORTS,
        summary=OVERVIEW,
    ),
)
def activity(spark, sf):
    return da.activity(reports(spark, sf))


@query(
    "n5_model_list",
    with_views(
        'SELECT model AS id, short_name AS name, family, round(f1, 9) AS f1_score, round("precision", 9) AS "precision",'
        " round(recall, 9) AS recall FROM micros",
        "micros",
    ),
)
def model_list(spark, sf):
    found = da.model_list(reports(spark, sf))
    return found.withColumns({c: F.round(c, 9) for c in ("f1_score", "precision", "recall")})


@query(
    "n6_model_details",
    with_views(
        """SELECT l.model, m.short_name AS name, m.family, m.n_samples, 0.5::DOUBLE AS threshold,
                  round(m.f1, 9) AS micro_f1, replace("""
        + TITLE.replace("label", "l.label")
        + """, 'Review Without', 'Review without') AS category, round(l."precision", 9) AS "precision",
                  round(l.recall, 9) AS recall, round(l.f1, 9) AS f1_score, tp + fn AS support, round(ap, 9) AS ap,
                  tn, fp, fn, tp
           FROM labelled l JOIN average_precisions a ON l.model = a.model AND l.label = a.label
                JOIN micros m ON l.model = m.model WHERE l.model = 'encoder/m0'""",
        "labelled",
        "average_precisions",
        "micros",
    ),
)
def model_details(spark, sf):
    found = da.model_details(reports(spark, sf), "encoder/m0").drop(
        "micro_precision", "micro_recall", "macro_precision", "macro_recall", "macro_f1"
    )
    return found.withColumns(
        {c: F.round(c, 9) for c in ("micro_f1", "precision", "recall", "f1_score", "ap")}
    )


def insight_sql(where: str) -> str:
    return with_views(
        f"""SELECT {TITLE} AS category, round(avg("precision") * 100, 1) AS "precision",
                   round(avg(recall) * 100, 1) AS recall, round(avg(f1) * 100, 1) AS f1_score,
                   floor(avg(tp + fn))::BIGINT AS support FROM labelled {where} GROUP BY label""",
        "labelled",
    )


@query("n7_insights_all", insight_sql(""))
def insights_all(spark, sf):
    return da.insights(reports(spark, sf))


@query("n7_insights_one", insight_sql("WHERE model = 'baseline/m1'"))
def insights_one(spark, sf):
    return da.insights(reports(spark, sf), "BASE")


@query(
    "n8_violation_severity",
    with_views(
        """SELECT label, c AS "count", CASE WHEN c > 20 THEN 'High' WHEN c > 15 THEN 'Medium' ELSE 'Low' END AS severity
           FROM (SELECT label, floor(avg(support))::BIGINT AS c FROM supports GROUP BY label)""",
        "scored",
        supports=SUPPORTS,
    ),
)
def severity(spark, sf):
    return da.violation_severity(reports(spark, sf))


@query(
    "n9_risk",
    with_views(
        f"""SELECT model, sample_id, CASE WHEN v = 0 THEN 'Relevant' ELSE cats END AS category, confidence,
                   v::INTEGER AS violations,
                   level AS risk_level, coalesce(highs, '') AS high_risk, coalesce(meds, '') AS medium_risk,
                   CASE level WHEN 'High' THEN 'Immediate review recommended.' WHEN 'Medium' THEN
                        'Manual review suggested.' ELSE 'No action required.' END AS recommendation
            FROM (SELECT model, sample_id, count(*) FILTER (prob >= 0.5) AS v, max(prob) AS confidence,
                         CASE WHEN max(prob) >= 0.8 THEN 'High' WHEN max(prob) >= 0.5 THEN 'Medium' ELSE 'Low' END AS level,
                         string_agg({TITLE}, ', ' ORDER BY pos) FILTER (prob >= 0.5) AS cats,
                         string_agg({TITLE}, ', ' ORDER BY pos) FILTER (prob >= 0.8) AS highs,
                         string_agg({TITLE}, ', ' ORDER BY pos) FILTER (prob >= 0.5 AND prob < 0.8) AS meds
                  FROM (SELECT *, CASE label WHEN 'irrelevant_content' THEN 0 WHEN 'advertisement' THEN 1 ELSE 2 END AS pos
                        FROM scored) GROUP BY model, sample_id)""",
        "scored",
    ),
)
def risk(spark, sf):
    found = da.risk(predictions(spark, sf), 0.5, LABELS)
    return found.select(
        "model",
        "sample_id",
        "category",
        "confidence",
        "violations",
        "risk_level",
        F.array_join("high_risk", ", ").alias("high_risk"),
        F.array_join("medium_risk", ", ").alias("medium_risk"),
        "recommendation",
    )


@query(
    "n10_confidence_histogram",
    with_views(
        'SELECT floor(prob * 10) / 10 AS bin, count(*) AS "count" FROM scored GROUP BY floor(prob * 10) / 10',
        "scored",
    ),
)
def histogram(spark, sf):
    return da.confidence_histogram(scored(spark, sf))


@query(
    "n11_confidence_stats",
    with_views(
        """SELECT label, round(avg(prob), 9) AS mean_confidence, round(stddev_pop(prob), 9) AS std_confidence,
                  count(*) AS sample_count FROM scored WHERE model = 'sft/m2' GROUP BY label""",
        "scored",
    ),
)
def confidence_stats(spark, sf):
    found = da.confidence_stats(scored(spark, sf), "sft/m2")
    return found.withColumns({c: F.round(c, 9) for c in ("mean_confidence", "std_confidence")})


DAILY = """SELECT strftime(d.day, '%Y-%m-%d') AS date, coalesce(v, 0)::DOUBLE AS value FROM
             (SELECT unnest(generate_series((SELECT max(ts)::DATE FROM events) - {back}, (SELECT max(ts)::DATE FROM events),
                     INTERVAL 1 DAY))::DATE AS day) d
           LEFT JOIN (SELECT ts::DATE AS day, {measure} AS v FROM events GROUP BY ts::DATE) e ON d.day = e.day"""


@query("n12_daily_counts", DAILY.format(back=89, measure="count(*)"))
def daily_counts(spark, sf):
    return da.daily_series(table(spark, sf, "events"), "ts", 90)


@query(
    "n12_daily_means",
    f"SELECT date, round(value, 6) AS value FROM ({DAILY.format(back=29, measure='avg(value)')})",
)
def daily_means(spark, sf):
    found = da.daily_series(table(spark, sf, "events"), "ts", 30, F.avg("value"))
    return found.withColumn("value", F.round("value", 6))


@query(
    "n13_series_summary",
    f"""SELECT round(avg(value), 6) AS avg_value,
               CASE WHEN arg_max(value, date) > arg_min(value, date) THEN 'up' ELSE 'down' END AS trend,
               round(abs((arg_max(value, date) - arg_min(value, date)) / arg_min(value, date) * 100), 6) AS trend_pct,
               max(value) AS peak, round(stddev_pop(value) / avg(value), 6) AS volatility
        FROM ({DAILY.format(back=29, measure='count(*)')})""",
)
def series_summary(spark, sf):
    found = da.series_summary(da.daily_series(table(spark, sf, "events"), "ts", 30))
    return found.withColumns({c: F.round(c, 6) for c in ("avg_value", "trend_pct", "volatility")})


@query(
    "n14_last_points",
    f"SELECT date, value FROM ({DAILY.format(back=89, measure='count(*)')}) ORDER BY date DESC LIMIT 30",
)
def last_points(spark, sf):
    return da.last_points(da.daily_series(table(spark, sf, "events"), "ts", 90))


@query(
    "n15_category_share",
    """SELECT event_type, n AS "count", round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS share_pct
       FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""",
)
def category_share(spark, sf):
    counted = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("count"))
    found = da.category_share(counted, "event_type")
    return found.withColumn("share_pct", F.round("share_pct", 6))


@query(
    "n16_best_mark",
    with_views("SELECT model, f1 = max(f1) OVER () AS is_best FROM micros", "micros"),
)
def best_mark(spark, sf):
    found = ev.best_mark(ev.micro(ev.confusion(scored(spark, sf))))
    return found.select("model", "is_best")
