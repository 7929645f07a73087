"""Streaming forms (inventory group S), run over everything available and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.plans.adapters import TEST_POLICIES, table
from reviewlens.plans.registry import query
from reviewlens.streaming import dedup_stream, moderate, run_available, stream_table, violation_counts


def stream(spark, sf, name):
    return stream_table(spark, f"{sf}/{name}.parquet", table(spark, sf, name).schema)


def event_reviews(events):
    """Events as dated reviews: type is the place, user the author, properties the text."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("business_name"),
        F.col("user_id").cast("string").alias("author_name"),
        F.col("props").alias("text"),
        (F.col("event_type") == "click").cast("int").alias("advertisement"),
        (F.col("event_type") == "error").cast("int").alias("irrelevant_content"),
        (F.col("value") > 10).cast("int").alias("review_without_visit"),
    )


@query(
    "s1_moderated_stream",
    """SELECT doc_id, ad AS advertisement, irr AS irrelevant_content, rant AS review_without_visit,
              regexp_matches(text, '(?i)(https?://|www\\.)') AS has_url,
              CASE WHEN ad + irr + rant > 0 THEN 'High' ELSE 'Low' END AS risk_level
       FROM (SELECT *, CAST(promo >= 2 OR (promo >= 1 AND regexp_matches(text, '(?i)(https?://|www\\.)')) AS INTEGER) AS ad,
                    CAST(unrelated >= 2 OR (unrelated = 1 AND words < 15) AS INTEGER) AS irr,
                    CAST(contains(lower(text), 'that') AND NOT contains(lower(text), 'ate') AS INTEGER) AS rant
             FROM (SELECT doc_id, text, contains(lower(text), 'mail')::INT + contains(lower(text), 'ing')::INT
                          + contains(lower(text), 'the')::INT AS promo,
                          contains(lower(text), 'ate')::INT + contains(lower(text), 'and')::INT AS unrelated,
                          len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words
                   FROM documents))""",
)
def moderated(spark, sf):
    found = moderate(stream(spark, sf, "documents").select("doc_id", "text"), TEST_POLICIES)
    kept = found.select(
        "doc_id", "advertisement", "irrelevant_content", "review_without_visit", "has_url", "risk_level"
    )
    return run_available(kept, "moderated")


@query(
    "s2_stream_dedup",
    """SELECT DISTINCT event_type AS business_name, user_id::VARCHAR AS author_name, props AS text FROM events""",
)
def stream_dedup(spark, sf):
    rows = event_reviews(stream(spark, sf, "events"))
    kept = dedup_stream(rows, "ts", "60 days").select("business_name", "author_name", "text")
    return run_available(kept, "dedup")


@query(
    "s3_windowed_violations",
    """SELECT strftime(day, '%Y-%m-%d') AS day, n_reviews, advertisement, irrelevant_content, review_without_visit FROM (
         SELECT ts::DATE AS day, count(*) AS n_reviews, count(*) FILTER (event_type = 'click') AS advertisement,
                count(*) FILTER (event_type = 'error') AS irrelevant_content,
                count(*) FILTER (value > 10) AS review_without_visit FROM events GROUP BY ts::DATE)
       WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def windowed(spark, sf):
    counts = violation_counts(event_reviews(stream(spark, sf, "events")), "ts")
    return run_available(counts, "windows").select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "n_reviews",
        "advertisement",
        "irrelevant_content",
        "review_without_visit",
    )
