"""Scans and sinks (inventory groups A and B).

Each query writes data derived from the given tables to the shared scratch folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.text import threshold_probs
from reviewlens.operators import evaluation, profile, split
from reviewlens.operators.profile import normalise_requests, unify
from reviewlens.plans.adapters import businesses, predictions, reviews, scored, table, vectors, with_views
from reviewlens.plans.balance_queries import ERRORS, SIZES, TRIALS
from reviewlens.plans.registry import query
from reviewlens.plans.similarity_queries import SCAN, over_scores
from reviewlens.schemas import METADATA, RAW_REVIEWS, REVIEWS
from reviewlens.sources import (
    read_image_listing,
    read_reports,
    read_reviews_csv,
    read_table,
    scratch_path,
    write_reports,
    write_scan,
    write_splits,
    write_table,
)
from reviewlens.sources.readers import report_labels

JSON_REVIEWS = T.StructType(
    [T.StructField("seq", T.LongType()), T.StructField("language", T.StringType()), *RAW_REVIEWS.fields[:4]]
)


@query(
    "a1_csv_scan",
    with_views(
        "SELECT business_name, author_name, md5(text) AS text, rating::VARCHAR AS rating, photo FROM reviews", "reviews"
    ),
)
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    # another column order, a column of its own, no rating_category
    raw = reviews(spark, sf).select("photo", "rating", "text", "seq", "author_name", "business_name")
    write_table(raw, path, "csv")
    return read_reviews_csv(spark, path).withColumn("text", F.md5("text")).drop("rating_category")


@query("a2_parquet_scan", "SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def parquet_scan(spark, sf):
    present = read_table(spark, f"{sf}/documents.parquet").select("doc_id", "lang").filter("lang = 'fr'")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType())])
    absent = read_table(spark, f"{sf}/no_such_table.parquet", schema, missing_ok=True)
    return present.unionByName(absent)


@query(
    "a3_jsonl_scan",
    with_views("SELECT seq, language, business_name, md5(text) AS text, rating::VARCHAR AS rating FROM reviews", "reviews"),
)
def jsonl_scan(spark, sf):
    path = scratch_path(spark, "jsonl")
    rows = reviews(spark, sf).select("seq", "language", "business_name", "text", "rating")
    # every row is followed by a blank line, which the scan must skip
    lines = rows.select(F.concat(F.to_json(F.struct("*")), F.lit("\n")).alias("value"))
    lines.write.text(path)
    found = read_table(spark, path, JSON_REVIEWS, "json")
    return found.select("seq", "language", "business_name", F.md5("text").alias("text"), "rating")


LABEL_ROWS = with_views(
    """SELECT l.model, split_part(l.model, '/', 1) AS family, l.label, round(l."precision", 9) AS "precision",
              round(l.recall, 9) AS recall, round(l.f1, 9) AS f1, round(ap, 9) AS ap, tp + fn AS support, tn, fp, fn, tp
       FROM labelled l JOIN average_precisions a ON l.model = a.model AND l.label = a.label""",
    "labelled",
    "average_precisions",
)


def stored_labels(spark, path, *more):
    found = report_labels(read_reports(spark, path, *more))
    return found.select(
        "model",
        "family",
        "label",
        *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "ap")],
        "support",
        "confusion.*",
    )


@query("a4_reports_scan", LABEL_ROWS)
def reports_scan(spark, sf):
    path = scratch_path(spark, "reports")
    write_reports(evaluation.report(scored(spark, sf)), path)
    return stored_labels(spark, f"{path}/*/*.txt", f"{path}/absent/metrics.json")


@query(
    "a5_image_presence",
    """SELECT doc_id AS seq, doc_id % 4 = 0 AS has_image, doc_id % 4 IN (1, 2) AS dangling FROM documents""",
)
def image_presence(spark, sf):
    path = scratch_path(spark, "images")
    write_table(table(spark, sf, "documents").select("doc_id", "text"), f"{path}/img")
    kind, name = F.col("doc_id") % 4, F.col("_metadata.file_name")
    photo = F.when(kind == 0, F.concat(F.lit("img/"), name)).when(kind == 1, "img/gone.jpg")
    # the same file name in a folder that has no such file
    photo = photo.when(kind == 2, F.concat(F.lit("other/"), name))
    rows = spark.read.parquet(f"{path}/img").select(F.col("doc_id").alias("seq"), photo.alias("photo"))
    found = profile.with_image_presence(rows, read_image_listing(spark, path))
    return found.select(
        "seq", "has_image", (F.col("photo").isNotNull() & ~F.col("has_image")).alias("dangling")
    )


@query(
    "a5_image_stats",
    with_views(
        "SELECT count(*) FILTER (has_image) AS found, count(*) FILTER (NOT has_image) AS missing FROM unified", "unified"
    ),
)
def image_stats(spark, sf):
    return profile.image_stats(unify(reviews(spark, sf), language=None))


@query(
    "a6_requests",
    """SELECT conv_id, turn, role AS kind, CASE WHEN role = 'user' THEN trim(body) ELSE body END AS text,
              '' AS business_name, '' AS author_name, '' AS rating, false AS has_photo
       FROM (SELECT *, CASE WHEN turn % 5 = 0 THEN '  ' ELSE text END AS body FROM conversations)
       WHERE role = 'assistant' OR (role = 'user' AND trim(body) <> '')""",
)
def requests(spark, sf):
    kind = F.when(F.col("role") == "user", "single").when(F.col("role") == "assistant", "item")
    rows = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        kind.alias("kind"),
        F.when(F.col("turn") % 5 == 0, "  ").otherwise(F.col("text")).alias("text"),
        F.lit(None).cast("string").alias("rating"),
    )
    role = F.when(F.col("kind") == "single", "user").otherwise("assistant")
    return normalise_requests(rows).withColumn("kind", role)


@query(
    "b1_parquet_sink",
    with_views("SELECT seq, review_id, place_name, rating, has_image FROM unified", "unified"),
)
def parquet_sink(spark, sf):
    path = scratch_path(spark, "parquet")
    write_table(unify(reviews(spark, sf), language=None), path)
    schema = T.StructType([T.StructField("seq", T.LongType()), *REVIEWS.fields])
    return read_table(spark, path, schema).select("seq", "review_id", "place_name", "rating", "has_image")


@query(
    "b2_csv_mirror",
    with_views(
        "SELECT seq::VARCHAR AS seq, review_id, md5(text) AS text, business_name AS original, image_path FROM unified",
        "unified",
    ),
)
def csv_mirror(spark, sf):
    path = scratch_path(spark, "mirror")
    rows = unify(reviews(spark, sf), language=None)
    write_table(rows, path, "csv")
    flat = T.StructType([T.StructField(c, T.StringType()) for c in rows.columns])
    found = read_reviews_csv(spark, path, flat)
    original = F.from_json("metadata", METADATA)["original_business_name"]
    return found.select(
        "seq",
        "review_id",
        F.md5("text").alias("text"),
        original.alias("original"),
        F.coalesce("image_path", F.lit("")).alias("image_path"),
    )


@query(
    "b3_split_sink",
    with_views(
        """SELECT split, sum(size)::BIGINT AS n, count(*) AS businesses FROM trials
           WHERE trial = (SELECT trial FROM errors ORDER BY err, trial LIMIT 1) GROUP BY split""",
        sizes=SIZES,
        trials=TRIALS,
        errors=ERRORS,
    ),
)
def split_sink(spark, sf):
    path = scratch_path(spark, "splits")
    write_splits(split.split_by_group(businesses(spark, sf), "business"), path)
    schema = T.StructType(
        [T.StructField(n, t) for n, t in (("seq", T.LongType()), ("business", T.StringType()), ("split", T.StringType()))]
    )
    found = read_table(spark, path, schema, "json")
    return found.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("business").alias("businesses"))


@query("b4_report_sink", LABEL_ROWS)
def report_sink(spark, sf):
    path = scratch_path(spark, "report-sink")
    write_reports(evaluation.report(scored(spark, sf)), path)
    return stored_labels(spark, *[f"{path}/model_slug={m}" for m in ("encoder-m0", "baseline-m1", "sft-m2", "absent")])


@query(
    "b5_prediction_sink",
    with_views(
        """SELECT model, count(DISTINCT sample_id) AS n, CAST(sum(CAST(prob >= 0.5 AS INTEGER)) AS BIGINT) AS positives,
                  round(sum(prob), 3) AS mass FROM scored GROUP BY model""",
        "scored",
    ),
)
def prediction_sink(spark, sf):
    path = scratch_path(spark, "predictions")
    # a row of JSON is mostly names and digits: as plain text the sink is several times its input
    scored_rows = predictions(spark, sf).withColumn("pred", threshold_probs("probs", 0.5))
    write_table(scored_rows, path, "json", compression="gzip")
    schema = "model string, sample_id string, probs array<double>, pred array<int>"
    found = read_table(spark, path, T._parse_datatype_string(schema), "json")
    total = F.aggregate("probs", F.lit(0.0), lambda a, p: a + p)
    hits = F.aggregate("pred", F.lit(0).cast("long"), lambda a, p: a + p)
    return found.groupBy("model").agg(
        F.count_distinct("sample_id").alias("n"),
        F.sum(hits).alias("positives"),
        F.round(F.sum(total), 3).alias("mass"),
    )


@query(
    "b6_scan_sinks",
    over_scores(
        """SELECT 'all' AS part, business, reason, round(mean_topk, 6) AS mean_topk, max_high_cluster_size FROM flagged
           UNION ALL SELECT 'suspicious', business, reason, NULL, max_high_cluster_size FROM flagged WHERE reason <> ''"""
    ),
)
def scan_sinks(spark, sf):
    from reviewlens.operators.similarity import scan_businesses

    path = scratch_path(spark, "scan")
    scores = scan_businesses(vectors(spark, sf), SCAN)
    write_scan(scores, path)
    everything = read_table(spark, f"{path}/business_scores", scores.schema, "json")
    schema = T.StructType([f for f in scores.schema if f.name not in ("mean_topk", "dup_rate", "suspicious")])
    tight = read_table(spark, f"{path}/clusters", schema, "json")
    columns = ["part", "business", "reason", "mean_topk", "max_high_cluster_size"]
    return (
        everything.withColumns({"part": F.lit("all"), "mean_topk": F.round("mean_topk", 6)})
        .select(columns)
        .unionByName(
            tight.withColumns({"part": F.lit("suspicious"), "mean_topk": F.lit(None).cast("double")}).select(columns)
        )
    )
