"""Schema, quality and exploratory profile (inventory groups C and O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions.text import word_count
from reviewlens.operators import profile
from reviewlens.plans.adapters import reviews, table, with_views
from reviewlens.plans.registry import query
from reviewlens.plans.text_queries import WORDS
from reviewlens.schemas import REQUIRED_RAW


def sparse_reviews(spark, sf):
    """Reviews with holes: authors, texts and ratings missing or odd in places."""
    return reviews(spark, sf).select(
        "seq",
        "business_name",
        F.when(F.col("seq") % 10 != 0, F.col("author_name")).alias("author_name"),
        F.when(F.col("seq") % 25 != 0, F.col("text")).alias("text"),
        F.when(F.col("seq") % 4 != 0, F.col("rating") + (F.col("seq") % 20 == 1).cast("int") * 5).alias("rating"),
        "photo",
    )


SPARSE = """SELECT seq, business_name, CASE WHEN seq % 10 <> 0 THEN author_name END AS author_name,
                   CASE WHEN seq % 25 <> 0 THEN text END AS text,
                   CASE WHEN seq % 4 <> 0 THEN rating + CAST(seq % 20 = 1 AS INTEGER) * 5 END AS rating, photo
            FROM reviews"""


@query(
    "c1_required_columns",
    "SELECT 'rating' AS missing FROM documents HAVING count(*) > 0"
    " UNION ALL SELECT 'author_name' FROM documents HAVING count(*) > 0"
    " UNION ALL SELECT 'business_name' FROM documents HAVING count(*) > 0",
)
def required(spark, sf):
    docs = table(spark, sf, "documents")
    absent = F.array(*[F.lit(c) for c in profile.missing_columns(docs)])
    return docs.agg(F.count("*").alias("n")).select(F.explode(absent).alias("missing"))


@query(
    "c2_default_columns",
    "SELECT doc_id, lang, 0 AS rating, false AS has_photo, '' AS place_name FROM documents",
)
def defaults(spark, sf):
    return profile.ensure_columns(
        table(spark, sf, "documents").select("doc_id", "lang"),
        {"rating": 0, "has_photo": False, "place_name": "", "lang": "xx"},
    )


@query(
    "c3_casts",
    """SELECT event_id, TRY_CAST(props AS INTEGER) AS props, TRY_CAST(kind AS INTEGER) AS kind,
              CAST(props IS NOT NULL AS INTEGER) + CAST(TRY_CAST(kind AS INTEGER) IS NULL AS INTEGER) AS _rejects
       FROM (SELECT event_id, props, CASE WHEN event_id % 3 = 0 THEN event_type
                    ELSE CAST(user_id AS VARCHAR) END AS kind FROM events)""",
)
def casts(spark, sf):
    kind = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    rows = table(spark, sf, "events").select("event_id", "props", kind.alias("kind"))
    return profile.cast_columns(rows, {"props": "int", "kind": "int"})


@query(
    "c3_reject_counts",
    """SELECT 'props' AS column_name, count(*) AS rejected FROM events WHERE TRY_CAST(props AS INTEGER) IS NULL
       UNION ALL SELECT 'event_type', count(*) FROM events WHERE TRY_CAST(event_type AS INTEGER) IS NULL""",
)
def rejects(spark, sf):
    return profile.reject_counts(table(spark, sf, "events"), {"props": "int", "event_type": "int"})


@query(
    "c4_unified",
    with_views(
        """SELECT seq, review_id, place_name, user_name, md5(text) AS text, language, rating, has_image, image_path,
                  business_name AS original_business_name FROM unified""",
        "unified",
    ),
)
def unified(spark, sf):
    rows = profile.unify(reviews(spark, sf), language=None)
    return rows.withColumns(
        {"text": F.md5("text"), "original_business_name": F.col("metadata.original_business_name")}
    ).drop("metadata")


@query(
    "c5_missing",
    with_views(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_count,"
            f" round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM sparse"
            for c in ("seq", "business_name", "author_name", "text", "rating", "photo")
        )
        + ") WHERE missing_count > 0",
        "reviews",
        sparse=SPARSE,
    ),
)
def missing(spark, sf):
    found = profile.missing_stats(sparse_reviews(spark, sf))
    return found.withColumn("missing_pct", F.round("missing_pct", 6))


@query(
    "c6_quality_issues",
    with_views(
        """SELECT issue, n, round(n * 100.0::DOUBLE / total, 1) AS pct FROM (
             SELECT unnest(['missing_author_name', 'missing_text', 'missing_rating', 'short_text',
                            'rating_out_of_range', 'duplicate']) AS issue,
                    unnest([count(*) FILTER (author_name IS NULL), count(*) FILTER (text IS NULL),
                            count(*) FILTER (rating IS NULL), count(*) FILTER (length(text) <= 10),
                            count(*) FILTER (rating < 1 OR rating > 5),
                            count(*) - (SELECT count(*) FROM (SELECT DISTINCT business_name, author_name, text
                                                              FROM sparse))]) AS n,
                    count(*) AS total FROM sparse) WHERE n > 0""",
        "reviews",
        sparse=SPARSE,
    ),
)
def issues(spark, sf):
    return profile.quality_issues(sparse_reviews(spark, sf), REQUIRED_RAW)


@query(
    "c7_metadata",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN NULL ELSE 'Policy' || lang END AS policy,
              CASE WHEN doc_id % 3 = 1 THEN NULL ELSE doc_id END AS attempt FROM documents
       WHERE doc_id % 3 <> 2 UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE doc_id % 3 = 2""",
)
def metadata(spark, sf):
    good = F.to_json(F.struct(F.concat(F.lit("Policy"), "lang").alias("policy"), F.col("doc_id").alias("attempt")))
    kind = F.col("doc_id") % 3
    text = F.when(kind == 0, good).when(kind == 1, F.lit("{broken")).otherwise(F.lit(""))
    parsed = table(spark, sf, "documents").select("doc_id", profile.parse_metadata(text).alias("m"))
    return parsed.select("doc_id", "m.policy", "m.attempt")


@query(
    "o1_overview",
    "SELECT column_name, data_type, non_null, n_rows, 6 AS n_columns FROM (SELECT"
    " unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS column_name,"
    " unnest(['bigint', 'timestamp_ntz', 'bigint', 'string', 'double', 'string']) AS data_type,"
    " unnest([count(event_id), count(ts), count(user_id), count(event_type), count(value), count(props)])"
    " AS non_null, count(*) AS n_rows FROM events)",
)
def overview(spark, sf):
    return profile.overview(table(spark, sf, "events"))


@query(
    "o2_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,"
        f" min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(quantile_cont({c}, 0.25), 6) AS q25,"
        f" round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def describe(spark, sf):
    found = profile.describe_numeric(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    )
    return found.select(
        "column_name", "n", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q25", "q50", "q75")]
    )


@query("o3_ratings", with_views("SELECT rating, count(*) AS n FROM reviews GROUP BY rating", "reviews"))
def ratings(spark, sf):
    return profile.rating_distribution(reviews(spark, sf))


@query(
    "o4_rating_center",
    with_views(
        "SELECT 'rating' AS measure, round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS std,"
        " median(rating)::DOUBLE AS median FROM sparse",
        "reviews",
        sparse=SPARSE,
    ),
)
def rating_center(spark, sf):
    found = profile.center_spread(sparse_reviews(spark, sf), {"rating": F.col("rating")})
    return found.select("measure", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "median")


@query(
    "o5_text_center",
    with_views(
        f"""SELECT 'text_length' AS measure, round(avg(length(text)), 6) AS mean, median(length(text))::DOUBLE AS median
            FROM reviews UNION ALL SELECT 'word_count', round(avg({WORDS}), 6), median({WORDS})::DOUBLE FROM reviews""",
        "reviews",
    ),
)
def text_center(spark, sf):
    found = profile.text_center(reviews(spark, sf))
    return found.withColumn("mean", F.round("mean", 6))


@query(
    "o6_length_bins",
    with_views(
        """SELECT b.bin::INTEGER AS bin, round(lo + b.bin * ((hi - lo) / 50.0::DOUBLE), 6) AS bin_start,
                  count(seq) AS n FROM range(50) b(bin), edges LEFT JOIN placed ON placed.bin = b.bin
           GROUP BY b.bin, lo, hi""",
        "reviews",
        edges="SELECT min(length(text))::DOUBLE AS lo, max(length(text))::DOUBLE AS hi FROM reviews",
        placed="""SELECT seq, least(49, floor((length(text) - lo) / ((hi - lo) / 50.0::DOUBLE))) AS bin
                  FROM reviews, edges""",
    ),
)
def length_bins(spark, sf):
    found = profile.equal_width_bins(reviews(spark, sf), F.length("text"))
    return found.withColumn("bin_start", F.round("bin_start", 6))


@query(
    "o6_word_bins",
    with_views(
        """SELECT b.bin::INTEGER AS bin, count(seq) AS n FROM range(50) b(bin)
           LEFT JOIN placed ON placed.bin = b.bin GROUP BY b.bin""",
        "reviews",
        counted=f"SELECT seq, {WORDS} AS words FROM reviews",
        edges="SELECT min(words)::DOUBLE AS lo, max(words)::DOUBLE AS hi FROM counted",
        placed="""SELECT seq, least(49, floor((words - lo) / ((hi - lo) / 50.0::DOUBLE))) AS bin
                  FROM counted, edges""",
    ),
)
def word_bins(spark, sf):
    return profile.equal_width_bins(reviews(spark, sf), word_count("text")).select("bin", "n")


@query(
    "o7_box_plot",
    with_views(
        """SELECT rating, q1, median, q3, min(v) FILTER (inside) AS whisker_low, max(v) FILTER (inside) AS whisker_high,
                  count(*) FILTER (NOT inside) AS outliers
           FROM (SELECT r.rating, q1, median, q3, r.v, r.v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
                 FROM lens r JOIN quarts q ON r.rating = q.rating) GROUP BY rating, q1, median, q3""",
        "reviews",
        lens="SELECT rating, length(text)::DOUBLE AS v FROM reviews",
        quarts="""SELECT rating, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                         quantile_cont(v, 0.75) AS q3 FROM lens GROUP BY rating""",
    ),
)
def box(spark, sf):
    return profile.box_plot(reviews(spark, sf), "rating", F.length("text"))


@query(
    "o8_statistics",
    with_views(
        """SELECT count(*) AS total_reviews, count(DISTINCT business_name) AS unique_businesses,
                  count(DISTINCT author_name) AS unique_reviewers, round(avg(length(text)), 6) AS avg_length,
                  round(avg(rating), 6) AS avg_rating FROM reviews""",
        "reviews",
    ),
)
def statistics(spark, sf):
    found = profile.review_statistics(reviews(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in ("avg_length", "avg_rating")})


@query(
    "o9_photo_share",
    with_views(
        "SELECT round(avg(CAST(photo IS NOT NULL AS INTEGER)) * 100, 6) AS photo_pct FROM reviews", "reviews"
    ),
)
def photo_share(spark, sf):
    return profile.photo_share(reviews(spark, sf)).select(F.round("photo_pct", 6).alias("photo_pct"))


@query(
    "o10_ingest_summary",
    with_views(
        """SELECT count(*) AS total_reviews, count(*) FILTER (has_image) AS reviews_with_images,
                  round(count(*) FILTER (has_image) * 1.0::DOUBLE / count(*), 6) AS image_coverage,
                  count(DISTINCT place_name) AS unique_places, count(DISTINCT user_name) AS unique_users FROM unified""",
        "unified",
    ),
)
def ingest_summary(spark, sf):
    found = profile.ingest_summary(profile.unify(reviews(spark, sf), language=None))
    return found.withColumn("image_coverage", F.round("image_coverage", 6))


@query(
    "o11_sample_rows",
    with_views("SELECT seq, business_name, rating FROM reviews ORDER BY seq LIMIT 5", "reviews"),
)
def sample(spark, sf):
    return profile.sample_rows(reviews(spark, sf).select("seq", "business_name", "rating"), 5, ["seq"])
