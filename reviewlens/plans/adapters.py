"""The given tables seen as reviews, scored rows, vectors, series and records, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions.policy import Vocabulary, default_policies
from reviewlens.operators.ordered import over_all_cores
from reviewlens.schemas import LABELS

# Words that occur in the invented prose of the test tables.
TEST_VOCABULARY = Vocabulary(
    promo=["mail", "ing", "the"], unrelated=["ate", "and"], rant=["that"], visit=["ate"]
)
TEST_POLICIES = default_policies(TEST_VOCABULARY)
MODELS = [("encoder/m0", 0.0), ("baseline/m1", 0.05), ("sft/m2", -0.05)]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return over_all_cores(docs, "doc_id").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("Biz "), "source", F.lit("-"), "lang").alias("business_name"),
        F.concat(F.lit("User "), (F.col("doc_id") % 97).cast("string")).alias("author_name"),
        "text",
        F.col("lang").alias("language"),
        (F.col("doc_id") % 5 + 1).cast("int").alias("rating"),
        F.when(
            F.col("doc_id") % 4 == 0, F.concat(F.lit("img/"), F.col("doc_id").cast("string"), F.lit(".jpg"))
        ).alias("photo"),
        F.coalesce("toxic", F.lit(0)).cast("int").alias("advertisement"),
        F.coalesce(1 - F.col("quality"), F.lit(0)).cast("int").alias("irrelevant_content"),
        (F.col("n_chars") % 11 == 0).cast("int").alias("review_without_visit"),
    )


def businesses(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("business")
    )


def sample_id():
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


def clipped(base: str):
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(base) + F.col("shift")))


def _label_parts():
    """(label, truth, base score) in label order."""
    return [
        ("irrelevant_content", F.col("l_linestatus") == "O", F.col("l_tax") * 12.5),
        ("advertisement", F.col("l_returnflag") == "R", F.col("l_discount") * 10),
        ("review_without_visit", F.col("l_quantity") > 25, F.col("l_quantity") / 50),
    ]


def _label_entries():
    return [
        F.struct(F.lit(label).alias("label"), truth.cast("int").alias("y_true"), base.alias("base"))
        for label, truth, base in _label_parts()
    ]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Long scored rows of three models, many scores tied."""
    models = F.array(
        *[F.struct(F.lit(n).alias("model"), F.lit(s).alias("shift")) for n, s in MODELS]
    )
    return (
        over_all_cores(table(spark, sf, "lineitem"), "l_orderkey")
        .select(sample_id().alias("sample_id"), F.inline(F.array(*_label_entries())))
        .select("*", F.inline(models))
        .select(
            "model",
            "sample_id",
            "label",
            "y_true",
            clipped("base").alias("prob"),
        )
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """(model, sample_id, probs) in label order."""
    models = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(s).alias("shift")) for n, s in MODELS])
    bases = [base.alias(label) for label, _, base in _label_parts()]
    return (
        over_all_cores(table(spark, sf, "lineitem"), "l_orderkey")
        .select(sample_id().alias("sample_id"), *bases, F.inline(models))
        .select("model", "sample_id", F.array(*[clipped(label) for label in LABELS]).alias("probs"))
    )


def truth(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        sample_id().alias("sample_id"),
        *[hit.cast("int").alias(label) for label, hit, _ in _label_parts()],
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("business"),
        F.col("vec_id").alias("seq"),
        F.col("embedding").alias("vector"),
    )


def records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.array("event_type").alias("ablr_use_cases"),
        F.array(F.concat(F.lit("User"), F.col("user_id").cast("string"))).alias("users"),
        F.array(F.concat(F.lit("H"), (F.col("user_id") % 7).cast("string"))).alias("hostnames"),
        F.col("ts").alias("log_start_time"),
    )


# The same views as SQL common table expressions, in dependency order.
CTE = {
    "reviews": """
        SELECT d.doc_id AS seq, 'Biz ' || d.source || '-' || d.lang AS business_name,
               'User ' || (d.doc_id % 97) AS author_name, d.text AS text, d.lang AS language,
               CAST(d.doc_id % 5 + 1 AS INTEGER) AS rating,
               CASE WHEN d.doc_id % 4 = 0 THEN 'img/' || d.doc_id || '.jpg' END AS photo,
               CAST(coalesce(l.toxic, 0) AS INTEGER) AS advertisement,
               CAST(coalesce(1 - l.quality, 0) AS INTEGER) AS irrelevant_content,
               CAST(d.n_chars % 11 = 0 AS INTEGER) AS review_without_visit
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "unified": """
        SELECT seq, substr(md5(business_name || author_name || text), 1, 16) AS review_id,
               replace(replace(lower(business_name), ' ', '_'), '-', '_') AS place_name,
               replace(lower(author_name), ' ', '_') AS user_name, text, language, rating,
               photo IS NOT NULL AS has_image, coalesce(photo, '') AS image_path,
               business_name, author_name
        FROM reviews""",
    "samples": """
        SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                  || CAST(round(l_extendedprice * 100) AS BIGINT) AS sample_id FROM lineitem""",
    "base_scores": """
        SELECT sample_id, 'irrelevant_content' AS label, CAST(l_linestatus = 'O' AS INTEGER) AS y_true,
               l_tax * 12.5 AS base FROM samples
        UNION ALL
        SELECT sample_id, 'advertisement', CAST(l_returnflag = 'R' AS INTEGER), l_discount * 10 FROM samples
        UNION ALL
        SELECT sample_id, 'review_without_visit', CAST(l_quantity > 25 AS INTEGER), l_quantity / 50 FROM samples""",
    "scored": """
        SELECT m.model, b.sample_id, b.label, b.y_true,
               least(1.0::DOUBLE, greatest(0.0::DOUBLE, b.base + m.shift)) AS prob
        FROM base_scores b, (VALUES ('encoder/m0', 0.0::DOUBLE), ('baseline/m1', 0.05::DOUBLE),
                                    ('sft/m2', -0.05::DOUBLE)) m(model, shift)""",
    "confusion": """
        SELECT model, label,
               count(*) FILTER (y_true = 0 AND prob < 0.5) AS tn,
               count(*) FILTER (y_true = 0 AND prob >= 0.5) AS fp,
               count(*) FILTER (y_true = 1 AND prob < 0.5) AS fn,
               count(*) FILTER (y_true = 1 AND prob >= 0.5) AS tp
        FROM scored GROUP BY model, label""",
    "labelled": """
        SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS "precision",
               CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
               CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (2 * tp + fp + fn) END AS f1
        FROM confusion""",
    "score_steps": """
        SELECT model, label, prob, sum(y_true) AS pos, count(*) AS n
        FROM scored GROUP BY model, label, prob""",
    "precision_steps": """
        SELECT model, label, pos,
               sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n
        FROM score_steps WINDOW w AS (PARTITION BY model, label ORDER BY prob DESC)""",
    "average_precisions": """
        SELECT model, label,
               coalesce(sum(pos * cum_pos::DOUBLE / cum_n) / nullif(sum(pos), 0), 0) AS ap
        FROM precision_steps GROUP BY model, label""",
    "pooled": """
        SELECT model, sum(tp)::DOUBLE AS tp, sum(fp)::DOUBLE AS fp, sum(fn)::DOUBLE AS fn,
               min(tn + fp + fn + tp) AS n_samples
        FROM confusion GROUP BY model""",
    "micros": """
        SELECT model, n_samples, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS "precision",
               CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
               CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
               split_part(model, '/', 1) AS family, split_part(model, '/', 2) AS short_name
        FROM pooled""",
}

_USES = {
    "unified": ["reviews"],
    "base_scores": ["samples"],
    "scored": ["base_scores"],
    "confusion": ["scored"],
    "labelled": ["confusion"],
    "score_steps": ["scored"],
    "precision_steps": ["score_steps"],
    "average_precisions": ["precision_steps"],
    "pooled": ["confusion"],
    "micros": ["pooled"],
}


def with_views(body: str, *names: str, recursive: bool = False, **own: str) -> str:
    """``body`` after the named views and what they use; ``own`` are further views of the query."""
    needed: list[str] = []

    def add(name: str) -> None:
        for used in _USES.get(name, []):
            add(used)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTE[n]})" for n in needed] + [f"{n} AS ({s})" for n, s in own.items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}" if parts else body
