"""The whole flow as lazily composed frames: ingest, annotate, augment, unify, split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions.policy import PolicyRule, annotate_rules, default_policies
from reviewlens.functions.text import business_key
from reviewlens.operators import balance, profile, split
from reviewlens.plans.adapters import TEST_POLICIES, reviews, with_views
from reviewlens.plans.balance_queries import ERRORS, META, NUMBERED, PLANNED, SHORTFALL, TRIALS
from reviewlens.plans.registry import query


def ingest(raw: DataFrame, language: str | None = "en") -> DataFrame:
    """Raw rows checked, unified and without repeats."""
    return balance.dedup_reviews(profile.unify(profile.require_columns(raw), language=language))


def training_table(
    annotated: DataFrame, synthetic: DataFrame | None = None, trials: int = 64, seed: int = 42
) -> DataFrame:
    """Original and synthetic rows in one schema, with their split."""
    rows = balance.training_rows(annotated)
    if synthetic is not None:
        rows = balance.combine(rows, balance.synthetic_training_rows(synthetic))
    # a business-less row is its own business; its key must not depend on the layout
    identity = F.md5(F.concat_ws("|", "author_name", "text", "source"))
    keyed = rows.withColumn("seq", identity)
    keyed = keyed.withColumn("_key", business_key(keyed, "surrogate"))
    return split.split_by_group(keyed, "_key", trials=trials, seed=seed).drop("_key", "seq")


def annotated_reviews(
    spark: SparkSession, sf: str, policies: list[PolicyRule] | None = None
) -> DataFrame:
    clean = ingest(reviews(spark, sf), language=None)
    return annotate_rules(clean, policies or default_policies())


FLAGSHIP = with_views(
    """SELECT place_name, count(*) AS n_reviews,
              CAST(sum(CAST(ad AS INTEGER)) AS BIGINT) AS advertisements,
              CAST(sum(CAST(irr AS INTEGER)) AS BIGINT) AS irrelevant,
              CAST(sum(CAST(rant AS INTEGER)) AS BIGINT) AS rants,
              CAST(sum(CAST(regexp_matches(text, '(?i)(https?://|www\\.)') AS INTEGER)) AS BIGINT) AS with_url
       FROM flags GROUP BY place_name""",
    "unified",
    kept="""SELECT * FROM unified QUALIFY row_number() OVER
            (PARTITION BY place_name, user_name, md5(text) ORDER BY seq) = 1""",
    hits="""SELECT *, contains(lower(text), 'mail')::INT + contains(lower(text), 'ing')::INT
                   + contains(lower(text), 'the')::INT AS promo,
                   contains(lower(text), 'ate')::INT + contains(lower(text), 'and')::INT AS unrelated,
                   contains(lower(text), 'that') AS ranting, contains(lower(text), 'ate') AS visited,
                   len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words
            FROM kept""",
    flags="""SELECT *, promo >= 2 OR (promo >= 1 AND regexp_matches(text, '(?i)(https?://|www\\.)')) AS ad,
                    unrelated >= 2 OR (unrelated = 1 AND words < 15) AS irr,
                    ranting AND NOT visited AS rant FROM hits""",
)

TRAINING_SPLITS = with_views(
    """SELECT t.split, r.source, count(*) AS n_rows, count(DISTINCT r.business) AS n_businesses,
              CAST(sum(r.ad) AS BIGINT) AS advertisements
       FROM training r JOIN trials t ON r.business = t.business
       WHERE t.trial = (SELECT trial FROM errors ORDER BY err, trial LIMIT 1) GROUP BY t.split, r.source""",
    "unified",
    kept="""SELECT * FROM unified QUALIFY row_number() OVER
            (PARTITION BY place_name, user_name, md5(text) ORDER BY seq) = 1""",
    shortfall=SHORTFALL,
    planned=PLANNED,
    numbered=NUMBERED,
    metas=META,
    training="""SELECT place_name AS business, 'original' AS source,
                       CAST(contains(lower(text), 'mail')::INT + contains(lower(text), 'ing')::INT
                       + contains(lower(text), 'the')::INT >= CASE WHEN
                       regexp_matches(text, '(?i)(https?://|www\\.)') THEN 1 ELSE 2 END AS INTEGER) AS ad FROM kept
                UNION ALL SELECT place_name, 'synthetic', CAST(policy = 'NoAdvertisement' AS INTEGER) FROM metas""",
    sizes="SELECT business, count(*) AS size FROM training GROUP BY business",
    trials=TRIALS,
    errors=ERRORS,
)


@query("flow_violations_per_business", FLAGSHIP)
def violations_per_business(spark: SparkSession, sf: str) -> DataFrame:
    from reviewlens.functions.text import has_url

    flagged = annotated_reviews(spark, sf, TEST_POLICIES)
    return flagged.groupBy("place_name").agg(
        F.count("*").alias("n_reviews"),
        F.sum("is_noadvertisement").alias("advertisements"),
        F.sum("is_noirrelevantcontent").alias("irrelevant"),
        F.sum("is_norantwithoutvisit").alias("rants"),
        F.sum(has_url("text").cast("int")).alias("with_url"),
    )


@query("flow_training_splits", TRAINING_SPLITS)
def training_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow: ingested and annotated originals, synthetic rows, one table, three splits."""
    from reviewlens.plans.balance_queries import synthetic

    rows = training_table(annotated_reviews(spark, sf, TEST_POLICIES), synthetic(spark, sf))
    return rows.groupBy("split", "source").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("business_name").alias("n_businesses"),
        F.sum("advertisement").alias("advertisements"),
    )
