"""Column types, label names and configuration shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Label space, in report order.
LABELS = ["irrelevant_content", "advertisement", "review_without_visit"]

# Policy name -> label it feeds.
POLICY_LABEL = {
    "NoAdvertisement": "advertisement",
    "NoIrrelevantContent": "irrelevant_content",
    "NoRantWithoutVisit": "review_without_visit",
}

REQUIRED_RAW = ["business_name", "author_name", "text", "rating"]

RAW_REVIEWS = T.StructType(
    [
        T.StructField("business_name", T.StringType()),
        T.StructField("author_name", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("photo", T.StringType()),
        T.StructField("rating_category", T.StringType()),
    ]
)

# Names of the metadata, and of the report and the defaults below.
METADATA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "source",
            "business_name",
            "author_name",
            "photo",
            "rating_category",
            "original_business_name",
        )
    ]
)

REVIEWS = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("place_name", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("has_image", T.BooleanType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

SYNTHETIC_METADATA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("augment_slug", T.StringType()),
        T.StructField("policy", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("model", T.StringType()),
    ]
)

_PRF = [T.StructField(n, T.DoubleType()) for n in ("precision", "recall", "f1")]
CONFUSION = T.StructType([T.StructField(n, T.LongType()) for n in ("tn", "fp", "fn", "tp")])
LABEL_METRICS = T.StructType(
    [
        *_PRF,
        T.StructField("ap", T.DoubleType()),
        T.StructField("support", T.LongType()),
        T.StructField("confusion", CONFUSION),
    ]
)
REPORT = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("n_samples", T.LongType()),
        T.StructField("per_label", T.MapType(T.StringType(), LABEL_METRICS)),
        T.StructField("macro", T.StructType(_PRF)),
        T.StructField("micro", T.StructType(_PRF)),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("sample_id", T.StringType()),
        T.StructField("probs", T.ArrayType(T.DoubleType())),
    ]
)


@dataclass(frozen=True)
class ScanConfig:
    """Settings of the per-business similarity scan."""

    min_reviews: int = 5
    topk: int = 5
    dup_threshold: float = 0.92
    sim_threshold: float = 0.85
    high_sim_threshold: float = 0.92
    min_cluster_size: int = 3
    overall_threshold: float = 0.82
    block_rows: int = 8192


@dataclass(frozen=True)
class FuseConfig:
    """Settings of the per-review coordination score and its fusion with a text score."""

    sim_threshold: float = 0.85
    min_samples: int = 2
    topk: int = 5
    dup_threshold: float = 0.92
    w_text: float = 0.7
    w_fraud: float = 0.3
    block_rows: int = 8192
