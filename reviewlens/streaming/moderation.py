"""The row-wise moderation steps on a stream, streaming repeat removal, windowed violation counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.policy import PolicyRule, annotate_rules, default_policies, flags_to_labels
from reviewlens.functions.text import has_url, normalise_name, text_hash
from reviewlens.operators.dashboard import risk
from reviewlens.schemas import LABELS, POLICY_LABEL
from reviewlens.sources.readers import is_file
from reviewlens.sources.scratch import scratch_path


def stream_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table as a stream, be it a folder or a single file."""
    reader = spark.readStream.schema(schema)
    if is_file(spark, path):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def moderate(df: DataFrame, policies: list[PolicyRule] | None = None, threshold: float = 0.5) -> DataFrame:
    """Policy flags, URL flag and risk of each review. Stateless: batch and stream alike."""
    policies = policies or default_policies()
    by_label = {POLICY_LABEL[p.name]: p for p in policies if p.name in POLICY_LABEL}

    def probability(label: str):
        if label not in by_label:
            return F.lit(0.0)
        result = by_label[label].column_fn(F.col("text"))
        return F.when(result["flag"], result["confidence"]).otherwise(1 - result["confidence"])

    flagged = flags_to_labels(annotate_rules(df, policies)).withColumns(
        {"has_url": has_url("text"), "probs": F.array(*[probability(n) for n in LABELS])}
    )
    return risk(flagged, threshold, LABELS)


def dedup_stream(df: DataFrame, ts: str, delay: str = "1 hour") -> DataFrame:
    """First review per (place, user, text) within the watermark; state older than it is dropped."""
    keyed = df.withColumns(
        {
            "_place": normalise_name("business_name"),
            "_user": normalise_name("author_name", dashes=False),
            "_hash": text_hash("text"),
        }
    )
    return (
        keyed.withWatermark(ts, delay)
        .dropDuplicatesWithinWatermark(["_place", "_user", "_hash"])
        .drop("_place", "_user", "_hash")
    )


def violation_counts(
    df: DataFrame, ts: str, labels: list[str] = LABELS, width: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Rows and violations per label in event-time windows; rows later than ``delay`` are left out."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, width))
        .agg(
            F.count("*").alias("n_reviews"),
            *[F.sum(F.col(name).cast("long")).alias(name) for name in labels],
        )
        .select(F.col("window.start").alias("window_start"), "n_reviews", *labels)
    )


def run_available(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over everything available into the shared folder and reads the result back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")
