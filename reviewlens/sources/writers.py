"""Sinks: Parquet, CSV, JSON lines, per-model reports, scan results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    mode: str = "errorifexists",
    compression: str | None = None,
) -> None:
    """One sink for every flat output. CSV gets nested columns as JSON text. Readers know a compression by file names."""
    if fmt == "csv":
        df = df.select(
            *[
                F.to_json(f.name).alias(f.name)
                if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        # texts keep their outer white space
        writer = writer.options(
            header=True,
            escape='"',
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)


def write_splits(df: DataFrame, path: str, split: str = "split", mode: str = "errorifexists") -> None:
    """JSON lines, one folder per split, so that a reader of one split prunes the others."""
    write_table(df, path, "json", [split], mode)


def write_reports(reports: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON report per model, in a folder named after the model."""
    slug = F.regexp_replace(F.lower(F.trim("model")), r"[\s/\\]", "-")
    body = F.to_json(F.struct(*reports.columns)).alias("value")
    reports.select(slug.alias("model_slug"), body).write.mode(mode).partitionBy("model_slug").text(path)


def write_scan(scores: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All business scores, and beside them the suspicious ones without the cohesion columns.

    The second sink reads what the first one wrote, so the scan itself runs once.
    """
    spark = scores.sparkSession
    write_table(scores, f"{path}/business_scores", "json", mode=mode)
    written = spark.read.schema(scores.schema).json(f"{path}/business_scores")
    suspicious = written.filter("suspicious").drop("mean_topk", "dup_rate", "suspicious")
    write_table(suspicious, f"{path}/clusters", "json", mode=mode)
