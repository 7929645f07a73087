"""Scans: review CSV, Parquet, JSON lines, metric reports, image listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.schemas import RAW_REVIEWS, REPORT, REQUIRED_RAW


def read_reviews_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_REVIEWS
) -> DataFrame:
    """Raw reviews by the names in the header: any column order, other columns left out, absent optional ones null.

    Texts may hold line breaks and doubled quotes; lines may end in the Windows way. A required column that
    the header lacks is an error before anything is read.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    found = reader.option("enforceSchema", False).csv(path)
    named = found.toDF(*[c.strip().lstrip("\ufeff") for c in found.columns])
    absent = [c for c in REQUIRED_RAW if c in schema.names and c not in named.columns]
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
    return named.select(
        *[
            (F.col(f.name) if f.name in named.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _located(spark, path)
    return store.exists(target)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path that a pattern stands for, is there."""
    store, target = _located(spark, pattern)
    found = store.globStatus(target)
    return found is not None and len(found) > 0


def is_file(spark: SparkSession, path: str) -> bool:
    store, target = _located(spark, path)
    return store.exists(target) and store.getFileStatus(target).isFile()


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    missing_ok: bool = False,
) -> DataFrame:
    """Parquet or JSON-lines scan. A missing path gives an empty frame when a schema says its columns."""
    if missing_ok and not path_exists(spark, path):
        if schema is None:
            raise ValueError("missing_ok needs a schema")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "json":
        # the reader skips blank lines
        return reader.json(path)
    return reader.format(fmt).load(path)


def read_reports(spark: SparkSession, *paths: str) -> DataFrame:
    """Nested metric reports, one JSON document per file or line; absent files and empty patterns are left out.

    A document may be spread over lines as long as only its first brace begins one.
    """
    present = [p for p in paths if matches(spark, p)]
    if not present:
        return spark.createDataFrame([], REPORT)
    whole = spark.read.text(present, wholetext=True).select("value")
    each = whole.select(F.explode(F.split("value", r"\r?\n(?=\{)")).alias("value")).filter("trim(value) <> ''")
    return each.select(F.from_json("value", REPORT).alias("r")).filter("r is not null").select("r.*")


def report_labels(reports: DataFrame) -> DataFrame:
    """One row per (model, label) of a report frame."""
    return reports.select(
        "model",
        "family",
        "threshold",
        "n_samples",
        F.explode("per_label").alias("label", "m"),
    ).select("model", "family", "threshold", "n_samples", "label", "m.*")


def read_image_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the files under ``folder``, from there; the bytes are never read."""
    store, target = _located(spark, folder)
    root = store.makeQualified(target).toString().rstrip("/")
    inside = F.col("path").substr(F.lit(len(root) + 2), F.length("path"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(inside.alias("file_name"), "length")
