"""Schema checks, data quality and exploratory profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.text import (
    has_photo,
    normalise_name,
    rating_out_of_range,
    review_id,
    short_text,
    text_hash,
    word_count,
)
from reviewlens.operators.ordered import any_of, exact_quantiles, join_heavy, null_safe
from reviewlens.schemas import METADATA, REQUIRED_RAW, SYNTHETIC_METADATA


def missing_columns(df: DataFrame, required: list[str] = REQUIRED_RAW) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str] = REQUIRED_RAW) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
    return df


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Adds the absent columns as constants."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient casts; values that do not convert become null and are counted in ``_rejects``."""
    turned = {c: F.col(c).try_cast(t) for c, t in types.items()}
    rejected = [(F.col(c).isNotNull() & v.isNull()).cast("int") for c, v in turned.items()]
    return df.withColumns({**turned, "_rejects": sum(rejected[1:], rejected[0])})


def reject_counts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """How many non-null values of each column fail to convert."""
    counts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias("rejected"),
        )
        for c, t in types.items()
    ]
    return df.agg(F.array(*counts).alias("_c")).select(F.inline("_c"))


def metadata_struct(source: str, photo: Column, category: Column) -> Column:
    return F.struct(
        F.lit(source).alias("source"),
        F.col("business_name").alias("business_name"),
        F.col("author_name").alias("author_name"),
        photo.alias("photo"),
        category.alias("rating_category"),
        F.col("business_name").alias("original_business_name"),
    ).cast(METADATA)


def parse_metadata(c: Column | str, schema: T.StructType = SYNTHETIC_METADATA) -> Column:
    """JSON metadata as a struct; bad or blank JSON gives null members."""
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    empty = F.from_json(F.lit("{}"), schema)
    return F.coalesce(F.from_json(text, schema, {"mode": "PERMISSIVE"}), empty)


def unify(df: DataFrame, source: str = "restaurant_reviews", language: str | None = "en") -> DataFrame:
    """Raw reviews in the unified schema, in one projection. ``photo`` and its kin are optional."""

    def optional(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")

    known = F.col("has_image") if "has_image" in df.columns else has_photo(optional("photo"))
    carried = ["seq"] if "seq" in df.columns else []
    return df.select(
        *carried,
        review_id("business_name", "author_name", "text").alias("review_id"),
        normalise_name("business_name").alias("place_name"),
        normalise_name("author_name", dashes=False).alias("user_name"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.lit(language) if language else F.col("language")).alias("language"),
        F.col("rating").try_cast("int").alias("rating"),
        known.alias("has_image"),
        optional("photo").alias("image_path"),
        metadata_struct(source, optional("photo"), optional("rating_category")).alias("metadata"),
    )


def with_text_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("text_hash", text_hash("text"))


def text_only(df: DataFrame, compat_drop_photo: bool = False) -> DataFrame:
    """All reviews without the image path; ``compat_drop_photo`` also drops the presence flag."""
    return df.drop("image_path", "has_image") if compat_drop_photo else df.drop("image_path")


def with_images(df: DataFrame) -> DataFrame:
    return df.filter("has_image")


def missing_stats(df: DataFrame) -> DataFrame:
    """Columns with missing values, their number and share, most first. One pass over the data."""
    counts = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("missing_count"))
            for c in df.columns
        ]
    )
    return (
        df.agg(counts.alias("_c"), F.count("*").alias("_n"))
        .select(F.inline("_c"), "_n")
        .filter("missing_count > 0")
        .select(
            "column_name",
            "missing_count",
            (F.col("missing_count") / F.col("_n") * 100).alias("missing_pct"),
        )
        .orderBy(F.desc("missing_pct"), "column_name")
    )


def quality_issues(
    df: DataFrame,
    required: list[str] = REQUIRED_RAW,
    key: list[str] | None = None,
    text: str = "text",
    rating: str = "rating",
) -> DataFrame:
    """Issues present in the data as (issue, n, pct): missing required values, short texts, ratings
    outside 1-5, rows repeating an earlier key."""
    key = key or ["business_name", "author_name", "text"]
    # the repeat key is hashed before the shuffle, so that long texts do not travel
    parts = [F.md5(F.col(c)) if c == text else F.col(c) for c in key]
    repeat = F.count("*") - F.count_distinct(F.struct(*parts))
    issues = [(f"missing_{c}", F.count_if(F.col(c).isNull())) for c in required]
    issues += [
        ("short_text", F.count_if(short_text(text))),
        ("rating_out_of_range", F.count_if(rating_out_of_range(rating))),
        ("duplicate", repeat),
    ]
    named = [F.struct(F.lit(n).alias("issue"), c.alias("n")) for n, c in issues]
    return (
        df.agg(F.array(*named).alias("_i"), F.count("*").alias("_n"))
        .select(F.inline("_i"), "_n")
        .filter("n > 0")
        .select("issue", "n", F.round(F.col("n") / F.col("_n") * 100, 1).alias("pct"))
    )


def overview(df: DataFrame) -> DataFrame:
    """One row per column: its type, the table's row and column counts, its non-null values."""
    fields = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"), F.lit(t).alias("data_type"), F.count(n).alias("non_null")
            )
            for n, t in df.dtypes
        ]
    )
    return df.agg(fields.alias("_f"), F.count("*").alias("n_rows")).select(
        F.inline("_f"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column, all exact."""
    long = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]
            )
        ).alias("_x")
    ).select("_x.*")
    moments = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            )
            for c in columns
        ]
    )
    plain = df.agg(moments.alias("_m")).select(F.inline("_m"))
    quartiles = exact_quantiles(long, ["column_name"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return plain.join(quartiles, "column_name", "left")


def rating_distribution(df: DataFrame, rating: str = "rating") -> DataFrame:
    return df.filter(F.col(rating).isNotNull()).groupBy(rating).agg(F.count("*").alias("n")).orderBy(rating)


def center_spread(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Mean, exact median and sample standard deviation per named expression."""
    long = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(n).alias("measure"), c.cast("double").alias("v")) for n, c in columns.items()]
            )
        ).alias("_x")
    ).select("_x.*")
    moments = long.groupBy("measure").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    return moments.join(exact_quantiles(long, ["measure"], "v", {"median": 0.5}), "measure", "left")


def text_center(df: DataFrame, text: str = "text") -> DataFrame:
    return center_spread(
        df, {"text_length": F.length(text), "word_count": word_count(text)}
    ).select("measure", "mean", "median")


def equal_width_bins(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins between the extremes; the last bin is closed."""
    values = df.select(value.cast("double").alias("v")).filter("v IS NOT NULL")
    low, high = (values.agg(f("v")).scalar() for f in (F.min, F.max))
    start = F.when(low == high, low - 0.5).otherwise(low)
    width = F.when(low == high, F.lit(1.0)).otherwise(high - low) / bins
    slot = F.least(F.lit(bins - 1), F.floor((F.col("v") - start) / width)).cast("int")
    counted = values.groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def box_plot(df: DataFrame, group: str, value: Column) -> DataFrame:
    """Quartiles, whisker ends inside the 1.5 IQR fences and outlier count per group."""
    rows = df.select(group, value.cast("double").alias("v")).filter("v IS NOT NULL")
    quart = exact_quantiles(rows, [group], "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}).withColumns(
        {
            "_low": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
            "_high": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
        }
    )
    # equal values first, so that the join sees at most the distinct values of a group
    counted = rows.groupBy(group, "v").agg(F.count("*").alias("_n"))
    inside = F.col("v").between(F.col("_low"), F.col("_high"))
    return (
        null_safe(counted, quart, [group])
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
        )
    )


def review_statistics(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Reviews, distinct businesses and reviewers, mean text length and rating."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count("*").alias("total_reviews"),
        distinct("business_name").alias("unique_businesses"),
        distinct("author_name").alias("unique_reviewers"),
        F.avg(F.length("text")).alias("avg_length"),
        F.avg("rating").alias("avg_rating"),
    )


def photo_share(df: DataFrame, photo: str = "photo") -> DataFrame:
    return df.agg((F.avg(has_photo(photo).cast("int")) * 100).alias("photo_pct"))


def ingest_summary(df: DataFrame) -> DataFrame:
    """Totals after ingestion; coverage of an empty table is 0."""
    pictured = F.count_if("has_image")
    return df.agg(
        F.count("*").alias("total_reviews"),
        pictured.alias("reviews_with_images"),
        F.coalesce(F.try_divide(pictured, F.count("*")), F.lit(0.0)).alias("image_coverage"),
        F.count_distinct("place_name").alias("unique_places"),
        F.count_distinct("user_name").alias("unique_users"),
    )


def sample_rows(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first n rows, in a stated order where one is given."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def with_image_presence(
    df: DataFrame, listing: DataFrame, photo: str = "photo", file_name: str = "file_name", seq: str = "seq"
) -> DataFrame:
    """``has_image`` is true where the photo's path is listed; no photo means no image."""
    wanted = F.regexp_replace(F.col(photo), r"^(\./)+", "")
    # rows without a photo get keys that are no file names, so that they do not meet in one task
    nowhere = F.concat(F.lit("//"), F.pmod(F.xxhash64(seq), F.lit(1 << 20)).cast("string"))
    keyed = df.withColumn("_file", F.when(F.coalesce(F.col(photo), F.lit("")) != "", wanted).otherwise(nowhere))
    # one picture may be shown by a great many rows
    shown = keyed.groupBy("_file").agg(F.count("*").alias("_shown"))
    names = listing.select(F.col(file_name).alias("_file")).distinct().withColumn("_hit", F.lit(True))
    met = join_heavy(keyed, shown.join(names, "_file", "left"), ["_file"], "_shown", seq, "left")
    return met.withColumn("has_image", F.col("_hit").isNotNull()).drop("_file", "_hit")


def image_stats(df: DataFrame) -> DataFrame:
    """Photos found in the listing, and reviews without one."""
    return df.agg(
        F.count_if("has_image").alias("found"), F.count_if(~F.col("has_image")).alias("missing")
    )


def normalise_requests(df: DataFrame, kind: str = "kind") -> DataFrame:
    """Request rows with defaults filled. Single texts that are blank are dropped, listed ones kept.

    ``kind`` is 'single' or 'item'; anything else was not a record and is dropped.
    """
    full = ensure_columns(
        df, {"business_name": "", "author_name": "", "rating": "", "has_photo": False, "text": ""}
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    single = F.col(kind) == "single"
    stripped = F.when(single, F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))).otherwise(text)
    keep = any_of([F.col(kind) == "item", single & (stripped != "")])
    return full.filter(keep).withColumns(
        {
            "text": stripped,
            "business_name": F.coalesce("business_name", F.lit("")),
            "author_name": F.coalesce("author_name", F.lit("")),
            "rating": F.coalesce(F.col("rating").cast("string"), F.lit("")),
            "has_photo": F.coalesce(F.col("has_photo").cast("boolean"), F.lit(False)),
        }
    )
