"""Class balancing, synthetic rows, repeat removal, unions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.policy import PolicyRule, default_policies, policy_one_hot
from reviewlens.functions.text import any_positive, has_url, text_or_empty
from reviewlens.operators.ordered import null_safe, with_dense_ids
from reviewlens.operators.profile import parse_metadata
from reviewlens.schemas import LABELS

# Generation prompt.
GENERATE_HEAD = """\
You are generating a single synthetic Google-style location review.
Target policy to VIOLATE: {policy}.
Policy description: {description}
"""
GENERATE_EXAMPLE = """\
Here is ONE example of a violating review (for guidance only):
Example: {example}
Do NOT copy or paraphrase this example. Produce a distinct review.
"""
GENERATE_TAIL = """\
Write a plausible review that clearly violates this policy while remaining realistic.
Constraints:
- Language: {language}
- Mention the place name '{place}' naturally.
- Length: 1-3 sentences.
- No disclaimers, no meta commentary, no quotes or code blocks.
Output: Only the review text."""
FALLBACK_PLACE = "synthetic_place"


def draw(n: Column | int, *parts: Column | str | int) -> Column:
    """A repeatable draw from 0..n-1: 60 bits of the md5 of the parts, so any layout and engine agrees."""
    shown = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digits = F.substring(F.md5(F.concat_ws("|", *shown)), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), n if isinstance(n, Column) else F.lit(n))


def plan_synthetic(
    spark: SparkSession,
    classes: dict[str, int],
    languages: list[str] | None = None,
    seed: int = 42,
    max_factor: int = 1,
    policies: list[PolicyRule] | None = None,
) -> DataFrame:
    """One row per generation attempt: policy, attempt number, language, example for guidance, rating."""
    languages = languages or ["en"]
    known = {p.name: p for p in policies or default_policies()}
    unknown = [c for c in classes if c not in known]
    if unknown:
        raise ValueError(f"Unknown policy in classes: {unknown}. Known: {list(known)}")
    asked = [(name, known[name].description, [e[0] for e in known[name].examples], int(n))
             for name, n in classes.items()]
    schema = "policy string, description string, examples array<string>, requested bigint"
    plan = spark.createDataFrame(asked, schema).filter("requested > 0")
    # the plan itself is split over the cluster, in runs of 10,000 attempts
    top = F.col("requested") * max_factor
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(requested * {int(max_factor)} - 1) div 10000")))
    runs = plan.withColumn("_run", run).repartition("policy", "_run")
    attempt = F.explode(
        F.sequence(F.col("_run") * 10000 + 1, F.least(top, (F.col("_run") + 1) * 10000))
    )
    rows = runs.withColumn("attempt", attempt)
    pick = draw(F.greatest(F.size("examples"), F.lit(1)), seed, "example", F.col("policy"), F.col("attempt"))
    language = F.array(*[F.lit(x) for x in languages])
    return rows.select(
        "policy",
        "description",
        "requested",
        "attempt",
        F.get(language, draw(len(languages), seed, "language", F.col("policy"), F.col("attempt")).cast("int"))
        .alias("language"),
        F.get("examples", pick.cast("int")).alias("example"),
        (draw(5, seed, "rating", F.col("policy"), F.col("attempt")) + 1).cast("int").alias("rating"),
    )


def attach_meta(plan: DataFrame, base: DataFrame, seed: int = 42, order: list[str] | None = None) -> DataFrame:
    """Place and user of a drawn base row per planned row; fabricated where the base has none."""
    order = order or ["review_id"]
    number = (F.col("policy"), F.col("attempt"))
    fallback_user = F.concat(F.lit("user_"), (draw(9000, seed, "user", *number) + 1000).cast("string"))
    positions = with_dense_ids(base.select(*order, "place_name", "user_name"), order, "_position")
    positions = positions.select("_position", "place_name", "user_name")
    n = positions.count()
    if n == 0:
        return plan.withColumns({"place_name": F.lit(FALLBACK_PLACE), "user_name": fallback_user})
    # every drawn position exists, so this is an inner join and may broadcast the plan if it is small
    met = plan.withColumn("_position", draw(n, seed, "base", *number)).join(positions, "_position")
    return met.drop("_position").withColumns(
        {
            "place_name": F.coalesce(F.nullif("place_name", F.lit("")), F.lit(FALLBACK_PLACE)),
            "user_name": F.coalesce(F.nullif("user_name", F.lit("")), fallback_user),
        }
    )


def generation_prompt(plan: DataFrame) -> DataFrame:
    """The generation prompt per planned row; the example part only where there is one."""

    def fill(template: str, **columns: str) -> Column:
        text = F.lit(template)
        for name, source in columns.items():
            text = F.replace(text, F.lit("{" + name + "}"), F.col(source))
        return text

    guidance = F.when(
        F.coalesce("example", F.lit("")) != "", fill(GENERATE_EXAMPLE, example="example")
    ).otherwise("")
    return plan.withColumn(
        "prompt",
        F.concat(
            fill(GENERATE_HEAD, policy="policy", description="description"),
            guidance,
            fill(GENERATE_TAIL, language="language", place="place_name"),
        ),
    )


def sanitize_generated(c: Column | str) -> Column:
    """Generated text without code fences, surrounding white space and double quotes."""
    text = F.regexp_replace(text_or_empty(c), r"^\s+|\s+$", "")
    fenced = text.startswith("```")
    opened = (
        F.when(fenced & text.contains("\n"), F.regexp_replace(text, r"^[^\n]*\n", ""))
        .when(fenced, F.regexp_replace(text, r"^`+|`+$", ""))
        .otherwise(text)
    )
    closed = F.when(opened.endswith("```"), F.regexp_replace(opened, r"\s*```$", "")).otherwise(opened)
    return F.regexp_replace(F.regexp_replace(closed, r"^\s+|\s+$", ""), r'^"+|"+$', "")


def synthetic_rows(generated: DataFrame, slug: str = "none", model: str = "template") -> DataFrame:
    """Unified rows from generated texts. Expects policy, number (1..n per policy), attempt and meta."""
    metadata = F.to_json(
        F.struct(
            F.lit("synthetic").alias("source"),
            F.lit(slug).alias("augment_slug"),
            F.col("policy"),
            F.col("attempt"),
            F.lit(model).alias("model"),
        )
    )
    return generated.select(
        F.format_string(f"aug-{slug}-%s-%05d", "policy", "number").alias("review_id"),
        "place_name",
        "user_name",
        "text",
        "language",
        F.col("rating").cast("int").alias("rating"),
        F.lit(False).alias("has_image"),
        F.lit("").alias("image_path"),
        metadata.alias("metadata"),
    )


Generator = Callable[[list[str]], list[str | None]]


def generate(
    prompts: DataFrame, make_generator: Callable[[], Generator], prompt: str = "prompt"
) -> DataFrame:
    """Runs a pluggable generator over planned attempts; failed ones (None) are dropped and the first
    ``requested`` successes per policy kept, numbered in attempt order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = make_generator()
        for batch in batches:
            yield batch.assign(text=generator(batch[prompt].tolist()))

    schema = T.StructType([*prompts.schema.fields, T.StructField("text", T.StringType())])
    made = prompts.mapInPandas(run, schema).filter("text IS NOT NULL")
    made = made.withColumn("text", sanitize_generated("text"))
    return first_successes(made)


def first_successes(made: DataFrame) -> DataFrame:
    """The first ``requested`` rows per policy in attempt order, numbered from 1."""
    from reviewlens.operators.ordered import with_running_sums

    numbered = with_running_sums(
        made.withColumn("_one", F.lit(1).cast("long")), ["policy"], ["attempt"], {"number": "_one"}
    )
    return numbered.filter(F.col("number") <= F.col("requested")).drop("_one")


def oversample(df: DataFrame, labels: list[str] = LABELS, seed: int = 42, key: str = "seq") -> DataFrame:
    """Repeats rows with any positive label towards one positive per negative: ceil(neg/pos)-1 copies.

    ``copy`` is 0 for the original. ``shuffle_key`` is a seeded random order; sort or range-partition
    on it to shuffle.
    """
    marked = df.withColumn("_any", any_positive(labels))
    positives, negatives = (marked.agg(F.count_if(c)).scalar() for c in (F.col("_any"), ~F.col("_any")))
    extra = F.when(
        F.col("_any") & (positives > 0) & (positives < negatives),
        F.ceil(negatives / positives) - 1,
    ).otherwise(0)
    # in runs of 10,000 copies, so that no row holds them all
    last = extra.cast("long")
    runs = marked.withColumn("_last", last).withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("_last div 10000")))
    )
    copy = F.sequence(F.col("_run") * 10000, F.least(F.col("_last"), F.col("_run") * 10000 + 9999))
    copies = runs.withColumn("copy", F.explode(copy)).drop("_any", "_last", "_run")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.col("copy").cast("string")))
    return copies.withColumn("shuffle_key", order)


def shuffled(df: DataFrame) -> DataFrame:
    return df.orderBy("shuffle_key").drop("shuffle_key")


def dedup_first(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The row with the lowest ``seq`` per key; null keys are equal to each other, ``seq`` is unique.

    The lowest numbers come from keys and numbers alone; the rows then meet them by a hashed semi-join, so
    texts are neither aggregated nor sorted.
    """
    first = df.groupBy(*keys).agg(F.min(seq).alias(seq))
    return null_safe(df, first.hint("shuffle_hash"), [*keys, seq], "left_semi")


def dedup_reviews(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Keep-first on (place, user, text), with the md5 of the text as grouping key."""
    from reviewlens.functions.text import text_hash

    hashed = df.withColumn("text_hash", text_hash("text"))
    return dedup_first(hashed, ["place_name", "user_name", "text_hash"], seq).drop("text_hash")


def keep_ids(df: DataFrame, kept: DataFrame, key: str = "review_id") -> DataFrame:
    """Side rows whose id survived."""
    return df.join(kept.select(key), key, "left_semi")


def repeat_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows repeat an earlier row's key."""
    return df.agg((F.count("*") - F.count_distinct(F.struct(*keys))).alias("duplicates"))


def dup_stats(df: DataFrame, keys: list[str], flag: Column | None = None) -> DataFrame:
    """Rows before, after and removed by keep-first on the keys; with ``flag``, flagged rows too."""
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *([F.count_if(flag).alias("f"), F.max(flag.cast("int")).alias("k")] if flag is not None else []),
    )
    out = [
        F.sum("n").alias("before"),
        F.count("*").alias("after"),
        (F.sum("n") - F.count("*")).alias("removed"),
    ]
    if flag is not None:
        out += [F.sum("f").alias("flagged_before"), F.sum("k").alias("flagged_keys")]
    return per_key.agg(*out)


def training_rows(annotated: DataFrame, compat_drop_photo: bool = False) -> DataFrame:
    """Annotated originals as training rows."""
    from reviewlens.functions.policy import flags_to_labels

    photo = (
        F.coalesce("has_image", F.lit(False))
        if "has_image" in annotated.columns and not compat_drop_photo
        else F.lit(False)
    )
    return flags_to_labels(annotated).select(
        *_training_columns(photo), *_label_columns(), F.lit("original").alias("source")
    )


def synthetic_training_rows(synthetic: DataFrame) -> DataFrame:
    """Synthetic rows as training rows, labelled by the policy in their metadata."""
    named = synthetic.withColumn("_policy", parse_metadata("metadata")["policy"])
    photo = F.coalesce("has_image", F.lit(False)) if "has_image" in synthetic.columns else F.lit(False)
    return policy_one_hot(named, "_policy").select(
        *_training_columns(photo), *_label_columns(), F.lit("synthetic").alias("source")
    )


def _training_columns(photo: Column) -> list[Column]:
    return [
        text_or_empty("place_name").alias("business_name"),
        text_or_empty("user_name").alias("author_name"),
        text_or_empty("text").alias("text"),
        text_or_empty("language").alias("language"),
        F.coalesce("rating", F.lit(0)).cast("int").alias("rating"),
        photo.alias("has_photo"),
        has_url("text").alias("has_url"),
    ]


def _label_columns() -> list[Column]:
    return [F.col(name) for name in ("advertisement", "irrelevant_content", "review_without_visit")]


def combine(original: DataFrame, synthetic: DataFrame) -> DataFrame:
    """All rows of both, by column name; nothing is removed."""
    return original.unionByName(synthetic)
