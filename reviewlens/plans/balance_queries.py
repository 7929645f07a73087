"""Balancing, synthetic rows, repeats, unions and splits (inventory groups F, G, H, I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions.policy import annotate_rules, default_policies
from reviewlens.operators import balance, split
from reviewlens.operators.profile import unify
from reviewlens.plans.adapters import TEST_POLICIES, businesses, reviews, with_views
from reviewlens.plans.policy_queries import FLAGS, HITS
from reviewlens.plans.registry import query

LANGUAGES = ["en", "fr", "de"]


def class_shortfall(spark, sf) -> dict[str, int]:
    """Rows each policy lacks to reach a tenth of the reviews; three numbers."""
    row = reviews(spark, sf).agg(
        *[
            F.greatest(F.lit(0), F.ceil(F.count("*") / 10) - F.count_if(F.col(c) == 1)).alias(n)
            for n, c in (
                ("NoAdvertisement", "advertisement"),
                ("NoIrrelevantContent", "irrelevant_content"),
                ("NoRantWithoutVisit", "review_without_visit"),
            )
        ]
    ).first()
    return {k: int(v) for k, v in row.asDict().items()}


SHORTFALL = """SELECT p.policy, greatest(0, ceil(n / 10.0::DOUBLE) - hits)::BIGINT AS requested FROM (
                 SELECT unnest(['NoAdvertisement', 'NoIrrelevantContent', 'NoRantWithoutVisit']) AS policy,
                        unnest([sum(advertisement), sum(irrelevant_content), sum(review_without_visit)]) AS hits,
                        count(*) AS n FROM reviews) p"""


def draw_sql(n: str, *parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"(('0x' || substr(md5({joined}), 1, 15))::BIGINT % {n})"


_EXAMPLES = ", ".join(
    "('{}', [{}])".format(p.name, ", ".join("'" + e[0].replace("'", "''") + "'" for e in p.examples))
    for p in default_policies()
)
PLANNED = f"""SELECT s.policy, s.requested, a.attempt::BIGINT AS attempt,
                     ['en', 'fr', 'de'][{draw_sql("3", "'42'", "'language'", "s.policy", "a.attempt")} + 1] AS language,
                     e.examples[{draw_sql("3", "'42'", "'example'", "s.policy", "a.attempt")} + 1] AS example,
                     ({draw_sql("5", "'42'", "'rating'", "s.policy", "a.attempt")} + 1)::INTEGER AS rating
              FROM shortfall s, (SELECT unnest(range(1, (SELECT max(requested) + 1 FROM shortfall))) AS attempt) a,
                   (VALUES {_EXAMPLES}) e(policy, examples)
              WHERE a.attempt <= s.requested AND e.policy = s.policy"""


def planned(body: str, **own: str) -> str:
    return with_views(body, "unified", shortfall=SHORTFALL, planned=PLANNED, **own)


def plan(spark, sf, factor: int = 1):
    return balance.plan_synthetic(spark, class_shortfall(spark, sf), LANGUAGES, max_factor=factor)


@query("f1_request_plan", planned("SELECT policy, requested, attempt, language, example, rating FROM planned"))
def request_plan(spark, sf):
    return plan(spark, sf).drop("description")


META = f"""SELECT p.*, coalesce(b.place_name, 'synthetic_place') AS place_name, coalesce(b.user_name, '') AS user_name
           FROM planned p LEFT JOIN numbered b ON b.position = 1 +
                {draw_sql("(SELECT count(*) FROM unified)", "'42'", "'base'", "p.policy", "p.attempt")}"""
NUMBERED = "SELECT place_name, user_name, row_number() OVER (ORDER BY seq) AS position FROM unified"


def with_meta(spark, sf, factor: int = 1):
    base = unify(reviews(spark, sf), language=None)
    return balance.attach_meta(plan(spark, sf, factor), base, order=["seq"])


@query(
    "f2_sampled_meta",
    planned(
        "SELECT policy, attempt, place_name, user_name FROM metas", numbered=NUMBERED, metas=META
    ),
)
def sampled_meta(spark, sf):
    return with_meta(spark, sf).select("policy", "attempt", "place_name", "user_name")


def _prompt_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def fill(template: str, **names: str) -> str:
        sql = quoted(template)
        for name, column in names.items():
            sql = f"replace({sql}, '{{{name}}}', {column})"
        return sql

    about = "CASE policy " + " ".join(
        f"WHEN '{p.name}' THEN {quoted(p.description)}" for p in default_policies()
    ) + " END"
    return (
        f"{fill(balance.GENERATE_HEAD, policy='policy', description=about)}"
        f" || {fill(balance.GENERATE_EXAMPLE, example='example')}"
        f" || {fill(balance.GENERATE_TAIL, language='language', place='place_name')}"
    )


@query(
    "f3_generation_prompt",
    planned(
        f"SELECT policy, attempt, md5({_prompt_sql()}) AS prompt FROM metas", numbered=NUMBERED, metas=META
    ),
)
def generation_prompts(spark, sf):
    prompts = balance.generation_prompt(with_meta(spark, sf))
    return prompts.select("policy", "attempt", F.md5("prompt").alias("prompt"))


@query(
    "f4_sanitized",
    with_views("SELECT seq, md5(trim(trim(text, chr(10) || ' '), '\"')) AS text FROM reviews", "reviews"),
)
def sanitized(spark, sf):
    kind = F.col("seq") % 4
    wrapped = (
        F.when(kind == 0, F.concat(F.lit("```text\n"), "text", F.lit("\n```")))
        .when(kind == 1, F.concat(F.lit(' "'), "text", F.lit('" ')))
        .when(kind == 2, F.concat(F.lit("\n"), "text", F.lit("```  ")))
        .otherwise(F.col("text"))
    )
    return reviews(spark, sf).select("seq", F.md5(balance.sanitize_generated(wrapped)).alias("text"))


SYNTHETIC = """SELECT 'aug-none-' || policy || '-' || lpad(attempt::VARCHAR, 5, '0') AS review_id, place_name, user_name,
                      'About ' || place_name || ': ' || example AS text, language, rating, false AS has_image,
                      '' AS image_path, policy, attempt FROM metas"""


def synthetic(spark, sf):
    texts = with_meta(spark, sf).withColumn(
        "text", F.concat(F.lit("About "), "place_name", F.lit(": "), "example")
    )
    return balance.synthetic_rows(texts.withColumn("number", F.col("attempt")))


@query(
    "f5_synthetic_rows",
    planned(
        """SELECT review_id, place_name, user_name, text, language, rating, has_image, image_path,
                  '{"source":"synthetic","augment_slug":"none","policy":"' || policy || '","attempt":' || attempt
                  || ',"model":"template"}' AS metadata FROM made""",
        numbered=NUMBERED,
        metas=META,
        made=SYNTHETIC,
    ),
)
def synthetic_rows(spark, sf):
    return synthetic(spark, sf)


def template_generator():
    """A stand-in generator: fails on some prompts, else writes a line about the place."""
    import hashlib

    def write(prompt: str) -> str | None:
        if int(hashlib.md5(prompt.encode()).hexdigest()[:2], 16) % 3 == 0:
            return None
        place = prompt.split("Mention the place name '", 1)[1].split("'", 1)[0]
        return f'```\n"Never been to {place}, but I am told it is bad."\n```'

    return lambda prompts: [write(p) for p in prompts]


GENERATED = f"""SELECT *, row_number() OVER (PARTITION BY policy ORDER BY attempt) AS number FROM metas
                WHERE ('0x' || substr(md5({_prompt_sql()}), 1, 2))::BIGINT % 3 <> 0"""


@query(
    "f6_generated",
    with_views(
        """SELECT 'aug-none-' || policy || '-' || lpad(number::VARCHAR, 5, '0') AS review_id, place_name, attempt,
                  'Never been to ' || place_name || ', but I am told it is bad.' AS text
           FROM generated WHERE number <= requested""",
        "unified",
        shortfall=SHORTFALL,
        planned=PLANNED.replace("max(requested) + 1", "max(requested) * 5 + 1").replace(
            "a.attempt <= s.requested", "a.attempt <= s.requested * 5"
        ),
        numbered=NUMBERED,
        metas=META,
        generated=GENERATED,
    ),
)
def generated(spark, sf):
    prompts = balance.generation_prompt(with_meta(spark, sf, factor=5))
    made = balance.generate(prompts, template_generator)
    rows = balance.synthetic_rows(made)
    return rows.select(
        "review_id", "place_name", F.get_json_object("metadata", "$.attempt").cast("int").alias("attempt"), "text"
    )


@query(
    "f7_oversample",
    with_views(
        """SELECT seq, copy::INTEGER AS copy, md5('42|' || seq || '|' || copy) AS shuffle_key FROM marked,
                  (SELECT count(*) FILTER (positive) AS p, count(*) FILTER (NOT positive) AS n FROM marked) c,
                  (SELECT unnest(range(0, 1000)) AS copy) k
           WHERE copy <= CASE WHEN positive AND p > 0 AND p < n THEN ceil(n / p::DOUBLE) - 1 ELSE 0 END""",
        "reviews",
        marked="""SELECT seq, greatest(irrelevant_content, advertisement, review_without_visit) = 1 AS positive
                  FROM reviews""",
    ),
)
def oversampled(spark, sf):
    return balance.oversample(reviews(spark, sf)).select("seq", "copy", "shuffle_key")


@query(
    "g1_keep_first",
    with_views(
        """SELECT seq, review_id, language FROM unified
           QUALIFY row_number() OVER (PARTITION BY language, md5(text) ORDER BY seq) = 1""",
        "unified",
    ),
)
def keep_first(spark, sf):
    from reviewlens.functions.text import text_hash

    rows = unify(reviews(spark, sf), language=None).select(
        "seq", "review_id", "language", text_hash("text").alias("text_hash")
    )
    return balance.dedup_first(rows, ["language", "text_hash"]).drop("text_hash")


@query(
    "g2_keep_side_rows",
    with_views(
        """SELECT l.doc_id AS seq, l.quality, l.toxic FROM labels l JOIN (
             SELECT seq FROM reviews QUALIFY row_number() OVER (PARTITION BY language, text ORDER BY seq) = 1) k
           ON l.doc_id = k.seq""",
        "reviews",
    ),
)
def keep_side(spark, sf):
    from reviewlens.plans.adapters import table

    side = table(spark, sf, "labels").withColumnRenamed("doc_id", "seq")
    rows = reviews(spark, sf).select("seq", "language", F.md5("text").alias("text_hash"))
    return balance.keep_ids(side, balance.dedup_first(rows, ["language", "text_hash"]), "seq")


@query(
    "g3_repeats",
    with_views(
        """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT language, text FROM reviews)) AS duplicates
           FROM reviews""",
        "reviews",
    ),
)
def repeats(spark, sf):
    rows = reviews(spark, sf).select("language", F.md5("text").alias("text_hash"))
    return balance.repeat_count(rows, ["language", "text_hash"])


@query(
    "g4_removal_stats",
    with_views(
        """SELECT CAST(sum(n) AS BIGINT) AS before, count(*) AS after, CAST(sum(n) - count(*) AS BIGINT) AS removed,
                  CAST(sum(f) AS BIGINT) AS flagged_before, CAST(sum(k) AS BIGINT) AS flagged_keys
           FROM (SELECT count(*) AS n, count(*) FILTER (photo IS NOT NULL) AS f,
                        max(CAST(photo IS NOT NULL AS INTEGER)) AS k FROM reviews GROUP BY language, text)""",
        "reviews",
    ),
)
def removal_stats(spark, sf):
    rows = reviews(spark, sf).select("language", F.md5("text").alias("text_hash"), "photo")
    return balance.dup_stats(rows, ["language", "text_hash"], F.col("photo").isNotNull())


TRAINING = """SELECT u.place_name AS business_name, u.user_name AS author_name, u.text, u.language, u.rating,
                     u.has_image AS has_photo, regexp_matches(u.text, '(?i)(https?://|www\\.)') AS has_url,
                     CAST(f.ad AS INTEGER) AS advertisement, CAST(f.irr AS INTEGER) AS irrelevant_content,
                     CAST(f.rant AS INTEGER) AS review_without_visit, 'original' AS source
              FROM unified u JOIN flags f ON u.seq = f.seq
              UNION ALL
              SELECT place_name, user_name, text, language, rating, false, regexp_matches(text, '(?i)(https?://|www\\.)'),
                     CAST(policy = 'NoAdvertisement' AS INTEGER), CAST(policy = 'NoIrrelevantContent' AS INTEGER),
                     CAST(policy = 'NoRantWithoutVisit' AS INTEGER), 'synthetic' FROM made"""


def training(spark, sf):
    original = annotate_rules(unify(reviews(spark, sf), language=None), TEST_POLICIES)
    return balance.combine(
        balance.training_rows(original), balance.synthetic_training_rows(synthetic(spark, sf))
    )


@query(
    "h1_union",
    with_views(
        "SELECT * REPLACE (md5(text) AS text) FROM training",
        "unified",
        hits=HITS,
        flags=FLAGS,
        shortfall=SHORTFALL,
        planned=PLANNED,
        numbered=NUMBERED,
        metas=META,
        made=SYNTHETIC,
        training=TRAINING,
    ),
)
def union(spark, sf):
    return training(spark, sf).withColumn("text", F.md5("text"))


@query(
    "h2_union_with_repeats",
    with_views(
        """SELECT source, count(*) AS n, count(DISTINCT text) AS texts FROM
             (SELECT 'a' AS source, text FROM reviews UNION ALL SELECT 'b', text FROM reviews
              WHERE advertisement = 1 UNION ALL SELECT 'b', text FROM reviews WHERE advertisement = 1)
           GROUP BY source""",
        "reviews",
    ),
)
def union_with_repeats(spark, sf):
    rows = reviews(spark, sf).select(F.md5("text").alias("text"), "advertisement")
    positives = rows.filter("advertisement = 1").withColumn("source", F.lit("b"))
    bag = balance.combine(
        rows.withColumn("source", F.lit("a")), balance.combine(positives, positives)
    )
    return bag.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("text").alias("texts"))


SIZES = "SELECT o_custkey::VARCHAR AS business, count(*) AS size FROM orders GROUP BY o_custkey"
TRIALS = """SELECT trial, business, size, CASE WHEN mid < 0.7::DOUBLE THEN 'train'
                   WHEN mid < 0.7::DOUBLE + 0.15::DOUBLE THEN 'val' ELSE 'test' END AS split
            FROM (SELECT trial, business, size, (sum(size) OVER (PARTITION BY trial ORDER BY h, business) - size / 2.0::DOUBLE)
                         / (SELECT sum(size) FROM sizes)::DOUBLE AS mid
                  FROM (SELECT trial, business, size, md5('42|' || trial || '|' || business) AS h
                        FROM sizes, (SELECT unnest(range(0, 64)) AS trial)))"""
ERRORS = """SELECT trial, (n_train - t_train) ** 2 + (n_val - t_val) ** 2 + (n_test - (total - t_train - t_val)) ** 2 AS err,
                   n_train, n_val, n_test
            FROM (SELECT trial, sum(size) FILTER (split = 'train') AS n_train, sum(size) FILTER (split = 'val') AS n_val,
                         sum(size) FILTER (split = 'test') AS n_test FROM trials GROUP BY trial),
                 (SELECT sum(size) AS total, round_even(0.7::DOUBLE * sum(size), 0) AS t_train,
                         round_even(0.15::DOUBLE * sum(size), 0) AS t_val FROM sizes)"""


@query("i1_group_sizes", f"SELECT business, size FROM ({SIZES})")
def sizes(spark, sf):
    return split.group_sizes(businesses(spark, sf), "business")


@query(
    "i2_targets",
    """SELECT lang, round_even(0.7::DOUBLE * n, 0)::BIGINT AS train, round_even(0.15::DOUBLE * n, 0)::BIGINT AS val,
              (n - round_even(0.7::DOUBLE * n, 0) - round_even(0.15::DOUBLE * n, 0))::BIGINT AS test
       FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)""",
)
def targets(spark, sf):
    from reviewlens.plans.adapters import table

    counted = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return counted.select("lang", *[c.alias(s) for s, c in split.split_targets(F.col("n")).items()])


@query(
    "i3_best_assignment",
    with_views(
        """SELECT business, size, split FROM trials
           WHERE trial = (SELECT trial FROM errors ORDER BY err, trial LIMIT 1)""",
        sizes=SIZES,
        trials=TRIALS,
        errors=ERRORS,
    ),
)
def assignment(spark, sf):
    return split.best_assignment(split.group_sizes(businesses(spark, sf), "business"), "business")


@query(
    "i3_trial_errors",
    with_views(
        """SELECT trial::INTEGER AS trial, err::DOUBLE AS err, n_train::BIGINT AS n_train, n_val::BIGINT AS n_val,
                  n_test::BIGINT AS n_test FROM errors""",
        sizes=SIZES,
        trials=TRIALS,
        errors=ERRORS,
    ),
)
def errors(spark, sf):
    sized = split.group_sizes(businesses(spark, sf), "business")
    found = split.trial_errors(sized, "business", split.total_size(sized))
    return found.withColumn("err", F.col("err").cast("double"))


@query(
    "i4_split_rows",
    with_views(
        """SELECT o_orderkey AS seq, o_custkey::VARCHAR AS business, split FROM orders JOIN
             (SELECT business, split FROM trials WHERE trial = (SELECT trial FROM errors ORDER BY err, trial LIMIT 1)) a
           ON o_custkey::VARCHAR = a.business""",
        sizes=SIZES,
        trials=TRIALS,
        errors=ERRORS,
    ),
)
def split_rows(spark, sf):
    return split.split_by_group(businesses(spark, sf), "business")


@query(
    "i5_split_report",
    with_views(
        """SELECT split, sum(size)::BIGINT AS n_rows, count(*) AS n_businesses,
                  round(sum(size) / (SELECT sum(size) FROM sizes)::DOUBLE, 6) AS ratio, 0::BIGINT AS leaked_keys
           FROM trials WHERE trial = (SELECT trial FROM errors ORDER BY err, trial LIMIT 1) GROUP BY split""",
        sizes=SIZES,
        trials=TRIALS,
        errors=ERRORS,
    ),
)
def report(spark, sf):
    rows = split.split_by_group(businesses(spark, sf), "business")
    return split.split_report(rows, "business").withColumn("ratio", F.round("ratio", 6))
