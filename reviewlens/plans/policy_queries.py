"""Policy annotation (inventory group E)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from reviewlens.functions import policy as po
from reviewlens.plans.adapters import TEST_POLICIES, TEST_VOCABULARY, reviews, table, with_views
from reviewlens.plans.registry import query
from reviewlens.plans.text_queries import WORDS

HITS = f"""SELECT seq, contains(lower(text), 'mail')::INT + contains(lower(text), 'ing')::INT
                  + contains(lower(text), 'the')::INT AS promo,
                  contains(lower(text), 'ate')::INT + contains(lower(text), 'and')::INT AS unrelated,
                  contains(lower(text), 'that') AS ranting, contains(lower(text), 'ate') AS visited,
                  regexp_matches(text, '(?i)(https?://|www\\.)') AS url, {WORDS} AS words FROM reviews"""
FLAGS = """SELECT seq, promo >= 2 OR (promo >= 1 AND url) AS ad,
                  unrelated >= 2 OR (unrelated = 1 AND words < 15) AS irr, ranting AND NOT visited AS rant,
                  CASE WHEN url AND promo > 0 THEN 0.99::DOUBLE WHEN promo >= 2 THEN 0.96 ELSE 0.7 END AS ad_conf,
                  CASE WHEN unrelated >= 2 THEN 0.95::DOUBLE WHEN unrelated = 1 AND words < 15 THEN 0.92
                       ELSE 0.7 END AS irr_conf,
                  CASE WHEN ranting AND NOT visited THEN 0.98::DOUBLE ELSE 0.7 END AS rant_conf FROM hits"""


def flagged(body: str) -> str:
    return with_views(body, "reviews", hits=HITS, flags=FLAGS)


@query(
    "e1_advertisement_rule",
    """SELECT page_id, n >= 2 OR (url AND n > 0) AS flag,
              CASE WHEN url AND n > 0 THEN 0.99::DOUBLE WHEN n >= 2 THEN 0.96 ELSE 0.7 END AS confidence,
              CASE WHEN url AND n > 0 THEN 'Contains URL and promotional word (likely advertisement)'
                   WHEN n >= 2 THEN 'Contains multiple promotional words'
                   ELSE 'No strong advertisement detected' END AS reason
       FROM (SELECT page_id, regexp_matches(html, '(?i)(https?://|www\\.)') AS url,
                    contains(lower(html), 'mail')::INT + contains(lower(html), 'ing')::INT
                    + contains(lower(html), 'the')::INT AS n FROM pages)""",
)
def advertisement(spark, sf):
    rows = table(spark, sf, "pages").select(
        "page_id", po.advertisement_rule("html", TEST_VOCABULARY).alias("r")
    )
    return rows.select("page_id", "r.*")


@query(
    "e2_irrelevant_rule",
    flagged(
        """SELECT h.seq, irr AS flag, irr_conf AS confidence,
                  CASE WHEN unrelated >= 2 THEN 'Mentions multiple unrelated topics' WHEN irr
                       THEN 'Short review about unrelated topic' ELSE 'Content appears relevant' END AS reason
           FROM hits h JOIN flags f ON h.seq = f.seq"""
    ),
)
def irrelevant(spark, sf):
    rows = reviews(spark, sf).select("seq", po.irrelevant_rule("text", TEST_VOCABULARY).alias("r"))
    return rows.select("seq", "r.*")


@query(
    "e3_rant_rule",
    flagged(
        """SELECT seq, rant AS flag, rant_conf AS confidence, CASE WHEN rant THEN
                  'Rant phrase present and no evidence of visit' ELSE 'Likely visited or not a rant' END AS reason
           FROM flags"""
    ),
)
def rant(spark, sf):
    rows = reviews(spark, sf).select("seq", po.rant_rule("text", TEST_VOCABULARY).alias("r"))
    return rows.select("seq", "r.*")


@query(
    "e4_all_policies",
    flagged(
        """SELECT seq, CAST(ad AS INTEGER) AS is_noadvertisement, CAST(irr AS INTEGER) AS is_noirrelevantcontent,
                  CAST(rant AS INTEGER) AS is_norantwithoutvisit FROM flags"""
    ),
)
def all_policies(spark, sf):
    return po.annotate_rules(reviews(spark, sf), TEST_POLICIES).select(
        "seq", "is_noadvertisement", "is_noirrelevantcontent", "is_norantwithoutvisit"
    )


@query(
    "e4_default_policies",
    with_views(
        """SELECT seq, CAST(contains(lower(text), 'visit')::INT + contains(lower(text), 'discount')::INT
                  + contains(lower(text), 'promo')::INT + contains(lower(text), 'deal')::INT
                  + contains(lower(text), 'offer')::INT + contains(lower(text), 'sale')::INT
                  >= CASE WHEN regexp_matches(text, '(?i)(https?://|www\\.)') THEN 1 ELSE 2 END AS INTEGER)
                  AS is_noadvertisement FROM reviews""",
        "reviews",
    ),
)
def default_policies(spark, sf):
    return po.annotate_rules(reviews(spark, sf)).select("seq", "is_noadvertisement")


def prompt_sql() -> str:
    """The prompt around a review, per policy, as SQL literals."""
    heads = []
    for p in po.default_policies():
        shots = "".join(f"\nReview: {r}\nResponse: {json.dumps(a)}\n" for r, a in p.examples)
        head = po.PROMPT_STEPS.format(policy=p.name, description=p.description)
        text = f"{head}\n\nPast Examples: {shots}\nReview Information:\n".replace("'", "''")
        heads.append(f"('{p.name}', '{text}')")
    info = " || chr(10) || ".join(
        [
            "'Business Name: ' || place_name",
            "'User Name: ' || user_name",
            "'Text: ' || text",
            "'Rating: ' || rating",
            "'Language: ' || language",
            "'Has Image: ' || CASE WHEN has_image THEN 'True' ELSE 'False' END",
            "'Image Path: ' || image_path",
            "'Metadata: '",
        ]
    )
    return with_views(
        f"""SELECT seq, policy, md5(head || {info} || chr(10) || 'Response: ') AS prompt
            FROM unified, (VALUES {", ".join(heads)}) p(policy, head)""",
        "unified",
    )


@query("e5_prompts", prompt_sql())
def prompts(spark, sf):
    from reviewlens.operators.profile import unify

    rows = unify(reviews(spark, sf), language=None).drop("metadata")
    return po.policy_prompts(rows, keep=["seq"]).select("seq", "policy", F.md5("prompt").alias("prompt"))


@query(
    "e6_annotate_with_rules",
    flagged(
        """SELECT seq, 'NoAdvertisement' AS policy, CAST(ad AS INTEGER) AS label FROM flags
           UNION ALL SELECT seq, 'NoIrrelevantContent', CAST(irr AS INTEGER) FROM flags
           UNION ALL SELECT seq, 'NoRantWithoutVisit', CAST(rant AS INTEGER) FROM flags"""
    ),
)
def annotate_offline(spark, sf):
    answers = F.array(
        *[
            F.struct(F.lit(p.name).alias("policy"), po.rule_response(p.column_fn(F.col("text"))).alias("response"))
            for p in TEST_POLICIES
        ]
    )
    rows = reviews(spark, sf).select("seq", F.inline(answers))
    return rows.select("seq", "policy", po.gate(po.parse_response("response"), 0.9).alias("label"))


def keyword_responder():
    """A stand-in annotator: answers from the review part of the prompt alone."""

    def answer(prompt: str) -> str:
        body = prompt.rsplit("Review Information:", 1)[1].lower()
        return json.dumps({"is_violation": "mail" in body, "confidence": 0.95})

    return lambda batch: [answer(p) for p in batch]


@query(
    "e6_annotate_with_responder",
    with_views(
        """SELECT seq, policy, CAST(contains(lower(text), 'mail') AS INTEGER) AS label FROM reviews,
           (VALUES ('NoAdvertisement'), ('NoIrrelevantContent'), ('NoRantWithoutVisit')) p(policy)""",
        "reviews",
    ),
)
def annotate_plugged(spark, sf):
    rows = reviews(spark, sf).select("seq", "text")
    asked = po.policy_prompts(rows, keep=["seq"])
    answered = po.annotate_with(asked, keyword_responder)
    return answered.select("seq", "policy", po.gate(po.parse_response("response"), 0.9).alias("label"))


RESPONSES = [
    '```json\n{"is_violation": true, "confidence": 0.95}\n```',
    '{"is_violation": true, "confidence": 0.79}',
    'so: {"confidence": 0.9} {"is_violation": false}',
    '{"is_violation": "false", "confidence": "0.9"}',
    '{"is_violation": null, "confidence": 0.9}',
    '{"a": {"b": 1}}',
    "no json",
    '{"is_violation": true, "confidence": null}',
    '{"is_violation": 0, "confidence": 1}',
]
RESPONSE_SQL = """SELECT doc_id, [true, true, true, true, false, NULL, NULL, true, false][doc_id % 9 + 1] AS is_violation,
                  ([0.95, 0.79, 0.9, 0.9, 0.9, 0.0, 0.0, 0.0, 1.0]::DOUBLE[])[doc_id % 9 + 1] AS confidence
                  FROM documents"""


def responses(spark, sf):
    answer = F.get(F.array(*[F.lit(r) for r in RESPONSES]), (F.col("doc_id") % 9).cast("int"))
    return table(spark, sf, "documents").select("doc_id", po.parse_response(answer).alias("r"))


@query("e7_parse_response", RESPONSE_SQL)
def parsed_responses(spark, sf):
    return responses(spark, sf).select("doc_id", "r.*")


@query(
    "e8_gate",
    f"""SELECT doc_id, CAST(coalesce(is_violation AND confidence >= 0.9, false) AS INTEGER) AS at_default,
               CAST(coalesce(is_violation AND confidence >= 0.75, false) AS INTEGER) AS at_lower
        FROM ({RESPONSE_SQL})""",
)
def gated(spark, sf):
    return responses(spark, sf).select(
        "doc_id", po.gate(F.col("r")).alias("at_default"), po.gate(F.col("r"), 0.75).alias("at_lower")
    )


@query(
    "e9_flags_to_labels",
    flagged(
        """SELECT seq, CAST(ad AS INTEGER) AS advertisement, CAST(irr AS INTEGER) AS irrelevant_content,
                  0 AS review_without_visit FROM flags"""
    ),
)
def labels_from_flags(spark, sf):
    some = po.annotate_rules(reviews(spark, sf).select("seq", "text"), TEST_POLICIES[:2])
    return po.flags_to_labels(some).select(
        "seq", "advertisement", "irrelevant_content", "review_without_visit"
    )


@query(
    "e10_policy_one_hot",
    """SELECT doc_id, CAST(doc_id % 5 = 0 AS INTEGER) AS advertisement, CAST(doc_id % 5 = 1 AS INTEGER) AS irrelevant_content,
              CAST(doc_id % 5 = 2 AS INTEGER) AS review_without_visit FROM documents""",
)
def one_hot(spark, sf):
    kind = F.col("doc_id") % 5
    name = (
        F.when(kind == 0, " NoAdvertisement ")
        .when(kind == 1, "NoIrrelevantContent")
        .when(kind == 2, "NoRantWithoutVisit")
        .when(kind == 3, F.col("lang"))
    )
    rows = table(spark, sf, "documents").select("doc_id", name.alias("policy"))
    return po.policy_one_hot(rows, "policy").drop("policy")


@query(
    "a7_policy_dimension",
    with_views(
        """SELECT language, policy, 3 AS n_examples, count(*) AS n_reviews FROM reviews,
           (VALUES ('NoAdvertisement'), ('NoIrrelevantContent'), ('NoRantWithoutVisit')) p(policy)
           GROUP BY language, policy""",
        "reviews",
    ),
)
def policy_dimension(spark, sf):
    rows = reviews(spark, sf).select("language", F.inline(po.policy_array()))
    return rows.groupBy("language", "policy", F.size("examples").alias("n_examples")).agg(
        F.count("*").alias("n_reviews")
    )
