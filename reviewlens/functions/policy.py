"""Policy rules, prompts and response parsing."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.text import col, has_url, json_truthy, text_or_empty, word_count
from reviewlens.schemas import LABELS, POLICY_LABEL

# Keyword lists of the three rules.
PROMO_WORDS = ["visit", "discount", "promo", "deal", "offer", "sale"]
UNRELATED_WORDS = ["holiday", "trip", "vacation", "flight", "hotel"]
RANT_PHRASES = ["never been here", "haven't visited", "I heard", "someone told me", "I read"]
VISIT_WORDS = ["ate", "ordered", "visited", "went", "tried", "service", "food"]

# Few-shot examples per policy, as (review, response).
ADVERTISEMENT_EXAMPLES = [
    ("Best pizza! Visit www.pizzapromo.com for discounts!",
     {"is_violation": True, "confidence": 0.98,
      "reasoning": "Contains promotional language and a URL.",
      "violation_type": "advertisement",
      "indicators": ["Visit", "www.pizzapromo.com", "discounts"]}),
    ("Try our new burger deal at www.burgerpromo.com!",
     {"is_violation": True, "confidence": 0.97,
      "reasoning": "Promotional offer and website link.",
      "violation_type": "advertisement",
      "indicators": ["deal", "www.burgerpromo.com"]}),
    ("Great food and service, will come again.",
     {"is_violation": False, "confidence": 0.99,
      "reasoning": "No promotional content or links.",
      "violation_type": "none", "indicators": ["food", "service"]}),
]
IRRELEVANT_EXAMPLES = [
    ("I had a wonderful vacation in Hawaii.",
     {"is_violation": True, "confidence": 0.94,
      "reasoning": "Mentions vacation, not focused on restaurant experience.",
      "violation_type": "irrelevant", "indicators": ["vacation", "Hawaii"]}),
    ("My flight to Paris was delayed, so I stopped by this place.",
     {"is_violation": True, "confidence": 0.93,
      "reasoning": "Review is mostly about flight, not the location.",
      "violation_type": "irrelevant", "indicators": ["flight", "Paris"]}),
    ("The pasta was delicious and the staff were friendly.",
     {"is_violation": False, "confidence": 0.99,
      "reasoning": "Review is relevant to the restaurant.",
      "violation_type": "none", "indicators": ["pasta", "staff"]}),
]
RANT_EXAMPLES = [
    ("Never been here, but I heard it's terrible.",
     {"is_violation": True, "confidence": 0.97,
      "reasoning": "Reviewer admits never visiting, but makes a complaint.",
      "violation_type": "rant_without_visit", "indicators": ["Never been here", "I heard"]}),
    ("I haven't visited, but someone told me the service is bad.",
     {"is_violation": True, "confidence": 0.96,
      "reasoning": "No evidence of visit, only hearsay.",
      "violation_type": "rant_without_visit", "indicators": ["haven't visited", "someone told me"]}),
    ("I tried the pizza and loved the atmosphere.",
     {"is_violation": False, "confidence": 0.99,
      "reasoning": "Reviewer describes their own experience.",
      "violation_type": "none", "indicators": ["tried", "pizza", "atmosphere"]}),
]

# Instruction block of the classification prompt.
PROMPT_STEPS = """\
You are an expert Google reviewer tasked with identifying policy violations in Google location reviews.
Policy: {policy}
Policy Description: {description}
Follow these steps:
1. Carefully read the review and reason step by step about whether it violates the policy.
2. If you suspect the review is AI-generated, err on the side of flagging a violation for this policy.
3. If you are unsure, explain your reasoning and err on the side of not flagging a violation unless it is AI-generated.
4. Respond ONLY with a valid JSON object, no markdown, no extra text.
5. The JSON must have these fields: is_violation (true/false), confidence (float)
Constraints:
- Only output the JSON object, no code block markers or extra commentary.
- Do not generate extra text that is not needed.
- Confidence must be between 0.0 and 1.0.
- Reasoning should be concise and reference evidence from the review.
- indicators should be a list of keywords or phrases that triggered the decision.
- Do not use double quotes inside reasoning or indicators unless they are properly escaped.
- Prefer single quotes for quoted phrases inside reasoning."""
PROMPT_FIELDS = [
    ("Business Name", "place_name"),
    ("User Name", "user_name"),
    ("Text", "text"),
    ("Rating", "rating"),
    ("Language", "language"),
    ("Has Image", "has_image"),
    ("Image Path", "image_path"),
    ("Metadata", "metadata"),
]


@dataclass(frozen=True)
class Vocabulary:
    """Keyword lists of the rules; ``strict_case`` keeps phrases with capitals unmatchable."""

    promo: list[str] = field(default_factory=lambda: PROMO_WORDS)
    unrelated: list[str] = field(default_factory=lambda: UNRELATED_WORDS)
    rant: list[str] = field(default_factory=lambda: RANT_PHRASES)
    visit: list[str] = field(default_factory=lambda: VISIT_WORDS)
    strict_case: bool = True


@dataclass(frozen=True)
class PolicyRule:
    """A policy: what it says, few-shot examples, and a column rule giving (flag, confidence, reason)."""

    name: str
    description: str
    column_fn: Callable[[Column], Column]
    examples: list[tuple[str, dict]] = field(default_factory=list)

    @property
    def flag_column(self) -> str:
        return f"is_{self.name.lower().replace(' ', '_')}"


def words_present(c: Column, words: list[str]) -> Column:
    """How many of the words occur as substrings of the lower-cased text; each counts once."""
    lowered = F.lower(c)
    hits = [F.coalesce(lowered.contains(w), F.lit(False)).cast("int") for w in words]
    return sum(hits[1:], hits[0]) if hits else F.lit(0)


def _result(flag: bool, confidence: float, reason: str) -> Column:
    return F.struct(
        F.lit(flag).alias("flag"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason")
    )


# Reasons of the rules.
REASONS = {
    "url": "Contains URL and promotional word (likely advertisement)",
    "promotional": "Contains multiple promotional words",
    "no advertisement": "No strong advertisement detected",
    "topics": "Mentions multiple unrelated topics",
    "short": "Short review about unrelated topic",
    "relevant": "Content appears relevant",
    "rant": "Rant phrase present and no evidence of visit",
    "no rant": "Likely visited or not a rant",
}
# Descriptions of the policies.
DESCRIPTIONS = {
    "NoAdvertisement": "Reviews should not contain promotional content, advertisements, or links to external websites.",
    "NoIrrelevantContent": "Reviews must be about the location itself, not about unrelated events, trips, or other topics.",
    "NoRantWithoutVisit": "Rants or complaints must come from actual visitors. Reviews based on hearsay or without evidence of a visit are violations.",
}


def advertisement_rule(c: Column | str, vocabulary: Vocabulary = Vocabulary()) -> Column:
    n = words_present(col(c), vocabulary.promo)
    return (
        F.when(
            has_url(c) & (n > 0),
            _result(True, 0.99, REASONS["url"]),
        )
        .when(n >= 2, _result(True, 0.96, REASONS["promotional"]))
        .otherwise(_result(False, 0.7, REASONS["no advertisement"]))
    )


def irrelevant_rule(c: Column | str, vocabulary: Vocabulary = Vocabulary()) -> Column:
    n = words_present(col(c), vocabulary.unrelated)
    return (
        F.when(n >= 2, _result(True, 0.95, REASONS["topics"]))
        .when(
            (n == 1) & (word_count(c) < 15), _result(True, 0.92, REASONS["short"])
        )
        .otherwise(_result(False, 0.7, REASONS["relevant"]))
    )


def rant_rule(c: Column | str, vocabulary: Vocabulary = Vocabulary()) -> Column:
    phrases = vocabulary.rant if vocabulary.strict_case else [p.lower() for p in vocabulary.rant]
    ranting = words_present(col(c), phrases) > 0
    visited = words_present(col(c), vocabulary.visit) > 0
    return F.when(
        ranting & ~visited, _result(True, 0.98, REASONS["rant"])
    ).otherwise(_result(False, 0.7, REASONS["no rant"]))


def default_policies(vocabulary: Vocabulary = Vocabulary()) -> list[PolicyRule]:
    return [
        PolicyRule(
            "NoAdvertisement",
            DESCRIPTIONS["NoAdvertisement"],
            lambda c: advertisement_rule(c, vocabulary),
            ADVERTISEMENT_EXAMPLES,
        ),
        PolicyRule(
            "NoIrrelevantContent",
            DESCRIPTIONS["NoIrrelevantContent"],
            lambda c: irrelevant_rule(c, vocabulary),
            IRRELEVANT_EXAMPLES,
        ),
        PolicyRule(
            "NoRantWithoutVisit",
            DESCRIPTIONS["NoRantWithoutVisit"],
            lambda c: rant_rule(c, vocabulary),
            RANT_EXAMPLES,
        ),
    ]


def violating_only(policies: list[PolicyRule]) -> list[PolicyRule]:
    """The same policies with only those examples that do violate them."""
    return [replace(p, examples=[e for e in p.examples if e[1]["is_violation"]]) for p in policies]


def annotate_rules(
    df: DataFrame,
    policies: list[PolicyRule] | None = None,
    text: str = "text",
    threshold: float = 0.0,
    start_at: int = 0,
    seq: str = "seq",
) -> DataFrame:
    """One 0/1 column per policy in a single projection. Rows before ``start_at`` keep 0."""
    flags = {}
    for p in policies or default_policies():
        result = p.column_fn(F.col(text))
        hit = (result["flag"] & (result["confidence"] >= threshold)).cast("int")
        flags[p.flag_column] = F.when(F.col(seq) >= start_at, hit).otherwise(0) if start_at else hit
    return df.withColumns(flags)


def _example_struct(review: str, response: dict) -> Column:
    return F.struct(
        F.lit(review).alias("review"),
        F.struct(
            F.lit(response["is_violation"]).alias("is_violation"),
            F.lit(float(response["confidence"])).alias("confidence"),
            F.lit(response["reasoning"]).alias("reasoning"),
            F.lit(response["violation_type"]).alias("violation_type"),
            F.array(*[F.lit(i) for i in response["indicators"]]).alias("indicators"),
        ).alias("response"),
    )


def policy_array(policies: list[PolicyRule] | None = None) -> Column:
    """The policies as an array literal: exploding it fans a row out without any join."""
    return F.array(
        *[
            F.struct(
                F.lit(p.name).alias("policy"),
                F.lit(p.description).alias("description"),
                F.lit(p.flag_column).alias("flag_column"),
                F.array(*[_example_struct(*e) for e in p.examples]).alias("examples"),
            )
            for p in policies or default_policies()
        ]
    )


def policy_prompts(df: DataFrame, policies: list[PolicyRule] | None = None, keep: list[str] | None = None):
    """One prompt per (review, policy). Fields the table lacks are left empty."""

    def shown(name: str) -> Column:
        if name not in df.columns:
            return F.lit("")
        if isinstance(df.schema[name].dataType, (T.StructType, T.MapType)):
            return F.to_json(name)
        if isinstance(df.schema[name].dataType, T.BooleanType):
            return F.when(F.col(name), "True").when(~F.col(name), "False").otherwise("")
        return text_or_empty(name)

    info = F.concat_ws("\n", *[F.concat(F.lit(f"{label}: "), shown(c)) for label, c in PROMPT_FIELDS])
    heads = []
    for p in policies or default_policies():
        shots = "".join(f"\nReview: {r}\nResponse: {json.dumps(a)}\n" for r, a in p.examples)
        steps = PROMPT_STEPS.format(policy=p.name, description=p.description)
        head = f"{steps}\n\nPast Examples: {shots}\nReview Information:\n"
        heads.append(F.struct(F.lit(p.name).alias("policy"), F.lit(head).alias("head")))
    fanned = df.select(*(keep or df.columns), info.alias("_info"), F.explode(F.array(*heads)).alias("_p"))
    prompt = F.concat("_p.head", "_info", F.lit("\nResponse: "))
    return fanned.withColumns({"policy": F.col("_p.policy"), "prompt": prompt}).drop("_info", "_p")


Responder = Callable[[list[str]], list[str]]


def annotate_with(
    prompts: DataFrame, make_responder: Callable[[], Responder], prompt: str = "prompt"
) -> DataFrame:
    """Adds ``response`` from a pluggable annotator: one client per partition, one call per batch."""

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        responder = make_responder()
        for batch in batches:
            yield batch.assign(response=responder(batch[prompt].tolist()))

    schema = T.StructType([*prompts.schema.fields, T.StructField("response", T.StringType())])
    return prompts.mapInPandas(respond, schema)


def rule_response(result: Column) -> Column:
    """A rule result written as an annotator would answer; the offline default responder."""
    return F.format_string(
        '{"is_violation": %s, "confidence": %s, "reasoning": "%s"}',
        result["flag"].cast("string"),
        result["confidence"].cast("string"),
        result["reason"],
    )


def parse_response(c: Column | str) -> Column:
    """First brace-to-brace object of an answer as (is_violation, confidence); else (null, 0.0).

    Keys that are absent or of odd types follow loose truthiness: no key is true, "false" is true. Of a key
    that is repeated the last value counts, and NaN is a number; answers of those two kinds are read less strictly, so
    that there "false" in quotes is false.
    """
    space = r"[\s]+"
    plain = F.regexp_replace(text_or_empty(c), f"^{space}|{space}$", "")
    plain = F.regexp_replace(plain, r"^```json\s*", "")
    plain = F.regexp_replace(plain, r"^```\s*", "")
    plain = F.regexp_replace(plain, r"\s*```$", "")
    found = F.regexp_extract(plain, r"(?s)\{.*?\}", 0)
    document = F.try_parse_json(F.nullif(found, F.lit("")))
    number = F.try_variant_get(document, "$.confidence", "string")
    confidence = (
        F.when(number == "true", 1.0).when(number == "false", 0.0).otherwise(number.try_cast("double"))
    )
    options = {"allowNonNumericNumbers": "true", "columnNameOfCorruptRecord": "broken"}
    loose = F.from_json(found, "is_violation string, confidence string, broken string", options)
    usable = document.isNull() & (found != "") & loose["broken"].isNull()
    false = F.coalesce(loose["is_violation"].isin("false", "0", "0.0", "", "[]", "{}"), F.lit(False))
    return F.struct(
        F.when(document.isNotNull(), json_truthy(document, "is_violation", absent=True))
        .when(usable, ~false)
        .alias("is_violation"),
        F.coalesce(F.when(usable, loose["confidence"].try_cast("double")).otherwise(confidence), F.lit(0.0)).alias(
            "confidence"
        ),
    )


def gate(parsed: Column, threshold: float = 0.9) -> Column:
    """1 where the answer says violation with enough confidence."""
    sure = (parsed["confidence"] >= threshold) & ~F.isnan(parsed["confidence"])
    return F.coalesce(parsed["is_violation"] & sure, F.lit(False)).cast("int")


def flags_to_labels(df: DataFrame) -> DataFrame:
    """Policy flag columns become label columns; an absent one counts as 0."""
    out = {}
    for policy, label in POLICY_LABEL.items():
        flag = f"is_{policy.lower()}"
        out[label] = F.col(flag).cast("int") if flag in df.columns else F.lit(0)
    return df.withColumns(out)


def policy_one_hot(df: DataFrame, policy: str) -> DataFrame:
    """Label columns from a policy name; unknown, blank or null gives zeros."""
    name = F.trim(text_or_empty(policy))
    by_label = {label: p for p, label in POLICY_LABEL.items()}
    return df.withColumns({label: (name == by_label[label]).cast("int") for label in LABELS})
