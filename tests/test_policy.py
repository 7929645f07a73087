"""Rules, response parsing and text helpers on known vectors."""

import json

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import policy as po
from reviewlens.functions import text as tx
from reviewlens.operators import balance, profile

RULES = [
    (po.advertisement_rule, "Best pizza! Visit www.pizzapromo.com for discounts!", True, 0.99),
    (po.advertisement_rule, "Try our new burger deal at www.burgerpromo.com!", True, 0.99),
    (po.advertisement_rule, "A deal and an offer", True, 0.96),
    (po.advertisement_rule, "Great food and service, will come again.", False, 0.7),
    (po.irrelevant_rule, "I had a wonderful vacation in Hawaii.", True, 0.92),
    (po.irrelevant_rule, "My flight to Paris was delayed, so I stopped by this place.", True, 0.92),
    (po.irrelevant_rule, "The pasta was delicious and the staff were friendly.", False, 0.7),
    (po.rant_rule, "Never been here, but I heard it's terrible.", True, 0.98),
    (po.rant_rule, "I haven't visited, but someone told me the service is bad.", False, 0.7),
    (po.rant_rule, "I tried the pizza and loved the atmosphere.", False, 0.7),
    (po.rant_rule, "I heard it is bad.", False, 0.7),
    (po.rant_rule, "I am told never been here; late plate", False, 0.7),
    (po.advertisement_rule, None, False, 0.7),
]


@pytest.mark.parametrize("rule,text,flag,confidence", RULES)
def test_rules(spark, rule, text, flag, confidence):
    row = spark.createDataFrame([(text,)], "text string").select(rule("text").alias("r")).first().r
    assert (row.flag, row.confidence) == (flag, confidence)


def test_loose_case_lets_capital_phrases_match(spark):
    df = spark.createDataFrame([("I heard it is bad.",)], "text string")
    loose = po.Vocabulary(strict_case=False)
    assert df.select(po.rant_rule("text", loose)["flag"].alias("f")).first().f


RESPONSES = [
    ('```json\n{"is_violation": true, "confidence": 0.95}\n```', True, 0.95, 1),
    ('{"is_violation": true, "confidence": 0.79}', True, 0.79, 0),
    ('{"confidence": 0.9}', True, 0.9, 1),
    ('{"is_violation": "false", "confidence": 0.9}', True, 0.9, 1),
    ('{"is_violation": "", "confidence": 0.9}', False, 0.9, 0),
    ('{"is_violation": null, "confidence": 0.9}', False, 0.9, 0),
    ('{"is_violation": true}', True, 0.0, 0),
    ('{"a": {"b": 1}}', None, 0.0, 0),
    ("no json", None, 0.0, 0),
    (None, None, 0.0, 0),
    ('{"is_violation": true, "confidence": "high"}', True, 0.0, 0),
]


def test_response_truth_table(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(RESPONSES)], "i int, t string")
    rows = df.withColumn("p", po.parse_response("t")).withColumn("g", po.gate(F.col("p"), 0.8))
    for row in rows.collect():
        assert (row.p.is_violation, row.p.confidence, row.g) == RESPONSES[row.i][1:]


def test_prompt_has_examples_and_all_fields(spark):
    df = spark.createDataFrame([(1, "p", "u", "hello", 4)], "seq long, place_name string, user_name string, text string, rating int")
    rows = {r.policy: r.prompt for r in po.policy_prompts(df, keep=["seq"]).collect()}
    assert set(rows) == {p.name for p in po.default_policies()}
    prompt = rows["NoAdvertisement"]
    assert prompt.startswith("You are an expert Google reviewer") and prompt.endswith("\nResponse: ")
    assert json.dumps(po.ADVERTISEMENT_EXAMPLES[0][1]) in prompt
    assert "Business Name: p\nUser Name: u\nText: hello\nRating: 4\nLanguage: \nHas Image: \n" in prompt


def test_start_offset_and_flags_to_labels(spark):
    df = spark.createDataFrame([(0, "deal offer"), (1, "deal offer")], "seq long, text string")
    rows = po.flags_to_labels(po.annotate_rules(df, start_at=1)).orderBy("seq").collect()
    assert [r.advertisement for r in rows] == [0, 1]
    assert all(r.review_without_visit == 0 for r in rows)


def test_url_and_names(spark):
    df = spark.createDataFrame(
        [("HTTPS://x",), ("www.y",), ("http://z",), (None,)], "t string"
    ).select(tx.has_url("t").alias("web"), tx.has_url("t", "strict").alias("strict"))
    assert [tuple(r) for r in df.collect()] == [(True, False), (True, False), (True, True), (False, False)]
    row = spark.range(1).select(
        tx.normalise_name(F.lit("A B-C")).alias("place"), tx.normalise_name(F.lit("A B-C"), False).alias("user")
    ).first()
    assert tuple(row) == ("a_b_c", "a_b-c")


def test_business_key_policies(spark):
    rows = [(0, "7", "x"), (1, " ", "x"), (2, "nan", ""), (3, None, None), (4, "", "y")]
    df = spark.createDataFrame(rows, "seq long, business_id string, business_name string")
    found = df.select(*[tx.business_key(df, p).alias(p) for p in ("surrogate", "drop", "lump")]).collect()
    assert [r.surrogate for r in found] == ["7", "x", "__row_2", "__row_3", "y"]
    assert [r["drop"] for r in found] == ["7", "x", None, None, "y"]
    assert [r.lump for r in found] == ["7", " ", "nan", "", "y"]


def test_tokens_agree_with_python(spark):
    import re

    texts = ["Don't stop, É été! 北京 x²", "a b c_1 --", "😀 ok", "", "naïve ½ ٣"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in df.withColumn("k", tx.tokens("t")).withColumn("n", tx.word_count("t")).collect():
        assert row.k == re.findall(r"\w+|[^\w\s]", row.t.lower())
        assert row.n == len(row.t.split())


def test_output_parse(spark):
    cases = {
        'x {"advertisement": true, "irrelevant_content": 0}': (False, True, False),
        '{"advertisement": true} trailing': (False, False, False),
        "{bad}": (False, False, False),
        '{"review_without_visit": "false"}\n': (False, False, True),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for row in df.withColumn("p", tx.parse_model_output("t")).collect():
        assert tuple(row.p) == cases[row.t]


def test_risk_levels(spark):
    from reviewlens.operators.dashboard import risk
    from reviewlens.schemas import LABELS

    rows = [([0.9, 0.1, 0.1],), ([0.6, 0.1, 0.1],), ([0.4, 0.1, 0.1],), ([0.8, 0.5, 0.0],)]
    found = risk(spark.createDataFrame(rows, "probs array<double>"), 0.5, LABELS).collect()
    assert [r.risk_level for r in found] == ["High", "Medium", "Low", "High"]
    assert found[2].category == "Relevant"
    assert found[2].explanation == "No labels exceeded threshold 0.5. Highest probability 40.0%."
    assert found[3].category == "Irrelevant Content, Advertisement"
    assert (found[3].high_risk, found[3].medium_risk) == (["Irrelevant Content"], ["Advertisement"])


def test_sanitize(spark):
    cases = {
        '```text\n"Nice"\n```': "Nice",
        "```Nice```": "Nice",
        '  "Nice place" ': "Nice place",
        "Nice": "Nice",
        None: "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for row in df.withColumn("s", balance.sanitize_generated("t")).collect():
        assert row.s == cases[row.t]


def test_unify_and_photo_flow(spark):
    raw = spark.createDataFrame(
        [(0, "A B", "U", "t", "5", "p.jpg"), (1, "A-B", "U", "t", "x", None), (2, "C", "V", None, "2", "")],
        "seq long, business_name string, author_name string, text string, rating string, photo string",
    )
    rows = profile.unify(raw).orderBy("seq").collect()
    assert [r.has_image for r in rows] == [True, False, False]
    assert [r.rating for r in rows] == [5, None, 2]
    assert rows[2].text == ""
    kept = balance.dedup_reviews(profile.unify(raw)).collect()
    assert sorted(r.seq for r in kept) == [0, 2]
    annotated = po.annotate_rules(profile.unify(raw))
    assert [r.has_photo for r in balance.training_rows(annotated).orderBy("has_photo").collect()] == [False, False, True]
    assert not any(r.has_photo for r in balance.training_rows(annotated, compat_drop_photo=True).collect())
    with pytest.raises(ValueError, match="rating"):
        profile.require_columns(raw.drop("rating"))


def test_dedup_is_idempotent_and_layout_free(spark):
    rows = [(i, f"k{i % 7}" if i % 5 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "seq long, k string, v int")
    found = [
        sorted(map(tuple, balance.dedup_first(df.repartition(n), ["k"]).collect()), key=repr) for n in (1, 4, 16)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 8
    once = balance.dedup_first(df, ["k"])
    assert sorted(map(tuple, balance.dedup_first(once, ["k"]).collect()), key=repr) == found[0]


def test_model_output_is_read_once_a_row(spark):
    df = spark.createDataFrame([("so {\"advertisement\": true}",)], "t string")
    found = df.select(tx.parse_model_output("t").alias("p")).select("p.*")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1
    assert tuple(found.first()) == (False, True, False)
