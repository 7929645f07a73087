"""Empty tables go through, and a table's layout does not change a result."""

from pyspark.sql import functions as F

from reviewlens.operators import balance, dashboard, features, profile, similarity, split
from reviewlens.operators import evaluation as ev
from reviewlens.schemas import LABELS


def test_empty_tables(spark):
    texts = spark.createDataFrame([], "seq long, business_name string, author_name string, text string, rating int")
    vocab = features.build_vocab(texts)
    assert features.encode(texts, vocab).isEmpty()
    assert split.split_by_group(texts, "business_name").isEmpty()
    assert balance.dedup_first(texts, ["text"]).isEmpty()
    assert profile.quality_issues(texts).isEmpty()
    assert profile.describe_numeric(texts, ["rating"]).first().n == 0
    scored = spark.createDataFrame([], "model string, sample_id string, label string, y_true int, prob double")
    assert ev.report(scored).isEmpty()
    assert ev.threshold_sweep(scored).isEmpty()
    assert dashboard.confidence_histogram(scored).isEmpty()
    vectors = spark.createDataFrame([], "business string, seq long, vector array<float>")
    assert similarity.scan_businesses(vectors).isEmpty()
    assert similarity.review_scores(vectors).isEmpty()


def test_encode_pads_cuts_and_marks_unknown(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, ""), (3, "a " * 300)], "seq long, text string")
    vocab = features.build_vocab(df)
    assert {r.token: r.id for r in vocab.collect()} == {"a": 2}
    for n in (1, 7):
        found = {r.seq: r.ids for r in features.encode(df.repartition(n), vocab, max_len=6).collect()}
        assert found == {1: [2, 1, 2, 1, 0, 0], 2: [0] * 6, 3: [2] * 6}


def test_report_does_not_depend_on_layout(spark):
    rows = [("m", str(i), LABELS[i % 3], i % 2, (i * 37 % 100) / 100) for i in range(600)]
    scored = spark.createDataFrame(rows, "model string, sample_id string, label string, y_true int, prob double")
    found = [
        ev.report(scored.repartition(n)).select(F.to_json(F.struct("n_samples", "macro", "micro"))).first()[0]
        for n in (1, 4, 16)
    ]
    assert found[0] == found[1] == found[2]
