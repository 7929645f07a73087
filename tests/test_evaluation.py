"""Evaluation against the published reports and against plain loops; splits, balancing, learning."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import balance, dashboard, learning, split
from reviewlens.operators import evaluation as ev
from reviewlens.schemas import LABELS
from reviewlens.sources import read_reports, scratch_path, write_reports

# Tn, fp, fn, tp of the published reports, per label in label order, 211 rows each.
GOLDEN = {
    "encoder/enc-bert-large-cased": [(189, 0, 5, 17), (194, 0, 0, 17), (196, 0, 3, 12)],
    "encoder/enc-xlm-roberta-base": [(187, 2, 4, 18), (194, 0, 0, 17), (196, 0, 3, 12)],
    "sft/sft-gemma-3-12b": [(184, 5, 5, 17), (194, 0, 0, 17), (191, 5, 1, 14)],
    "sft/sft-gemma-3-4b": [(184, 5, 5, 17), (193, 1, 3, 14), (188, 8, 2, 13)],
    "sft/sft-ministral-8b": [(172, 17, 3, 19), (192, 2, 0, 17), (188, 8, 1, 14)],
}
# Published macro F1, micro precision, micro recall, micro F1.
PUBLISHED = {
    "encoder/enc-bert-large-cased": (0.9202, 1.0000, 0.8519, 0.9200),
    "encoder/enc-xlm-roberta-base": (0.9153, 0.9592, 0.8704, 0.9126),
    "sft/sft-gemma-3-12b": (0.8654, 0.8276, 0.8889, 0.8571),
    "sft/sft-gemma-3-4b": (0.7900, 0.7586, 0.8148, 0.7857),
    "sft/sft-ministral-8b": (0.7855, 0.6494, 0.9259, 0.7634),
}
# Published average precision of the 0/1 scored models.
PUBLISHED_AP = {
    "sft/sft-gemma-3-12b": (0.6208, 1.0000, 0.6925),
    "sft/sft-gemma-3-4b": (0.6208, 0.7828, 0.5460),
    "sft/sft-ministral-8b": (0.4700, 0.8947, 0.5987),
}


@pytest.fixture(scope="module")
def reports(spark):
    rows = []
    for model, per_label in GOLDEN.items():
        for label, (tn, fp, fn, tp) in zip(LABELS, per_label):
            for n, y, p in ((tn, 0, 0.0), (fp, 0, 1.0), (fn, 1, 0.0), (tp, 1, 1.0)):
                rows += [(model, f"{label}{y}{p}{i}", label, y, p) for i in range(n)]
    scored = spark.createDataFrame(rows, "model string, sample_id string, label string, y_true int, prob double")
    path = scratch_path(spark, "golden")
    write_reports(ev.report(scored), path)
    return read_reports(spark, f"{path}/*/*.txt").cache()


def test_published_numbers(reports):
    for r in reports.collect():
        macro_f1, precision, recall, f1 = PUBLISHED[r.model]
        assert r.n_samples == 211
        assert r.macro.f1 == pytest.approx(macro_f1, abs=5e-5)
        assert (r.micro.precision, r.micro.recall, r.micro.f1) == pytest.approx((precision, recall, f1), abs=5e-5)
        for i, label in enumerate(LABELS):
            assert tuple(r.per_label[label].confusion) == GOLDEN[r.model][i]
            if r.model in PUBLISHED_AP:
                assert r.per_label[label].ap == pytest.approx(PUBLISHED_AP[r.model][i], abs=5e-5)


def test_dashboard_on_published_reports(reports):
    shares = {r.category: r["count"] for r in dashboard.category_distribution(reports).collect()}
    assert shares == {"Relevant": 157, "Irrelevant": 22, "Advertisement": 17, "Rant without Visit": 15}
    severity = {r.label: r.severity for r in dashboard.violation_severity(reports).collect()}
    assert severity == {"irrelevant_content": "High", "advertisement": "Medium", "review_without_visit": "Low"}
    over = dashboard.overview(reports).first()
    assert (over.best_model, over.worst_model) == ("enc-bert-large-cased", "sft-ministral-8b")
    assert (over.encoder_count, over.sft_count, over.violations, over.relevant_reviews) == (2, 3, 54, 157)
    names = [r.name for r in dashboard.model_list(reports).collect()]
    assert names[0] == "enc-bert-large-cased" and names[-1] == "sft-ministral-8b"
    compared = {r.model: r.accuracy for r in dashboard.model_comparison(reports).collect()}
    assert compared["enc-xlm-roberta-base"] == 91.3
    lines = [r.details for r in dashboard.activity(reports).orderBy("position").collect()]
    assert lines[0] == "Best: enc-bert-large-cased (F1: 0.920)"
    assert lines[-1] == "Evaluated 5 models on 211 samples"
    assert dashboard.insights(reports, "no such model").count() == 3
    assert dashboard.model_details(reports, "sft/sft-gemma-3-4b").count() == 3


def scored_frame(spark, rows):
    return spark.createDataFrame(rows, "model string, sample_id string, label string, y_true int, prob double")


def loop_ap(y, p):
    total, hits, seen, ap = sum(y), 0, 0, 0.0
    for score in sorted(set(p), reverse=True):
        at = [i for i, v in enumerate(p) if v == score]
        hits += sum(y[i] for i in at)
        seen += len(at)
        ap += sum(y[i] for i in at) / total * hits / seen if total else 0
    return ap


def test_average_precision_and_sweep_against_loops(spark):
    rng = random.Random(2)
    cases = {
        "mixed": [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(300)],
        "none": [(0, rng.random()) for _ in range(50)],
        "all": [(1, rng.random()) for _ in range(50)],
        "tied": [(i % 2, 0.5) for i in range(40)],
    }
    rows = [("m", str(i), k, y, p) for k, v in cases.items() for i, (y, p) in enumerate(v)]
    scored = scored_frame(spark, rows)
    aps = {r.label: r.ap for r in ev.average_precision(scored).collect()}
    best = {r.label: r.threshold for r in ev.threshold_sweep(scored).collect()}
    assert ev.GRID == list(np.linspace(0.1, 0.9, 17))
    for label, pairs in cases.items():
        y, p = [a for a, _ in pairs], [b for _, b in pairs]
        assert aps[label] == pytest.approx(loop_ap(y, p))
        top, chosen = -1.0, 0.5
        for t in ev.GRID:
            tp = sum(a and b >= t for a, b in pairs)
            wrong = sum((not a) and b >= t for a, b in pairs) + sum(a and b < t for a, b in pairs)
            f1 = 2 * tp / (2 * tp + wrong) if 2 * tp + wrong else 0.0
            if f1 > top:
                top, chosen = f1, t
        assert best[label] == chosen


def test_fixed_half_only_touches_per_label(spark):
    scored = scored_frame(spark, [("m", "1", "a", 1, 0.6), ("m", "2", "a", 0, 0.6), ("m", "3", "a", 1, 0.9)])
    plain, half = (ev.report(scored, 0.8, compat_fixed_half=c, labels=["a"]).first() for c in (False, True))
    assert plain.per_label["a"].recall == 0.5 and half.per_label["a"].recall == 1.0
    assert plain.macro.f1 == half.macro.f1
    assert half.per_label["a"].confusion.tp == 1


def test_align_meets_on_ids(spark):
    truth = spark.createDataFrame([("b", 1, 0, 0), ("a", 0, 0, 1)], "sample_id string, " + ", ".join(f"{n} int" for n in LABELS))
    preds = spark.createDataFrame([("m", "a", [0.1, 0.2, 0.9]), ("m", "z", [0.0, 0.0, 0.0])], "model string, sample_id string, probs array<double>")
    rows = {r.label: (r.y_true, r.prob) for r in ev.align(preds, truth).collect()}
    assert rows == {LABELS[0]: (0, 0.1), LABELS[1]: (0, 0.2), LABELS[2]: (1, 0.9)}
    assert tuple(ev.unaligned(preds, truth).first()) == ("m", 1, 1)


@pytest.mark.parametrize("sizes", [[1] * 500, [400] + [3] * 60, [5]])
def test_split_keeps_businesses_whole_and_near_targets(spark, sizes):
    rows = [(f"b{b}", b * 1000 + i) for b, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "business string, seq long")
    found = split.split_by_group(df, "business").cache()
    assert found.count() == len(rows)
    report = split.split_report(found, "business").collect()
    assert all(r.leaked_keys == 0 for r in report)
    assert sum(r.n_rows for r in report) == len(rows)
    if max(sizes) == 1:
        assert {r.split: r.n_rows for r in report} == {"train": 350, "val": 75, "test": 75}
    again = split.split_by_group(df.repartition(7), "business", trials=64)
    assert found.exceptAll(again).isEmpty()


def test_trial_errors_equal_the_assignments(spark):
    rows = [(f"b{i}", 1 + (i * 13) % 9) for i in range(300)]
    sizes = spark.createDataFrame(rows, "business string, size long")
    total = split.total_size(sizes)
    errors = {r.trial: r for r in split.trial_errors(sizes, "business", total, trials=3).collect()}
    for trial in range(3):
        per = split.trial_assignment(sizes, "business", total, trial).groupBy("split").agg(F.sum("size").alias("n"))
        counts = {r.split: r.n for r in per.collect()}
        assert all(errors[trial][f"n_{s}"] == counts.get(s, 0) for s in split.SPLITS)


def test_targets_round_half_even(spark):
    row = spark.range(1).select(*[c.alias(k) for k, c in split.split_targets(F.lit(211)).items()]).first()
    assert (row.train, row.val, row.test) == (148, 32, 31)


def test_oversample_counts(spark):
    rows = [(i, int(i < 3), 0, 0) for i in range(13)]
    df = spark.createDataFrame(rows, "seq long, advertisement int, irrelevant_content int, review_without_visit int")
    assert balance.oversample(df).count() == 22
    assert balance.oversample(df.filter("advertisement = 0")).count() == 10
    assert balance.oversample(df.filter("seq < 5")).count() == 5


def test_plan_rejects_unknown_policies_and_meta_falls_back(spark):
    with pytest.raises(ValueError, match="Unknown policy"):
        balance.plan_synthetic(spark, {"Nope": 1})
    plan = balance.plan_synthetic(spark, {"NoAdvertisement": 20000, "NoRantWithoutVisit": 0}, ["en", "fr"])
    assert plan.count() == 20000 and plan.select("attempt").distinct().count() == 20000
    empty = spark.createDataFrame([], "review_id string, place_name string, user_name string")
    row = balance.attach_meta(plan, empty).first()
    assert row.place_name == "synthetic_place" and row.user_name.startswith("user_")


def test_generation_stops_at_requested(spark):
    plan = balance.plan_synthetic(spark, {"NoAdvertisement": 10}, max_factor=5)
    empty = spark.createDataFrame([], "review_id string, place_name string, user_name string")
    prompts = balance.generation_prompt(balance.attach_meta(plan, empty))

    def failing():
        state = {"n": 0}

        def write(batch):
            out = []
            for _ in batch:
                state["n"] += 1
                out.append(None if state["n"] % 2 else "text")
            return out

        return write

    rows = balance.synthetic_rows(balance.generate(prompts, failing)).collect()
    assert sorted(r.review_id for r in rows) == [f"aug-none-NoAdvertisement-{i:05d}" for i in range(1, 11)]


def labelled_texts(spark, n=240):
    rows = []
    for i in range(n):
        ad = i % 3 == 0
        rows.append((i, f"biz{i % 12}", "u", ("buy discount now" if ad else "lovely meal today") + f" w{i % 17}", 5, int(ad), 0, int(i % 4 == 0)))
    return spark.createDataFrame(
        rows,
        "seq long, business_name string, author_name string, text string, rating int,"
        " advertisement int, irrelevant_content int, review_without_visit int",
    )


def test_classifier_learns_saves_and_loads(spark):
    df = labelled_texts(spark)
    train, val = df.filter("seq % 5 != 0"), df.filter("seq % 5 = 0")
    spec = learning.ModelSpec(dims=512, stages=(1, 8, 9, 10), reg_param=0.01)
    models, history = learning.fit_classifiers(train, val, [spec], patience=2)
    rows = history.orderBy("epoch").collect()
    assert 1 <= len(rows) <= 4 and rows[1].val_loss < rows[0].val_loss
    model = models[spec.name]
    scored = learning.score(val, model)
    met = ev.align(scored, val.withColumn("sample_id", F.col("seq").cast("string")))
    f1 = {r.label: r.f1 for r in ev.per_label(ev.confusion(met)).collect()}
    assert f1["advertisement"] > 0.95 and f1["irrelevant_content"] == 0.0
    path = scratch_path(spark, "model")
    model.save(path)
    loaded = learning.ReviewClassifier.load(path, spec)
    assert scored.exceptAll(learning.score(val, loaded)).isEmpty()
    requests = val.select("seq", "text").withColumn("kind", F.lit("single"))
    assert learning.predict(requests, model).select("pred").first().pred[0] == 0


def test_series_summary_edges(spark):
    one = spark.createDataFrame([("2024-01-01", 4.0)], "date string, value double")
    assert dashboard.series_summary(one).first().trend == "none"
    two = spark.createDataFrame([("2024-01-01", 4.0), ("2024-01-02", 5.0)], "date string, value double")
    row = dashboard.series_summary(two).first()
    assert (row.trend, row.trend_pct, row.peak) == ("up", 25.0, 5.0)
    assert row.volatility == pytest.approx(0.5 / 4.5)
