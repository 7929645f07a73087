"""Rows, columns and keys at the edges: nothing is dropped, nothing is cut."""

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import balance, dashboard, features, ordered, profile, similarity, split
from reviewlens.schemas import REPORT, FuseConfig
from reviewlens.sources import readers, writers
from reviewlens.sources.scratch import scratch_path


def test_draws_reach_beyond_32_bits(spark):
    n = 10**11
    found = spark.range(2000).select(balance.draw(n, 42, F.col("id")).alias("d"))
    low, high = found.agg(F.min("d"), F.max("d")).first()
    assert 0 <= low < n / 100 and n * 0.99 < high < n


def test_counts_beyond_32_bits(spark):
    plan = balance.plan_synthetic(spark, {"NoAdvertisement": 3_000_000_000})
    assert dict(plan.dtypes)["requested"] == dict(plan.dtypes)["attempt"] == "bigint"
    assert plan.limit(3).count() == 3
    rows = spark.createDataFrame([(1, 1, 0, 0)] + [(k, 0, 0, 0) for k in range(2, 25_002)],
                                 "seq long, irrelevant_content int, advertisement int, review_without_visit int")
    copies = balance.oversample(rows).filter("seq = 1").agg(F.count("*"), F.min("copy"), F.max("copy"), F.count_distinct("copy"))
    assert tuple(copies.first()) == (25_000, 0, 24_999, 25_000)


def test_split_keeps_rows_without_a_business(spark):
    rows = spark.createDataFrame([(k, None if k % 4 == 0 else f"b{k % 7}") for k in range(100)], "seq long, business string")
    found = split.split_by_group(rows, "business")
    assert found.count() == 100 and found.columns == ["seq", "business", "split"]
    assert found.filter("business is not null").groupBy("business").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()
    assert found.filter("business is null").select("split").distinct().count() > 1


def test_every_review_is_scored_and_fused(spark):
    rows = [("a", 1, [1.0, 0.0]), ("a", 2, [1.0, 0.0]), (None, 3, [1.0, 0.0]), ("a", 4, None)]
    vec = spark.createDataFrame(rows, "business string, seq long, vector array<float>")
    scores = similarity.review_scores(vec, FuseConfig())
    found = {r.seq: r.fraud_score for r in scores.collect()}
    assert set(found) == {1, 2, 3, 4} and found[3] == found[4] == 0.0
    text = spark.createDataFrame([(k, 0.5) for k in (1, 3, 4, 9)], "seq long, p_text double")
    fused = {r.seq: r.fused for r in similarity.fuse(text, scores).collect()}
    assert set(fused) == {1, 3, 4, 9} and fused[9] == pytest.approx(0.35)
    loose = similarity.fuse_unmatched(text, scores).first()
    assert (loose.only_text, loose.only_scores) == (1, 1)
    with pytest.raises(TypeError):
        similarity.review_scores(vec.withColumn("seq", F.col("seq").cast("string")))


def test_density_clusters_at_any_number_of_thresholds(spark):
    import random

    r = random.Random(3)
    base = [[r.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    rows = []
    for k in range(90):
        v = [x + r.gauss(0, 0.25) for x in base[k % 6]]
        size = sum(x * x for x in v) ** 0.5
        rows.append(("b", k, [x / size for x in v]))
    vec = spark.createDataFrame(rows, "business string, seq long, vector array<float>")
    for levels in ([0.9], [0.85, 0.95], [0.8, 0.9, 0.97], [0.7, 0.85, 0.92, 0.98]):
        found = []
        for block_rows in (1000, 12):
            blocks = similarity.block_vectors(vec, block_rows)
            near = similarity.neighbours(blocks, 3, 0.9, levels)
            found.append(sorted(map(tuple, similarity.density_clusters(blocks, near, levels, 3).collect())))
        assert found[0] == found[1] and found[0]


def test_reports_of_like_names_all_come_back(spark):
    names = ["sft/a-b", "sft-a/b", "SFT/a-b"]
    rows = spark.createDataFrame([(n,) for n in names], "model string")
    full = rows.select(*[(F.col("model") if f.name == "model" else F.lit(None).cast(f.dataType)).alias(f.name) for f in REPORT.fields])
    path = scratch_path(spark, "reports")
    writers.write_reports(full.coalesce(1), path)
    assert sorted(r.model for r in readers.read_reports(spark, f"{path}/*/*.txt").collect()) == sorted(names)
    nothing = readers.read_reports(spark, f"{path}/none-*/*.json", f"{path}/absent.json")
    assert nothing.isEmpty() and nothing.schema == REPORT


def test_pretty_printed_reports(spark, tmp_path):
    (tmp_path / "metrics.json").write_text('{\n  "model": "m",\n  "threshold": 0.5,\n  "per_label": {}\n}\n')
    assert [r.model for r in readers.read_reports(spark, str(tmp_path / "metrics.json")).collect()] == ["m"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_by_header(spark, tmp_path, end):
    lines = ["photo,rating,text,other,author_name,business_name", 'p.jpg,5,"two\nlines, ""quoted""",x,Ann,Cafe', ",3,plain,y,Bob,Bar"]
    (tmp_path / "r.csv").write_bytes((end.join(lines) + end).encode())
    rows = readers.read_reviews_csv(spark, str(tmp_path / "r.csv")).collect()
    assert [(r.business_name, r.author_name, r.text, r.rating, r.photo, r.rating_category) for r in rows] == [
        ("Cafe", "Ann", 'two\nlines, "quoted"', "5", "p.jpg", None),
        ("Bar", "Bob", "plain", "3", None, None),
    ]


def test_csv_without_a_required_column(spark, tmp_path):
    (tmp_path / "r.csv").write_text("business_name,author_name,text\na,b,c\n")
    with pytest.raises(ValueError, match="rating"):
        readers.read_reviews_csv(spark, str(tmp_path / "r.csv"))


def test_images_by_path(spark, tmp_path):
    (tmp_path / "cats").mkdir()
    (tmp_path / "cats" / "1.jpg").write_bytes(b"x")
    rows = spark.createDataFrame([(1, "cats/1.jpg"), (2, "dogs/1.jpg"), (3, None), (4, "./cats/1.jpg"), (5, "1.jpg")], "seq long, photo string")
    found = profile.with_image_presence(rows, readers.read_image_listing(spark, str(tmp_path)))
    assert {r.seq for r in found.filter("has_image").collect()} == {1, 4}


def test_keep_first_sorts_no_texts(spark):
    rows = spark.createDataFrame([(k, f"p{k % 5}" if k % 3 else None, "u", f"t{k % 2}") for k in range(60)],
                                 "seq long, place_name string, user_name string, text string")
    kept = balance.dedup_reviews(rows)
    first = {}
    for r in sorted(rows.collect(), key=lambda r: r.seq):
        first.setdefault((r.place_name, r.user_name, r.text), r.seq)
    assert {r.seq for r in kept.collect()} == set(first.values()) and kept.columns == rows.columns
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "first(" not in plan and "min_by" not in plan


def test_encoding_joins_types_and_keeps_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(features, "BLOCK_ROWS", 3)
    rows = [(1, "a b"), (1, "a c"), (2, "a"), (None, "a a a"), (3, ""), (4, None), (5, "zz a zz")]
    df = spark.createDataFrame(rows, "seq long, text string")
    vocab = spark.createDataFrame([("a", 5, 2), ("b", 2, 3), ("c", 2, 4)], "token string, freq long, id long")
    found = features.encode(df, vocab, max_len=3).collect()
    want = [(1, [2, 3, 0]), (1, [2, 4, 0]), (2, [2, 0, 0]), (None, [2, 2, 2]), (3, [0, 0, 0]), (4, [0, 0, 0]), (5, [1, 2, 1])]
    assert sorted(map(repr, ((r.seq, r.ids) for r in found))) == sorted(map(repr, want))
    assert features.encode(df.limit(0), vocab).collect() == []


def test_encoding_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(features, "BLOCK_ROWS", 50)
    vocab = spark.createDataFrame([("rare", 1, 2), ("b", 3, 3)], "token string, freq long, id long")
    rows = spark.createDataFrame([(k, "" if k % 10 else "rare b new") for k in range(500)] + [(500, None)], "seq long, text string")
    found = {r.seq: r.ids for r in features.encode(rows, vocab, max_len=4).collect()}
    assert len(found) == 501
    assert all(found[k] == ([0] * 4 if k % 10 or k == 500 else [2, 3, 1, 0]) for k in found)


def test_category_share_uses_a_total(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 3)], "category string, count long")
    found = dashboard.category_share(counts, "category")
    assert {r.category: r.share_pct for r in found.collect()} == {"a": 25.0, "b": 75.0}
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_answers_with_repeated_keys_and_nan(spark):
    from reviewlens.functions.policy import gate, parse_response

    answers = [
        '{"is_violation": false, "is_violation": true, "confidence": 0.2, "confidence": 0.95}',
        '{"is_violation": true, "confidence": NaN}',
        '{"is_violation": true, "confidence": 0.95',
        "nothing",
        '{"is_violation": true, "confidence": 0.95}',
    ]
    df = spark.createDataFrame([(k, a) for k, a in enumerate(answers)], "k int, a string")
    found = df.select("k", parse_response("a").alias("r")).withColumn("hit", gate(F.col("r"))).orderBy("k").collect()
    assert [r.hit for r in found] == [1, 0, 0, 0, 1]
    assert [r.r.is_violation for r in found] == [True, True, None, None, True]


def test_unaligned_counts_ids_once(spark):
    from reviewlens.operators.evaluation import unaligned

    p = spark.createDataFrame([("m", "1"), ("m", "1"), ("m", "2")], "model string, sample_id string")
    t = spark.createDataFrame([("1",), ("3",), ("3",)], "sample_id string")
    assert tuple(unaligned(p, t).first()) == ("m", 1, 1)


def test_release_deletes_this_run_only(spark):
    from reviewlens.sources.readers import path_exists
    from reviewlens.sources.scratch import run_folder

    assert scratch_path(spark, "x").startswith(run_folder(spark) + "/x-")
    assert spark.sparkContext.applicationId in run_folder(spark) and not path_exists(spark, scratch_path(spark, "x"))
