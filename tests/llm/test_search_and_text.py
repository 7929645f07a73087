"""Top-k search, decontamination, language identification and toxicity against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import decontaminate, langid, mtree, toxicity
from reviewlens.llm.arrays import LOWER, SPACE, buffers, hashes, pieces, spans

DOC = "doc_id long, text string"


def test_words_and_hashes_follow_the_bytes():
    texts = ["", "a b", None, " \t\n", "longer-than-eight-bytes é longer-than-eight-bytes", "x"]
    raw, offsets = buffers(pa.array(texts))
    begin, end, n = spans(~SPACE[raw], offsets)
    words = [bytes(raw[a:b]).decode() for a, b in zip(begin, end)]
    assert words == [w for t in texts for w in (t or "").split()]
    assert n.tolist() == [len((t or "").split()) for t in texts]
    h = hashes(raw, begin, end)
    assert h[2] == h[4] and len(set(h.tolist())) == len(set(words))
    assert bytes(LOWER[np.frombuffer("AzÉ".encode(), np.uint8)]).decode() == "azÉ"
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "bbbb", "c"])], ["t"])
    assert [p.num_rows for p in pieces([batch], "t", 3)] == [2, 1, 1]
    assert list(pieces([batch.slice(0, 0)], "t", 3)) == []


def brute_top(rows, queries, k):
    out = set()
    for q, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in rows if i != q and len(v) == len(x))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("tree_rows,page,block", [(8192, 64, 1024), (9, 3, 2)])
def test_top_k_equals_brute_force(spark, tree_rows, page, block):
    r = random.Random(3)
    rows = [(i, [r.randint(-5, 5) for _ in range(4)]) for i in range(150)]
    rows += [(1000 + i, [3, 3, 3, 3]) for i in range(80)]  # a third are one vector
    rows += [(2000, [1, 2]), (2001, [2, 1]), (2002, [9] * 4), (2003, [0] * 4)]
    extra = [(None, [1, 1, 1, 1]), (3000, None), (3001, [])]
    schema = "vec_id long, v array<long>, score string"
    df = spark.createDataFrame([(*x, "own") for x in rows + extra + rows[:1]], schema)
    asked = df.filter("vec_id % 10 = 0")
    found = mtree.top_k(df, asked, k=5, pivots=4, tree_rows=tree_rows, page=page, block=block)
    assert {tuple(x) for x in found.collect()} == brute_top(rows, [x for x in rows if x[0] % 10 == 0], 5)


def test_top_k_spares_distances():
    r = np.random.default_rng(1)
    points = np.concatenate([r.normal(c * 50, 1, (200, 6)) for c in range(10)])
    tree, found = mtree.MTree(points, 16), []

    def take(rows):
        found.extend(np.sqrt(((points[rows] - points[5]) ** 2).sum(axis=1)).tolist())
        return sorted(found)[9] if len(found) >= 10 else float("inf")

    tree.search(points[5], float("inf"), take)
    true = np.sort(np.sqrt(((points - points[5]) ** 2).sum(axis=1)))[:10]
    assert np.allclose(sorted(found)[:10], true) and tree.computed < 500 and tree.spared > 0


def test_integers_and_empty_vectors(spark):
    rows = [(1, [0.5, -0.0001]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", mtree.integers(F.col("e")).alias("v"))
    assert {r.vec_id: r.v for r in df.collect()} == {1: [512, -1], 2: None, 3: None, 4: None, 5: None}
    assert mtree.top_k(df.filter("vec_id = 9"), df).count() == 0
    assert mtree.top_k(df, df.filter("vec_id = 9")).count() == 0


def brute_contamination(docs, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for d, t in docs:
        w, hit, ids = cut(t), set(), set()
        for i, x in items:
            v = cut(x)
            size = min(13, len(v))
            windows = {tuple(v[k : k + size]) for k in range(len(v) - size + 1)} if v else set()
            for k in range(len(w) - size + 1):
                if size and tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    ids |= {str(i)} if i is not None else set()
        out.append((d, len(w), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination_equals_brute_force(spark):
    r = random.Random(5)
    words = ["a", "B", "é", "É", "x1", "İ", "the", "of", "zz"]
    text = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(k, text(r.randint(13, 30))) for k in range(6)] + [(6, "b of zz"), (7, "İ"), (8, ""), (9, None), (10, "?!")]
    items += [(11, items[0][1]), (None, items[1][1]), (3, items[3][1]), (12, "a " * 20)]
    docs = [(k, text(r.randint(0, 60))) for k in range(25)] + [(30, None), (31, ""), (32, "a " * 60)]
    docs += [(40 + k, text(20) + items[k][1] + text(300)) for k in range(6)]
    docs += [(50, items[2][1].upper()), (50, items[2][1].upper()), (50, "else"), (None, items[0][1])]
    d = spark.createDataFrame([(*x, 7) for x in docs], DOC + ", n_hit int").repartition(3)
    b = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, words string")
    found = decontaminate.contamination(d, b).collect()
    assert sorted(((x.doc_id, x.n_words, x.n_hit, x.item_ids, x.contaminated) for x in found), key=repr) == (
        brute_contamination(docs, items)
    )
    assert decontaminate.contamination(d.limit(0), b).isEmpty()
    clean = decontaminate.contamination(d, b.limit(0))
    assert clean.count() == len(docs) and clean.filter("contaminated or n_items > 0").isEmpty()


def test_winnowing_keeps_a_print_of_every_shared_span(spark):
    r = random.Random(8)
    for _ in range(3):
        shared = [r.choice("abcdef") for _ in range(13)]
        both = [[r.choice("abcdef") for _ in range(r.randint(0, 30))] + shared + [r.choice("abc")] for _ in range(2)]
        rows = decontaminate.fingerprints(spark.createDataFrame([(w,) for w in both], "words array<string>")).collect()
        assert set(rows[0].prints) & set(rows[1].prints)


def naive_phrases(text, sample):
    count, phrase = 1, ""
    for c in text:
        if phrase + c in sample:
            phrase += c
        else:
            count, phrase = count + 1, c if c in sample else ""
            count += not phrase
    return count


def test_phrases_equal_a_naive_parse():
    r = random.Random(2)
    samples = {x: "".join(r.choice(x + "   ") for _ in range(300)) for x in ("abcd", "cdef", "xyz")}
    parser = langid.Parser(samples)
    of = lambda t: langid.encode(*buffers(pa.array([t])), parser.table)[0].tolist()
    texts = ["".join(r.choice("abcdefxyz q!") for _ in range(n)) for n in (0, 1, 5, 80, 900)]
    coded, heads, _ = langid.encode(*buffers(pa.array(texts)), parser.table)
    found = parser.phrases(coded, heads)
    letter = lambda codes: "".join(chr(200 + c) for c in codes)
    for k, text in enumerate(texts):
        for j, name in enumerate(parser.names):
            assert found[k, j] == (naive_phrases(letter(of(text)), letter(of(samples[name]))) if text else 0)


def test_languages(spark):
    speech = {"en": "the quick brown fox and the lazy dog went over there ", "de": "der schnelle braune fuchs und der faule hund gingen "}
    rows = [(k, speech[x][k % 9 :] * 3, x) for k in range(40) for x in speech]
    df = spark.createDataFrame([*rows, (90, None, "fr"), (91, "x", None)], DOC + ", lang string")
    samples = langid.learn(df.select("text", "lang"))
    assert set(samples) == {"en", "de"} and langid.learn(df.select("text", "lang")) == samples
    texts = [(1, "the dog and the fox"), (2, "DER HUND UND DER FUCHS"), (3, None), (4, ""), (5, "123 !?"), (6, "𝒜" * 3), (1, "the dog and the fox")]
    docs = spark.createDataFrame([(*x, "old") for x in [*texts, (7, "der hund und der fuchs, " * 5000)]], DOC + ", lang_pred string")
    found = {r.doc_id: r for r in langid.identify(docs, samples).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3, 4, 5, 7)] == ["en", "de", "und", "und", "und", "de"]
    assert found[6].lang_pred in samples and all(0 <= r.lang_score <= 1 for r in found.values())
    assert langid.identify(docs, samples).count() == len(texts) + 1
    assert langid.identify(docs.limit(0), samples).isEmpty()
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.learn(df.select("text", "lang").limit(0)) == {}


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    import __spark_entry__ as driver

    found = driver.queries()["op8_language"](spark, "/root/testdata/sf0.01").filter("held_out")
    right = found.join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.97


def test_toxicity_learns_words_and_beginnings(spark):
    r = random.Random(4)
    plain = ["".join(r.choice("bcdfg") + r.choice("aeiou") for _ in range(3)) for _ in range(200)]
    bad = ["zzurk", "qqost" + "ab", "qqost" + "en", "qqost" + "ig"]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 5 == 0
        words = [r.choice(plain) for _ in range(60)]
        if toxic:
            for _ in range(4):
                words.insert(r.randint(0, 60), r.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame([*rows, (700, None), (701, ""), (0, rows[0][1])], DOC)
    own = spark.createDataFrame([*labels, (None, 1), (9, None), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, own.filter("doc_id % 3 <> 0 or doc_id is null"))
    found = toxicity.score(docs.withColumn("toxicity", F.lit("old")), model)
    scores = {x.doc_id: x.toxicity for x in found.collect()}
    assert found.count() == len(rows) + 3 and found.columns == ["doc_id", "toxicity"]
    held = [k for k, _ in labels if k % 3 == 0]
    assert all((scores[k] >= 0.3) == (k % 5 == 0) for k in held)
    assert 0 <= scores[700] == scores[701] < 0.3
    hidden = spark.createDataFrame([(1, " ".join(plain[:20]) + " zzurk"), (2, "zzurk " * 9 + plain[0])], DOC)
    kept = toxicity.score(hidden, model, keep_text=True)
    assert kept.columns == ["doc_id", "text", "toxicity"] and kept.count() == 2
    assert toxicity.score(docs.limit(0), model).isEmpty()


@pytest.mark.parametrize("labels,base", [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0)])
def test_toxicity_without_two_kinds_of_labels(spark, labels, base):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOC)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [x.toxicity for x in toxicity.score(docs, model).collect()] == [base, base]


def test_features_see_hidden_words_and_shouting():
    raw, offsets = buffers(pa.array(["idiot"]))
    whole = [h for at, h in toxicity._terms(LOWER[raw], *spans(SPACE[raw] == 0, offsets)[:2])][0]
    lexicon = toxicity.Lexicon(whole, np.array([2.0]))
    names = list(toxicity.FEATURES)
    found = toxicity.features(pa.array(["you idiot", "1d10t", "HELLO YOU!", "", None]), lexicon)
    at = lambda row, name: found[row, names.index(name)]
    assert at(0, "density") == 1.0 and at(0, "addressed") > 0 and at(0, "hidden") == 0
    assert at(1, "density") == 0 and at(1, "hidden") > 0 and at(1, "digits") > 0
    assert at(2, "shouted") == 1.0 and at(2, "exclaimed") > 0 and (found[3:] == 0).all()


def test_an_id_with_several_vectors_is_one_candidate(spark):
    rows = [(1, [100 + k, 1]) for k in range(30)] + [(k, [k, 0]) for k in range(2, 40)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    ask = spark.createDataFrame([(1000, [1, 0])], "vec_id long, v array<long>")
    found = sorted((x["rank"], x.vec_id, x.score) for x in mtree.top_k(df, ask, tree_rows=8, page=4).collect())
    assert found == [(1, 1, 129)] + [(k + 2, 39 - k, 39 - k) for k in range(9)]
