"""What a Python worker holds at once in the pipeline's stages."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

import corpus_pipeline
from reviewlens.llm import langid, lexicon_bpe, setsketch, toxicity
from reviewlens.llm.queries import tokenizer_file

MB = 1 << 20


def texts_of(size, seed=1):
    """Texts of 500 to 4,000 characters, ``size`` bytes or a little more together."""
    draw, out = random.Random(seed), []
    words = ["".join(draw.choices("abcdefghijklmnopqrst", k=draw.randint(2, 9))) for _ in range(5000)]
    while size > 0:
        out.append(" ".join(draw.choices(words, k=draw.randint(80, 620))))
        size -= len(out[-1])
    return out


def held(run, batch):
    """MB that ``run`` takes at its peak beside the batch; numpy's arrays are counted."""
    for _ in run(iter([batch.slice(0, 1)])):
        pass  # what is loaded once
    tracemalloc.start()
    for out in run(iter([batch])):
        del out
    peak = tracemalloc.get_traced_memory()[1] / MB
    tracemalloc.stop()
    return peak


@pytest.fixture(scope="module")
def batch():
    own = texts_of(6 * MB)
    keys = pa.array(range(len(own)), pa.int64())
    return pa.RecordBatch.from_arrays([keys, keys, pa.array(own, pa.string())], ["doc_id", "key", "text"])


def task_of(monkeypatch, docs, op):
    """The function that ``op`` gives to mapInArrow."""
    given = []
    with monkeypatch.context() as m:
        m.setattr(type(docs), "mapInArrow", lambda self, f, schema: given.append(f) or self.withColumn("_features", F.array(F.lit(0.0))))
        op(docs)
    return given[0]


def test_language_takes_little_beside_the_batch(spark, batch, monkeypatch):
    docs = spark.createDataFrame([(1, 1, "a b")], "doc_id long, key long, text string")
    samples = {"en": " ".join(texts_of(3000, 2)), "de": " ".join(texts_of(3000, 3))}
    run = task_of(monkeypatch, docs, lambda df: langid.identify(df, samples))
    assert held(run, batch) < 30


def test_toxicity_takes_little_beside_the_batch(spark, batch, monkeypatch):
    docs = spark.createDataFrame([(1, 1, "a b")], "doc_id long, key long, text string")
    lexicon = toxicity.Lexicon(np.arange(1, 5, dtype=np.uint64), np.ones(4))
    run = task_of(monkeypatch, docs, lambda df: toxicity._with_features(df, lexicon, "text", keep_text=True))
    assert held(run, batch) < 30


def test_sketches_take_little_beside_the_batch(batch):
    assert held(setsketch._sketch, batch) < 30


def test_learning_languages_starts_no_worker_for_its_shares(spark, monkeypatch):
    rows = [(f"text number {k} {'und' if k % 2 else 'and'}", "de" if k % 2 else "en") for k in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string").localCheckpoint()
    expected = {"de", "en"}

    def refuse(*_, **__):
        raise AssertionError("a list went through Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", refuse)
    assert set(langid.learn(docs)) == expected


def test_batches_of_the_pipeline_are_bounded_by_bytes(spark, sf):
    key = corpus_pipeline.BATCH_CONF
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        long = spark.range(60).select(
            F.col("id").alias("doc_id"), F.repeat(F.lit("so weit so gut "), 40_000).alias("text"), F.lit("de").alias("lang")
        )
        corpus_pipeline.drop_languageless(spark, docs, sf)

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

        found = long.coalesce(1).mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in found) == 60
        assert max(r.bytes for r in found) < 4 * MB  # 36 MB in one before
        spark.conf.set(key, "1234567")
        corpus_pipeline.drop_languageless(spark, docs, sf)
        assert spark.conf.get(key) == "1234567"  # a bound that is there stays
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_a_worker_forgets_the_words_of_an_encoder_with_its_broadcast(spark):
    """Workers are reused: a later task on the same worker finds no vocabulary, encoder or remembered words."""
    docs = spark.createDataFrame([(k, f"a few words {k}") for k in range(200)], "doc_id long, text string").repartition(8)
    raw = tokenizer_file("word_bpe_49k.json")
    encoded = lexicon_bpe.encode(docs, raw, lexicon_bpe.frequent_words(docs, raw))
    assert encoded.filter("n_tokens > 0").count() == 200

    def held_here(batches):
        import gc
        import os
        import sys

        for _ in batches:
            pass
        gc.collect()
        own = sys.modules.get("reviewlens.llm.lexicon_bpe")
        kinds = (own.Vocabulary, own.Encoder) if own else ()
        n = sum(isinstance(x, kinds) for x in gc.get_objects())
        yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([own is not None]), pa.array([n])], ["pid", "used", "held"])

    found = docs.mapInArrow(held_here, "pid long, used boolean, held long").collect()
    assert any(r.used for r in found)  # workers that had encoded
    assert not any(r.held for r in found)
