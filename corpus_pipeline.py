"""From raw documents to token ids: toxic texts, texts in no language, near-duplicates and benchmark copies go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import decontaminate, langid, lexicon_bpe, setsketch, toxicity
from reviewlens.llm.queries import fold, table, tokenizer_file
from reviewlens.sources.scratch import scratch_path

#: Documents of this toxicity go.
TOXIC = 0.3
#: Bytes of rows that a Python worker gets at once. Spark counts rows only, unless told: 10,000 documents of 3,300 bytes
#: are 33 MB, of longer ones any number, and executor and worker hold them several times over.
BATCH_BYTES = 2 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, unless they are already. No result depends on how rows are batched."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def _with(docs: DataFrame, names: list[str], op: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``op`` on ``docs`` while columns that it would replace have other names; the columns of ``docs`` of its result."""
    away = {c: f"_aside_{c}" for c in docs.columns if c.lower() in names}
    found = op(docs.withColumnsRenamed(away))
    return found.select(*[F.col(away.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labels doesn't call toxic; a null text is scored as an empty one."""
    bound_batches(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold("doc_id", 4) != 2)
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return _with(
        docs,
        ["toxicity"],
        lambda df: toxicity.score(df, model, keep_text=True).filter(F.col("toxicity") < TOXIC),
    )


def drop_languageless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters: the others have no language. Which language the others are in decides nothing."""
    bound_batches(spark)
    samples = langid.learn(docs.filter(fold("doc_id", 4) != 2).select("text", "lang"))
    samples = samples or {"any": "a"}  # with nothing to learn, letters still tell
    return _with(
        docs,
        ["lang_pred", "lang_score"],
        lambda df: langid.identify(df, samples).filter("lang_pred <> 'und'"),
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document of least doc_id; rows of one doc_id stay together."""
    bound_batches(spark)
    found = setsketch.cluster(docs.select("doc_id", "text"))
    return docs.join(found.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words are in benchmark spans."""
    found = decontaminate.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    found = found.filter("contaminated").select(F.col("text_key").alias("_text_key")).distinct()
    keyed = docs.withColumn("_text_key", decontaminate.text_key())
    return keyed.join(found, "_text_key", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and digests of the ids and of the decoded text."""
    bound_batches(spark)
    vocabulary = tokenizer_file("word_bpe_49k.json")
    own = docs.select("doc_id", "text")
    found = lexicon_bpe.encode(own, vocabulary, lexicon_bpe.frequent_words(own, vocabulary))
    return found.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", drop_languageless),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: No SQL: stages fit models. The tests hold each stage against its operator and against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the whole of what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
