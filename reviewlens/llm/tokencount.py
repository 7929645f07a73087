"""Token counts through a digest cache: only contents the cache has never seen are encoded."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.sources.scratch import materialise

CACHE = "version string, digest binary, n_tokens long"
#: Units a worker remembers before it starts over; bounds its memory, never its results.
MEMO = 300_000


def version_digest(model: bytes) -> str:
    """Names what counts depend on: the vocabulary file and the library that reads it."""
    import sentencepiece

    return hashlib.sha256(model + sentencepiece.__version__.encode()).hexdigest()


class PieceCounter:
    """Counts pieces as the library does, remembering units between which no piece can reach.

    The library turns each space into a mark, puts one mark in front and merges neighbours. If the model
    leaves texts as they are and no piece has a mark after another character, no merge crosses from a
    non-space to a space, so a text is the sum of its units (marks, then other characters). With any
    other model whole texts are encoded.
    """

    MARK = "▁"

    def __init__(self, model: bytes):
        import sentencepiece

        self.encode = sentencepiece.SentencePieceProcessor(model_proto=model).encode
        names = [self.pieces(i) for i in range(self.encode.__self__.vocab_size())]
        probe = " \tÅﬁ  é 　x "
        same = self.encode.__self__.decode(self.encode(probe)) == probe
        self.split = same and not any(self.MARK in x.lstrip(self.MARK) for x in names)
        self.memo: dict[str, int] = {}

    def pieces(self, i: int) -> str:
        return self.encode.__self__.id_to_piece(i)

    def unit(self, marks: int, rest: str) -> int:
        if marks == 1 and not rest:
            return self.lone()
        return len(self.encode(" " * (marks - 1) + rest))

    def lone(self) -> int:
        """A mark on its own, which the library's empty text hides: of two words' worth, less one."""
        return len(self.encode("a ")) - len(self.encode("a"))

    def __call__(self, text: str) -> int:
        if not self.split or not text:
            return len(self.encode(text))
        text = text.replace(self.MARK, " ")
        if len(self.memo) > MEMO:
            self.memo.clear()
        units = (" " + text).split(" ")[1:] if "  " not in text and text[0] != " " else None
        if units is None:
            units = re.findall(r" +[^ ]*", " " + text)
            units = [x[1:] if x[1:2] != " " and len(x) > 1 else x for x in units]
            units = ["" if x == " " else x for x in units]
        total, memo = 0, self.memo
        for x in units:
            n = memo.get(x)
            if n is None:
                marks = len(x) - len(x.lstrip(" ")) or 1
                n = memo[x] = self.unit(marks, x.lstrip(" "))
            total += n
        return total


def counts_of(model: bytes, version: str):
    """The task that encodes distinct contents: rows (digest, text) to rows of the cache."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = PieceCounter(model)
        for batch in batches:
            found = [count(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(found), pa.string()), batch.column("digest"), pa.array(found, pa.int64())],
                ["version", "digest", "n_tokens"],
            )

    return run


def cached(spark, path: str, version: str) -> DataFrame:
    """What the cache holds for this version, one row per digest."""
    try:
        table = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], CACHE)
    held = table.filter(F.col("version") == version)
    # two runs that missed the same content at the same time have both appended it
    return held.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_bytes (UTF-8), digest and n_tokens; appends what the cache missed.

    The normal form of a content is its text with null as empty: the tokenizer tells any two other texts
    apart. Equal contents are one row before anything is shuffled, so a group of copies of any size
    costs one row per task, and is encoded once. Counts join back by digest; AQE splits a hot digest.
    A null text counts as empty, repeated rows stay, other columns stay as they are (n_bytes, digest and
    n_tokens among them are replaced), an empty table gives no rows and leaves the cache as it is.
    """
    spark = docs.sparkSession
    version = version_digest(model)
    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(content, 256))
    first = docs.select(digest.alias("digest"), content.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = first.join(cached(spark, cache, version), "digest", "left_anti")
    misses.mapInArrow(counts_of(model, version), CACHE).write.mode("append").parquet(cache)
    known = materialise(cached(spark, cache, version), "counts")
    keyed = docs.withColumns({"n_bytes": F.octet_length(content).cast("long"), "digest": digest}).drop(text, "n_tokens")
    return keyed.join(known, "digest", "left")
