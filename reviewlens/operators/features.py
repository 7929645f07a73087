"""Vocabulary and fixed-length encoding."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.text import tokens
from reviewlens.operators.ordered import with_dense_ids
from reviewlens.sources.scratch import materialise

# Padding and unknown ids; real ids follow.
PAD, UNKNOWN = 0, 1
#: Rows of a block; bounds what a task holds, with the length that rows are cut to.
BLOCK_ROWS = 4096


def build_vocab(df: DataFrame, text: str = "text", min_freq: int = 2) -> DataFrame:
    """(token, freq, id) of the tokens seen often enough, ids from 2 in token order."""
    counted = (
        df.select(F.explode(tokens(text)).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("freq"))
        .filter(F.col("freq") >= min_freq)
    )
    return with_dense_ids(counted, ["token"], "id", start=UNKNOWN + 1).select("token", "freq", "id")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, words) as blocks: keys, the codes of each row, and the block's distinct tokens, once."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            words = part.column("words")
            encoded = words.flatten().dictionary_encode()
            ends = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())])
            codes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), encoded.indices)
            whole = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (part.column("key"), codes, encoded.dictionary)]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *whole], ["block", "keys", "codes", "words"])


def _unpack(batches: Iterator[pa.RecordBatch], max_len: int, name: str) -> Iterator[pa.RecordBatch]:
    """Blocks with the ids of their distinct tokens as rows (key, ids)."""
    for batch in batches:
        for i in range(batch.num_rows):
            keys, rows = batch.column("keys")[i].values, batch.column("codes")[i].values
            sizes = rows.value_lengths().to_numpy().astype(np.int64)
            ids = batch.column("ids")[i].values
            known = np.zeros(0, np.int64) if ids is None else ids.to_numpy()
            out = np.full((len(keys), max_len), PAD, np.int64)
            out[np.arange(max_len) < sizes[:, None]] = known[rows.flatten().to_numpy()]
            ends = pa.array(np.arange(0, out.size + 1, max_len, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(ends, pa.array(out.ravel()))], [name, "ids"])


def encode(df: DataFrame, vocab: DataFrame, text: str = "text", key: str = "seq", max_len: int = 256) -> DataFrame:
    """(key, ids) of every row: token ids cut and zero-padded to ``max_len``. Rows with equal keys stay rows of their own.

    Rows are packed into blocks. Only a block's distinct tokens meet the vocabulary, which grows with the data and is
    not broadcast: a token that is in every row is one row of the join for each block. Their ids come back as one array
    for each block, in the order of its codes.
    """
    kind = df.schema[key].dataType.simpleString()
    cut = df.select(F.col(key).alias("key"), F.slice(tokens(text), 1, max_len).alias("words"))
    blocks = materialise(
        cut.mapInArrow(_pack, f"block string, keys array<{kind}>, codes array<array<int>>, words array<string>"), "blocks"
    )
    own = blocks.select("block", F.posexplode("words").alias("pos", "token"))
    met = own.join(vocab.select("token", "id"), "token", "left")
    pair = F.struct("pos", F.coalesce("id", F.lit(UNKNOWN)).cast("long").alias("id"))
    listed = met.groupBy("block").agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
    ids = listed.select("block", F.col("pairs.id").alias("ids"))
    none = F.array().cast("array<bigint>")
    home = blocks.drop("words").join(ids, "block", "left").withColumn("ids", F.coalesce("ids", none))
    return home.mapInArrow(partial(_unpack, max_len=max_len, name=key), f"`{key}` {kind}, ids array<bigint>")
