"""Near-duplicate reviews by cascaded MinHash, with rows in proportion to the reviews.

1. Reviews of a group with the same shingles are one row (``shingle_sets``).
2. A signature has 128 least hashes, cut into 32 bands. Rows of one group that agree in a band share a bucket.
3. A bucket is a star, not a set of pairs: each member is compared with one row in the middle, the first in one of four
   orders that the bands take in turn, so that a row meets several middles. The full shingle sets decide. A member that
   its middle refuses stays for the next round, in which the first of those refused is the middle; a crowded bucket is
   split there by the four values that follow the band's.
4. Kept edges are joined to clusters by connected components.

Candidates are approximate by design: two similar rows may share no band (once in 10^7 at 0.8) or never meet as member
and middle. What is kept is exact, since every edge is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.text import tokens
from reviewlens.operators.components import connected_components
from reviewlens.operators.ordered import null_safe
from reviewlens.sources.scratch import materialise

BANDS, ROWS = 32, 4
#: Orders in which the middle of a bucket is chosen.
ORDERS = 4
#: Rounds in which buckets are looked at; members of a bucket above which it is split by a longer signature.
ROUNDS, CROWDED = 4, 64
#: Rows for each edge from which on the rows that take part are sought first.
FEW = 20

_SEEDS = np.random.Generator(np.random.Philox(11)).integers(1 << 63, size=(2, BANDS * ROWS), dtype=np.uint64)
#: Shingles that are hashed at once.
_STEP = 1 << 16


def keyed_shingles(df: DataFrame, within: list[str], text: str = "text", seq: str = "seq", size: int = 5) -> DataFrame:
    """The group, seq, shingles (distinct, sorted) and set_key of each review with tokens.

    A shingle is the hash of ``size`` consecutive tokens; a shorter text is one shingle.
    """
    words = df.select(*within, F.col(seq).alias("seq"), tokens(text).alias("_words"))
    n = F.size("_words")
    grams = F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.xxhash64(F.slice("_words", i, size)))
    shingles = F.when(n >= size, F.array_sort(F.array_distinct(grams))).otherwise(F.array(F.xxhash64("_words")))
    found = words.filter(n > 0).select(*within, "seq", shingles.alias("shingles"))
    return found.withColumn("set_key", F.md5(F.array_join("shingles", ",")))


def shingle_sets(keyed: DataFrame, within: list[str]) -> DataFrame:
    """One row per set of shingles of a group: the group, set_key, shingles, rep (lowest seq), copies."""
    return keyed.groupBy(*within, "set_key", "shingles").agg(F.min("seq").alias("rep"), F.count("*").alias("copies"))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factor, shift = _SEEDS | np.uint64(1)
    for batch in batches:
        lists = batch.column("shingles")
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.cumsum(sizes)
        out = np.full((batch.num_rows, BANDS * ROWS), np.iinfo(np.uint64).max, np.uint64)
        row = np.repeat(np.arange(batch.num_rows), sizes)
        for at in range(0, int(ends[-1]) if len(ends) else 0, _STEP):
            part, of = values[at : at + _STEP], row[at : at + _STEP]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            for k in range(BANDS * ROWS):
                mixed = part * factor[k] + shift[k]
                mixed ^= mixed >> np.uint64(31)
                mixed *= factor[-1 - k]
                out[of[first], k] = np.minimum(out[of[first], k], np.minimum.reduceat(mixed, first))
        offsets = pa.array(np.arange(0, out.size + 1, BANDS * ROWS, dtype=np.int32))
        signature = pa.ListArray.from_arrays(offsets, pa.array(out.view(np.int64).ravel()))
        others = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "shingles"]
        names = [name for name in batch.schema.names if name != "shingles"]
        yield pa.RecordBatch.from_arrays([*others, signature], [*names, "signature"])


def similar_stars(sets: DataFrame, within: list[str], threshold: float = 0.8) -> DataFrame:
    """Verified edges (rep, middle, similarity) between rows of ``shingle_sets``, at most a few for each row.

    ``sets`` is read several times, so it had better be a written table.
    """
    groups = [f"_g{i}" for i in range(len(within))]
    sets = sets.withColumnsRenamed(dict(zip(within, groups, strict=True)))
    sized = sets.select(*groups, "rep", F.size("shingles").alias("n"), "shingles")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sized.schema.fields if f.name != "shingles")
    signed = sized.mapInArrow(_signatures, f"{kinds}, signature array<bigint>")
    # the values of a band, then those of the bands after it: what a longer signature adds
    around = F.concat("signature", F.slice("signature", 1, ROWS * ROUNDS))
    cut = signed.withColumn("around", around).select(*groups, "rep", "n", "around", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    keys = F.array(*[F.xxhash64("band", F.slice("around", F.col("band") * ROWS + 1, ROWS * r)) for r in range(1, ROUNDS + 1)])
    turn = (F.col("band") % ORDERS).alias("turn")
    banded = cut.select(*groups, "rep", "n", turn, keys.alias("keys"), F.lit(0).alias("level"))
    waiting = materialise(banded.withColumn("bucket", F.get("keys", F.lit(0))), "bands")
    found, shingles, few = None, sets.select("rep", "shingles"), sets.count() / FEW
    for _ in range(ROUNDS):
        bucket = [*groups, "level", "bucket"]
        first = F.min_by("rep", F.xxhash64("rep", "turn")).alias("middle")
        middle = waiting.groupBy(*bucket).agg(first, F.count("*").alias("held")).filter("held > 1")
        # a crowded bucket is one key; next to a written table its rows can be split at run time
        met = null_safe(waiting, materialise(middle, "middles"), bucket).filter("rep <> middle")
        met = materialise(met, "met")
        edges = met.select("rep", "middle").distinct()
        if found is not None:
            edges = edges.join(found.select("rep", "middle"), ["rep", "middle"], "left_anti")
        edges = materialise(edges, "edges")
        part = shingles
        if edges.count() < few:
            # the shingles are most of the bytes: next to few edges, only those that take part are sent to them
            ends = edges.select("rep").union(edges.select("middle")).distinct()
            part = materialise(shingles.join(ends, "rep", "left_semi"), "part")
        a, b = (part.select(F.col("rep").alias(x), F.col("shingles").alias(f"_{x}")) for x in ("rep", "middle"))
        both = edges.join(a, "rep").join(b, "middle")
        shared = F.size(F.array_intersect("_rep", "_middle"))
        union = F.size("_rep") + F.size("_middle") - F.col("shared")
        kept = both.withColumn("shared", shared).select("rep", "middle", (F.col("shared") / union).alias("similarity"))
        kept = materialise(kept.filter(F.col("similarity") >= threshold), "kept")
        found = kept if found is None else found.unionByName(kept)
        refused = met.join(found.select("rep", "middle"), ["rep", "middle"], "left_anti")
        level = F.when(F.col("held") > CROWDED, F.least(F.col("level") + 1, F.lit(ROUNDS - 1))).otherwise(F.col("level"))
        refused = refused.withColumn("level", level).withColumn("bucket", F.get("keys", F.col("level")))
        waiting = materialise(refused.select(*waiting.columns), "refused")
        if waiting.isEmpty():
            break
    return found


def near_duplicates(
    df: DataFrame, within: list[str] = [], text: str = "text", seq: str = "seq", size: int = 5, threshold: float = 0.8
) -> DataFrame:
    """(seq, cluster, copies) of reviews with tokens: the lowest seq of its near-duplicates, and how many have its text.

    Two reviews of a group are near-duplicates if their shingles' intersection is ``threshold`` of the union or more.
    ``seq`` is a whole number, unique over all groups.
    """
    # shingles are several times their text: they are cut twice and written once for each set
    cut = keyed_shingles(df, within, text, seq, size)
    keyed, sets = materialise(cut.drop("shingles"), "keyed"), materialise(shingle_sets(cut, within), "shingles")
    edges = similar_stars(sets, within, threshold)
    parts = connected_components(edges.select(F.col("rep").alias("u"), F.col("middle").alias("v")))
    heads = sets.select(*within, "set_key", "rep", "copies").join(parts.withColumnRenamed("vertex", "rep"), "rep", "left")
    heads = heads.select(*within, "set_key", "copies", F.coalesce("component", "rep").alias("cluster"))
    met = null_safe(keyed.select(*within, "seq", "set_key"), materialise(heads, "heads"), [*within, "set_key"])
    return met.select("seq", "cluster", "copies")
