"""Coordinated-review detection: how alike are the reviews of a business.

How it stays bounded whatever the size of a business or of a group of copies:

* Equal vectors of a business become one row with a weight, so copies never meet pairwise.
* A business is cut into blocks of at most ``block_rows`` distinct vectors near one pivot. Blocks travel
  in tiles of about ``TILE_ROWS`` rows, so small blocks send a row no more often than large ones. A row
  goes to the cells (own tile, other tile) that can matter; a cell compares two tiles by matrix products,
  ``AT_ONCE`` similarities at a time, and returns a fixed amount per row: counts, its k nearest, its
  component root. No task holds more than two tiles and no table of pairs is written.
* A block has a centre and a radius, which bound every similarity between two blocks. A cell is left
  out if its bound is below the lowest threshold and below the k-th nearest that each row of either
  block has found in its own block. Results don't change; unlike blocks never meet.
* Density clusters need the neighbour counts first (one pass), then only component roots per cell
  (second pass); roots of one vector seen in several cells are merged by connected components.
* Mean similarities of clusters come from vector sums: sum over pairs of x.y = |sum x|^2 - sum |x|^2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.text import business_key, is_blank, text_or_empty, tokens
from reviewlens.operators.components import connected_components
from reviewlens.operators.ordered import join_heavy, shuffle_partitions
from reviewlens.schemas import FuseConfig, ScanConfig
from reviewlens.sources.scratch import materialise

PAIR_ROWS = 256
MOST_PIVOTS = 4096
#: Rows after which a tile of blocks is full; similarities that a task holds at once.
TILE_ROWS = 4096
AT_ONCE = 1 << 19


def eligible_reviews(df: DataFrame, seq: str = "seq", original_only: bool = True) -> DataFrame:
    """(business, seq, text) of original reviews with a business and a text."""
    if original_only and "source" in df.columns:
        df = df.filter(F.col("source") == "original")
    return (
        df.withColumn("business", business_key(df, "drop", seq))
        .filter(F.col("business").isNotNull() & ~is_blank("text"))
        .select("business", F.col(seq).alias("seq"), "text")
    )


def embed(df: DataFrame, text: str = "text", dims: int = 256, gram: int = 2) -> DataFrame:
    """Adds ``vector``: unit-length counts of hashed tokens and token n-grams. Stays in the JVM."""
    words = df.withColumn("_words", tokens(text))
    grams, longer = [F.col("_words")], F.col("_words")
    for size in range(2, gram + 1):
        # each gram of the size before, followed by the word after it; the last ones have none
        rest = F.slice("_words", F.lit(size), F.greatest(F.size("_words"), F.lit(1)))
        longer = F.array_compact(
            F.zip_with(longer, rest, lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
        )
        grams.append(longer)
    words = words.withColumn("_grams", F.concat(*grams))
    counted = HashingTF(numFeatures=dims, inputCol="_grams", outputCol="_tf").transform(words)
    unit = Normalizer(p=2.0, inputCol="_tf", outputCol="_unit").transform(counted)
    return unit.withColumn("vector", vector_to_array("_unit", "float32")).drop(
        "_words", "_grams", "_tf", "_unit"
    )


def embed_with(df: DataFrame, make_embedder, text: str = "text") -> DataFrame:
    """Adds ``vector`` from a pluggable model: one instance per partition, called per batch of texts.

    The model returns one row per text; rows are scaled to unit length.
    """

    def run(batches):
        model = make_embedder()
        for batch in batches:
            found = np.asarray(model(batch[text].tolist()), dtype=np.float32)
            size = np.linalg.norm(found, axis=1, keepdims=True)
            yield batch.assign(vector=list(found / np.where(size > 0, size, 1)))

    schema = T.StructType([*df.schema.fields, T.StructField("vector", T.ArrayType(T.FloatType()))])
    return df.mapInPandas(run, schema)


# ---- blocks -----------------------------------------------------------------------------------


def block_vectors(vec: DataFrame, block_rows: int, min_reviews: int = 1) -> DataFrame:
    """One row per distinct vector of a business: lowest seq, copies, business size, own block.

    ``vec`` has business, seq and vector; ``seq`` is a whole number, unique over all businesses.
    """
    if not isinstance(vec.schema["seq"].dataType, T.IntegralType):
        raise TypeError(f"seq must be a whole number, not {vec.schema['seq'].dataType.simpleString()}")
    vec = vec.withColumn("seq", F.col("seq").cast("long"))
    distinct = (
        vec.filter("business IS NOT NULL AND vector IS NOT NULL")
        .groupBy("business", "vector")
        .agg(F.min("seq").alias("rep"), F.count("*").alias("w"))
    )
    sizes = (
        distinct.groupBy("business")
        .agg(F.sum("w").alias("n"), F.count("*").alias("m"))
        .filter(F.col("n") >= min_reviews)
        .withColumn("blocks", F.ceil(F.col("m") / block_rows).cast("int"))
    )
    placed = join_heavy(distinct, sizes, ["business"], "m", "rep")
    placed = materialise(placed, "placed")
    one = placed.filter("blocks = 1").withColumn("block", F.lit(0))
    if placed.filter("blocks > 1").isEmpty():
        return one
    return materialise(one.unionByName(_near_pivots(placed.filter("blocks > 1"), block_rows)), "blocks")


def _near_pivots(placed: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of vectors with the same nearest pivot, several for a pivot near to many.

    The pivots of a business are drawn by hash: about twice as many as it has full blocks, some MOST_PIVOTS at most.
    They only place the vectors; without any, a business is cut by hash alone.
    """
    among = F.greatest(F.lit(max(1, block_rows // 2)).cast("long"), F.expr(f"n div {MOST_PIVOTS}"))
    drawn = F.pmod(F.xxhash64("rep", F.lit("pivot")), among) == 0
    pivots = materialise(placed.filter(drawn).select("business", "rep", "vector", "blocks"), "pivots")
    # every slice gets all pivots, so small blocks must not make more slices
    slices = F.ceil(F.col("blocks") * min(1.0, block_rows / TILE_ROWS)).cast("int")
    own = F.pmod(F.xxhash64("rep"), slices.cast("long")).cast("int")
    rows = placed.withColumn("slice", own).groupBy("business", "slice")
    sent = pivots.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).groupBy("business", "slice")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema.fields)
    near = materialise(rows.cogroup(sent).applyInArrow(_nearest_pivot, f"{kinds}, pivot bigint"), "near-pivots")
    held = near.groupBy("business", "pivot").agg(F.count("*").alias("_held"))
    parts = held.select("business", "pivot", "_held", F.ceil(F.col("_held") / block_rows).cast("int").alias("_parts"))
    order = Window.partitionBy("business").orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.withColumn("_first", F.coalesce(F.sum("_parts").over(order), F.lit(0)))
    met = join_heavy(near, first, ["business", "pivot"], "_held", "rep")
    part = F.pmod(F.xxhash64("rep", F.lit("part")), F.col("_parts").cast("long"))
    return met.withColumn("block", (F.col("_first") + part).cast("int")).drop("pivot", "_first", "_parts")


def _nearest_pivot(rows: pa.Table, pivots: pa.Table) -> pa.Table:
    if not rows.num_rows or not pivots.num_rows:
        return rows.drop(["slice"]).append_column("pivot", pa.repeat(pa.scalar(0, pa.int64()), rows.num_rows))
    x, p, names = _matrix(rows), _matrix(pivots), pivots.column("rep").to_numpy()
    order = np.argsort(names)
    p, names = p[order], names[order]
    found = np.empty(len(x), np.int64)
    step = _step(len(p))
    for start in range(0, len(x), step):
        part = x[start : start + step]
        found[start : start + step] = names[((p * p).sum(1) - 2 * part @ p.T).argmin(axis=1)]
    return rows.drop(["slice"]).append_column("pivot", pa.array(found))


def block_index(rows: DataFrame) -> DataFrame:
    """Per block: its rows, and its centre, radius and largest norm, which bound what it can be similar to."""
    kind = rows.schema["business"].dataType.simpleString()

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = _matrix(table)
        centre = x.mean(axis=0)
        far = np.sqrt(((x - centre) ** 2).sum(axis=1).max())
        norm = np.sqrt((x * x).sum(axis=1).max())
        columns = [[k.as_py()] for k in key] + [[centre.tolist()], [float(far)], [float(norm)], [len(x)]]
        kinds = [table.schema.field("business").type, pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, ["business", "block", "vector", "radius", "norm", "held"])

    return rows.groupBy("business", "block").applyInArrow(
        run, f"business {kind}, block int, vector array<double>, radius double, norm double, held bigint"
    )


def _tiled(index: DataFrame) -> DataFrame:
    """Adds the tile of each block: blocks in order, about TILE_ROWS rows together."""
    before = Window.partitionBy("business").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.coalesce(F.sum("held").over(before), F.lit(0))
    return index.withColumn("tile", F.floor(rows / TILE_ROWS).cast("int"))


def _bound_cell(at_least: float):
    """Pairs of blocks (a < b) that may hold similarities of ``at_least``, or above what a row of theirs has."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        c, name, tile = _matrix(table), table.column("number").to_numpy(), table.column("tile").to_numpy()
        radius, norm, floor = (table.column(x).to_numpy() for x in ("radius", "norm", "floor"))
        own, against = _sides(key, table)[0]
        found, step, size = [np.zeros((4, 0), np.int32)], _step(len(against)), (c * c).sum(axis=1)
        for start in range(0, len(own), step):
            i, j = own[start : start + step, None], against[None, :]
            dots = c[i[:, 0]] @ c[against].T
            apart = np.sqrt(np.maximum(size[i] + size[j] - 2 * dots, 0)) - radius[i] - radius[j]
            by_distance = (norm[i] ** 2 + norm[j] ** 2 - np.maximum(apart, 0) ** 2) / 2
            by_centre = dots + np.sqrt(size[i]) * radius[j] + np.sqrt(size[j]) * radius[i] + radius[i] * radius[j]
            # sums of products are only as exact as floats are
            bound = np.minimum(by_distance, by_centre) + 1e-6
            needed = (bound >= np.minimum(at_least, np.minimum(floor[i], floor[j]))) & (name[i] != name[j])
            if own is against:
                needed &= name[i] < name[j]
            a, b = np.nonzero(needed)
            a, b = i[a, 0], against[b]
            # tiles follow the order of blocks
            found.append(np.stack([f(x[a], x[b]) for x in (name, tile) for f in (np.minimum, np.maximum)]))
        pairs = np.concatenate(found, axis=1)
        columns = [pa.repeat(key[0], pairs.shape[1]), *[pa.array(x, pa.int32()) for x in pairs]]
        return pa.Table.from_arrays(columns, ["business", "cell_a", "cell_b", "tile_a", "tile_b"])

    return run


#: Blocks of a business whose bounds are compared in one task with as many others.
INDEX_BLOCKS = 1024


def needed_cells(index: DataFrame, at_least: float) -> DataFrame:
    """(business, cell_a, cell_b, tile_a, tile_b), a < b, of the pairs of blocks that bounds can't leave out.

    ``index`` has floor too; without tiles, a block is one of its own.
    """
    if "tile" not in index.columns:
        index = index.withColumn("tile", F.col("block"))
    sizes = index.groupBy("business").agg(F.count("*").alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / INDEX_BLOCKS).cast("int")
    rows = index.withColumnRenamed("block", "number").join(sizes, "business").withColumn("blocks", blocks).drop("_n")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("number"), F.col("blocks").cast("long")).cast("int"))
    kind = index.schema["business"].dataType.simpleString()
    return (
        _all_cells(rows)
        .groupBy("business", "cell_a", "cell_b")
        .applyInArrow(_bound_cell(at_least), f"business {kind}, cell_a int, cell_b int, tile_a int, tile_b int")
    )


def _all_cells(rows: DataFrame) -> DataFrame:
    """Each row once per cell its block could take part in."""
    other = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = other.withColumns(
        {"cell_a": F.least("block", "_other"), "cell_b": F.greatest("block", "_other")}
    ).drop("_other", "blocks")
    # a stated number of partitions: few bytes are much work here, so they must not be coalesced
    return cells.repartition(shuffle_partitions(rows), "business", "cell_a", "cell_b")


def _with_tile(rows: DataFrame, index: DataFrame | None) -> DataFrame:
    """Rows with the tile of their block; a business of one block is not in the index."""
    if index is None:
        return rows.withColumn("tile", F.lit(0))
    return rows.join(index.select("business", "block", "tile"), ["business", "block"], "left").withColumn(
        "tile", F.coalesce("tile", F.lit(0))
    )


def _own_cells(rows: DataFrame) -> DataFrame:
    cells = rows.withColumns({"cell_a": F.col("tile"), "cell_b": F.col("tile")}).drop("blocks")
    return cells.repartition(shuffle_partitions(rows), "business", "cell_a", "cell_b")


def _cross_cells(rows: DataFrame, tiles: DataFrame) -> DataFrame:
    """Each row once per needed cell (business, tile_a, tile_b) of its tile."""
    either = tiles.withColumn("tile", F.explode(F.array_distinct(F.array("tile_a", "tile_b"))))
    either = either.withColumnsRenamed({"tile_a": "cell_a", "tile_b": "cell_b"})
    # a tile has about TILE_ROWS rows, so that no key of this join is heavy on the left
    cells = rows.drop("blocks").join(materialise(either, "cells"), ["business", "tile"])
    return cells.repartition(shuffle_partitions(rows), "business", "cell_a", "cell_b")


def _several_blocks(blocks: DataFrame) -> bool:
    return not blocks.filter("blocks > 1").isEmpty()


def _cells(rows: DataFrame, at_least: float) -> DataFrame:
    """Each row once per cell of tiles that may hold a similarity of ``at_least``; ``tile`` is its own."""
    if not _several_blocks(rows):
        return _own_cells(_with_tile(rows, None))
    index = materialise(_tiled(block_index(rows.filter("blocks > 1"))), "index")
    rows = _with_tile(rows, index)
    needed = needed_cells(index.withColumn("floor", F.lit(np.inf)), at_least)
    tiles = needed.filter("tile_a <> tile_b").select("business", "tile_a", "tile_b").distinct()
    own = _own_cells(rows)
    return own.unionByName(_cross_cells(rows, tiles).select(own.columns))


def _step(against: int) -> int:
    """Rows that are compared with ``against`` others at once."""
    return max(1, AT_ONCE // max(1, against))


def _matrix(table: pa.Table) -> np.ndarray:
    vectors = table.column("vector").combine_chunks()
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(table.num_rows, -1)


def _sides(key: tuple, table: pa.Table, place: str = "block") -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the compared sides: (own, against), both ways for two different places."""
    block = table.column(place).to_numpy()
    a, b = key[1].as_py(), key[2].as_py()
    first = np.flatnonzero(block == a)
    if a == b:
        return [(first, first)]
    second = np.flatnonzero(block == b)
    return [(first, second), (second, first)]


def _block_sides(table: pa.Table, pairs: pa.Table | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of each block and of all blocks it is paired with; without pairs, of each block and itself."""
    block = table.column("block").to_numpy()
    order = np.argsort(block, kind="stable")
    names, first = np.unique(block[order], return_index=True)
    rows = np.split(order, first[1:])
    if pairs is None:
        yield from ((x, x) for x in rows)
        return
    a, b = (np.searchsorted(names, pairs.column(c).to_numpy()) for c in ("cell_a", "cell_b"))
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    for k in np.unique(own):
        yield rows[k], np.concatenate([rows[i] for i in other[own == k]])


#: Columns whose greatest is taken first when the nearest are looked for.
GROUP = 32


def _heavier(sims: np.ndarray, w: np.ndarray, over: float, at_least: list[float]) -> list[np.ndarray]:
    """Per row, the weight of what is above ``over`` and of what is at each of ``at_least`` or above."""
    levels = [lambda x: x > over, *[lambda x, t=t: x >= t for t in at_least]]
    some = np.flatnonzero(sims.ravel() >= min([over, *at_least]))
    if len(some) > sims.size // 16:
        return [level(sims) @ w for level in levels]
    row, place = np.divmod(some, sims.shape[1])
    found, weight = sims.ravel()[some], w[place]
    # sums of whole numbers below 2^53 are exact
    return [np.bincount(row, weight * level(found), len(sims)).astype(np.int64) for level in levels]


def _nearest(sims: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest of each row, in any order.

    The k-th greatest of the maxima of groups of columns is not above the k-th greatest of all, so only what
    reaches it is sorted.
    """
    rows, columns = sims.shape
    groups = columns // GROUP
    if groups > 2 * k:
        most = sims[:, : groups * GROUP].reshape(rows, groups, GROUP).max(axis=2)
        least = np.partition(most, groups - k, axis=1)[:, groups - k]
        some = np.flatnonzero(sims >= least[:, None])
        # with many ties or undefined numbers all are sorted
        if len(some) <= sims.size // 16 and not np.isnan(most).any():
            row, place = np.divmod(some, columns)
            order = np.lexsort((-sims.ravel()[some], row))
            begin = np.searchsorted(row, np.arange(rows))
            return place[order[begin[:, None] + np.arange(k)]]
    return np.argpartition(-sims, k - 1, axis=1)[:, :k]


def _neighbour_cell(topk: int, over: float, at_least: list[float]):
    def run(table: pa.Table, pairs: pa.Table | None = None) -> pa.Table:
        x, w = _matrix(table), table.column("w").to_numpy()
        parts = []
        for own, against in _block_sides(table, pairs):
            same = own is against
            k = min(topk, len(against))
            y, wy, step = x[against], w[against], _step(len(against))
            for start in range(0, len(own), step):
                if k == 0:
                    break
                rows = own[start : start + step]
                sims = x[rows] @ y.T
                counts = _heavier(sims, wy, over, at_least)
                place = np.arange(len(rows))
                if same:
                    # a row's own entry stands for its other copies
                    mine = sims[place, start + place]
                    counts = [counts[0] - (mine > over)] + [
                        c - (mine >= t) for c, t in zip(counts[1:], at_least)
                    ]
                    sims[place, start + place] = np.where(wy[start + place] > 1, mine, -np.inf)
                near = _nearest(sims, k)
                weight = wy[near]
                if same:
                    weight = weight - (near == (start + place)[:, None])
                parts.append((rows, np.take_along_axis(sims, near, 1), weight, counts, k))
        return _neighbour_table(table, parts, len(at_least))

    return run


def _neighbour_table(table: pa.Table, parts: list, levels: int) -> pa.Table:
    frames = []
    for rows, sims, weight, counts, k in parts:
        picked = table.select(["business", "rep", "block", "w", "n"]).take(pa.array(rows))
        offsets = pa.array(np.arange(0, len(rows) * k + 1, k, dtype=np.int32))
        columns = {
            "business": picked.column("business"),
            "rep": picked.column("rep"),
            "block": picked.column("block"),
            "w": picked.column("w"),
            "n": picked.column("n"),
            "top_sim": pa.ListArray.from_arrays(offsets, pa.array(sims.ravel())),
            "top_w": pa.ListArray.from_arrays(offsets, pa.array(weight.ravel().astype(np.int64))),
            "over": pa.array(counts[0].astype(np.int64)),
        }
        for i in range(levels):
            columns[f"near_{i}"] = pa.array(counts[i + 1].astype(np.int64))
        frames.append(pa.table(columns))
    return pa.concat_tables(frames)


def neighbours(blocks: DataFrame, topk: int, over: float, at_least: list[float]) -> DataFrame:
    """Per distinct vector and cell of tiles: its nearest others with weights, and how many reviews are more
    similar than ``over`` and at least as similar as each of ``at_least``."""
    kind = blocks.schema["business"].dataType.simpleString()
    rep = blocks.schema["rep"].dataType.simpleString()
    levels = "".join(f", near_{i} bigint" for i in range(len(at_least)))
    schema = (
        f"business {kind}, rep {rep}, block int, w bigint, n bigint, top_sim array<double>, top_w array<bigint>,"
        f" over bigint{levels}"
    )
    rows = blocks.select("business", "rep", "w", "n", "vector", "block", "blocks")

    several, index = _several_blocks(rows), None
    if several:
        index = materialise(_tiled(block_index(rows.filter("blocks > 1"))), "index")
    rows = _with_tile(rows, index)
    compare, cell = _neighbour_cell(topk, over, at_least), ["business", "cell_a", "cell_b"]
    inside = materialise(_own_cells(rows).groupBy(*cell).applyInArrow(lambda table: compare(table), schema), "neighbours")
    if not several:
        return inside
    # what each block's worst-off row has found at home; copies count once here, which can only lower it
    best = F.sort_array(F.filter(F.arrays_zip("top_sim", "top_w"), lambda x: x.top_w > 0).top_sim, asc=False)
    kth = F.coalesce(F.get(best, F.lit(topk - 1)), F.lit(-np.inf))
    floors = inside.withColumn("kth", kth).groupBy("business", "block").agg(F.min("kth").alias("floor"))
    needed = needed_cells(index.join(floors, ["business", "block"]), min([over, *at_least]))
    pairs = materialise(needed, "pairs")
    met = _cross_cells(rows.filter("blocks > 1"), pairs.select("business", "tile_a", "tile_b").distinct())
    told = pairs.select("business", F.col("tile_a").alias("_a"), F.col("tile_b").alias("_b"), "cell_a", "cell_b")
    told = told.repartition(shuffle_partitions(rows), "business", "_a", "_b")
    across = met.groupBy(*cell).cogroup(told.groupBy("business", "_a", "_b")).applyInArrow(lambda a, b: compare(a, b), schema)
    return inside.unionByName(materialise(across, "neighbours"))


def top_sums(near: DataFrame, topk: int) -> DataFrame:
    """Per distinct vector: the summed similarity of its k nearest reviews, k = min(topk, n - 1)."""
    entries = near.select("business", "rep", "w", "n", F.inline(F.arrays_zip("top_sim", "top_w"))).filter(
        "top_w > 0"
    )
    by_sim = Window.partitionBy("business", "rep").orderBy(F.desc("top_sim"))
    best = entries.withColumn("_r", F.row_number().over(by_sim)).filter(F.col("_r") <= topk)
    before = F.coalesce(
        F.sum("top_w").over(by_sim.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    k = F.least(F.lit(topk), F.col("n") - 1)
    best = best.withColumn("_take", F.greatest(F.lit(0), F.least(F.col("top_w"), k - before)))
    return best.groupBy("business", "rep", "w", "n").agg(F.sum(F.col("top_sim") * F.col("_take")).alias("top"))


def mean_topk(near: DataFrame, topk: int) -> DataFrame:
    """Per business, the mean similarity of every review's k nearest; 0 for a single review."""
    k = F.least(F.lit(topk), F.col("n") - 1)
    return (
        top_sums(near, topk)
        .groupBy("business", "n")
        .agg(F.sum(F.col("top") * F.col("w")).alias("t"))
        .select("business", F.coalesce(F.try_divide("t", k * F.col("n")), F.lit(0.0)).alias("mean_topk"))
    )


def dup_rate(near: DataFrame) -> DataFrame:
    """Share of ordered pairs more similar than the duplicate threshold, per business."""
    return (
        near.groupBy("business", "n")
        .agg(F.sum(F.col("over") * F.col("w")).alias("hits"))
        .select(
            "business",
            F.col("n").alias("n_reviews"),
            (F.col("hits") / F.greatest(F.lit(1), F.col("n") * (F.col("n") - 1))).alias("dup_rate"),
        )
    )


# ---- density clusters -------------------------------------------------------------------------


class _Forest:
    """Components of a two-sided graph whose edges are told one left node at a time, and their least names."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.split = len(left)
        self.low = np.concatenate([left, right]).tolist()
        self.up = list(range(len(self.low)))
        #: a node of each right node's component, the latest that is known
        self.seen = np.arange(self.split, len(self.low))

    def top(self, node: int) -> int:
        while self.up[node] != node:
            self.up[node] = node = self.up[self.up[node]]
        return node

    def tie(self, left: int, right: np.ndarray) -> None:
        seen = self.seen[right]
        some = seen[:1] if (seen == seen[0]).all() else np.unique(seen)
        tops = {self.top(left), *(self.top(x) for x in some.tolist())}
        head = min(tops, key=self.low.__getitem__)
        for x in tops:
            self.up[x] = head
        self.seen[right] = head

    def roots(self) -> tuple[np.ndarray, np.ndarray]:
        names = np.array([self.low[self.top(x)] for x in range(len(self.up))], np.int64)
        return names[: self.split], names[self.split :]


def _cluster_cell(thresholds: list[float]):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x, rep = _matrix(table), table.column("rep").to_numpy()
        own, against = _sides(key, table, "tile")[0]
        inner = own is against
        names, y, step = (rep[own], rep[against]), x[against], _step(len(against))
        found = []
        for level, threshold in enumerate(thresholds):
            core = table.column(f"core_{level}").to_numpy(zero_copy_only=False)
            a, b = core[own], core[against]
            forest, bits = _Forest(*names), []
            # outside its own block's cell a core without core neighbours says nothing new
            met = (np.zeros(len(own), bool), np.zeros(len(against), bool))
            for start in range(0, len(own), step):
                close = x[own[start : start + step]] @ y.T >= threshold
                if inner:
                    place = np.arange(len(close))
                    close[place, start + place] = True
                bits.append(np.packbits(close, axis=1))
                for i in np.flatnonzero(a[start : start + step]):
                    next_to = np.flatnonzero(close[i] & b)
                    if len(next_to):
                        forest.tie(start + i, next_to)
                        met[0][start + i] = True
                        met[1][next_to] = True
            roots = forest.roots()
            for side, told in enumerate(met[:1] if inner else met):
                found.append((names[side][told], roots[side][told], True, level))
            for k, packed in enumerate(bits):
                part = slice(k * step, k * step + len(packed))
                close = np.unpackbits(packed, axis=1, count=len(against)).view(bool)
                sides = [(close, part, ~a[part], slice(None), b, 0)]
                if not inner:
                    sides.append((close.T, slice(None), ~b, part, a[part], 1))
                for near, mine, border, others, cores, side in sides:
                    at, to = np.nonzero(near[np.ix_(border, cores)])
                    name, code = np.unique(roots[1 - side][others][cores], return_inverse=True)
                    told = np.unique(at * max(1, len(name)) + code[to])
                    at, to = np.divmod(told, max(1, len(name)))
                    found.append((names[side][mine][border][at], name[to], False, level))
        size = [len(f[0]) for f in found]
        return pa.table(
            {
                "business": pa.repeat(table.column("business")[0], sum(size)),
                "rep": pa.array(np.concatenate([f[0] for f in found])),
                "root": pa.array(np.concatenate([f[1] for f in found])),
                "core": pa.array(np.repeat([f[2] for f in found], size)),
                "level": pa.array(np.repeat(np.array([f[3] for f in found], dtype=np.int32), size)),
            }
        )

    return run


def density_clusters(
    blocks: DataFrame, near: DataFrame, thresholds: list[float], min_samples: int
) -> DataFrame:
    """(business, level, rep, cluster) of clustered distinct vectors, one level per threshold.

    A review with ``min_samples`` reviews (itself included) at or above the threshold is core; a
    cluster is a connected set of cores plus the reviews next to them, a review next to several
    clusters going to the one with the lowest core. The cluster is named after its lowest core.
    ``near`` must have been made with the same thresholds, in this order.
    """
    levels = range(len(thresholds))
    degrees = near.groupBy("business", "rep").agg(*[F.sum(f"near_{i}").alias(f"near_{i}") for i in levels])
    flags = degrees.select(
        "business",
        "rep",
        *[(F.col(f"near_{i}") + 1 >= min_samples).alias(f"core_{i}") for i in levels],
        F.greatest(*[F.col(f"near_{i}") for i in levels], F.lit(0)).alias("_most"),
    )
    touched = flags.filter(
        (F.col("_most") > 0) | F.greatest(*[F.col(f"core_{i}").cast("int") for i in levels], F.lit(0)).cast("boolean")
    )
    rows = blocks.select("business", "rep", "vector", "block", "blocks").join(
        touched.drop("_most"), ["business", "rep"]
    )
    kind = blocks.schema["business"].dataType.simpleString()
    links = materialise(
        _cells(rows, min(thresholds, default=np.inf))
        .groupBy("business", "cell_a", "cell_b")
        .applyInArrow(
            _cluster_cell(list(thresholds)),
            f"business {kind}, rep bigint, root bigint, core boolean, level int",
        ),
        "links",
    )
    keys = ["business", "level", "rep"]
    cores = links.filter("core").groupBy(*keys).agg(F.min("root").alias("root"))
    borders = links.filter("NOT core").select(*keys, "root")
    if blocks.filter("blocks > 1").isEmpty():
        # one cell per business: its roots are final
        named = cores.unionByName(borders).withColumnRenamed("root", "cluster")
    else:
        named = _across_cells(links, cores, borders, len(thresholds))
    return named.groupBy(*keys).agg(F.min("cluster").alias("cluster"))


def _across_cells(links: DataFrame, cores: DataFrame, borders: DataFrame, levels: int) -> DataFrame:
    """Clusters of businesses of several blocks: a core met in several cells ties their roots together."""
    per_core = Window.partitionBy("level", "rep")
    tied = (
        links.filter("core")
        .select("level", F.col("root").alias("u"), F.min("root").over(per_core).alias("v"))
        .filter("u != v")
        .distinct()
    )
    # levels share vertex names, so (name, level) packs into one number
    packed = tied.select(*[(F.col(c).cast("long") * levels + F.col("level")).alias(c) for c in ("u", "v")])
    merged = connected_components(packed).select(
        F.expr(f"(vertex - pmod(vertex, {levels})) div {levels}").alias("root"),
        F.expr(f"int(pmod(vertex, {levels}))").alias("level"),
        F.expr(f"(component - pmod(component, {levels})) div {levels}").alias("_to"),
    )
    held = cores.groupBy("level", "root").agg(F.count("*").alias("_held"))
    named = (
        join_heavy(cores, held.join(merged, ["level", "root"], "left"), ["level", "root"], "_held", "rep")
        .withColumn("cluster", F.coalesce("_to", "root"))
        .drop("_to", "root")
    )
    named = materialise(named, "cores")
    # a border review follows the cores it is next to; its root is itself a core
    next_to = borders.groupBy("level", "root").agg(F.count("*").alias("_held"))
    target = next_to.join(named.select("level", F.col("rep").alias("root"), "cluster"), ["level", "root"])
    followed = join_heavy(borders, target, ["level", "root"], "_held", "rep").drop("root")
    return named.unionByName(followed)


def clustered_reviews(
    vec: DataFrame, blocks: DataFrame, near: DataFrame, clusters: DataFrame, level: int, threshold: float, min_samples: int
) -> DataFrame:
    """(business, seq, cluster) of every clustered review at one level of ``clusters``: copies follow their vector.

    Copies of a vector too short to be similar to itself are not next to each other: without another core beside
    them, each is a cluster of its own. A seq that comes twice with one vector is one row.
    """
    placed = clusters.filter(F.col("level") == level).select("business", "rep", "cluster")
    copied = blocks.filter("w > 1").select("business", "vector", "rep", "w", (dot("vector", "vector") < threshold).alias("_apart"))
    met = placed.join(copied, ["business", "rep"])
    # a cluster is named after its lowest core, so only these can be lone ones
    alone = met.filter("_apart AND cluster = rep").select("business", "cluster")
    degrees = near.groupBy("business", "rep").agg(F.sum(f"near_{level}").alias("_near"))
    cores = degrees.filter(F.col("_near") + 1 >= min_samples).select("business", "rep")
    held = placed.join(alone, ["business", "cluster"], "left_semi").join(cores, ["business", "rep"])
    lone = held.groupBy("business", "cluster").agg((F.count("*") == 1).alias("_lone"))
    met = met.join(lone, ["business", "cluster"], "left")
    own = F.col("_apart") & (F.col("cluster") == F.col("rep")) & F.coalesce("_lone", F.lit(False))
    met = met.select("business", "vector", "rep", "cluster", own.alias("_own"), "w")
    copies = join_heavy(vec.select("business", F.col("seq").cast("long").alias("seq"), "vector"), met, ["business", "vector"], "w", "seq")
    cluster = F.when(F.col("_own"), F.col("seq")).otherwise(F.col("cluster")).alias("cluster")
    others = copies.filter("seq != rep").select("business", "seq", cluster).distinct()
    return placed.withColumnRenamed("rep", "seq").unionByName(others)


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def cluster_members(blocks: DataFrame, clusters: DataFrame) -> DataFrame:
    return clusters.join(blocks.select("business", "rep", "w", "vector"), ["business", "rep"])


def cluster_sums(members: DataFrame) -> DataFrame:
    """Size, vector sum and mean pairwise similarity per cluster, in one aggregation."""
    vector = array_to_vector(F.col("vector").cast("array<double>"))
    grouped = members.groupBy("business", "level", "cluster").agg(
        F.sum("w").alias("size"),
        F.count("*").alias("distinct_rows"),
        Summarizer.sum(vector, F.col("w").cast("double")).alias("_s"),
        F.sum(F.col("w") * dot("vector", "vector")).alias("_q"),
    )
    n = F.col("size")
    return grouped.withColumn("total", vector_to_array("_s")).select(
        "business",
        "level",
        "cluster",
        "size",
        "distinct_rows",
        "total",
        F.try_divide(dot("total", "total") - F.col("_q"), n * (n - 1)).alias("mean_sim"),
    )


def largest_clusters(sums: DataFrame) -> DataFrame:
    """Per business and level, size and mean similarity of the largest cluster; the more similar of
    equals. Clusters of one review do not count."""
    top = F.max(F.struct("size", "mean_sim")).alias("t")
    return (
        sums.filter("size > 1")
        .groupBy("business", "level")
        .agg(top)
        .select("business", "level", F.col("t.size").alias("size"), F.col("t.mean_sim").alias("mean_sim"))
    )


# ---- business scan ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Scan:
    """The frames a scan is made of; each can be used on its own."""

    blocks: DataFrame
    near: DataFrame
    clusters: DataFrame


def scan_frames(vec: DataFrame, cfg: ScanConfig = ScanConfig()) -> Scan:
    thresholds = [cfg.sim_threshold, cfg.high_sim_threshold]
    blocks = block_vectors(vec, cfg.block_rows, cfg.min_reviews)
    near = neighbours(blocks, cfg.topk, cfg.dup_threshold, thresholds)
    return Scan(blocks, near, density_clusters(blocks, near, thresholds, cfg.min_cluster_size))


def scan_businesses(vec: DataFrame, cfg: ScanConfig = ScanConfig()) -> DataFrame:
    """Score row per business with at least ``min_reviews`` reviews."""
    scan = scan_frames(vec, cfg)
    largest = largest_clusters(cluster_sums(cluster_members(scan.blocks, scan.clusters)))

    def level(i: int, name: str) -> DataFrame:
        return largest.filter(F.col("level") == i).select(
            "business", F.col("size").alias(f"max_{name}_size"), F.col("mean_sim").alias(f"max_{name}_mean")
        )

    joined = (
        dup_rate(scan.near)
        .join(mean_topk(scan.near, cfg.topk), "business", "left")
        .join(level(0, "cluster"), "business", "left")
        .join(level(1, "high_cluster"), "business", "left")
    )
    return flag_businesses(joined, cfg)


def flag_businesses(scores: DataFrame, cfg: ScanConfig = ScanConfig()) -> DataFrame:
    """Adds ``suspicious`` and ``reason``: overall cohesion first, then a tight subcluster."""
    filled = scores.select(
        "business",
        "n_reviews",
        F.coalesce("mean_topk", F.lit(0.0)).alias("mean_topk"),
        "dup_rate",
        F.coalesce("max_cluster_size", F.lit(0)).alias("max_cluster_size"),
        F.coalesce("max_cluster_mean", F.lit(0.0)).alias("max_cluster_mean"),
        F.coalesce("max_high_cluster_size", F.lit(0)).alias("max_high_cluster_size"),
        F.coalesce("max_high_cluster_mean", F.lit(0.0)).alias("max_high_cluster_mean"),
    )
    reason = (
        F.when(F.col("mean_topk") >= cfg.overall_threshold, "overall")
        .when(
            (F.col("max_high_cluster_size") >= cfg.min_cluster_size)
            & (F.col("max_high_cluster_mean") >= cfg.high_sim_threshold),
            "subcluster",
        )
        .otherwise("")
    )
    return filled.withColumn("reason", reason).withColumn("suspicious", F.col("reason") != "")


def suspicious_businesses(scores: DataFrame) -> DataFrame:
    return scores.filter("suspicious").drop("mean_topk", "dup_rate", "suspicious")


# ---- review scores ----------------------------------------------------------------------------


def cohesion(vec: DataFrame, cfg: FuseConfig = FuseConfig()) -> DataFrame:
    """mean_topk and dup_rate per business, of any size."""
    near = neighbours(block_vectors(vec, cfg.block_rows), cfg.topk, cfg.dup_threshold, [])
    return _cohesion(near, cfg.topk)


def _cohesion(near: DataFrame, topk: int) -> DataFrame:
    return (
        dup_rate(near)
        .join(mean_topk(near, topk), "business", "left")
        .select("business", "n_reviews", F.coalesce("mean_topk", F.lit(0.0)).alias("mean_topk"), "dup_rate")
    )


def peer_scores(members: DataFrame) -> DataFrame:
    """Per clustered vector, its mean similarity to the other reviews of its cluster, within 0..1."""
    sums = cluster_sums(members).select("business", "level", "cluster", "size", "total", "distinct_rows")
    joined = join_heavy(members, sums, ["business", "level", "cluster"], "distinct_rows", "rep")
    mean = F.try_divide(dot("vector", "total") - dot("vector", "vector"), F.col("size") - 1)
    return joined.select(
        "business",
        "rep",
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(mean, F.lit(0.0)))).alias("peer_score"),
    )


def review_scores(vec: DataFrame, cfg: FuseConfig = FuseConfig()) -> DataFrame:
    """(business, seq, peer_score, fraud_score) per review; reviews without a cluster, business or vector score 0.

    ``fraud_score`` scales the peer score by the cohesion of the business, within 0..1.
    """
    blocks = block_vectors(vec, cfg.block_rows)
    near = neighbours(blocks, cfg.topk, cfg.dup_threshold, [cfg.sim_threshold])
    clusters = density_clusters(blocks, near, [cfg.sim_threshold], cfg.min_samples)
    peers = peer_scores(cluster_members(blocks, clusters))
    own = top_cohesion(near, cfg.topk)
    scored = (
        blocks.select("business", "vector", "rep", "w")
        .join(peers, ["business", "rep"], "left")
        .withColumn("peer_score", F.coalesce("peer_score", F.lit(0.0)))
    )
    scored = join_heavy(scored, own, ["business"], "distinct_rows", "rep", "left").withColumn(
        "fraud_score",
        F.greatest(
            F.lit(0.0),
            F.least(F.lit(1.0), F.col("peer_score") * F.coalesce("mean_topk", F.lit(0.0))),
        ),
    )
    # copies share their representative's scores; a text copied very often is cut into pieces
    found = join_heavy(
        vec.select("business", "seq", "vector"),
        scored.select("business", "vector", "w", "peer_score", "fraud_score"),
        ["business", "vector"],
        "w",
        "seq",
        "left",
    )
    scores = {c: F.coalesce(c, F.lit(0.0)) for c in ("peer_score", "fraud_score")}
    return found.withColumns(scores).drop("vector")


def top_cohesion(near: DataFrame, topk: int) -> DataFrame:
    held = near.select("business", "rep").distinct().groupBy("business").agg(F.count("*").alias("distinct_rows"))
    return held.join(mean_topk(near, topk), "business", "left")


def fuse(
    text: DataFrame, scores: DataFrame, key: str = "seq", w_text: float = 0.7, w_fraud: float = 0.3
) -> DataFrame:
    """Weighted mean of text probability ``p_text`` and ``fraud_score`` (0 where there is none), within 0..1."""
    total = w_text + w_fraud if w_text + w_fraud > 0 else 1.0
    mean = (F.col("p_text") * w_text + F.col("fraud_score") * w_fraud) / total
    met = text.join(scores.select(key, "fraud_score"), key, "left")
    return met.withColumn("fraud_score", F.coalesce("fraud_score", F.lit(0.0))).withColumn(
        "fused", F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean))
    )


def fuse_unmatched(text: DataFrame, scores: DataFrame, key: str = "seq") -> DataFrame:
    """Keys that only one side has, which must be none."""
    left = text.select(key, F.lit(1).alias("a"), F.lit(0).alias("b"))
    right = scores.select(key, F.lit(0).alias("a"), F.lit(1).alias("b"))
    per_key = left.unionByName(right).groupBy(key).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return per_key.agg(
        F.count_if(F.col("b") == 0).alias("only_text"), F.count_if(F.col("a") == 0).alias("only_scores")
    )


def _pair_cell(threshold: float):
    """The pairs of a cell, a chunk of its rows at a time."""

    def run(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        x, rep, w = _matrix(table), table.column("rep").to_numpy(), table.column("w").to_numpy()
        own, against = _sides(key, table, "tile")[0]
        for start in range(0, len(own), PAIR_ROWS):
            rows = own[start : start + PAIR_ROWS]
            sims = x[rows] @ x[against].T
            i, j = np.nonzero(sims >= threshold)
            keep = rep[rows][i] < rep[against][j] if own is against else rep[rows][i] != rep[against][j]
            a, b, near = rows[i[keep]], against[j[keep]], sims[i[keep], j[keep]]
            low, high = np.where(rep[a] < rep[b], a, b), np.where(rep[a] < rep[b], b, a)
            columns = {
                "business": pa.array([key[0].as_py()] * len(a), table.schema.field("business").type),
                "seq_a": pa.array(rep[low]),
                "seq_b": pa.array(rep[high]),
                "copies_a": pa.array(w[low]),
                "copies_b": pa.array(w[high]),
                "sim": pa.array(near),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def similar_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs of distinct texts of a business at or above the threshold, with their copy counts.

    The output grows with the pairs, so no flow uses it; a task holds the pairs of PAIR_ROWS rows at a time.
    """
    kind = blocks.schema["business"].dataType.simpleString()
    cells = _cells(blocks.select("business", "rep", "w", "vector", "block", "blocks"), threshold)
    return cells.groupBy("business", "cell_a", "cell_b").applyInArrow(
        _pair_cell(threshold),
        f"business {kind}, seq_a bigint, seq_b bigint, copies_a bigint, copies_b bigint, sim double",
    )
