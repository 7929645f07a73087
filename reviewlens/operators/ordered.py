"""Running totals, positions and exact quantiles over an order, without a single-task window.

Rows are range-partitioned on the order, so a partition is a bounded slice of it whatever the key
distribution. The slice is materialised once, since both the slice totals and the rows must see the
same boundaries; each row then needs its in-slice running sum plus the total of the slices before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.sources.scratch import materialise

SLICE = "_slice"


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def over_all_cores(df: DataFrame, key: str) -> DataFrame:
    """A small table read by fewer tasks than there are cores, spread over them by key for the
    computing that follows. Tables of a real size have more scan tasks than cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the key columns come from the left."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def with_running_sums(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], slices: int | None = None
) -> DataFrame:
    """Adds, per target name, the running sum of a column in (keys, order), ties broken by nothing.

    Callers pass one row per (keys, order).
    """
    n = slices or shuffle_partitions(df)
    sliced = df.repartitionByRange(n, *keys, *order).withColumn(SLICE, F.spark_partition_id())
    sliced = materialise(sliced)
    before = Window.partitionBy(*keys, F.lit(0)).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per slice and key change
    offsets = (
        sliced.groupBy(*keys, SLICE)
        .agg(*[F.sum(c).alias(f"_t_{t}") for t, c in sums.items()])
        .select(
            *keys,
            SLICE,
            *[F.coalesce(F.sum(f"_t_{t}").over(before), F.lit(0)).alias(f"_o_{t}") for t in sums],
        )
    )
    inside = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = sliced.withColumns({f"_s_{t}": F.sum(c).over(inside) for t, c in sums.items()})
    out = null_safe(out, offsets, [*keys, SLICE])
    out = out.withColumns({t: F.col(f"_s_{t}") + F.col(f"_o_{t}") for t in sums})
    return out.drop(SLICE, *[f"_s_{t}" for t in sums], *[f"_o_{t}" for t in sums])


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles per key, one output column per name in ``probs``.

    Equal values are counted together first, so a value held by many rows is one row here. The values are
    written once in slices of their order; totals per slice tell in which of them a wanted position falls, and
    only those are ranked.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    sliced = counted.repartitionByRange(shuffle_partitions(df), *keys, value)
    sliced = materialise(sliced.withColumn(SLICE, F.spark_partition_id()), "slices")
    # at most one row per slice and key change
    of_key = Window.partitionBy(*keys, F.lit(0))
    upto = of_key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = sliced.groupBy(*keys, SLICE).agg(F.sum("_n").alias("_t")).withColumns(
        {"_upto": F.sum("_t").over(upto), "_total": F.sum("_t").over(of_key)}
    )
    wanted = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            entry = (F.lit(f"_{name}_{side}"), pos.cast("long"), at - F.floor(at))
            wanted.append(F.struct(*[c.alias(n) for c, n in zip(entry, ("pick", "pos", "w"), strict=True)]))
    before = F.col("_upto") - F.col("_t")
    places = totals.withColumn("_x", F.explode(F.array(*wanted))).filter(
        (F.col("_x.pos") >= before) & (F.col("_x.pos") < F.col("_upto"))
    )
    places = materialise(places.select(*keys, SLICE, (F.col("_x.pos") - before).alias("_pos"), "_x.pick", "_x.w"), "places")
    inside = Window.partitionBy(*keys, SLICE).orderBy(value)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = null_safe(sliced, places.select(*keys, SLICE).distinct(), [*keys, SLICE], "left_semi")
    ranked = held.withColumn("_last", F.sum("_n").over(inside))
    # the value covering 0-based position p is the one with last - n <= p < last
    met = null_safe(ranked, places, [*keys, SLICE]).filter(
        (F.col("_pos") < F.col("_last")) & (F.col("_pos") >= F.col("_last") - F.col("_n"))
    )
    picks = [
        F.max(F.when(F.col("pick") == f"_{n}_{side}", source)).alias(f"_{n}_{end}")
        for n in probs
        for side, end, source in (
            ("lo", "lo", F.col(value).cast("double")),
            ("hi", "hi", F.col(value).cast("double")),
            ("lo", "w", F.col("w")),
        )
    ]
    wide = met.groupBy(*keys).agg(*picks)
    return wide.select(
        *keys,
        *[
            (
                F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_w")
            ).alias(n)
            for n in probs
        ],
    )


def with_dense_ids(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Consecutive ids along a unique order."""
    numbered = with_running_sums(df.withColumn("_one", F.lit(1).cast("long")), [], order, {name: "_one"})
    return numbered.withColumn(name, F.col(name) + (start - 1)).drop("_one")


def join_heavy(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    weight: str,
    spread: str,
    how: str = "inner",
    share: int = 2000,
    floor: int = 1_000_000,
) -> DataFrame:
    """Equi-join where a few keys may hold most of ``left``.

    ``right`` has one row per key and says in ``weight`` how many left rows its key has. A piece is
    1/share of all left rows, at least ``floor``. A key with more than that is cut: its left rows pick
    a piece by the hash of ``spread``, its right row is repeated once per piece. At most ``share`` keys
    can be that heavy, and together they have at most 2 * ``share`` pieces; this bounds the broadcast
    of the piece counts and the repetition. With no such key this is a plain join.
    ``weight`` is dropped. ``how`` is inner or left; null keys do not match.
    """
    right = materialise(right, "right")
    total, most = right.agg(F.sum(weight), F.max(weight)).first()
    piece_rows = max((total or 0) / share, floor)
    if (most or 0) <= piece_rows:
        return left.join(right.drop(weight), keys, how)
    cut = right.withColumn("_pieces", F.ceil(F.col(weight) / piece_rows).cast("int"))
    heavy = cut.filter("_pieces > 1").select(*keys, "_pieces")
    piece = F.pmod(F.xxhash64(spread), F.col("_pieces").cast("long")).cast("int")
    salted = left.join(F.broadcast(heavy), keys, "left").withColumn(
        "_piece", F.coalesce(piece, F.lit(0))
    )
    last = F.greatest(F.col("_pieces"), F.lit(1)) - 1
    repeated = cut.withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
    return (
        salted.drop("_pieces")
        .join(repeated.drop("_pieces", weight), [*keys, "_piece"], how)
        .drop("_piece")
    )


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
