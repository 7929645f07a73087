"""Divergence of sources by single-pass in-memory indexing.

Per language, each source's term distribution is compared with every other source's and with the whole language's.

1. A task reads its rows once and builds block postings (language, term, source -> occurrences, rows) in memory. When
   the block is full and merging equal entries no longer makes room, it is spilled: sorted by term, one run for each
   language and hash shard.
2. A shard's runs meet in one task and are merged through a heap into frequencies, term by term. A term in too few rows
   of its language is left out there. Frequent words and large sources are one entry per block at most.
3. Smoothed shares are whole numbers. Were all counts 0, the distance of two sources would be the number of terms times
   the distance of their smallest shares. What the terms of one source change in that depends on the other's smallest
   share alone and is read off running sums over the source's distinct shares; only terms that both sources have need a
   correction by pair, which is streamed term by term into bounded sums.

All arithmetic is on integers. Shares are computed by long division in base 1,000, so that nothing overflows below
9 * 10^15 counted terms per language.

Defined results: null language, source or text reads as ''; a group without kept terms has the smallest share
everywhere; a language with one source has no pairs; repeated rows count as often as they stand; an empty table gives
no rows; columns other than the three are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.arrays import LOWER, buffers, hashes, mix, pieces, spans
from reviewlens.sources.scratch import materialise

SCALE = 1_000_000_000
#: Added to every count.
SMOOTH = 5
#: Text taken at once, and what the postings of a block may hold, in bytes.
PIECE, BLOCK = 2 << 20, 24 << 20
#: Sums of pairs that a task holds before it sends them on.
PAIRS = 1 << 20
#: Sources of a language that one task pairs with all others.
SIDE = 2048

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True

RUNS = (
    "lang string, shard int, terms array<string>, docs array<long>, widths array<int>, sources array<string>, counts array<long>"
)
RUN_COLUMNS = ["lang", "shard", "terms", "docs", "widths", "sources", "counts"]
KEPT = "lang string, term string, source string, count long, total long, lead boolean"


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, and the sums of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]]


class Block:
    """Postings in memory: parts of (terms, group ids, occurrences, rows), merged when they fill the block."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def size(self) -> int:
        return sum(names.nbytes + 32 * len(code) for names, code, *_ in self.parts)

    def add(self, piece: pa.RecordBatch) -> None:
        data, offsets = buffers(piece.column("text"))
        low = LOWER[data]
        member = LETTER[low]
        begin, end, per_row = spans(member, offsets)
        if not len(begin):
            return
        at = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(low[member]))
        encoded = words.dictionary_encode()
        names, code = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        pairs = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), strict=True)
        group = np.array([self.groups.setdefault(pair, len(self.groups)) for pair in pairs], dtype=np.int64)
        row = np.repeat(np.arange(len(group)), per_row)
        seen, times = np.unique(row * len(names) + code, return_counts=True)
        row, code = seen // len(names), seen % len(names)
        key, count, docs = _summed(group[row] * len(names) + code, times, np.ones_like(times))
        self.parts.append((names, key % len(names), key // len(names), count, docs))

    def merge(self) -> None:
        encoded = pa.concat_arrays([part[0] for part in self.parts]).dictionary_encode()
        names, to = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        start = np.cumsum([0, *[len(part[0]) for part in self.parts]])
        code = np.concatenate([to[part[1] + s] for part, s in zip(self.parts, start[:-1], strict=True)])
        group, count, docs = (np.concatenate([part[i] for part in self.parts]) for i in (2, 3, 4))
        key, count, docs = _summed(group * len(names) + code, count, docs)
        self.parts = [(names, key % len(names), key // len(names), count, docs)]

    def runs(self, shards: int) -> Iterator[pa.RecordBatch]:
        """The postings sorted by language, shard, term and source, a row for each language and shard."""
        if not self.parts:
            return
        self.merge()
        names, code, group, count, docs = self.parts[0]
        keys = list(self.groups)
        langs, sources = (pa.array([k[i] for k in keys], pa.string()) for i in (0, 1))
        lang_of = np.unique([k[0] for k in keys], return_inverse=True)[1]
        source_of = np.unique([k[1] for k in keys], return_inverse=True)[1]
        rank = np.empty(len(names), np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        raw, at = buffers(names)
        lang_raw, lang_at = buffers(langs)
        mixed = mix(hashes(raw, at[:-1], at[1:])[code] ^ hashes(lang_raw, lang_at[:-1], lang_at[1:])[group])
        shard = (mixed % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((source_of[group], rank[code], shard, lang_of[group]))
        code, group, count, docs, shard = (x[order] for x in (code, group, count, docs, shard))
        run = lang_of[group] * shards + shard
        fresh = np.concatenate([[True], run[1:] != run[:-1]])
        first, term = np.flatnonzero(fresh), np.flatnonzero(fresh | np.concatenate([[True], code[1:] != code[:-1]]))
        by_entry = pa.array(np.append(first, len(run)), pa.int32())
        by_term = pa.array(np.append(np.searchsorted(term, first), len(term)), pa.int32())
        widths = pa.array(np.diff(np.append(term, len(run))), pa.int32())
        columns = [
            langs.take(pa.array(group[first])),
            pa.array(shard[first], pa.int32()),
            *[pa.ListArray.from_arrays(by_term, x) for x in (names.take(pa.array(code[term])), pa.array(np.add.reduceat(docs, term)), widths)],
            *[pa.ListArray.from_arrays(by_entry, x) for x in (sources.take(pa.array(group)), pa.array(count))],
        ]
        yield from pieces_of_rows(pa.RecordBatch.from_arrays(columns, RUN_COLUMNS), 256)


def pieces_of_rows(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def block_runs(batches: Iterable[pa.RecordBatch], shards: int, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Term-sorted runs of as many rows as fit into a block, again and again."""
    block = Block()
    for piece in pieces(batches, "text", PIECE):
        block.add(piece)
        if block.size() > limit:
            block.merge()
            if block.size() > limit // 2:
                yield from block.runs(shards)
                block = Block()
    yield from block.runs(shards)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield {name: batch.column(i)[at] for i, name in enumerate(batch.schema.names)}


def _entries(run: dict) -> Iterator[tuple[str, int, list[str], list[int]]]:
    """The terms of a run in order, each with its rows, sources and counts."""
    terms, docs, widths, sources, counts = (run[c].values.to_pylist() for c in RUN_COLUMNS[2:])
    at = 0
    for term, in_rows, width in zip(terms, docs, widths, strict=True):
        yield term, in_rows, sources[at : at + width], counts[at : at + width]
        at += width


def merge_runs(batches: Iterable[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Frequencies of the terms in ``min_docs`` rows of their language at least, from runs sorted by language and shard.

    The heap holds one term of each run; only the sums of one term's sources are held.
    """
    schema = pa.schema(
        [("lang", pa.string()), ("term", pa.string()), ("source", pa.string())]
        + [("count", pa.int64()), ("total", pa.int64()), ("lead", pa.bool_())]
    )
    out: list[list] = [[] for _ in schema]
    for (lang, _), rows in groupby(_rows(batches), lambda r: (r["lang"].as_py(), r["shard"].as_py())):
        runs = [_entries(r) for r in rows]
        for term, entries in groupby(heapq.merge(*runs, key=itemgetter(0)), itemgetter(0)):
            counts: dict[str, int] = defaultdict(int)
            in_rows = 0
            for _, docs, sources, times in entries:
                in_rows += docs
                for source, count in zip(sources, times, strict=True):
                    counts[source] += count
            if in_rows < min_docs:
                continue
            total = sum(counts.values())
            for column, values in zip(
                out,
                (
                    [lang] * len(counts),
                    [term] * len(counts),
                    counts.keys(),
                    counts.values(),
                    [total] * len(counts),
                    [True] + [False] * (len(counts) - 1),
                ),
                strict=True,
            ):
                column.extend(values)
            if len(out[0]) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
                out = [[] for _ in schema]
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)


def pair_corrections(batches: Iterable[pa.RecordBatch], limit: int = PAIRS) -> Iterator[pa.RecordBatch]:
    """Sums over the terms that two sources both have, from rows (lang, term, source, p, z) sorted by language and term.

    A correction is what the term's true distance differs by from what both sources' own terms explain.
    """
    sums: dict[tuple[str, str, str], int] = defaultdict(int)

    def sent() -> pa.RecordBatch:
        keys, values = list(sums), list(sums.values())
        columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], ["lang", "lo", "hi", "value"])

    def entries() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("lang", "term", "source", "p", "z")], strict=True)

    for (lang, _), rows in groupby(entries(), lambda e: e[:2]):
        own = sorted(e[2:] for e in rows)
        p, z = (np.array([e[i] for e in own], np.int64) for i in (1, 2))
        for i in range(len(own) - 1):
            rest = np.abs(p[i] - p[i + 1 :]) - np.abs(p[i] - z[i + 1 :]) - np.abs(p[i + 1 :] - z[i]) + np.abs(z[i] - z[i + 1 :])
            for j, value in enumerate(rest.tolist(), i + 1):
                sums[lang, own[i][0], own[j][0]] += value
            if len(sums) > limit:
                yield sent()
                sums.clear()
    if sums:
        yield sent()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)), by long division."""
    below = total + SMOOTH * terms
    quotient, rest = F.call_function("div", count + SMOOTH, below), (count + SMOOTH) % below
    for _ in range(3):
        quotient = quotient * 1000 + F.call_function("div", rest * 1000, below)
        rest = (rest * 1000) % below
    return quotient + 1


def frequencies(docs: DataFrame, min_docs: int, shards: int | None = None) -> DataFrame:
    """lang, term, source, count, total (of the language), lead (once a term) of kept terms, from rows lang, source, text."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.select("lang", "source", "text").mapInArrow(partial(block_runs, shards=shards or 4 * parts), RUNS)
    dealt = runs.repartition(parts, "lang", "shard").sortWithinPartitions("lang", "shard")
    return dealt.mapInArrow(partial(merge_runs, min_docs=min_docs), KEPT)


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: each other source of the language by distance. Part ``term``: the ``top`` terms that the source uses
    more than its language does.
    """
    names = {"lang": lang, "source": source, "text": text}
    own = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in names.items()])
    kept = materialise(frequencies(own, min_docs), "frequencies")
    sums = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = kept.filter("lead").groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    found = own.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    found = found.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "lang_n", "v")])
    # without kept terms there is no share; every sum over terms is 0 then
    zero = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("n"), F.col("v"))).otherwise(0)
    groups = materialise(found.withColumn("z", zero), "groups")
    rated = materialise(
        kept.join(groups, ["lang", "source"]).select(
            "lang",
            "term",
            "source",
            "z",
            share(F.col("count"), F.col("n"), F.col("v")).alias("p"),
            share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"),
        ),
        "rated",
    )
    return _pairs(rated, groups).unionByName(_terms(rated, top))


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(rated: DataFrame, top: int) -> DataFrame:
    ahead = rated.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(ahead, "term").filter(F.col("rank") <= top)


def _pairs(rated: DataFrame, groups: DataFrame) -> DataFrame:
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("pieces"))
    held = groups.join(sizes, "lang")
    left = held.withColumn("piece", F.pmod(F.xxhash64("source"), "pieces").cast("int"))
    right = held.select(
        "lang",
        F.col("source").alias("other"),
        F.col("z").alias("x"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
    )
    pairs = left.join(right, ["lang", "piece"]).filter("source <> other").select("lang", "source", "other", "v", "z", "x")
    # each source's distinct shares, largest first, between the smallest shares of the others
    held = rated.groupBy("lang", "source", F.col("p").alias("x")).agg(F.count("*").alias("n"))
    events = held.select("lang", "source", "x", "n").unionByName(pairs, allowMissingColumns=True)
    largest = Window.partitionBy("lang", "source").orderBy(F.desc("x")).rangeBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("lang", "source")
    n, s = F.coalesce("n", F.lit(0)), F.coalesce(F.col("n") * F.col("x"), F.lit(0))
    read = events.select(
        "*",
        F.sum(n).over(largest).alias("above_n"),
        F.sum(s).over(largest).alias("above"),
        F.sum(n).over(whole).alias("all_n"),
        F.sum(s).over(whole).alias("all"),
    ).filter("other is not null")
    far = F.abs(F.col("z") - F.col("x"))
    own = 2 * F.col("above") - F.col("all") + F.col("x") * (F.col("all_n") - 2 * F.col("above_n")) - F.col("all_n") * far
    base = F.when(F.col("source") < F.col("other"), F.col("v") * far).otherwise(0)
    ends = [F.least("source", "other").alias("lo"), F.greatest("source", "other").alias("hi")]
    explained = read.select("lang", *ends, (own + base).alias("value"))
    sorted_terms = rated.select("lang", "term", "source", "p", "z").repartition("lang", "term").sortWithinPartitions("lang", "term")
    corrected = sorted_terms.mapInArrow(pair_corrections, "lang string, lo string, hi string, value long")
    summed = explained.unionByName(corrected).groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("lo").alias("source"), F.col("hi").alias("item")), F.struct(F.col("hi").alias("source"), F.col("lo").alias("item")))
    return _ranked(summed.select("lang", "value", F.explode(ways).alias("way")).select("lang", "way.*", "value"), "pair")
