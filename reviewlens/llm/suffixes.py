"""Removal of repeated passages by a sparse suffix array.

A byte goes if it is in a string of ``length`` bytes that also starts anywhere else: in another text, in the same one,
overlapping or not. A string of that length is called a window here. Texts are bytes in UTF-8; a passage may begin or
end inside a character.

Sorting a suffix for every byte would move each text hundreds of times. Only some suffixes are sorted:

1. *Anchors.* In a window, the anchor is the place whose next ``gram`` bytes have the least hash (the first such place).
   Equal windows have their anchor at the same distance, so windows with different anchor grams differ. Consecutive
   windows mostly share an anchor; such a run is a slice. Slices whose gram occurs at one anchor only hold no repeated
   window and need no more than a count by hash.
2. *Equal slices.* Slices are counted by a 128-bit digest of their bytes. One that occurs more than once is repeated as
   a whole. This settles copies and passages inside texts before any text is moved, however many there are.
3. *Suffixes.* What is left are slices that share a gram but differ. Of each different one, one place is cut out, in
   parts of at most ``step`` windows. All windows of a part hold its core, ``length - step + 1`` bytes at a fixed place
   from the anchor. Parts are range-partitioned, by splitters that Spark samples, by the suffix that begins with the
   core, then by what stands before it. A bucket sorts suffixes and reversed prefixes by multikey quicksort, eight bytes
   at a time; the common lengths of neighbours tell which windows are equal.
4. *Boundaries.* A core may go on in the next bucket, or in many of them. The windows of a bucket's first and last core
   are therefore also compared between buckets, by the digest of each different window.

No step collects a group: a gram, core or passage that a third of all rows hold is spread over buckets by what differs.
Long texts are read in parts of ``CHUNK`` windows.

Defined results: a null text is empty, with no spans; texts shorter than ``length`` stay; equal texts of ``length``
bytes or more are all removed, so are repeated rows; every row gives one row, whatever its id, null and repeated ids
included; an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.arrays import buffers, mix, pieces, ragged
from reviewlens.sources.scratch import materialise

#: Text taken at once, in bytes, and windows of a text taken at once.
PIECE = CHUNK = 1 << 20
#: Parts that one bucket sorts.
BUCKET = 12_000
#: Bytes of a suffix that a splitter holds.
LEAD = 32
_ODD = 0x9E3779B97F4A7C15

ANCHORS = "text_id binary, begin int, windows int, back int, gram long, slice binary"
PARTS = "text_id binary, at int, most int, least int, content binary"
FOUND = "key binary, first int, last int, window binary"


def text_id(text: str) -> Column:
    """Half of the digest of a text: rows with the same text have the same spans."""
    return F.unhex(F.substring(F.sha2(F.col(text).cast("binary"), 256), 1, 32))


def _digest(data: bytes | memoryview) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (8 times a power of 2) from each place on, places whose gram would overrun left out."""
    n = len(data) - gram + 1
    lanes = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
    found, width, factor = mix(lanes), 8, _ODD
    while width < gram:
        found = found[:-width] * np.uint64(factor) + found[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    return mix(found[:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def anchored_slices(data: np.ndarray, valid: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """First and last window of each run of windows with one anchor, the anchor, and its hash.

    ``valid`` marks the places where a window may begin.
    """
    width = length - gram + 1
    hashed = gram_hashes(data, gram)
    least = sliding_least(hashed, width)
    valid = valid[: len(least)]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    stop = np.flatnonzero(valid & np.append(~valid[1:] | new[1:], True))
    view, anchor = np.lib.stride_tricks.sliding_window_view(hashed, width), first.copy()
    for at in range(0, len(first), 2048):
        anchor[at : at + 2048] += view[first[at : at + 2048]].argmin(axis=1)
    # a run outlives its anchor if the same hash comes again: each place of that hash takes the windows up to it
    again = np.flatnonzero(stop > anchor)
    if len(again):
        more = [[], [], []]
        for k in again.tolist():
            i, j = int(first[k]), int(stop[k])
            places = i + np.flatnonzero(hashed[i : j + width] == least[i])
            lo, hi = np.append(i, places[:-1] + 1), np.minimum(places, j)
            use = lo <= hi
            for part, values in zip(more, (lo[use], hi[use], places[use]), strict=True):
                part.append(values)
        rest = np.setdiff1d(np.arange(len(first)), again, assume_unique=True)
        first, stop, anchor = (
            np.concatenate([old[rest], *part]) for old, part in zip((first, stop, anchor), more, strict=True)
        )
    return first, stop, anchor, hashed[anchor]


def _chunks(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """Pieces of texts with their bytes, row starts, and the place of the bytes in a long text that is read in parts."""
    for piece in pieces(batches, "text", PIECE):
        data, offsets = buffers(piece.column("text"))
        if len(data) <= 2 * CHUNK:
            yield piece, data, offsets, 0
            continue
        for at in range(0, len(data) - length + 1, CHUNK):  # a piece above the limit is one row
            part = data[at : at + CHUNK + length - 1]
            yield piece, part, np.array([0, len(part)]), at


def find_anchors(batches: Iterable[pa.RecordBatch], length: int, gram: int, full: bool) -> Iterator[pa.RecordBatch]:
    """The slices of texts of ``length`` bytes or more: (text_id, text) -> ANCHORS, or only gram and count if not ``full``."""
    for piece, data, offsets, shift in _chunks(batches, length):
        if len(data) < length:
            continue
        valid = np.zeros(len(data), bool)
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            valid[begin : max(begin, end - length + 1)] = True
        first, stop, anchor, hashed = anchored_slices(data, valid, length, gram)
        hashed = hashed.view(np.int64)
        if not full:
            gram_of, count = np.unique(hashed, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram_of), pa.array(count)], ["gram", "n"])
            continue
        row = np.searchsorted(offsets, first, "right") - 1
        raw = memoryview(data)
        digests = [_digest(raw[i : j + length]) for i, j in zip(first.tolist(), stop.tolist(), strict=True)]
        columns = [
            piece.column("text_id").take(pa.array(row)),
            pa.array(first - offsets[row] + shift, pa.int32()),
            pa.array(stop - first + 1, pa.int32()),
            pa.array(anchor - stop, pa.int32()),
            pa.array(hashed),
            pa.array(digests, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["text_id", "begin", "windows", "back", "gram", "slice"])


def cut_parts(batches: Iterable[pa.RecordBatch], length: int, step: int) -> Iterator[pa.RecordBatch]:
    """The parts of the wanted slices of each text: (text_id, text, wanted) -> PARTS.

    The core of a part begins at byte ``most`` of its content. Its windows begin ``least`` to ``most`` bytes before it.
    """
    names = ["text_id", "at", "most", "least", "content"]
    for piece in pieces(batches, "text", PIECE):
        data, offsets = buffers(piece.column("text"))
        raw = memoryview(data)
        out: list[list] = [[] for _ in names]
        for row, (ident, wanted) in enumerate(zip(piece.column("text_id").to_pylist(), piece.column("wanted").to_pylist(), strict=True)):
            base = int(offsets[row])
            for x in wanted:
                begin, windows, back = x["begin"], x["windows"], x["back"]
                anchor = begin + windows - 1 + back
                for k in range(back // step, (back + windows - 1) // step + 1):
                    core = anchor - k * step
                    at, last = max(begin, core - step + 1), min(begin + windows - 1, core)
                    values = (ident, at, core - at, core - last, bytes(raw[base + at : base + last + length]))
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                if len(out[0]) >= 4096:
                    yield _part_batch(out, names)
                    out = [[] for _ in names]
        if out[0]:
            yield _part_batch(out, names)


def _part_batch(out: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def multikey_sort(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, and how many bytes each row of that order shares with the one before it.

    Rows are split by eight bytes at a time; only rows still tied are looked at again.
    """
    count, width = strings.shape
    words = np.zeros((count, -(-width // 8) * 8), np.uint8)
    words[:, :width] = strings
    words = words.view(">u8")
    order, common = np.arange(count), np.zeros(count, np.int64)
    tied, group = np.arange(count), np.zeros(count, np.int64)
    for depth in range(words.shape[1]):
        if not len(tied):
            break
        key = words[order[tied], depth].astype(np.uint64)
        place = np.lexsort((key, group))
        order[tied] = order[tied][place]
        key = key[place]
        same_group = np.concatenate([[False], group[1:] == group[:-1]])
        differs = np.concatenate([[False], key[1:] != key[:-1]])
        split = same_group & differs
        apart = (key[1:] ^ key[:-1])[split[1:]]
        # of the eight bytes, those before the highest set bit are shared
        shared = 8 - (np.frexp(apart.astype(np.float64))[1] + 7) // 8
        low = apart < (np.uint64(1) << np.uint64(52))
        shared[~low] = [8 - (int(x).bit_length() + 7) // 8 for x in apart[~low]]
        common[tied[split]] = 8 * depth + shared
        common[tied[same_group & ~differs]] = 8 * (depth + 1)
        group = np.cumsum(~same_group | differs)
        alone = np.bincount(group)[group] == 1
        tied, group = tied[~alone], group[~alone]
    return order, np.minimum(common, width)


def _matrix(data: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Rows of bytes from ``begin`` on (backwards if ``step`` is -1), filled up with zeros."""
    rows = np.zeros((len(begin), width), np.uint8)
    owner, place = ragged(size)
    rows[owner, place] = data[begin[owner] + step * place]
    return rows


def sort_bucket(batches: Iterable[pa.RecordBatch], length: int, step: int) -> Iterator[pa.RecordBatch]:
    """First and last repeated window of each part of a bucket, and digests of the windows that other buckets may hold.

    Rows (key, content, most, least, n, lead, core): n places have this content; lead and core come first in the order
    of the splitters.
    """
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    keys, content = table.column("key").combine_chunks(), table.column("content").combine_chunks()
    keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
    content = content.chunk(0) if isinstance(content, pa.ChunkedArray) else content
    most, least, n = (table.column(c).to_numpy().astype(np.int64) for c in ("most", "least", "n"))
    data, at = buffers(_as_text(content))
    count = len(most)
    core = at[:-1] + most
    right = _matrix(data, core, at[1:] - core, length)
    left = _matrix(data, core - 1, most, step, -1)
    (order, common), (back_order, back_common) = multikey_sort(right), multikey_sort(left)
    first, last = np.full(count, step), np.full(count, -1)

    def classes(order: np.ndarray, common: np.ndarray, size: int) -> np.ndarray:
        """Rows that share their first ``size`` bytes get one number."""
        out = np.empty(count, np.int64)
        out[order] = np.cumsum(common < size)
        return out

    # the cores of the first and the last row in the order of the splitters may go on in other buckets
    begun = list(zip(table.column("lead").to_pylist(), table.column("core").to_pylist(), strict=True))
    ends = (min(begun), max(begun))
    edge = np.fromiter((x in ends for x in begun), bool, count)
    raw = memoryview(data)
    for back in range(step):
        rows = np.flatnonzero((least <= back) & (back <= most))
        if not len(rows):
            continue
        pair = classes(order, common, length - back)[rows] * (count + 1) + classes(back_order, back_common, back)[rows]
        _, one, which, times = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        shown = rows[one][edge[rows[one]]]  # one row for each window that this bucket has, however often
        if len(shown):
            begin = at[:-1][shown] + most[shown] - back
            windows = [_digest(raw[i : i + length]) for i in begin.tolist()]
            yield _found(keys.take(pa.array(shown)), most[shown] - back, most[shown] - back, windows)
        rows = rows[(times[which] > 1) | (n[rows] > 1)]
        window = most[rows] - back
        first[rows], last[rows] = np.minimum(first[rows], window), np.maximum(last[rows], window)
    rows = np.flatnonzero(last >= 0)
    yield _found(keys.take(pa.array(rows)), first[rows], last[rows], [None] * len(rows))


def _as_text(column: pa.Array) -> pa.Array:
    """A binary column whose buffers can be read as those of a text column."""
    return column.view(pa.large_string() if pa.types.is_large_binary(column.type) else pa.string())


def _found(keys: pa.Array, first: np.ndarray, last: np.ndarray, windows: list) -> pa.RecordBatch:
    columns = [keys, pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(windows, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["key", "first", "last", "window"])


def repeated_spans(docs: DataFrame, text: str, length: int, gram: int, step: int) -> DataFrame:
    """text_id, begin, end of stretches that are in repeated windows, for all texts; stretches may overlap."""
    own = docs.select(text_id(text).alias("text_id"), F.col(text).alias("text")).filter(F.octet_length("text") >= length)
    grams = own.mapInArrow(partial(find_anchors, length=length, gram=gram, full=False), "gram long, n long")
    # written, so that a join with it can split a gram that a large part of the anchors has
    shared = materialise(grams.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram"), "grams")
    anchors = own.mapInArrow(partial(find_anchors, length=length, gram=gram, full=True), ANCHORS)
    anchors = materialise(anchors.join(shared, "gram", "left_semi"), "anchors")
    place = F.struct("text_id", "begin", "windows", "back")
    slices = materialise(anchors.groupBy("gram", "slice").agg(F.count("*").alias("n"), F.min(place).alias("place")), "slices")
    copies = slices.filter("n > 1").select("gram", "slice")
    whole = anchors.join(copies, ["gram", "slice"], "left_semi")
    whole = whole.select("text_id", "begin", (F.col("begin") + F.col("windows") - 1 + length).alias("end"))
    mixed = slices.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram")
    mixed = materialise(mixed, "mixed")
    wanted = slices.join(mixed, "gram", "left_semi").groupBy("place.text_id")
    wanted = wanted.agg(F.collect_list(F.struct("place.begin", "place.windows", "place.back")).alias("wanted"))
    texts = own.groupBy("text_id").agg(F.first("text").alias("text")).join(wanted, "text_id")
    key = F.unhex(F.md5(F.concat("content", F.col("most").cast("string").cast("binary"))))
    parts = texts.mapInArrow(partial(cut_parts, length=length, step=step), PARTS)
    parts = materialise(parts.withColumn("key", key), "parts")
    kinds = parts.groupBy("key", "content", "most", "least").agg(F.count("*").alias("n"))
    kinds = materialise(kinds, "kinds")
    buckets = max(1, -(-kinds.count() // BUCKET))
    # splitters are short: the first bytes of the suffix, the core that they begin, what follows it, and all there is
    size = length - step + 1
    order = {
        "lead": F.expr(f"substring(content, most + 1, {LEAD})"),
        "core": F.xxhash64(F.expr(f"substring(content, most + 1, {size})")),
        "after": F.expr(f"substring(content, most + 1 + {size}, {LEAD // 2})"),
        "rest": F.xxhash64("content"),
    }
    dealt = kinds.withColumns(order).repartitionByRange(buckets, *order)
    dealt = dealt.select("key", "content", "most", "least", "n", "lead", "core")
    found = materialise(dealt.mapInArrow(partial(sort_bucket, length=length, step=step), FOUND), "found")
    edges = found.filter("window is not null")
    crossing = edges.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    alike = found.filter("window is null").unionByName(edges.join(crossing, "window", "left_semi").select(*found.columns))
    alike = alike.groupBy("key").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    cut = parts.select("key", "text_id", "at").join(alike, "key")
    cut = cut.select("text_id", (F.col("at") + F.col("first")).alias("begin"), (F.col("at") + F.col("last") + length).alias("end"))
    return whole.unionByName(cut).distinct()


def _keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    for piece in pieces(batches, "text", PIECE):
        data, offsets = buffers(piece.column("text"))
        raw, spans, kept = memoryview(data), [], []
        for row, found in enumerate(piece.column("found").to_pylist()):
            base, merged = int(offsets[row]), []
            for x in sorted((f["begin"], f["end"]) for f in found or ()):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            borders = [0, *[b for pair in merged for b in pair], int(offsets[row + 1]) - base]
            kept.append(b"".join(raw[base + i : base + j] for i, j in zip(borders[::2], borders[1::2], strict=True)))
            spans.append([{"begin": i, "end": j} for i, j in merged])
        columns = [piece.column("doc_id"), pa.array(np.diff(offsets)), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])


def drop_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = 400, gram: int = 64, step: int = 96) -> DataFrame:
    """doc_id, n_bytes, spans (begin and end of the removed runs) and kept (the remaining bytes) of every row.

    ``gram`` is 8, 16, 32, 64 ... and below ``length``; ``step`` is at most ``length``.
    """
    own = docs.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(own, "text", length, gram, step)
    by_text = materialise(spans.groupBy("text_id").agg(F.collect_list(F.struct("begin", "end")).alias("found")), "spans")
    met = own.withColumn("text_id", text_id("text")).join(by_text, "text_id", "left").select("doc_id", "text", "found")
    kind = docs.schema[doc].dataType.simpleString()
    return met.mapInArrow(_keep, f"doc_id {kind}, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary")
