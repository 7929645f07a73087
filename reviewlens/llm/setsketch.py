"""Near-duplicates by SetSketch: registers of exponentially spaced truncated minima over sets of word shingles.

A register holds the floor of the negative logarithm (to a base close to 1) of the least of exponential hash values of
a set's members. Registers merge by maximum, and two sets agree in one about as often as they share members.
Bands of registers bring similar sets together; a joint likelihood of all registers and the known set sizes estimates
their similarity, which drops what is far from similar; links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.arrays import LOWER, SPACE, buffers, hashes, mix, pieces, spans
from reviewlens.operators.components import connected_components
from reviewlens.sources.scratch import materialise

#: Words in a shingle. Two sets are linked if they share at least SHARE hundredths of their union.
SHINGLE, SHARE = 4, 80
#: Registers, and bands of them. Sets that share 0.8 of their union meet in a band but for once in 20 million.
REGISTERS, BANDS = 128, 32
#: Base, rate and limit of the registers.
BASE, RATE, LIMIT = 1.001, 20.0, 65534
#: Estimates below this are dropped: five standard errors under 0.8.
LEAST_ESTIMATE = 0.62
#: Rows of a block, and columns of the matrices whose products compare two blocks.
BLOCK, CELL_COLUMNS = 2048, 2048
#: Bits for each document that is read again in the map of these, and bits of the largest map (8 MB).
MAP_BITS, LARGEST_MAP = 16, 1 << 26
#: Bytes of text that are looked at once.
PIECE = 1 << 20
_FACTORS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text laid end to end, as 64-bit hashes, and where each text begins."""
    raw, offsets = buffers(column)
    low = LOWER[raw]
    begin, end, n = spans(~SPACE[low], offsets)
    words = hashes(low, begin, end)
    heads = np.concatenate([[0], np.cumsum(n)])
    g = words.copy()
    for k in range(1, size):  # after the loop g[i] holds words i to i + size - 1
        g[:-k] = mix(g[:-k] ^ mix(words[k:] + np.uint64(k)))
    out, sizes = [], np.zeros(len(n), np.int64)
    for row in np.flatnonzero(n):
        a, b = heads[row], heads[row + 1]
        if n[row] >= size:
            own = np.sort(g[a : b - size + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        else:  # the whole sequence is the one shingle
            whole = np.uint64(n[row])
            for w in words[a:b]:
                whole = mix(np.array([whole ^ w], np.uint64))[0]
            own = np.array([whole], np.uint64)
        out.append(own)
        sizes[row] = len(own)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def registers(members: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The registers of each set (row), zeros for an empty one."""
    out = np.zeros((len(heads) - 1, REGISTERS), np.uint16)
    some = np.flatnonzero(np.diff(heads))
    if some.size:
        for k, factor in enumerate(_FACTORS):
            least = np.minimum.reduceat(members * factor, heads[some])
            rate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
            value = np.floor(1 - np.log(np.maximum(rate, 1e-300) / RATE) / np.log(BASE))
            out[some, k] = np.clip(value, 0, LIMIT + 1)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, grid: int = 128) -> np.ndarray:
    """The similarity at which the registers of each pair of rows are likeliest, the set sizes being known.

    With u and v the sizes' shares of their sum, a register of the first is larger with probability
    p(u - v J), of the second with p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    u = n_a / (n_a + n_b)
    most = np.minimum(u / (1 - u), (1 - u) / u)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    for k in range(grid + 1):
        j = most * k / grid
        larger = (u - (1 - u) * j, (1 - u) - u * j)
        p = [-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE) for x in larger]
        same = np.maximum(1 - p[0] - p[1], 1e-12)
        likely = above * np.log(np.maximum(p[0], 1e-12)) + below * np.log(np.maximum(p[1], 1e-12))
        likely += (REGISTERS - above - below) * np.log(same)
        better = likely > best
        best, at = np.where(better, likely, best), np.where(better, j, at)
    return at


def _keys(members: np.ndarray, heads: np.ndarray) -> list[pa.Array]:
    """Two names of each set: sums over its members, whatever their order."""
    out = []
    for salt in (0x1234567, 0x89ABCDE):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(members ^ np.uint64(salt)), dtype=np.uint64)])
        out.append(pa.array(np.diff(total[heads]).view(np.int64)))
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", PIECE):
        members, heads = shingle_sets(batch.column("text"))
        rows = pa.array([r.tobytes() for r in registers(members, heads)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(np.diff(heads)), *_keys(members, heads), rows],
            ["doc_id", "key", "n", "k1", "k2", "registers"],
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        width = REGISTERS // BANDS
        lanes = np.ascontiguousarray(found).view(np.uint64).reshape(len(found), BANDS, width // 4)
        key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(found), 1))
        for k in range(width // 4):
            key = mix(key ^ mix(lanes[:, :, k]))
        columns = [
            pa.array(key.ravel().view(np.int64)),
            *(pa.array(np.repeat(batch.column(c).to_numpy(), BANDS)) for c in ("rep", "n")),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "rep", "n"])


def _register_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [_register_rows(batch.column(c)) for c in ("ra", "rb")]
        n_a, n_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
        kept = pa.array(estimate(*sides, n_a, n_b) >= LEAST_ESTIMATE)
        yield pa.RecordBatch.from_arrays([batch.column(n).filter(kept) for n in ("a", "b")], ["a", "b"])


def _mapped(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a doc_id of ``wanted``, and few others: one in MAP_BITS, more beyond the largest map.

    The map has a bit for each hash of a doc_id and is broadcast as words of 64 bits, so no text is shuffled.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(min(LARGEST_MAP, max(64, wanted.count() * MAP_BITS))))
    word, bit = F.expr("_place div 64"), F.expr("cast(_place % 64 as int)")
    words = wanted.withColumn("_place", place).groupBy(word.alias("_word"))
    words = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    placed = docs.withColumn("_place", place).withColumn("_word", word).join(F.broadcast(words), "_word")
    return placed.filter(F.getbit("_bits", bit) == 1).select(*docs.columns)


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", PIECE):
        members, heads = shingle_sets(batch.column("text"))
        sets = pa.ListArray.from_arrays(pa.array(heads, pa.int32()), pa.array(members.view(np.int64)))
        columns = [*_keys(members, heads), pa.array(np.diff(heads)), sets]
        yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n", "members"])


def _sides(key: tuple, table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows of two blocks that have to meet: all but pairs of the commonest component."""
    block, component = table.column("block").to_numpy(), table.column("component").to_numpy()
    a, b = (np.flatnonzero(block == key[k].as_py()) for k in (1, 2))
    names, counts = np.unique(component, return_counts=True)
    rare = component != names[counts.argmax()]
    return [(a[rare[a]], b), (a[~rare[a]], b[rare[b]])]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link of each vertex of these links to the least of its component, but for that one itself."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[u], root[v])
        now = root.copy()
        for end in (u, v):
            np.minimum.at(now, end, least)
            np.minimum.at(now, root[end], least)
        now = now[now]
        if (now == root).all():
            break
        root = now
    other = np.flatnonzero(root != np.arange(len(names)))
    return names[other], names[root[other]]


def _cell(key: tuple, table: pa.Table) -> pa.Table:
    """Links between the components of two blocks of a group, at most one for each component.

    Shared shingles are counted by products of 0/1 matrices, some columns at a time; no pair becomes a row.
    """
    lists = table.column("members").combine_chunks()
    owner = np.repeat(np.arange(table.num_rows), np.diff(lists.offsets.to_numpy()))
    _, at, count = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[at]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n, component = (table.column(c).to_numpy() for c in ("n", "component"))
    sides = _sides(key, table)
    shared = [np.zeros((len(rows), len(others)), np.float32) for rows, others in sides]
    for low in range(0, int((count > 1).sum()), CELL_COLUMNS):
        some = slice(*np.searchsorted(column, [low, low + CELL_COLUMNS]))
        has = np.zeros((table.num_rows, CELL_COLUMNS), np.float32)
        has[owner[some], column[some] - low] = 1
        for total, (rows, others) in zip(shared, sides, strict=True):
            total += has[rows] @ has[others].T
    low, high = [], []
    for total, (rows, others) in zip(shared, sides, strict=True):
        for i in range(0, len(rows), 256):  # the comparison needs whole numbers of more than 24 bits
            some = rows[i : i + 256]
            both = total[i : i + 256].astype(np.int64)
            union = n[some][:, None] + n[others][None, :] - both
            x, y = np.nonzero((both * 100 >= union * SHARE) & (component[some][:, None] != component[others][None, :]))
            ends = np.unique(np.sort(np.column_stack([component[some[x]], component[others[y]]]), axis=1), axis=0)
            low.append(ends[:, 0])
            high.append(ends[:, 1])
    a, b = _forest(*(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (low, high)))
    return pa.table({"u": pa.array(a, pa.int64()), "v": pa.array(b, pa.int64())})


def _cells(rows: DataFrame) -> DataFrame:
    """Rows (grp, rep, ...) once for each pair (low, high) of blocks of their group that holds theirs."""
    sizes = rows.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = rows.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")})


def _links_of_stars(members: DataFrame, sets: DataFrame, full: DataFrame) -> DataFrame:
    """Confirmed links (u, v) between the members of buckets and the first of their bucket."""
    pairs = members.filter("rep <> first").select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct()
    mine, theirs = (
        sets.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
        for x in ("a", "b")
    )
    close = pairs.join(mine, "a").join(theirs, "b")
    close = close.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SHARE)
    close = close.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely, "a long, b long")
    ours, others = (full.select(F.col("rep").alias(x), F.col("members").alias(f"m{x}")) for x in ("a", "b"))
    both = materialise(close, "likely").join(ours, "a").join(others, "b")
    both = both.withColumn("shared", F.size(F.array_intersect("ma", "mb")))
    union = F.size("ma") + F.size("mb") - F.col("shared")
    return both.filter(F.col("shared") * 100 >= union * SHARE).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _links_between(members: DataFrame, components: DataFrame, full: DataFrame) -> DataFrame:
    """Links (u, v) between components that share a bucket, enough of them to join all that belong together.

    Buckets that hold several components are grouped by the least of these, so that a set travels once for all
    the buckets that it shares with that component. A group is cut into blocks that meet each other, by full sets:
    a product of matrices costs less than the likelihood of as many pairs.
    """
    placed = members.select("bucket", "rep", "n").join(components, "rep", "left")
    placed = materialise(placed.withColumn("component", F.coalesce("component", "rep")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("grp"), F.max("component").alias("high"))
    rows = placed.join(mixed.filter("grp <> high").select("bucket", "grp"), "bucket")
    rows = materialise(rows.select("grp", "rep", "n", "component").distinct(), "mixed")
    cells = _cells(rows).join(full, "rep")
    cells = cells.select("grp", "low", "high", "block", "n", "component", "members")
    return cells.groupBy("grp", "low", "high").applyInArrow(_cell, "u long, v long").distinct()


def _components(links: DataFrame) -> DataFrame:
    return materialise(connected_components(links).select(F.col("vertex").alias("rep"), "component"), "components")


def classes(docs: DataFrame, same_id: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, key): doc_id, key, n, class and first, the least doc_id of the class.

    A class is a component of linked sets; it is null for rows without words or doc_id. With ``same_id`` rows of
    one doc_id are one document and so of one class, whatever their texts.

    Equal sets are one representative from the start, so copies cost nothing beyond their own row. In each
    bucket every member meets the first one; what is in a bucket with another component after that meets it block
    by block. Texts are read a second time, once, for sets that share a bucket, and become sets where they are read:
    a shuffle moves the sets that share a bucket, never a text. No bucket is capped or held by one
    task, and no pair of members becomes a row but those with the first.
    """
    schema = "doc_id long, key binary, n long, k1 long, k2 long, registers binary"
    sketched = materialise(docs.mapInArrow(_sketch, schema), "sketches")
    names = ["k1", "k2", "n"]
    named = sketched.filter("n > 0 and doc_id is not null")
    sets = named.groupBy(*names).agg(F.min(F.struct("doc_id", "registers")).alias("x"))
    sets = sets.select(*names, "x.*", F.monotonically_increasing_id().alias("rep"))
    sets = materialise(sets, "representatives")  # from here on a set has the number written
    banded = sets.select("registers", "rep", "n").mapInArrow(_bands, "bucket long, rep long, n long")
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("first")).filter("size > 1")
    members = banded.join(materialise(buckets, "buckets"), "bucket")
    members = materialise(members.select("bucket", "rep", "n", "first"), "members")

    wanted = sets.join(members.select("rep").distinct(), "rep").select("doc_id", "rep", *names)
    wanted = materialise(wanted, "wanted")
    full = _mapped(docs.select("doc_id", "text"), wanted).select("text")
    # a row that is not wanted, or has another text than its doc_id's wanted one, goes by the name of its set
    full = full.mapInArrow(_full, "k1 long, k2 long, n long, members array<long>").dropDuplicates(names)
    full = materialise(full.join(wanted, names).select("rep", "members"), "sets")
    links = _links_of_stars(members, sets, full)
    if same_id:
        several = named.groupBy("doc_id").agg(*[f(k).alias(f"{f.__name__}_{k}") for f in (F.min, F.max) for k in names])
        several = several.filter(" or ".join(f"min_{k} <> max_{k}" for k in names)).select("doc_id")
        repeats = named.select("doc_id", *names).join(several, "doc_id").distinct()
        repeats = materialise(repeats.join(sets.select(*names, "rep"), names).select("doc_id", "rep"), "repeats")
        least = repeats.groupBy("doc_id").agg(F.min("rep").alias("v"))
        links = links.unionByName(repeats.join(least, "doc_id").select(F.col("rep").alias("u"), "v").filter("u <> v"))
    components = _components(links)
    more = materialise(_links_between(members, components, full), "links")
    known = sets.select(*names, "rep", "doc_id").join(components, "rep", "left")
    known = known.select(*names, "doc_id", F.coalesce("component", "rep").alias("class"))
    if not more.isEmpty():
        wider = _components(more).select(F.col("rep").alias("class"), F.col("component").alias("wider"))
        known = known.join(wider, "class", "left").withColumn("class", F.coalesce("wider", "class")).drop("wider")
    known = materialise(known, "classes")
    first = known.groupBy("class").agg(F.min("doc_id").alias("first"))
    known = known.drop("doc_id").join(first, "class")
    rows = sketched.select("doc_id", "key", *names)
    # a row without doc_id may be a copy of one that has
    own = [F.when(F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in ("class", "first")]
    return rows.join(known, names, "left").select("doc_id", "key", "n", *own)


def cluster(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept; other columns are left out.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; a text of fewer than four words is one
    shingle, one without words (or null) is empty and linked with nothing. component_id is the least doc_id that
    can be reached over links, kept marks that document. Rows that repeat a doc_id are one document: it has the
    links of each of its texts, and all its rows that have words are of one component. A null doc_id is linked with
    nothing and not kept. An empty table gives no rows.
    """
    named = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = classes(named.withColumn("key", F.lit(None).cast("binary")))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"),
    )
