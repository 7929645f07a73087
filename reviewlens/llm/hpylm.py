"""Language-model scores by a hierarchical Pitman-Yor model of words.

A word's restaurant is named by the whole word before it; restaurants of words that end in the same two bytes share a
parent, those of one last byte the next, and all share the root, whose base is uniform over the vocabulary and one
more. Seating is sampled by blocks: the table count of a dish is drawn for all its customers at once, with the weight
that the Chinese-restaurant rule gives it. Predictive probabilities are averaged over several samples.

A dish's seating depends on other dishes only through the totals of a restaurant. So words are dealt into buckets by
hash, a bucket's words are resampled together as arrays, and only totals go round between sweeps. The restaurants of
whole words are as many as words: their totals are added up at homes, dealt by the hash of the context, and each bucket
gets those of its own contexts. Texts meet the model word by word in the buckets, in blocks that carry each block's
words once, and the sums come home; words after a word that the bucket has never seen before one of its own go on to
the home of that context.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.arrays import LOWER, SPACE, buffers, hashes, pieces, ragged, spans
from reviewlens.sources.scratch import discard, materialise

#: Text bytes of a block, and bytes of all texts per bucket.
BLOCK, BUCKET = 3 << 20, 8 << 20
#: Whole seatings proposed for each dish beyond EXACT before the first sample and between samples; samples.
BURN, MOVES, SAMPLES = 6, 3, 3
#: Concentration of every restaurant.
THETA = 1.0
#: Customers up to which a table count is drawn from a table of weights; points of the integral beyond.
EXACT, NODES = 512, 32
#: Endings of contexts: two bytes, and their parents: one.
CONTEXTS, PARENTS = 1 << 16, 1 << 8
#: Buckets for each home of contexts; buckets for each round of scoring, and rounds at most.
PER_HOME, PER_ROUND, ROUNDS = 8, 24, 2
_END = np.uint64(0x7F4A7C159E3779B9)
USAGE = (
    "bucket int, block long, words binary, pairs binary, context binary, times binary, docs binary,"
    " ids array<long>, held array<boolean>, tokens array<long>"
)
STATE = (
    "bucket int, words binary, pairs binary, own binary, context binary, c binary,"
    " t3 array<binary>, t2 array<binary>, t1 array<binary>, t0 array<binary>"
)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of each text's words and its end, the context of each, and tokens per text.

    A context is the word before: its last two bytes, then 48 bits of its hash. A text's first token has context 0.
    """
    raw, offsets = buffers(column)
    low = LOWER[raw]
    begin, end, n = spans(~SPACE[low], offsets)
    rows = np.arange(len(n))
    own = np.arange(len(begin)) + np.repeat(rows, n)
    out = np.full(len(begin) + len(n), _END, np.uint64)
    out[own] = hashes(low, begin, end)
    last = low[end - 1].astype(np.uint16) << np.uint16(8)
    last |= np.where(end - begin > 1, low[np.maximum(end - 2, 0)], 0).astype(np.uint16)
    context = np.zeros(len(out), np.uint64)
    context[own + 1] = (last.astype(np.uint64) << np.uint64(48)) | (out[own] >> np.uint64(16))
    return out, context, n + 1


def _bytes(x: np.ndarray) -> bytes:
    """Numbers byte by byte of their places, packed."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def _ints(packed: bytes, kind) -> np.ndarray:
    kind, size = np.dtype(kind), int.from_bytes(packed[:8], "little")
    if not size:
        return np.zeros(0, kind)
    raw = np.frombuffer(pa.decompress(packed[8:], size, "zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()


def _homes(buckets: int) -> int:
    return -(-buckets // PER_HOME)


def _home(context: np.ndarray, homes: int) -> np.ndarray:
    return (((context >> np.uint64(16)) & np.uint64(0xFFFFFFFF)) * np.uint64(homes)) >> np.uint64(32)


def _before(context: np.ndarray, at: np.ndarray, n: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of a block in order, and the place of each token's; ``at`` are the places of its words."""
    names = np.zeros(words + 1, np.uint64)
    after = np.concatenate([[0], at[:-1] + 1]).astype(np.int64)
    after[np.cumsum(n) - n] = 0
    names[after] = context
    order = np.argsort(names, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return names[order], place[after]


def _usage(buckets: int, with_docs: bool):
    """Blocks of texts as, per bucket, their distinct words, the contexts of each and in which texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, "text", BLOCK):
            block += 1
            found, context, n = tokens(batch.column("text"))
            doc = np.repeat(np.arange(batch.num_rows, dtype=np.uint64), n)  # a batch has fewer than 2^16 rows
            words, at = np.unique(found, return_inverse=True)
            names, after = _before(context, at, n, len(words))
            # a block's words, contexts and rows fit into one number
            low, wide = (np.uint64(x.bit_length()) for x in (batch.num_rows, len(names)))
            keys = (((at.astype(np.uint64) << wide) | after.astype(np.uint64)) << low) | doc
            keys.sort()
            pair = keys >> low
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            times = np.diff(np.concatenate([first, [len(keys)]])).astype(np.uint32)
            of = (pair[first] >> wide).astype(np.int64)
            per_word = np.bincount(of, minlength=len(words)).astype(np.uint32)
            contexts = names[pair[first] & ((np.uint64(1) << wide) - np.uint64(1))]
            docs = (keys & ((np.uint64(1) << low) - np.uint64(1))).astype(np.uint16)
            bucket = ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            w = np.searchsorted(bucket, np.arange(buckets + 1))
            p = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])[w]
            d = np.concatenate([[0], np.cumsum(times, dtype=np.int64)])[p]
            home = block % buckets
            rows = []
            for k in np.union1d(bucket, [home] if with_docs else []).astype(int).tolist():
                if w[k] < w[k + 1] or (with_docs and k == home):
                    rows.append(
                        {
                            "bucket": k, "block": block, "words": _bytes(words[w[k] : w[k + 1]]),
                            "pairs": _bytes(per_word[w[k] : w[k + 1]]), "context": _bytes(contexts[p[k] : p[k + 1]]),
                            "times": _bytes(times[p[k] : p[k + 1]]),
                            "docs": _bytes(docs[d[k] : d[k + 1]]) if with_docs else None,
                        }
                    )
                    if with_docs and k == home:
                        rows[-1] |= {
                            "ids": batch.column("doc_id").to_pylist(), "held": batch.column("held").to_pylist(),
                            "tokens": n.tolist(),
                        }
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return run


_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64())]
    + [(x, pa.binary()) for x in ("words", "pairs", "context", "times", "docs")]
    + [("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64()))]
)
_STATE = pa.schema(
    [("bucket", pa.int32())]
    + [(x, pa.binary()) for x in ("words", "pairs", "own", "context", "c")]
    + [(x, pa.list_(pa.binary())) for x in ("t3", "t2", "t1", "t0")]
)


def _each(rows: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """One row at a time, so that only its own arrays are copied."""
    for k in range(rows.num_rows):
        yield rows.slice(k, 1).to_pylist()[0]


def _first_of(ordered: np.ndarray) -> np.ndarray:
    """Where each value of an ordered array begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def _merge(group: pa.Table) -> pa.Table:
    """The words of a bucket with the counts of their contexts over all blocks."""
    rows = group.select(["bucket", "words", "pairs", "context", "times"]).to_pylist()
    words, word = np.unique(np.concatenate([_ints(r["words"], "u8") for r in rows]), return_inverse=True)
    word = np.repeat(word, np.concatenate([_ints(r["pairs"], "u4") for r in rows]))
    context = np.concatenate([_ints(r["context"], "u8") for r in rows])
    times = np.concatenate([_ints(r["times"], "u4") for r in rows])
    own, context = np.unique(context, return_inverse=True)
    pair = (word.astype(np.uint64) << np.uint64(32)) | context.astype(np.uint64)
    order = np.argsort(pair)
    pair = pair[order]
    first = _first_of(pair)
    c = np.add.reduceat(times[order].astype(np.uint64), first)
    per_word = np.bincount((pair[first] >> np.uint64(32)).astype(np.int64), minlength=len(words))
    row = {
        "bucket": rows[0]["bucket"], "words": _bytes(words), "pairs": _bytes(per_word.astype(np.uint32)),
        "own": _bytes(own), "context": _bytes(pair[first].astype(np.uint32)), "c": _bytes(c), "t3": [], "t2": [], "t1": [], "t0": [],
    }
    return pa.Table.from_pylist([row], _STATE)


@lru_cache(8)
def seating_odds(discount: float, most: int = EXACT) -> np.ndarray:
    """[c, t]: log of the weight of t tables for c customers, wherever they are.

    It is S(c, t) = S(c-1, t-1) + (c - 1 - t d) S(c-1, t), the generalized Stirling numbers.
    """
    log = np.full((most + 1, most + 1), -np.inf)
    log[0, 0] = 0.0
    for c in range(1, most + 1):
        log[c, 1:] = log[c - 1, :-1]
        t = np.arange(1, c)
        log[c, 1:c] = np.logaddexp(log[c, 1:c], log[c - 1, 1:c] + np.log(c - 1 - t * discount))
    return log


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, from 10 on."""
    up = 10.0
    far = x + up
    tail = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / far**2) / far**2) / far**2) / far
    out = (far - 0.5) * np.log(far) - far + 0.5 * np.log(2 * np.pi) + tail
    for k in range(int(up)):
        out -= np.log(x + k)
    return out


def _log_g(z: np.ndarray, d: float) -> np.ndarray:
    """log(1 - (1 - e^-z)^d), log of the generating function of a table's customers at e^-z."""
    with np.errstate(all="ignore"):
        near = np.log(-np.expm1(-z))
        inner = np.where(np.abs(z) > 0.7, np.log1p(-np.exp(-z)), near)
        return np.log(-np.expm1(d * inner))


def _fall(z: np.ndarray, d: float) -> np.ndarray:
    """Minus the slope of _log_g for real z: the mean customers of a table, from infinity down to one."""
    with np.errstate(all="ignore"):
        log = np.where(z > 0.7, np.log1p(-np.exp(-z)), np.log(-np.expm1(-z)))
        return np.exp(np.log(d) + (d - 1) * log - z - _log_g(z, d))


def _solve(falling, n: int) -> np.ndarray:
    """Where a falling function of z > 0 is 0, by halving in log z."""
    low, high = np.full(n, np.log(1e-300)), np.full(n, np.log(30.0))
    for _ in range(56):
        z = (low + high) / 2
        up = falling(np.exp(z)) > 0
        low, high = np.where(up, z, low), np.where(up, high, z)
    return np.exp((low + high) / 2)


def log_tables(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """log(t! d^t S(c, t) / c!) for any c: the coefficient of x^c in (1 - (1 - x)^d)^t, by an integral through its saddle."""
    c, t = np.asarray(c, float), np.asarray(t, float)
    out = np.where(t == c, c * np.log(d), -np.inf)
    some = np.flatnonzero((t >= 1) & (t < c))
    for k in range(0, len(some), 1 << 12):
        own = some[k : k + (1 << 12)]
        out[own] = _coefficient(c[own], t[own], d)
    return out


def _coefficient(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    # a line where the saddle is far from the branch point, else a parabola around the cut
    z0 = np.maximum(_solve(lambda z: t * _fall(z, d) - c, len(c)), 1 / c)
    line = z0 > 0.5
    step = z0 * 1e-4
    bend = t * (_fall(z0 - step, d) - _fall(z0 + step, d)) / (2 * step)
    steep = np.minimum(np.maximum(2 * c * z0 * (1 - d), 0.4), 2 * bend * z0**2 + 0.4)
    h = np.where(line, np.minimum(np.pi, np.sqrt(80 / bend)), np.sqrt(40 / steep)) / NODES
    y = (np.arange(NODES) + 0.5) * h[:, None]
    z0, line = z0[:, None], line[:, None]
    z = np.where(line, z0 + 1j * y, z0 * (1 + 1j * y) ** 2)
    turn = np.where(line, 1, 2 * z0 * (1 + 1j * y))
    c, t = c[:, None], t[:, None]
    peak = c * z0 + t * _log_g(z0, d)
    total = (np.exp(c * z + t * _log_g(z, d) - peak) * turn).real.sum(axis=1) * h / np.pi
    return peak[:, 0] + np.log(np.maximum(total, 1e-300))


def _few(c: np.ndarray, p: np.ndarray, rest: np.ndarray, odds: np.ndarray, d: float, random: np.random.Generator) -> np.ndarray:
    """A draw of the tables of each dish of at most EXACT customers."""
    out, order = np.empty(len(c), np.int64), np.argsort(c.astype(np.uint16), kind="stable")
    sizes, at = c[order], 0
    while at < len(c):
        width = int(min(2 ** np.ceil(np.log2(sizes[at])), len(odds) - 1))
        own = order[at : min(np.searchsorted(sizes, width, "right"), at + max(1, (1 << 18) // width))]
        at += len(own)
        new = np.log((THETA + d * (rest[own, None] + np.arange(width))) * p[own, None])
        weight = np.cumsum(new, axis=1) + odds[c[own], 1 : width + 1]
        total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        out[own] = 1 + (total[:, :-1] <= random.random((len(own), 1)) * total[:, -1:]).sum(axis=1)
    return out


def _many(
    c: np.ndarray, t: np.ndarray, p: np.ndarray, rest: np.ndarray, d: float, moves: int, random: np.random.Generator
) -> np.ndarray:
    """The tables of dishes of any size after ``moves`` proposals of a whole new count, each taken by Metropolis' rule.

    Proposals are logistic around the mode, so a count may go anywhere at once and few are turned down.
    """
    a, log_p = THETA / d + rest, np.log(p)
    mean = lambda z: c / _fall(z, d)
    slope = lambda z: _log_g(z, d) + log_p + np.log(1 + a / np.maximum(mean(z), 1e-280))
    z = _solve(slope, len(c))
    mode = np.clip(mean(z), 1, c)
    bend = (_log_g(z * 0.99, d) - _log_g(z * 1.01, d)) / np.maximum(mean(z * 1.01) - mean(z * 0.99), 1e-280)
    bend = np.where(mode > 1, bend, 0) + 1 / mode - 1 / (a + mode)
    scale = np.clip(0.65 / np.sqrt(bend), 1, c)

    def log_proposal(x: np.ndarray) -> np.ndarray:
        before, after = (np.abs(x - mode) - 0.5) / scale, (np.abs(x - mode) + 0.5) / scale
        return after + np.log(-np.expm1(-1 / scale)) - np.logaddexp(0, before) - np.logaddexp(0, after)

    def log_target(x: np.ndarray) -> np.ndarray:
        return log_tables(c, x, d) + _log_gamma(a + x) - _log_gamma(x + 1) + x * log_p

    own = t.astype(float)
    worth = log_target(own) - log_proposal(own)
    # only from 1 to c: what lies outside would be the same factor of every proposal
    least, most = (1 / (1 + np.exp(np.minimum((mode - x) / scale, 600))) for x in (0.5, c + 0.5))
    for _ in range(moves):
        u = np.clip(least + random.random(len(c)) * (most - least), 1e-15, 1 - 1e-15)
        to = np.clip(np.rint(mode + scale * np.log(u / (1 - u))), 1, c)
        other = log_target(to) - log_proposal(to)
        taken = np.log(random.random(len(c))) < other - worth
        own, worth = np.where(taken, to, own), np.where(taken, other, worth)
    return own.astype(np.int64)


def resample(
    c: np.ndarray, t: np.ndarray, parent: np.ndarray, tables: np.ndarray, odds: np.ndarray, discount: float,
    moves: int, random: np.random.Generator,
) -> np.ndarray:
    """Tables after all customers of each dish with c customers at t tables were seated again.

    parent: the dish's probability in the parent; tables: those of its restaurant, all dishes together. Up to EXACT
    customers the count is drawn from its distribution given the rest; beyond, ``moves`` proposals of a whole count.
    """
    t = np.minimum(np.maximum(t, 1), c)
    rest = np.maximum(tables - t, 0)
    few = np.flatnonzero((c > 1) & (c <= EXACT))  # one customer has one table
    many = np.flatnonzero(c > EXACT)
    t[few] = _few(c[few], parent[few], rest[few], odds, discount, random)
    for k in range(0, len(many), 1 << 16):
        own = many[k : k + (1 << 16)]
        t[own] = _many(c[own], t[own], parent[own], rest[own], discount, moves, random)
    return t


@dataclass
class Totals:
    """Tables of the restaurants of endings and above, customers of endings, and what the whole model shares."""

    customers: np.ndarray
    tables: np.ndarray
    parent_tables: np.ndarray
    root_tables: float
    discounts: tuple[float, float, float, float]
    words: int
    tokens: int

    @property
    def parent_customers(self) -> np.ndarray:
        return self.tables.reshape(PARENTS, -1).sum(axis=1)

    def root(self, c0: np.ndarray, t0: np.ndarray) -> np.ndarray:
        d = self.discounts[0]
        rest = (THETA + d * self.root_tables) / (self.words + 1)
        return (c0 - d * t0 + rest) / (THETA + self.parent_tables.sum())

    def middle(self, c1: np.ndarray, t1: np.ndarray, at: np.ndarray, p0: np.ndarray) -> np.ndarray:
        d = self.discounts[1]
        return (c1 - d * t1 + (THETA + d * self.parent_tables[at]) * p0) / (THETA + self.parent_customers[at])

    def leaf(self, c2: np.ndarray, t2: np.ndarray, at: np.ndarray, p1: np.ndarray) -> np.ndarray:
        d = self.discounts[2]
        return (c2 - d * t2 + (THETA + d * self.tables[at]) * p1) / (THETA + self.customers[at])

    def word(self, c3: np.ndarray, t3: np.ndarray, customers: np.ndarray, tables: np.ndarray, p2: np.ndarray) -> np.ndarray:
        """After a whole word, whose restaurant has so many customers and tables."""
        d = self.discounts[3]
        return (c3 - d * t3 + (THETA + d * tables) * p2) / (THETA + customers)


class Bucket:
    """A bucket's words with their contexts, the endings of those, and the endings' parents."""

    def __init__(self, row: dict):
        self.row = row
        self.words = _ints(row["words"], "u8")
        self.pair_word = np.repeat(np.arange(len(self.words)), _ints(row["pairs"], "u4"))
        self.n = _ints(row["c"], "u8").astype(np.int64)
        #: the bucket's own contexts, and that of each pair
        self.own, self.at = _ints(row["own"], "u8"), _ints(row["context"], "u4").astype(np.int64)
        # contexts of a word are in order, so those of one ending or parent stand together
        ending = (self.own >> np.uint64(48)).astype(np.int64)[self.at]
        self.keys, self.into = self._runs((self.pair_word << 16) | ending)
        self.word, self.context = self.keys >> 16, self.keys & 0xFFFF
        self.parents, self.up = self._runs(self.keys >> 8)
        self.parent_word, self.parent = self.parents >> 8, self.parents & 0xFF

    @staticmethod
    def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = _first_of(ordered)
        return ordered[first], np.repeat(np.arange(len(first)), np.diff(first, append=len(ordered)))

    @property
    def c(self) -> np.ndarray:
        """Customers of the endings in the last sample: tables of whole words."""
        return self.endings(self.seats(-1))

    def seats(self, k: int) -> np.ndarray:
        return _ints(self.row["t3"][k], "u4").astype(np.int64)

    def sample(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(_ints(self.row[x][k], "u4").astype(np.int64) for x in ("t2", "t1", "t0"))

    def start(self, discounts: tuple[float, ...]) -> tuple[np.ndarray, ...]:
        """About c to the power of the discount tables for c customers, level by level."""
        few = lambda c, d: np.minimum(c, np.maximum(1, np.floor(c**d))).astype(np.int64)
        t3 = few(self.n, discounts[3])
        t2 = few(self.endings(t3), discounts[2])
        t1 = few(self.below(t2), discounts[1])
        return t3, t2, t1, few(self.root_customers(t1), discounts[0])

    def endings(self, t3: np.ndarray) -> np.ndarray:
        return np.bincount(self.into, t3, len(self.keys)).astype(np.int64)

    def below(self, t2: np.ndarray) -> np.ndarray:
        return np.bincount(self.up, t2, len(self.parents)).astype(np.int64)

    def root_customers(self, t1: np.ndarray) -> np.ndarray:
        return np.bincount(self.parent_word, t1, len(self.words)).astype(np.int64)

    def by_context(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, x, len(self.own)).astype(np.uint64)

    def sums(self, t3: np.ndarray, t2: np.ndarray, t1: np.ndarray, t0: np.ndarray) -> dict:
        """The bucket's part of all totals but those of whole words, and how many dishes have one or two customers, per level."""
        own = np.unique(self.context)
        place = np.searchsorted(own, self.context)
        c2, c1 = self.endings(t3), self.below(t2)
        levels = (self.root_customers(t1), c1, c2, self.n)
        return {
            "at": own.tolist(),
            "customers": np.bincount(place, c2, len(own)).astype(np.int64).tolist(),
            "tables": np.bincount(place, t2, len(own)).astype(np.int64).tolist(),
            "parent_tables": np.bincount(self.parent, t1, PARENTS).astype(np.int64).tolist(),
            "scalars": [int(t0.sum()), len(self.words), int(self.n.sum())]
            + [int((c == k).sum()) for c in levels for k in (1, 2)],
        }


SUMS = "at array<int>, customers array<long>, tables array<long>, parent_tables array<long>, scalars array<long>"


def _first(discounts: tuple[float, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                b = Bucket(row)
                yield _packed(row, b, b.start(discounts))

    return run


def _packed(row: dict, bucket: Bucket, t: tuple[np.ndarray, ...], keep: bool = False) -> pa.RecordBatch:
    """The state with the sample ``t``, after those kept or in place of the last."""
    out = dict(row)
    for name, x in zip(("t3", "t2", "t1", "t0"), t, strict=True):
        out[name] = (row[name] if keep else row[name][:-1]) + [_bytes(x.astype(np.uint32))]
    out |= bucket.sums(*t)
    return pa.RecordBatch.from_pylist([out], _WITH_SUMS)


_WITH_SUMS = pa.schema(
    [*_STATE, ("at", pa.list_(pa.int32()))]
    + [(x, pa.list_(pa.int64())) for x in ("customers", "tables", "parent_tables", "scalars")]
)


ASKED = "home int, bucket int, at binary, customers binary, tables array<binary>"
_ASKED = pa.schema(
    [("home", pa.int32()), ("bucket", pa.int32()), ("at", pa.binary()), ("customers", pa.binary())]
    + [("tables", pa.list_(pa.binary()))]
)


def _ask(homes: int, last: bool):
    """Each bucket's part of the totals of its own contexts, for their homes; of the last sample or of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                b = Bucket(row)
                order, cut = _dealt(b.own, homes)
                own, customers = b.own[order], b.by_context(b.n)[order]
                tables = [b.by_context(b.seats(k))[order] for k in ([-1] if last else range(len(row["t3"])))]
                found = []
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    part = slice(cut[k], cut[k + 1])
                    found.append(
                        {
                            "home": k, "bucket": row["bucket"], "at": _bytes(own[part]),
                            "customers": _bytes(customers[part]), "tables": [_bytes(t[part]) for t in tables],
                        }
                    )
                yield pa.RecordBatch.from_pylist(found, _ASKED)

    return run


def _dealt(own: np.ndarray, homes: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of contexts by home, and where each home begins in it."""
    home = _home(own, homes).astype(np.min_scalar_type(homes))
    order = np.argsort(home, kind="stable")
    return order, np.searchsorted(home[order], np.arange(homes + 1))


def _answer(group: pa.Table) -> pa.Table:
    """To every bucket the totals of the contexts it asked for; those of all the home's contexts under bucket -1."""
    rows = group.to_pylist()
    at, back = np.unique(np.concatenate([_ints(r["at"], "u8") for r in rows]), return_inverse=True)
    add = lambda parts: np.bincount(back, np.concatenate(parts), len(at)).astype(np.uint64)
    customers = add([_ints(r["customers"], "u8") for r in rows])
    tables = [add([_ints(r["tables"][k], "u8") for r in rows]) for k in range(len(rows[0]["tables"]))]
    home = rows[0]["home"]
    out = [{"home": home, "bucket": -1, "at": _bytes(at), "customers": _bytes(customers), "tables": [_bytes(t) for t in tables]}]
    upto = np.cumsum([int.from_bytes(r["at"][:8], "little") // 8 for r in rows])
    for r, mine in zip(rows, np.split(back, upto[:-1]), strict=True):
        told = {"customers": _bytes(customers[mine]), "tables": [_bytes(t[mine]) for t in tables]}
        out.append({"home": home, "bucket": r["bucket"], "at": None, **told})
    return pa.Table.from_pylist(out, _ASKED)


def _heard(own: np.ndarray, told: list[dict], homes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Customers and tables of a bucket's own contexts, from what the homes have answered."""
    order, _ = _dealt(own, homes)
    told = sorted(told, key=lambda r: r["home"])

    def placed(parts: list[bytes]) -> np.ndarray:
        out = np.empty(len(own), np.int64)
        out[order] = np.concatenate([_ints(x, "u8") for x in parts])
        return out

    return placed([r["customers"] for r in told]), [placed([r["tables"][k] for r in told]) for k in range(len(told[0]["tables"]))]


def _asked(state: DataFrame, homes: int, last: bool) -> DataFrame:
    return state.mapInArrow(_ask(homes, last), ASKED).groupBy("home").applyInArrow(_answer, ASKED)


def _sweep(totals: Totals, moves: int, seed: int, keep: bool, homes: int):
    """One visit to all dishes of a bucket, the lowest level first; totals are those of the last visit."""

    def run(state: pa.Table, told: pa.Table) -> pa.Table:
        odds = [seating_odds(d) for d in totals.discounts]
        d0, d1, d2, d3 = totals.discounts
        row = state.to_pylist()[0]
        b, random = Bucket(row), np.random.default_rng([seed, row["bucket"]])
        t3, (t2, t1, t0) = b.seats(-1), b.sample(-1)
        p0 = totals.root(b.root_customers(t1), t0)
        p1 = totals.middle(b.below(t2), t1, b.parent, p0[b.parent_word])
        p2 = totals.leaf(b.endings(t3), t2, b.context, p1[b.up])
        tables = _heard(b.own, told.to_pylist(), homes)[1][0]
        t3 = resample(b.n, t3, p2[b.into], tables[b.at], odds[3], d3, moves, random)
        t2 = resample(b.endings(t3), t2, p1[b.up], totals.tables[b.context], odds[2], d2, moves, random)
        tables = totals.parent_tables[b.parent]
        t1 = resample(b.below(t2), t1, p0[b.parent_word], tables, odds[1], d1, moves, random)
        base = np.full(len(t0), 1 / (totals.words + 1))
        tables = np.full(len(t0), totals.root_tables)
        t0 = resample(b.root_customers(t1), t0, base, tables, odds[0], d0, moves, random)
        return pa.Table.from_batches([_packed(row, b, (t3, t2, t1, t0), keep)])

    return run


def _with_contexts(homes: int):
    """A bucket's state with the totals of its own contexts, in their order."""

    def run(state: pa.Table, told: pa.Table) -> pa.Table:
        row = state.to_pylist()[0]
        customers, tables = _heard(_ints(row["own"], "u8"), told.to_pylist(), homes)
        row |= {"after": _bytes(customers), "after_tables": [_bytes(t) for t in tables]}
        return pa.Table.from_pylist([row], _MODEL)

    return run


MODEL = f"{STATE}, after binary, after_tables array<binary>"
_MODEL = pa.schema([*_STATE, ("after", pa.binary()), ("after_tables", pa.list_(pa.binary()))])


def _totals(state: DataFrame) -> Totals:
    """Sums over the buckets; 65,536 endings, 256 parents and eleven numbers at most."""
    customers, tables, parents = np.zeros(CONTEXTS), np.zeros(CONTEXTS), np.zeros(PARENTS)
    each = state.select(F.explode(F.arrays_zip("at", "customers", "tables")).alias("x"))
    for r in each.groupBy("x.at").agg(F.sum("x.customers").alias("c"), F.sum("x.tables").alias("t")).collect():
        customers[r["at"]], tables[r["at"]] = r.c, r.t
    for r in state.select(F.posexplode("parent_tables")).groupBy("pos").agg(F.sum("col").alias("t")).collect():
        parents[r.pos] = r.t
    rows = state.select(F.posexplode("scalars")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    s = [x for _, x in sorted((r.pos, r.n) for r in rows)] or [0] * 11
    # the share of dishes with one customer tells the discount
    rates = tuple(min(0.95, max(0.05, s[k] / max(1, s[k] + 2 * s[k + 1]))) for k in (3, 5, 7, 9))
    return Totals(customers, tables, parents, float(s[0]), rates, int(s[1]), int(s[2]))


@dataclass
class Model:
    state: DataFrame
    samples: list[Totals]
    buckets: int
    #: totals of all contexts by home
    contexts: DataFrame


def fit(
    docs: DataFrame, text: str = "text", burn: int = BURN, moves: int = MOVES, samples: int = SAMPLES,
    bucket_bytes: int = BUCKET,
) -> Model:
    """Counts over all of ``docs`` and ``samples`` seatings; a null text is empty and has its end only."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = int(max(1, -(-size // bucket_bytes)))
    homes = _homes(buckets)
    used = rows.mapInArrow(_usage(buckets, False), USAGE).select("bucket", "words", "pairs", "context", "times")
    state = materialise(used.groupBy("bucket").applyInArrow(_merge, STATE), "counts")
    schema, names = f"{STATE}, {SUMS}", [f.split()[0] for f in STATE.split(", ")]
    # a first seating tells the discounts, a second one uses them
    told = materialise(state.mapInArrow(_first((0.5,) * 4), schema).drop(*names), "sums")
    discounts = _totals(told).discounts
    seated = materialise(state.mapInArrow(_first(discounts), schema), "seating")
    totals = _totals(seated)
    discounts = totals.discounts
    discard(state, told)
    found = []
    for k in range(samples):
        step = _sweep(totals, moves if k else burn, k, k > 0, homes)
        last = seated.select(*names)
        asked = _asked(last, homes, True).filter("bucket >= 0")
        before, seated = seated, materialise(last.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(step, schema), "seating")
        latest = _totals(seated)
        latest.discounts = discounts
        totals = latest
        found.append(latest)
        discard(before)
    last = seated.select(*names)
    contexts = materialise(_asked(last, homes, False), "contexts")
    told = contexts.filter("bucket >= 0")
    model = last.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(_with_contexts(homes), MODEL)
    model = materialise(model, "model")
    discard(seated)
    return Model(model, found, buckets, contexts.filter("bucket < 0"))


def _scores(model_samples: list[Totals], homes: int):
    """A bucket's part of the scores of each block's texts, and what must go on to the homes of contexts."""

    def run(used: pa.Table, state: pa.Table) -> pa.Table:
        totals = model_samples[0]
        held = state.to_pylist()
        b = Bucket(held[0]) if held else None
        out, sent, theirs, some = [], [], [], len(model_samples)
        none = (np.zeros(0), np.zeros(0))
        root, middle, leaf, tables = ([none] * some for _ in range(4))
        if b is not None:
            counts = np.bincount(b.pair_word, b.n, len(b.words))
            customers = _ints(held[0]["after"], "u8")
            tables = [_ints(x, "u8") for x in held[0]["after_tables"]]
            pairs, seen = b.pair_word * len(b.own) + b.at, np.zeros(len(b.n))
            for k, s in enumerate(model_samples):
                t3, (t2, t1, t0) = b.seats(k), b.sample(k)
                root[k], middle[k], leaf[k] = (b.root_customers(t1), t0), (b.below(t2), t1), (b.endings(t3), t2)
                p0 = s.root(*root[k])
                p1 = s.middle(*middle[k], b.parent, p0[b.parent_word])
                p2 = s.leaf(*leaf[k], b.context, p1[b.up])
                seen += s.word(b.n, t3, customers[b.at], tables[k][b.at], p2[b.into])
            seen = np.log10(seen / some)
        floor = totals.tokens + 0.1 * (totals.words + 1)
        pick = lambda pair, i, ok: tuple(np.where(ok, x[i], 0) if len(x) else np.zeros(len(i)) for x in pair)
        for r in _each(used):
            words, per = _ints(r["words"], "u8"), _ints(r["pairs"], "u4")
            context, times = _ints(r["context"], "u8"), _ints(r["times"], "u4")
            at = np.repeat(np.arange(len(words)), per)
            where, known = _find(b.words if b else np.zeros(0, "u8"), words)
            mine, here = _find(b.own if b else np.zeros(0, "u8"), context)
            pair, has_pair = _find(pairs if b else np.zeros(0, np.int64), where[at] * (len(b.own) if b else 1) + mine)
            has_pair &= known[at] & here
            # words that were never seen after their context
            new = np.flatnonzero(~has_pair)
            of, ending = at[new], (context[new] >> np.uint64(48)).astype(np.int64)
            place, has_parent = _find(b.parents if b else np.zeros(0, np.int64), (where[of] << 8) | (ending >> 8))
            spot, has_ending = _find(b.keys if b else np.zeros(0, np.int64), (where[of] << 16) | ending)
            has_parent &= known[of]
            has_ending &= known[of]
            p, away = np.zeros(len(new)), np.flatnonzero(~here[new])
            far, on = new[away], []
            for k, s in enumerate(model_samples):
                p0 = s.root(*pick(root[k], where, known))
                p1 = s.middle(*pick(middle[k], place, has_parent), ending >> 8, p0[of])
                p2 = s.leaf(*pick(leaf[k], spot, has_ending), ending, p1)
                p += s.word(0, 0, *pick((customers, tables[k]) if b else none, mine[new], here[new]), p2)
                on.append(p2[away])
            log = np.where(has_pair, seen[pair], 0) if b else np.zeros(len(context))
            log[new] = np.log10(p / some)
            log[far] = 0
            c = np.where(known, counts[where], 0) if b else np.zeros(len(words))
            base = np.log10((c + 0.1) / floor)
            docs = _ints(r["docs"], "u2")
            rows = int(docs.max()) + 1 if len(docs) else 0
            sums = [np.bincount(docs, np.repeat(x, times), rows) for x in (log, base[at], known[at])]
            told = np.flatnonzero(np.bincount(docs, minlength=rows))
            out.append(
                {
                    "block": r["block"], "ids": r["ids"], "held": r["held"], "tokens": r["tokens"],
                    "docs": _bytes(told.astype(np.uint16)), "score": _bytes(sums[0][told]),
                    "base": _bytes(sums[1][told]), "known": _bytes(sums[2][told].astype(np.uint32)),
                }
            )
            if len(far):
                begin = np.cumsum(times, dtype=np.int64) - times
                owner, step = ragged(times[far].astype(np.int64))
                sent.append((np.full(len(far), r["block"]), context[far], times[far], on))
                theirs.append(docs[begin[far][owner] + step])
        if sent:
            block, context, times = (np.concatenate([x[i] for x in sent]) for i in range(3))
            on = [np.concatenate([x[3][k] for x in sent]) for k in range(some)]
            docs, begin = np.concatenate(theirs), np.cumsum(times, dtype=np.int64) - times
            order, cut = _dealt(context, homes)
            for k in np.flatnonzero(np.diff(cut)).tolist():
                own = order[cut[k] : cut[k + 1]]
                owner, step = ragged(times[own].astype(np.int64))
                out.append(
                    {
                        "home": k, "blocks": _bytes(block[own]), "context": _bytes(context[own]), "times": _bytes(times[own]),
                        "docs": _bytes(docs[begin[own][owner] + step]), "p": [_bytes(x[own]) for x in on],
                    }
                )
        return pa.Table.from_pylist(out, _PARTS)

    return run


def _sent_on(model_samples: list[Totals]):
    """The scores of words whose context was not in their bucket, at the home of the context."""

    def run(parts: pa.Table, contexts: pa.Table) -> pa.Table:
        held = contexts.to_pylist()
        at = _ints(held[0]["at"], "u8") if held else np.zeros(0, "u8")
        none = np.zeros(0, "u8")
        customers = _ints(held[0]["customers"], "u8") if held else none
        tables = [_ints(x, "u8") for x in held[0]["tables"]] if held else [none] * len(model_samples)
        rows = list(_each(parts))
        if not rows:
            return pa.Table.from_pylist([], _PARTS)
        every = lambda name, kind: np.concatenate([_ints(r[name], kind) for r in rows])
        block, times, docs = every("blocks", "i8"), every("times", "u4").astype(np.int64), every("docs", "u2")
        where, known = _find(at, every("context", "u8"))
        pick = lambda x: np.where(known, x[where], 0) if len(x) else np.zeros(len(where))
        p = np.zeros(len(where))
        for k, (s, t) in enumerate(zip(model_samples, tables, strict=True)):
            p += s.word(0, 0, pick(customers), pick(t), np.concatenate([_ints(r["p"][k], "f8") for r in rows]))
        # in an order of the values alone, so that sums don't depend on that of the rows
        block, log = np.repeat(block, times), np.repeat(np.log10(p / len(model_samples)), times)
        order = np.lexsort((log, docs, block))
        block, docs, log = block[order], docs[order], log[order]
        text = _first_of((block << 16) | docs)
        sums, block, docs = np.add.reduceat(log, text), block[text], docs[text]
        out = []
        for own in np.split(np.arange(len(text)), _first_of(block)[1:]):
            none = np.zeros(len(own))
            out.append(
                {
                    "block": int(block[own[0]]), "docs": _bytes(docs[own]), "score": _bytes(sums[own]), "base": _bytes(none),
                    "known": _bytes(none.astype(np.uint32)),
                }
            )
        return pa.Table.from_pylist(out, _PARTS)

    return run


PARTS = (
    "block long, ids array<long>, held array<boolean>, tokens array<long>, docs binary, score binary, base binary,"
    " known binary, home int, blocks binary, context binary, times binary, p array<binary>"
)
_PARTS = pa.schema(
    [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64()))]
    + [(x, pa.binary()) for x in ("docs", "score", "base", "known")]
    + [("home", pa.int32()), ("blocks", pa.binary()), ("context", pa.binary()), ("times", pa.binary()), ("p", pa.list_(pa.binary()))]
)


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each is, and whether it is there at all."""
    if not len(sorted_):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return at, sorted_[at] == wanted


def _gather(parts: pa.Table) -> pa.Table:
    """The texts of a block with the sums over all buckets."""
    rows = parts.to_pylist()
    home = next(r for r in rows if r["ids"] is not None)
    n = len(home["ids"])
    sums = {"score": np.zeros(n), "base": np.zeros(n), "known": np.zeros(n)}
    for r in sorted(rows, key=lambda r: r["docs"]):
        docs = _ints(r["docs"], "u2")
        for name, kind in (("score", "f8"), ("base", "f8"), ("known", "u4")):
            sums[name][docs] += _ints(r[name], kind)
    return pa.table(
        {
            "doc_id": pa.array(home["ids"], pa.int64()), "held_out": pa.array(home["held"], pa.bool_()),
            "n_tokens": pa.array(home["tokens"], pa.int64()), "n_known": pa.array(sums["known"].astype(np.int64)),
            "base_score": sums["base"], "score": sums["score"],
        }
    )


def score(docs: DataFrame, model: Model, text: str = "text", doc: str = "doc_id", held: str = "held_out") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    ``docs`` has doc_id (long), held_out (boolean, carried along) and the text; other columns are left out. A null or
    empty text has one token, its end. Repeated rows are scored one by one, null ids are kept, an empty table
    gives no rows. With nothing to learn from, every word has the probability of the base.
    """
    rows = docs.select(
        F.col(doc).cast("long").alias("doc_id"), F.col(held).alias("held"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    homes, rounds = _homes(model.buckets), min(ROUNDS, -(-model.buckets // PER_ROUND))
    found = []
    for k in range(rounds):
        # a round's shuffles are gone before the next one's
        share = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(rounds).cast("long")) == k
        used = (rows.filter(share) if rounds > 1 else rows).mapInArrow(_usage(model.buckets, True), USAGE)
        met = used.groupBy("bucket").cogroup(model.state.groupBy("bucket"))
        parts = materialise(met.applyInArrow(_scores(model.samples, homes), PARTS), "parts")
        far = parts.filter("home IS NOT NULL").groupBy("home").cogroup(model.contexts.groupBy("home"))
        every = parts.filter("home IS NULL").unionByName(far.applyInArrow(_sent_on(model.samples), PARTS))
        schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
        found.append(materialise(every.groupBy("block").applyInArrow(_gather, schema), "scores"))
        discard(parts)
    scores = reduce(DataFrame.unionByName, found)
    return scores.withColumn("train_tokens", F.lit(model.samples[0].tokens).cast("long"))


def perplexity(score: str = "score", n_tokens: str = "n_tokens"):
    """Of a text from its score."""
    return F.pow(F.lit(10.0), -F.col(score) / F.col(n_tokens))
