"""Language identification by cross-parsing against suffix automata.

A text is parsed into the longest phrases that occur in a language's sample; a suffix automaton of the sample
gives each next state by one lookup. The language whose sample needs the fewest phrases, each counted with the bits
that name a place in the sample, is the one that the text is written in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.arrays import buffers, pieces, ragged

#: Characters of a language's sample, texts it is drawn from, characters taken of one of them.
SAMPLE_CHARS, SAMPLE_TEXTS, EXCERPT = 20_000, 200, 500
#: Symbols: 0 pads, 1 is any run of non-letters, the others are letters.
LETTERS = 62
#: Parsing starts afresh after so many symbols, so that long texts are parsed side by side.
LANE = 1024
#: Bytes of text that are looked at once.
PIECE = 1 << 19


def symbols(samples: list[str]) -> np.ndarray:
    """The symbol of each code point of the basic plane: the most frequent letters of the samples have their
    own, other letters share one with a frequent letter; lower and upper case are one."""
    lowered = [chr(c).lower() if not 0xD800 <= c < 0xE000 else " " for c in range(65536)]
    seen: dict[str, int] = {}
    for text in samples:
        for c in text.lower():
            if c.isalpha():
                seen[c] = seen.get(c, 0) + 1
    top = sorted(seen, key=lambda c: (-seen[c], c))[:LETTERS]
    own = {c: k + 2 for k, c in enumerate(top)}
    of = [own.get(x, ord(x[0]) % LETTERS + 2) if x[0].isalpha() else 1 for x in lowered]
    return np.array(of, np.uint8)


def encode(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as symbols, each run of non-letters as one; where each text begins; whether it has a letter."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    coded = table[np.minimum(points, 0xFFFF)]
    astral = np.flatnonzero(points > 0xFFFF)
    if astral.size:
        coded[astral] = [ord(chr(c).lower()[0]) % LETTERS + 2 if chr(c).isalpha() else 1 for c in points[astral]]
    before = np.concatenate([[0], coded[:-1]])
    starts = heads[:-1][heads[:-1] < len(coded)]
    before[starts] = 0
    keep = (coded != 1) | (before != 1)
    letters = np.concatenate([[0], np.cumsum(coded > 1)])[heads]
    kept = np.concatenate([[0], np.cumsum(keep)])[heads]
    return coded[keep], kept, np.diff(letters) > 0


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the states of the automaton of all substrings; state 0 is the start."""
    longest, link, following = [0], [-1], [{}]
    last = 0
    for c in text.tolist():
        state = len(longest)
        longest.append(longest[last] + 1)
        link.append(0)
        following.append({})
        at = last
        while at >= 0 and c not in following[at]:
            following[at][c] = state
            at = link[at]
        if at >= 0:
            held = following[at][c]
            if longest[at] + 1 == longest[held]:
                link[state] = held
            else:
                copy = len(longest)
                longest.append(longest[at] + 1)
                link.append(link[held])
                following.append(dict(following[held]))
                while at >= 0 and following[at].get(c) == held:
                    following[at][c] = copy
                    at = link[at]
                link[held] = link[state] = copy
        last = state
    return following


class Parser:
    """The automata of all languages in one table of next states; 0 is none."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        self.table = symbols([samples[n] for n in self.names])
        self.width = LETTERS + 2
        rows, self.roots, self.bits = [np.zeros((1, self.width), np.int32)], [], []
        base = 1
        for name in self.names:
            raw = np.frombuffer(samples[name].encode(), np.uint8)
            coded, _, _ = encode(raw, np.array([0, len(raw)]), self.table)
            states = suffix_automaton(coded)
            own = np.zeros((len(states), self.width), np.int32)
            for k, arcs in enumerate(states):
                own[k, list(arcs)] = [base + t for t in arcs.values()]
            rows.append(own)
            self.roots.append(base)
            self.bits.append(np.log2(max(2, len(coded))))
            base += len(states)
        self.next = np.concatenate(rows).ravel()
        roots = np.array(self.roots, np.int32)
        # after a failure the symbol that failed begins the next phrase, alone if the sample lacks it
        begun = self.next.reshape(-1, self.width)[roots]
        self.unseen = begun == 0
        self.begun = np.where(self.unseen, roots[:, None], begun)

    def phrases(self, coded: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Phrases that each text (row) takes in each language (column)."""
        size = np.diff(heads)
        owner, part = ragged(-(-size // LANE))
        start = heads[owner] + part * LANE
        length = np.minimum(size[owner] - part * LANE, LANE)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        langs = np.arange(len(self.names))[:, None]
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(owner), axis=1)
        count = np.ones(state.shape, np.int32)
        live = len(owner) - np.searchsorted(length[::-1], np.arange(LANE), "right")
        for k, m in enumerate(live.tolist()):
            if not m:
                break
            c = coded[start[:m] + k].astype(np.int64)
            to = self.next[state[:, :m] * self.width + c]
            lane, at = np.nonzero(to == 0)
            if len(lane):
                failed = c[at]
                to[lane, at] = self.begun[lane, failed]
                count[lane, at] += 1 + self.unseen[lane, failed]
            state[:, :m] = to
        out = np.zeros((len(size), len(self.names)))
        for lang in langs.ravel():
            out[:, lang] = np.bincount(owner, count[lang], len(size))
        return out

    def __call__(self, column: pa.Array) -> tuple[list[str | None], np.ndarray]:
        """The language of each text, "und" without letters, and how far the second is behind, from 0 to 1."""
        coded, heads, letters = encode(*buffers(column), self.table)
        bits = self.phrases(coded, heads) * np.array(self.bits)
        best = bits.argmin(axis=1)
        ranked = np.sort(bits, axis=1)
        second = ranked[:, 1] if len(self.names) > 1 else np.full(len(best), np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(np.isinf(second), 1.0, 1 - ranked[:, 0] / np.maximum(second, 1))
        names = [self.names[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, score, 0.0)


def learn(
    labelled: DataFrame, sample_chars: int = SAMPLE_CHARS, sample_texts: int = SAMPLE_TEXTS, excerpt: int = EXCERPT
) -> dict[str, str]:
    """A sample per language from (text, lang): excerpts of different texts, chosen and ordered by hash.

    Only the samples reach the driver: about ``sample_texts`` excerpts per language whatever the table's size,
    of which at most ``sample_chars`` characters are kept. Copies count once. Null texts or languages, and
    texts without letters, take no part.
    """
    spark = labelled.sparkSession
    rows = labelled.filter("lang is not null and text is not null").withColumn("h", F.xxhash64("text"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()  # one row per language
    if not sizes:
        return {}
    share = 1 << 30
    # from an Arrow table: a list would start Python workers on the executors only to be pickled again
    below = [min(share, -(-share * sample_texts // max(1, r.n))) for r in sizes]
    drawn = pa.table([pa.array([r.lang for r in sizes], pa.string()), pa.array(below, pa.int64())], ["lang", "below"])
    drawn = spark.createDataFrame(drawn)
    picked = rows.join(F.broadcast(drawn), "lang").filter(F.pmod("h", F.lit(share)) < F.col("below"))
    # an excerpt begins anywhere in its text
    last = F.greatest(F.length("text") - excerpt, F.lit(0)).cast("long")
    begin = (F.pmod(F.xxhash64("h"), last + 1) + 1).cast("int")
    picked = picked.select("lang", "h", F.substring("text", begin, F.lit(excerpt)).alias("excerpt"))
    found: dict[str, str] = {}
    for r in picked.groupBy("lang", "h").agg(F.first("excerpt").alias("excerpt")).orderBy("lang", "h").collect():
        before = found.get(r.lang, "")
        if len(before) < sample_chars and any(map(str.isalpha, r.excerpt)):
            found[r.lang] = (before + " " + r.excerpt)[:sample_chars]
    return found


def identify(docs: DataFrame, samples: dict[str, str], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and lang_score.

    ``und`` with score 0 for a null text, an empty one and one without letters (and for all if no language was
    learned). Every text is parsed whole. Ties go to the language that sorts first. Rows are neither moved
    nor dropped, repeated rows are told alike, columns named like the new ones are replaced. Each
    worker holds about 10 MB per language.
    """
    kept = [f.name for f in docs.schema.fields if f.name not in ("lang_pred", "lang_score")]
    docs = docs.select(*kept)
    if not samples:
        return docs.withColumns({"lang_pred": F.lit("und"), "lang_score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(Parser(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in pieces(batches, text, PIECE):
            names, score = parser(batch.column(text))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "lang_score"])

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("lang_score", "double")
    return docs.mapInArrow(run, schema)
