"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

The most frequent words of a corpus and their ids are compiled into an automaton that shares prefixes and
suffixes. Every arc carries the number of words it steps over, so the numbers along a word's path add up to
the word's place in the sorted lexicon, which is where its ids are. The automaton is one flat file that
every worker maps into memory. Words it doesn't have are merged by rank, so results never depend on it.
"""

from __future__ import annotations

import json
import mmap
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.arrays import pieces
from reviewlens.sources.scratch import materialise

#: Words in the automaton: a bound for what is broadcast, not for what is encoded exactly.
LEXICON_WORDS = 65_536
#: Words a worker remembers; it works out the others each time.
MEMO = 200_000
#: Texts of these characters need no Unicode tables: ASCII and the precomposed Latin letters.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-įı-ſ]*")
_LETTER = "a-zß-öø-ſ"
#: How the vocabulary's own pattern cuts lower-cased texts of those characters.
PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Ranks, ids and special tokens of a word-end BPE file, and how texts fall into words."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"])
        self.ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}
        self.end = model["end_of_word_suffix"]
        self.letters = byte_letters()
        self.bytes = {c: b for b, c in enumerate(self.letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        library = Tokenizer.from_str(raw.decode())
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if PLAIN.fullmatch(text):
            return PLAIN_WORDS.findall(text.lower())
        back = self.bytes
        return [bytes(back[c] for c in w).decode() for w, _ in self.split(self.normalize(text))]

    def segments(self, text: str) -> list[str]:
        """Words and special tokens in order; special tokens are found in the raw text, as the library does."""
        if not any(map(text.__contains__, self.special)):
            return self.words(text)
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out += [part] if k % 2 else self.words(part)
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of a word: the neighbours of lowest rank merge first, the leftmost of equals."""
        if word in self.special:
            return [self.special[word]]
        parts = [self.letters[b] for b in word.encode()]
        parts[-1] += self.end
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(p, none) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = get((parts[k - 1], parts[k]), none)
            if k < len(ranks):
                ranks[k] = get((parts[k], parts[k + 1]), none)
        return [self.ids[p] for p in parts if p in self.ids]


def compile_lexicon(entries: Iterable[tuple[str, list[int]]]) -> bytes:
    """The transducer of distinct words as one flat file.

    Words enter in byte order; a state is final once the next word leaves it, and is then replaced by an
    equal one seen before. Layout, all little-endian 32-bit: states, arcs, words; per state its first arc,
    whether a word ends there; per arc its target and the words it steps over; per word where its
    ids begin; ids; then a byte per arc, its label.
    """
    entries = sorted((w.encode(), ids) for w, ids in entries)
    states: list[tuple[bool, list[list]]] = [(False, [])]  # root; arcs are [label, target]
    register: dict[tuple, int] = {}
    path, last = [0], b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            final, arcs = states[state]
            same = register.setdefault((final, tuple(map(tuple, arcs))), state)
            if same != state:
                states[path[-1]][1][-1][1] = same

    for word, _ in entries:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        for b in word[shared:]:
            states.append((False, []))
            states[path[-1]][1].append([b, len(states) - 1])
            path.append(len(states) - 1)
        states[path[-1]] = (True, states[path[-1]][1])
        last = word
    close(0)
    # number what is still reachable, and count the words below each state
    order, number, count = [0], {0: 0}, {}
    for state in order:
        for _, target in states[state][1]:
            if target not in number:
                number[target] = len(order)
                order.append(target)
    todo = [0]
    while todo:
        final, arcs = states[todo[-1]]
        below = [t for _, t in arcs if t not in count]
        if below:
            todo += below
        else:
            state = todo.pop()
            count[state] = final + sum(count[t] for _, t in arcs)
    first, finals, targets, steps, labels = [], [], [], [], bytearray()
    for state in order:
        final, arcs = states[state]
        first.append(len(targets))
        finals.append(int(final))
        passed = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(number[target])
            steps.append(passed)
            passed += count[target]
    first.append(len(targets))
    begin, ids = [0], []
    for _, own in entries:
        ids += own
        begin.append(len(ids))
    ints = [len(order), len(targets), len(entries), *first, *finals, *targets, *steps, *begin, *ids]
    return struct.pack(f"<{len(ints)}I", *ints) + bytes(labels)


class Lexicon:
    """A compiled lexicon, mapped into memory from a file that has no name and goes with the process."""

    def __init__(self, flat: bytes):
        file = tempfile.TemporaryFile()  # noqa: SIM115  lives as long as the mapping
        file.write(flat)
        file.flush()
        self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n, arcs, words = struct.unpack_from("<3I", flat)
        whole = memoryview(self.map)
        size = len(flat) - arcs
        ints = whole[:size].cast("I")
        at = 3
        self.first, at = ints[at : at + n + 1], at + n + 1
        self.final, at = ints[at : at + n], at + n
        self.target, at = ints[at : at + arcs], at + arcs
        self.steps, at = ints[at : at + arcs], at + arcs
        self.begin, at = ints[at : at + words + 1], at + words + 1
        self.ids = ints[at:]
        self.labels = size

    def find(self, word: bytes) -> list[int] | None:
        state = place = 0
        for k in range(len(word)):
            low = self.labels + self.first[state]
            arc = self.map.find(word[k : k + 1], low, self.labels + self.first[state + 1])
            if arc < 0:
                return None
            arc -= self.labels
            place += self.steps[arc]
            state = self.target[arc]
        if not self.final[state]:
            return None
        return list(self.ids[self.begin[place] : self.begin[place + 1]])


def frequent_words(docs: DataFrame, vocabulary: bytes, text: str = "text", words: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the most frequent words of all texts, at most ``words`` of them.

    Words are counted in the tasks before the shuffle. Frequencies fall into classes a hundredth of a power of e wide;
    the classes from the top that hold at most ``words`` words are taken whole, so only the class sizes and the
    bounded lexicon reach the driver.
    """

    shared = docs.sparkSession.sparkContext.broadcast(Shared(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = shared.value.vocabulary.segments
        for batch in pieces(batches, "text", 16 << 20):
            found: Counter = Counter()
            for x in batch.column("text").to_pylist():
                found.update(split(x or ""))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"]
            )

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    level = F.floor(F.log("n") * 100).cast("int")
    counted = materialise(counted.select("word", level.alias("level")), "words")
    sizes = counted.groupBy("level").agg(F.count("*").alias("n")).collect()  # a few thousand classes
    room, lowest = words, None
    for r in sorted(sizes, key=lambda r: -r.level):
        room -= r.n
        if room < 0:
            break
        lowest = r.level
    top = counted.filter(F.col("level") >= (lowest if lowest is not None else 1 << 30)).select("word")
    merge = _vocabulary(vocabulary).merge
    return compile_lexicon((r.word, merge(r.word)) for r in top.collect())


class Encoder:
    """Encodes and decodes texts in one task, remembering the first MEMO words it meets."""

    def __init__(self, vocabulary: bytes, lexicon: bytes):
        self.vocabulary, self.lexicon = Vocabulary(vocabulary), Lexicon(lexicon)
        self.memo: dict[str, tuple[bytes, str]] = {}

    def word(self, word: str) -> tuple[bytes, str]:
        """The ids of a word as bytes, and its tokens with a space between."""
        found = self.lexicon.find(word.encode())
        found = self.vocabulary.merge(word) if found is None else found
        return struct.pack(f"<{len(found)}I", *found), decode(found, self.vocabulary)

    def __call__(self, text: str) -> tuple[bytes, str]:
        words = self.vocabulary.segments(text)
        new = {w: self.word(w) for w in set(words).difference(self.memo)}
        known = self.memo
        if new and len(known) < MEMO:
            known.update(new)
        elif new:
            known = {w: known.get(w) or new[w] for w in set(words)}
        parts = [known[w] for w in words]
        return b"".join([ids for ids, _ in parts]), " ".join([t for _, t in parts if t])


class Shared:
    """Files that are broadcast, and what a worker makes of them once for the tasks that it runs one after another.

    A worker forgets a broadcast when it gets a task that doesn't use it, and with it the words remembered here. Kept by the
    module they would stay beside the memory of every later stage.
    """

    def __init__(self, vocabulary: bytes, lexicon: bytes = b""):
        self.files = vocabulary, lexicon

    def __reduce__(self):
        return Shared, self.files

    @cached_property
    def vocabulary(self) -> Vocabulary:
        return Vocabulary(self.files[0])

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(*self.files)


@lru_cache(maxsize=1)
def _vocabulary(raw: bytes) -> Vocabulary:
    return Vocabulary(raw)


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The tokens of ids with a space between, special ones included: the file names no decoder."""
    return " ".join(vocabulary.names[i] for i in ids)


def encode(docs: DataFrame, vocabulary: bytes, lexicon: bytes, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ids (little-endian unsigned 32-bit), n_tokens and decoded.

    A null text is empty and gives no ids. Rows stay where they are: nothing is shuffled. Repeated rows
    stay; columns of ``docs`` named like the new ones are replaced; an empty table gives no rows.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, "ids", "n_tokens", "decoded")]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(Shared(vocabulary, lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder
        for batch in pieces(batches, "_text", 4 << 20):
            found = [encoder(x or "") for x in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array([x for x, _ in found], pa.binary()),
                    pa.array([len(x) // 4 for x, _ in found], pa.int64()),
                    pa.array([x for _, x in found], pa.string()),
                ],
                [*names, "ids", "n_tokens", "decoded"],
            )

    schema = docs.select(*names).schema.add("ids", "binary").add("n_tokens", "long").add("decoded", "string")
    return docs.select(*names, F.col(text).alias("_text")).mapInArrow(run, schema)
