"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

The lexicon is learned: words and word beginnings that are more frequent in labelled toxic documents than in others,
weighted by the lower bound of their log odds. Features are lexicon densities, hits near a second person, capitals,
punctuation and obfuscation rates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from reviewlens.llm.arrays import LOWER, buffers, hashes, mix, pieces, spans
from reviewlens.sources.scratch import materialise

#: Labelled rows that the model is fitted on, terms of the lexicon, texts a term must occur in.
SAMPLE_ROWS, TERMS, SUPPORT = 20_000, 2_000, 8
#: Bytes of the word beginnings that can be terms; words as a whole are terms too.
BEGINNINGS = (4, 5, 6, 7)
#: Words that address somebody, in the languages of the tables.
SECOND_PERSON = (
    "you your yours yourself u ur ye du dich dir dein deine deiner ihr euch euer sie tu te ti toi ton ta tes vous votre"
    " vos tú usted ustedes vosotros vuestro tus su"
).split()
#: Words between a hit and the person addressed.
NEAR = 5
#: Bytes of text that are looked at once.
PIECE = 1 << 18
FEATURES = (
    "density", "hits", "kinds", "hidden", "addressed", "capitals", "shouted", "exclaimed", "punctuation", "mixed", "digits", "words",
)

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_LEET = LOWER.copy()
#: Digits and signs that stand for letters.
for _sign, _letter in zip(b"013457@$!|+", b"oieastasiit", strict=True):
    _LEET[_sign] = _letter
_WHOLE = np.uint64(0x5851F42D4C957F2D)


def _class(wanted) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[b for b in range(128) if wanted(chr(b))]] = True
    return out


_UPPER, _DIGIT = _class(str.isupper), _class(str.isdigit)
_PUNCT = _class(lambda c: c.isprintable() and not c.isalnum() and c != " ")
_LOUD = _class(lambda c: c in "!?")


def _per_row(member: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(member)])[offsets])


def _terms(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind of term: which words have one, and its hash."""
    every = np.arange(len(begin))
    yield every, hashes(data, begin, end) ^ _WHOLE
    for k in BEGINNINGS:
        long = np.flatnonzero(end - begin >= k)
        yield long, hashes(data, begin[long], begin[long] + k)


def _persons() -> np.ndarray:
    raw = [w.encode() for w in SECOND_PERSON]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    return hashes(data, ends - [len(w) for w in raw], ends) ^ _WHOLE


@dataclass
class Lexicon:
    """Hashes of terms in order, and the weight of each."""

    terms: np.ndarray
    weights: np.ndarray

    def of(self, found: np.ndarray) -> np.ndarray:
        """The weight of each hash, 0 for those that are no terms."""
        if not len(self.terms):
            return np.zeros(len(found))
        at = np.minimum(np.searchsorted(self.terms, found), len(self.terms) - 1)
        return np.where(self.terms[at] == found, self.weights[at], 0.0)


EMPTY = Lexicon(np.zeros(0, np.uint64), np.zeros(0))


def _hits(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> tuple[np.ndarray, ...]:
    """Begin, end, weight and heaviest term of each word of lower-cased bytes, and the words per row."""
    begin, end, n = spans(_LETTER[data], offsets)
    weight, which = np.zeros(len(begin)), np.zeros(len(begin), np.uint64)
    for at, h in _terms(data, begin, end):
        own = lexicon.of(h)
        more = own > weight[at]
        which[at[more]], weight[at[more]] = h[more], own[more]
    return begin, end, weight, which, n


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """A row of FEATURES for each text; zeros for an empty one."""
    raw, offsets = buffers(column)
    rows = len(offsets) - 1
    low = LOWER[raw]
    begin, end, weight, which, n = _hits(low, offsets, lexicon)
    owner, hit = np.repeat(np.arange(rows), n), weight > 0
    hits = np.bincount(owner, weight, rows)
    pairs = np.unique(np.column_stack([owner[hit].astype(np.uint64), which[hit]]), axis=0)
    kinds = np.bincount(pairs[:, 0].astype(np.int64), minlength=rows)
    # signs read as letters
    _, _, weight2, _, n2 = _hits(_LEET[raw], offsets, lexicon)
    hidden = np.maximum(0, np.bincount(np.repeat(np.arange(rows), n2), weight2, rows) - hits)
    person = np.flatnonzero(np.isin(hashes(low, begin, end) ^ _WHOLE, PERSONS))
    hit_at = np.flatnonzero(hit)
    addressed = np.zeros(rows)
    if len(person) and len(hit_at):
        after = np.minimum(np.searchsorted(person, hit_at), len(person) - 1)
        before = np.maximum(after - 1, 0)
        near = np.zeros(len(hit_at), bool)
        for other in (person[after], person[before]):
            near |= (np.abs(other - hit_at) <= NEAR) & (owner[other] == owner[hit_at])
        addressed = np.bincount(owner[hit_at], near, rows)
    size = np.maximum(1, np.diff(offsets))
    count = np.maximum(1, n)
    upper = np.concatenate([[0], np.cumsum(_UPPER[raw])])
    shouted = np.bincount(owner, (upper[end] - upper[begin] == end - begin) & (end - begin > 2), rows)
    digit = _DIGIT[raw]
    letter = _LETTER[low]
    mixed = np.zeros(len(raw), bool)
    mixed[1:] = (digit[1:] & letter[:-1]) | (letter[1:] & digit[:-1])
    return np.column_stack(
        [
            hits / count, np.log1p(hits), np.log1p(kinds), hidden / count, np.log1p(addressed),
            _per_row(_UPPER[raw], offsets) / size, shouted / count, _per_row(_LOUD[raw], offsets) / size,
            _per_row(_PUNCT[raw], offsets) / size, _per_row(mixed, offsets) / size, _per_row(digit, offsets) / size,
            np.log1p(n),
        ]
    )


PERSONS = _persons()


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None = None
    scale: IsotonicRegressionModel | None = None
    base: float = 0.0


def _with_features(df: DataFrame, lexicon: Lexicon, text: str, keep_text: bool = False) -> DataFrame:
    """``df``, as a rule without the text, with the vector of features."""
    kept = [f.name for f in df.schema.fields if keep_text or f.name != text]
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, PIECE):
            rows = features(batch.column(text), shared.value)
            ends = pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32))
            found = pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), found], [*kept, "_features"])

    schema = df.select(*kept).schema.add("_features", ArrayType(DoubleType()))
    return df.mapInArrow(run, schema).withColumn("_features", array_to_vector("_features"))


def learn_lexicon(labelled: DataFrame, terms: int = TERMS, support: int = SUPPORT) -> Lexicon:
    """The terms of (text, toxic) that are more frequent in toxic texts, at most ``terms`` of them.

    A text counts a term three times at most. A term must be in ``support`` toxic texts, and its log odds per
    word, less two standard errors, must exceed log 4; that bound is its weight. Of those terms, best first, one
    is kept if half of ``support`` toxic texts have fewer than two occurrences of terms kept before: chance
    words that copies of a toxic text share are not needed to tell them. Counts are summed in the tasks before
    the shuffle; ``labelled`` is a bounded sample.
    """

    def found(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Distinct (term, row) with their counts, and the number of words."""
        raw, offsets = buffers(batch.column("text"))
        low = LOWER[raw]
        begin, end, n = spans(_LETTER[low], offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), n)
        term, row = (np.concatenate(x) for x in zip(*((h, owner[at]) for at, h in _terms(low, begin, end)), strict=True))
        order = np.lexsort((row, term))
        term, row = term[order], row[order]
        first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (row[1:] != row[:-1])][: len(term)])
        return term[first], row[first], np.diff(np.r_[first, len(term)]), len(begin)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False) == 1
            term, row, n, _ = found(batch)
            own, at = np.unique(term, return_inverse=True)
            n, yes = np.minimum(n, 3), toxic[row]
            rows = [np.bincount(at, w, len(own)).astype(np.int64) for w in (yes, n * yes, n * ~yes)]
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), *map(pa.array, rows)], ["term", "texts", "yes", "no"])

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            raw, offsets = buffers(batch.column("text"))
            words = spans(_LETTER[LOWER[raw]], offsets)[2]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(words)], ["toxic", "words"])

    sizes = labelled.select("text", "toxic").mapInArrow(size, "toxic int, words long")
    words = {r.toxic: r.n + 1 for r in sizes.groupBy("toxic").agg(F.sum("words").alias("n")).collect()}  # two rows
    if len(words) < 2:
        return EMPTY
    counts = labelled.select("text", "toxic").mapInArrow(count, "term long, texts long, yes long, no long")
    counts = counts.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("texts", "yes", "no")))
    yes, no = F.col("yes") + 0.5, F.col("no") + 0.5
    odds = F.log(yes / words[1]) - F.log(no / words[0]) - 2 * F.sqrt(1 / yes + 1 / no)
    top = counts.filter(F.col("texts") >= support).withColumn("odds", odds).filter(F.col("odds") > float(np.log(4)))
    ranked = top.orderBy(F.desc("odds"), "term").limit(terms).select("term", "odds").collect()
    wanted = np.array([r.term for r in ranked], np.int64).view(np.uint64)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The candidates that each text has, and how often."""
        for batch in pieces(batches, "text", PIECE):
            term, row, n, _ = found(batch)
            at = np.flatnonzero(np.isin(term, wanted))
            at = at[np.argsort(row[at], kind="stable")]
            heads = np.searchsorted(row[at], np.arange(batch.num_rows + 1))
            lists = [
                pa.ListArray.from_arrays(pa.array(heads, pa.int32()), pa.array(x[at].astype(np.int64)))
                for x in (term.view(np.int64), n)
            ]
            yield pa.RecordBatch.from_arrays(lists, ["terms", "n"])

    toxic = labelled.filter("toxic = 1").select("text").mapInArrow(present, "terms array<long>, n array<long>").collect()
    having: dict[int, list[tuple[int, int]]] = {}
    for k, r in enumerate(toxic):
        for term, n in zip(r.terms, r.n, strict=True):
            having.setdefault(term, []).append((k, n))
    told, kept = np.zeros(len(toxic), np.int64), {}
    for r in ranked:
        texts, n = np.array(having.get(r.term, []), np.int64).reshape(-1, 2).T
        if (told[texts] < 2).sum() * 2 >= support:
            kept[r.term] = r.odds
            told[texts] += n
    own = np.array(sorted(kept, key=lambda t: t % (1 << 64)), np.int64)
    return Lexicon(own.view(np.uint64), np.array([kept[t] for t in own.tolist()]))


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, text: str = "text", doc: str = "doc_id"
) -> Model:
    """A model of ``labels`` (doc_id, toxic 0 or 1) for the texts of ``docs``.

    It is fitted on about ``sample_rows`` labelled rows, chosen by hash of doc_id: a fifth of them calibrate, the
    others teach the lexicon and the trees. Null labels and ids take no part; of several labels of a document
    the largest counts. With labels of one kind only, every score is that label; with none it is 0.
    """
    own = labels.filter(F.col("toxic").isNotNull() & F.col(doc).isNotNull())
    own = own.groupBy(F.col(doc).alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = own.count()
    if not n:
        return Model(EMPTY)
    share = 1 << 30
    part = F.pmod(F.xxhash64("doc_id"), F.lit(share)) < min(share, share * sample_rows // n)
    # at most about sample_rows narrow rows
    drawn = F.broadcast(own.filter(part))
    picked = docs.select(F.col(doc).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).join(drawn, "doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(5)) == 0
    picked = materialise(picked.withColumn("fold", fold), "labelled")
    kinds = [r.toxic for r in picked.select("toxic").distinct().collect()]
    if len(kinds) < 2:
        return Model(EMPTY, base=float(kinds[0]) if kinds else 0.0)
    lexicon = learn_lexicon(picked.filter("not fold"))
    rows = _with_features(picked.select("text", "toxic", "fold"), lexicon, "text")
    rows = rows.select("fold", F.col("toxic").cast("double").alias("label"), vector_to_array("_features").alias("f"))
    rows = materialise(rows, "features").select("fold", "label", array_to_vector("f").alias("_features"))
    learners = rows.filter("not fold")
    if learners.select("label").distinct().count() < 2:
        learners = rows
    trees = GBTClassifier(
        featuresCol="_features", maxIter=12, maxDepth=3, stepSize=0.3, minInstancesPerNode=2, maxBins=64, seed=7
    ).fit(learners)
    raw = trees.transform(rows.filter("fold")).select("label", vector_to_array("probability")[1].alias("_raw"))
    raw = materialise(raw, "calibration")
    scale = IsotonicRegression(featuresCol="_raw").fit(raw) if not raw.isEmpty() else None
    return Model(lexicon, trees, scale)


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs``, without the text unless ``keep_text``, with toxicity (0 to 1).

    A null text is scored as an empty one. Rows stay where they are, repeated rows are scored alike, a column
    named toxicity is replaced. The calibrated probability counts for all but a hundredth; the trees' own keeps
    apart what calibration ties.
    """
    kept = [f.name for f in docs.schema.fields if f.name != "toxicity" and (keep_text or f.name != text)]
    if model.trees is None:
        return docs.select(*kept, F.lit(model.base).alias("toxicity"))
    out = _with_features(docs.select(*dict.fromkeys([*kept, text])), model.lexicon, text, keep_text)
    trees = model.trees.setRawPredictionCol("_margin").setProbabilityCol("_p").setPredictionCol("_class")
    out = trees.transform(out)
    out = out.withColumn("_raw", vector_to_array("_p")[1])
    if model.scale is not None:
        out = model.scale.setPredictionCol("_even").transform(out)
        out = out.withColumn("_raw", F.col("_even") * 0.99 + F.col("_raw") * 0.01)
    return out.select(*kept, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_raw")).alias("toxicity"))
