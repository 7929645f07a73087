"""Benchmark decontamination by winnowing; column functions and joins only.

Winnowing keeps, of every window of ``WINDOW`` consecutive k-grams, the one of least hash. With
k + WINDOW - 1 equal to the span that counts, each such span of a document keeps exactly one fingerprint, and
an equal span of an item keeps the same one. So the join of fingerprints finds every shared span, and
comparing words around the hits leaves out what only shares a k-gram.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.sources.scratch import materialise

#: Words in a span that counts, in a k-gram, and k-grams in a window.
SPAN, GRAM, WINDOW = 13, 6, 8
#: What stands between words, once A-Z are a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased, then runs of digits, a-z and everything beyond ASCII; null has none.

    lower() changes letters beyond ASCII too, so texts with such capitals take the slower way.
    """
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    own = F.when(
        text.rlike(r"[^\x00-\x7F&&[\p{IsUppercase}\p{Lt}]]"), F.translate(text, capitals, capitals.lower())
    ).otherwise(F.lower(text))
    return F.coalesce(F.filter(F.split(own, BETWEEN), lambda w: w != ""), F.array().cast("array<string>"))


def _next(name: str, by: int) -> tuple[Column, Column]:
    """An array without its last ``by`` elements, and without its first."""
    left = F.greatest(F.size(name) - by, F.lit(0))
    return F.slice(name, F.lit(1), left), F.slice(name, F.lit(1 + by), left)


def fingerprints(df: DataFrame, source: str = "words", target: str = "prints") -> DataFrame:
    """Adds the distinct winnowed hashes of the 13-word spans; sequences of fewer words have none.

    Six-grams are put together from pairs, and the least of eight from the least of two and of four, so each
    word costs six steps whatever the window.
    """
    hashed = F.transform(source, lambda w: F.xxhash64(w))
    pair = lambda a, b: F.xxhash64(a, b)
    least = lambda a, b: F.least(a, b)
    df = df.withColumn("_h", hashed)
    df = df.withColumn("_2", F.zip_with(*_next("_h", 1), pair)).drop("_h")
    df = df.withColumn("_4", F.zip_with(*_next("_2", 2), pair))
    df = df.withColumn("_6", F.zip_with(_next("_4", 2)[0], F.slice("_2", F.lit(5), F.greatest(F.size("_4") - 2, F.lit(0))), pair))
    df = df.drop("_2", "_4")
    df = df.withColumn("_m2", F.zip_with(*_next("_6", 1), least)).drop("_6")
    df = df.withColumn("_m4", F.zip_with(*_next("_m2", 2), least)).drop("_m2")
    return df.withColumn(target, F.array_distinct(F.zip_with(*_next("_m4", 4), least))).drop("_m4")


def spans(source: str, size: int) -> Column:
    """Every run of ``size`` consecutive words as one text; words hold no space."""
    last = F.size(source) - size
    every = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.array_join(F.slice(source, i + 1, F.lit(size)), " "),
    )
    return F.when(last >= 0, every).otherwise(F.array().cast("array<string>"))


def _hits(docs: DataFrame, pairs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """(_key, unit, hit): the words (from 0) of a document inside an occurrence of an item's span."""
    spanned = docs.join(pairs.groupBy("_key").agg(F.collect_set("unit").alias("units")), "_key")
    spanned = spanned.select("_key", "units", spans("words", size).alias("own"))
    # written first: an array that a lambda refers to would be built again for each element
    wanted = materialise(items.select("unit", spans("words", size).alias("theirs")), "spans")
    both = spanned.select("_key", "own", F.explode("units").alias("unit")).join(wanted, "unit")
    begins = F.filter(
        F.transform("own", lambda x, i: F.when(F.array_contains("theirs", x), i)), lambda i: i.isNotNull()
    )
    covered = F.flatten(F.transform(begins, lambda i: F.sequence(i, i + (size - 1))))
    return both.select("_key", "unit", F.array_distinct(covered).alias("hit")).filter(F.size("hit") > 0)


def text_key(doc: str = "doc_id", text: str = "text") -> Column:
    """Names a document's text: its id and a hash of the text."""
    return F.concat_ws(":", F.coalesce(F.col(doc).cast("string"), F.lit("-")), F.hex(F.xxhash64(text)))


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Per row of ``docs``: text_key, doc_id, n_words, n_hit, item_ids (sorted as strings), n_items, contaminated.

    Both tables need a text. A span is 13 consecutive words of an item, or the whole of an item with fewer, and
    a word of a document is hit inside any occurrence of a span. Contaminated: n_hit > 0 and at least a
    twentieth of the words. A null or wordless text has no words and is clean, an item of that kind
    has no span; repeated rows are judged alike, and items of equal words count once for the work and with
    each of their ids in the result; a null item id is not listed; null document ids are kept; other
    columns are ignored. Empty tables: no documents, or no hits.

    Documents are reduced to fingerprints in the scan, about two for nine words. The side of the items is
    broadcast only if Spark finds it under its threshold, else both are shuffled. Whole texts are read again
    for documents with a shared fingerprint only.
    """
    split = docs.select(F.col(doc).alias("doc_id"), text_key(doc).alias("_key"), words(F.col("text")).alias("words"))
    prints = fingerprints(split).select("doc_id", "_key", F.size("words").cast("long").alias("n_words"), "prints")
    base = materialise(prints, "fingerprints")

    listed = benchmark.select(F.col(item).cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    listed = listed.filter(F.size("words") > 0).withColumn("unit", F.sha2(F.array_join("words", " "), 256))
    listed = materialise(listed, "items")
    items = listed.groupBy("unit").agg(F.first("words").alias("words"))
    ids = listed.filter("item_id is not null").select("unit", "item_id").distinct()

    keyed = split.select("_key", "words")
    short = [r[0] for r in items.filter(F.size("words") < SPAN).select(F.size("words")).distinct().collect()]
    found = []
    for size in [SPAN, *sorted(short)]:  # at most 13 sizes
        if size == SPAN:
            mine = items.filter(F.size("words") >= SPAN)
            # written first: explode's own filter would otherwise repeat each step's expression many times over
            theirs = materialise(fingerprints(mine).select("unit", "prints"), "item-fingerprints")
            theirs = theirs.select("unit", F.explode("prints").alias("print"))
            ours = base.select("_key", F.explode("prints").alias("print"))
        else:
            mine = items.filter(F.size("words") == size)
            theirs = mine.select("unit", F.xxhash64(F.array_join("words", " ")).alias("print"))
            grams = F.array_distinct(F.transform(spans("words", size), lambda x: F.xxhash64(x)))
            ours = keyed.select("_key", F.explode(grams).alias("print"))
        pairs = materialise(ours.join(theirs, "print").select("_key", "unit").distinct(), "candidates")
        found.append(_hits(keyed, pairs, mine, size))
    hits = materialise(reduce(DataFrame.unionByName, found), "hits")

    words_hit = hits.groupBy("_key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit")
    )
    items_hit = (
        hits.select("_key", "unit").distinct().join(ids, "unit").groupBy("_key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    out = base.drop("prints").join(words_hit, "_key", "left").join(items_hit, "_key", "left")
    out = out.withColumns(
        {
            "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
            "item_ids": F.coalesce("item_ids", F.array().cast("array<string>")),
        }
    )
    return out.withColumns(
        {
            "n_items": F.size("item_ids").cast("long"),
            "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")),
        }
    ).withColumnRenamed("_key", "text_key")
