"""Fill-in-middle transformation with counted quantifiers, in column functions only.

A text is a sequence of units (lines, by default). ``regexp_count`` gives their number n; two hash draws give the
border after unit a and the border after unit b; one match of a pattern built for the row, with the possessive groups
``(unit){a}+`` and ``(unit){b-a}+``, captures prefix, middle and suffix. Possessive groups never give units back, so
the match is one pass over the text whatever its length, without recursion.

Defined results: a null text is empty; an empty text, a text that contains a mark, and a text outside ``rate`` stay
plain (no lengths); a null id draws like an empty one; rows with equal ids draw alike; every row gives one row and
repeated rows stay repeated; an empty table gives no rows. Only the id and the text are read, so other columns may have
any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its end, or what is left after the last one.
LINE = r"[^\n]*+\n|[^\n]++"


@dataclass(frozen=True)
class Marks:
    """Strings before the parts; none may be a part of another, nor begin with the end of another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def layout(self, form: str) -> list[str]:
        """The marks in the order in which a form has them."""
        ahead = [self.prefix, self.suffix] if form == "psm" else [self.suffix, self.prefix]
        return [*ahead, self.middle]

    def inside(self, text: Column) -> Column:
        found = F.contains(text, F.lit(self.prefix))
        return found | F.contains(text, F.lit(self.suffix)) | F.contains(text, F.lit(self.middle))


def draw(seed: str, doc: Column, k: int) -> Column:
    """The k-th (from 0) group of eight hexadecimal digits of the digest of seed, colon and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    seed: str = "7",
    unit: str = LINE,
    rate: int = 100,
    spm: int = 50,
    marks: Marks = Marks(),
) -> DataFrame:
    """doc_id, text, n, form, prefix, middle, suffix (null if plain) and output of every row.

    ``unit`` is the pattern of a unit; matched from left to right, units must make up the whole text. ``rate`` per cent
    of the texts are cut, ``spm`` per cent of those have the suffix first.
    """
    own = docs.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = own.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long"))
    cuts = [F.pmod(draw(seed, F.col("doc_id"), k), F.col("n") + 1) for k in (0, 1)]
    plain = (F.col("text") == "") | marks.inside(F.col("text")) | (draw(seed, F.col("doc_id"), 2) % 100 >= rate)
    other = F.when(draw(seed, F.col("doc_id"), 3) % 100 < spm, "spm").otherwise("psm")
    drawn = counted.select(
        "*",
        F.when(plain, "plain").otherwise(other).alias("form"),
        F.least(*cuts).alias("a"),
        (F.greatest(*cuts) - F.least(*cuts)).alias("more"),
    )
    # no mark is in the text, so that one can part the captured groups
    pattern = F.format_string(rf"(?s)\A((?:{unit}){{%d}}+)((?:{unit}){{%d}}+)(.*+)\z", "a", "more")
    between = marks.prefix.replace("\\", "\\\\").replace("$", "\\$")
    match = F.regexp_replace("text", pattern, F.lit(f"$1{between}$2{between}$3"))
    cut = F.split(match, re.escape(marks.prefix))
    parts = drawn.select("doc_id", "text", "n", "form", F.when(F.col("form") != "plain", cut).alias("cut"))
    named = parts.select(
        "doc_id", "text", "n", "form", *[F.col("cut")[i].alias(x) for i, x in enumerate(("prefix", "middle", "suffix"))]
    )
    part_of = {marks.prefix: "prefix", marks.middle: "middle", marks.suffix: "suffix"}
    laid = {f: F.concat(*[c for m in marks.layout(f) for c in (F.lit(m), F.col(part_of[m]))]) for f in ("psm", "spm")}
    output = F.when(F.col("form") == "psm", laid["psm"]).when(F.col("form") == "spm", laid["spm"])
    return named.withColumn("output", output.otherwise(F.col("text")))


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text from which ``fill_in_middle`` made this output of this form."""

    def joined(name: str) -> Column:
        layout = marks.layout(name)
        groups = [f"${layout.index(m) + 1}" for m in (marks.prefix, marks.middle, marks.suffix)]
        first, second, third = map(re.escape, layout)
        return F.regexp_replace(output, rf"(?s)\A{first}(.*?){second}(.*?){third}(.*+)\z", "".join(groups))

    return F.when(form == "psm", joined("psm")).when(form == "spm", joined("spm")).otherwise(output)
