"""Scalar expressions on review columns. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.schemas import LABELS

# Unicode white space as Python's str.split sees it, as a regex class body.
SPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Word run, or one sign that is neither word nor space.
TOKEN = rf"[\p{{L}}\p{{N}}_]++|[^\p{{L}}\p{{N}}_{SPACE}]"

# System prompt of the chat form.
CHAT_SYSTEM = (
    "You are a policy checker for Google reviews. "
    "Given a review with fields, output JSON with boolean keys: "
    "irrelevant_content, advertisement, review_without_visit. Only output JSON."
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """Null, empty or white space only."""
    return F.regexp_replace(text_or_empty(c), f"[{SPACE}]+", "") == ""


def normalise_name(c: Column | str, dashes: bool = True) -> Column:
    """Lower case with blanks (and, for places, dashes) as underscores."""
    return F.translate(F.lower(col(c)), " -" if dashes else " ", "__" if dashes else "_")


def review_id(*parts: Column | str) -> Column:
    """First 16 hex digits of the md5 of the raw parts, with no delimiter; a missing part reads nan."""
    joined = F.concat(*[F.coalesce(col(p).cast("string"), F.lit("nan")) for p in parts])
    return F.substring(F.md5(joined), 1, 16)


def text_hash(c: Column | str) -> Column:
    return F.md5(text_or_empty(c))


def has_url(c: Column | str, mode: str = "web") -> Column:
    """``web``: scheme or www, any case. ``strict``: a lower-case scheme only."""
    if mode == "web":
        return F.coalesce(col(c).rlike(r"(?i)(https?://|www\.)"), F.lit(False))
    if mode == "strict":
        hit = col(c).contains("http://") | col(c).contains("https://")
        return F.coalesce(hit, F.lit(False))
    raise ValueError(f"unknown mode {mode}")


def has_photo(c: Column | str) -> Column:
    return F.coalesce(col(c) != "", F.lit(False))


def word_count(c: Column | str) -> Column:
    return F.size(F.filter(F.split(col(c), f"[{SPACE}]+"), lambda w: w != ""))


def short_text(c: Column | str, limit: int = 10) -> Column:
    return F.length(col(c)) <= limit


def rating_out_of_range(c: Column | str) -> Column:
    return (col(c) < 1) | (col(c) > 5)


def slugify(c: Column | str) -> Column:
    trimmed = F.lower(F.regexp_replace(text_or_empty(c), f"^[{SPACE}]+|[{SPACE}]+$", ""))
    return F.translate(trimmed, " /\\", "_--")


def title_label(c: Column | str) -> Column:
    return F.initcap(F.replace(col(c), F.lit("_"), F.lit(" ")))


def category_name(c: Column | str, names: dict[str, str]) -> Column:
    """Fixed display name of a label, else its title form."""
    picked = reduce(
        lambda acc, kv: acc.when(col(c) == kv[0], F.lit(kv[1])),
        list(names.items())[1:],
        F.when(col(c) == next(iter(names)), F.lit(next(iter(names.values())))),
    )
    return picked.otherwise(title_label(c))


def short_model_name(c: Column | str) -> Column:
    return F.element_at(F.split(col(c), "/"), -1)


def model_family(c: Column | str, anywhere: bool = False) -> Column:
    """Family from the model path; ``anywhere`` also accepts it as a middle segment, in any case."""
    path = F.lower(F.trim(F.translate(col(c), "\\", "/"))) if anywhere else col(c)

    def under(*names: str) -> Column:
        tests = [path.startswith(f"{n}/") for n in names]
        if anywhere:
            tests += [path.contains(f"/{n}/") for n in names]
        return reduce(lambda a, b: a | b, tests)

    first = F.regexp_replace(path, "^/+", "") if anywhere else path
    return (
        F.when(under("encoder"), "encoder")
        .when(under("baseline"), "baseline")
        .when(under("sft") | path.startswith("sft-"), "sft")
        .when(under("fraud_fuse", "fraud"), "fraud_fuse")
        .otherwise(F.split_part(first, F.lit("/"), F.lit(1)))
    )


def business_key(df: DataFrame, blank_policy: str = "surrogate", seq: str = "seq") -> Column:
    """Business id where given, else name. Blank keys: own surrogate, dropped (null) or lumped."""
    name = text_or_empty("business_name") if "business_name" in df.columns else F.lit("")
    given = text_or_empty("business_id") if "business_id" in df.columns else F.lit("")
    if blank_policy == "lump":
        return F.when(given == "", name).otherwise(given)

    def absent(c: Column) -> Column:
        return is_blank(c) | (F.lower(c) == "nan")

    key = F.when(absent(given), name).otherwise(given)
    if blank_policy == "surrogate":
        return F.when(absent(key), F.concat(F.lit("__row_"), F.col(seq))).otherwise(key)
    if blank_policy == "drop":
        return F.when(~is_blank(key), key)
    raise ValueError(f"unknown blank policy {blank_policy}")


def truthy_label(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("boolean"), F.lit(False)).cast("int")


def label_vector(labels: list[str] = LABELS) -> Column:
    return F.array(*[truthy_label(name) for name in labels])


def any_positive(labels: list[str] = LABELS) -> Column:
    return F.exists(label_vector(labels), lambda v: v == 1)


def threshold_probs(probs: Column | str, threshold: float) -> Column:
    return F.transform(col(probs), lambda p: (p >= threshold).cast("int"))


def valid_date_text(c: Column | str) -> Column:
    """dd/mm/yyyy with plausible parts, or empty. The calendar is not checked."""
    pattern = r"^([0-9]{2})/([0-9]{2})/([0-9]{4})$"
    day, month, year = (F.regexp_extract(col(c), pattern, i).try_cast("int") for i in (1, 2, 3))
    shaped = col(c).rlike(pattern)
    inside = day.between(1, 31) & month.between(1, 12) & year.between(1900, 2100)
    return (col(c) == "") | (shaped & F.coalesce(inside, F.lit(False)))


def filter_records(
    df: DataFrame,
    label: str | None = None,
    user: str | None = None,
    host: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """Keep the records matching every given criterion; ``all``, empty and unreadable dates match all."""
    at = {
        "label": "ablr_use_cases",
        "user": "users",
        "host": "hostnames",
        "time": "log_start_time",
        **(columns or {}),
    }

    def some_contains(name: str, needle: str) -> Column:
        return F.exists(F.col(name), lambda v: F.lower(v).contains(needle.lower()))

    if label and label != "all":
        df = df.filter(F.array_contains(at["label"], label))
    if user and user != "all":
        df = df.filter(some_contains(at["user"], user))
    if host and host != "all":
        df = df.filter(some_contains(at["host"], host))
    # the bound is parsed from a literal, so that it folds to a constant and reaches the scan
    if date_from:
        low = F.try_to_timestamp(F.lit(date_from), F.lit("d/M/yyyy"))
        df = df.filter(low.isNull() | (F.col(at["time"]) >= low))
    if date_to:
        high = F.try_to_timestamp(F.lit(date_to), F.lit("d/M/yyyy"))
        last = high + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
        df = df.filter(high.isNull() | (F.col(at["time"]) <= last))
    return df


def candidate_list(
    match: Column | str,
    description: Column | str,
    score: Column | str,
    others: Column | str,
    matched: Column | str,
) -> Column:
    """Primary candidate if matched, up to five complete alternates, then N/A; first per key kept.

    ``others`` is a map with keys other_match_1.. and other_match_description_1.. .
    """

    def entry(m: Column, d: Column, s: Column) -> Column:
        return F.struct(m.alias("match"), d.alias("description"), s.cast("double").alias("match_score"))

    none = F.lit(None).cast("double")
    primary = F.when(col(matched), F.array(entry(text_or_empty(match), col(description), col(score))))
    alternates = [
        entry(
            F.try_element_at(col(others), F.lit(f"other_match_{i}")),
            F.try_element_at(col(others), F.lit(f"other_match_description_{i}")),
            none,
        )
        for i in range(1, 6)
    ]
    complete = F.filter(
        F.array(*alternates),
        lambda c: (F.coalesce(c["match"], F.lit("")) != "")
        & (F.coalesce(c["description"], F.lit("")) != ""),
    )
    closing = F.array(
        entry(
            F.lit("N/A"),
            F.lit("This log entry does not match any known command or pattern"),
            none,
        )
    )
    every = F.concat(F.coalesce(primary, F.slice(closing, 1, 0)), complete, closing)
    keys = F.transform(every, lambda c: c["match"])
    return F.filter(every, lambda c, i: i == F.array_position(keys, c["match"]) - 1)


def tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(TOKEN), F.lit(0))


def model_text(flags: bool = False) -> Column:
    """Structured text of a training row; ``flags`` adds the URL and photo lines where they hold."""
    parts = [
        F.lit("BUSINESS: "), text_or_empty("business_name"),
        F.lit("\nAUTHOR: "), text_or_empty("author_name"),
        F.lit("\nRATING: "), text_or_empty("rating"),
        F.lit("\nTEXT: "), text_or_empty("text"),
    ]
    if flags:
        for name in ("has_url", "has_photo"):
            line = F.lit(f"\n{name.upper()}: true")
            parts.append(F.when(F.coalesce(F.col(name).cast("boolean"), F.lit(False)), line).otherwise(""))
    return F.concat(*parts)


def gold_answer(labels: list[str] = LABELS) -> Column:
    """The labels as a JSON object of booleans, in label order."""
    shape = "{" + ", ".join(f'"{name}": %s' for name in labels) + "}"
    return F.format_string(shape, *[(truthy_label(n) == 1).cast("string") for n in labels])


def chat_messages(df: DataFrame, with_answer: bool = True) -> Column:
    """System, user and (for training) assistant turns. ``review_text`` is preferred when present."""
    body = text_or_empty("review_text" if "review_text" in df.columns else "text")
    photo = F.coalesce(F.col("has_photo").cast("boolean"), F.lit(False))
    user = F.concat(
        F.lit("BUSINESS: "), text_or_empty("business_name"),
        F.lit("\nAUTHOR: "), text_or_empty("author_name"),
        F.lit("\nRATING: "), text_or_empty("rating"),
        F.lit("\nTEXT: "), body,
        F.lit("\nHAS_URL: "), has_url("text", "strict").cast("string"),
        F.lit("\nHAS_PHOTO: "), photo.cast("string"),
    )
    turns = [("system", F.lit(CHAT_SYSTEM)), ("user", user)]
    if with_answer:
        turns.append(("assistant", gold_answer()))
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])


def json_truthy(document: Column, key: str, absent: bool) -> Column:
    """Truth of a JSON member as a dynamic language sees it: "false" is true, 0, "" and null are not."""
    member = F.try_variant_get(document, f"$.{key}", "variant")
    kind = F.schema_of_variant(member)
    as_text = F.try_variant_get(document, f"$.{key}", "string")
    return (
        F.when(document.isNull() | member.isNull(), F.lit(absent))
        .when(kind == "VOID", F.lit(False))
        .when(kind == "BOOLEAN", as_text == "true")
        .when(kind == "STRING", as_text != "")
        .when(kind.startswith("ARRAY"), as_text != "[]")
        .when(kind.startswith("OBJECT"), as_text != "{}")
        .otherwise(F.coalesce(as_text.try_cast("double") != 0, F.lit(True)))
    )


def parse_model_output(c: Column | str, labels: list[str] = LABELS) -> Column:
    """Last JSON object of a generated text as a struct of booleans; unreadable means all false."""
    found = F.regexp_extract(F.regexp_replace(text_or_empty(c), f"[{SPACE}]+$", ""), r"(?s)\{.*\}$", 0)
    document = F.try_parse_json(F.nullif(found, F.lit("")))
    # a variable, so that a text is searched and parsed once and not for every use of its document
    read = F.transform(
        F.array(document), lambda d: F.struct(*[json_truthy(d, name, absent=False).alias(name) for name in labels])
    )
    return F.get(read, F.lit(0))
