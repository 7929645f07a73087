"""Scalar functions and text features (inventory groups D and J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions import text as tx
from reviewlens.operators.features import build_vocab, encode
from reviewlens.operators.similarity import eligible_reviews
from reviewlens.plans.adapters import predictions, records, reviews, table, with_views
from reviewlens.plans.registry import query

URL = "regexp_matches(html, '(?i)(https?://|www\\.)')"
SPACE = (
    "\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}"
    "\\x{205f}\\x{3000}"
)
WORDS = f"len(list_filter(regexp_split_to_array(text, '[{SPACE}]+'), lambda x: x <> ''))"
TOKENS = f"regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_{SPACE}]')"


@query("d1_names", with_views("SELECT seq, place_name, user_name FROM unified", "unified"))
def names(spark, sf):
    return reviews(spark, sf).select(
        "seq",
        tx.normalise_name("business_name").alias("place_name"),
        tx.normalise_name("author_name", dashes=False).alias("user_name"),
    )


@query("d2_review_id", with_views("SELECT seq, review_id FROM unified", "unified"))
def review_ids(spark, sf):
    return reviews(spark, sf).select(
        "seq", tx.review_id("business_name", "author_name", "text").alias("review_id")
    )


@query("d3_text_hash", with_views("SELECT seq, md5(text) AS text_hash FROM reviews", "reviews"))
def text_hashes(spark, sf):
    return reviews(spark, sf).select("seq", tx.text_hash("text").alias("text_hash"))


@query("d4_has_url", f"SELECT page_id, {URL} AS has_url FROM pages")
def has_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.has_url("html").alias("has_url"))


@query(
    "d5_has_url_strict",
    "SELECT page_id, contains(html, 'http://') OR contains(html, 'https://') AS has_url FROM pages",
)
def has_url_strict(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.has_url("html", "strict").alias("has_url"))


@query(
    "d6_has_photo",
    with_views("SELECT seq, photo IS NOT NULL AND photo <> '' AS has_photo FROM reviews", "reviews"),
)
def has_photo(spark, sf):
    return reviews(spark, sf).select("seq", tx.has_photo("photo").alias("has_photo"))


@query(
    "d7_business_key",
    """SELECT doc_id AS seq,
              CASE WHEN id <> '' THEN id WHEN name <> '' THEN name ELSE '__row_' || doc_id END AS surrogate,
              CASE WHEN id <> '' THEN id WHEN name <> '' THEN name END AS dropped,
              CASE WHEN id <> '' THEN id ELSE name END AS lumped
       FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE lang || (doc_id % 9) END AS id,
                    CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS name FROM documents)""",
)
def business_keys(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"),
        F.when(F.col("lang") == "en", "")
        .otherwise(F.concat("lang", (F.col("doc_id") % 9).cast("string")))
        .alias("business_id"),
        F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("source")).alias("business_name"),
    )
    return rows.select(
        "seq",
        tx.business_key(rows, "surrogate").alias("surrogate"),
        tx.business_key(rows, "drop").alias("dropped"),
        tx.business_key(rows, "lump").alias("lumped"),
    )


@query(
    "d8_eligible",
    with_views(
        """SELECT business_name AS business, seq, length(text) AS n_chars FROM reviews
           WHERE (CASE WHEN rating < 5 THEN 'original' ELSE 'synthetic' END) = 'original'
             AND trim(text) <> ''""",
        "reviews",
    ),
)
def eligible(spark, sf):
    sourced = reviews(spark, sf).withColumn(
        "source", F.when(F.col("rating") < 5, "original").otherwise("synthetic")
    )
    return eligible_reviews(sourced).select("business", "seq", F.length("text").cast("long").alias("n_chars"))


@query(
    "d9_start_offset",
    with_views(
        """SELECT seq, CASE WHEN seq >= 100 THEN CAST(contains(lower(text), 'mail')::INT
               + contains(lower(text), 'ing')::INT + contains(lower(text), 'the')::INT >= 2 AS INTEGER)
               ELSE 0 END AS is_noadvertisement FROM reviews""",
        "reviews",
    ),
)
def start_offset(spark, sf):
    from reviewlens.functions.policy import annotate_rules
    from reviewlens.plans.adapters import TEST_POLICIES

    return annotate_rules(reviews(spark, sf), TEST_POLICIES[:1], start_at=100).select(
        "seq", "is_noadvertisement"
    )


@query(
    "d10_split_photo",
    with_views(
        """SELECT 'text_only' AS part, count(*) AS n, count(DISTINCT place_name) AS places FROM unified
           UNION ALL SELECT 'with_images', count(*), count(DISTINCT place_name) FROM unified
           WHERE has_image""",
        "unified",
    ),
)
def split_photo(spark, sf):
    from reviewlens.operators import profile

    unified = profile.unify(reviews(spark, sf), language=None)

    def count(df, part):
        return df.agg(
            F.lit(part).alias("part"), F.count("*").alias("n"), F.count_distinct("place_name").alias("places")
        )

    return count(profile.text_only(unified), "text_only").unionByName(
        count(profile.with_images(unified), "with_images")
    )


@query(
    "d11_label_vector",
    with_views(
        "SELECT seq, irrelevant_content || ',' || advertisement || ',' || review_without_visit AS labels"
        " FROM reviews",
        "reviews",
    ),
)
def label_vectors(spark, sf):
    return reviews(spark, sf).select("seq", F.array_join(tx.label_vector(), ",").alias("labels"))


@query(
    "d12_threshold",
    with_views(
        """SELECT model, sample_id,
                  max(CASE WHEN label = 'irrelevant_content' THEN CAST(prob >= 0.5 AS INTEGER) END) || ',' ||
                  max(CASE WHEN label = 'advertisement' THEN CAST(prob >= 0.5 AS INTEGER) END) || ',' ||
                  max(CASE WHEN label = 'review_without_visit' THEN CAST(prob >= 0.5 AS INTEGER) END) AS pred
           FROM scored GROUP BY model, sample_id""",
        "scored",
    ),
)
def thresholds(spark, sf):
    return predictions(spark, sf).select(
        "model", "sample_id", F.array_join(tx.threshold_probs("probs", 0.5), ",").alias("pred")
    )


@query(
    "d13_any_positive",
    with_views(
        "SELECT seq, greatest(irrelevant_content, advertisement, review_without_visit) = 1 AS positive"
        " FROM reviews",
        "reviews",
    ),
)
def any_positive(spark, sf):
    return reviews(spark, sf).select("seq", tx.any_positive().alias("positive"))


@query(
    "d14_short_or_odd",
    with_views(
        "SELECT seq, length(text) <= 10 AS short_text, rating < 2 OR rating > 5 OR rating < 1 AS odd_rating"
        " FROM (SELECT seq, text, rating + 1 AS rating FROM reviews)",
        "reviews",
    ),
)
def short_or_odd(spark, sf):
    rows = reviews(spark, sf).withColumn("rating", F.col("rating") + 1)
    return rows.select(
        "seq",
        tx.short_text("text").alias("short_text"),
        (tx.rating_out_of_range("rating") | (F.col("rating") < 2)).alias("odd_rating"),
    )


@query(
    "d15_filter_records",
    """SELECT event_id FROM events
       WHERE event_type = 'click' AND contains('user' || user_id, 'r1') AND contains('h' || (user_id % 7), 'h')
         AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 23:59:59'""",
)
def filtered_records(spark, sf):
    return tx.filter_records(
        records(spark, sf), "click", "R1", "h", date_from="05/01/2024", date_to="20/01/2024"
    ).select("event_id")


@query(
    "d15_filter_wildcards",
    """SELECT event_id FROM events WHERE contains('h' || (user_id % 7), 'h3')""",
)
def filtered_wildcards(spark, sf):
    return tx.filter_records(
        records(spark, sf), "all", "", "H3", date_from="not a date", date_to="99/99/2024"
    ).select("event_id")


@query(
    "d16_date_text",
    """SELECT event_id, shown, shown = '' OR (regexp_matches(shown, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$')
              AND coalesce(TRY_CAST(substr(shown, 1, 2) AS INT) BETWEEN 1 AND 31
              AND TRY_CAST(substr(shown, 4, 2) AS INT) BETWEEN 1 AND 12
              AND TRY_CAST(substr(shown, 7, 4) AS INT) BETWEEN 1900 AND 2100, false)) AS valid
       FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN strftime(ts, '%d/%m/%Y')
             WHEN 2 THEN strftime(ts, '%m-%d-%Y')
             ELSE lpad(CAST(user_id % 40 AS VARCHAR), 2, '0') || '/' || lpad(CAST(user_id % 15 AS VARCHAR), 2, '0')
                  || '/' || CAST(1890 + user_id * 2 AS VARCHAR) END AS shown FROM events)""",
)
def date_text(spark, sf):
    user = F.col("user_id")
    odd = F.concat(
        F.lpad((user % 40).cast("string"), 2, "0"), F.lit("/"), F.lpad((user % 15).cast("string"), 2, "0"),
        F.lit("/"), (user * 2 + 1890).cast("string"),
    )
    kind = F.col("event_id") % 4
    shown = (
        F.when(kind == 0, "")
        .when(kind == 1, F.date_format("ts", "dd/MM/yyyy"))
        .when(kind == 2, F.date_format("ts", "MM-dd-yyyy"))
        .otherwise(odd)
    )
    rows = table(spark, sf, "events").select("event_id", shown.alias("shown"))
    return rows.withColumn("valid", tx.valid_date_text("shown"))


@query(
    "d17_candidates",
    """SELECT event_id, string_agg(m, '|' ORDER BY pos) AS matches FROM (
           SELECT event_id, m, min(pos) AS pos FROM (
               SELECT event_id, 0 AS pos, event_type AS m FROM events WHERE value > 10
               UNION ALL SELECT event_id, 1, 'error' FROM events
               UNION ALL SELECT event_id, 2, 'u' || (user_id % 3) FROM events WHERE user_id % 2 = 0
               UNION ALL SELECT event_id, 4, 'u' || (user_id % 4) FROM events
               UNION ALL SELECT event_id, 6, 'N/A' FROM events) GROUP BY event_id, m)
       GROUP BY event_id""",
)
def candidates(spark, sf):
    user = F.col("user_id")
    others = F.create_map(
        F.lit("other_match_1"), F.lit("error"), F.lit("other_match_description_1"), F.lit("an error"),
        F.lit("other_match_2"), F.concat(F.lit("u"), (user % 3).cast("string")),
        F.lit("other_match_description_2"), F.when(user % 2 == 0, "even").otherwise(""),
        F.lit("other_match_3"), F.lit("no description"),
        F.lit("other_match_4"), F.concat(F.lit("u"), (user % 4).cast("string")),
        F.lit("other_match_description_4"), F.lit("by four"),
    )
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", "value", others.alias("others"), (F.col("value") > 10).alias("matched")
    )
    found = tx.candidate_list("event_type", "event_type", "value", "others", "matched")
    return rows.select("event_id", F.array_join(F.transform(found, lambda c: c["match"]), "|").alias("matches"))


@query(
    "d18_slugify",
    "SELECT p_partkey, replace(replace(lower(trim(shown)), ' ', '_'), '/', '-') AS slug"
    " FROM (SELECT p_partkey, ' ' || p_brand || '/' || p_name || ' ' AS shown FROM part)",
)
def slugs(spark, sf):
    shown = F.concat(F.lit(" "), "p_brand", F.lit("/"), "p_name", F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", tx.slugify(shown).alias("slug"))


@query(
    "d19_title_label",
    """SELECT DISTINCT event_type, CASE event_type WHEN 'click' THEN 'Clicked' ELSE
              upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' ' ||
              upper(substr(event_type, 1, 1)) || substr(event_type, 2) END AS title FROM events""",
)
def titles(spark, sf):
    from reviewlens.functions.text import category_name

    label = F.when(F.col("event_type") == "click", F.lit("click")).otherwise(
        F.concat("event_type", F.lit("_"), "event_type")
    )
    return (
        table(spark, sf, "events")
        .select("event_type")
        .distinct()
        .select("event_type", category_name(label, {"click": "Clicked"}).alias("title"))
    )


@query(
    "d20_model_family",
    """SELECT p_partkey, CASE WHEN path LIKE 'encoder/%' THEN 'encoder' WHEN path LIKE 'baseline/%' THEN 'baseline'
              WHEN path LIKE 'sft/%' OR path LIKE 'sft-%' THEN 'sft'
              WHEN path LIKE 'fraud/%' OR path LIKE 'fraud_fuse/%' THEN 'fraud_fuse'
              ELSE split_part(path, '/', 1) END AS family
       FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'encoder/' WHEN 1 THEN 'baseline/' WHEN 2 THEN 'sft-'
             WHEN 3 THEN 'fraud/' WHEN 4 THEN 'sft/' ELSE '' END || p_name AS path FROM part)""",
)
def families(spark, sf):
    kind = F.col("p_partkey") % 6
    lead = (
        F.when(kind == 0, "encoder/")
        .when(kind == 1, "baseline/")
        .when(kind == 2, "sft-")
        .when(kind == 3, "fraud/")
        .when(kind == 4, "sft/")
        .otherwise("")
    )
    rows = table(spark, sf, "part").select("p_partkey", F.concat(lead, "p_name").alias("path"))
    return rows.select("p_partkey", tx.model_family("path").alias("family"))


@query(
    "d21_lengths",
    with_views(f"SELECT seq, length(text) AS text_length, {WORDS} AS word_count FROM reviews", "reviews"),
)
def lengths(spark, sf):
    return reviews(spark, sf).select(
        "seq",
        F.length("text").cast("long").alias("text_length"),
        tx.word_count("text").cast("long").alias("word_count"),
    )


@query(
    "d22_short_name",
    "SELECT page_id, list_extract(string_split(url, '/'), -1) AS name FROM pages",
)
def short_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.short_model_name("url").alias("name"))


@query(
    "j1_structured_text",
    with_views(
        """SELECT seq, md5('BUSINESS: ' || business_name || chr(10) || 'AUTHOR: ' || author_name || chr(10)
                  || 'RATING: ' || rating || chr(10) || 'TEXT: ' || text) AS body FROM reviews""",
        "reviews",
    ),
)
def structured_text(spark, sf):
    return reviews(spark, sf).select("seq", F.md5(tx.model_text()).alias("body"))


@query(
    "j2_flagged_text",
    """SELECT page_id, md5('BUSINESS: ' || url || chr(10) || 'AUTHOR: ' || chr(10) || 'RATING: ' || (page_id % 5 + 1)
              || chr(10) || 'TEXT: ' || html
              || CASE WHEN regexp_matches(html, '(?i)(https?://|www\\.)') THEN chr(10) || 'HAS_URL: true' ELSE '' END
              || CASE WHEN page_id % 3 = 0 THEN chr(10) || 'HAS_PHOTO: true' ELSE '' END) AS body
       FROM pages""",
)
def flagged_text(spark, sf):
    rows = _page_rows(spark, sf)
    return rows.select("page_id", F.md5(tx.model_text(flags=True)).alias("body"))


def _page_rows(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.col("url").alias("business_name"),
        F.lit(None).cast("string").alias("author_name"),
        (F.col("page_id") % 5 + 1).alias("rating"),
        F.col("html").alias("text"),
        tx.has_url("html").alias("has_url"),
        (F.col("page_id") % 3 == 0).alias("has_photo"),
        (F.col("page_id") % 2).alias("irrelevant_content"),
        (F.col("page_id") % 7 == 0).alias("advertisement"),
        F.lit(None).cast("int").alias("review_without_visit"),
    )


GOLD = """'{"irrelevant_content": ' || (page_id % 2 = 1) || ', "advertisement": ' || (page_id % 7 = 0)
          || ', "review_without_visit": false}'"""


@query(
    "j3_chat_messages",
    f"""SELECT page_id, 'system,user,assistant' AS roles,
               md5('BUSINESS: ' || url || chr(10) || 'AUTHOR: ' || chr(10) || 'RATING: ' || (page_id % 5 + 1)
               || chr(10) || 'TEXT: ' || html || chr(10) || 'HAS_URL: '
               || (contains(html, 'http://') OR contains(html, 'https://')) || chr(10) || 'HAS_PHOTO: '
               || (page_id % 3 = 0)) AS user_turn, {GOLD} AS assistant_turn FROM pages""",
)
def chats(spark, sf):
    rows = _page_rows(spark, sf)
    turns = rows.select("page_id", tx.chat_messages(rows).alias("m"))
    return turns.select(
        "page_id",
        F.array_join(F.transform("m", lambda t: t["role"]), ",").alias("roles"),
        F.md5(F.get("m", F.lit(1))["content"]).alias("user_turn"),
        F.get("m", F.lit(2))["content"].alias("assistant_turn"),
    )


@query("j4_gold_answer", f"SELECT page_id, {GOLD} AS answer FROM pages")
def gold(spark, sf):
    return _page_rows(spark, sf).select("page_id", tx.gold_answer().alias("answer"))


@query(
    "j5_tokens",
    with_views(
        f"SELECT seq, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS joined FROM"
        f" (SELECT seq, {TOKENS} AS t FROM reviews)",
        "reviews",
    ),
)
def token_lists(spark, sf):
    rows = reviews(spark, sf).select("seq", tx.tokens("text").alias("t"))
    return rows.select("seq", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("joined"))


VOCAB = f"""SELECT token, freq, 1 + row_number() OVER (ORDER BY encode(token)) AS id FROM
            (SELECT token, count(*) AS freq FROM (SELECT unnest({TOKENS}) AS token FROM reviews)
             GROUP BY token HAVING count(*) >= 2)"""


@query("j6_vocabulary", with_views("SELECT token, freq, id FROM vocab", "reviews", vocab=VOCAB))
def vocabulary(spark, sf):
    return build_vocab(reviews(spark, sf))


@query(
    "j7_encode",
    with_views(
        """SELECT seq, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos)) AS ids, count(*) AS n,
                  CAST(sum(id) AS BIGINT) AS id_sum
           FROM (SELECT p.seq, p.pos, CASE WHEN c.token IS NULL THEN 0 ELSE coalesce(v.id, 1) END AS id
                 FROM (SELECT seq, unnest(range(1, 257)) AS pos FROM reviews) p
                 LEFT JOIN cut c ON p.seq = c.seq AND p.pos = c.pos LEFT JOIN vocab v ON c.token = v.token)
           GROUP BY seq""",
        "reviews",
        vocab=VOCAB,
        cut=f"""SELECT seq, unnest({TOKENS}[1:256]) AS token,
                       unnest(range(1, least(len({TOKENS}), 256) + 1)) AS pos FROM reviews""",
    ),
)
def encoded(spark, sf):
    rows = reviews(spark, sf)
    ids = encode(rows, build_vocab(rows))
    return ids.select(
        "seq",
        F.md5(F.array_join("ids", ",")).alias("ids"),
        F.size("ids").cast("long").alias("n"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"),
    )


@query(
    "j8_model_output",
    """SELECT doc_id, kind IN (0, 1, 4) AS irrelevant_content, kind IN (0, 2) AS advertisement,
              kind = 3 AS review_without_visit FROM (SELECT doc_id, doc_id % 7 AS kind FROM documents)""",
)
def model_outputs(spark, sf):
    answers = [
        '{"irrelevant_content": true, "advertisement": 1}',
        '```{"irrelevant_content": "false", "advertisement": 0} ',
        '{"advertisement": [0], "review_without_visit": ""}',
        '{"irrelevant_content": null, "review_without_visit": 0.5}',
        '{"irrelevant_content": {"a": 1}}',
        '{"irrelevant_content": true} and more',
        "{not json}",
    ]
    answer = F.get(F.array(*[F.lit(a) for a in answers]), (F.col("doc_id") % 7).cast("int"))
    rows = table(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit("\n"), answer).alias("output")
    )
    # the texts hold no braces, so the last object is the answer
    return rows.select("doc_id", tx.parse_model_output("output").alias("p")).select("doc_id", "p.*")
