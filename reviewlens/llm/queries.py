"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import (
    chat,
    decontaminate,
    divergence,
    fim,
    hpylm,
    langid,
    lexicon_bpe,
    mtree,
    setsketch,
    suffixes,
    tokencount,
    toxicity,
    warc,
)
from reviewlens.sources.scratch import scratch_path

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> bytes:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


OP1_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM whole),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c USING (i) WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""


@query("op1_mtree_topk", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all rows for every row whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", mtree.integers(F.col("embedding")).alias("v"))
    return mtree.top_k(rows, rows.filter("vec_id % 100 = 0"))


OP2_SQL = r"""
WITH cut AS (
  SELECT 0 AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 1, CAST(item_id AS VARCHAR), text FROM benchmark
), split AS (
  SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM cut
), spans AS (
  SELECT id, least(13, len(w)) AS size, unnest([list_aggregate(w[i:i + least(13, len(w)) - 1], 'string_agg', ' ')
    for i in range(1, len(w) - least(13, len(w)) + 2)]) AS span
  FROM split WHERE kind = 1 AND len(w) > 0
), sizes AS (SELECT DISTINCT size FROM spans),
own AS (
  SELECT id, size, i, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS span FROM (
    SELECT id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM split, sizes WHERE kind = 0 AND len(w) >= size)
), hits AS (SELECT own.id, own.size, own.i, spans.id AS item FROM own JOIN spans USING (size, span)),
covered AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY id),
named AS (SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id)
SELECT CAST(split.id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM split LEFT JOIN covered USING (id) LEFT JOIN named USING (id) WHERE kind = 0
"""


@query("op2_decontaminate", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


OP3_SQL = """
WITH full_pages AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (SELECT payload_digest, min(page_id) AS first FROM full_pages WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> coalesce(first, page_id) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> coalesce(first, page_id) THEN first END AS refers_to
FROM full_pages LEFT JOIN firsts USING (payload_digest)
"""


@query("op3_warc", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a capture, read back and assembled."""
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path, repeats=True)
    found = warc.captures(warc.read_archives(spark, path))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*(?:/?INST|/?SYS|OUT|/?ROLE|/TURN)\]'))
    + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
      ELSE 20 + length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*(?:/?INST|/?SYS|OUT|/?ROLE|/TURN)\]')) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(mark, '' ORDER BY turn, role, text), 's?(?:ua)+') AS valid,
  CAST(nullif(length(regexp_extract(string_agg(mark, '' ORDER BY turn, role, text), '^s?(?:ua)*u?')), count(*)) AS INTEGER) AS error_turn
FROM (SELECT *, CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END AS mark FROM sized)
GROUP BY conv_id
"""


@query("op4_chat_format", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are full of control strings; digests of what is read back."""
    said = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    template = chat.Template()
    found = chat.format_chats(rows, template).withColumns(
        {"read": template.parse(F.col("formatted")), "loss": chat.loss_text(F.col("segments"), template)}
    )
    lines = F.transform("read", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n")))
    return found.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "error_turn",
    )


OP6_SQL = r"""
WITH cut AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest([list_aggregate(w[i:i + least(4, len(w)) - 1], 'string_agg', ' ')
    for i in range(1, len(w) - least(4, len(w)) + 2)]) AS s FROM cut WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)
), reached AS (
  WITH RECURSIVE walk AS (SELECT x AS doc_id, y AS other FROM links UNION SELECT walk.doc_id, links.y FROM walk JOIN links ON links.x = walk.other)
  SELECT doc_id, min(other) AS least FROM walk GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id,
  doc_id <= coalesce(least, doc_id) AS kept
FROM cut LEFT JOIN sizes USING (doc_id) LEFT JOIN reached USING (doc_id)
"""


@query("op6_setsketch_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents."""
    return setsketch.cluster(table(spark, sf_dir, "documents"))


def fold(doc: str, parts: int):
    """crc32 of an id as text, modulo ``parts``."""
    return F.crc32(F.col(doc).cast("string").cast("binary")) % parts


@query("op5_hpylm")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by a model of nine tenths of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 10) == 0).alias("held_out"))
    return hpylm.score(docs, hpylm.fit(docs.filter("not held_out")))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by a model that has seen the labels of three quarters of the ids."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.select("doc_id", "toxic").filter(fold("doc_id", 4) != 2))
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"),
    )


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by samples from three quarters of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = langid.learn(docs.filter(fold("doc_id", 4) != 2).select("text", "lang"))
    found = langid.identify(docs.select("doc_id", "text"), samples)
    held = (fold("doc_id", 4) == 2).alias("held_out")
    return found.select("doc_id", held, "lang_pred", F.col("lang_score").alias("score"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a cache that is empty at first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tokencount.count_tokens(docs, scratch_path(spark, "token-cache"), tokenizer_file("piece_bpe_32k.model"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query("op10_lexicon_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = tokenizer_file("word_bpe_49k.json")
    found = lexicon_bpe.encode(docs, vocabulary, lexicon_bpe.frequent_words(docs, vocabulary))
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP11_SQL = r"""
WITH own AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM own
), kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (
  SELECT lang, any_value(v) AS v, sum(c) AS n FROM counts JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) USING (lang) GROUP BY lang
), named AS (SELECT DISTINCT lang, source FROM own),
sums AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(c, 0) AS c,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 5)) // CAST(coalesce(sums.n, 0) + 5 * langs.v AS HUGEINT) AS p
  FROM named JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN sums USING (lang, source) LEFT JOIN counts USING (lang, source, term)
), whole AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(c) + 5)) // CAST(any_value(n) + 5 * any_value(v) AS HUGEINT) AS q
  FROM counts JOIN langs USING (lang) GROUP BY ALL
), far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM named a JOIN named b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of every language against the others and against the language."""
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP12_SQL = """
WITH own AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS x FROM documents),
sized AS (SELECT *, CAST(octet_length(x) AS BIGINT) AS n FROM own),
windows AS (SELECT r, i, md5(x[i + 1:i + 400]) AS w FROM (SELECT r, x, unnest(range(0, n - 399)) AS i FROM sized)),
starts AS (SELECT r, i FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)),
marked AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 400, true) AS fresh FROM starts),
numbered AS (SELECT r, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY r ORDER BY i) AS span FROM marked),
spans AS (SELECT r, span, min(i) AS b, max(i) + 400 AS e FROM numbered GROUP BY ALL),
ends AS (SELECT r, b, e FROM spans UNION ALL SELECT r, n, n FROM sized),
gaps AS (SELECT r, b, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b, e), 0) AS since FROM ends),
kept AS (SELECT r, string_agg(hex(x[since + 1:b]), '' ORDER BY since) AS h FROM gaps JOIN own USING (r) WHERE b > since GROUP BY r),
sums AS (SELECT r, count(*) AS n_spans, sum(e - b) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM sized LEFT JOIN kept USING (r) LEFT JOIN sums USING (r)
"""


@query("op12_suffix_dedup", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages."""
    found = suffixes.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x.end - x.begin)
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP13_SQL = r"""
WITH own AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, [CAST(('0x' || h[1 + 8 * k:8 + 8 * k]) AS BIGINT) for k in range(4)] AS x FROM own
), cut AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 100
      THEN 'plain' WHEN x[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(x[1] % (n + 1), x[2] % (n + 1))], '') AS prefix,
    array_to_string(units[least(x[1] % (n + 1), x[2] % (n + 1)) + 1:greatest(x[1] % (n + 1), x[2] % (n + 1))], '') AS middle,
    array_to_string(units[greatest(x[1] % (n + 1), x[2] % (n + 1)) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut by lines, and read back from the output."""
    found = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
