"""WARC, chat, language model, near-duplicates, token counts, BPE and the pipeline."""

import contextlib
import hashlib
import io
import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reviewlens.llm import chat, hpylm, lexicon_bpe, setsketch, tokencount, warc
from reviewlens.llm.queries import tokenizer_file
from reviewlens.sources.scratch import scratch_path

DOC = "doc_id long, text string"


def test_archives_come_back_as_written(spark):
    tricky = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n" * 3
    pages = [(1, "http://a/1", "x" * 100), (2, "http://a/2", "x" * 100), (3, "u", "short"), (4, "u", "short")]
    pages += [(5, "bad\r\nurl", tricky), (6, None, None), (7, "", ""), (0, "z", "x" * 100), (8, "h", "é" * 50), (9, "h", "é" * 50)]
    pages += [(10 + k, "hot", "y" * 200) for k in range(60)] + [(3, "u", "short"), (None, "n", "x" * 100), (99, "n", "z" * 99)]
    path = scratch_path(spark, "archives")
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, type string")
    warc.write_archives(df.repartition(4), path, file_records=20, floor=10)
    records = warc.read_archives(spark, path)
    found = {r.page_id: r for r in warc.captures(records).collect()}
    assert len(found) == len(pages) - 1 == warc.captures(records).count()
    firsts = {}
    for i, _, h in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        raw = (h or "").encode()
        first = firsts.setdefault(raw, i) if len(raw) >= 100 else i
        kind = "response" if first == i else "revisit"
        assert tuple(found[i][c] for c in ("payload_bytes", "payload_digest", "record_type", "refers_to")) == (
            len(raw), hashlib.sha256(raw).hexdigest(), kind, None if first == i else first
        )
    nested = warc.assemble(records).filter("metadata.page_id = 5").first()
    assert bytes(nested.response.payload).decode() == tricky and nested.response.target_uri == "bad%0D%0Aurl"
    assert nested.request.record_id and warc.assemble(records.filter("type <> 'request'")).first().request is None
    empty = scratch_path(spark, "archives")
    warc.write_archives(df.limit(0), empty)
    assert warc.captures(warc.read_archives(spark, empty)).isEmpty()


def test_repeated_pages_come_back_each(spark, tmp_path):
    """op3 on a table with repeated rows returns what its SQL returns."""
    import duckdb

    from reviewlens.llm import queries

    pages = [(1, "a", "x" * 100)] * 3 + [(2, "a", "x" * 100)] * 2 + [(3, "u", "short")] * 2 + [(4, None, None)] * 40 + [(5, "v", "z")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    df.write.parquet(str(tmp_path / "pages.parquet"))
    found = sorted(tuple(x) for x in queries.op3(spark, str(tmp_path)).collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    assert sorted(map(str, found)) == sorted(map(str, db.execute(f"SELECT {names} FROM ({queries.OP3_SQL})").fetchall()))
    path = scratch_path(spark, "archives")
    warc.write_archives(df, path, floor=10, repeats=True)
    assert warc.captures(warc.read_archives(spark, path)).count() == len(pages)


def test_records_of_plain_and_memberwise_archives():
    import gzip

    one = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 6\r\n\r\nWARC/1\r\n\r\n"
    for raw in (one + one, gzip.compress(one) + gzip.compress(one), gzip.compress(one + one)):
        assert [b for _, b in warc.records_of(raw)] == [b"WARC/1"] * 2
    assert len(list(warc.records_of(one + one[:-8]))) == 1 and list(warc.records_of(b"")) == []


def test_chats_are_reversible_and_checked(spark):
    r = random.Random(6)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "\\", "[", "<", "a", "é", "\n", "[ROLE]", "[/TURN]", "<\\\\/s>", "$1", "[OUT]"]
    rows = []
    for c in range(60):
        for t in range(r.randint(1, 5)):
            role = r.choice(["system", "user", "assistant", "tool", "[/ROLE]x", "", None])
            rows.append((c, r.choice([t, 0, None]), role, r.choice([None, "", "".join(r.choice(bits) for _ in range(8))])))
    rows += rows[:5] + [(None, 0, "user", "q")]
    df = spark.createDataFrame([(*x, "n") for x in rows], "conv_id long, turn long, role string, text string, valid string")
    template = chat.Template()
    out = chat.format_chats(df, template).withColumns(
        {"read": template.parse(F.col("formatted")), "loss": chat.loss_text(F.col("segments"), template)}
    )
    found = {x.conv_id: x for x in out.collect()}
    assert set(found) == {x[0] for x in rows}
    for c, x in found.items():
        turns = sorted(((t is not None, t or 0, o or "", s or "") for k, t, o, s in rows if k == c))
        assert [(y.role, y.text) for y in x.read] == [(o, s) for *_, o, s in turns]
        assert x.loss == "".join(s for *_, o, s in turns if o == "assistant")
        for y in x.segments:
            if y.text not in template.controls:
                assert not any(m in y.text for m in template.controls) or y.text.startswith("[ROLE]")
    assert chat.format_chats(df.limit(0)).isEmpty()


def test_turn_order(spark):
    orders = {1: "sua", 2: "ua", 3: "uaua", 4: "u", 5: "su", 6: "au", 7: "uua", 8: "sus", 9: "uax", 10: "ssu"}
    name = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(k, t, name[c], "t") for k, v in orders.items() for t, c in enumerate(v)]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {x.conv_id: (x.valid, x.error_turn) for x in out.collect()}
    assert found == {1: (True, None), 2: (True, None), 3: (True, None), 4: (False, None), 5: (False, None), 6: (False, 0),
                     7: (False, 1), 8: (False, 2), 9: (False, 2), 10: (False, 1)}


def brute_components(docs):
    sets = {}
    for d, t in docs:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", w) if x]
        sets[d] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {(d, len(sets[d]), find(d), find(d) == d) for d in ids}


@pytest.mark.parametrize("block,columns", [(256, 8192), (3, 16)])
def test_components_equal_brute_force(spark, monkeypatch, block, columns):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(setsketch, "CELL_COLUMNS", columns)
    r = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    docs, base = [], [r.choice(words) for _ in range(90)]
    for k in range(120):  # a chain of edits: neighbours are linked, the ends are not
        base = base.copy()
        for _ in range(2):
            base[r.randrange(len(base))] = r.choice(words)
        docs.append((k * 7 % 120, " ".join(base)))
    docs += [(200 + k, docs[3][1].upper()) for k in range(60)]
    far = [r.choice(words) for _ in range(100)]
    for k in range(80):  # copies of one text, each too far from most others
        own = far.copy()
        for at in r.sample(range(100), 1 + k % 4):
            own[at] = f"own{k}-{at}"
        docs.append((500 + k, " ".join(own)))
    docs += [(300 + k, " ".join(r.choice(words) for _ in range(r.randint(0, 8)))) for k in range(60)]
    docs += [(400, None), (401, ""), (402, " \n"), (403, "one"), (404, "ONE"), (405, "É a"), (406, "é a"), (407, "\x1fa b")]
    df = spark.createDataFrame([(*x, 1) for x in docs], DOC + ", n_shingles int").repartition(5)
    found = setsketch.cluster(df).collect()
    assert {tuple(x) for x in found} == brute_components(docs) and len(found) == len(docs)


def test_components_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, "q")], DOC)
    found = sorted(map(tuple, setsketch.cluster(df).collect()), key=repr)
    assert found == sorted([(None, 2, None, False), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 1, 3, True)], key=repr)
    assert setsketch.cluster(df.limit(0)).isEmpty()


def test_components_of_a_doc_id_with_two_texts(spark):
    a, b = ("".join(f"{c}{k} " for k in range(60)) for c in "pq")
    rows = [(5, a), (5, b), (7, a + "tail"), (9, b + "tail"), (4, a), (4, "other words than those"), (11, "alone")]
    found = {tuple(x) for x in setsketch.cluster(spark.createDataFrame(rows, DOC)).select("doc_id", "component_id").collect()}
    assert found == {(5, 4), (7, 4), (9, 4), (4, 4), (11, 11)}


def test_near_duplicates_shuffle_no_text(spark, monkeypatch):
    plans, write = [], setsketch.materialise

    def noted(df, name="frame"):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain("formatted")
        plans.append(plan.getvalue())
        return write(df, name)

    monkeypatch.setattr(setsketch, "materialise", noted)
    r = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(r.choice(words) for _ in range(40))) for k in range(150)]
    docs += [(200 + k, docs[k][1] + " tail") for k in range(40)]
    docs += [(k, t.upper() + "\n") for k, t in docs[:5]] + [(None, docs[7][1]), (None, "x y"), (300, None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every table were large
    try:
        found = [tuple(x) for x in setsketch.cluster(spark.createDataFrame(docs, DOC)).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert set(found) == brute_components([x for x in docs if x[0] is not None]) | {(None, 37, None, False), (None, 1, None, False)}
    assert len(found) == len(docs) and len(plans) > 9
    assert not [p for p in plans if re.search(r"Exchange\s+Input \[\d+\]: \[[^\]]*\btext#", p)]


@pytest.mark.parametrize("largest", [1 << 26, 64])
def test_map_of_documents_loses_none(spark, monkeypatch, largest):
    monkeypatch.setattr(setsketch, "LARGEST_MAP", largest)
    docs = spark.range(-3000, 3000).selectExpr("id as doc_id", "string(id) as text").unionByName(
        spark.createDataFrame([(None, "a"), (50, "b")], DOC)
    )
    wanted = spark.range(-3000, 3000, 50).selectExpr("id as doc_id")
    found = [tuple(x) for x in setsketch._mapped(docs, wanted).collect()]
    assert {(k, str(k)) for k in range(-3000, 3000, 50)} | {(50, "b")} <= set(found)
    assert len(found) == len(set(found)) and (largest == 64 or len(found) < 1000)
    assert setsketch._mapped(docs, wanted.limit(0)).isEmpty()


def _joined(a, b, names):
    name = {int(x): int(x) for x in names}
    for x, y in zip(a, b, strict=True):
        ends = name[int(x)], name[int(y)]
        name = {k: min(ends) if w in ends else w for k, w in name.items()}
    return name


def test_forest_joins_what_links_join():
    r = np.random.default_rng(3)
    for n in (0, 1, 5, 60):
        a, b = r.integers(0, 80, n), r.integers(0, 80, n)
        u, v = setsketch._forest(a, b)
        names = np.concatenate([a, b])
        assert len(set(u)) == len(u) and _joined(a, b, names) == _joined(u, v, names)


def test_registers_merge_and_estimate():
    r = np.random.default_rng(0)
    x = r.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b, both = np.sort(x[:2000]), np.sort(x[400:2400]), np.sort(x[:2400])
    regs = [setsketch.registers(s, np.array([0, len(s)])) for s in (a, b, both)]
    assert (setsketch.merge(regs[0], regs[1]) == regs[2]).all()
    found = setsketch.estimate(regs[0], regs[1], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(found - 1600 / 2400) < 0.12


def test_scores(spark):
    r = random.Random(1)
    words = ["the", "cat", "dog", "Sat", "on", "é", "mat."]
    docs = [(k, " ".join(words[(j * j + k % 3) % 7] for j in range(r.randint(0, 60))), k % 10 == 0) for k in range(200)]
    docs += [(500, None, True), (501, "", True), (502, "never seen  before", True), (502, "never seen  before", True), (None, "the", True)]
    df = spark.createDataFrame([(*d, 0.0) for d in docs], DOC + ", held_out boolean, score double").repartition(3)
    learned = df.filter("not held_out")
    model = hpylm.fit(learned, bucket_bytes=2000)
    found = hpylm.score(df, model).collect()
    assert len(found) == len(docs) and model.buckets > 3
    cut = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None]
    c = {}
    for _, t, held in docs:
        for w in cut(t) if not held else []:
            c[w] = c.get(w, 0) + 1
    n, v, texts = sum(c.values()), len(c), {d: (t, h) for d, t, h in docs}
    for x in found:
        w = cut(texts[x.doc_id][0])
        base = sum(math.log10((c.get(y, 0) + 0.1) / (n + 0.1 * (v + 1))) for y in w)
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (texts[x.doc_id][1], len(w), sum(y in c for y in w), n)
        assert abs(x.base_score - base) < 1e-9 and x.score < 0
    held = [x for x in found if x.held_out and x.doc_id is not None and x.doc_id < 500]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)
    one = hpylm.fit(learned)  # another layout of the same words
    assert one.samples[0].tokens == n and one.samples[0].words == v
    assert hpylm.score(df.limit(0), model).isEmpty()
    blank = hpylm.score(df, hpylm.fit(learned.limit(0))).first()
    assert blank.n_known == 0 and blank.score <= 0


def test_predictions_of_a_context_add_up(spark):
    df = spark.createDataFrame([(k, "a b a c b b a"[: k % 13]) for k in range(50)], DOC)
    model = hpylm.fit(df)
    row = model.state.collect()[0].asDict()
    b, s = hpylm.Bucket(row), model.samples[-1]
    t2, t1, t0 = b.sample(-1)
    c1, c0 = b.below(t2), b.root_customers(t1)
    p0 = s.root(c0, t0)
    rest = s.root(np.zeros(1), np.zeros(1))
    assert abs(p0.sum() + rest[0] - 1) < 1e-9
    for u in np.unique(b.context):
        p1 = np.zeros(len(b.words))
        for w in range(len(b.words)):
            k = np.flatnonzero((b.parent_word == w) & (b.parent == u >> 8))
            pick = (c1[k], t1[k]) if len(k) else (np.zeros(1), np.zeros(1))
            p1[w] = s.middle(*pick, np.array([u >> 8]), p0[w : w + 1])[0]
        own = b.context == u
        full = np.zeros((2, len(b.words)))
        full[:, b.word[own]] = b.c[own], t2[own]
        p = s.leaf(*full, np.full(len(b.words), u), p1)
        assert p.sum() < 1 and abs(p.sum() + s.leaf(0, 0, u, s.middle(0, 0, u >> 8, rest[0])) - 1) < 1e-9


def test_a_context_is_the_whole_word_before(spark):
    """Words that end alike are told apart, and predictions after each of them add up."""
    learned = spark.createDataFrame([(k, "great cat" if k % 2 else "treat dog") for k in range(400)], DOC)
    model = hpylm.fit(learned)
    asked = [(k, t, True) for k, t in enumerate(("great cat", "great dog", "treat dog", "treat cat", "other cat"))]
    found = {r.doc_id: r.score for r in hpylm.score(spark.createDataFrame(asked, DOC + ", held_out boolean"), model).collect()}
    assert found[0] - found[1] > 1 and found[2] - found[3] > 1 and found[0] > found[4]
    row = model.state.collect()[0].asDict()
    b, s = hpylm.Bucket(row), model.samples[-1]
    customers, tables = hpylm._ints(row["after"], "u8"), hpylm._ints(row["after_tables"][-1], "u8")
    t3, (t2, t1, t0) = b.seats(-1), b.sample(-1)
    c1, p0, rest = b.below(t2), s.root(b.root_customers(t1), t0), s.root(np.zeros(1), np.zeros(1))[0]
    assert len(b.own) == 5 and customers.sum() == 1200 and tables.sum() == t3.sum()
    for u, key in enumerate(b.own):
        end, total = int(key) >> 48, 0.0
        for w in [*range(len(b.words)), None]:
            at = lambda names, mine, x: sum(x[k] for k in np.flatnonzero((names == w) & mine)) if w is not None else 0  # noqa: B023, E731
            p1 = s.middle(at(b.parent_word, b.parent == end >> 8, c1), at(b.parent_word, b.parent == end >> 8, t1), end >> 8, rest if w is None else p0[w])
            p2 = s.leaf(at(b.word, b.context == end, b.c), at(b.word, b.context == end, t2), end, p1)
            total += s.word(at(b.pair_word, b.at == u, b.n), at(b.pair_word, b.at == u, t3), customers[u], tables[u], p2)
        assert abs(total - 1) < 1e-9


def test_scores_follow_from_the_state_of_all_buckets(spark):
    """Many buckets, homes and rounds: each token's probability from totals added up here, also in contexts of other buckets."""
    r = random.Random(4)
    words = ["w%d" % k for k in range(60)] + ["é", "Ab", "ab"]
    docs = [(k, " ".join(r.choice(words[: 20 + k % 44]) for _ in range(r.randint(0, 40)))) for k in range(300)]
    learned = spark.createDataFrame(docs, DOC).repartition(3)
    model = hpylm.fit(learned, bucket_bytes=300)
    assert model.buckets > 2 * hpylm.PER_ROUND
    seen, totals = [{} for _ in range(4)], [[{}, {}] for _ in model.samples]
    for row in model.state.collect():
        b = hpylm.Bucket(row.asDict())
        for k in range(len(model.samples)):
            t3, (t2, t1, t0) = b.seats(k), b.sample(k)
            for name, x, y, level in (
                (zip(b.words[b.pair_word], b.own[b.at]), b.n, t3, 0), (zip(b.words[b.word], b.context), b.endings(t3), t2, 1),
                (zip(b.words[b.parent_word], b.parent), b.below(t2), t1, 2), (((w,) for w in b.words), b.root_customers(t1), t0, 3),
            ):
                for key, c, t in zip(name, x, y):
                    seen[level].setdefault((k, *map(int, key)), (int(c), int(t)))
            for u, c, t in zip(b.own[b.at], b.n, t3):
                for table, x in zip(totals[k], (c, t)):
                    table[int(u)] = table.get(int(u), 0) + int(x)
    asked = docs + [(1000 + k, f"w{k % 60} w{k % 7} new{k} w{k % 60} Ab") for k in range(100)]
    found = hpylm.score(spark.createDataFrame([(*d, False) for d in asked], DOC + ", held_out boolean"), model).collect()
    texts = dict(asked)
    assert len(found) == len(asked)
    for x in found:
        out, context, _ = hpylm.tokens(pa.array([texts[x.doc_id]]))
        want = 0.0
        for w, u in zip(out.tolist(), context.tolist()):
            p, end = 0.0, u >> 48
            for k, s in enumerate(model.samples):
                get = lambda level, *key: seen[level].get((k, w, *key), (0, 0))  # noqa: B023, E731
                p1 = s.middle(*get(2, end >> 8), end >> 8, s.root(*get(3)))
                p += s.word(*get(0, u), totals[k][0].get(u, 0), totals[k][1].get(u, 0), s.leaf(*get(1, end), end, p1))
            want += math.log10(p / len(model.samples))
        assert abs(x.score - want) < 1e-9


def test_seating_has_the_right_distribution():
    """Many customers of one dish, alone in a restaurant: tables as the Stirling numbers say."""
    d, p, c, n = 0.5, 0.3, 4, 40_000
    odds = hpylm.seating_odds(d)
    t = np.ones(n, np.int64)
    t = hpylm.resample(np.full(n, c), t, np.full(n, p), t.copy(), odds, d, 40, np.random.default_rng(0))
    stirling = {1: (1 - d) * (2 - d) * (3 - d), 4: 1.0}
    rows = {(1, 1): 1.0}
    for m in range(2, c + 1):
        for k in range(1, m + 1):
            rows[m, k] = rows.get((m - 1, k - 1), 0) + (m - 1 - k * d) * rows.get((m - 1, k), 0)
    assert abs(rows[4, 1] - stirling[1]) < 1e-12
    weight = [rows[c, k] * math.prod(hpylm.THETA + d * j for j in range(k)) * p**k for k in range(1, c + 1)]
    got = np.bincount(t, minlength=c + 1)[1:] / n
    assert np.abs(got - np.array(weight) / sum(weight)).max() < 0.02


def test_seating_of_many_customers_has_the_right_distribution():
    """A thousand customers of one dish, from the first seating through the moves of a run."""
    c, rest, n = 1000, 20, 4000
    for d, p in ((0.5, 0.3), (0.8, 0.9), (0.3, 0.01)):
        log = np.full(c + 1, -np.inf)
        log[0] = 0.0
        for m in range(1, c + 1):  # row by row; m - 1 - k d is only needed for k < m
            stay = log + np.log(np.maximum(m - 1 - np.arange(c + 1) * d, 1e-300))
            stay[m:] = -np.inf
            stay[0] = -np.inf
            log = np.logaddexp(np.concatenate([[-np.inf], log[:-1]]), stay)
        weight = log[1:] + np.cumsum(np.log((hpylm.THETA + d * (rest + np.arange(c))) * p))
        weight = np.exp(weight - weight.max())
        upto = np.cumsum(weight) / weight.sum()
        odds, random_ = hpylm.seating_odds(d), np.random.default_rng(1)
        t = np.full(n, int(c**d))
        for moves in [hpylm.BURN] + [hpylm.MOVES] * (hpylm.SAMPLES - 1):
            before = t
            t = hpylm.resample(np.full(n, c), t, np.full(n, p), t + rest, odds, d, moves, random_)
            got = np.cumsum(np.bincount(t, minlength=c + 1)[1:]) / n
            assert np.abs(got - upto).max() < 0.035
        assert abs(np.corrcoef(before, t)[0, 1]) < 0.3  # one sample says little of the next


def test_table_counts_of_any_number_of_customers():
    """One table has the known weight, and a million customers are not left at the first seating."""
    for c in (10**3, 10**6, 10**9):
        exact = math.log(0.7) + math.lgamma(c - 0.7) - math.lgamma(0.3) - math.lgamma(c + 1)
        assert abs(hpylm.log_tables(np.array([c]), np.array([1]), 0.7)[0] - exact) < 1e-4
    c, d, n = 10**6, 0.5, 500
    first = np.full(n, int(c**d))
    args = hpylm.seating_odds(d), d, hpylm.BURN, np.random.default_rng(2)
    t = hpylm.resample(np.full(n, c), first, np.full(n, 0.1), first + 1000, *args)
    assert np.abs(t - first).mean() > 12 * hpylm.SAMPLES and t.std() > hpylm.SAMPLES


ALPHABET = ["a", "th", "ing", " ", "  ", "\n", "É", "ß", "İ", "Σ", "'s", "'", "12", "½", "é", "\x1c", "\x85", "\xa0", "😀", "漢字",
            "<|endoftext|>", "<|", "<s>", "</s>", "▁", ".", "!!", "ª", "ſ", "\x00", "　", "ﬁ", "the", " of"]


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_token_counts_equal_the_library_and_fill_the_cache(spark):
    import sentencepiece

    model = tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = [(k, t, 0) for k, t in enumerate(texts(600, 1))] + [(900, None, 0), (901, "", 0), (None, "x", 0)] + [(910, "copy " * 50, 0)] * 40
    df = spark.createDataFrame(docs, DOC + ", n_tokens int").repartition(4)
    cache = scratch_path(spark, "cache")
    found = tokencount.count_tokens(df, cache, model)
    assert sorted(map(str, ((x.doc_id, x.n_bytes, x.n_tokens) for x in found.collect()))) == sorted(
        str((d, len((t or "").encode()), len(library.encode(t or "")))) for d, t, _ in docs
    )
    held = spark.read.parquet(cache).count()
    assert held == len({t or "" for _, t, _ in docs})
    more = spark.createDataFrame([(1, "copy " * 50), (2, "new text")], DOC)
    assert {x.doc_id: x.n_tokens for x in tokencount.count_tokens(more, cache, model).collect()} == {
        1: len(library.encode("copy " * 50)), 2: len(library.encode("new text"))
    }
    assert spark.read.parquet(cache).count() == held + 1
    assert tokencount.count_tokens(more.limit(0), cache, model).isEmpty()


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    raw = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_str(raw.decode())
    docs = [(k, t) for k, t in enumerate(texts(800, 2))] + [(900, None), (901, ""), (902, "the thing " * 3000), (902, "again")]
    df = spark.createDataFrame([(*d, "old") for d in docs], DOC + ", ids string").repartition(3)
    for words in (0, 5, 1000):
        lexicon = lexicon_bpe.frequent_words(df, raw, words=words)
        found = lexicon_bpe.encode(df, raw, lexicon).collect()
        got = sorted(((x.doc_id, struct.unpack(f"<{x.n_tokens}I", x.ids), x.decoded) for x in found))
        want = []
        for d, t in docs:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((d, tuple(ids), library.decode(ids, skip_special_tokens=False)))
        assert got == sorted(want)
    assert lexicon_bpe.encode(df.limit(0), raw, lexicon).isEmpty()


def test_lexicon_is_minimal_and_exact():
    entries = [("tap", [1]), ("taps", [2, 3]), ("top", [4]), ("tops", []), ("é", [7, 8, 9])]
    found = lexicon_bpe.Lexicon(lexicon_bpe.compile_lexicon(entries))
    for word, ids in entries:
        assert found.find(word.encode()) == ids
    assert [found.find(x) for x in (b"", b"t", b"ta", b"tapss", b"x", b"\xc3")] == [None] * 6
    # a and o lead to one state, as do tap-s and top-s: t . p s, and the two bytes of é
    assert len(found.final) == 6
    assert lexicon_bpe.Lexicon(lexicon_bpe.compile_lexicon([])).find(b"a") is None


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_stages_keep_columns_and_drop_what_they_reject(spark, staged):
    for name, before, after in staged[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert after.exceptAll(before).isEmpty()
    near = staged[2]
    rows = [(x.doc_id, x.text) for x in near[1].collect()]
    assert {x.doc_id for x in near[2].collect()} == {d for d, _, _, kept in brute_components(rows) if kept}
    last = staged[-1]
    assert last[2].count() == last[1].count() and last[2].filter("n_tokens * 4 <> octet_length(ids)").isEmpty()
    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {x.doc_id for x in whole.collect()} == {x.doc_id for x in last[2].collect()}


def test_stages_take_odd_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.limit(40).withColumns({c: F.lit("own") for c in ("toxicity", "lang_pred", "lang_score", "n_hit", "kept")})
    nulls = spark.createDataFrame([(None, None, None, None, None, *["own"] * 5), (10**6, "", "en", "s", 0, *["own"] * 5)], odd.schema)
    odd = odd.unionByName(nulls).unionByName(odd.limit(3))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, odd, sf)
        assert found.columns == odd.columns and {x.lang_pred for x in found.collect()} <= {"own"}
        assert stage(spark, docs.limit(0), sf).isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == odd.count()
    # without letters, and nothing else
    kept = corpus_pipeline.drop_languageless(spark, odd, sf)
    assert odd.count() - kept.count() == 2


def test_letterless_texts_go_without_a_language(spark):
    rows = [(1, "words here", None), (2, "12 34", None), (3, None, None), (4, "漢字", None)]
    df = spark.createDataFrame(rows, DOC + ", lang string")
    assert {x.doc_id for x in corpus_pipeline.drop_languageless(spark, df, "").collect()} == {1, 4}
