"""Source divergence, suffix-array removal of repeats, and fill-in-middle: brute force, round trips and edges."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reviewlens.llm import divergence, fim, suffixes

# ---------------------------------------------------------------- suffixes


def brute_removed(texts, length):
    """Removed byte flags of each text, by a table of all windows."""
    seen = Counter()
    for t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(gone)
    return out


def runs_of(flags):
    return [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(flags))]


def check_repeats(spark, texts, ids=None, **how):
    how = {"length": 40, "gram": 8, "step": 10} | how
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    raw = [(t or "").encode() for t in texts]
    wanted = sorted(
        (i is None, i or 0, len(t), tuple(runs_of(g)), bytes(b for b, x in zip(t, g, strict=True) if not x))
        for i, t, g in zip(ids, raw, brute_removed(raw, how["length"]), strict=True)
    )
    rows = suffixes.drop_repeats(docs, **how).collect()
    found = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_bytes, tuple((x.begin, x.end) for x in r.spans), bytes(r.kept)) for r in rows
    )
    assert found == wanted


def test_repeats_of_random_texts(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "ö", "漢字", "x", "\n", "of", "the"]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 30))) for _ in range(12)]
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 5)):
            own = "".join(rng.choices("abcdefgh ", k=rng.randint(0, 60)))
            parts.append(own if rng.random() < 0.5 else rng.choice(passages)[rng.randint(0, 9) :])
        texts.append("".join(parts))
    check_repeats(spark, texts)


def test_repeats_in_repetitive_texts_and_edges(spark):
    shared = "".join(random.Random(1).choices("abcdefghij", k=60))
    texts = ["a" * 39, "a" * 40, "a" * 41, "b" * 300, "ab" * 100, "abc" * 77 + "x", "", None, shared, shared, "q" + shared + "r"]
    texts += [shared[:40] + "z" * 30, "y" * 17 + shared[20:], shared[:39], "\0" * 50 + shared[:20], "\0" * 45]
    check_repeats(spark, texts, ids=[None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 7, 9, 10, 11, 12, 13])


def test_repeats_that_cross_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET", 3)
    rng = random.Random(5)
    shared = "".join(rng.choices("abcdefghij", k=47))
    texts = ["".join(rng.choices("klmno", k=rng.randint(0, 3))) + shared + "".join(rng.choices("klmno", k=4)) for _ in range(200)]
    check_repeats(spark, texts)


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 64)
    monkeypatch.setattr(suffixes, "PIECE", 64)
    rng = random.Random(6)
    shared = "".join(rng.choices("abcdefghij", k=400))
    texts = ["".join(rng.choices("klmnop", k=k)) + shared[k : 200 + k] + "".join(rng.choices("klmnop", k=100)) for k in range(30)]
    batches = [pa.RecordBatch.from_pydict({"text_id": [b"%d" % i for i in range(30)], "text": texts})]
    rows = [r for b in suffixes.find_anchors(batches, 40, 8, True) for r in b.to_pylist()]
    for i, t in enumerate(texts):  # every window is in one slice
        own = sorted(w for r in rows if r["text_id"] == b"%d" % i for w in range(r["begin"], r["begin"] + r["windows"]))
        assert own == list(range(len(t) - 39))


def test_repeats_with_other_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "x", 2, b"k", 3)], "doc_id long, text string, n_bytes int, text_id binary, spans int")
    assert [tuple(r)[:2] for r in suffixes.drop_repeats(docs).collect()] == [(1, 1)]
    assert suffixes.drop_repeats(docs.limit(0)).collect() == []


def test_multikey_sort():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (300, 21)).astype(np.uint8) * 127
    rows[::3, 5:] = rows[0, 5:]
    order, common = suffixes.multikey_sort(rows)
    ordered = [bytes(rows[i]) for i in order]
    assert ordered == sorted(map(bytes, rows))
    for k in range(1, 300):
        same = next((i for i, (a, b) in enumerate(zip(ordered[k - 1], ordered[k], strict=True)) if a != b), 21)
        assert common[k] == same


# ---------------------------------------------------------------- divergence


def brute_audit(rows, min_docs, top):
    docs, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        langs[lang].update(words)
    out = []
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + (10**9 * (c[t] + 5)) // (n + 5 * len(kept)) for t in kept}

        own, whole = {k[1]: shares(c) for k, c in counts.items() if k[0] == lang}, shares(langs[lang])
        for a, p in own.items():
            pair = [(b, sum(abs(p[t] - q[t]) for t in kept)) for b, q in own.items() if b != a]
            term = [(t, p[t] - whole[t]) for t in kept if counts[lang, a][t] and p[t] > whole[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, a, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def divergence_rows():
    rng = random.Random(9)
    words = [f"w{c}" for c in "abcdefghijklmnopqrst"] + ["Über", "don't", "ÄÖ", "漢", "x1y"]
    rows = []
    for _ in range(400):
        lang, source = rng.choice(["de", "en", None]), rng.choice(["hot", "hot", "a", "b", None, "ç"])
        rows.append((lang, source, " ".join(rng.choices(words, k=rng.randint(0, 12), weights=range(1, 26)))))
    return rows + [("fr", "only", "wa"), ("it", "u", None), ("it", "v", ""), ("de", "empty", "12 34")] + rows[:5]


@pytest.mark.parametrize("block", [None, 1])
def test_audit_equals_brute_force(spark, monkeypatch, block):
    rows = divergence_rows()
    if block:  # every piece spills
        monkeypatch.setattr(divergence, "SIDE", 2)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    found = sorted(tuple(r) for r in divergence.audit(docs, min_docs=20, top=5).collect())
    assert found == brute_audit(rows, 20, 5)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_blocks_that_spill_give_the_same_frequencies():
    rows = divergence_rows()
    names = ("lang", "source", "text")
    batches = [pa.RecordBatch.from_pydict({n: [r[i] or "" for r in rows[k : k + 20]] for i, n in enumerate(names)}) for k in range(0, 400, 20)]

    def merged(limit):
        runs = [r for b in divergence.block_runs(batches, 4, limit) for r in b.to_pylist()]
        runs.sort(key=lambda r: (r["lang"], r["shard"]))
        assert all(r["terms"] == sorted(r["terms"]) for r in runs)
        lists = [pa.list_(x) for x in (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64())]
        kinds, cols = [pa.string(), pa.int32(), *lists], divergence.RUN_COLUMNS
        batch = pa.RecordBatch.from_arrays([pa.array([r[c] for r in runs], k) for c, k in zip(cols, kinds, strict=True)], cols)
        found = [tuple(r.values())[:5] for b in divergence.merge_runs([batch], 20) for r in b.to_pylist()]
        return len(runs), sorted(found)

    many, few = merged(1), merged(1 << 20)
    assert many[0] > 3 * few[0] and many[1] == few[1]


def test_pair_sums_that_are_sent_in_parts():
    rows = [("l", t, s, p, 1) for t in "abc" for s, p in (("x", 5), ("y", 9), ("z", 4))]
    batch = pa.RecordBatch.from_pydict(dict(zip(("lang", "term", "source", "p", "z"), map(list, zip(*rows, strict=True)), strict=True)))

    def total(limit):
        sums = Counter()
        for b in divergence.pair_corrections([batch], limit):
            for r in b.to_pylist():
                sums[r["lo"], r["hi"]] += r["value"]
        return sums

    assert total(1) == total(1 << 20)
    assert total(1)["x", "y"] == 3 * (abs(5 - 9) - abs(5 - 1) - abs(9 - 1))


# ---------------------------------------------------------------- fill-in-middle


def brute_fim(doc, text, seed="7", rate=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", pre, mid, suf, f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", pre, mid, suf, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("how", [{}, {"rate": 40, "spm": 10, "seed": "other"}])
def test_fill_in_middle_equals_brute_force(spark, how):
    rng = random.Random(4)
    texts = ["", None, "\n", "\n\n\n", "one", "one\n", "a\r\nb\rc\n", "x<P>y", "<S", "<M\n>", "P>\n<\nS>", "$1\\2\n{3}\n", "😀\nä\n z"]
    texts += ["".join(rng.choices(["a", "<", "P", "S", "M", ">", "\n", "é", "$", "\\"], k=rng.randint(1, 60))) for _ in range(300)]
    texts += ["line\n" * 30_000, "w" * 2_000_000, ("l" * 100_000 + "\n") * 3]
    rows = [(None if i % 50 == 7 else i % 290, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = fim.fill_in_middle(docs, **how).withColumn("back", fim.restore(fim.F.col("output"), fim.F.col("form"))).collect()
    assert len(found) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2:3])
    wanted = sorted([(d, t or "", *brute_fim(d, t, **how)) for d, t in rows], key=key)
    got = sorted([(r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.suffix, r.output) for r in found], key=key)
    assert got == wanted
    assert all(r.back == r.text for r in found)


def test_fill_in_middle_with_other_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a\nb\n", "x", 2, "y")], "doc_id int, text string, n string, a int, form string")
    assert fim.fill_in_middle(docs).columns == ["doc_id", "text", "n", "form", "prefix", "middle", "suffix", "output"]
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_fill_in_middle_stays_in_column_functions(spark):
    docs = spark.createDataFrame([(1, "a\nb\n")], "doc_id int, text string")
    plan = fim.fill_in_middle(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
