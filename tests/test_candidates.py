"""Near-duplicate candidates: recall against brute force, groups, and rows that stay in proportion to the reviews."""

import random
from itertools import combinations

from reviewlens.operators import candidates

WORDS = [f"w{i}" for i in range(400)]


def near_copies(rng, text, share):
    words = text.split()
    for i in rng.sample(range(len(words)), int(len(words) * share)):
        words[i] = rng.choice(WORDS)
    return " ".join(words)


def brute(rows, threshold=0.8):
    """Pairs (seq, seq) of one group at or above the threshold."""
    sets = {}
    for seq, group, text in rows:
        words = (text or "").split()
        grams = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        sets[seq] = (group, grams)
    return {
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a][0] == sets[b][0] and sets[a][1] and len(sets[a][1] & sets[b][1]) >= threshold * len(sets[a][1] | sets[b][1])
    }


def clusters(pairs, seqs):
    least = {s: s for s in seqs}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def test_recall_and_clusters(spark):
    rng = random.Random(8)
    rows = []
    for group in ("a", "b", None):
        for _ in range(25):
            text = " ".join(rng.choices(WORDS, k=rng.randint(8, 120)))
            rows += [(group, near_copies(rng, text, rng.choice([0, 0.005, 0.02, 0.04]))) for _ in range(rng.randint(1, 6))]
    rows += [("a", ""), ("a", None), ("b", "w1 w2"), ("b", "w1  w2"), (None, "w1 w2")]
    rng.shuffle(rows)
    rows = [(i, g, t) for i, (g, t) in enumerate(rows)]
    found = {r.seq: r.cluster for r in candidates.near_duplicates(spark.createDataFrame(rows, "seq long, g string, text string"), ["g"]).collect()}
    assert set(found) == {s for s, _, t in rows if t}
    pairs = brute(rows)
    met = [found[a] == found[b] for a, b in pairs]
    assert len(pairs) > 100 and sum(met) / len(met) >= 0.99
    want = clusters(pairs, found)
    assert all(want[s] == want[c] for s, c in found.items())  # nothing is joined that isn't linked


def test_rows_grow_with_the_reviews(spark):
    rng = random.Random(2)
    text = " ".join(rng.choices(WORDS, k=100))

    def edges(n):
        rows = [(i, "hot", near_copies(rng, text, 0.01)) for i in range(n)] + [(n + i, "hot", text) for i in range(n)]
        keyed = candidates.keyed_shingles(spark.createDataFrame(rows, "seq long, g string, text string"), ["g"])
        return candidates.similar_stars(candidates.shingle_sets(keyed, ["g"]), ["g"]).count()

    small, large = edges(150), edges(600)
    assert large <= candidates.BANDS * 600  # a row has one edge for each band at most
    assert large <= 6 * small  # four times the reviews; pairs would be sixteen times as many


def test_crowded_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(candidates, "CROWDED", 3)
    rng = random.Random(4)
    text = " ".join(rng.choices(WORDS, k=60))
    rows = [(i, near_copies(rng, text, 0.03)) for i in range(80)]
    found = {r.seq: r.cluster for r in candidates.near_duplicates(spark.createDataFrame(rows, "seq long, text string")).collect()}
    pairs = brute([(s, "", t) for s, t in rows])
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_no_rows(spark):
    assert candidates.near_duplicates(spark.createDataFrame([], "seq long, text string")).collect() == []


def test_shingles_are_written_once_and_sent_only_where_needed(spark, monkeypatch):
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(200)]
    texts += [(500, texts[7][1] + " more"), (501, texts[7][1])]
    written = {}

    def recording(df, name="frame", keep=candidates.materialise):
        out = keep(df, name)
        written.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(candidates, "materialise", recording)
    df = spark.createDataFrame(texts, "seq long, text string")
    found = {r.seq: (r.cluster, r.copies) for r in candidates.near_duplicates(df).collect()}
    assert found[500] == (7, 1) and found[501] == found[7] == (7, 2) and found[8] == (8, 1)
    holders = [f for frames in written.values() for f in frames if "shingles" in f.columns]
    assert [f.count() for f in holders] == [201, *[2 for _ in holders[1:]]]
