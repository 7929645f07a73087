"""The similarity scan against brute force, with copies, several blocks and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import similarity as si
from reviewlens.schemas import FuseConfig, ScanConfig


def fixture_vectors(seed=5):
    """Businesses of 1, 2 and many reviews; loose themes, chains of neighbours, many exact copies."""
    rng = np.random.default_rng(seed)
    rows, seq = [], 0
    for business, themes, per in (("one", 1, 1), ("two", 1, 2), ("big", 6, 14), ("mid", 3, 7)):
        centres = rng.normal(size=(themes, 6))
        for c in centres:
            for _ in range(per):
                v = c + rng.normal(scale=0.45, size=6)
                v = (v / np.linalg.norm(v)).astype(np.float32)
                for _ in range(int(rng.integers(1, 4)) if business == "big" and rng.random() < 0.2 else 1):
                    rows.append((business, seq, [float(x) for x in v]))
                    seq += 1
    order = rng.permutation(len(rows))
    return [(rows[i][0], int(n), rows[i][2]) for n, i in enumerate(order)]


def brute_clusters(x, threshold, min_samples):
    near = (x @ x.T) >= threshold
    np.fill_diagonal(near, True)
    core = near.sum(1) >= min_samples
    label = np.full(len(x), -1)
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        todo, label[i] = [i], i
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if label[j] == -1:
                    label[j] = i
                    if core[j]:
                        todo.append(j)
    return label


def brute(rows, topk, dup, threshold, min_samples):
    out = {}
    for business in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == business), key=lambda r: r[1])
        x = np.array([r[2] for r in mine])
        n, s = len(x), np.array(x) @ np.array(x).T
        off = s.copy()
        np.fill_diagonal(off, -np.inf)
        k = min(topk, n - 1)
        top = float(np.sort(off, axis=1)[:, -k:].mean()) if k else 0.0
        labels = brute_clusters(x, threshold, min_samples)
        best, scores = (0, 0.0), np.zeros(n)
        for c in set(labels) - {-1}:
            idx = np.flatnonzero(labels == c)
            if len(idx) > 1:
                sub = s[np.ix_(idx, idx)]
                best = max(best, (len(idx), (sub.sum() - np.trace(sub)) / (len(idx) * (len(idx) - 1))))
                scores[idx] = np.clip((sub.sum(1) - np.diag(sub)) / (len(idx) - 1), 0, 1)
        out[business] = dict(
            n=n,
            top=top,
            dup=float((off > dup).sum() / max(1, n * (n - 1))),
            clusters={mine[i][1]: mine[labels[i]][1] for i in range(n) if labels[i] != -1},
            best=best,
            scores={mine[i][1]: scores[i] for i in range(n)},
        )
    return out


@pytest.fixture(scope="module")
def vec(spark):
    return spark.createDataFrame(fixture_vectors(), "business string, seq long, vector array<float>").repartition(3)


@pytest.mark.parametrize("block_rows,min_samples", [(7, 2), (30, 4), (8192, 4)])
def test_scan_equals_brute_force(vec, block_rows, min_samples):
    cfg = ScanConfig(
        min_reviews=1,
        topk=5,
        dup_threshold=0.93,
        sim_threshold=0.85,
        high_sim_threshold=0.95,
        min_cluster_size=min_samples,
        block_rows=block_rows,
    )
    expected = brute(fixture_vectors(), 5, 0.93, 0.85, min_samples)
    high = brute(fixture_vectors(), 5, 0.93, 0.95, min_samples)
    for row in si.scan_businesses(vec, cfg).collect():
        want = expected[row.business]
        assert row.n_reviews == want["n"]
        assert row.mean_topk == pytest.approx(want["top"], abs=1e-9)
        assert row.dup_rate == pytest.approx(want["dup"], abs=1e-12)
        assert (row.max_cluster_size, pytest.approx(row.max_cluster_mean, abs=1e-6)) == want["best"]
        assert (row.max_high_cluster_size, pytest.approx(row.max_high_cluster_mean, abs=1e-6)) == high[
            row.business
        ]["best"]


@pytest.mark.parametrize("block_rows", [7, 8192])
def test_clusters_and_review_scores_equal_brute_force(vec, block_rows):
    cfg = FuseConfig(sim_threshold=0.85, min_samples=4, topk=5, dup_threshold=0.93, block_rows=block_rows)
    expected = brute(fixture_vectors(), 5, 0.93, 0.85, 4)
    blocks = si.block_vectors(vec, block_rows)
    near = si.neighbours(blocks, 5, 0.93, [0.85])
    clusters = si.density_clusters(blocks, near, [0.85], 4)
    # every copy belongs to the cluster of its lowest one
    members = vec.join(blocks.select("business", "vector", "rep"), ["business", "vector"]).join(
        clusters.select("business", "rep", "cluster"), ["business", "rep"]
    )
    found = {r.seq: r.cluster for r in members.collect()}
    assert found == {s: c for b in expected.values() for s, c in b["clusters"].items()}
    for row in si.review_scores(vec, cfg).collect():
        want = expected[row.business]
        assert row.peer_score == pytest.approx(want["scores"][row.seq], abs=1e-6)
        scaled = min(1.0, max(0.0, want["scores"][row.seq] * want["top"]))
        assert row.fraud_score == pytest.approx(scaled, abs=1e-6)


def test_a_third_of_all_rows_in_copies(spark):
    rows = [("b", i, [1.0, 0.0]) for i in range(3000)] + [("b", 3000, [0.0, 1.0]), ("b", 3001, [0.6, 0.8])]
    vec = spark.createDataFrame(rows, "business string, seq long, vector array<float>")
    blocks = si.block_vectors(vec, 8192)
    assert blocks.count() == 3
    near = si.neighbours(blocks, 5, 0.9, [0.9])
    row = si.dup_rate(near).first()
    assert row.dup_rate == pytest.approx(3000 * 2999 / (3002 * 3001))
    assert si.density_clusters(blocks, near, [0.9], 3).count() == 1
    scores = si.review_scores(vec, FuseConfig(sim_threshold=0.9, min_samples=3, dup_threshold=0.9))
    assert scores.count() == 3002
    assert scores.filter(F.col("peer_score") > 0.999).count() == 3000


def test_single_review_scores_zero(spark):
    vec = spark.createDataFrame([("a", 1, [1.0, 0.0])], "business string, seq long, vector array<float>")
    row = si.review_scores(vec).first()
    assert (row.peer_score, row.fraud_score) == (0.0, 0.0)
    assert si.cohesion(vec).first().mean_topk == 0.0


def test_min_reviews_drops_small_businesses(vec):
    found = si.scan_businesses(vec, ScanConfig(min_reviews=5)).select("business").collect()
    assert {r.business for r in found} == {"big", "mid"}


def test_pairs_of_distinct_texts(vec):
    blocks = si.block_vectors(vec, 7)
    found = {(r.seq_a, r.seq_b): (r.sim, r.copies_a, r.copies_b) for r in si.similar_pairs(blocks, 0.9).collect()}
    assert len(found) == si.similar_pairs(blocks, 0.9).count()
    reps = {}
    for business, seq, v in sorted(fixture_vectors(), key=lambda r: r[1]):
        reps.setdefault((business, tuple(v)), []).append(seq)
    keys = sorted(reps, key=lambda k: reps[k][0])
    expected = {}
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            sim = float(np.dot(a[1], b[1]))
            if a[0] == b[0] and sim >= 0.9:
                expected[(reps[a][0], reps[b][0])] = (pytest.approx(sim), len(reps[a]), len(reps[b]))
    assert found == expected


def test_flag_prefers_overall(spark):
    rows = [("a", 5, 0.9, 0.0, 3, 0.95, 3, 0.95), ("b", 5, 0.1, 0.0, 3, 0.95, 3, 0.95), ("c", 5, 0.1, 0.0, 0, 0.0, 0, 0.0)]
    df = spark.createDataFrame(
        rows,
        "business string, n_reviews long, mean_topk double, dup_rate double, max_cluster_size long,"
        " max_cluster_mean double, max_high_cluster_size long, max_high_cluster_mean double",
    )
    found = {r.business: (r.suspicious, r.reason) for r in si.flag_businesses(df).collect()}
    assert found == {"a": (True, "overall"), "b": (True, "subcluster"), "c": (False, "")}


def test_fusion_is_a_weighted_mean(spark):
    text = spark.createDataFrame([(1, 0.8)], "seq long, p_text double")
    scores = spark.createDataFrame([(1, 0.5), (2, 0.5)], "seq long, fraud_score double")
    assert si.fuse(text, scores).first().fused == pytest.approx(0.71)
    assert si.fuse(text, scores, w_text=0.0, w_fraud=0.0).first().fused == 0.0
    assert tuple(si.fuse_unmatched(text, scores).first()) == (0, 1)


def test_embeddings_are_unit_vectors_and_copies_agree(spark):
    df = spark.createDataFrame([(1, "Good food here"), (2, "good FOOD here"), (3, "bad")], "seq long, text string")
    found = {r.seq: np.array(r.vector) for r in si.embed(df).collect()}
    assert np.allclose(np.linalg.norm(found[1]), 1, atol=1e-6)
    assert np.allclose(found[1], found[2])
    assert found[1] @ found[3] < 0.5


def test_plugged_embedder(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "b")], "seq long, text string")

    def make():
        return lambda texts: [[len(t), 1.0] for t in texts]

    found = {r.seq: r.vector for r in si.embed_with(df, make).collect()}
    assert found[1] == pytest.approx([2 / 5**0.5, 1 / 5**0.5])


def themed_vectors(themes=12, per=60, dims=16):
    rng = np.random.default_rng(3)
    centres = np.linalg.qr(rng.normal(size=(dims, dims)))[0][:themes]
    rows = []
    for i in range(themes * per):
        v = centres[i % themes] + rng.normal(scale=0.02, size=dims)
        rows.append(("big", i, [float(x) for x in (v / np.linalg.norm(v)).astype(np.float32)]))
    return rows


def test_unlike_blocks_do_not_meet(spark):
    rows = themed_vectors()
    vec = spark.createDataFrame(rows, "business string, seq long, vector array<float>").repartition(3)
    blocks = si.block_vectors(vec, 30)
    count = blocks.select("block").distinct().count()
    index = si.block_index(blocks).withColumn("floor", F.lit(np.inf))
    needed = si.needed_cells(index, 0.9).count()
    assert count >= 12 and needed < 0.35 * count * (count - 1) / 2
    # vectors sent to cells with another block, against those that all cells would get
    cells = si._cells(blocks.select("business", "rep", "vector", "block", "blocks"), 0.9)
    assert cells.filter("cell_a <> cell_b").count() < 0.35 * len(rows) * (count - 1)


@pytest.mark.parametrize("block_rows", [30, 8192])
def test_pruned_cells_change_nothing(spark, block_rows):
    rows = themed_vectors()
    vec = spark.createDataFrame(rows, "business string, seq long, vector array<float>").repartition(3)
    cfg = ScanConfig(
        min_reviews=1, topk=5, dup_threshold=0.995, sim_threshold=0.99, high_sim_threshold=0.998, min_cluster_size=3, block_rows=block_rows
    )
    want = brute(rows, 5, 0.995, 0.99, 3)["big"]
    row = si.scan_businesses(vec, cfg).first()
    assert row.mean_topk == pytest.approx(want["top"], abs=1e-9)
    assert row.dup_rate == pytest.approx(want["dup"], abs=1e-12)
    assert (row.max_cluster_size, pytest.approx(row.max_cluster_mean, abs=1e-6)) == want["best"]
    x = np.array([r[2] for r in rows])
    pairs = {(a, b) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.99, 1)), strict=True)}
    found = si.similar_pairs(si.block_vectors(vec, block_rows), 0.99)
    assert {(r.seq_a, r.seq_b) for r in found.collect()} == pairs


def test_norms_of_any_size_are_bounded(spark):
    rng = np.random.default_rng(7)
    rows = [("b", i, [float(x) for x in rng.normal(size=4) * rng.choice([0.1, 1, 5])]) for i in range(150)]
    vec = spark.createDataFrame(rows, "business string, seq long, vector array<float>")
    x = np.array([np.float32(r[2]) for r in rows], dtype=np.float64)
    pairs = {(a, b) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 2.0, 1)), strict=True)}
    assert {(r.seq_a, r.seq_b) for r in si.similar_pairs(si.block_vectors(vec, 8), 2.0).collect()} == pairs


@pytest.mark.parametrize("block_rows,tile_rows", [(7, 25)])
def test_tiles_of_blocks_change_nothing(vec, monkeypatch, block_rows, tile_rows):
    monkeypatch.setattr(si, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(si, "AT_ONCE", 64)
    test_scan_equals_brute_force(vec, block_rows, 4)
    test_clusters_and_review_scores_equal_brute_force(vec, block_rows)


def test_small_blocks_send_rows_by_tiles(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    vec = spark.createDataFrame([("b", i, v.tolist()) for i, v in enumerate(x)], "business string, seq long, vector array<float>")
    monkeypatch.setattr(si, "TILE_ROWS", 300)
    sent, cells = [], si._cross_cells

    def counted(rows, tiles):
        sent.append(cells(rows, tiles))
        return sent[-1]

    monkeypatch.setattr(si, "_cross_cells", counted)
    near = si.neighbours(si.block_vectors(vec, 10), 5, 0.5, [0.5])
    # nothing can be left out here, yet a row goes to about four tiles, not to ninety blocks
    assert sent[0].count() <= 900 * 5
    assert near.count() <= 900 * 6
    exact = x.astype(float) @ x.T.astype(float)
    np.fill_diagonal(exact, -np.inf)
    assert si.mean_topk(near, 5).first().mean_topk == pytest.approx(np.sort(exact, axis=1)[:, -5:].mean())


def test_a_cell_holds_few_similarities_at_once():
    import tracemalloc

    import pyarrow as pa

    n, dims = 3000, 8
    x = np.random.default_rng(2).normal(size=(n, dims)).astype(np.float32)
    table = pa.table(
        {
            "business": ["b"] * n, "rep": np.arange(n), "w": np.ones(n, np.int64), "n": np.full(n, n),
            "vector": pa.array(list(x), pa.list_(pa.float32())), "block": np.zeros(n, np.int32), "tile": np.zeros(n, np.int32),
            "core_0": np.arange(n) % 2 == 0,
        }
    )
    key = (pa.scalar("b"), pa.scalar(0), pa.scalar(0))
    tracemalloc.start()
    si._neighbour_cell(5, 0.5, [0.5])(table)
    assert tracemalloc.get_traced_memory()[1] < 30 << 20
    tracemalloc.reset_peak()
    si._cluster_cell([0.5])(key, table)
    assert tracemalloc.get_traced_memory()[1] < 30 << 20
    tracemalloc.stop()


def test_every_review_of_every_business_is_clustered(spark, tmp_path):
    """Copies, businesses of fewer than five reviews, and copies too short to be similar to themselves."""
    duckdb = pytest.importorskip("duckdb")
    from reviewlens.plans import catalog

    rows = [(1, k, [1.0, 0.0, 0.0]) for k in (5, 3, 4)] + [(1, 9, [0.9, 0.1, 0.0]), (1, 8, [0.0, 1.0, 0.0])]
    rows += [(2, 20 + k, [0.0, 0.6, 0.8]) for k in range(3)] + [(3, 30, [1.0, 0.0, 0.0]), (3, 31, [1.0, 0.0, 0.0])]
    # 41 and 42 are 0.16 like themselves, but next to 43 and 44, which are no cores
    rows += [(4, 41, [0.4, 0.0, 0.0]), (4, 42, [0.4, 0.0, 0.0]), (4, 43, [0.7, 0.9, 0.0]), (4, 44, [0.7, -0.9, 0.0])]
    rows += [(5, 50 + k, [0.4, 0.0, 0.0]) for k in range(2)] + [(5, 53 + k, [1.0, 0.3 * k, 0.0]) for k in range(3)]
    rows += [(None, 60, [1.0, 0.0, 0.0]), (6, 70, None), (1, 3, [1.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "label int, vec_id long, embedding array<float>")
    table.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = catalog.QUERIES["m5_density_clusters"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.sql(catalog.ORACLES["m5_density_clusters"]).fetchall()
    assert sorted(map(tuple, found.select("seq", "cluster").collect())) == sorted(want)
    assert {r[0] for r in want} >= {3, 4, 5, 9, 20, 21, 22, 41, 42, 50, 51}


@pytest.mark.parametrize("kind", ["spread", "alike", "zeros", "short", "undefined"])
def test_nearest_and_heavier_equal_sorting_all(kind):
    rng = np.random.default_rng(2)
    sims = rng.normal(size=(9, 50 if kind == "short" else 1111))
    if kind == "alike":
        sims = np.round(sims, 1)
    if kind == "zeros":
        sims[sims < 2.5] = 0
    if kind == "undefined":
        sims[3, 40] = np.nan
    sims[2, 5] = -np.inf
    w = rng.integers(1, 9, sims.shape[1])
    got = np.take_along_axis(sims, si._nearest(sims, 5), 1)
    keep = np.ones(len(sims), bool) if kind != "undefined" else ~np.isnan(sims).any(axis=1)
    assert (np.sort(got, 1)[keep] == np.sort(sims, 1)[:, -5:][keep]).all()
    for low in (2.5, -1.0):
        want = [(sims > low) @ w, (sims >= low + 0.1) @ w]
        assert all((a == b).all() for a, b in zip(si._heavier(sims, w, low, [low + 0.1]), want, strict=True))


def test_a_cell_sorts_few_similarities(monkeypatch):
    """Most similarities are only compared, none of them sorted or partitioned with its whole row."""
    cut, partition = [], np.argpartition
    monkeypatch.setattr(np, "argpartition", lambda *a, **b: cut.append(a[0].size) or partition(*a, **b))
    x = np.random.default_rng(1).normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    si._nearest(x[:200] @ x.T, 5)
    assert not cut
