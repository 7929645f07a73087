"""Coordinated-review detection (inventory group M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators import candidates
from reviewlens.operators import similarity as si
from reviewlens.plans.adapters import reviews, vectors, with_views
from reviewlens.plans.registry import query
from reviewlens.plans.text_queries import TOKENS
from reviewlens.schemas import FuseConfig, ScanConfig

# The test vectors are far apart, so the thresholds are low.
SCAN = ScanConfig(
    min_reviews=5,
    topk=5,
    dup_threshold=0.30,
    sim_threshold=0.25,
    high_sim_threshold=0.30,
    min_cluster_size=2,
    overall_threshold=0.21,
)
FUSE = FuseConfig(sim_threshold=0.25, min_samples=3, topk=5, dup_threshold=0.30)

VECS = """SELECT label::VARCHAR AS business, vec_id AS seq, list_transform(embedding, lambda x: x::DOUBLE) AS v
          FROM embeddings"""
SIZES = "SELECT business, count(*) AS n FROM vecs GROUP BY business"
SYM = """SELECT a.business, a.seq AS sa, b.seq AS sb, list_dot_product(a.v, b.v) AS sim
         FROM vecs a JOIN vecs b ON a.business = b.business AND a.seq <> b.seq"""
TOPK = """SELECT business, avg(sim) AS mean_topk FROM
            (SELECT *, row_number() OVER (PARTITION BY business, sa ORDER BY sim DESC) AS r FROM sym)
          WHERE r <= 5 GROUP BY business"""
DUP = """SELECT s.business, n AS n_reviews, count(*) FILTER (sim > 0.30) / (n * (n - 1.0::DOUBLE)) AS dup_rate
         FROM sizes s LEFT JOIN sym ON s.business = sym.business GROUP BY s.business, n"""


def clusters_sql(threshold: float, samples: int, prefix: str) -> dict[str, str]:
    p = prefix
    return {
        f"{p}near": f"SELECT * FROM sym WHERE sim >= {threshold}",
        f"{p}core": f"SELECT sa AS seq FROM {p}near GROUP BY sa HAVING count(*) + 1 >= {samples}",
        f"{p}reach": f"""SELECT seq, seq AS root FROM {p}core UNION
                         SELECT e.sb, r.root FROM {p}reach r JOIN {p}near e ON r.seq = e.sa
                         WHERE e.sb IN (SELECT seq FROM {p}core)""",
        f"{p}comp": f"SELECT seq, min(root) AS cluster FROM {p}reach GROUP BY seq",
        f"{p}clusters": f"""SELECT seq, cluster FROM {p}comp UNION ALL
                            SELECT e.sa, min(c.cluster) FROM {p}near e JOIN {p}comp c ON e.sb = c.seq
                            WHERE e.sa NOT IN (SELECT seq FROM {p}core) GROUP BY e.sa""",
        f"{p}stats": f"""SELECT c.business, c.cluster, c.size, avg(sim) AS mean_sim FROM
                           (SELECT v.business, k.cluster, count(*) AS size FROM {p}clusters k JOIN vecs v ON k.seq = v.seq
                            GROUP BY v.business, k.cluster) c
                         JOIN {p}clusters x ON x.cluster = c.cluster JOIN {p}clusters y ON y.cluster = c.cluster
                         JOIN sym ON sym.sa = x.seq AND sym.sb = y.seq
                         WHERE c.size > 1 GROUP BY c.business, c.cluster, c.size""",
        f"{p}largest": f"""SELECT business, size, mean_sim FROM {p}stats
                           QUALIFY row_number() OVER (PARTITION BY business ORDER BY size DESC, mean_sim DESC) = 1""",
    }


def over_vectors(body: str, **own: str) -> str:
    return with_views(body, recursive=True, vecs=VECS, sizes=SIZES, sym=SYM, **own)


def blocks(spark, sf, cfg=SCAN):
    return si.block_vectors(vectors(spark, sf), cfg.block_rows, cfg.min_reviews)


def near(spark, sf):
    return si.neighbours(
        blocks(spark, sf), SCAN.topk, SCAN.dup_threshold, [SCAN.sim_threshold, SCAN.high_sim_threshold]
    )


@query("m1_embed")
def embed(spark, sf):
    rows = si.embed(reviews(spark, sf).select("seq", "text"))
    norm = si.dot("vector", "vector")
    return rows.select("seq", F.size("vector").alias("dims"), F.round(norm, 4).alias("norm"))


@query(
    "m2_similar_pairs",
    over_vectors(
        """SELECT business, sa AS seq_a, sb AS seq_b, 1::BIGINT AS copies_a, 1::BIGINT AS copies_b, round(sim, 6) AS sim
           FROM sym WHERE sa < sb AND sim >= 0.25"""
    ),
)
def similar_pairs(spark, sf):
    return si.similar_pairs(blocks(spark, sf), SCAN.sim_threshold).withColumn("sim", F.round("sim", 6))


@query("m3_mean_topk", over_vectors("SELECT business, round(mean_topk, 6) AS mean_topk FROM topk", topk=TOPK))
def mean_topk(spark, sf):
    return si.mean_topk(near(spark, sf), SCAN.topk).withColumn("mean_topk", F.round("mean_topk", 6))


@query("m3_mean_topk_pruned", over_vectors("SELECT business, round(mean_topk, 6) AS mean_topk FROM topk", topk=TOPK))
def mean_topk_pruned(spark, sf):
    """The same through small blocks, whose bounds leave cells out."""
    small = si.block_vectors(vectors(spark, sf), 64, SCAN.min_reviews)
    found = si.mean_topk(si.neighbours(small, SCAN.topk, SCAN.dup_threshold, [SCAN.sim_threshold]), SCAN.topk)
    return found.withColumn("mean_topk", F.round("mean_topk", 6))


@query(
    "m4_dup_rate", over_vectors("SELECT business, n_reviews, round(dup_rate, 9) AS dup_rate FROM dup", dup=DUP)
)
def dup_rate(spark, sf):
    return si.dup_rate(near(spark, sf)).withColumn("dup_rate", F.round("dup_rate", 9))


def members(spark, sf, min_samples: int):
    placed = blocks(spark, sf)
    found = si.neighbours(placed, SCAN.topk, SCAN.dup_threshold, [SCAN.sim_threshold, SCAN.high_sim_threshold])
    return placed, si.density_clusters(
        placed, found, [SCAN.sim_threshold, SCAN.high_sim_threshold], min_samples
    )


@query(
    "m5_density_clusters",
    over_vectors("SELECT seq, cluster FROM aclusters", **clusters_sql(0.25, 3, "a")),
)
def density_clusters(spark, sf):
    """Of businesses of any size, a row for each clustered review."""
    vec = vectors(spark, sf)
    placed = si.block_vectors(vec, SCAN.block_rows)
    met = si.neighbours(placed, SCAN.topk, SCAN.dup_threshold, [SCAN.sim_threshold])
    found = si.density_clusters(placed, met, [SCAN.sim_threshold], 3)
    return si.clustered_reviews(vec, placed, met, found, 0, SCAN.sim_threshold, 3).select("seq", "cluster")


def largest(spark, sf, level: int):
    placed, found = members(spark, sf, 2)
    sums = si.cluster_sums(si.cluster_members(placed, found.filter(F.col("level") == level)))
    return si.largest_clusters(sums).select("business", "size", F.round("mean_sim", 6).alias("mean_sim"))


@query(
    "m6_largest_cluster",
    over_vectors("SELECT business, size, round(mean_sim, 6) AS mean_sim FROM alargest", **clusters_sql(0.25, 2, "a")),
)
def largest_cluster(spark, sf):
    return largest(spark, sf, 0)


@query(
    "m7_largest_high_cluster",
    over_vectors("SELECT business, size, round(mean_sim, 6) AS mean_sim FROM alargest", **clusters_sql(0.30, 2, "a")),
)
def largest_high_cluster(spark, sf):
    return largest(spark, sf, 1)


@query(
    "m8_min_reviews",
    over_vectors("SELECT business, n AS n_reviews FROM sizes WHERE n >= 50"),
)
def min_reviews(spark, sf):
    placed = si.block_vectors(vectors(spark, sf), SCAN.block_rows, 50)
    return placed.groupBy("business").agg(F.sum("w").alias("n_reviews"))


SCORES = """SELECT d.business, d.n_reviews, coalesce(t.mean_topk, 0) AS mean_topk, d.dup_rate,
                   coalesce(a.size, 0) AS max_cluster_size, coalesce(a.mean_sim, 0) AS max_cluster_mean,
                   coalesce(h.size, 0) AS max_high_cluster_size, coalesce(h.mean_sim, 0) AS max_high_cluster_mean
            FROM dup d LEFT JOIN topk t ON d.business = t.business LEFT JOIN alargest a ON d.business = a.business
                 LEFT JOIN hlargest h ON d.business = h.business WHERE d.n_reviews >= 5"""
FLAGGED = """SELECT *, CASE WHEN mean_topk >= 0.21 THEN 'overall'
                    WHEN max_high_cluster_size >= 2 AND max_high_cluster_mean >= 0.30 THEN 'subcluster' ELSE '' END AS reason
             FROM scores"""


def over_scores(body: str) -> str:
    return over_vectors(
        body,
        topk=TOPK,
        dup=DUP,
        **clusters_sql(0.25, 2, "a"),
        **clusters_sql(0.30, 2, "h"),
        scores=SCORES,
        flagged=FLAGGED,
    )


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("m9_suspicious", over_scores("SELECT business, reason <> '' AS suspicious, reason FROM flagged"))
def suspicious(spark, sf):
    return si.scan_businesses(vectors(spark, sf), SCAN).select("business", "suspicious", "reason")


@query(
    "m10_business_scores",
    over_scores(
        """SELECT business, n_reviews, round(mean_topk, 6) AS mean_topk, round(dup_rate, 6) AS dup_rate, max_cluster_size,
                  round(max_cluster_mean, 6) AS max_cluster_mean, max_high_cluster_size,
                  round(max_high_cluster_mean, 6) AS max_high_cluster_mean, reason <> '' AS suspicious, reason FROM flagged"""
    ),
)
def business_scores(spark, sf):
    return rounded(
        si.scan_businesses(vectors(spark, sf), SCAN),
        "mean_topk",
        "dup_rate",
        "max_cluster_mean",
        "max_high_cluster_mean",
    )


@query("m10_review_text_scan")
def text_scan(spark, sf):
    """The scan over hashed vectors of the review texts themselves, with the default thresholds."""
    rows = si.eligible_reviews(reviews(spark, sf))
    return si.scan_businesses(si.embed(rows), ScanConfig(min_cluster_size=2))


PEERS = """SELECT x.seq, greatest(0, least(1, avg(sim))) AS peer FROM aclusters x JOIN aclusters y
             ON x.cluster = y.cluster JOIN sym ON sym.sa = x.seq AND sym.sb = y.seq GROUP BY x.seq"""
REVIEW_SCORES = """SELECT v.business, v.seq, coalesce(p.peer, 0) AS peer_score,
                          greatest(0, least(1, coalesce(p.peer, 0) * t.mean_topk)) AS fraud_score
                   FROM vecs v LEFT JOIN peers p ON v.seq = p.seq LEFT JOIN topk t ON v.business = t.business"""


def over_reviews(body: str) -> str:
    return over_vectors(body, topk=TOPK, **clusters_sql(0.25, 3, "a"), peers=PEERS, review_scores=REVIEW_SCORES)


@query("m11_peer_scores", over_reviews("SELECT business, seq, round(peer_score, 6) AS peer_score FROM review_scores"))
def peer_scores(spark, sf):
    return rounded(si.review_scores(vectors(spark, sf), FUSE), "peer_score").drop("fraud_score")


@query("m12_review_scores", over_reviews("SELECT business, seq, round(fraud_score, 6) AS fraud_score FROM review_scores"))
def review_scores(spark, sf):
    return rounded(si.review_scores(vectors(spark, sf), FUSE), "fraud_score").drop("peer_score")


@query(
    "m12_cohesion",
    over_vectors(
        """SELECT d.business, n_reviews, round(mean_topk, 6) AS mean_topk, round(dup_rate, 6) AS dup_rate
           FROM dup d JOIN topk t ON d.business = t.business""",
        topk=TOPK,
        dup=DUP,
    ),
)
def cohesion(spark, sf):
    return rounded(si.cohesion(vectors(spark, sf), FUSE), "mean_topk", "dup_rate")


@query(
    "m13_fused",
    over_reviews(
        """SELECT seq, round((seq % 10 / 10.0::DOUBLE) * 0.7::DOUBLE + fraud_score * 0.3::DOUBLE, 6) AS fused
           FROM review_scores"""
    ),
)
def fused(spark, sf):
    text = vectors(spark, sf).select("seq", ((F.col("seq") % 10) / 10.0).alias("p_text"))
    scores = si.review_scores(vectors(spark, sf), FUSE)
    return rounded(si.fuse(text, scores), "fused").select("seq", "fused")


@query("m13_unmatched", 
    """SELECT count(*) FILTER (vec_id % 3 <> 0 AND vec_id % 4 = 0) AS only_text,
              count(*) FILTER (vec_id % 3 = 0 AND vec_id % 4 <> 0) AS only_scores FROM embeddings""",
)
def unmatched(spark, sf):
    text = vectors(spark, sf).select("seq").filter("seq % 3 <> 0")
    return si.fuse_unmatched(text, si.review_scores(vectors(spark, sf), FUSE).filter("seq % 4 <> 0"))


def near_sql(group: str) -> str:
    return with_views(
        """SELECT s.seq, least(s.seq, coalesce(cluster, s.seq)) AS cluster, copies FROM sets s LEFT JOIN least_of USING (seq)
           JOIN (SELECT g, id, count(*) AS copies FROM sets GROUP BY ALL) c ON c.g = s.g AND c.id = s.id""",
        "reviews",
        recursive=True,
        cut=f"SELECT seq, {group} AS g, {TOKENS} AS t FROM reviews",
        grams="""SELECT DISTINCT seq, g, unnest([array_to_string(t[i:i + least(5, len(t)) - 1], ' ')
                   for i in range(1, len(t) - least(5, len(t)) + 2)]) AS s FROM cut WHERE len(t) > 0""",
        sets="SELECT seq, g, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS id FROM grams GROUP BY seq, g",
        shared="""SELECT a.seq AS x, b.seq AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.s = b.s AND a.seq <> b.seq
                  GROUP BY ALL""",
        links="""SELECT x, y FROM shared JOIN sets a ON a.seq = x JOIN sets b ON b.seq = y WHERE k >= 0.8 * (a.n + b.n - k)""",
        walk="SELECT x AS seq, y AS other FROM links UNION SELECT walk.seq, y FROM walk JOIN links ON x = walk.other",
        least_of="SELECT seq, min(other) AS cluster FROM walk GROUP BY seq",
    )


@query("m14_near_duplicates", near_sql("business_name"))
def near_duplicates(spark, sf):
    return candidates.near_duplicates(reviews(spark, sf), ["business_name"])


@query("m14_near_duplicates_across", near_sql("''"))
def near_duplicates_across(spark, sf):
    return candidates.near_duplicates(reviews(spark, sf))
