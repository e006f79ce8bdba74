"""Known results on graphs cut from the test tables with a window, and on the chain graph."""

import pytest

import edgeflow as ef
from conftest import sf

LEAD = (
    "SELECT src, dst FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey "
    "ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst FROM lineitem {where}) WHERE dst IS NOT NULL"
)
GRAPHS = {
    "part": LEAD.format(where=""),
    "sparse": LEAD.format(where="WHERE l_quantity <= 12"),
    "user": "SELECT src, dst FROM (SELECT user_id AS src, lead(user_id) OVER (PARTITION BY event_type, "
    "CAST(ts AS DATE) ORDER BY ts, event_id) AS dst FROM events) WHERE dst IS NOT NULL",
}


def window_graph(spark, scale, name):
    for table in ("lineitem", "events"):
        spark.read.parquet(f"{sf(scale)}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(GRAPHS[name])


@pytest.mark.parametrize(
    "scale, name, edges, paths, walks",
    [
        ("0.001", "part", 4527, 105393, 12986),
        ("0.01", "part", 45257, 1051620, 12607),
        ("0.001", "sparse", 527, 1540, 29),
        ("0.01", "sparse", 5235, 15116, 22),
        ("0.001", "user", 850, 48853, 189408),
        ("0.01", "user", 9850, 657116, 296762),
    ],
)
def test_paths_and_walks(spark, scale, name, edges, paths, walks):
    G = window_graph(spark, scale, name)
    assert G.count() == edges
    assert ef.two_path_cardinality(G).first().two_paths == paths
    assert ef.triangle_count(G, "preagg").first().closed_walks == walks
    assert ef.triangle_count(G, "shuffle_merge").first().closed_walks == walks


@pytest.mark.parametrize(
    "scale, name, closed, lookup",
    [
        ("0.001", "part", 12240, (20, 0, 20)),
        ("0.01", "part", 12516, (23, 0, 23)),
        ("0.001", "sparse", None, (35, 30, 5)),
        ("0.01", "sparse", None, (293, 289, 4)),
    ],
)
def test_existence_and_lookup(spark, scale, name, closed, lookup):
    G = window_graph(spark, scale, name)
    if closed:
        assert ef.closed_two_paths(G).first().two_paths_closed == closed
    assert tuple(ef.successor_lookup(G).first())[:3] == lookup


def test_filtered_walks(spark):
    G = ef.filter_max_id(window_graph(spark, "0.01", "part"), 1000)
    assert G.count() == 11549
    assert ef.two_path_cardinality(G).first().two_paths == 134946
    assert ef.triangle_count(G).first().closed_walks == 1600
    assert ef.closed_two_paths(G).first().two_paths_closed == 1589


@pytest.mark.parametrize(
    "scale, name, expected",
    [
        ("0.001", "part", {2: 3, 3: 3}),
        ("0.01", "part", {2: 4, 3: 4}),
        ("0.001", "sparse", {2: 8, 3: 0}),
        ("0.01", "sparse", {2: 0, 3: 11}),
    ],
)
def test_eccentricity(spark, scale, name, expected):
    distances = ef.bfs_distances(window_graph(spark, scale, name), [2, 3])
    assert {r.source: r.dist for r in ef.eccentricity(distances).collect()} == expected
    reached = {("0.001", "sparse"): 174 + 1, ("0.01", "sparse"): 1 + 1802}
    if (scale, name) in reached:
        assert distances.count() == reached[(scale, name)]


@pytest.mark.parametrize(
    "scale, seeds, errors, centroids",
    [
        ("0.001", [10, 19, 29, 39], [1493, 991, 805, 695, 691], [15, 20, 26, 32]),
        ("0.01", [9, 19, 29, 39], [17181, 9752, 7069, 5686, 5559], [15, 20, 25, 31]),
    ],
)
def test_kmeans(spark, scale, seeds, errors, centroids):
    counts = ef.follower_count(window_graph(spark, scale, "part"))
    table = ef.kmeans_seeds(counts, 4)
    assert sorted(r.centroid for r in table.collect()) == seeds
    result = ef.kmeans_1d(counts, table)
    assert [r.sse for r in result.trace.orderBy("pass").collect()] == errors
    assert sorted(r.centroid for r in result.centroids.collect()) == centroids


def test_zero_followers(spark):
    G = window_graph(spark, "0.01", "sparse")
    nodes = spark.read.parquet(f"{sf('0.01')}/part.parquet").selectExpr("p_partkey AS id")
    assert ef.follower_count_all(G, nodes).where("n = 0").count() == 160


def test_chain(spark):
    edges, ranks = ef.chain_graph(spark, 100)
    assert edges.count() == 10_000 and ranks.count() == 10_001
    rounds = ef.chain_pagerank(edges, ranks)
    totals = [r.total for r in ef.rank_trace(rounds).orderBy("round").collect()]
    assert totals == pytest.approx([
        0.9999, 0.99986667, 0.9998222311109873, 0.999762980740311, 0.999717312221085,
        0.9996675312733304, 0.9996159698174185, 0.9995669710768083, 0.9995168623734572,
        0.9994666444291576,
    ], abs=1e-9)
    final = ef.last_round(rounds, 10)
    assert final.count() == 10_000 and final.where("id = 0").count() == 0
    top = ef.top_k(final, "pr", 4).collect()
    assert [r.id for r in top] == [3, 6, 9, 12]
    assert top[0].pr == pytest.approx(0.000150096799620, abs=1e-14)
