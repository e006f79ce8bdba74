"""The hand-checked graph with every semantic corner: copies, a loop, isolated and unknown ids."""

import pytest

import edgeflow as ef
from edgeflow.operators import paths, triangles


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_follower_counts(micro, micro_nodes):
    some = [(1, 1), (2, 3), (3, 1), (4, 2), (5, 1), (6, 2), (9, 1)]
    assert rows(ef.follower_count_all(micro, micro_nodes)) == sorted(some + [(7, 0), (8, 0)])
    assert rows(ef.follower_count(micro)) == some
    assert rows(ef.follower_count(micro, "grouped")) == some
    assert rows(ef.follower_count(micro, "grouped", slice_rows=1)) == some
    assert rows(ef.degree_histogram(ef.follower_count(micro))) == [(1, 4), (2, 2), (3, 1)]


def test_two_paths(micro):
    assert rows(ef.two_path_cardinality(micro)) == [(18,)]
    paths = ef.two_paths(micro)
    assert sum(r.n for r in paths.collect()) == 18
    assert (3, 2, 3) in rows(paths) and (1, 4, 2) in rows(paths)


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle_merge", "shuffle_hash", "preagg"])
@pytest.mark.parametrize("slice_rows", [1, 1_000_000])
def test_triangles(micro, strategy, slice_rows):
    assert rows(ef.triangle_count(micro, strategy, slice_rows)) == [(10, 3)]


def test_totals_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    weights = [(1, 2, 10**10), (2, 3, 10**10), (3, 1, 10**10 + 1), (4, 4, 10**10)]
    copies = spark.createDataFrame(weights, "src bigint, dst bigint, w bigint")
    walks = 3 * 10**20 * (10**10 + 1) + 10**30
    closed = copies.alias("a").join(copies.alias("b"), F.expr("a.dst = b.src")).join(
        copies.alias("c"), F.expr("b.dst = c.src AND c.dst = a.src")
    )
    n = triangles.exact("a.w") * triangles.exact("b.w") * triangles.exact("c.w")
    total = triangles._with_triangles(closed.agg(triangles._total(n, "closed_walks"))).first()
    assert tuple(total) == (walks, walks // 3)


def test_unknown_strategy(micro):
    with pytest.raises(ValueError):
        ef.triangle_count(micro, "nested")
    with pytest.raises(ValueError):
        ef.follower_count(micro, "nested")


def test_triangle_rows(micro):
    found = ef.triangle_rows(micro)
    assert sum(r.n for r in found.collect()) == 10
    assert (6, 6, 6, 6, 1) in rows(found)
    assert all(r.f3 == r.u2 and r.u3 == r.f1 for r in found.collect())


def test_existence_and_lookup(micro):
    assert rows(ef.closed_two_paths(micro)) == [(9, 3)]
    assert rows(ef.successor_lookup(micro)) == [(2, 1, 1, 0)]


def test_filter(micro):
    kept = ef.filter_max_id(micro, 4)
    assert rows(kept) == [(1, 2), (1, 2), (2, 3), (3, 1)]
    assert ef.filter_max_id(micro) is micro
    assert rows(ef.triangle_count(kept)) == [(6, 2)]


def test_hops(micro):
    found = ef.bfs_distances(micro, [2, 3])
    from_2 = {1: 2, 2: 0, 3: 1, 4: 1, 5: 2, 6: 3, 9: 3}
    from_3 = {1: 1, 2: 2, 3: 0, 4: 1, 5: 2, 6: 3, 9: 3}
    expected = [(2, v, d) for v, d in from_2.items()] + [(3, v, d) for v, d in from_3.items()]
    assert rows(found) == sorted(expected)
    assert rows(ef.eccentricity(found)) == [(2, 3), (3, 3)]
    assert rows(ef.diameter_estimate(found)) == [(3,)]
    assert rows(ef.farthest_vertex(found)) == [(2, 6, 3), (3, 6, 3)]
    wide = ef.bfs_distances_wide(found, [2, 3], ef.vertices(micro))
    assert wide.columns == ["id", "d_2", "d_3"]
    assert rows(wide) == sorted((v, from_2[v], from_3[v]) for v in from_2)


def test_hops_corners(micro):
    assert rows(ef.bfs_distances(micro, [7])) == []
    assert rows(ef.bfs_distances(micro, [9])) == [(9, 9, 0)]
    assert rows(ef.bfs_distances(micro, [2], max_rounds=1)) == [(2, 2, 0), (2, 3, 1), (2, 4, 1)]
    reached = ef.bfs_distances(micro, [6])
    wide = {r.id: r.d_6 for r in ef.bfs_distances_wide(reached, [6], ef.vertices(micro)).collect()}
    assert wide == {1: None, 2: None, 3: None, 4: None, 5: None, 6: 0, 9: None}


def test_long_search(spark, monkeypatch):
    monkeypatch.setattr(paths, "MERGE_ROUNDS", 3)
    ring = spark.range(12).selectExpr("id AS src", "(id + 1) % 12 AS dst")
    found = ef.bfs_distances(ring, [0, 5])
    assert rows(found) == sorted((s, v, (v - s) % 12) for s in (0, 5) for v in range(12))


def test_empty_graph(micro):
    empty = micro.limit(0)
    assert rows(ef.follower_count(empty)) == []
    assert rows(ef.two_path_cardinality(empty)) == [(0,)]
    for strategy in ("auto", "preagg"):
        assert rows(ef.triangle_count(empty, strategy)) == [(0, 0)]
    assert rows(ef.closed_two_paths(empty)) == [(0, 0)]
    assert rows(ef.bfs_distances(empty, [1])) == []
    assert ef.pagerank(empty).count() == 0
    assert ef.chain_pagerank(empty, ef.distinct_sources(empty).selectExpr("id", "1.0D AS pr")).count() == 0


def test_expand_neighbours(spark, edges_from):
    G = edges_from([(1, 2), (1, 2), (1, 3), (2, 3)])
    state = spark.createDataFrame([(1, 0, None), (2, None, 0), (3, None, None)], "id bigint, a int, b int")
    key = lambda r: tuple(-1 if v is None else v for v in r)
    found = sorted((tuple(r) for r in ef.expand_neighbours(G, state, ["a", "b"]).collect()), key=key)
    expected = [
        (1, 0, None, 1), (2, None, 0, 1), (2, 1, None, 2), (3, None, None, 1), (3, None, 1, 1), (3, 1, None, 1),
    ]
    assert found == sorted(expected, key=key)


def test_endpoints(edges_from):
    G = edges_from([(1, 2), (2, 2)])
    assert rows(ef.edge_endpoints(G)) == [(1, 2, "out"), (2, 1, "in"), (2, 2, "in"), (2, 2, "out")]
    assert rows(ef.reverse_edges(G)) == [(2, 1), (2, 2)]
    assert rows(ef.distinct_sources(G)) == [(1,), (2,)]
