"""Random graphs with a hub against plain Python, with and without splitting of hot vertices."""

from collections import Counter

import pytest

import brute
import edgeflow as ef

GRAPHS = [(1, 12, 60), (2, 40, 160), (3, 150, 260)]
SPLITS = [3, 1_000_000]


@pytest.fixture(params=GRAPHS, ids=lambda g: f"v{g[1]}")
def pairs(request):
    return brute.random_graph(*request.param)


@pytest.fixture(params=SPLITS, ids=lambda s: f"slice{s}")
def slice_rows(request):
    return request.param


def test_two_paths(edges_from, pairs, slice_rows):
    found = ef.two_paths(edges_from(pairs), slice_rows=slice_rows).collect()
    assert {(r.f1, r.u2): r.n for r in found} == brute.two_paths(pairs)
    assert len(found) == len(brute.two_paths(pairs))


@pytest.mark.parametrize("strategy", ["auto", "shuffle_hash", "preagg"])
def test_closed_walks(edges_from, pairs, slice_rows, strategy):
    walks = brute.closed_walks(pairs)
    found = ef.triangle_count(edges_from(pairs), strategy, slice_rows).first()
    assert tuple(found) == (walks, walks // 3)


def test_triangle_rows(edges_from, pairs, slice_rows):
    found = ef.triangle_rows(edges_from(pairs), slice_rows=slice_rows).collect()
    assert {(r.f1, r.u2): r.n for r in found} == brute.triangle_rows(pairs)


def test_existence(edges_from, pairs, slice_rows):
    closed = brute.closed_by_existence(pairs)
    assert tuple(ef.closed_two_paths(edges_from(pairs), slice_rows).first()) == (closed, closed // 3)


def test_successor_lookup(edges_from, pairs, slice_rows):
    found = ef.successor_lookup(edges_from(pairs), slice_rows).first()
    assert tuple(found) == brute.successor_lookup(pairs)


def test_hops(edges_from, pairs, slice_rows):
    found = ef.bfs_distances(edges_from(pairs), [2, 7], slice_rows=slice_rows).collect()
    expected = {(s, v): d for s in (2, 7) for v, d in brute.hops(pairs, s).items()}
    assert {(r.source, r.id): r.dist for r in found} == expected
    assert len(found) == len(expected)


@pytest.mark.parametrize("damping", [1.0, 0.85])
def test_pagerank(edges_from, pairs, slice_rows, damping):
    ranks = ef.pagerank(edges_from(pairs), damping, iters=3, slice_rows=slice_rows)
    expected = brute.pagerank(pairs, damping, 3)
    found = {r.id: r.pr for r in ef.last_round(ranks, 3).collect()}
    assert found == pytest.approx(expected)
    assert [r.total for r in ef.rank_trace(ranks).collect()] == pytest.approx([1.0] * 4)


@pytest.mark.parametrize("max_list", [2, 10_000])
def test_lists(edges_from, pairs, max_list):
    G, copies = edges_from(pairs), Counter(pairs)
    out = Counter({(r.id, e.id): e.n for r in ef.adjacency_lists(G, max_list).collect() for e in r.nbrs})
    assert out == copies
    ins, outs = Counter(), Counter()
    lists = ef.in_out_neighbour_lists(G, max_list).collect()
    for r in lists:
        ins.update({(e.id, r.id): e.n for e in r.ins})
        outs.update({(r.id, e.id): e.n for e in r.outs})
    assert ins == copies and outs == copies
    parts = Counter(r.id for r in lists)
    assert max(parts.values()) > 1 if max_list == 2 else set(parts.values()) == {1}


def test_grouped_count(edges_from, pairs, slice_rows):
    found = ef.follower_count(edges_from(pairs), "grouped", slice_rows).collect()
    assert {r.id: r.n for r in found} == Counter(b for _, b in pairs)


def test_send_state(spark, edges_from, pairs, slice_rows):
    state = spark.createDataFrame([(v, v * 10) for v in range(200)], "id bigint, s bigint")
    found = ef.send_state(edges_from(pairs), state, slice_rows).collect()
    assert {(r.src, r.dst, r.s): r.w for r in found} == Counter((a, b, a * 10) for a, b in pairs)


@pytest.mark.parametrize("seeds", [[1, 4], [0, 3, 9, 20], [5, 5, 1000]])
def test_kmeans(spark, pairs, seeds):
    counts = Counter(b for _, b in pairs)
    values = spark.createDataFrame(list(counts.items()), "id bigint, n bigint")
    moved, errors, labels = brute.kmeans(list(counts.values()), seeds)
    result = ef.kmeans_1d(values, seeds)
    assert {r.old: r.centroid for r in result.centroids.collect()} == moved
    assert [r.sse for r in result.trace.orderBy("pass").collect()] == errors
    assert {r.id: r.centroid for r in result.members.collect()} == dict(zip(counts, labels))


def test_kmeans_tie_goes_to_the_smaller_centroid(spark):
    values = spark.createDataFrame([(1, 5)], "id bigint, n bigint")
    assert ef.kmeans_assign(values, [8, 2]).first().centroid == 2


def test_kmeans_negative_mean_loses_its_sign(spark):
    values = spark.createDataFrame([(1, -7), (2, -8)], "id bigint, n bigint")
    stats = ef.pass_stats(ef.degree_histogram(values), [-5]).first()
    assert (stats.old, stats.centroid, stats.members, stats.sse) == (-5, 7, 2, 13)
