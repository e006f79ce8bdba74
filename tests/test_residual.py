"""PageRank to a tolerance against plain power iteration."""

import pytest

import brute
import edgeflow as ef


def _power(pairs, damping, restart, rounds=200):
    ids = {v for pair in pairs for v in pair}
    homes = ids if restart is None else ids & set(restart)
    home = {v: (v in homes) / len(homes) for v in ids}
    out, ranks = brute.out_lists(pairs), dict(home)
    for _ in range(rounds):
        got = dict.fromkeys(ids, 0.0)
        for a, bs in out.items():
            for b in bs:
                got[b] += ranks[a] / len(bs)
        stuck = sum(ranks[v] for v in ids if v not in out)
        ranks = {v: (1 - damping) * home[v] + damping * (got[v] + stuck * home[v]) for v in ids}
    return ranks


@pytest.mark.parametrize("restart, slice_rows", [(None, 1_000_000), ([7, 9, 10_000], 3)])
def test_error_is_within_the_tolerance(edges_from, restart, slice_rows):
    pairs = brute.random_graph(3, 150, 260)
    found = ef.pagerank_residual(edges_from(pairs), 0.6, 1e-4, restart, slice_rows=slice_rows)
    expected = _power(pairs, 0.6, restart)
    got = {r.id: r.pr for r in found.ranks.collect()}
    assert got.keys() == expected.keys()
    assert sum(abs(got[v] - expected[v]) for v in got) <= 1e-4
    # the residuals tell the error exactly
    assert abs(sum(expected.values()) - sum(got.values()) - found.trace[-1][2] / 0.4) < 1e-9


def test_active_set_shrinks(edges_from):
    """Rank flows from a hub over many leaves into one chain: later rounds have few senders."""
    leaves = range(1, 200)
    pairs = [(0, i) for i in leaves] + [(i, 300) for i in leaves] + [(300 + i, 301 + i) for i in range(8)] + [(308, 308)]
    trace = ef.pagerank_residual(edges_from(pairs), 0.5, 1e-3, [0]).trace
    active = [senders for _, senders, _ in trace]
    assert active[:3] == [1, 199, 1]
    residuals = [left for _, _, left in trace]
    assert residuals == sorted(residuals, reverse=True)
    assert max(active[2:]) <= 2


def test_wrong_calls_and_no_edges(edges_from):
    with pytest.raises(ValueError):
        ef.pagerank_residual(edges_from([(1, 2)]), 1.0)
    with pytest.raises(ValueError):
        ef.pagerank_residual(edges_from([(1, 2)]), 0.5, restart=[3])
    assert ef.pagerank_residual(edges_from([(1, 2)]).where("src = 5")).ranks.collect() == []
    assert len(ef.pagerank_residual(edges_from([(1, 2)]), max_rounds=1).trace) == 2
