"""Plain Python answers for small graphs, straight from the definitions."""

import random
from collections import Counter, defaultdict, deque


def random_graph(seed, vertices, edges, hub_share=0.35):
    """Random edges with loops and copies; a hub takes part in `hub_share` of them, each way."""
    rng = random.Random(seed)
    result = []
    for _ in range(edges):
        a, b = rng.randrange(vertices), rng.randrange(vertices)
        roll = rng.random()
        if roll < hub_share / 2:
            a = 7
        elif roll < hub_share:
            b = 7
        result.append((a, b))
        if rng.random() < 0.2:
            result.append((a, b))
    return result


def out_lists(edges):
    out = defaultdict(list)
    for a, b in edges:
        out[a].append(b)
    return out


def two_paths(edges):
    out = out_lists(edges)
    return Counter((a, c) for a, b in edges for c in out[b])


def closed_walks(edges):
    copies = Counter(edges)
    return sum(n * copies[(c, a)] for (a, c), n in two_paths(edges).items())


def closed_by_existence(edges):
    known = set(edges)
    return sum(n for (a, c), n in two_paths(edges).items() if (c, a) in known)


def triangle_rows(edges):
    copies = Counter(edges)
    return {
        (a, c): n * copies[(c, a)] for (a, c), n in two_paths(edges).items() if copies[(c, a)]
    }


def successor_lookup(edges):
    best = {a: max(bs) for a, bs in out_lists(edges).items()}
    dead = sum(b not in best for _, b in edges)
    closed = sum(b in best and best.get(best[b]) == a for a, b in edges)
    return dead + closed, dead, closed, (dead + closed) // 3


def hops(edges, source):
    if all(source not in edge for edge in edges):
        return {}
    out, found, queue = out_lists(edges), {source: 0}, deque([source])
    while queue:
        a = queue.popleft()
        for b in out[a]:
            if b not in found:
                found[b] = found[a] + 1
                queue.append(b)
    return found


def pagerank(edges, damping, rounds):
    ids = {v for edge in edges for v in edge}
    out = out_lists(edges)
    ranks = {v: 1 / len(ids) for v in ids}
    for _ in range(rounds):
        got = defaultdict(float)
        for a, bs in out.items():
            for b in bs:
                got[b] += ranks[a] / len(bs)
        stuck = sum(ranks[v] for v in ids if not out[v]) / len(ids)
        ranks = {v: (1 - damping) / len(ids) + damping * (got[v] + stuck) for v in ids}
    return ranks


def kmeans(values, seeds, passes=11):
    """(centroids per old one of the last pass, squared errors per pass, labels)."""
    centers, errors = sorted(set(seeds)), []
    for number in range(1, passes + 1):
        groups = defaultdict(list)
        for x in values:
            groups[min(centers, key=lambda c: (abs(x - c), c))].append(x)
        errors.append(sum((x - c) ** 2 for c, xs in groups.items() for x in xs))
        moved = {c: abs(int(sum(xs) / len(xs))) for c, xs in groups.items()}
        labels = [moved[min(centers, key=lambda c: (abs(x - c), c))] for x in values]
        if number > 1 and all(c == m for c, m in moved.items()):
            break
        centers = sorted(set(moved.values()))
    return moved, errors, labels
