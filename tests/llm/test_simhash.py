from cases import EDGE, documents, edge, empty  # noqa: F401
import numpy as np
import plain
import pytest

from edgeflow.llm import golay, simhash
from edgeflow.llm.components import stars


def test_golay_keys_of_words_two_bits_apart():
    random = np.random.default_rng(1)
    words = random.integers(0, 1 << 23, 5_000)
    for flips in range(3):
        other = words.copy()
        for _ in range(flips):
            other ^= 1 << random.integers(0, 23, len(words))
        a, b = golay.keys(words), golay.keys(other)
        assert ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any((1, 2)).all()


def test_number_of_golay_keys():
    assert np.bincount((golay.corrections() >= 0).sum(1)).tolist() == [0, 277, 0, 0, 0, 0, 1771]


def test_fingerprints_four_bits_apart_share_a_key():
    random = np.random.default_rng(2)
    for _ in range(300):
        fp = int(random.integers(0, 1 << 63))
        other = fp
        for bit in random.choice(64, 4, replace=False):
            other ^= 1 << int(bit)
        pair = np.array([fp, other], np.uint64).view(np.int64)
        (a, _), (b, _) = (simhash.keys_of(pair[i: i + 1]) for i in range(2))
        assert set(a.tolist()) & set(b.tolist())


@pytest.mark.parametrize("size", [9, 60, 400])
def test_star_links_have_the_components_of_all_links(size):
    random = np.random.default_rng(size)
    members = np.unique(random.integers(0, 1 << 14, size))
    a, b = simhash.star_links(members, 2)
    assert len(a) < len(members)
    expected = plain.groups(members.tolist(), lambda x, y: plain.near(x, y, 2))
    stars_ = {frozenset(pair) for pair in zip(a.tolist(), b.tolist())}
    assert plain.groups(members.tolist(), lambda x, y: frozenset((x, y)) in stars_) == expected


def _expected(rows):
    fps = [plain.fingerprint(text) for _, text in rows]
    group = plain.groups(fps, plain.near)
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, f"{fp:016x}", least.get(g)) for (i, _), fp, g in zip(rows, fps, group)), key=repr)


def _found(docs):
    found = simhash.components(docs).select("doc_id", simhash.hex_digits("fp").alias("fp"), "component_id")
    return sorted(map(tuple, found.collect()), key=repr)


def test_components_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert _found(documents) == _expected(rows)


def test_components_of_edge_cases(edge, empty):
    assert _found(edge) == _expected([row[:2] for row in EDGE])
    assert _found(empty) == []


def test_keep_one(edge, empty, documents):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns and simhash.keep_one(empty).collect() == []
    expected = {g for g in plain.groups([plain.fingerprint(row[1]) for row in EDGE], plain.near)}
    assert kept.count() == len(expected)
    components = {r.component_id for r in simhash.components(documents).collect()}
    assert sorted(r.doc_id for r in simhash.keep_one(documents).collect()) == sorted(components)


def test_a_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join([*base[: k % 400], f"changed{k}", *base[k % 400 + 1:]])) for k in range(600)]
    found = simhash.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    expected = {i: c for i, _, c in _expected(rows)}
    assert {r.doc_id: r.component_id for r in found} == expected


def test_too_many_bits(documents):
    with pytest.raises(ValueError):
        simhash.components(documents, max_bits=5)


def test_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(5, 5), (3, 2), (2, 3), (100, 200), (300, 200)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    found = {(r.a, r.b) for r in stars(links).collect()}
    assert found == {(i, 1) for i in range(2, 61)} | {(200, 100), (300, 100)}
    assert stars(links.limit(0)).collect() == []
