import numpy as np
import pytest
from cases import SF
from pyspark.sql import functions as F

from edgeflow.llm import embeddings as embeddings_
from edgeflow.llm import whitening

ODD = [
    (900, None, 1), (901, [], 1), (902, [0.5, None, 0.25], 1), (903, [float("nan"), 0.0, 1.0], 1),
    (904, [float("inf"), 0.0, 1.0], 2), (905, [0.25, 0.5], 1), (None, [0.3, -0.4, 0.5], 1), (None, [0.3, -0.4, 0.5], 1),
    (906, [1e300, 0.0, 0.0], 1),
]


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


def _whitened(rows, k=16, scale=64.0, shift=1_000_000):
    """n, {(id, place): (deviation, |projection|…)} by numpy and Python integers."""
    x = [(i, [int(np.floor(scale * c)) + shift for c in v]) for i, v in rows]
    distinct = sorted({tuple(v) for _, v in x})
    n, sums = len(distinct), [sum(v[j] for v in distinct) for j in range(len(distinct[0]))]
    centred = np.array([[a - s // n for a, s in zip(v, sums)] for v in distinct], float) - [s % n / n for s in sums]
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = sum(values[:k] > 1e-12 * values.sum())
    place = {v: z for v, z in zip(distinct, centred @ (vectors[:, :k] / np.sqrt(values[:k])))}
    deviation = {v: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in distinct}
    return n, [(i, deviation[tuple(v)], place[tuple(v)]) for i, v in x], values[:k] / values.sum()


def _compare(found, rows, k=16, **scales):
    n, expected, explained = _whitened(rows, k, **scales)
    got = {}
    for r in found.collect():
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        got.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r.whitened)
    assert sum(len(v) for c in got.values() for v in c.values()) == len(rows) * len(explained)
    signs = {}
    for i, deviation, z in expected:
        for c, value in enumerate(z):
            mine = got[i, deviation][c + 1]
            if c not in signs and abs(value) > 1e-3:
                signs[c] = np.sign(mine[0] * value)
            assert np.allclose(mine, value * signs.get(c, 1), atol=1e-6)


def test_whitening_of_the_embeddings(embeddings):
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    _compare(whitening.whiten(embeddings), rows)


@pytest.mark.parametrize("block_rows, slab_rows", [(16, 100), (7, 64), (4096, 1 << 22)])
def test_whitening_in_slabs_with_copies_and_bad_rows(spark, block_rows, slab_rows):
    random = np.random.default_rng(5)
    rows = [(i, (random.normal(size=3) * [3, 1, 0.3]).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(200)]  # copies of three vectors
    given = spark.createDataFrame(
        [(i, v, 1) for i, v in rows] + ODD, "vec_id bigint, embedding array<double>, label int"
    ).withColumns({c: F.lit(1) for c in ("x", "mark", "index", "n", "component", "whitened", "vector", "entries")})
    left = rows + [(None, [0.3, -0.4, 0.5])] * 2
    _compare(whitening.whiten(given, block_rows=block_rows, slab_rows=slab_rows), left)


def test_whitening_keeps_digits_beyond_64_bits(spark):
    random = np.random.default_rng(6)
    rows = [(i, (random.normal(size=2) * 1e14).tolist()) for i in range(40)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>"))
    _compare(found, rows)


def test_components_without_variance_have_no_rows(spark):
    flat = [(i, [float(i), 2.0, 1.0 - i]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame(flat, "vec_id bigint, embedding array<float>"))
    assert {r.component for r in found.collect()} == {1}
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5, 0.5])] * 3, ODD[:2]):
        table = spark.createDataFrame([row[:2] for row in rows], "vec_id bigint, embedding array<double>")
        assert whitening.whiten(table).collect() == []


def _links(rows, threshold=0.93):
    """Rows of (vec_id, n_links, component_id, kept) by comparing all pairs."""
    def fine(label, v):
        return label is not None and bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    units = [np.array(v) / max(map(abs, v)) if fine(label, v) else None for _, v, label in rows]
    units = [u if u is None else u / np.linalg.norm(u) for u in units]
    group, counts = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b) or a @ b < threshold:
                continue
            counts[i] += 1
            counts[j] += 1
            group[top(i)] = top(j)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    made = [(key, n, least.get(top(i))) for i, ((key, _, _), n) in enumerate(zip(rows, counts))]
    return sorted(((key, n, c, key == c) for key, n, c in made), key=repr)


def _found(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    table = table.withColumns({c: F.lit(1) for c in ("v", "row", "u", "d", "grp", "weight", "least", "key", "n_links", "kept")})
    return sorted((tuple(r) for r in embeddings_.near_duplicates(table, **options).collect()), key=repr)


def _around(random, centre, degrees, n):
    """Unit vectors at about these angles from a direction."""
    noise = random.normal(size=(n, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    angle = np.radians(random.uniform(0, degrees, n))[:, None]
    return np.cos(angle) * centre + np.sin(angle) * noise


@pytest.mark.parametrize("d, degrees, options", [
    (64, 9, {}), (64, 25, {"block": 16}), (64, 14, {"slice_entries": 64 * 20, "block": 7}), (3, 60, {"block": 32}),
    (130, 18, {"slice_entries": 130 * 10}),
])
def test_links_equal_those_of_all_pairs(spark, d, degrees, options):
    random = np.random.default_rng(d + degrees)
    rows = []
    for label in (1, 2):
        for size in (1, 2, 3, 40, 150):
            centre = random.normal(size=d)
            made = _around(random, centre / np.linalg.norm(centre), degrees, size) * random.uniform(0.1, 5)
            rows += [(len(rows) + k, v.tolist(), label) for k, v in enumerate(made)]
        rows += [(len(rows) + k, v.tolist(), label) for k, v in enumerate(random.normal(size=(60, d)))]
    rows += [(2_000 + k, rows[5][1], 1 + k % 2) for k in range(30)]  # exact copies, under both labels
    assert _found(spark, rows, **options) == _links(rows)


def test_links_of_odd_rows(spark):
    rows = ODD + [
        (907, [0.0, 0.0, 0.0], 1), (908, [0.0, 0.0, 0.0], 1), (909, [0.3, -0.4, 0.5], None), (910, [0.3, -0.4, 0.5], None),
        (911, [3e300, -4e300, 5e300], 1), (912, [3e-320, -4e-320, 5e-320], 1), (906, [1.0, 0.0, -0.0], 1), (906, [1.0, 0.0, 0.0], 1),
        (None, [7.0], 5), (None, [2.0], 5),
    ]
    expected = [(i, n, c, k if i is not None or c is not None else True) for i, n, c, k in _links(rows)]
    assert _found(spark, rows) == sorted(expected, key=repr)
    assert _found(spark, []) == []


def test_pairs_at_the_threshold_are_found(spark):
    random = np.random.default_rng(9)
    rows = []
    for k in range(400):
        a, b = np.linalg.qr(random.normal(size=(48, 2)))[0].T
        for v in (a, 0.9305 * a + np.sqrt(1 - 0.9305**2) * b):
            rows.append((len(rows), v.tolist(), 1))
    found = {i: n for i, n, _, _ in _found(spark, rows)}
    assert all(found[i] >= 1 for i in range(800))


def test_estimates_are_unbiased_and_within_their_bounds():
    random = np.random.default_rng(10)
    plan = embeddings_.Plan(0.93, 1_000)
    for cosine in (-0.5, 0.0, 0.6, 0.93, 0.99):
        pairs = [np.linalg.qr(random.normal(size=(64, 2)))[0].T for _ in range(400)]
        x = np.array([v for a, b in pairs for v in (a, cosine * a + np.sqrt(1 - cosine**2) * b)])
        made = embeddings_.Estimates(embeddings_._codes(x, plan)[1], 64)
        one, other = np.arange(0, 800, 2), np.arange(1, 800, 2)
        estimate = ((made.codes[one] * made.turned[other]).sum(1) + (made.codes[other] * made.turned[one]).sum(1)) / 2
        assert abs(estimate.mean() - cosine) < 0.01
        assert (np.abs(estimate - cosine) <= (made.error[one] + made.error[other]) / 2).all()


def test_threshold_must_lie_between_0_and_1(embeddings):
    with pytest.raises(ValueError):
        embeddings_.near_duplicates(embeddings, threshold=1.0)
