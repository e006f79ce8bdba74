"""Near-duplicate embeddings: binary codes of randomly rotated vectors, then exact recomputation.

1. Equal vectors of a label become one row with their number. A random rotation turns each unit vector o,
   and the signs of the turned entries are its code ō, a corner of the cube; the correction factor
   ⟨ō, o⟩ is stored beside it. ⟨ō, q⟩ / ⟨ō, o⟩ is an unbiased estimate of ⟨o, q⟩ for any q, with an error
   that the factor bounds (the published randomised codes with that estimator).
2. Bands of code bits are keys. A task that has the members of a key estimates their inner products from
   codes, factors and half-precision vectors, and ties together what could reach the threshold within the
   bounds. It returns a star for each group, so as many rows as members at most.
3. The components of those ties hold every link, most vectors are in none. In a component the angle to
   the mean direction decides most pairs by the triangle inequality: two vectors whose angles add up to less
   than the limit are linked, two whose angles differ by more are not. Vectors are counted in rings by
   that angle; rings whose pairs are still open are cut into blocks, and blocks meet in pairs for exact
   inner products in double precision. No pair is ever a row.
"""

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from edgeflow.functions import spread
from edgeflow.llm.common import let, mapped
from edgeflow.llm.components import stars
from edgeflow.plans import found_once, hot_keys, keep, partitions

#: Share of the pairs at the threshold itself that may share no key; pairs above it miss far less often.
MISSED = 1e-5
#: Errors of an estimate that still count as possible, in standard deviations.
CONFIDENCE = 5.0
#: Members that a key of unrelated vectors may have, on average, and the least bits of a key.
MEMBERS, LEAST_BITS = 256, 8
#: Code bits that an estimate uses at least.
ESTIMATE_BITS = 192
#: Numbers of vectors that meet in a task, above which a key goes to several.
SLICE_ENTRIES = 1_280_000
#: Rings within the limit angle, and vectors of a block of a ring.
RINGS, BLOCK = 8, 1024
#: Radians that the rounding of an angle may take.
ROUNDING = 1e-6
#: What the half-precision entries of a unit vector may change in an inner product.
HALF = 2e-3
SEED = 20
GROUP = ["grp", "label", "d"]


def unit(v):
    """A column of doubles as a vector of length one; divided by its largest entry first, so that no square overflows."""
    peak = F.array_max(F.transform(v, lambda c: F.abs(c)))
    scaled = let(peak, lambda p: F.transform(v, lambda c: c / p))
    return let(scaled, lambda x: let(_length(x), lambda norm: F.transform(x, lambda c: c / norm)))


def _length(v):
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, c: total + c * c))


def comparable(label, v):
    """Whether a row can link at all: a label, and a vector of finite entries that are not all zero."""
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return F.coalesce(label.isNotNull() & finite & F.exists(v, lambda c: c != 0.0), F.lit(False))


class Plan:
    """Bits of a key, keys of a vector and rotations, for a threshold and the size of the largest label."""

    def __init__(self, threshold, largest, missed=MISSED):
        if not 0 < threshold < 1:
            raise ValueError("the threshold lies between 0 and 1")
        self.threshold, self.angle = threshold, math.acos(threshold)
        self.bits = max(LEAST_BITS, math.ceil(math.log2(max(1, largest) / MEMBERS)))
        # a sign differs with the probability angle / π, so a band of bits agrees with this one
        agree = (1 - self.angle / math.pi) ** self.bits
        self.bands = math.ceil(math.log(missed) / math.log(1 - agree))

    def rotations(self, side):
        """(rotations whose signs give keys, those whose codes give estimates) of vectors padded to `side`."""
        estimated = -(-ESTIMATE_BITS // side)
        return max(estimated, -(-self.bits * self.bands // side)), estimated


def padded(d):
    return -(-d // 64) * 64


@lru_cache(maxsize=256)
def rotation(side, d, number):
    """`d` columns of a random orthogonal matrix, the same in every task: what turns a padded vector."""
    random = np.random.default_rng([SEED, side, number])
    q, r = np.linalg.qr(random.standard_normal((side, side)))
    return np.ascontiguousarray((q * np.sign(np.diag(r)))[:, :d])


def _codes(x, plan):
    """(keys, packed row) of unit vectors of one length, a row each: code bits, factors and the vector itself."""
    m, d = x.shape
    side = padded(d)
    rotations, estimated = plan.rotations(side)
    bits, factors = [], []
    for number in range(rotations):
        turned = x @ rotation(side, d, number).T
        bits.append(turned > 0)
        if number < estimated:
            factors.append(np.abs(turned).sum(1) / math.sqrt(side))
    banded = np.concatenate(bits, axis=1)[:, : plan.bits * plan.bands].reshape(m, plan.bands, plan.bits)
    keys = banded.astype(np.int64) @ (1 << np.arange(plan.bits, dtype=np.int64))
    packed = [
        np.packbits(np.concatenate(bits[:estimated], axis=1), axis=1),
        np.stack(factors, axis=1).astype("<f4").view(np.uint8).reshape(m, -1),
        x.astype("<f2").view(np.uint8).reshape(m, -1),
    ]
    return keys, np.concatenate(packed, axis=1)


def _coded(plan):
    """(row, sort, u) → (row, sort, d, keys, packed); `sort` stands for the label and the length."""

    def run(batches):
        for batch in batches:
            row, sort, u = (batch.column(i) for i in range(3))
            lengths, values = np.diff(u.offsets.to_numpy()), u.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for d in np.unique(lengths):
                places = np.flatnonzero(lengths == d)
                keys, packed = _codes(values[starts[places][:, None] + np.arange(d)], plan)
                offsets = pa.array(np.arange(len(places) + 1, dtype=np.int32) * plan.bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        row.take(pa.array(places)), sort.take(pa.array(places)), pa.array(np.full(len(places), d, np.int32)),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1))),
                        pa.array([line.tobytes() for line in packed], pa.binary()),
                    ],
                    names=["row", "sort", "d", "keys", "packed"],
                )

    return run


class Estimates:
    """Estimated inner products among rows packed by `_codes`, all of length `d`."""

    def __init__(self, packed, d, confidence=CONFIDENCE):
        side = padded(d)
        estimated = -(-ESTIMATE_BITS // side)
        code, factor = estimated * side // 8, estimated * 4
        signs = np.unpackbits(packed[:, :code], axis=1).astype(np.float32) * 2 - 1
        factors = np.ascontiguousarray(packed[:, code: code + factor]).view("<f4")
        x = np.ascontiguousarray(packed[:, code + factor:]).view("<f2").astype(np.float32)
        # codes over their factors, and the turned vectors, of all rotations side by side
        weight = np.repeat(1 / (factors * math.sqrt(side) * estimated), side, axis=1)
        self.codes = signs * weight
        self.turned = np.concatenate([x @ rotation(side, d, k).T.astype(np.float32) for k in range(estimated)], axis=1)
        spread_ = np.sqrt(((1 - factors**2) / factors**2).mean(1) / ((side - 1) * estimated))
        self.error = confidence * spread_ + HALF

    def __len__(self):
        return len(self.error)

    def possible(self, a, b, threshold):
        """Whether rows `a` (indices) may reach the threshold with rows `b`: the mean of both directions and its bound."""
        estimate = self.codes[a] @ self.turned[b].T + self.turned[a] @ self.codes[b].T
        return estimate + self.error[a][:, None] + self.error[b] >= 2 * threshold


def groups(n, near):
    """(member, root) places that tie together what `near(places, places)` links, one row for each member but the root."""
    left, found = np.arange(n), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            hit = near(np.array([frontier.pop()]), left)[0]
            if hit.any():
                reached, left = left[hit], left[~hit]
                found.append(np.stack([reached, np.full(len(reached), root)], axis=1))
                frontier.extend(reached)
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _whole_runs(batches):
    """Tables of the rows of whole runs of equal values in the first column, of batches sorted by it."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        start = int(np.searchsorted(key, key[-1]))
        if held and held[-1].column(0)[-1].as_py() == key[-1]:
            held.append(batch)
            continue
        if held or start:
            yield pa.Table.from_batches([*held, batch.slice(0, start)]).combine_chunks()
        held = [batch.slice(start)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _runs(table):
    """(start, length) of the runs of two rows or more."""
    key = table.column(0).to_numpy()
    bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(bounds)
    return [(int(bounds[i]), int(sizes[i])) for i in np.flatnonzero(sizes > 1)]


def _rows_of(column):
    """A binary column with values of one length as a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _tied(plan, confidence=CONFIDENCE):
    """(key, row, d, packed) sorted by key → (a, b): the members of a key that may link, each tied to one of them."""

    def of_run(row, d, packed):
        made = Estimates(packed, d, confidence)
        everyone, social = np.arange(len(made)), []
        step = max(1, 4_000_000 // len(made))
        for first in everyone[::step]:
            part = everyone[first: first + step]
            hit = made.possible(part, everyone, plan.threshold)
            hit[part - first, part] = False
            social.append(part[hit.any(1)])
        social = np.concatenate(social)
        ties = groups(len(social), lambda a, b: made.possible(social[a], social[b], plan.threshold))
        return row[social[ties]]

    def run(batches):
        for table in _whole_runs(batches):
            row, d = table.column("row").to_numpy(), table.column("d").to_numpy()
            found = [np.empty((0, 2), np.int64)]
            for start, size in _runs(table):
                packed = table.column("packed").slice(start, size)
                for length in np.unique(d[start: start + size]):  # one, unless two keys have one hash
                    own = np.flatnonzero(d[start: start + size] == length)
                    found.append(of_run(row[start + own], int(length), _rows_of(packed.take(pa.array(own)))))
            ties = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(ties[:, 0]), pa.array(ties[:, 1])], names=["a", "b"])

    return run


def ties(vectors, plan, confidence=CONFIDENCE, slice_entries=SLICE_ENTRIES):
    """(a, b): rows of `vectors` (row, label, v) tied together, so that linked ones are in one component.

    A key with more members than fit a task is cut into slices, and each two slices meet in a task of
    their own.
    """
    sort = F.xxhash64("label", F.size("v"))
    coded = mapped(
        vectors.select("row", sort.alias("sort"), unit(F.col("v")).alias("u")), _coded(plan),
        "row bigint, sort bigint, d int, keys array<bigint>, packed binary",
    )
    banded = coded.select("row", "sort", "d", "packed", F.posexplode("keys").alias("band", "bits"))
    keyed = banded.select(F.xxhash64("sort", "band", "bits").alias("key"), "row", "d", "packed")
    longest = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    sizes = keyed.groupBy(F.col("key").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    hot = found_once(hot_keys(sizes, max(2, slice_entries // longest)))
    if hot is not None:
        marked = keyed.join(F.broadcast(hot.select(F.col("id").alias("key"), "slices")), "key", "left")
        own = spread(F.col("slices"), "row")
        others = F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda other: other != own)
        marked = marked.withColumn("other", F.explode(F.when(F.col("slices").isNull(), F.array(F.lit(0))).otherwise(others)))
        meeting = F.xxhash64("key", F.least(own, "other"), F.greatest(own, "other"))
        keyed = marked.withColumn("key", F.when(F.col("slices").isNull(), F.col("key")).otherwise(meeting))
        keyed = keyed.select("key", "row", "d", "packed")
    by_key = keyed.repartition(partitions(vectors.sparkSession), "key").sortWithinPartitions("key", "row")
    return mapped(by_key, _tied(plan, confidence), "a bigint, b bigint")


def _centres(members):
    """GROUP and `centre`, the mean direction of a group's unit vectors; any direction serves where they cancel out."""
    sums = members.select(*GROUP, F.posexplode("u").alias("place", "c")).groupBy(*GROUP, "place").agg(F.sum("c").alias("c"))
    listed = sums.groupBy(*GROUP).agg(F.sort_array(F.collect_list(F.struct("place", "c"))).alias("listed"))
    summed = F.transform("listed", lambda e: e["c"])
    first = F.transform("listed", lambda e: F.when(e["place"] == 0, 1.0).otherwise(0.0))
    centre = let(_length(summed), lambda norm: F.when(norm > 1e-6, F.transform(summed, lambda c: c / norm)).otherwise(first))
    # written, as are the other aggregates that hot groups meet: both sides of the join are shuffled and can be split
    return keep(listed.select(*GROUP, centre.alias("centre")), "embeddings-centres")


def _ring_pairs(rings, plan):
    """Pairs of rings of a group, the nearer one first, with `sure`: true (all linked), false (none), null (open)."""
    inner = rings.select(*GROUP, *[F.col(c).alias(f"{c}_1") for c in rings.columns if c not in GROUP])
    outer = rings.select(*GROUP, *[F.col(c).alias(f"{c}_2") for c in rings.columns if c not in GROUP])
    linked = F.col("far_1") + F.col("far_2") <= plan.angle - ROUNDING
    apart = F.col("near_2") - F.col("far_1") > plan.angle + ROUNDING
    met = inner.join(outer, GROUP).where("ring_1 <= ring_2")
    return met.withColumn("sure", F.when(linked, True).when(apart, False))


def _sure(pairs):
    """GROUP, ring, `weight` of the vectors that all of the ring link with, `root` that they hang together with."""
    linked = pairs.where("sure")
    nearer = linked.select(*GROUP, F.col("ring_1").alias("ring"), F.col("ring_2").alias("other"), F.col("weight_2").alias("weight"), F.col("least_2").alias("root"))
    farther = linked.where("ring_1 < ring_2").select(
        *GROUP, F.col("ring_2").alias("ring"), F.col("ring_1").alias("other"), F.col("weight_1").alias("weight"), F.col("least_1").alias("root")
    )
    # whatever ring links with one at all links with the innermost one
    both = nearer.unionByName(farther).groupBy(*GROUP, "ring")
    made = both.agg(F.sum("weight").alias("weight"), F.min(F.struct("other", "root"))["root"].alias("root"))
    return keep(made, "embeddings-sure")


def _compared(threshold):
    """(pair, side, row, weight, u) sorted by pair → (row, weight, root): exact links across a pair of blocks."""

    def of_run(side, row, weight, u):
        dots = u @ u.T
        near = dots >= threshold
        np.fill_diagonal(near, True)
        if side.any():
            near &= side[:, None] != side[None, :]
        roots = row.copy()
        for member, root in groups(len(row), lambda a, b: near[a][:, b]):
            roots[member] = row[root]
        found = near @ weight
        return row[found > 0], found[found > 0], roots[found > 0]

    def run(batches):
        for table in _whole_runs(batches):
            pair = table.column("pair").to_numpy()
            bounds = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1], [True]]))
            side, row, weight = (table.column(c).to_numpy() for c in ("side", "row", "weight"))
            u = table.column("u").combine_chunks()
            made = []
            for start, end in zip(bounds[:-1], bounds[1:]):
                lines = u.slice(start, end - start).flatten().to_numpy().reshape(end - start, -1)
                made.append(of_run(side[start:end], row[start:end], weight[start:end], lines))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts)) for parts in zip(*made)], names=["row", "weight", "root"]
            )

    return run


def _open(placed, rings, pairs, plan, block):
    """(row, weight, root) from the blocks of rings whose pairs are open; None if there are none."""
    spark = placed.sparkSession
    cut = lambda n: F.ceil(F.col(n) / block).cast("int")
    blocks = (
        pairs.where("sure IS NULL")
        .withColumn("slice_1", F.explode(F.sequence(F.lit(0), cut("n_1") - 1)))
        .withColumn("slice_2", F.explode(F.sequence(F.lit(0), cut("n_2") - 1)))
        .where("ring_1 < ring_2 OR slice_1 <= slice_2")
        .select(*GROUP, "ring_1", "slice_1", "ring_2", "slice_2", F.monotonically_increasing_id().alias("pair"))
    )
    blocks = keep(blocks, "embeddings-blocks")
    if blocks.isEmpty():
        return None
    same = (F.col("ring_1") == F.col("ring_2")) & (F.col("slice_1") == F.col("slice_2"))
    first = blocks.select(*GROUP, F.col("ring_1").alias("ring"), F.col("slice_1").alias("slice"), "pair", F.lit(False).alias("side"))
    second = blocks.where(~same).select(*GROUP, F.col("ring_2").alias("ring"), F.col("slice_2").alias("slice"), "pair", F.lit(True).alias("side"))
    sliced = placed.join(rings.select(*GROUP, "ring", cut("n").alias("slices")), [*GROUP, "ring"]).withColumn(
        "slice", spread(F.col("slices"), "row")
    )
    met = sliced.join(first.unionByName(second), [*GROUP, "ring", "slice"]).select("pair", "side", "row", "weight", "u")
    by_pair = met.repartition(partitions(spark), "pair").sortWithinPartitions("pair")
    return mapped(by_pair, _compared(plan.threshold), "row bigint, weight bigint, root bigint")


def exact_links(members, plan, block=BLOCK):
    """(row, weight, root) of members (row, GROUP, u, weight): the weight each links with, its own included,
    and rows it hangs together with. Several rows for one member; their weights add up."""
    spark = members.sparkSession
    dot = F.aggregate(F.zip_with("u", "centre", lambda a, b: a * b), F.lit(0.0), lambda total, c: total + c)
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot)))
    placed = members.join(_centres(members), GROUP).withColumn("angle", angle).drop("centre")
    ring = F.floor(F.col("angle") * (RINGS / plan.angle)).cast("int")
    placed = keep(placed.withColumn("ring", ring), "embeddings-placed")
    rings = keep(
        placed.groupBy(*GROUP, "ring").agg(
            F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"), F.min("angle").alias("near"),
            F.max("angle").alias("far"), F.min("row").alias("least"),
        ),
        "embeddings-rings",
    )
    pairs = _ring_pairs(rings, plan)
    found = placed.select("row", *GROUP, "ring").join(_sure(pairs), [*GROUP, "ring"]).select("row", "weight", "root")
    compared = _open(placed, rings, pairs, plan, block)
    return keep(found if compared is None else found.unionByName(compared), "embeddings-links")


def near_duplicates(
    rows, threshold=0.93, id="vec_id", label="label", vector="embedding",
    missed=MISSED, confidence=CONFIDENCE, slice_entries=SLICE_ENTRIES, block=BLOCK,
):
    """(vec_id, n_links, component_id, kept) for each row: vectors of one label with a cosine of `threshold` or more link.

    `n_links` counts the other rows linked directly, equal vectors among them; `component_id` is the
    smallest id that links lead to, the row's own included, and `kept` says whether that is its own.
    Rows with a null label, and vectors that are null, empty, all zero or hold a null or an entry that
    is not finite, link with nothing; vectors of different lengths do not link either. Repeated rows and
    ids are rows of their own; a null id is the smallest of none, so a row without id is kept only where no id
    leads to it. An empty table gives no row. Other columns are not read, whatever their names.

    Every link found is checked in double precision or follows from angles to a common direction, with
    a margin for rounding; none below the threshold is returned. Pairs right at the threshold share no key in the share
    `missed` of all cases and fall outside the bound of their estimate as rarely as five standard deviations say.
    """
    given = rows.select(
        F.col(id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    fine = comparable(F.col("label"), F.col("v"))
    distinct = given.where(fine).groupBy("label", "v").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
    vectors = keep(distinct.withColumn("row", F.monotonically_increasing_id()), "embeddings-vectors")
    sizes = vectors.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    plan = Plan(threshold, sizes.agg(F.max("n")).first()[0] or 1, missed)
    tied = stars(ties(vectors, plan, confidence, slice_entries), "embeddings-ties")
    in_groups = tied.select(F.col("a").alias("row"), F.col("b").alias("grp")).unionByName(
        tied.select(F.col("b").alias("row"), F.col("b").alias("grp")).distinct()
    )
    members = keep(
        in_groups.join(vectors, "row").select("row", "grp", "label", F.size("v").alias("d"), unit(F.col("v")).alias("u"), "weight"),
        "embeddings-members",
    )
    links = exact_links(members, plan, block)
    roots = stars(links.select(F.col("row").alias("a"), F.col("root").alias("b")), "embeddings-components")
    counts = links.groupBy("row").agg(F.sum("weight").alias("links"))
    known = vectors.join(counts, "row", "left").join(roots.select(F.col("a").alias("row"), "b"), "row", "left")
    known = keep(
        known.select(
            "label", "v", "least", F.coalesce("b", "row").alias("root"), (F.coalesce("links", "weight") - 1).alias("n_links")
        ),
        "embeddings-known",
    )
    components = keep(known.groupBy("root").agg(F.min("least").alias("component_id")), "embeddings-least")
    of = known.join(components, "root").select("label", "v", "n_links", "component_id")
    # an exact copy that very many rows share makes a skewed partition, which adaptive execution splits
    linked = given.where(fine).join(of, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = given.where(~fine).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
