"""Exact top-k search by BM25 with an inverted index and block-max dynamic pruning.

The index is made where the documents are read: every task cuts its rows into shards of a bounded
number of postings, each of documents that have the same frequent terms, and no text is shuffled. Statistics of terms are summed over all shards, so a
score is the same whatever the shard. A shard keeps its documents in an order that puts alike ones
side by side and, for each term and block of a few documents, the largest impact.

A query is a set of weighted terms. Those whose largest impacts in a shard add up to less than the k-th
best score found so far cannot lift a document to it by themselves: a document is a candidate only if it
has one of the other terms, so those are read first, as from the pivot of WAND on. The scores so far and
the largest impacts of what is not read bound each block; blocks whose bound is below the k-th best score
are passed over, and the postings of the remaining terms are sought in the others only. Shards are asked in
waves, each several times as large as all before it and with the k-th best score found before as the
least, so that a query gets a few times k documents from a wave, however many shards there are. The k
best of all are merged exactly. Every row of the queries has a number of its own; they are sent to the shards in
blocks of a bounded number and, on average, a bounded number of terms. What all blocks and waves find is one table.
"""

import re
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from edgeflow.llm.common import mapped, slices, text_bytes
from edgeflow.plans import Rounds, keep, plan_text

#: Constants of BM25.
K1, B = 1.2, 0.75
#: Postings of a shard, documents of a block, and the part of a shard's documents that have a frequent term.
SHARD_POSTINGS, BLOCK, FREQUENT = 6_000_000, 64, 12
#: Queries sent to the shards at a time, and their terms.
QUERIES, QUERY_TERMS = 16_000, 4_000_000
#: Shards of the first wave on average, and how many times as many the waves reach each time.
FIRST_WAVE, GROWTH = 4, 8
#: Queries that a shard answers together.
TOGETHER = 64
#: Products of a matrix that are summed in the time of one posting.
CELLS = 200
#: Postings that are read in the time of one seek.
SEEK = 20
#: Seeks that a look at a block takes.
LOOK = 4
#: Postings from which a term has a list by itself.
LISTED = 96
#: Blocks are summed one by one if fewer than one of so many is open.
SPARSE = 8
#: Partitions of the documents that a task may take, and tasks for a core at least.
GATHERED, CORE_TASKS = 6, 8
#: Characters that are worked on at a time.
PIECE = 1 << 17
#: Documents and most frequent terms by which groups of alike documents are found, groups at most, rounds, the cosine
#: from which groups are one, and the part of a shard that a group has at least.
SAMPLE, COMMON, GROUPS, MOVES, ALIKE, SMALL = 512, 256, 8, 4, 0.5, 16
#: Bounds are sums in another order than scores.
SLACK = 1 + 1e-9
#: Decimal places of a score, and what rounding may add to one.
PLACES, ROUNDING = 6, 1e-6

_BREAK = re.compile(r"[\W_]")


@cache
def _inside():
    """For each code point, whether it belongs to a word: letters and digits do."""
    return np.fromiter((chr(code).isalnum() for code in range(0x110000)), bool, 0x110000)


def _hashed(text):
    """The starts and 63-bit hashes of the words of a text; a hash is the sum of one for each character and its place."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _inside()[codes]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, np.empty(0, np.int64)
    first = np.cumsum(sizes) - sizes
    x = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
    x = (x.astype(np.uint64) << np.uint64(32)) + codes[inside] + np.uint64(1)
    x *= np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return starts, (np.add.reduceat(x, first) >> np.uint64(1)).astype(np.int64)


def _pieces(texts):
    """(number, piece) of some texts, cut between words into pieces of about PIECE characters."""
    for number, text in enumerate(texts):
        start = 0
        while len(text) - start > PIECE:
            cut = _BREAK.search(text, start + PIECE)
            if cut is None:
                break
            yield number, text[start: cut.start()]
            start = cut.start()
        yield number, text[start:]


def _bags(texts):
    """For each of some texts its distinct term hashes, rising, and how often each occurs."""
    found, numbers, pieces, held = [[] for _ in texts], [], [], 0

    def hashed():
        starts, hashes = _hashed("\n".join(pieces))
        cuts = np.searchsorted(starts, np.cumsum([len(piece) + 1 for piece in pieces]))
        for number, low, high in zip(numbers, [0, *cuts], cuts):
            found[number].append(hashes[low:high])

    for number, piece in _pieces([text.lower() for text in texts]):
        numbers.append(number)
        pieces.append(piece)
        held += len(piece)
        if held >= PIECE:
            hashed()
            numbers, pieces, held = [], [], 0
    if pieces:
        hashed()
    return [np.unique(f[0] if len(f) == 1 else np.concatenate(f), return_counts=True) for f in found]


def _texts(column):
    return [value.as_buffer().to_pybytes().decode("utf-8", "replace") for value in column]


def terms(docs, id="doc_id", text="text"):
    """(id, terms, counts) of every row: 63-bit hashes of its runs of letters and digits in lower case."""

    def run(batches):
        for batch in slices(batches, "text"):
            found = _bags(_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32()))],
                names=["id", "terms", "counts"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return mapped(
        docs.select(F.col(id).alias("id"), text_bytes(F.col(text)).alias("text")), run,
        f"id {kind}, terms array<bigint>, counts array<int>",
    )


def _alike(found, least):
    """Numbers of documents (terms, counts) that have the same frequent terms, each group with `least` postings at least.

    Groups are by which of the most frequent terms a document has, as languages differ in these.
    """
    sizes = np.array([len(t) for t, _ in found])
    if sizes.sum() <= 2 * least:
        return [np.arange(len(found))]
    sample = np.linspace(0, len(found) - 1, min(SAMPLE, len(found))).astype(int)
    term, df = np.unique(np.concatenate([found[i][0] for i in sample]), return_counts=True)
    if not len(term):
        return [np.arange(len(found))]
    some = np.sort(term[np.argsort(-df, kind="stable")[:COMMON]])
    marks = np.zeros((len(found), len(some)), np.float32)
    for mark, (term, _) in zip(marks, found):
        at = np.minimum(np.searchsorted(term, some), len(term) - 1) if len(term) else None
        mark[:] = 0 if at is None else term[at] == some
    marks /= np.maximum(np.sqrt(marks.sum(1, keepdims=True)), 1)

    def middles(vectors, group, n):
        sums = np.stack([vectors[group == g].sum(0) for g in range(n)])
        return sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)

    # centres far from each other, moved to the middles of their groups, and one for those that are alike
    held = np.count_nonzero(marks[sample], 1)
    few = marks[sample[held >= np.median(held)]]
    centres = few[:1]
    for _ in range(GROUPS - 1):
        centres = np.concatenate([centres, few[[(few @ centres.T).max(1).argmin()]]])
    for _ in range(MOVES):
        centres = middles(few, (few @ centres.T).argmax(1), len(centres))
    group = (marks @ centres.T).argmax(1)
    held = np.bincount(group, sizes, len(centres))
    near = centres @ centres.T
    for g in np.argsort(held, kind="stable")[:-1]:
        near[g, held <= 0] = -1
        near[g, g] = -1
        other = near[g].argmax()
        if held[g] and (held[g] < least or near[g, other] > ALIKE) and held[other]:
            group[group == g] = other
            held[other], held[g] = held[other] + held[g], 0
    return [np.flatnonzero(group == g) for g in np.flatnonzero(held)]


def _shard(ids, found):
    """One row of the index from the ids of documents and their (terms, counts)."""
    sizes = np.array([len(t) for t, _ in found])
    lengths = np.array([int(c.sum()) for _, c in found], np.int64)
    # alike documents have the same most frequent term and about the same length
    common = np.array([t[c.argmax()] if len(t) else 0 for t, c in found], np.int64)
    order = np.lexsort((lengths, common))
    places = np.empty(len(order), np.int32)
    places[order] = np.arange(len(order), dtype=np.int32)
    term = np.concatenate([t for t, _ in found]) if found else np.empty(0, np.int64)
    count = np.concatenate([c for _, c in found]).astype(np.int32) if found else np.empty(0, np.int32)
    place = np.repeat(places, sizes)
    by_term = np.lexsort((place, term))
    distinct, df = np.unique(term, return_counts=True)
    return {
        "ids": [ids[i] for i in order], "lengths": lengths[order], "terms": distinct, "df": df.astype(np.int32),
        "places": place[by_term].astype("<i4").tobytes(), "counts": count[by_term].astype("<i4").tobytes(),
    }


def index(docs, shard_postings=SHARD_POSTINGS, id="doc_id", text="text"):
    """Shards of the inverted index of every row of `docs`; a row is a document of its own.

    `place`, evenly spread between 0 and 1, is fixed by the task and the number of the shard in it.
    """
    kind = docs.schema[id].dataType.simpleString()

    def run(batches):
        ids, found, postings, id_type, number = [], [], 0, None, 0
        names = ["place", "ids", "lengths", "terms", "df", "places", "counts"]

        def shard(some):
            place = (xxhash.xxh64_intdigest(f"{TaskContext.get().partitionId()} {number}") >> 11) / 2**53
            row = {"place": place, **_shard([ids[i] for i in some], [found[i] for i in some])}
            lists = [id_type, pa.int64(), pa.int64(), pa.int32()]
            types = [pa.float64(), *map(pa.list_, lists), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in zip(names, types)], names=names)

        for batch in slices(batches, "text"):
            id_type = batch.schema.field("id").type
            for doc, (term, count) in zip(batch.column("id").to_pylist(), _bags(_texts(batch.column("text")))):
                ids.append(doc)
                found.append((term, count.astype(np.int32)))
                postings += len(term)
                if postings >= shard_postings:
                    for some in _alike(found, shard_postings // SMALL):
                        yield shard(some)
                        number += 1
                    ids, found, postings = [], [], 0
        for some in _alike(found, shard_postings // SMALL) if ids else []:
            yield shard(some)
            number += 1

    return mapped(
        docs.select(F.col(id).alias("id"), text_bytes(F.col(text)).alias("text")), run,
        f"place double, ids array<{kind}>, lengths array<bigint>, terms array<bigint>, df array<int>, places binary, counts binary",
    )


def _gathered(docs):
    """`docs` in fewer partitions where files give far more than there are cores: larger shards are asked at less cost."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    # the partitions of anything but files may be known only once it has run
    if "Exchange" in plan_text(docs):
        return docs
    count = docs.rdd.getNumPartitions()
    return docs.coalesce(max(count // GATHERED, CORE_TASKS * cores)) if count > CORE_TASKS * cores else docs


def _ranges(starts, counts):
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - np.concatenate([[0], ends[:-1]]), counts) + np.arange(ends[-1] if len(ends) else 0)


class Shard:
    """Postings of a shard with impacts; those of frequent terms as full rows too, cut into blocks of documents.

    Queries that are asked together take some of the most frequent terms, as many as is cheapest for them, by a product of
    matrices: a row of impacts for each, and the largest of them in each block. The other terms are rare: they have
    about one posting in each block they have any in, so their postings are their largest impacts there,
    beside the largest of the whole shard. `postings_read` counts the postings of these that were read.

    `units`: a weight for each term that its impacts hold already; queries give multiples of it.
    """

    def __init__(self, ids, lengths, terms, df, places, counts, mean_length, units=None):
        self.documents, self.blocks = len(lengths), -(-len(lengths) // BLOCK)
        by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))
        self.id_order = np.empty(len(ids), np.int64)
        self.id_order[by_id] = np.arange(len(ids))
        self.terms, self.df = terms, df
        self.starts = np.concatenate([[0], np.cumsum(df, dtype=np.int64)])
        # places and impacts side by side, and an impact of 0 at the end
        self.postings = np.zeros((2, len(places) + 1))
        self.places, self.impacts = self.postings[0, :-1].view(np.intp), self.postings[1]
        self.places[:] = places
        norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        self.impacts[:-1] = counts * (K1 + 1) / (counts + norm[places])
        if units is not None:
            self.impacts[:-1] *= np.repeat(units, df)
        # the largest impact of each term
        self.most = np.maximum.reduceat(self.impacts, self.starts[:-1]) if len(terms) else np.empty(0)
        self.postings_read = 0
        frequent = np.flatnonzero(df > self.documents / FREQUENT)
        self.frequent = frequent[np.argsort(-df[frequent], kind="stable")]
        self.row = np.full(len(terms), len(terms))
        self.row[self.frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), self.blocks * BLOCK), np.float32)
        self.posting = np.full(self.rows.shape, -1, np.int32)
        for row, term in enumerate(self.frequent):
            some = slice(self.starts[term], self.starts[term + 1])
            self.rows[row, self.places[some]] = self.impacts[some]
            self.posting[row, self.places[some]] = np.arange(some.start, some.stop)
        self.largest = self.rows.reshape(len(frequent), self.blocks, BLOCK).max(2).astype(float) * (1 + 2.0**-20)
        listed = np.flatnonzero(df >= LISTED)
        self.list_of = np.full(len(terms), -1)
        self.list_of[listed] = np.arange(len(listed))
        ends = self.starts[listed + 1].tolist()
        self.lists = [self.postings[:, low:high] for low, high in zip(self.starts[listed].tolist(), ends)]
        self.room = np.empty((2, 0))

    @cached_property
    def cells(self):
        """The term and block of each posting, which rise."""
        return np.repeat(np.arange(len(self.terms)) * self.blocks, self.df) + self.places // BLOCK

    def places_of(self, terms):
        """Where each of some rising terms is in the shard, -1 for those that it lacks."""
        found = np.full(len(terms), -1)
        if len(terms):
            at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
            there = np.flatnonzero(terms[at] == self.terms)
            found[at[there]] = there
        return found

    def gains(self, starts, sizes, weights):
        """What documents get from ranges of postings: places and gains."""
        postings = _ranges(starts, sizes)
        return self.places[postings], np.repeat(weights, sizes) * self.impacts[postings]

    def totals(self, n, number, at, weights):
        """What documents get from all postings of the terms of `n` queries, given by rising `number`: (n, blocks, BLOCK)."""
        width, sizes, listed = self.blocks * BLOCK, self.df[at], self.list_of[at]
        self.postings_read += int(sizes.sum())
        short, own = listed < 0, np.flatnonzero(listed >= 0)
        places, gains = self.gains(self.starts[at[short]], sizes[short], weights[short])
        total = np.bincount(places + np.repeat(number[short] * width, sizes[short]), gains, n * width).reshape(n, width).astype(float, copy=False)
        ends = np.concatenate([[0], np.cumsum(sizes[own])]).tolist()
        cuts = np.searchsorted(number[own], np.arange(n + 1)).tolist()
        multiples = np.flatnonzero(weights[own] != 1)
        parts = np.searchsorted(multiples, cuts).tolist()
        lists, factors, multiples = listed[own].tolist(), weights[own].tolist(), multiples.tolist()
        size = max(ends[high] - ends[low] for low, high in zip(cuts, cuts[1:]))
        if self.room.shape[1] < size:
            # new arrays of this size are slow: their pages come one by one
            self.room = np.empty((2, 2 * size))
        places, gains = self.room[0].view(np.intp), self.room[1]
        for query, (low, high) in enumerate(zip(cuts, cuts[1:])):
            if low < high:
                start, size = ends[low], ends[high] - ends[low]
                np.concatenate([self.lists[i] for i in lists[low:high]], axis=1, out=self.room[:, :size])
                for i in multiples[parts[query]: parts[query + 1]]:
                    gains[ends[i] - start: ends[i + 1] - start] *= factors[i]
                total[query] += np.bincount(places[:size], gains[:size], width)
        return total.reshape(n, self.blocks, BLOCK)

    def rare(self, number, at, weights, often, least):
        """What documents get from rare terms, and the bound of each block, 0 for blocks that cannot reach `least`.

        The terms of all queries, by rising `number` of the query. `often`: the bounds of the blocks by the frequent terms.
        Blocks with the bound 0 are not summed in full.
        """
        n, reach, largest = len(least), (least - ROUNDING) / SLACK, weights * self.most[at]
        room = reach - often.max(1)
        opened = np.bincount(number, largest, n) * SLACK >= room
        # a look at all blocks takes the time of some seeks in each
        waiting = np.bincount(number, self.df[at] * (largest <= room[number]), n) > LOOK * SEEK * self.blocks
        cuts, first, later = np.searchsorted(number, np.arange(n + 1)), opened[number], {}
        for query in np.flatnonzero(opened & waiting):
            order = cuts[query] + np.argsort(largest[cuts[query]: cuts[query + 1]])
            below = np.cumsum(largest[order])
            split = np.searchsorted(below, room[query])
            later[query] = order[:split], below
            first[order[:split]] = False
        totals = self.totals(n, number[first], at[first], weights[first])
        sums = totals.max(2) + often
        bounds = np.where(opened[:, None] & (sums >= reach[:, None]), sums, 0)
        for query, (some, below) in later.items():
            bounds[query] = self._rest(totals[query], at[some], weights[some], below, often[query], reach[query])
        return totals, bounds

    def _rest(self, total, at, weights, below, often, reach):
        """Add to the `total` of a query the terms that cannot reach `reach`, in rising order of what they add at most."""
        near, some = np.arange(self.blocks), len(at)
        while True:
            sums, before = total.max(1) + often, len(near)
            near = near[sums[near] + (below[some - 1] if some else 0) >= reach]
            if not some or not len(near):
                break
            # those with the larger impacts first, as they close blocks; few postings are read at once, or where none are closed
            more = self.df[at[:some]].sum() > SEEK * self.blocks and (SEEK == 0 or 2 * len(near) < before)
            now = slice(some // 2 if more else 0, some)
            some, terms, factors = now.start, at[now], weights[now]
            if len(near) * len(terms) * SEEK < self.df[terms].sum():
                cells = (terms[:, None] * self.blocks + near).ravel()
                low, high = (np.searchsorted(self.cells, cells, side) for side in ("left", "right"))
                places, gains = self.gains(low, high - low, np.repeat(factors, len(near)))
                self.postings_read += len(places)
                total += np.bincount(places, gains, self.blocks * BLOCK).reshape(self.blocks, BLOCK)
            else:
                total += self.totals(1, np.zeros(len(terms), int), terms, factors)[0]
        bounds = np.zeros(self.blocks)
        bounds[near] = sums[near]
        return bounds

    def best(self, queries, k, least):
        """(places, scores) for each of some queries (terms, weights): its `k` best documents that reach its `least`."""
        asked = []
        for terms, weights in queries:
            at = self.places_of(terms)
            asked.append((at[at >= 0], weights[at >= 0]))
        return self.answers(asked, k, least)

    def answers(self, asked, k, least):
        """`best` for queries as the places and weights of their terms in the shard.

        Single precision says which documents can be among the best; their scores are summed in double precision
        and rounded. Of equal ones the smaller id is better.
        """
        n, nothing = len(asked), (np.empty(0, np.intp), np.empty(0))
        found, least = [nothing] * n, np.array(least, float)
        number = np.repeat(np.arange(n), [len(at) for at, _ in asked])
        at, weights = (np.concatenate(x) for x in zip(*asked))
        row = self.row[at]
        taken = self._taken(n, row)
        frequent = row < taken
        often = np.zeros((n, taken))
        often[number[frequent], row[frequent]] = weights[frequent]
        totals, bounds = self.rare(number[~frequent], at[~frequent], weights[~frequent], often @ self.largest[:taken], least)
        bounds *= SLACK
        wanted = (bounds > 0) & (bounds >= least[:, None] - ROUNDING)
        some, often = np.flatnonzero(wanted.any(1)), often.astype(np.float32)
        if not len(some):
            return found
        if wanted[some].sum() * SPARSE > wanted[some].size:
            scores = (often[some] @ self.rows[:taken]).reshape(len(some), self.blocks, BLOCK)
            for score, query in zip(scores, some):
                score += totals[query]
        else:
            scores = np.full((len(some), self.blocks, BLOCK), -1, np.float32)
            for block in np.flatnonzero(wanted.any(0)):
                there = np.flatnonzero(wanted[some, block])
                gains = often[some[there]] @ self.rows[:taken, block * BLOCK: (block + 1) * BLOCK]
                scores[there, block] = gains + totals[some[there], block]
        tops, least = scores.max(2), least[some]
        # where there are k blocks or more, k of them have a document each that reaches the k-th largest of their best
        each = tops if self.blocks >= k else scores.reshape(len(some), -1)
        lowest = np.zeros(len(some))
        if each.shape[1] >= k:
            lowest += np.partition(each, each.shape[1] - k)[:, each.shape[1] - k]
        # sums of numbers that are not negative, in single precision, are wrong by this part at most
        error = (taken + 8) * 2.0**-23
        lowest = np.maximum(least, lowest * (1 - 2 * error)) - 2 * ROUNDING
        lowest -= np.abs(lowest) * 2 * error
        near = (tops >= lowest[:, None]) & (tops > 0)
        number, row, weights = number[frequent], row[frequent], weights[frequent]
        cuts = np.searchsorted(number, np.arange(n + 1))
        for i in np.flatnonzero(near.any(1)):
            block, own = np.flatnonzero(near[i]), slice(cuts[some[i]], cuts[some[i] + 1])
            there, column = np.nonzero((scores[i, block] >= lowest[i]) & (scores[i, block] > 0))
            places = block[there] * BLOCK + column
            exact = weights[own] @ self.impacts[self.posting[row[own, None], places]]
            exact = np.round(totals[some[i]].ravel()[places] + exact, PLACES)
            high = exact >= max(least[i], 10.0**-PLACES)
            places, exact = places[high], exact[high]
            first = np.lexsort((self.id_order[places], -exact))[:k]
            found[some[i]] = places[first], exact[first]
        return found

    def _taken(self, queries, row):
        """How many of the most frequent terms some queries take by matrices, so that these and postings cost least."""
        n = len(self.frequent)
        postings = np.bincount(row[row < n], minlength=n) * self.df[self.frequent]
        left = np.concatenate([[0], np.cumsum(postings[::-1])])[::-1] * CELLS
        return int(np.argmin(left + np.arange(n + 1) * (queries * self.blocks * BLOCK)))


def _search(block, reached, k, mean_length):
    """Function of batches of shards that gives (number of the query, id, score).

    `block`: see `_block`. `reached`: the least score of each query that can still be among its best.
    """

    def run(batches):
        names, vocabulary, units, starts, terms, weights = block.value
        found = [np.empty(0)] * len(names)  # the best scores that this task has seen
        for batch in batches:
            for row in range(batch.num_rows):
                column = {n: c[row] for n, c in zip(batch.schema.names, batch.columns)}
                lengths, held, df = (column[n].values.to_numpy() for n in ("lengths", "terms", "df"))
                if not len(held):
                    continue
                at = np.minimum(np.searchsorted(vocabulary, held), len(vocabulary) - 1)
                shard = Shard(
                    column["ids"].values.to_pylist(), lengths, held, df,
                    *(np.frombuffer(column[n].as_buffer(), "<i4") for n in ("places", "counts")), mean_length,
                    np.where(vocabulary[at] == held, units[at], 1.0),
                )
                at = shard.places_of(vocabulary)
                # queries that read about as much of the shard go together, as they have as many of its terms
                work = np.add.reduceat(np.where(at < 0, 0, df[at])[terms], starts[:-1])
                numbers, places, scores = [], [], []
                for some in np.array_split(np.argsort(work, kind="stable"), -(-len(names) // TOGETHER)):
                    asked = []
                    for number in some:
                        own = slice(starts[number], starts[number + 1])
                        there = at[terms[own]]
                        asked.append((there[there >= 0], weights[own][there >= 0]))
                    least = [max(reached[n], found[n][0] if len(found[n]) == k else -np.inf) for n in some]
                    for number, (where, score) in zip(some, shard.answers(asked, k, least)):
                        if len(where):
                            found[number] = np.sort(np.concatenate([found[number], score]))[-k:]
                            numbers.append(np.full(len(where), number))
                            places.append(where)
                            scores.append(score)
                if numbers:
                    ids = column["ids"].values.take(pa.array(np.concatenate(places), pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[np.concatenate(numbers)]), ids, pa.array(np.concatenate(scores))],
                        names=["number", "doc_id", "score"],
                    )

    return run


def _block(rows):
    """A block of queries: their numbers, all their terms once, rising, and the least weight of each, where the terms of
    each query start, and for each of these the number in all and the multiple of that weight."""
    lists = rows.column("terms").combine_chunks(), rows.column("weights").combine_chunks()
    terms, weights = (values.flatten().to_numpy() for values in lists)
    starts = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy())])
    vocabulary, at = np.unique(terms, return_inverse=True)
    units = np.full(len(vocabulary), np.inf)
    np.minimum.at(units, at, weights)
    return rows.column("number").to_numpy(), vocabulary, units, starts, at.astype(np.int32), weights / units[at]


def weighted(queries, shards, documents):
    """Queries (id, terms, counts) with the weight of each term: its count times its inverse frequency in the whole index."""
    asked = queries.select("id", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("id", "t.terms", "t.counts")
    df = (
        shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms")
        .agg(F.sum("t.df").alias("df"))
    )
    idf = F.log(1 + (documents - F.col("df") + 0.5) / (F.col("df") + 0.5))
    together = asked.join(df, "terms").select("id", F.struct("terms", (F.col("counts") * idf).alias("weight")).alias("t"))
    listed = together.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("id", F.col("t.terms").alias("terms"), F.col("t.weight").alias("weights"))


def top_k(docs, queries, k=10, queries_at_a_time=QUERIES, id="doc_id", text="text", query_id="doc_id"):
    """(query_id, rank, doc_id, score): the `k` best rows of `docs` for every row of `queries`, exactly.

    The terms of a query are those of its whole text, each as often as it occurs; very long texts are asked whole.
    Scores are rounded to PLACES; equal ones rank by id, null ids first. A document without a term of the query is no
    result, so null and empty texts give none and are none. Each of several queries with one id is
    answered by itself, with ranks of its own; queries without an id are left out.
    """
    spark = docs.sparkSession
    # a shard is a row group, so that a wave reads no others
    shards = keep(index(_gathered(docs), id=id, text=text), "search-index", **{"parquet.block.row.count.limit": 1})
    words = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)
    total = shards.agg(
        F.count(F.lit(1)).alias("shards"), F.sum(F.size("ids")).alias("n"), F.sum(words).alias("words")
    ).first()
    given = queries.where(F.col(query_id).isNotNull())
    # numbers are of the written rows, the same whenever a task runs again
    given = keep(terms(given, query_id, text), "search-terms").withColumn(
        "id", F.struct(F.monotonically_increasing_id().alias("number"), F.col("id").alias("query_id"))
    )
    asked = keep(weighted(given, shards, float(total["n"] or 0)).select("id.*", "terms", "weights"), "search-queries")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("terms")).alias("terms")).first()
    blocks = max(-(-size["n"] // queries_at_a_time), -(-(size["terms"] or 0) // QUERY_TERMS))
    kinds = [asked.schema["query_id"].dataType.simpleString(), docs.schema[id].dataType.simpleString()]
    found = Rounds(spark, "search-found", f"number bigint, doc_id {kinds[1]}, score double")
    written = 0
    for block in range(blocks):
        # queries_at_a_time of them on average, whatever the size of the tables
        rows = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).toArrow().sort_by("number")
        if not rows.num_rows:
            continue
        sent = _block(rows)
        numbers, sent = sent[0], spark.sparkContext.broadcast(sent)
        first, reached, low, high = written, np.full(len(numbers), -np.inf), 0.0, FIRST_WAVE / max(total["shards"], 1)
        while low < 1:
            wave = shards.where((F.col("place") >= low) & (F.col("place") < high))
            run = _search(sent, reached, k, total["words"] / max(total["n"], 1))
            found.write(written, mapped(wave, run, found.schema))
            low, high, written = high, high * GROWTH, written + 1
            if low < 1:
                # one number for each query of the block
                scores = found.read(*range(first, written)).groupBy("number").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
                for row in scores.select("number", F.get("s", F.lit(k - 1)).alias("least")).where("least IS NOT NULL").collect():
                    reached[np.searchsorted(numbers, row["number"])] = row["least"]
        sent.unpersist()
    if not written:
        return spark.createDataFrame([], f"query_id {kinds[0]}, rank int, doc_id {kinds[1]}, score double")
    ranked = found.all().withColumn(
        "rank", F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc("doc_id")))
    )
    met = ranked.where(F.col("rank") <= k).join(asked.select("number", "query_id"), "number")
    return met.select("query_id", "rank", "doc_id", "score")
