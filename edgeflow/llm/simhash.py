"""SimHash near-duplicates: fingerprints, links by Golay-code fuzzy hashing, components.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits. Up to four differing bits
spread over them in one of two ways:

* a segment is clean; then one of the other two has at most two of the bits. Key: the clean segment
  whole, and a Golay key of the other.
* every segment has one, and one of them at most two; then each of the other two has exactly one, so
  half of it is clean. Key: a half of each of the two, and a Golay key of the third.

Fingerprints within four bits therefore share one of their keys (33 bits each, about 100 of them).
Distinct fingerprints are shuffled by key, and every key's members are compared in the task that has
them. What a task returns of a key is not its links but for large keys a star for each group of
linked members, which has the same components and as many rows as members.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from edgeflow.llm import golay
from edgeflow.llm.common import mapped, slices, text_bytes, unused
from edgeflow.llm.components import stars
from edgeflow.plans import keep, partitions

#: (shift, bits) of the three segments
SEGMENTS = [(0, 22), (22, 21), (43, 21)]
#: Differing bits up to which the keys find all links.
MAX_BITS = 4
#: Shingles whose bits are counted at a time.
COUNTED = 65_536
#: Members of a key up to which links are returned one by one.
SMALL = 8
#: Fingerprints whose keys a task makes at a time.
KEYED = 4_096


def fingerprint(text, shingle=4):
    """Fingerprint of UTF-8 bytes; see `fingerprints`."""
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII white spaces
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0] + [end + 1 for end in ends[:-1]]
    hashed = xxhash.xxh64_intdigest
    spans = zip(starts, ends[shingle - 1:]) if len(words) >= shingle else [(0, at)]
    hashes = np.fromiter((hashed(joined[a:b], 42) for a, b in spans), np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), COUNTED):
        part = hashes[start: start + COUNTED]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs, shingle=4, id="doc_id", text="text"):
    """(doc_id, body, fp) of every whole text, a row for each row of `docs`, `fp` as a signed 64-bit number.

    A-Z in lower case, words between ASCII white space, shingles of `shingle` words joined by spaces,
    repeats included; fewer words are one shingle. A bit is set if over half of the shingles' XXH64
    (seed 42) have it. Null and empty texts and those without words have zero. `body` is a hash of the
    text. Other columns are not read, whatever their names.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            found = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("body"), pa.array(found, pa.int64())], names=["doc_id", "body", "fp"]
            )

    kind = docs.schema[id].dataType.simpleString()
    given = docs.select(F.col(id).alias("doc_id"), text_bytes(F.col(text)).alias("text"))
    given = given.select("doc_id", F.xxhash64("text").alias("body"), "text")
    return mapped(given, run, f"doc_id {kind}, body bigint, fp bigint")


def _halves(words, bits):
    low = bits // 2
    return [words & ((1 << low) - 1), words >> low]


def keys_of(fps):
    """(key, fp) of an array of signed fingerprints, all keys of each."""
    unsigned = np.asarray(fps, np.int64).view(np.uint64)
    segments = [
        ((unsigned >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64) for shift, bits in SEGMENTS
    ]
    fuzzy = [golay.keys(s) for s in segments]
    halves = [_halves(s, bits) for s, (_, bits) in zip(segments, SEGMENTS)]
    exact = [(segments[i], j) for i in range(3) for j in range(3) if i != j]
    for k in range(3):
        i, j = (x for x in range(3) if x != k)
        exact += [((a << 11) | b, k) for a in halves[i] for b in halves[j]]
    keys, owners = [], []
    for number, (clean, j) in enumerate(exact):
        there = fuzzy[j] >= 0
        made = (np.int64(number) << 40) | (clean[:, None] << golay.INDEX_BITS) | fuzzy[j]
        keys.append(made[there])
        owners.append(np.broadcast_to(np.asarray(fps, np.int64)[:, None], there.shape)[there])
    return np.concatenate(keys), np.concatenate(owners)


def _keyed(batches):
    for batch in batches:
        fps = batch.column("fp").to_numpy()
        for start in range(0, len(fps), KEYED):
            key, fp = keys_of(fps[start: start + KEYED])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])


def _distance(a, b):
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def star_links(members, max_bits):
    """Links (member, root) that tie together what is linked among `members`, at most one for each.

    Search from each root in turn; a member that was reached is compared with the members not yet
    reached only, so that a tight group costs little more than its size.
    """
    left, found = np.unique(members), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            near = _distance(left, np.broadcast_to(frontier.pop(), left.shape)) <= max_bits
            if near.any():
                reached, left = left[near], left[~near]
                found.append((reached, np.full(len(reached), root)))
                frontier.extend(reached)
    a, b = zip(*found) if found else ([np.empty(0, np.int64)],) * 2
    return np.concatenate(a), np.concatenate(b)


def _links_of_runs(key, fp, max_bits):
    """Links within runs of equal keys; all runs are whole."""
    bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(bounds)
    small = np.repeat(sizes <= SMALL, sizes)
    a, b = [], []
    for apart in range(1, min(SMALL, sizes.max())):
        same = small[apart:] & (key[apart:] == key[:-apart])
        x, y = fp[apart:][same], fp[:-apart][same]
        near = _distance(x, y) <= max_bits
        a.append(x[near])
        b.append(y[near])
    for run in np.flatnonzero(sizes > SMALL):
        x, y = star_links(fp[bounds[run]: bounds[run + 1]], max_bits)
        a.append(x)
        b.append(y)
    if not a:
        return np.empty((0, 2), np.int64)
    pairs = np.stack([np.concatenate(a), np.concatenate(b)], axis=1)
    return np.unique(pairs, axis=0)


def _linked(max_bits):
    def run(batches):
        keys, fps = [], []  # what may go on in the next batch: the last key's members

        def links(key, fp):
            pairs = _links_of_runs(key, fp, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            if not len(key):
                continue
            if keys and keys[-1][-1] == key[-1]:
                keys.append(key)
                fps.append(fp)
                continue
            whole = int(np.searchsorted(key, key[-1]))
            keys.append(key[:whole])
            fps.append(fp[:whole])
            done, members = np.concatenate(keys), np.concatenate(fps)
            keys, fps = [key[whole:].copy()], [fp[whole:].copy()]
            if len(done):
                yield links(done, members)
        if keys:
            yield links(np.concatenate(keys), np.concatenate(fps))

    return run


def links(distinct, max_bits=MAX_BITS):
    """Links (a, b) that connect the same of the distinct fingerprints (fp) as all pairs within `max_bits` do."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find links of at most {MAX_BITS} bits")
    tasks = partitions(distinct.sparkSession)
    # a task writes a hundred rows for each it reads, so the few files of the distinct ones are not enough
    keyed = mapped(distinct.select("fp").repartition(tasks, "fp"), _keyed, "key bigint, fp bigint")
    by_key = keyed.repartition(tasks, "key").sortWithinPartitions("key")
    return mapped(by_key, _linked(max_bits), "a bigint, b bigint")


def roots(distinct, max_bits=MAX_BITS):
    """Distinct fingerprints (fp, …) with `root`, the same for all that hang together, written once."""
    star = stars(links(distinct, max_bits), "simhash-links")
    met = distinct.join(star.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    return keep(met.withColumn("root", F.coalesce("root", "fp")), "simhash-roots")


def components(docs, shingle=4, max_bits=MAX_BITS, id="doc_id", text="text"):
    """(doc_id, fp, component_id): documents whose fingerprints hang together by links of `max_bits` bits.

    `component_id` is the smallest id in the component, the document's own included; null ids are the
    smallest of none. Equal fingerprints always hang together, so empty texts are one component. A row
    for each row of `docs`; an empty table gives none.
    """
    rows = keep(fingerprints(docs, shingle, id, text), "simhash-rows")
    distinct = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    rooted = roots(distinct, max_bits)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    # a fingerprint that very many documents share makes a skewed partition, which adaptive execution splits
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp):
    """A signed 64-bit fingerprint as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs, shingle=4, max_bits=MAX_BITS, id="doc_id", text="text"):
    """The rows of `docs` with one document of each component.

    The one with the smallest id stays, null ids being the largest; of several texts under that id the
    one with the least hash, and of equal rows one.
    """
    rows = fingerprints(docs, shingle, id, text)
    one = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), "body")
    distinct = keep(rows.groupBy("fp").agg(F.min(one).alias("one")), "simhash-distinct")
    kept = roots(distinct, max_bits).groupBy("root").agg(F.min("one").alias("one"))
    doc = unused(docs, "_doc")
    body = F.xxhash64(text_bytes(F.col(text))).alias("body")
    marked = docs.withColumn(doc, F.struct(F.col(id).isNull().alias("missing"), F.col(id).alias("id"), body))
    return marked.join(kept.select(F.col("one").alias(doc)), doc, "left_semi").dropDuplicates([doc]).drop(doc)
