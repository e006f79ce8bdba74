"""Line dedup by pairwise alignment.

A run of neighbouring lines that several documents share ties each of them to the first one that has
it: one pair for a document and a run, however many documents share it, never all pairs among them.
The runs are the shortest ones with the words of a block that begin or end at each line; every block
is made of such runs, so each line of a block has a pair that holds it. A document is aligned with every
earlier one that it has such a run from. Patience diff aligns the runs of both documents, anchored at
the rare ones: those that occur once in each. A match of runs is a common block by itself, so shorter
common lines are no anchors and cannot hide one; its lines are deleted from the later document. What is
left is aligned again until nothing matches, so that moved blocks are found as well.
"""

import bisect
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeflow.llm.common import mapped, unused
from edgeflow.plans import keep

#: Words of a run that makes a pair, and of a common block that is deleted.
BLOCK_WORDS = 20
_SPACES = " \t\n\x0b\f\r"
# fixed values: the odd factor of the hash of a run, and its inverse
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def sequences(docs, id="doc_id", text="text"):
    """(doc, lines) of the distinct rows of `docs`.

    `doc` has `id` and `body`, a hash of the text; each of the `lines` a hash `h`, its words `n` and its place `i`.
    Lines are cut at line ends and compared without white space around them; those without a word are
    left out. Null texts have no lines.
    """
    given = F.coalesce(F.col(text).cast("string"), F.lit(""))
    stripped = F.transform(
        F.split(given, "\n"), lambda line, i: F.struct(F.btrim(line, F.lit(_SPACES)).alias("line"), i.alias("i"))
    )
    found = F.transform(
        F.filter(stripped, lambda e: F.length(e["line"]) > 0),
        lambda e: F.struct(
            F.xxhash64(e["line"]).alias("h"), F.size(F.split(e["line"], f"[{_SPACES}]+")).alias("n"), e["i"].alias("i")
        ),
    )
    rows = docs.select(F.struct(F.col(id).alias("id"), F.xxhash64(given).alias("body")).alias("doc"), found.alias("lines"))
    return rows.dropDuplicates(["doc"])


def runs(words, least):
    """(starts, ends) of the shortest runs of `least` words or more, first those that begin at each line, then those that end there."""
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    at = np.arange(len(words))
    ends = np.searchsorted(total, total[:-1] + least)
    starts = np.searchsorted(total, total[1:] - least, side="right") - 1
    forth, back = ends < len(total), starts >= 0
    return np.concatenate((at[forth], starts[back])), np.concatenate((ends[forth], at[back] + 1))


def run_keys(hashes, starts, ends):
    """A hash of each run: the hashes of its lines by powers of a factor, modulo 2^64."""
    powers, inverse = (np.cumprod(np.full(len(hashes), f, np.uint64)) for f in (_FACTOR, _INVERSE))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * powers)))
    return ((total[ends] - total[starts]) * inverse[starts]).view(np.int64)


def _keyed(least):
    def run(batches):
        for batch in batches:
            column = batch.column("lines")
            h, n = (column.values.field(f).to_numpy() for f in ("h", "n"))
            found = [
                np.unique(run_keys(h[a:b], *runs(n[a:b], least))) for a, b in itertools.pairwise(column.offsets.to_pylist())
            ]
            docs = np.repeat(np.arange(len(found)), [len(keys) for keys in found])
            keys = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(docs)), pa.array(keys)], names=["doc", "key"])

    return run


def pairs(found, block_words=BLOCK_WORDS):
    """(doc, first) – a document and an earlier one, `first`, the first that has one of its runs of `block_words` words.

    Documents are in the order of id, then text hash; null ids come first.
    """
    keys = mapped(found, _keyed(block_words), f"doc {found.schema['doc'].dataType.simpleString()}, key bigint")
    shared = keys.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    # a table of its own: adaptive execution splits the documents of a hot run only where both sides are shuffled
    shared = keep(shared.select("key", "first"), "lines-shared")
    return keys.join(shared, "key").where("first < doc").select("doc", "first").distinct()


def _rising(pairs_):
    """Longest run of pairs that rises in both numbers; the pairs rise in the first."""
    tails, ends, before = [], [], []
    for k, (_, b) in enumerate(pairs_):
        at = bisect.bisect_left(tails, b)
        before.append(ends[at - 1] if at else -1)
        tails[at: at + 1], ends[at: at + 1] = [b], [k]
    found, k = [], ends[-1] if ends else -1
    while k >= 0:
        found.append(pairs_[k])
        k = before[k]
    return found[::-1]


def patience(a, b):
    """Pairs of places of equal elements of two lists, rising in both, by patience diff.

    Elements that occur once in each are matched first, the longest run that rises in both; then the
    stretches between matches alike. In a stretch without such an element, first occurrences are.
    """
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        low_a, high_a, low_b, high_b = todo.pop()
        while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
            found.append((low_a, low_b))
            low_a, low_b = low_a + 1, low_b + 1
        while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
            high_a, high_b = high_a - 1, high_b - 1
            found.append((high_a, high_b))
        if low_a == high_a or low_b == high_b:
            continue
        at_a, at_b = {}, {}
        for places, elements, low, high in ((at_a, a, low_a, high_a), (at_b, b, low_b, high_b)):
            for i in range(low, high):
                places.setdefault(elements[i], []).append(i)
        common = [x for x in at_a if x in at_b]
        once = [x for x in common if len(at_a[x]) == len(at_b[x]) == 1]
        anchors = _rising(sorted((at_a[x][0], at_b[x][0]) for x in once or common))
        found.extend(anchors)
        for (i, j), (k, m) in itertools.pairwise([(low_a - 1, low_b - 1), *anchors, (high_a, high_b)]):
            if anchors and k - i > 1 and m - j > 1:
                todo.append((i + 1, k, j + 1, m))
    return sorted(found)


def _sequence(lines, words, least):
    """(run, start, end) of the shortest runs of `least` words or more, in the order of their places."""
    places = set(zip(*(p.tolist() for p in runs(words, least))))
    return [(tuple(lines[i:j]), i, j) for i, j in sorted(places)]


def common_blocks(first, later, words, least=BLOCK_WORDS):
    """Places in `later` of blocks it shares with `first`: runs that are neighbours in both, of `least` words or more."""
    size = dict(zip(later, words))
    # a line that `later` lacks is in no common run, whatever its words
    theirs = [run for run, _, _ in _sequence(first, [size.get(x, least) for x in first], least)]
    mine, deleted = _sequence(later, words, least), set()
    while matched := patience(theirs, [run for run, _, _ in mine]):
        held = {theirs[i] for i, _ in matched}
        for run, i, j in mine:
            if run in held:
                deleted.update(range(i, j))
        theirs, mine = [run for run in theirs if run not in held], [m for m in mine if m[0] not in held]
    return sorted(deleted)


def _aligned(least):
    def run(batches):
        for batch in batches:
            sides = []
            for name in ("lines", "theirs"):
                column = batch.column(name)
                fields = column.values
                sides.append((column.offsets.to_pylist(), [fields.field(f).to_numpy() for f in ("h", "n", "i")]))
            (mine, (h, n, place)), (theirs, (other, _, _)) = sides
            picked, gone = [], []
            for k, ((a, b), (c, d)) in enumerate(zip(itertools.pairwise(mine), itertools.pairwise(theirs))):
                blocks = common_blocks(other[c:d].tolist(), h[a:b].tolist(), n[a:b].tolist(), least)
                if blocks:
                    picked.append(k)
                    gone.append(place[a:b][blocks])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(picked, pa.int64())), pa.array(gone, pa.list_(pa.int32()))],
                names=["doc", "gone"],
            )

    return run


def deletions(docs, block_words=BLOCK_WORDS, id="doc_id", text="text"):
    """(doc, gone) – the places of the lines to delete from each document that loses any; see `sequences`."""
    found = keep(sequences(docs, id, text), "lines-sequences")
    theirs = found.select(F.col("doc").alias("first"), F.col("lines").alias("theirs"))
    both = pairs(found, block_words).join(theirs, "first").join(found, "doc").select("doc", "lines", "theirs")
    kind = found.schema["doc"].dataType.simpleString()
    aligned = mapped(both, _aligned(block_words), f"doc {kind}, gone array<int>")
    return aligned.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def dedup(docs, block_words=BLOCK_WORDS, id="doc_id", text="text", counts=None):
    """`docs` with the text of every row without the blocks that an earlier document has.

    Order: by id, then by a hash of the text, null ids first. Rows of equal id and text are one
    document and stay alike. A text that loses all its lines is empty; texts that lose none stay as
    they are, null ones too. `counts` names a column for the number of lines deleted.
    """
    changes = deletions(docs, block_words, id, text)
    doc, gone = unused(docs, "_doc"), unused(docs, "_gone")
    body = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    marked = docs.withColumn(doc, F.struct(F.col(id).alias("id"), body.alias("body")))
    lost = changes.select(F.col("doc").alias(doc), F.col("gone").alias(gone))
    met = marked.join(lost, doc, "left").drop(doc)
    if counts:
        met = met.withColumn(counts, F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("bigint"))
    schema = T.StructType([f for f in met.schema.fields if f.name != gone])

    def run(batches):
        at_text = schema.names.index(text)
        for batch in batches:
            columns = {n: c for n, c in zip(batch.schema.names, batch.columns)}
            texts = []
            for value, places in zip(columns[text], columns.pop(gone)):
                if places.is_valid and value.is_valid:
                    drop = set(places.as_py())
                    texts.append("\n".join(s for i, s in enumerate(value.as_py().split("\n")) if i not in drop))
                else:
                    texts.append(value.as_py())
            arrays = [columns[n] for n in schema.names]
            arrays[at_text] = pa.array(texts, arrays[at_text].type)
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return mapped(met, run, schema)
