"""Fill-in-the-middle: a document's lines cut at two ranks and put in another order.

The lines of a document form an indexable skip list. Every lane is an array of nodes; a node carries
how many units and how many code points (and bytes) lie before the next node of its lane. A search
starts at the head of the highest lane, takes a step as long as its units fit into the rank that is
left, adds up the widths, and goes down a lane where they do not.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from edgeflow.llm.common import mapped, slices, text_bytes

#: What stands before the prefix, the suffix and the middle of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A node of a lane is in the next one too with the probability 1 in FAN.
FAN = 4
_NEWLINE = 10


class SkipList:
    """Units (lines, each with its newline) of UTF-8 bytes, found by rank."""

    def __init__(self, data):
        data = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero(data == _NEWLINE) + 1
        if len(data) and (not len(ends) or ends[-1] != len(data)):
            ends = np.append(ends, len(data))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
        # every byte but those that continue a character begins a code point
        begins = (data & 0xC0) != 0x80
        points = np.add.reduceat(begins, starts, dtype=np.int64) if len(ends) else starts
        self.n = len(ends)
        widths = np.stack([np.ones(self.n, np.int64), points, ends - starts], axis=1)
        #: (widths of the nodes, place of each node in the lane below), the lowest lane first
        self.lanes = [(widths, None)]
        while len(widths) > FAN:
            up = _rises(len(widths), len(self.lanes))
            widths = np.add.reduceat(widths, up, axis=0)
            self.lanes.append((widths, up))

    def seek(self, rank):
        """(code points, bytes) before the unit of this rank, 0 … n, and the steps taken."""
        units = points = size = steps = node = 0
        for widths, below in reversed(self.lanes):
            while node < len(widths) and units + widths[node, 0] <= rank:
                units, points, size = np.add((units, points, size), widths[node])
                node, steps = node + 1, steps + 1
            if below is not None:
                # the end of a lane is the end of the one below
                node = below[node] if node < len(below) else -1
                if node < 0:
                    break
        return int(points), int(size), steps


def _rises(n, lane):
    """Places of the nodes of a lane that the next one has too: the head, and others by a hash of their place."""
    mixed = (np.arange(n, dtype=np.uint64) + np.uint64(lane << 40)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    chosen = (mixed >> np.uint64(32)) % np.uint64(FAN) == 0
    chosen[0] = True
    if chosen.all():
        chosen[1:] = False
    return np.flatnonzero(chosen)


def draws(doc_id, seed):
    """Four 32-bit numbers that depend on the seed and the id only; a null id counts as no digits."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * k: 8 * k + 8], 16) for k in range(4)]


def _arrange(doc_id, data, seed, rate, spm):
    """(n, form, prefix_chars, middle_chars, output bytes) of one document."""
    first, second, third, fourth = draws(doc_id, seed)
    units = SkipList(data)
    if not data or any(mark.encode() in data for mark in (PREFIX, SUFFIX, MIDDLE)) or third % 100 >= rate:
        return units.n, "plain", None, None, data
    low, high = sorted((first % (units.n + 1), second % (units.n + 1)))
    (points, cut, _), (more_points, end, _) = units.seek(low), units.seek(high)
    prefix, middle, suffix = data[:cut], data[cut:end], data[end:]
    if fourth % 100 < spm:
        form, parts = "spm", (SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle)
    else:
        form, parts = "psm", (PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle)
    return units.n, form, points, more_points - points, b"".join(parts)


def transform(docs, seed=7, rate=100, spm=50, id="doc_id", text="text"):
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of `docs`.

    A text is cut after two ranks of its `n` lines drawn from the seed and the id. Of 100 documents
    about `rate` are rearranged, `spm` of those 100 with the suffix first ("spm"), the others with the prefix
    first ("psm"). Empty texts, texts that hold a mark and those the draw leaves out are "plain": the
    output is the text, and the two lengths (in code points) are null. Both cuts may fall together or
    on an end, so that parts are empty. Null texts count as empty; rows with one id are cut by the same
    draws; no row is dropped, and an empty table gives none. Other columns are not read, whatever their
    names. A very long text is one row of one task: its lines need about 30 bytes each beside it.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id")
            rows = [
                _arrange(key.as_py(), value.as_buffer().to_pybytes(), seed, rate, spm)
                for key, value in zip(ids, batch.column("text"))
            ]
            n, form, prefix, middle, output = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(output, pa.binary()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema[id].dataType.simpleString()
    made = mapped(
        docs.select(F.col(id).alias("doc_id"), text_bytes(F.col(text)).alias("text")), run,
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary",
    )
    return made.withColumn("output", F.col("output").cast("string"))


def restore(output, form):
    """The text that `transform` was given, from its output and form alone, as a column."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(made):
    """Rows of `transform` with hexadecimal sha256 of the output and of the restored text instead of the output."""
    restored = restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )
