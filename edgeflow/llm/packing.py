"""Packing of tokenized documents into fixed windows: concatenate and cut.

Two passes. The first encodes every document once and writes the ids with the partition they were
written from and their offset in it. The totals of the partitions, one number each, are summed to
the global offset of every partition. The second pass cuts the written ids at the multiples of the
window length; there is no shuffle and nothing but the partition totals visits the driver.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from edgeflow.llm.common import mapped, slices, text_bytes
from edgeflow.llm.vocabulary import byte_encoder
from edgeflow.plans import keep

WINDOW = 1024
#: Closes every document.
END_ID = 0


def tokens(docs, vocabulary, id="doc_id", text="text", end_id=END_ID):
    """Ids of every document and `end_id`: (doc_id, part, start, ids), ids as little-endian 32-bit bytes.

    `part` is the task that encoded the row and `start` the number of ids before it in that task.
    Null texts count as empty: they hold `end_id` alone. Repeated rows are documents of their own.
    """

    def encode(batches):
        encoder, part, start = byte_encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            coded = [
                np.append(encoder(value.as_buffer().to_pybytes().decode("utf-8", "replace")), end_id).astype("<u4")
                for value in batch.column("text")
            ]
            ends = start + np.cumsum([len(ids) for ids in coded], dtype=np.int64)
            starts = np.concatenate([[start], ends[:-1]])
            start = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(coded), part, np.int32)),
                    pa.array(starts.astype(np.int64)),
                    pa.array([ids.tobytes() for ids in coded], pa.binary()),
                ],
                names=["doc_id", "part", "start", "ids"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return mapped(
        docs.select(F.col(id).alias("doc_id"), text_bytes(F.col(text)).alias("text")), encode,
        f"doc_id {kind}, part int, start bigint, ids binary",
    )


def bases(written):
    """Global offset of each part: one number per task of the first pass, so no more than its tasks."""
    totals = written.groupBy("part").agg(F.max(F.col("start") + F.length("ids") / 4).cast("bigint").alias("n"))
    found, base = {}, 0
    for row in sorted(totals.collect()):
        found[row["part"]] = base
        base += row["n"]
    return found


def cut(written, window=WINDOW):
    """Pieces of written ids: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    Sequence `s` holds the ids at global places s·window … (s+1)·window−1; a piece is the part of a
    document in one sequence, and its `offset` says where a boundary lies. All sequences but the last
    are full.
    """
    base = bases(written)

    def pieces(batches):
        for batch in batches:
            rows = []
            for doc_id, part, start, ids in zip(*(batch.column(i) for i in range(4))):
                data = ids.as_buffer().to_pybytes()
                place, n, done = base[part.as_py()] + start.as_py(), len(data) // 4, 0
                while done < n:
                    sequence, offset = divmod(place + done, window)
                    length = min(n - done, window - offset)
                    rows.append((doc_id, done, length, data[4 * done: 4 * (done + length)], n, sequence, offset))
                    done += length
            doc_ids, *columns = zip(*rows) if rows else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.as_py() for x in doc_ids], batch.schema.field("doc_id").type)]
                + [pa.array(values, kind) for values, kind in zip(columns, kinds)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    kind = written.schema["doc_id"].dataType.simpleString()
    return mapped(
        written.select("doc_id", "part", "start", "ids"), pieces,
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )


def pack(docs, vocabulary, window=WINDOW, id="doc_id", text="text"):
    """Pieces of all documents packed into sequences of `window` ids; see `tokens` and `cut`.

    An empty table gives no piece. Other columns of `docs` are not read, whatever their names.
    """
    return cut(keep(tokens(docs, vocabulary, id, text), "packing-tokens"), window)


def with_checksum(pieces):
    """Pieces with `ids_crc32`, the unsigned crc32 of their bytes, instead of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def checksum_of(ids):
    """`ids_crc32` of a Python list of ids."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
