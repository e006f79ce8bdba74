"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A word is read twice: as it stands, and as its shape (runs of letters, capitals, digits and single
other characters). Features are the words, pairs of words, the shapes, pairs and triples of shapes,
and a mark for a word that equals the one before, each hashed to one of 2^18 places. The value of a
feature is its share of the document's words times SCALE, so a score does not depend on the length.

The regression learns on the driver from a sample of at most `max_rows` labelled documents, the first
ones by a hash of the id; the tasks that read the documents turn the sample into sparse vectors. The
weights, 2^18 numbers whatever the data, go to all tasks, and a score is one sparse dot product.
"""

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeflow.llm.common import mapped, slices, text_bytes, unused

#: Places of the hashed features.
PLACES = 1 << 18
#: Places of the mark for a repeated word, of no feature, and of the constant feature.
REPEATED, NONE, CONSTANT = PLACES, PLACES + 1, PLACES + 2
#: Value of a feature that every word of a document has.
SCALE = 50.0
#: Labelled documents that the regression learns from at most.
MAX_ROWS = 6_000
#: Passes over the sample.
PASSES = 4
#: Words a worker remembers.
REMEMBERED = 200_000
#: Words whose features are made at a time.
STRETCH = 100_000


class _Kinds(dict):
    """code point → the letter that stands for its kind."""

    def __missing__(self, point):
        c = chr(point)
        kind = self[point] = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return kind


_KINDS, _RUN = _Kinds(), re.compile(r"(.)\1+", re.DOTALL)


def shape(word):
    """`Theater,` → `Aa,`; `THE!!` → `A!`; `4.0` → `0.0`."""
    return _RUN.sub(r"\1", word.translate(_KINDS))


class _Words(dict):
    """word → its number; the hashes of the words met so far by number."""

    def __init__(self):
        self.hashes = np.empty((2, REMEMBERED + STRETCH + 2), np.uint64)

    def __missing__(self, word):
        number = self[word] = len(self)
        self.hashes[:, number] = (
            xxhash.xxh64_intdigest(word, 1), xxhash.xxh64_intdigest(shape(word.decode("utf-8", "replace")), 2)
        )
        return number

    def of(self, words):
        """Hashes of words as they stand and of their shapes."""
        if len(self) > REMEMBERED:
            self.clear()
        return self.hashes[:, np.fromiter(map(self.__getitem__, words), np.int64, len(words))]


def _mixed(*parts):
    """One hash of neighbouring hashes."""
    mixed = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        # fixed value: an odd multiplier that spreads bits
        mixed = (mixed ^ part) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def features(words, inside, memory):
    """(6, words) places of the features that end at each word, NONE where the document lacks one.

    `inside`: how many of the words before, two at most, belong to the same document. The first two
    words are only there to complete what ends at the next ones.
    """
    as_is, shapes = memory.of(words)
    made = np.full((6, len(words)), NONE, np.int64)
    pair, triple = inside >= 1, inside >= 2
    size = np.uint64(PLACES)
    made[0] = as_is % size
    made[1] = _mixed(shapes) % size
    made[2, 1:] = _mixed(as_is[:-1], as_is[1:]) % size
    made[3, 1:] = _mixed(shapes[:-1], shapes[1:]) % size
    made[4, 2:] = _mixed(shapes[:-2], shapes[1:-1], shapes[2:]) % size
    made[5, 1:] = np.where(as_is[1:] == as_is[:-1], REPEATED, NONE)
    made[2:4, ~pair] = NONE
    made[5, ~pair] = NONE
    made[4, ~triple] = NONE
    return made


def stretches(texts, memory):
    """Features of UTF-8 texts, at most STRETCH words at a time: (document of each word, features)."""
    words, document, inside = [], [], []

    def flush(context):
        made = features(words, np.concatenate(inside), memory)[:, context:]
        return np.concatenate(document)[context:], made

    context = 0
    for number, text in enumerate(texts):
        found = text.split()
        for start in range(0, len(found), STRETCH):
            if len(words) >= STRETCH:
                yield flush(context)
                context = min(start, 2)
                words, document, inside = [], [], []
                if context:
                    words, document, inside = found[start - 2: start], [np.zeros(2, np.int64)], [np.zeros(2, np.int64)]
            part = found[start: start + STRETCH]
            words.extend(part)
            document.append(np.full(len(part), number))
            inside.append(np.minimum(np.arange(start, start + len(part)), 2))
    if words:
        yield flush(context)


def vector(text, memory):
    """Sparse vector (places, values) of UTF-8 bytes."""
    found = [np.unique(made[made != NONE], return_counts=True) for _, made in stretches([text], memory)]
    if not found:
        return np.empty(0, np.int64), np.empty(0)
    where, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    counts = np.bincount(back, np.concatenate([f[1] for f in found]))
    return where, counts * (SCALE / max(len(text.split()), 1))


def logits(texts, weights, memory):
    """Sparse dot products of UTF-8 texts with `weights`, which end with 0 for NONE and the constant."""
    totals, sizes = np.zeros(len(texts)), np.zeros(len(texts))
    for document, made in stretches(texts, memory):
        totals += np.bincount(document, weights[made].sum(0, dtype=np.float64), len(texts))
        sizes += np.bincount(document, minlength=len(texts))
    return weights[CONSTANT] + SCALE * totals / np.maximum(sizes, 1)


class Regression:
    """Logistic regression whose weights are sparse by the regularised leader's rule."""

    def __init__(self, alpha=0.1, beta=1.0, l1=0.1, l2=0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(CONSTANT + 1), np.zeros(CONSTANT + 1)

    def weights(self, where):
        z, n = self.z[where], self.n[where]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, where, values, label):
        where, values = np.append(where, CONSTANT), np.append(values, 1.0)
        w = self.weights(where)
        gradient = (probability(w @ values) - label) * values
        grown = self.n[where] + gradient**2
        self.z[where] += gradient - (np.sqrt(grown) - np.sqrt(self.n[where])) / self.alpha * w
        self.n[where] = grown


def probability(logit):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, logit))))


def learn(examples, passes=PASSES):
    """Weights of (places, values, label) examples; 0.5 is the score of all without any."""
    regression = Regression()
    for _ in range(passes):
        for where, values, label in examples:
            regression.update(where, values, label)
    return regression.weights(np.arange(CONSTANT + 1))


def sample(docs, labels, learnable, max_rows=MAX_ROWS, id="doc_id", text="text"):
    """Sparse vectors of at most `max_rows` labelled documents (id, label), in a fixed order.

    Only ids for which the column `learnable` of the labels holds. Labels are 0 or 1, others are left
    out; of several labels of an id the least counts, of several texts each one. Where ids repeat and their
    rows are more than `max_rows`, the first in the order count.
    """
    chosen = (
        labels.where(learnable & F.col("label").isin(0, 1) & F.col(id).isNotNull())
        .groupBy(id).agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64(id), id).limit(max_rows)
    )
    # the broadcast has no more than max_rows rows of two numbers
    rows = docs.select(F.col(id), text_bytes(F.col(text)).alias("text")).join(F.broadcast(chosen), id)

    def run(batches):
        memory = _Words()
        for batch in slices(batches, "text"):
            vectors = [vector(t.as_buffer().to_pybytes(), memory) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), batch.column("label"),
                 pa.array([v[0].astype("<i4").tobytes() for v in vectors], pa.binary()),
                 pa.array([v[1].astype("<f4").tobytes() for v in vectors], pa.binary())],
                names=["id", "label", "places", "vals"],
            )

    kind = docs.schema[id].dataType.simpleString()
    found = mapped(
        rows.select(id, F.col("label").cast("int").alias("label"), "text"), run,
        f"id {kind}, label int, places binary, vals binary",
    )
    order = found.orderBy(F.xxhash64("id"), "id", F.xxhash64("places", "vals")).limit(max_rows).collect()
    return [(np.frombuffer(r.places, "<i4"), np.frombuffer(r.vals, "<f4").astype(float), r.label) for r in order]


def score(docs, weights, text="text", name="score"):
    """`docs` and the column `name`, the probability of label 1 of every whole text.

    Null and empty texts and those without words get the probability of the constant feature alone. A
    name that `docs` has already, in capitals or not, is lengthened (`score_1`, …); the column is the last.
    """
    name = unused(docs, name)
    spark, given = docs.sparkSession, unused(docs, "_bytes")
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        memory, w = _Words(), shared.value
        for batch in slices(batches, given):
            texts = [t.as_buffer().to_pybytes() for t in batch.column(given)]
            scores = [probability(float(x)) for x in logits(texts, w, memory)]
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != given]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=schema.names)

    return mapped(docs.withColumn(given, text_bytes(F.col(text))), run, schema)


def classify(
    docs, labels, learnable=None, max_rows=MAX_ROWS, id="doc_id", text="text", label="quality",
    name="score",
):
    """Learn from `labels` and score `docs`; see `sample` and `score`."""
    labels = labels.select(F.col(id), F.col(label).alias("label"))
    learnable = F.lit(True) if learnable is None else learnable
    return score(docs, learn(sample(docs, labels, learnable, max_rows, id, text)), text, name)

