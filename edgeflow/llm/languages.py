"""Language of a text by a bidirectional gated recurrent network over bytes.

A text is cut into windows of WINDOW bytes. In each window one network reads forwards and one
backwards; their states at a byte give the probability of every language there, so every position of
the whole text is labelled. A document's probabilities are the mean over the labelled positions that
are part of letters.

The network learns on the driver, in numpy by backpropagation through time, from windows of at most
`per_language` documents a language, the first ones by a hash of the id. It has a few thousand
numbers, whatever the data.
"""

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeflow.llm.common import mapped, slices, text_bytes, unused

WINDOW = 128
EMBEDDED, STATES = 8, 8
#: Documents of a language and windows of a document that the network learns from at most.
PER_LANGUAGE, PER_DOCUMENT = 600, 3
STEPS, BATCH, RATE, SEED = 400, 128, 0.02, 20
#: Bytes of a window that the network learns from.
LEARNED = 64
#: Windows that are read side by side.
ABREAST = 1_024
UNKNOWN = "und"

#: Letters in UTF-8: ASCII letters and the bytes of any longer character.
IN_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_LETTERS = re.compile(r"[^\W\d_]")


def has_letter(text):
    return any(m[0].isalpha() for m in _LETTERS.finditer(text))


def squash(x, spare=None):
    """x / (1 + |x|) in place: what a hyperbolic tangent would do, several times as fast."""
    spare = np.abs(x, out=spare)
    spare += 1
    x /= spare
    return x


def steepness(y):
    """Derivative of `squash` where its value is `y`."""
    return (1 - np.abs(y)) ** 2


class Direction:
    """One recurrent layer. Gates z and r and the candidate c have rows 0, 1 and 2 of the parameters."""

    def __init__(self, random):
        scale = 1 / np.sqrt(EMBEDDED + STATES)
        self.w = random.normal(0, scale, (3, EMBEDDED, STATES)).astype(np.float32)
        self.u = random.normal(0, scale, (3, STATES, STATES)).astype(np.float32)
        self.b = np.zeros((3, 1, STATES), np.float32)

    def forward(self, embedding, times, keep=False):
        """States (time, n, STATES) after each of the bytes (time, n), and what `backward` needs."""
        # what a byte gives to a gate is one of 256 rows
        given = embedding @ self.w + self.b
        time, n = times.shape
        states, kept, h = np.empty((time, n, STATES), np.float32), [], np.zeros((n, STATES), np.float32)
        z, r, c, own, row, spare = (np.empty_like(h) for _ in range(6))
        for t in range(time):
            for k, gate in enumerate((z, r)):
                np.matmul(h, self.u[k], out=gate)
                gate += np.take(given[k], times[t], axis=0, out=row, mode="clip")
                squash(gate, spare)
                gate += 1
                gate *= 0.5
            np.matmul(h, self.u[2], out=own)
            np.multiply(own, r, out=c)
            c += np.take(given[2], times[t], axis=0, out=row, mode="clip")
            squash(c, spare)
            if keep:
                kept.append((h, z.copy(), r.copy(), c.copy(), own.copy()))
            new = states[t]
            np.subtract(h, c, out=new)
            new *= z
            new += c
            h = new
        return states, kept

    def backward(self, embedding, times, kept, d_states):
        """Gradients of w, u, b and the embedding, from those of the states, back through time."""
        d_u, d_h = np.zeros_like(self.u), np.zeros_like(d_states[0])
        d_given = np.empty((3, *d_states.shape), np.float32)
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, c, own = kept[t]
            d_h = d_h + d_states[t]
            d_z, d_r, d_c = d_given[:, t]
            d_c[:] = d_h * (1 - z) * steepness(c)
            d_z[:] = d_h * (h - c) * 0.5 * steepness(2 * z - 1)
            d_r[:] = d_c * own * 0.5 * steepness(2 * r - 1)
            d_own = d_c * r
            d_u[0] += h.T @ d_z
            d_u[1] += h.T @ d_r
            d_u[2] += h.T @ d_own
            d_h = d_h * z + d_z @ self.u[0].T + d_r @ self.u[1].T + d_own @ self.u[2].T
        # by byte, as `given` is
        flat = times.ravel()
        columns = d_given.reshape(3, -1, STATES)
        by_byte = np.stack(
            [np.stack([np.bincount(flat, columns[k, :, i], 256) for i in range(STATES)], 1) for k in range(3)]
        ).astype(np.float32)
        d_w = embedding.T @ by_byte
        return [d_w, d_u, by_byte.sum(1, keepdims=True)], (by_byte @ self.w.transpose(0, 2, 1)).sum(0)


class Network:
    """Byte embedding, one layer each way, and a label for every position."""

    def __init__(self, names, seed=SEED):
        random = np.random.default_rng(seed)
        self.names = list(names)
        self.embedding = random.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32)
        self.forwards, self.backwards = Direction(random), Direction(random)
        self.out = random.normal(0, 0.3, (2, STATES, len(self.names))).astype(np.float32)
        self.bias = np.zeros(len(self.names), np.float32)

    def parameters(self):
        both = [p for d in (self.forwards, self.backwards) for p in (d.w, d.u, d.b)]
        return [self.embedding, *both, self.out, self.bias]

    def read(self, windows, keep=False):
        """Probabilities (time, n, languages) of the bytes (n, time), and what learning needs."""
        times = np.ascontiguousarray(windows.T).astype(np.intp)
        ahead, kept_ahead = self.forwards.forward(self.embedding, times, keep)
        back, kept_back = self.backwards.forward(self.embedding, times[::-1], keep)
        p = ahead @ self.out[0]
        p += back[::-1] @ self.out[1]
        p += self.bias
        p -= p.max(2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(2, keepdims=True)
        return p, (times, ahead, back, kept_ahead, kept_back)

    def gradients(self, windows, weights, labels):
        """Gradients of the mean cross entropy over the weighted positions (n, time)."""
        p, (times, ahead, back, kept_ahead, kept_back) = self.read(windows, keep=True)
        d = p
        d[:, np.arange(len(labels)), labels] -= 1
        d *= (weights / max(weights.sum(), 1)).T[:, :, None].astype(np.float32)
        flat, size = d.reshape(-1, d.shape[2]), (-1, STATES)
        d_out = np.stack([ahead.reshape(size).T @ flat, back[::-1].reshape(size).T @ flat])
        own, e_ahead = self.forwards.backward(self.embedding, times, kept_ahead, d @ self.out[0].T)
        other, e_back = self.backwards.backward(
            self.embedding, times[::-1], kept_back, (d @ self.out[1].T)[::-1]
        )
        return [e_ahead + e_back, *own, *other, d_out, flat.sum(0)]


def learn(windows, weights, labels, names, steps=STEPS, seed=SEED):
    """A network learned from byte windows (n, time), position weights and language numbers; fixed by the seed."""
    network, random = Network(names, seed), np.random.default_rng(seed)
    if not len(labels):
        return network
    parameters = network.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    members = [np.flatnonzero(labels == k) for k in range(len(network.names))]
    members = [m for m in members if len(m)]
    for step in range(1, steps + 1):
        # as many of each language
        chosen = np.concatenate([random.choice(m, max(1, BATCH // len(members))) for m in members])
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        gradients = network.gradients(windows[chosen], weights[chosen], labels[chosen])
        for p, g, a, b in zip(parameters, gradients, first, second):
            g = np.clip(g, -1, 1)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return network


def cut(data, window=WINDOW):
    """Windows (n, window) of bytes; the last one is filled up with spaces."""
    n = -(-len(data) // window)
    filled = np.full(n * window, 32, np.uint8)
    filled[: len(data)] = np.frombuffer(data, np.uint8)
    return filled.reshape(n, window)


def pooled(network, texts):
    """Mean probabilities (texts, languages) over the letters of each UTF-8 text; zero rows for texts without."""
    totals, counts = np.zeros((len(texts), len(network.names))), np.zeros(len(texts))
    owners = np.repeat(np.arange(len(texts)), [-(-len(t) // WINDOW) for t in texts])
    pending = (cut(t) for t in texts if t)
    held, size, done = [], 0, 0
    for part in itertools.chain(pending, [None]):
        if part is not None:
            held.append(part)
            size += len(part)
            if size < ABREAST:
                continue
        if not held:
            break
        windows = np.concatenate(held)
        whole = len(windows) if part is None else len(windows) // ABREAST * ABREAST
        for start in range(0, whole, ABREAST):
            some = windows[start: min(start + ABREAST, whole)]
            p, _ = network.read(some)
            letters = IN_LETTER[some]
            p *= letters.T[:, :, None]
            owner = owners[done: done + len(some)]
            for k, row in enumerate(p.sum(0, dtype=np.float64).T):
                totals[:, k] += np.bincount(owner, row, len(texts))
            counts += np.bincount(owner, letters.sum(1), len(texts))
            done += len(some)
        held = [windows[whole:]]
        size = len(held[0])
    return totals / np.maximum(counts, 1)[:, None]


def sample(docs, learnable, per_language=PER_LANGUAGE, id="doc_id", text="text", language="lang"):
    """Names, byte windows, position weights and language numbers from at most `per_language` documents each.

    Every language counts, however many there are. Rows with a null language, id or text are left out.
    Only PER_DOCUMENT windows of a chosen document leave its task.
    """
    rows = docs.where(learnable).select(
        F.col(id).alias("id"), F.col(language).cast("string").alias("language"), F.col(text).cast("string").alias("text")
    ).where("id IS NOT NULL AND language IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("language").count().collect()  # one row for each output of the network
    names = sorted(r["language"] for r in sizes)
    # every language keeps about twice what is needed by a threshold of its own, then the first ones
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    limits = docs.sparkSession.createDataFrame(
        [(r["language"], int(min(1.0, 2 * per_language / r["count"]) * (1 << 40))) for r in sizes],
        "language string, most bigint",
    )
    last = F.greatest(F.length("text") - LEARNED, F.lit(0)) + 1
    pieces = F.transform(
        F.sequence(F.lit(1), F.lit(PER_DOCUMENT)),
        lambda i: F.substring("text", (F.pmod(F.xxhash64("id", i), last) + 1).cast("int"), F.lit(LEARNED)),
    )
    found = (
        rows.join(F.broadcast(limits), "language").where(place < F.col("most")).select("language", place.alias("place"), pieces.alias("pieces"))
        .orderBy("place", "language").limit(4 * per_language * len(sizes)).collect() if sizes else []
    )
    used, windows, labels = dict.fromkeys(names, 0), [], []
    for row in sorted(found, key=lambda r: (r["place"], r["language"], r["pieces"])):
        if used[row["language"]] < per_language:
            used[row["language"]] += 1
            for piece in dict.fromkeys(row["pieces"]):
                if has_letter(piece):
                    windows.append(cut(piece.encode(), LEARNED)[:1])
                    labels.append(names.index(row["language"]))
    windows = np.concatenate(windows) if windows else np.empty((0, LEARNED), np.uint8)
    return names, windows, IN_LETTER[windows].astype(np.float32), np.array(labels, np.int64)


def label(docs, network, text="text", names=("lang_pred", "score")):
    """`docs` with the language of every whole text and its probability as columns `names`.

    Null and empty texts, those without a letter and all texts of a network without languages are `und`
    with probability 0. A tie goes to the first name. A new name that `docs` has already, in capitals or
    not, is lengthened (`score_1`, …); the two are the last columns in any case.
    """
    names = tuple(unused(docs, name) for name in names)
    shared, given = docs.sparkSession.sparkContext.broadcast(network), unused(docs, "_bytes")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )

    def run(batches):
        net = shared.value
        for batch in slices(batches, given):
            texts = [t.as_buffer().to_pybytes() for t in batch.column(given)]
            texts = [t if has_letter(t.decode("utf-8", "replace")) else b"" for t in texts]
            p = pooled(net, texts) if net.names else np.zeros((len(texts), 1))
            best = p.argmax(1)
            known = [bool(t and net.names) for t in texts]
            found = [net.names[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            scores = [float(row[k]) if ok else 0.0 for row, k, ok in zip(p, best, known)]
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != given]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found), pa.array(scores)], names=schema.names)

    return mapped(docs.withColumn(given, text_bytes(F.col(text))), run, schema)


def identify(docs, learnable, id="doc_id", text="text", language="lang", names=("lang_pred", "score")):
    """Learn from the languages of `docs` where `learnable` holds and label all of them; see `sample`, `label`."""
    found, windows, weights, labels = sample(docs, learnable, id=id, text=text, language=language)
    return label(docs, learn(windows, weights, labels, found), text, names)
