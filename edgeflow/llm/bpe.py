"""BPE encoding by forced boundaries, and decoding.

Two neighbouring bytes that stand side by side in no token of the vocabulary can never be merged, so
the text can be cut between them for certain. The fragments between cuts are encoded one by one and
their ids concatenated. Fragments repeat far more often than words, so each worker keeps a bounded
table of those it has met.
"""

import functools
import itertools
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F

from edgeflow.llm.common import int_lists, mapped, slices, text_bytes
from edgeflow.llm.vocabulary import byte_letters, read_vocabulary

#: Words and fragments a worker remembers; the table starts anew beyond it.
REMEMBERED = 200_000


class _Table(dict):
    """A bounded memory of a function."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[key] = self.function(key)
        return value


class ForcedBoundaryEncoder:
    """text → ids of a vocabulary of word pieces (lower case, white space dropped, word-end suffix)."""

    def __init__(self, path):
        from tokenizers.models import BPE

        content = read_vocabulary(path)
        model, splits = content["model"], content["pre_tokenizer"]["pretokenizers"]
        self.suffix = model["end_of_word_suffix"]
        merges = [tuple(pair) for pair in model["merges"]]
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        self.last = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix)
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.letters = str.maketrans({chr(b): letter for b, letter in byte_letters().items()})
        self.joined = {
            pair
            for token in model["vocab"]
            for pair in itertools.pairwise(token.removesuffix(self.suffix))
        }
        # one object for each id, however many words have it
        self.numbers = list(range(max(model["vocab"].values()) + 1))
        self.fragments = _Table(self.fragment)
        self.words = _Table(self.word)

    def cuts(self, letters):
        """Fragments of a word in byte letters: cut wherever no token joins the two neighbours."""
        places = [i for i, pair in enumerate(itertools.pairwise(letters), 1) if pair not in self.joined]
        return [letters[a:b] for a, b in itertools.pairwise([0, *places, len(letters)])]

    def fragment(self, key):
        letters, ends_word = key
        return tuple(self.numbers[t.id] for t in (self.last if ends_word else self.inner).tokenize(letters))

    def word(self, word):
        letters = word.encode().decode("latin-1").translate(self.letters)
        *inner, last = self.cuts(letters)
        ids = [i for fragment in inner for i in self.fragments[fragment, False]]
        return (*ids, *self.fragments[last, True])

    def normal(self, text):
        """Composed and in lower case, letter by letter: a final sigma is not special."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text):
        """Ids of a whole text. Names of special tokens in it give their ids."""
        found, words = [], self.words.__getitem__
        for i, part in enumerate(self.special_pattern.split(text) if "<|" in text else [text]):
            if i % 2:
                found.append((self.special[part],))
            else:
                found.extend(map(words, self.pattern.findall(self.normal(part))))
        return list(itertools.chain.from_iterable(found))


@functools.cache
def encoder(path):
    return ForcedBoundaryEncoder(path)


@functools.cache
def token_texts(path):
    """Token texts by id."""
    content = read_vocabulary(path)
    tokens = content["model"]["vocab"] | {t["content"]: t["id"] for t in content["added_tokens"]}
    texts = [""] * (max(tokens.values()) + 1)
    for token, i in tokens.items():
        texts[i] = token
    return pa.array(texts)


def encode(docs, vocabulary, id="doc_id", text="text"):
    """Ids of every whole text: (doc_id, ids array<int>), a row for each row of `docs`.

    Null and empty texts have no ids. Other columns are not read, whatever their names.
    """

    def run(batches):
        coder = encoder(vocabulary)
        for batch in slices(batches, "text"):
            coded = [coder.encode(t.as_buffer().to_pybytes().decode("utf-8", "replace")) for t in batch.column("text")]
            counts = [len(ids) for ids in coded]
            flat = np.fromiter(itertools.chain.from_iterable(coded), np.int32, sum(counts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), int_lists(flat, counts)], names=["doc_id", "ids"])

    kind = docs.schema[id].dataType.simpleString()
    return mapped(
        docs.select(F.col(id).alias("doc_id"), text_bytes(F.col(text)).alias("text")), run, f"doc_id {kind}, ids array<int>"
    )


def decode(coded, vocabulary):
    """Encoded rows with `text`, their tokens joined by spaces as a vocabulary without decoder has it.

    Null ids give an empty text; an id that the vocabulary lacks fails.
    """

    def run(batches):
        texts = token_texts(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = part.column("ids")
                flat = texts.take(ids.flatten())
                counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pc.binary_join(lists, " ")], names=["doc_id", "ids", "text"]
                )

    kind = coded.schema["doc_id"].dataType.simpleString()
    return mapped(coded.select("doc_id", "ids"), run, f"doc_id {kind}, ids array<int>, text string")


def digests(decoded):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded rows."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
