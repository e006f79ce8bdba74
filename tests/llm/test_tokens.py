"""Encoding, decoding and packing against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

from cases import EDGE, documents, edge, empty  # noqa: F401
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edgeflow.llm import bpe, packing
from edgeflow.llm.vocabulary import byte_encoder

WORDS, BYTES = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


ODD = [
    "", " ", "It's 2024, they'll've gone!!! don't", "a" * 3000, "İstanbul ΟΔΟΣ ος ﬁ é Ǆ", "\x1c\x1d\x1e\x1f\x85​᠎　",
    "<|startoftext|>Hello<|endoftext|> world<|endoftext|", "日本語テキスト 한국어 🎉🎉👩‍👩‍👧", "x\x00y", "½²³ ⅷ ٣", "A" + "ñ" * 500, "...---...###",
]


@pytest.mark.parametrize("text", ODD)
def test_encoder_gives_the_ids_of_the_library(library, text):
    assert bpe.encoder(WORDS).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_encoder_on_random_letters(library):
    random.seed(3)
    letters = "abcdefgh '.!1é ßÄ<|>\n漢́"
    for _ in range(300):
        text = "".join(random.choices(letters, k=random.randrange(60)))
        assert bpe.encoder(WORDS).encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_cuts_are_where_no_token_joins():
    coder = bpe.encoder(WORDS)
    word = "qxzjqvxkq"
    fragments = coder.cuts(word)
    assert "".join(fragments) == word and len(fragments) > 1
    tokens = [t.removesuffix("</w>") for t in bpe.read_vocabulary(WORDS)["model"]["vocab"]]
    for left, right in zip(fragments, fragments[1:]):
        assert not any(left[-1] + right[0] in token for token in tokens)


def _digests(library, rows):
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((
            i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
        ))
    return sorted(expected, key=repr)


def _coded(docs):
    return sorted(map(tuple, bpe.digests(bpe.decode(bpe.encode(docs, WORDS), WORDS)).collect()), key=repr)


def test_digests(library, documents, edge, empty):
    assert _coded(documents) == _digests(library, [(r.doc_id, r.text) for r in documents.collect()])
    assert _coded(edge) == _digests(library, [row[:2] for row in EDGE])
    assert _coded(empty) == []


def test_null_ids_decode_to_nothing(spark):
    coded = spark.createDataFrame([(1, None), (2, []), (3, [320])], "doc_id bigint, ids array<int>")
    assert [r.text for r in bpe.decode(coded, WORDS).orderBy("doc_id").collect()] == ["", "", "a</w>"]


def test_byte_encoder_gives_the_ids_of_the_library():
    library = Tokenizer.from_file(BYTES)
    for text in [*ODD, "\n\n  x  \n", " " * 5000, "word " * 2000]:
        assert byte_encoder(BYTES)(text).tolist() == library.encode(text, add_special_tokens=False).ids


def _check(pieces, rows, window=1024):
    library = Tokenizer.from_file(BYTES)
    expected = sorted(zlib.crc32(packing.np.asarray([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for _, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.sequence_id * window + p.offset - p.start].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    found = []
    for own in by_doc.values():
        own.sort(key=lambda p: p.start)
        data, at = b"", 0
        for p in own:
            assert p.start == at and p.length == len(p.ids) // 4
            data, at = data + p.ids, at + p.length
        assert all(p.doc_tokens == at for p in own)
        found.append(zlib.crc32(bytes(data)))
    assert sorted(found) == expected
    for number, spans in by_sequence.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == window or number == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_packing(documents, edge, empty):
    _check(packing.pack(documents.repartition(5), BYTES).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    _check(packing.pack(edge, BYTES).collect(), [row[:2] for row in EDGE])
    assert packing.pack(empty, BYTES).collect() == []


def test_checksum(documents):
    pieces = packing.pack(documents.limit(3), BYTES)
    for p, q in zip(pieces.collect(), packing.with_checksum(pieces).collect()):
        assert zlib.crc32(bytes(p.ids)) == q.ids_crc32 == packing.checksum_of(np.frombuffer(p.ids, "<u4"))
