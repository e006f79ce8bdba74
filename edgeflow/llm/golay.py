"""The binary Golay code of 23 bits as a fuzzy hash.

Every word of 23 bits has exactly one codeword within three bits. The *keys* of a word are the 12-bit
indices of all codewords within four bits: one, or six if the nearest codeword is three bits away.
Two words that differ in at most two bits share a key: the word half-way between them has a codeword
within three bits, and that is within four bits of both.
"""

import functools
import itertools

import numpy as np

BITS, INDEX_BITS, CHECK_BITS = 23, 12, 11
# fixed value: generator polynomial of the code
GENERATOR = 0b101011100011


def syndromes(words):
    """Remainders by the generator polynomial; codewords have remainder zero."""
    rest = np.asarray(words, np.uint32).copy()
    for shift in range(INDEX_BITS - 1, -1, -1):
        rest ^= ((rest >> np.uint32(shift + CHECK_BITS)) & np.uint32(1)) * np.uint32(GENERATOR << shift)
    return rest


@functools.cache
def corrections():
    """(2048, 6) error patterns of up to four bits that lead from a word with this syndrome to a codeword, −1 for none."""
    patterns = np.array(
        [sum(1 << b for b in places) for n in range(5) for places in itertools.combinations(range(BITS), n)], np.uint32
    )
    by = syndromes(patterns)
    table, filled = np.full((1 << CHECK_BITS, 6), -1, np.int64), np.zeros(1 << CHECK_BITS, int)
    for syndrome, pattern in zip(by.tolist(), patterns.tolist()):
        table[syndrome, filled[syndrome]] = pattern
        filled[syndrome] += 1
    return table


def keys(words):
    """(n, 6) codeword indices within four bits of each word, −1 where there are fewer."""
    words = np.asarray(words, np.uint32)
    errors = corrections()[syndromes(words)]
    return np.where(errors < 0, -1, (words.astype(np.int64)[:, None] ^ errors) >> CHECK_BITS)
