"""Encoders made from vocabulary files; built once in every Python worker."""

import functools
import json

import numpy as np


@functools.cache
def byte_letters():
    """byte → the printable letter that stands for it in byte-level vocabularies."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def read_vocabulary(path):
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@functools.cache
def byte_encoder(path):
    """text → ids of a byte-level vocabulary whose ranks are its ids, special tokens included.

    The rank coder gives the same ids as the file's own library several times as fast; texts its
    pattern engine gives up on (a huge run of one character class) go to that library.
    """
    import tiktoken
    from tokenizers import Tokenizer

    content = read_vocabulary(path)
    byte_of = {letter: b for b, letter in byte_letters().items()}
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    ranks = {
        bytes(byte_of[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special
    }
    # fixed value: the split pattern of byte-level vocabularies
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    library = []

    def encode(text):
        try:
            return coder.encode_to_numpy(text, allowed_special="all")
        except BaseException as error:  # a panic of the coder is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            library[:] = library or [Tokenizer.from_file(path)]
            return np.array(library[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode
