"""Plain-Python versions of operators, for small tables."""

import math
import re
from collections import Counter

import xxhash

SPACE = "[\x20\x09-\x0d]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def fingerprint(text, shingle=4):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i: i + shingle]) for i in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """The number of each item's group: the place of the first item it hangs together with."""
    group = list(range(len(items)))
    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def near(a, b, bits=4):
    return (a ^ b).bit_count() <= bits


def stripped(text):
    """(place, line) of the lines with a word."""
    found = [(i, line.strip(" \t\n\x0b\f\r")) for i, line in enumerate((text or "").split("\n"))]
    return [(i, line) for i, line in found if line]


def bm25(docs, queries, k):
    """query id → [(score, id)] of the best documents; docs and queries are {id: text}."""
    bags = {i: Counter(re.findall(r"[^\W_]+", (t or "").lower())) for i, t in docs.items()}
    length = {i: sum(bag.values()) for i, bag in bags.items()}
    mean = sum(length.values()) / max(1, len(bags))
    df = Counter(w for bag in bags.values() for w in bag)
    idf = {w: math.log(1 + (len(bags) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    found = {}
    for q, text in queries.items():
        asked = Counter(re.findall(r"[^\W_]+", (text or "").lower()))
        scores = []
        for i, bag in bags.items():
            norm = 1.2 * (0.25 + 0.75 * length[i] / max(mean, 1e-9))
            shared = [w for w in asked if w in bag]
            if shared:
                scores.append((sum(asked[w] * idf[w] * bag[w] * 2.2 / (bag[w] + norm) for w in shared), i))
        found[q] = sorted(scores, key=lambda s: (-round(s[0], 6), s[1]))[:k]
    return found
