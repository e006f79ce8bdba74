import hashlib
import re

import numpy as np
import pytest
from cases import EDGE, documents, edge, empty  # noqa: F401
from pyspark.sql import functions as F

from edgeflow.llm import middle


def _units(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text)


def _plain(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i: i + 8], 16) for i in (0, 8, 16, 24)]
    units = _units(text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


TRICKY = [
    (20, "a<\nS>b\n\n\n"), (21, "\n"), (22, "<P"), (23, "has <M> inside\nand more"), (24, "x\r\ny z\x85w\n"),
    (25, "<S\n<S\n<P\n<M\n>\n"), (26, "\n" * 5_000), (27, "ß漢🎉\n" * 3_000 + "end"), (28, "no newline at all"),
]


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 100), (0, 50), (100, 0)])
def test_against_plain_python(spark, rate, spm):
    rows = [row[:2] for row in EDGE] + TRICKY
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = middle.transform(docs, rate=rate, spm=spm).withColumn("back", middle.restore(F.col("output"), F.col("form")))
    got = sorted(((r.doc_id, *r[1:6], r.back) for r in found.collect()), key=repr)
    assert got == sorted(((i, *_plain(i, t, rate, spm), t or "") for i, t in rows), key=repr)


def test_clashing_columns_and_no_rows(edge, empty):
    clashing = edge.withColumns({c: F.lit(1) for c in ("form", "output", "prefix_chars", "middle_chars", "n")})
    got = sorted(map(tuple, middle.transform(clashing).collect()), key=repr)
    assert got == sorted(((row[0], *_plain(*row[:2])) for row in EDGE), key=repr)
    assert middle.digests(middle.transform(empty)).collect() == []


def test_digests_of_documents(documents):
    found = {r.doc_id: r for r in middle.digests(middle.transform(documents)).collect()}
    for r in documents.collect():
        n, form, prefix, mid, output = _plain(r.doc_id, r.text)
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (output, r.text or "")]
        assert tuple(found[r.doc_id]) == (r.doc_id, n, form, prefix, mid, *sha)


def test_every_rank_is_reached_in_few_steps():
    random = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 17, 900, 20_000):
        units = ["é" * int(k) + "\n" for k in random.integers(0, 9, n)]
        found = middle.SkipList("".join(units).encode())
        points = np.concatenate([[0], np.cumsum([len(u) for u in units])])
        size = np.concatenate([[0], np.cumsum([len(u.encode()) for u in units])])
        assert found.n == n
        ranks = range(n + 1) if n < 1_000 else random.integers(0, n + 1, 500)
        sought = [found.seek(rank) for rank in ranks]
        assert [s[:2] for s in sought] == [(points[r], size[r]) for r in ranks]
        # a fan-out of four: a handful of steps a lane, not a walk along the lines
        assert max(s[2] for s in sought) <= 40 + 8 * len(found.lanes)
