"""Line dedup, search, quality rules, licences and pages."""

import re
from collections import Counter, defaultdict
from pathlib import Path

from cases import EDGE, SF, documents, edge, empty, texts  # noqa: F401
from check import compare, connect
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
from pyspark.sql import functions as F

from edgeflow.llm import licence_terms, licences, lines, pages, rules, search
from edgeflow.llm.oracle import ORACLE, rules_sql
from edgeflow.llm.queries import QUERIES
from edgeflow.plans import plan_text

# ---- line dedup

small = st.lists(st.integers(0, 6), max_size=14)


@given(small, small)
@settings(max_examples=200, deadline=None)
def test_patience_matches_equal_elements_in_rising_order(a, b):
    found = lines.patience(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:]))
    assert not found == [] or not set(a) & set(b)


@given(small, small, st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_blocks_are_equal_runs_and_all_of_length_one_are_found(a, b, least):
    gone = lines.common_blocks(a, b, [1] * len(b), least)
    assert all(b[j] in a for j in gone)
    if least == 1:
        assert gone == [j for j, x in enumerate(b) if x in a]


PASSAGE = "\n".join(" ".join(f"p{i}w{j}" for j in range(30)) for i in range(3))


def test_passages_leave_all_documents_but_the_first(spark):
    rows = [(i, f"own first {i}\n{PASSAGE}\n\nown last {i}") for i in range(40)]
    rows.append((40, PASSAGE.split("\n")[2] + "\n\n" + PASSAGE.split("\n")[0]))  # moved
    found = {r.doc_id: r.text for r in lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[0] == rows[0][1] and found[40] == ""
    assert all(found[i] == f"own first {i}\n\nown last {i}" for i in range(1, 40))


def test_line_dedup_of_edge_cases(edge, empty):
    found = lines.dedup(edge)
    assert found.columns == edge.columns and found.count() == len(EDGE)
    texts = {(r.doc_id, r.text) for r in found.collect()}
    # the copies of the long text and null texts; rows of equal id and text stay alike
    assert (50, "") in texts and (7, EDGE[9][1]) in texts and (2, None) in texts
    assert lines.dedup(empty, counts="counts").collect() == []


def _blocks(first, later, words, least):
    """Places of all runs of `later` that `first` has as well, of `least` words or more, by trying all diagonals."""
    gone = set()
    for shift in range(-len(first), len(later)):
        run = []
        for j in range(max(0, shift), len(later) + 1):
            if j < len(later) and 0 <= j - shift < len(first) and first[j - shift] == later[j]:
                run.append(j)
                continue
            if sum(words[p] for p in run) >= least:
                gone.update(run)
            run = []
    return gone


def _against_all(rows, least=lines.BLOCK_WORDS):
    """id → text of documents in order, without the blocks that any earlier one has."""
    seen, found = [], {}
    for i, text in sorted(rows):
        own = plain.stripped(text)
        body, gone = [line for _, line in own], set()
        for other in seen:
            if not set(body).isdisjoint(other):
                gone |= {own[p][0] for p in _blocks(other, body, [len(line.split()) for line in body], least)}
        seen.append(body)
        found[i] = "\n".join(line for p, line in enumerate(text.split("\n")) if p not in gone)
    return found


def _line(name, words=8):
    return " ".join(f"{name}w{j}" for j in range(words))


def test_blocks_whose_lines_have_other_first_holders(spark):
    shared = [_line(f"l{k}") for k in range(8)]
    short = [f"s{k} of three" for k in range(9)]
    rows = [(k, f"{_line(f'own{k}')}\n{line}\n{_line(f'end{k}')}") for k, line in enumerate(shared)]
    rows += [(20 + k, "\n".join([_line(f"d{k}"), *shared, _line(f"e{k}")])) for k in range(3)]
    rows += [(30 + k, "\n".join([_line(f"f{k}"), *short])) for k in range(2)]
    found = {r.doc_id: r.text for r in lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[20] == dict(rows)[20] and found[21] == f"{_line('d1')}\n{_line('e1')}" and found[31] == _line("f1")
    assert found == _against_all(rows)


def test_line_dedup_against_every_earlier_document(documents, texts):
    expected = _against_all(texts.items())
    assert {r.doc_id: r.text for r in lines.dedup(documents).collect()} == expected
    assert any(len(t) > len(expected[i]) for i, t in texts.items())


@given(small, small, st.lists(st.integers(1, 30), min_size=7, max_size=7), st.integers(1, 40))
@settings(max_examples=500, deadline=None)
def test_all_common_blocks_are_found(a, b, sizes, least):
    words = [sizes[x] for x in b]
    assert lines.common_blocks(a, b, words, least) == sorted(_blocks(a, b, words, least))


@given(st.lists(st.integers(0, 2), max_size=40), st.lists(st.integers(0, 2), max_size=40), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_all_common_blocks_of_few_lines_that_repeat_are_found(a, b, least):
    words = [2] * len(b)
    assert lines.common_blocks(a, b, words, least) == sorted(_blocks(a, b, words, least))


def test_a_block_that_short_lines_cross():
    first, later = ["s1", "x1", "s2", "x2", "P"], ["P", "s1", "y1", "s2", "y2"]
    assert lines.common_blocks(first, later, [60, 5, 5, 5, 5]) == [0]


# ---- search

def _close(found, expected, k):
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.score, r.doc_id))
    assert {q: len(v) for q, v in by_query.items()} == {q: len(v) for q, v in expected.items() if v}
    for q, rows in by_query.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        for (_, score, _), (true, _) in zip(rows, expected[q]):
            assert score == pytest.approx(true, abs=2e-6)


@pytest.mark.parametrize("k, postings", [(1, 10**6), (10, 3_000), (10, 500)])
def test_search_against_brute_force(documents, texts, monkeypatch, k, postings):
    monkeypatch.setattr(search.index, "__defaults__", (postings, "doc_id", "text"))
    monkeypatch.setattr(search, "FIRST_WAVE", 1)
    found = search.top_k(documents.repartition(3), documents.where("doc_id % 20 = 0"), k=k, queries_at_a_time=4).collect()
    _close(found, plain.bm25(texts, {i: t for i, t in texts.items() if i % 20 == 0}, k), k)


def _random_shard(seed, documents=1_500, words=3_000, length=60):
    """A shard of documents of a few frequent and many rare terms, a sixth of them copies, and each one's query."""
    draw = np.random.default_rng(seed)
    found = []
    for _ in range(documents):
        bag = np.where(draw.random(length) < 0.2, draw.integers(0, 5, length), draw.integers(5, words, length))
        found.append(np.unique(bag[: draw.integers(1, length)], return_counts=True))
    for first in range(0, documents - 9, 50):
        found[first + 1: first + 9] = [found[first]] * 8
    made = search._shard(list(range(documents)), found)
    places, counts = (np.frombuffer(made[n], "<i4") for n in ("places", "counts"))
    shard = search.Shard(made["ids"], made["lengths"], made["terms"], made["df"], places, counts, made["lengths"].mean())
    df = np.zeros(words)
    df[made["terms"]] = made["df"]
    return shard, [(t, c * np.log(1 + (documents - df[t] + 0.5) / (df[t] + 0.5))) for t, c in found]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("seek", [0, 20, 10**9])
def test_terms_below_the_least_score_are_sought_in_open_blocks_only(monkeypatch, seed, seek):
    monkeypatch.setattr(search, "SEEK", seek)
    shard, queries = _random_shard(seed)
    for at in range(0, len(queries), 100):
        some = queries[at: at + 20]
        shard.postings_read = 0
        whole = shard.best(some, 5, [-np.inf] * len(some))
        all_read, shard.postings_read = shard.postings_read, 0
        least = [scores.min() if len(scores) == 5 else -np.inf for _, scores in whole]
        pruned = shard.best(some, 5, least)
        for (places, scores), (where, found) in zip(whole, pruned):
            assert places.tolist() == where.tolist() and np.allclose(scores, found, rtol=0, atol=2e-6)
        # where a seek costs nothing, fewer are read; where it costs much, all of the open terms are
        assert shard.postings_read < all_read if seek == 0 else shard.postings_read <= all_read


def test_words_are_those_of_the_pattern():
    texts = ["", " \n", "One two_two, one.", "Ünï çödé ß Σ ς İ ı 漢字 🎉 x²½ ٣ a\x1cb\x85c", "x" * 300_000, "w" + " w7 v" * 60_000, "last"]
    assert max(map(len, texts)) > 2 * search.PIECE
    number = {}
    for text, (terms, counts) in zip(texts, search._bags(texts)):
        words = Counter(re.findall(r"[^\W_]+", text.lower()))
        assert terms.tolist() == sorted(set(terms.tolist())) and all(t >= 0 for t in terms)
        alone = {int(search._bags([word])[0][0][0]): n for word, n in words.items()}
        assert dict(zip(terms.tolist(), counts.tolist())) == alone
        number.update(zip(words, alone))
    assert len(set(number.values())) == len(number)


def test_documents_of_other_languages_are_in_other_shards():
    draw = np.random.default_rng(3)
    found = [np.unique(draw.integers(0, 40, 30) + 1000 * (i % 3), return_counts=True) for i in range(300)]
    groups = search._alike(found, 200)
    assert sorted(tuple(sorted({i % 3 for i in g})) for g in groups) == [(0,), (1,), (2,)]
    assert sorted(i for g in groups for i in g) == list(range(300))
    # too few postings to part, and documents without words
    assert [g.tolist() for g in search._alike(found, 10**6)] == [list(range(300))]
    none = np.empty(0, np.int64)
    assert sum(len(g) for g in search._alike([(none, none)] * 5 + found, 200)) == 305


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("cells, listed", [(0, 1), (1, 4), (10**9, 10**9)])
def test_answers_are_the_same_by_products_and_by_postings(monkeypatch, seed, cells, listed):
    monkeypatch.setattr(search, "FREQUENT", 100)
    monkeypatch.setattr(search, "LISTED", listed)
    monkeypatch.setattr(search, "CELLS", cells)
    shard, queries = _random_shard(seed, documents=400, words=300)
    for query, (places, scores) in zip(queries[:40], shard.best(queries[:40], 7, [-np.inf] * 40)):
        sums = defaultdict(float)
        for term, weight in zip(*query):
            at = np.searchsorted(shard.terms, term)
            for posting in range(shard.starts[at], shard.starts[at + 1]):
                sums[int(shard.places[posting])] += weight * shard.impacts[posting]
        expected = sorted((-round(s, search.PLACES), shard.id_order[place]) for place, s in sums.items())[:7]
        assert [-s for s in scores] == pytest.approx([s for s, _ in expected], abs=2e-6)
        assert [shard.id_order[p] for p in places] == [i for _, i in expected]


def test_many_partitions_of_files_make_fewer_shards(spark, tmp_path):
    texts = spark.range(400).selectExpr("id AS doc_id", "concat('word', id, ' text') AS text").repartition(100)
    texts.write.parquet(str(tmp_path / "docs"))
    files = spark.read.parquet(str(tmp_path / "docs"))
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert files.rdd.getNumPartitions() > search.CORE_TASKS * cores
        assert search._gathered(files).rdd.getNumPartitions() == search.CORE_TASKS * cores
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert search._gathered(files.repartition(500)).count() == 400


def test_queries_of_one_id_are_answered_each(spark):
    docs = spark.createDataFrame([(i, f"w{i} w{i + 1}") for i in range(20)], "doc_id bigint, text string")
    asked = spark.createDataFrame([(7, "w3"), (7, "w10 w10"), (7, "w3"), (7, None), (8, "w19"), (None, "w5")], "doc_id bigint, text string")
    found = search.top_k(docs, asked, queries_at_a_time=2).collect()
    assert sorted((r.query_id, r.rank, r.doc_id) for r in found) == sorted(
        [(7, 1, 2), (7, 2, 3)] * 2 + [(7, 1, 9), (7, 2, 10), (8, 1, 18), (8, 2, 19)]
    )


def test_the_plan_of_a_search_is_the_same_for_any_number_of_blocks(documents):
    asked = documents.where("doc_id % 40 = 0").limit(5)
    plans = [plan_text(search.top_k(documents, asked, k=3, queries_at_a_time=n)) for n in (100, 1)]
    few, many = ([plan.count(x) for x in ("Join", "Exchange", "Scan parquet", "Union")] for plan in plans)
    assert few == many and few[0] > 0


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i, "same text here" if i % 2 else f"other {i}") for i in range(200)], "doc_id bigint, text string")
    found = search.top_k(docs, docs.where("doc_id = 151"), k=5).orderBy("rank").collect()
    assert [r.doc_id for r in found] == [1, 3, 5, 7, 9]


def test_search_of_edge_cases(spark, edge, empty):
    found = search.top_k(edge, edge, k=3).collect()
    assert {r.query_id for r in found} <= {row[0] for row in EDGE} - {None, 1, 2, 3}
    assert search.top_k(empty, empty).collect() == [] and search.top_k(edge, empty).collect() == []
    assert search.top_k(edge, spark.createDataFrame([(1, "absentword")], "doc_id bigint, text string")).collect() == []


# ---- quality rules

def test_rules_of_edge_cases(edge, empty):
    found = rules.judge(edge)
    assert found.count() == len(EDGE) and rules.judge(empty).collect() == []
    by_id = {r.doc_id: r for r in found.collect()}
    assert (by_id[2].n_words, by_id[2].word_chars, by_id[2].kept) == (0, 0, False)
    assert by_id[8].n_words == 1 and by_id[8].word_chars == 200_000
    assert by_id[7].n_words == 60_000 and by_id[7].n_repeat_words == 60_000 and by_id[7].base_failed


def test_repeated_words_and_lines(spark):
    text = "a b c d e f a b c d e\nx\nx\n \nx \n# $"
    row = rules.judge(spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (16, 16, 2, 1, 10)


def test_frequent_lines_deplete_documents(spark):
    line = "a line of six words here"
    own = lambda i: " ".join(f"own{i}word{j}" for j in range(12))
    rows = [(i, f"{line}\n{line}\n{line}\nshort tail {i}", "host") for i in range(12)]
    rows += [(100 + i, f"{line}\n{own(i)}", "host") for i in range(3)]
    rows += [(200 + i, f"{line}\n{line}\n{line}\nshort tail {i}", None) for i in range(5)]
    rows += [(300 + i, f"{own('c')}\n{own('d')}", "copies") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id: r.kept for r in rules.judge(docs, most_repeated=100).collect()}
    assert not any(kept[i] for i in range(12)) and all(kept[i] for i in kept if i >= 100)


@pytest.mark.parametrize("documents", [40, 400])
def test_the_limit_goes_with_the_host(spark, documents):
    """The same share of a host has the same verdict at either size; copies of documents change neither."""
    own = lambda i: " ".join(f"own{i}word{j}" for j in range(12))
    common, rarer = "a line of boiler plate on very many of the pages " * 5, "some other line on a few of the pages here " * 5

    def text(i):
        return f"{own(i)}\n" + (common if 100 * i < 30 * documents else rarer if 100 * i >= 92 * documents else own(-i - 1))

    rows = [(i, text(i), "host") for i in range(documents)] + [(5_000 + i, text(documents - 1), "host") for i in range(200)]
    kept = {r.doc_id: (r.kept, r.n_words - r.words_left > 0) for r in rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), most_repeated=100).collect()}
    assert all(kept[i] == (100 * i >= 30 * documents, 100 * i < 30 * documents) for i in range(documents))
    assert all(kept[5_000 + i] == (True, False) for i in range(200))


def test_rules_equal_their_sql_where_documents_are_depleted(spark):
    sf_dir, limits = SF, {"max_share": 0.02, "least_documents": 2}
    found = rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), least_left=0.9, **limits)
    sql = rules_sql(limits["max_share"], limits["least_documents"], 0.9)
    assert compare(found, connect(sf_dir), sql) is None
    assert found.where("NOT kept AND NOT base_failed").count() > 0


# ---- licences

def test_templates_match_themselves(spark):
    files = spark.createDataFrame(
        [(i, f"d{i}/f", f"# header\n{text}\nmore") for i, (_, text) in enumerate(licences.TEMPLATES)], "doc_id bigint, path string, text string"
    )
    found = {r.doc_id: r for r in licences.scan(files).collect()}
    for i, (licence, _) in enumerate(licences.TEMPLATES):
        assert found[i].licence == licence and found[i].origin in ("file", "notice")


def test_the_nearest_directory_counts(spark):
    mit, apache = (next(t for n, t in licences.TEMPLATES[k:] if n == name) for name, k in (("MIT", 3), ("Apache-2.0", 1)))
    prose = "nothing but prose of many words " * 40
    files = [
        ("LICENSE", mit), ("a/x", prose), ("a/b/COPYING", apache), ("a/b/c/y", prose), ("a/bc/z", prose), ("a/b", prose),
        ("a/b/c/n", f"{prose}\nReleased under the MIT License.\n{prose}"), (None, prose), (None, mit), ("e", None), ("f", ""),
    ]
    table = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id bigint, path string, text string")
    found = {r.doc_id: (r.licence, r.origin, r.origin_path) for r in licences.scan(table).collect()}
    assert found == {
        0: ("MIT", "file", None), 1: ("MIT", "inherited", "LICENSE"), 2: ("Apache-2.0", "file", None),
        3: ("Apache-2.0", "inherited", "a/b/COPYING"), 4: ("MIT", "inherited", "LICENSE"), 5: ("MIT", "inherited", "LICENSE"),
        6: ("MIT", "notice", None), 7: (None, "none", None), 8: ("MIT", "file", None),
        9: ("MIT", "inherited", "LICENSE"), 10: ("MIT", "inherited", "LICENSE"),
    }


def test_whole_licences_are_inherited(spark):
    prose = "nothing but prose of many words " * 40
    # the words of each licence in full, as often as in its text
    texts_ = {}
    for licence, counts in licence_terms.WHOLE.items():
        words = counts.split()
        texts_[licence] = " ".join(f"{term} " * int(n) for term, n in zip(words[::2], words[1::2]))
    files = [(f"{licence}/{name}", text) for licence, own in texts_.items() for name, text in (("LICENSE", own), ("src/x", prose))]
    # the common words of a licence make no licence file
    files.append(("z/y", f"the license of it. {'the of and to a or in that this you is for any ' * 30} {prose}"))
    table = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id bigint, path string, text string")
    found = {r.path: (r.licence, r.origin, r.origin_path) for r in licences.scan(table).collect()}
    for licence in texts_:
        assert found[f"{licence}/LICENSE"] == (licence, "file", None)
        assert found[f"{licence}/src/x"] == (licence, "inherited", f"{licence}/LICENSE")
    assert found["z/y"] == (None, "none", None)


NAMES = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2",
    "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0",
    "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


def _licence_files():
    """Licence → text of the files in the system's folder, and of two made from them."""
    folder = Path("/usr/share/common-licenses")
    if not all((folder / name).is_file() for name in NAMES):
        pytest.skip("no licence files here")
    found = {licence: (folder / name).read_text(errors="replace") for name, licence in NAMES.items()}
    bsd = found["BSD-3-Clause"]
    found["BSD-2-Clause"] = bsd[: bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE"):]
    affero = found["GPL-3.0"].replace("the terms of the GNU General", "the terms of the GNU Affero General")
    assert affero != found["GPL-3.0"]
    return found | {"AGPL-3.0": affero}


def test_licence_files_and_their_sql(spark, tmp_path):
    prose = "nothing but prose of many words " * 40
    rows = []
    for k, (licence, text) in enumerate(_licence_files().items()):
        # a folder of the query is a source, a language and a thousand
        rows += [(1000 * k, text, "en", "s"), (1000 * k + 1, prose, "en", "s"), (1000 * k + 2, f"{prose}\nReleased under the MIT License.", "en", "s")]
    rows += [(99_000, prose, "en", "s"), (99_001, None, "en", "s"), (99_002, prose, None, None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    table.coalesce(1).toPandas().to_parquet(tmp_path / "documents.parquet")
    found = QUERIES["op2_licences"](spark, str(tmp_path))
    by_id = {r.doc_id: (r.licence, r.origin) for r in found.collect()}
    for k, licence in enumerate(_licence_files()):
        assert by_id[1000 * k] == (licence, "file") and by_id[1000 * k + 1] == (licence, "inherited")
        assert by_id[1000 * k + 2] == ("MIT", "notice")
    assert by_id[99_000] == by_id[99_001] == (None, "none")
    assert compare(found, connect(tmp_path), ORACLE["op2_licences"]) is None


def test_licences_of_edge_cases(edge, empty):
    assert licences.scan(edge.withColumn("path", F.col("source"))).count() == len(EDGE)
    assert licences.scan(empty.withColumn("path", F.col("source"))).collect() == []


# ---- pages

BODY = "<p>" + "A long paragraph of the article. " * 8 + "</p>"
LONG = ("A long paragraph of the article. " * 8).strip()


@pytest.mark.parametrize("html, blocks", [
    ("", []), ("no markup at all but " + "many words " * 20, [("no markup at all but " + "many words " * 20).strip()]),
    ("<p>short</p>", ["short"]), ("<nav>short</nav><p>a page</p><footer>x</footer>", ["a page"]), ("<nav>short</nav>", []),
    (f"<nav><a href=x>Menu</a></nav><article><h1>Title</h1>{BODY}<p>Ti.</p></article><footer>&copy; x</footer>", ["Title", LONG, "Ti."]),
    (f"<article><p><b>Bold.<br>&amp;\n  next<p>Open {BODY}", ["Bold. & next", "Open", LONG]),
    (f"<article>{BODY}<div class='ad-box'>Buy<div>this</div></div><p>End.</p><section id=comments><p>First!</p></section></article>", [LONG, "End."]),
    (f"<div id=sidebar><p>{LONG}</p></div><div class=main>{BODY}</div>", [LONG]),
    (f"<ul><li><a>one</a><li><a>two</a><li><a>three</a><li><a>four</a></ul>{BODY}<p>tail</p>", [LONG, "tail"]),
    (f"<article>{BODY}<form><input><p>Your mail</p></form><script>var a = '</p>';</script><!-- {BODY} --><p>x &lt; y</p></article>", [LONG, "x < y"]),
    (f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header>{BODY}</article>", ["Title", LONG]),
    (f"<article>{BODY}<p>cut of", [LONG, "cut of"]), (f"<article>{BODY}<p class='", [LONG]), (f"<article>{BODY}<script>never closed", [LONG]),
])
def test_main_text(html, blocks):
    assert pages.main_text(html) == "\n\n".join(blocks)


def test_a_page_without_article_element_is_found_by_its_surge():
    menu = "".join(f"<div><a href=/{i}>Link {i}</a></div>" for i in range(9))
    html = f"<html><body>{menu}<div>Home</div><p>Intro.</p>{BODY}{BODY}<p>Out.</p>{menu}<div>(c) 2020</div></body></html>"
    assert pages.main_text(html).split("\n\n") == ["Home", "Intro.", LONG, LONG, "Out."]


OTHER = ("Another paragraph of the text proper. " * 8).strip()


@pytest.mark.parametrize("html, blocks", [
    (f"<div class=post><p>{LONG}</p><p>{OTHER}</p></div><article><p>Teaser one</p></article><article><p>Teaser two</p></article>", [LONG, OTHER]),
    (f"<article><p>{LONG}</p></article><div class=post><p>{OTHER}</p><p>End.</p></div>", [LONG, OTHER, "End."]),
    (f"<p>Home</p><article><p>{LONG}</p><p><a>Wholly a link</a></p></article><p>(c) 2020</p>", [LONG, "Wholly a link"]),
    ("<p>Some words of a site</p><article><p>Short.</p></article>", ["Short."]),
    ("<article><p><a>Only a link</a></p></article>", ["Only a link"]),
    (f"<main><header><h1>Title</h1></header><p>{LONG}</p></main>", ["Title", LONG]),
    (f"<main><p>{LONG}</p></main><div class=post><p>{OTHER}</p></div>", [LONG, OTHER]),
])
def test_an_article_element_does_not_decide_alone(html, blocks):
    assert pages.main_text(html) == "\n\n".join(blocks)


@pytest.mark.parametrize("html, blocks", [
    (f"<article class='post comments-open'><p>{LONG}</p></article>", [LONG]),
    (f"<div class='content has-sidebar'><article><p>{LONG}</p></article><div class=sidebar>{OTHER}</div></div>", [LONG]),
    (f"<div id='no-sidebar-layout'><p>{LONG}</p></div>", [LONG]),
    (f"<div class='search-result-page'><p>{LONG}</p></div>", [LONG]),
    (f"<article><p>{LONG} <span class='alert'>Kept</span> words <b class='notice'>here</b></p></article>", [f"{LONG} Kept words here"]),
    (f"<p>{LONG}</p><div id=search><article><p>{LONG}</p><p>{OTHER}</p></article></div>", [LONG, LONG, OTHER]),
    (f"<article><p>{LONG}</p></article><div id=comments><article class=comment><p>{OTHER * 3}</p></article></div>", [LONG]),
    (f"<article><p>{LONG}</p></article><div class='site-footer'>{OTHER}</div><div class=adBox>{OTHER}</div>", [LONG]),
])
def test_hints_mark_whole_tokens_or_heads(html, blocks):
    assert pages.main_text(html) == "\n\n".join(blocks)


END = "A closing passage of about seventy letters that ends the whole text."


@pytest.mark.parametrize("html, blocks", [
    (f"<div><p>{LONG}</p><div class=ad>Buy</div><p>{END}</p></div>", [LONG, END]),
    (f"<div><ul><li>{LONG}</ul><div class=ad>Buy</div><form>Mail</form><div>{END}</div></div><div>(c) 2020</div>", [LONG, END, "(c) 2020"]),
    (f"<div><p>{LONG}</p></div><div class=ad>Buy</div><div><p>{END}</p></div>", [LONG]),
    (f"<div><p>{LONG}</p><p><a>Wholly a link</a></p><ul><li><a>An item</a></ul><p>{END}</p></div>", [LONG, "Wholly a link", "An item", END]),
])
def test_short_ends_and_linked_lines_stay(html, blocks):
    assert pages.main_text(html) == "\n\n".join(blocks)


TEXTS = (
    "elementor-widget related-work discussion-paper social-science share-price notice-period menu-item-description ad-hoc"
    " comments-open no-comments has-sidebar content-sidebar-wrap search-result-page"
).split()
CHROME = (
    "user-comments-box wpd-comment-text comments-page comment-with-avatar commentlist responses comment-7 ad ad-slot adBox"
    " google-ads sidebar td-sidebar site-footer related-posts social_links cookie-notice newsletter-signup main-menu alert-info"
).split()


@pytest.mark.parametrize("name", TEXTS)
def test_names_that_hold_a_hint_are_text(name):
    part = f"<div class='{name}'><p>{OTHER}</p></div>"
    assert pages.main_text(part) == OTHER
    assert pages.main_text(f"<div id=a><p>{LONG}</p>{part}</div>") == f"{LONG}\n\n{OTHER}"
    assert pages.main_text(f"<article><p>{LONG}</p>{part}</article>") == f"{LONG}\n\n{OTHER}"


@pytest.mark.parametrize("name", CHROME)
def test_names_that_are_hints_are_left_out(name):
    part = f"<div class='x {name}'><p>{OTHER * 3}</p><article><p>{OTHER}</p></article></div>"
    if name in CHROME[:10]:
        assert pages.main_text(f"<article><p>{LONG}</p></article>{part}") == LONG
        assert pages.main_text(part) == ""
    part = f"<div class='x {name}'><p>{OTHER * 3}</p></div>"
    assert pages.main_text(f"<div><p>{LONG}</p>{part}</div>") == LONG
    assert pages.main_text(f"<article><p>{LONG}</p>{part}</article>") == LONG


@pytest.mark.parametrize("html, blocks", [
    (f"<form id=aspnetForm><input type=hidden><div><input name=q></div><article><p>{LONG}</p></article></form>", [LONG]),
    (f"<form id=aspnetForm><input type=hidden><div><input name=q></div><p>{LONG}</p><p>{OTHER}</p></form>", [LONG, OTHER]),
    (f"<form><nav>Menu</nav><p>{LONG}</p></form><p>(c) 2020</p>", [LONG, "(c) 2020"]),
    (f"<p>{LONG}</p><form><p>{END}</p><label>Your very long name and address</label><input><textarea>x</textarea></form>", [LONG]),
    (f"<p>{LONG}</p><form><p>Search</p><input><button>Go</button></form><p>{OTHER}</p>", [LONG, OTHER]),
    (f"<p>{LONG}</p><form>Never closed <input>", [LONG]),
    (f"<form class=search><p>{LONG}</p></form><div class=main><p>{OTHER}</p></div>", [OTHER]),
    (f"<p>{LONG} where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and <object data=a.svg>a figure</object> stand.</p>",
     [f"{LONG} where x=1 and a figure stand."]),
    (f"<div class=widget><p>{LONG}</p></div>", [LONG]),
    (f"<article><p>{LONG}</p></article><ol class=commentlist><li><article class=comment-body>{OTHER * 3}</article></ol>", [LONG]),
])
def test_forms_and_pages_within_hints(html, blocks):
    assert pages.main_text(html) == "\n\n".join(blocks)


def _passages(weights, window, surge):
    """Passages by the definition: runs of places whose window, of the places up to it, holds any weight."""
    sums = [sum(weights[max(0, i - window + 1): i + 1]) for i in range(len(weights))]
    runs, start = [], 0
    for end in range(1, len(sums) + 1):
        if end == len(sums) or (sums[end] > 0) != (sums[start] > 0):
            runs += [(start, end)] if sums[start] else []
            start = end
    high = [run for run in runs if any(total >= surge for total in sums[run[0]: run[1]])]
    most = max((sum(weights[a:b]) for a, b in runs), default=0)
    return high or [run for run in runs if sum(weights[run[0]: run[1]]) == most][-1:]


@given(st.lists(st.sampled_from([0, 0, 0, 1, 5, 40, 90]), max_size=30), st.integers(1, 4), st.sampled_from([1, 60, 86]))
@settings(max_examples=500, deadline=None)
def test_passages_against_their_definition(weights, window, surge):
    assert pages.passages(weights, window, surge) == _passages(weights, window, surge)


@given(st.lists(st.sampled_from([0, 0, 0, 0, 4, 30, 50, 90]), max_size=24))
@settings(max_examples=500, deadline=None)
def test_lines_between_surge_and_dive_are_the_text(sizes):
    text = [f"{'x' * (size - 1)}." if size else f"<a>{i}</a>" for i, size in enumerate(sizes)]
    expected = []
    for start, end in _passages(sizes, pages.WINDOW, pages.SURGE):
        last = max(i for i in range(start, end) if sizes[i])
        expected += [text[i].removeprefix("<a>").removesuffix("</a>") for i in range(start, last + 1)]
    assert pages.main_text("".join(f"<div>{t}</div>" for t in text)) == "\n\n".join(expected)


words = st.integers(30, 60).flatmap(lambda n: st.integers(0, 999).map(lambda k: " ".join(f"t{k}n{j}" for j in range(n))))
chrome = st.sampled_from([
    "<form action=x><p>Join us and get our letter each week</p><label>Mail <input type=email></label><button>Go</button></form>",
    "<div class='comments-area'><h3>2 comments</h3><div class='user-comment'><p>" + "I do not agree at all. " * 20 + "</p></div></div>",
    "<nav><a href=x>Menu</a></nav>", "<div class='ad-slot'>Buy this</div>", "<aside><p>" + "By the way. " * 20 + "</p></aside>",
    "<script>var p = '<p>no</p>'</script>", "<div id=cookie-banner>" + "We use cookies here. " * 9 + "</div>",
])


@given(st.lists(words, min_size=1, max_size=6), st.lists(chrome, min_size=7, max_size=7), st.sampled_from(["div", "article", "form", "main", "section"]))
@settings(max_examples=300, deadline=None)
def test_pages_of_texts_and_chrome_give_their_texts(texts_, between, around):
    inner = "".join(f"{part}<p>{text}</p>" for part, text in zip(between, [*texts_, ""]) if text)
    if around == "form":
        inner = inner.replace("<form", "<div class=newsletter><span").replace("</form>", "</span></div>")
        inner = f"<input type=hidden><nav>Top</nav>{inner}"
    page = f"<html><body>{between[-1]}<{around} id=it>{inner}</{around}>{between[-1]}</body></html>"
    assert pages.main_text(page).split("\n\n") == texts_


def test_deep_and_broken_markup_takes_no_time():
    pages.main_text("<form>" * 100_000 + "<div class=widget>" * 50_000 + "x")
    pages.main_text("<b><div>" * 50_000 + "x")
    pages.main_text("</p>" * 100_000 + "<p>" * 100_000)
    pages.main_text("<" * 100_000 + "<a href='" * 1000)


def test_pages_of_edge_cases(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "u", "", 2), (3, "u", f"<article>{BODY * 2000}</article>", 3)]
    given_ = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = pages.extract(given_).collect()
    assert [r.n_chars for r in found] == [0, 0, 0, (len(LONG) + 2) * 2000 - 2]
    assert pages.extract(given_.limit(0)).collect() == [] and found[0].text == ""


def test_every_page_of_the_table_has_its_article(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in pages.extract(table).join(table.select("page_id", "html"), "page_id").collect():
        assert row.text and row.n_chars == len(row.text)
        assert not any(mark in row.text for mark in ("<p>", "track(", "margin:0", "©"))
