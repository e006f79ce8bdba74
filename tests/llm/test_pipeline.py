"""The stages against plain Python, each on its own input, and the whole run."""

from cases import SF, documents, edge, empty, labels, learnable  # noqa: F401
import corpus_pipeline
import plain
import pytest
from test_texts import _against_all
from test_tokens import _check

from edgeflow.llm import languages, packing, quality
from edgeflow.plans import keep

@pytest.fixture(scope="module")
def tables(spark, documents):
    found = [documents]
    for name, stage in corpus_pipeline.STAGES:
        found.append(keep(stage(spark, found[-1], SF), f"test-{name}".replace(" ", "-")))
    return found


def _texts(table):
    return {r.doc_id: r.text for r in table.collect()}


def test_the_order_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "language ID", "line dedup", "SimHash near-dedup", "packing"
    ]


def test_all_but_the_last_return_the_columns_of_documents(tables):
    assert all(t.schema == tables[0].schema for t in tables[:-1])


def test_quality_stage(tables, labels):
    scored = quality.classify(tables[0], labels, learnable()).collect()
    assert _texts(tables[1]) == {r.doc_id: r.text for r in scored if r.score >= 0.7}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & _texts(tables[1]).keys()) >= 0.97 * len(good)


def test_language_stage(tables):
    labelled = languages.identify(tables[1], learnable()).collect()
    kept = {r.doc_id: r.text for r in labelled if r.lang_pred != "und" and r.score >= corpus_pipeline.SURE}
    assert _texts(tables[2]) == kept and len(kept) >= 0.97 * len(labelled)


def test_line_stage(tables):
    before = _texts(tables[2])
    expected = _against_all(before.items())
    assert _texts(tables[3]) == {i: t for i, t in expected.items() if t == before[i] or plain.words(t)}
    assert all(r.n_chars == len(r.text) for r in tables[3].collect())


def test_near_stage(tables):
    texts = sorted(_texts(tables[3]).items())
    group = plain.groups([plain.fingerprint(t) for _, t in texts], plain.near)
    assert _texts(tables[4]) == {texts[g][0]: texts[g][1] for g in set(group)}


def test_packing_stage(tables):
    assert tables[5].columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = packing.pack(tables[4], corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY))
    _check(pieces.collect(), _texts(tables[4]).items())
    key = ["sequence_id", "offset", "doc_id", "ids_crc32"]
    assert sorted(map(tuple, tables[5].select(key).collect())) == sorted(map(tuple, packing.with_checksum(pieces).select(key).collect()))


def test_run(spark, tables):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, tables[5].collect()))


@pytest.mark.parametrize("number", range(5))
def test_stages_take_edge_cases_and_empty_tables(spark, edge, empty, number):
    stage = corpus_pipeline.STAGES[number][1]
    for given in (edge, empty):
        found = stage(spark, given, SF)
        assert number == 4 or found.columns == given.columns
        assert found.count() == 0 if given is empty else True
