"""The classifiers: gradients, held-out accuracy, fixed results, edge cases."""

from cases import EDGE, documents, edge, empty, labels, learnable  # noqa: F401
import numpy as np
import pytest
from pyspark.sql import functions as F

from edgeflow.llm import languages, quality

@pytest.fixture(scope="module")
def network(documents):
    names, windows, weights, numbers = languages.sample(documents, learnable())
    return languages.learn(windows, weights, numbers, names)


def test_gradients_by_differences():
    random = np.random.default_rng(5)
    network = languages.Network(["a", "b", "c"], 7)
    windows = random.integers(0, 256, (4, 20)).astype(np.uint8)
    weights, labels = random.integers(0, 2, (4, 20)).astype(np.float32), np.array([0, 1, 2, 1])

    def loss():
        p, _ = network.read(windows)
        return -(np.log(p[:, np.arange(4), labels]) * weights.T).sum() / weights.sum()

    for parameter, gradient in zip(network.parameters(), network.gradients(windows, weights, labels)):
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = parameter[place], np.float32(1e-2)
        parameter[place] = kept + step
        above = loss()
        parameter[place] = kept - step
        below = loss()
        parameter[place] = kept
        assert (above - below) / (2 * step) == pytest.approx(gradient[place], rel=0.03, abs=1e-4)


def test_every_position_counts_once(network):
    """Texts pooled together or alone, in windows of any helping, give the same."""
    texts = [b"", b"the and of", "straße der größe ".encode() * 40, b"x" * 1000, b" . "]
    together = languages.pooled(network, texts)
    for text, row in zip(texts, together):
        assert np.allclose(languages.pooled(network, [text])[0], row, atol=1e-5)
    assert not together[0].any() and not together[4].any()


def test_languages_of_held_out_documents(documents, network):
    found = languages.label(documents, network).where(~learnable()).collect()
    right = [r.lang_pred == r.lang for r in found]
    assert np.mean(right) >= 0.95 and all(0 <= r.score <= 1 for r in found)


def test_a_clashing_name_is_lengthened_and_another_name_is_fine(edge, empty, network):
    assert languages.label(edge, network).columns == [*edge.columns, "lang_pred", "score_1"]
    names = ("language_", "sure_")
    found = languages.label(edge, network, names=names)
    assert found.columns == [*edge.columns, *names] and found.count() == len(EDGE)
    for row in found.collect():
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.language_ != "und") == letters and (row.sure_ > 0) == letters
    assert languages.label(empty, network, names=names).collect() == []
    # nothing to learn from: nothing is known
    unknown = languages.identify(empty, F.lit(True), names=names)
    assert unknown.collect() == []
    assert {r.language_ for r in languages.identify(edge, F.lit(False), names=names).collect()} == {"und"}


def test_the_sample_is_bounded_and_ignores_held_out_rows(documents):
    names, windows, weights, numbers = languages.sample(documents, learnable(), per_language=5)
    assert (np.bincount(numbers) <= 5 * languages.PER_DOCUMENT).all()
    changed = documents.withColumn("text", F.when(learnable(), F.col("text")).otherwise("changed"))
    again = languages.sample(changed, learnable(), per_language=5)
    assert again[0] == names and (again[1] == windows).all() and (again[3] == numbers).all()


def test_quality_of_held_out_documents(documents, labels):
    scored = quality.classify(documents, labels, learnable()).where(~learnable())
    rows = scored.join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert np.mean([(r.score >= 0.7) == r.quality for r in rows]) >= 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_scores_do_not_depend_on_stretches(monkeypatch):
    texts = [b"one two two three. Four!! | | five 6.0 " * n for n in range(1, 12)] + [b"", b"one"]
    weights = np.random.default_rng(1).normal(size=quality.CONSTANT + 1)
    weights[quality.NONE] = 0
    whole = quality.logits(texts, weights, quality._Words())
    for stretch in (3, 7, 50):
        monkeypatch.setattr(quality, "STRETCH", stretch)
        assert np.allclose(quality.logits(texts, weights, quality._Words()), whole)
    for text, logit in zip(texts, whole):
        where, values = quality.vector(text, quality._Words())
        assert weights[quality.CONSTANT] + weights[where] @ values == pytest.approx(logit)


def test_shapes():
    assert [quality.shape(w) for w in ("Theater,", "THE!!", "4.0", "größe", "")] == ["Aa,", "A!", "0.0", "a", ""]


def test_quality_of_edge_cases(spark, edge, empty, labels):
    assert quality.classify(edge, labels).columns == [*edge.columns, "score_1"]
    found = quality.classify(edge, labels, name="score_")
    assert found.columns == [*edge.columns, "score_"] and found.count() == len(EDGE)
    assert quality.classify(empty, labels, name="score_").collect() == []
    odd = spark.createDataFrame([(5, None), (5, 1), (6, 0), (6, 1), (None, 1), (7, 3)], "doc_id bigint, quality int")
    learned = quality.sample(edge, odd.withColumnRenamed("quality", "label"), F.lit(True))
    assert sorted(label for *_, label in learned) == [0, 0, 1]
    none = quality.classify(edge, odd.limit(0), name="score_").collect()
    assert {r.score_ for r in none} == {0.5}


def test_the_learned_sample_is_bounded_and_in_a_fixed_order(documents, labels):
    given = labels.select("doc_id", F.col("quality").alias("label"))
    a = quality.sample(documents, given, learnable(), max_rows=20)
    b = quality.sample(documents.repartition(7), given.repartition(3), learnable(), max_rows=20)
    assert len(a) <= 20 and all((x[0] == y[0]).all() and x[2] == y[2] for x, y in zip(a, b))


def test_every_language_is_learned(spark):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = [
        (k * 10 + i, f"{alphabet[k % 26]}{alphabet[k // 26]} " * 20, f"l{k:02d}") for k in range(70) for i in range(2)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    names, windows, weights, numbers = languages.sample(docs, F.lit(True))
    assert names == [f"l{k:02d}" for k in range(70)] and set(numbers.tolist()) == set(range(70))


def test_repeated_ids_do_not_pass_the_bound_on_rows(spark):
    rows = [(i % 4, f"text number {i} of many words") for i in range(300)] + [(0, "text number 0 of many words")] * 200
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    given = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id bigint, label int")
    assert len(quality.sample(docs, given, F.lit(True), max_rows=20)) == 20
    assert len(quality.sample(docs, given, F.lit(True), max_rows=1)) == 1
    assert len(quality.sample(docs, given, F.lit(True), max_rows=1_000)) == 500


def test_names_that_clash_are_lengthened(spark):
    docs = spark.createDataFrame([(1, "some words", 2, "x")], "doc_id bigint, text string, Score int, LANG_PRED string")
    scored = quality.score(docs, np.zeros(quality.CONSTANT + 1))
    assert scored.columns == [*docs.columns, "score_1"] and scored.first().score_1 == 0.5
    found = languages.label(docs, languages.Network([]))
    assert found.columns == [*docs.columns, "lang_pred_1", "score_1"] and found.first().lang_pred_1 == "und"
