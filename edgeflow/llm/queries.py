"""One query per operator over the given tables: name → function of (spark, sf_dir)."""

import public_tokenizers
from pyspark.sql import functions as F

from edgeflow.llm import (
    bpe, embeddings, languages, licences, lines, middle, packing, pages, quality, rules, search, simhash, whitening,
)
from edgeflow.llm.common import fold, table

#: Rows of this fold teach nothing; see `common.fold`.
HELD_OUT = 2
#: Scores from which a document is of good quality.
GOOD = 0.7

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash(spark, sf_dir):
    found = simhash.components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@query
def op2_licences(spark, sf_dir):
    """The files of a source lie in folders by language and thousand."""
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


@query
def op3_quality(spark, sf_dir):
    learnable = fold(F.col("doc_id")) != HELD_OUT
    scored = quality.classify(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), learnable
    )
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


@query
def op4_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.top_k(docs, docs.where("doc_id % 50 = 0"), k=10)


@query
def op5_languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = languages.identify(docs, fold(F.col("doc_id")) != HELD_OUT)
    return found.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score")


@query
def op6_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs, counts="lines_deleted")


@query
def op7_bpe(spark, sf_dir):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary))


@query
def op8_html(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op9_rules(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"))


@query
def op10_packing(spark, sf_dir):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.with_checksum(packing.pack(table(spark, sf_dir, "documents"), vocabulary))


@query
def op11_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), k=16, scale=64.0, shift=1_000_000)
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@query
def op12_embeddings(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op13_middle(spark, sf_dir):
    return middle.digests(middle.transform(table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50))
