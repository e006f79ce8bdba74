"""Stages that turn the documents table into packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and all but the
last return the columns they were given.
"""

import public_tokenizers
from pyspark.sql import functions as F

from edgeflow.llm import languages, lines, packing, quality, simhash
from edgeflow.llm.common import fold, table, unused
from edgeflow.plans import keep

#: Rows of this fold teach the classifiers nothing.
HELD_OUT = 2
#: Least score of a document of good quality, and least probability of its language.
GOOD, SURE = 0.7, 0.35
VOCABULARY = "byte_bpe_50k.json"


def quality_classifier(spark, docs, sf_dir):
    """Rejects documents whose score is below GOOD."""
    score = unused(docs, "_score")
    learnable = fold(F.col("doc_id")) != HELD_OUT
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), learnable, name=score)
    return scored.where(F.col(score) >= GOOD).drop(score)


def language_id(spark, docs, sf_dir):
    """Rejects documents without letters, and those whose most likely language is less likely than SURE."""
    names = unused(docs, "_language"), unused(docs, "_sure")
    found = languages.identify(docs, fold(F.col("doc_id")) != HELD_OUT, names=names)
    return found.where((F.col(names[0]) != languages.UNKNOWN) & (F.col(names[1]) >= SURE)).drop(*names)


def line_dedup(spark, docs, sf_dir):
    """Deletes blocks of lines that an earlier document has; documents that lose all their words so go."""
    deleted = unused(docs, "_deleted")
    shorter = lines.dedup(docs, counts=deleted)
    left = shorter.where((F.col(deleted) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop(deleted)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark, docs, sf_dir):
    """Keeps one document of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def pack(spark, docs, sf_dir):
    """Pieces of the packed sequences."""
    return packing.with_checksum(packing.pack(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("packing", pack),
]

#: No stage can be told in SQL; the tests compare each with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}".replace(" ", "-"))
    return docs
