"""From documents to packed sequences: language ID, near copies, repeated passages, benchmark passages, packing.

Every stage takes any number of rows, none among them, and columns beyond those of
documents; rows are told apart by what they hold, so null and repeated ids are
rows like others.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from kinweave.llm import decontaminate, language, neardup, packing, substrings
from kinweave.llm.common import table, written


def by_language(spark, docs, sf_dir):
    """Documents whose language is recognised; rows whose text is null, empty or without letters go.

    Each row is judged by its own text, whatever its id; repeated rows alike. A
    column named like the prediction keeps its place.
    """
    out = ("__lang_pred", "__score")
    got = language.predict(docs, *language.fit(docs, public_tokenizers.path("piece_bpe_32k.model")), keep=docs.columns, out=out)
    return got.where(F.col(out[0]) != "und").drop(*out)


def one_of_each(spark, docs, sf_dir):
    """One document of each class of near copies: that of smallest id, null ids last, then of smallest text hash.

    A row that repeats with id and text stays once. Several texts of one id are
    judged each. Rows with null or empty text are alike to nothing and stay.
    """
    return neardup.one_of_each(docs)


def without_repeats(spark, docs, sf_dir):
    """Texts less the passages that start earlier; n_chars follows.

    Null or empty texts stay as they are. Documents of one id are ordered by text,
    null ids come last; rows equal in both are cut alike. No row goes, though a
    text may become empty.
    """
    return substrings.cleaned(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold no benchmark item, judged by their text, whatever their id; null or empty texts stay."""
    return decontaminate.without(docs, table(spark, sf_dir, "benchmark"))


def packed(spark, docs, sf_dir):
    """Pieces of sequences; a null or empty text is its closing id alone, repeated rows are packed each, null ids stay null."""
    return packing.pack_documents(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("language", by_language), ("neardup", one_of_each), ("substrings", without_repeats), ("decontaminate", without_benchmark), ("packing", packed)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
