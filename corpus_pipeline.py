"""Corpus pipeline over documents: language, lines, near duplicates, benchmark passages, tokens.

Each stage takes the rows the one before it kept, as they were written, and all but the last return the
columns of documents. Rows without text or letters go with the first stage. A document whose lines
are all found in earlier documents goes with the second.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import bpe, decontaminate, jaccard, language_id, line_templates
from roadlens.llm.common import packed, small_batches, stored, table
from roadlens.llm.queries import VOCABULARY


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language is undetermined; a missing ``lang`` is filled in.

    If no row names a language, none can be learned and all documents with a letter stay.
    """
    small_batches(spark)
    model = language_id.train(docs)
    alone, rest = packed(docs, "text", "lang")
    found = language_id.predict(alone, model)
    kept = found.filter(F.col("lang_pred") != "und" if model[0] else language_id.has_letter(F.col("text")))
    named = F.coalesce("lang", F.when(F.col("lang_pred") != "und", F.col("lang_pred")))
    return kept.select(*[named.alias("lang") if c == "lang" else rest[c] for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines of any length go, and documents of which nothing is left; ``n_chars`` follows the text."""
    alone, rest = packed(docs, "doc_id", "text", "n_chars")
    found = line_templates.drop_recurring(alone).filter("n_dropped = 0 OR trim(text) != ''")
    n = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.select(*[n.alias("n_chars") if c == "n_chars" else rest[c] for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    small_batches(spark)
    return jaccard.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids as little-endian 32-bit numbers, and the hash of the bytes they decode to."""
    small_batches(spark)
    decoded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), decoded=True)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language), ("line_dedup", lines), ("ngram_jaccard", near_duplicates),
          ("decontamination", benchmark), ("byte_bpe", tokens)]

#: Neither the language model nor the tokenizer can be written in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
