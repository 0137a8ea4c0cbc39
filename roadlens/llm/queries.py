"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import ann_tree, bpe, conversations, decontaminate, hard_negatives, html_crf, jaccard, language_id, line_templates, lm_trie, oracle, shards, token_scan, toxicity
from roadlens.llm.common import fold, table
from roadlens.session import scratch_path

VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 50256  # free in that vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


@_query("op4_winnowing", oracle.WINNOWING)
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@_query("op10_line_templates", oracle.LINE_TEMPLATES)
def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_recurring(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query("op6_naive_bayes")
def op6_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    model = language_id.train(docs.filter("NOT held_out"))
    return language_id.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@_query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), decoded=True)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op9_set_relations", oracle.SET_RELATIONS)
def op9_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"))


@_query("op3_kmeans_tree")
def op3_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op5_separator_scan")
def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.document_tokens(
        table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
        public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, END_ID)


@_query("op7_label_propagation")
def op7_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"))


@_query("op2_kneser_ney")
def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = fold(F.col("doc_id"), 1 << 32)
    learned = table(spark, sf_dir, "labels").filter(crc % 5 != 0)
    labelled = toxicity.with_labels(docs, learned).withColumn("part", F.floor(crc / 5) % 4)
    model, curve = toxicity.train(labelled)
    scored = toxicity.score(docs, model, curve).withColumn("held_out", crc % 5 == 0)
    return scored.select("doc_id", "held_out", "score", "predicted", "ordinary_ll", "toxic_ll")


@_query("op1_dom_crf")
def op1_dom_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.train(pages)).select("page_id", "url", "text", "n_chars")


@_query("op12_run_length")
def op12_run_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audits(conversations.damage(table(spark, sf_dir, "conversations")))


@_query("op11_hyperplane_tree", oracle.HARD_NEGATIVES)
def op11_hyperplane_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


@_query("op13_elias_fano")
def op13_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = fold(F.col("doc_id"), 5)
    scored = lm_trie.score(table(spark, sf_dir, "documents"), remainder != 1)
    return scored.select("doc_id", (remainder == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
