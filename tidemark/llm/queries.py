"""The corpus operators as queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, byte_bpe, conversations, fim, lm, mixing, packing, quality_model, quality_rules, secrets, simhash, toxicity, url_rules
from .common import table
from .sql import ORACLES


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op2_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_association_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op6_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_gray_order_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op9_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op10_lexicon_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.trie(table(spark, sf_dir, "conversations"))


def op13_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    ids = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids")
    return byte_bpe.decode(ids, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


OPERATORS = (
    op1_pruned_graph_search,
    op2_tiered_packing,
    op3_weighted_fair_mix,
    op4_pairwise_quality,
    op5_association_url_rules,
    op6_ownership_secrets,
    op7_gray_order_simhash,
    op8_rule_cascade,
    op9_log_bilinear_scores,
    op10_lexicon_automata,
    op11_fill_in_middle,
    op12_conversation_trie,
    op13_byte_level_bpe,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
