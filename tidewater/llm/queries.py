"""The queries of this subpackage: each applies its operator with production parameters to the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, conversations, crf, deleted_interpolation, divergence, domtrees, linechunks, mixing, qgrams, setsketch, sharding, urlrules, whitening
from tidewater.llm.common import table
from tidewater.llm.oracles import ORACLE_SQL as ORACLE_SQL


def op1_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judged(table(spark, sf_dir, "documents"))


def op2_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op3_golden_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op6_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op4_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_interpolation.scored(table(spark, sf_dir, "documents"))


def op5_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.tagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_qgrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgrams.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.cleaned(table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judged(table(spark, sf_dir, "pages"))


def op9_dom_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domtrees.extracted(table(spark, sf_dir, "pages"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    found = bpe.encoded(table(spark, sf_dir, "documents"), ranks, decode=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    return conversations.audited(conversations.edited(conversations.damaged(talks)), talks)


def op13_svd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_divergence, op2_label_propagation, op3_golden_mix, op6_setsketch, op4_deleted_interpolation, op5_crf, op10_qgrams, op7_line_chunks, op8_url_rules, op9_dom_trees, op11_bpe, op12_conversation_repair, op13_svd_whitening)}
