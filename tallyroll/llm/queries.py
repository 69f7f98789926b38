"""The queries over this package's operators, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import annulus, bpe, cotrain, decontaminate, filteraudit, licences, linededup, mixing, ordermin, pii, sharding, topk, warc
from .common import table


def op1_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.QUERY_EVERY == 0)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(sharding.write_shards(table(spark, sf_dir, "documents")))


def op3_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1)


def op5_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op6_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op8_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"))).drop("url")


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.classes(table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_splitting_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op13_annulus_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annulus.clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_threshold_top_k, op2_external_shuffle, op3_cotraining_quality, op4_spaced_seeds, op5_semi_markov_pii, op6_trie_bpe, op7_line_dedup, op8_dictionary_warc, op9_order_minhash, op10_licence_scan, op11_filter_audit, op12_splitting_tree_mix, op13_annulus_clusters)}

ORACLES: dict[str, str] = {"op1_threshold_top_k": topk.ORACLE, "op4_spaced_seeds": decontaminate.ORACLE, "op7_line_dedup": linededup.ORACLE, "op8_dictionary_warc": warc.ORACLE, "op11_filter_audit": filteraudit.ORACLE, "op13_annulus_clusters": annulus.ORACLE}
