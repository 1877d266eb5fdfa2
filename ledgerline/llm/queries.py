"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.expected import EXPECTED
from ledgerline.llm.licenses import scan_licenses
from ledgerline.llm.mixing import mix_sources
from ledgerline.llm.ngram_join import near_duplicates
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.periodic_runs import collapse_runs, repeated_from
from ledgerline.llm.quality_model import score_documents, train
from ledgerline.llm.quality_rules import judged
from ledgerline.llm.sharding import shard_documents
from ledgerline.llm.suffix_dedup import remove_repeats
from ledgerline.llm.token_alignment import align_tokenizers
from ledgerline.llm.topk import top_k
from ledgerline.llm.url_filter import filter_urls, pages_of_listed_hosts
from ledgerline.llm.vocabulary import vocabulary_path
from ledgerline.llm.warc import archived


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mix_sources(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op2_shard_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_documents(_table(spark, sf_dir, "documents"), 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), 50, with_text=False)
    return rows.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_pack_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary_path())


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), 4, 85)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), 10, 100, 1024)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op8_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return score_documents(documents, train(documents, _table(spark, sf_dir, "labels")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(_table(spark, sf_dir, "documents"), F.struct("doc_id"))
    return rows.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return filter_urls(pages, pages_of_listed_hosts(pages))


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


def op12_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_runs(_table(spark, sf_dir, "documents"), repeated_from)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_mix_sources,
        op2_shard_karmarkar_karp,
        op3_suffix_dedup,
        op4_pack_minimum_bin_slack,
        op5_ngram_jaccard,
        op6_exact_top_k,
        op7_license_scan,
        op8_quality_nbsvm,
        op9_quality_rules,
        op10_url_filter,
        op11_align_tokenizers,
        op12_warc_index,
        op13_periodic_runs,
    )
}

__all__ = ["EXPECTED", "QUERIES"]
