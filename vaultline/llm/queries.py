"""The registered queries of the operators (and the pipeline), with SQL
where SQL can express them. Each query is thin: it runs the operator over the
whole table with production parameters and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import (
    centroids, decontamination, fim, packing, pii, quality_rules, sharding, simhash, suffix_index, token_counts, toxicity,
    url_rules, warc)
from vaultline.llm.common import table
from vaultline.llm.oracles import ORACLES  # noqa: F401  (read by the driver contract)
from vaultline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_template_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.find_leaks(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark")).drop("content")


@_query
def op2_risk_controlled_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    feats = quality_rules.measure(docs.select("doc_id", "lang", "text"), keep_text=False)
    judged = quality_rules.screen_measured(feats, table(spark, sf, "labels"))
    q = F.col("quality")
    return judged.select("doc_id", *[q[c].alias(c) for c in quality_rules.CONTRACT_COUNTS],
                         q["base_failed"].alias("base_failed"), "kept",
                         F.array_join("rejected_by", ",").alias("rejected_by"))


@_query
def op3_association_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return (url_rules.judge(pages, labels)
            .select("page_id", "host", "path", "rule", "verdict", "mined_rule"))


@_query
def op4_pii_spans(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", *pii.digest(found))


@_query
def op5_salvage_warc(spark: SparkSession, sf: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf, "pages"), scratch_path(spark, "warc"))
    found = warc.read_archives(manifest, with_payload=False).filter(F.col("status") == "record")
    return found.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("long").alias("refers_to"))


@_query
def op6_segment_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         F.size("passages").cast("long").alias("n_passages"))


@_query
def op7_bin_completion_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents").select("doc_id", "text"))


@_query
def op8_gray_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@_query
def op9_digest_cache_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """A cache of its own for each run: no count is carried over."""
    cache = scratch_path(spark, "token-cache")
    return token_counts.count_tokens(table(spark, sf, "documents"), cache).drop("content")


@_query
def op10_virtual_slot_shards(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf, "documents").select("doc_id", "text"), n_shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


@_query
def op11_logarithmic_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return suffix_index.remove_repeats(docs, scratch_path(spark, "suffix-family"), keep=False)


@_query
def op12_laesa_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.with_inertia(centroids.cluster(table(spark, sf, "embeddings").select("vec_id", "embedding")))


@_query
def op13_frame_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fim.fill_in_middle(table(spark, sf, "documents").select("doc_id", "text"), output=False)
