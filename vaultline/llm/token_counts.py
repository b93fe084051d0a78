"""Token counts with a digest cache.

A count is stored under the digest of the content and the digest of the
tokenizer's file. A run joins its contents' digests with the cache, encodes
one copy of each missing content, appends the counts, and joins again.

Contents are normalised only in that null means empty: any other change could
change the count. Scale: digests are narrow; texts move once, when copies and
known contents have been left out by id; a hot content is one row by then.

Defined results: a null or empty text has 0 bytes and its library's count of
the empty text; repeated rows, also with null ids, are counted each; an empty
table gives an empty result and leaves the cache as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import tokenizing
from vaultline.llm.common import materialize, text_or_empty

MODEL, LIMIT = "piece_bpe_32k.model", 4096
CACHE_SCHEMA = "content string, n_tokens long, tokenizer string"


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) known for a tokenizer version; an absent cache is
    empty. A content appended twice counts once."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], CACHE_SCHEMA).select("content", "n_tokens")
    return (spark.read.schema(CACHE_SCHEMA).parquet(path).filter(F.col("tokenizer") == tokenizer)
            .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(docs: DataFrame, cache_path: str, model: str = MODEL, limit: int = LIMIT,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, content) of every row."""
    spark = docs.sparkSession
    tokenizer = tokenizing.version(model)
    body = text_or_empty(text)
    rows = materialize(docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"),
                                   F.sha2(body, 256).alias("content")), "token-digests")
    # One row's id stands for each unknown content; a null id stands for itself.
    wanted = (rows.groupBy("content").agg(F.min("doc_id").alias("_id"))
              .join(read_cache(spark, cache_path, tokenizer), "content", "left_anti"))
    wanted = materialize(wanted.withColumnRenamed("content", "_content"), "token-misses")
    texts = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"))
    misses = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["_id"])).filter(F.sha2("body", 256) == F.col("_content"))
    misses = misses.select(F.col("_content").alias("content"), "body")

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        counter = tokenizing.load(tokenizing.PieceCounts, model)
        for b in batches:
            counts = [counter.count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    (misses.mapInArrow(encode, "content string, n_tokens long").withColumn("tokenizer", F.lit(tokenizer))
     .write.mode("append").parquet(cache_path))
    # Written, so that the join deals both sides itself and can split a hot content.
    known = materialize(read_cache(spark, cache_path, tokenizer), "token-known")
    return (rows.join(known, "content")
            .withColumn("over_limit", F.col("n_tokens") > limit)
            .select("doc_id", "n_bytes", "n_tokens", "over_limit", "content"))
