"""Token counts through a digest cache.

Contents are keyed by (SHA-256 of the normalised text, SHA-256 of the
tokenizer file). Stored counts are joined first; only distinct misses are
encoded, and their counts are appended to the cache table.

Normalisation turns null into the empty text and nothing else: any other
change could alter the count. Equal texts are therefore encoded once.
Defined cases: null text counts as empty (0 tokens); repeated rows each get
their row; an empty table gives an empty result; columns other than the id and
the text are ignored; a null id is kept.
"""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.token_cache import byte_counts, in_blocks
from panelcast.session import ensure_checkpoint_dir

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: another file never meets old counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark, cache_path: str) -> DataFrame:
    """The stored counts; none if the folder is new."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    The texts are shuffled once, by digest, after equal texts of a task have
    been combined; the counts come back in a join of digests, whose hot keys
    AQE splits. A concurrent or repeated append may store a digest twice, so
    the cache is read through a grouped minimum.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                        text.alias("text"))

    def stored():
        return (read_cache(spark, cache_path).where(F.col("tokenizer") == version)
                .groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")))

    misses = (keyed.select("digest", "text").join(stored().select("digest"), "digest", "left_anti")
              .dropDuplicates(["digest"]))

    def encode(frames):
        for pdf in frames:
            texts = pdf["text"].tolist()
            counts = []
            for s in in_blocks(texts):
                counts += byte_counts(texts[s], tokenizer_path)
            yield pd.DataFrame({"digest": pdf["digest"], "tokenizer": version, "n_tokens": counts})

    misses.mapInPandas(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    out = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                      F.octet_length(text).cast("long").alias("n_bytes"))
    return (out.join(stored(), "digest", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def fresh_cache(spark) -> str:
    """A new, empty cache folder in the shared checkpoint folder, removed with the driver."""
    path = f"{ensure_checkpoint_dir(spark)}/llm-token-cache-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
        spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
