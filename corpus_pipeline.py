"""The corpus pipeline: quality rules, line dedup, near-duplicates, benchmark
decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and gets what the stage before kept;
all but the last return the columns of ``documents`` (and any further columns
``docs`` came with). Rows are never dropped for their size or place: a stage
drops what its operator rejects, and nothing else.

Defined results: NULL texts fail the quality rules; of repeated rows of a
near-duplicate group one stays; an empty table passes through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import bpe_words, decontaminate, line_dedup, quality_divergence, simhash
from tidemart.llm.bpe import default_tokenizer_path
from tidemart.llm.common import row_key, write_and_reread
from tidemart.session import remove, work_path, work_scope


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 7)."""
    return quality_divergence.quality_verdicts(docs).filter("kept").select("row.*").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go (operator 2); ``n_chars`` follows the text."""
    done = line_dedup.line_dedup(docs)
    there = F.col("row.text").isNotNull()
    changed = {"text": F.when(there, F.col("kept_text")),
               "n_chars": F.when(there, F.length("kept_text").cast("bigint"))}
    return done.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group stays (operator 10)."""
    return simhash.keep_one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go (operator 5)."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select("doc_id", "text", *row_key(F.col("doc_id"), F.col("text")))
    hits = decontaminate.contaminated_passages(keyed, items, keep=["k1", "k2"])
    bad = write_and_reread(hits.select("k1", "k2").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), *row_key(F.col("doc_id"), F.col("text")))
    return rows.join(bad, ["k1", "k2"], "left_anti").select("row.*").select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (operator 3): doc_id, lang, source, n_tokens,
    ids (little-endian unsigned 32-bit) and the digest of the decoded text."""
    path = default_tokenizer_path()
    back = bpe_words.encode(docs, path, keep=["doc_id", "lang", "source"],
                            piece_rows=bpe_words.piece_table(spark, path))
    return back.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage),
          ("near duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
          ("tokens", token_stage)]

#: SQL can express neither the near-duplicate stage's hash nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and reread.
    What a stage wrote on its way, and its input, go once its output is there."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        path = work_path(spark, "pipeline", f"{k}-{uuid.uuid4().hex}")
        with work_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            remove(spark, last)
        last = path
    return docs
