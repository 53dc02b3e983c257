"""Cleaning pipeline over ``documents``: five stages, each written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame.  All but the last return the columns of their input (whatever they are):

1. quality: documents that fail the base rules or lie far from their language and
   source (operator 3) go.
2. near_dedup: of each group of near copies (operator 6) the document with the
   smallest id stays, and one row of a repeated id; rows without an id stay.
3. suffix_dedup: strings of 200 bytes that start twice (operator 8) are cut out of the
   texts; characters that a cut halves go too, and ``n_chars`` is counted anew.
4. decontaminate: documents that contain a benchmark item (operator 7) go.
5. bpe: texts are encoded to token ids and decoded again (operator 1).

Cases: nulls in any column, empty tables and repeated rows are handled by the
operators as their modules say; columns named like an operator's are carried through.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import bpe, decontaminate, neardup, quality, suffixdedup
from scholarmetrics.llm.common import checked_join, cut, load, scratch

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(spark) as s:
        of, estimates = quality.fit(cut(quality.add_stats(docs.select("lang", "source", "text")).drop("text")))
        model = s.keep(cut(of)), s.keep(cut(estimates))
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), "text", "lang", "source")
    return quality.judge(quality.add_stats(whole), model).where("kept").select("__doc.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(spark) as s:
        gone = s.keep(cut(neardup.group(docs).where("NOT kept").select("doc_id").distinct()))
    left = checked_join(docs, gone, "doc_id", "left_anti")
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    again = cut(again)
    if not again.limit(1).count():
        return left
    one = checked_join(left, again, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*docs.columns), F.struct("text", F.xxhash64(*docs.columns))).alias("__doc")
    )
    return checked_join(left, again, "doc_id", "left_anti").unionByName(one.select("__doc.*"))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    @arrow_udf("string")
    def characters(col: pa.Array) -> pa.Array:
        return pa.array([x.as_py().decode("utf-8", "ignore") if x.is_valid else None for x in col], pa.string())

    whole = docs.select(F.struct(*docs.columns).alias("__doc"), "doc_id", "text")
    done = suffixdedup.dedup(whole)
    changed = F.col("begins").isNotNull()
    text = F.when(changed, characters(F.when(changed, F.col("kept")))).otherwise(F.col("text"))
    done = done.select("__doc", text.alias("__text"), changed.alias("__changed"))
    new = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        counted = F.char_length("__text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("__changed"), counted).otherwise(F.col("__doc.n_chars"))
    return done.select(*[new.get(c, F.col("__doc")[c]).alias(c) for c in docs.columns])


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), "text")
    return decontaminate.find(whole, load(spark, sf_dir, "benchmark")).where(F.size("found") == 0).select("__doc.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), BPE_RANKS, BPE_PATTERN)
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("bpe", bpe_stage),
]

#: SQL cannot express the stages; tests/llm compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
