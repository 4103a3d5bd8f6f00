"""The corpus pipeline: documents of a known language, once each, none nearly like another, mixed by source, packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import exact_dedup, jaccard_join, language_id, packing, source_mix
from twinledger.llm.common import cut, join_heavy, lower_ascii, shared_dir
from twinledger.llm.queries import MIX_WEIGHTS, mix_levels, tokenizer_file

NEAR_WORDS, NEAR_PERCENT = 5, 80
MIX_PERCENT = 80


def row_key(*parts: Column) -> Column:
    """A 64-bit hash that tells null from empty: by it decisions meet rows, as an id may be null or repeat."""
    return F.xxhash64(*[x for c in parts for x in (c, c.isNull())])


def with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", row_key(F.col("doc_id"), F.col("text")))


def one_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose `_key` is in kept (_key, n: how many rows of docs have it), one of each `_key`.

    Of several rows the largest by its columns stays; only these are grouped, and not at all if there are none.
    """
    names = [c for c in docs.columns if c != "_key"]
    out = docs.join(kept.where("n = 1"), "_key", "left_semi").select(*names)
    several = kept.where("n > 1")
    if several.isEmpty():
        return out
    rows = join_heavy(docs, several, ["_key"], "n", docs.count())
    return out.unionByName(rows.groupBy("_key").agg(F.max(F.struct(*names)).alias("r")).select("r.*"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can be told; those without a letter or without anything in common with a language go.

    Each row is judged by its own text, whether its id is null or repeats; repeated rows stay or go together.
    """
    profiles = language_id.learn(docs)
    keyed = with_key(docs)
    found = language_id.identify(keyed, profiles, id_col="_key").where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") > 0))
    return keyed.join(found.select("_key").distinct(), "_key", "left_semi").drop("_key")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, one with the largest doc_id; a null id stays only where no equal text has another.

    One id with several texts keeps each that is not an equal text of a larger id.
    """
    kept = exact_dedup.exact_duplicates(docs).where("kept").select(row_key(F.col("doc_id"), F.col("text_sha256")).alias("_key"))
    digest = F.sha2(F.coalesce(lower_ascii(F.col("text")), F.lit("")), 256)
    return one_each(docs.withColumn("_key", row_key(F.col("doc_id"), digest)), cut(kept.groupBy("_key").agg(F.count("*").alias("n"))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that share 0.8 or more of their five-word shingles, directly or through others, one with the smallest doc_id.

    A null id stays only where none of them has another; of several texts with the smallest id, the one of least
    hash stays.  Rows without shingles stay, repeated ones once.
    """
    keyed = with_key(docs)
    found = jaccard_join.jaccard_components(keyed, NEAR_WORDS, NEAR_PERCENT, id_col="_key").groupBy("_key").agg(F.max("component_id").alias("component"), F.count("*").alias("n"))
    ids = keyed.select("_key", "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key", "n")
    best = cut(found.join(ids, "_key").groupBy("component").agg(F.min(order).alias("best")).select("best._key", "best.n"))
    return one_each(keyed, best)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the budgets of their source take; the one in which a budget ends stays whole.

    Rows stand in the order of their hashes of id and text, so each of one id, or of none, is taken by itself;
    repeated rows count once.
    """
    keyed = with_key(docs)
    counts = cut(keyed.groupBy("_key").agg(F.count("*").alias("n")))
    if not counts.where("n > 1").isEmpty():
        keyed = with_key(one_each(keyed, counts))
    taken = source_mix.mix(keyed, mix_levels(), MIX_WEIGHTS, MIX_PERCENT, max_epochs=1, seed=7, id_col="_key")
    return keyed.join(taken.select("_key").distinct(), "_key", "left_semi").drop("_key")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(packing.pieces_of(docs, tokenizer_file(), 1024, 2))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
