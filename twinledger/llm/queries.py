"""The registered queries of this package and their oracle SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import (exact_dedup, jaccard_join, language_id, license_scan, nn_descent, oracles, packing, periodic_runs, quality_bayes, sharding,
                            source_mix, spelling_variants, substring_dedup, token_counts)
from twinledger.llm.common import WORD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary file on this machine; TOKENIZERS_DIR names another folder of such files."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


#: Budget tree of the production mix: domains by source, then languages, then sources.
MIX_DOMAINS = {"web": ("src0", "src1", "src2", "src3", "src4"), "books": ("src5", "src6", "src7", "src8", "src9"), "forums": ("src10", "src11", "src12", "src13", "src14")}
MIX_WEIGHTS = {("web",): 4, ("books",): 3, ("forums",): 2, ("reference",): 1, (None, "en"): 4, (None, "de"): 2, (None, "fr"): 2, (None, "es"): 2, (None, None, "src0"): 2}
MIX_PERCENT = 60


def mix_levels() -> dict:
    domain = F.lit("reference")
    for name, sources in MIX_DOMAINS.items():
        domain = F.when(F.col("source").isin(*sources), name).otherwise(domain)
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


@query
def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = language_id.held_out(F.col("doc_id"))
    profiles = language_id.learn(docs.where(~fold))
    out = language_id.identify(docs, profiles)
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op3_substring_dedup(spark, sf_dir):
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op4_source_mix(spark, sf_dir):
    return source_mix.mix(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_PERCENT, max_epochs=2, seed=7)


@query
def op5_best_fit_packing(spark, sf_dir):
    return packing.pack(packing.pieces_of(table(spark, sf_dir, "documents"), tokenizer_file(), 1024, 2))


@query
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_license_scan(spark, sf_dir):
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    return out.withColumn("notices", F.array_join("notices", ","))


@query
def op8_nn_descent(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nn_descent.nearest(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op9_quality_classifier(spark, sf_dir):
    out = quality_bayes.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *[F.round(c, 6).alias(c) for c in ("evidence", "host_posterior", "path_posterior", "quality")], "keep")


@query
def op10_ngram_jaccard(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op11_external_shuffle(spark, sf_dir):
    out = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text; in a tenth of the documents, by a hash of the id, the words from some place on repeat with a period."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    docs = docs.withColumn("w", F.when(F.expr("h % 10 = 0"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).withColumn("n", F.size("w"))
    docs = docs.withColumn("a", F.expr("if(n > 0, cast((h div 10) % n as int), 0)"))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    changed = F.expr("array_join(concat(slice(w, 1, a), transform(sequence(a, n - 1), i -> w[cast(a + (i - a) % p as int)])), ' ')")
    return docs.select("doc_id", F.when(F.expr("n > 0"), changed).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, sf_dir):
    out = periodic_runs.periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    best = out.withColumn("best", F.expr(periodic_runs.strongest()))
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(F.expr(listed), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"), typo=97)


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


#: Token counts and packing rest on a tokenizer's vocabulary and shuffling on the session's random numbers, so op1, op5, op11 and the pipeline have none.
ORACLES = oracles.build(MIX_DOMAINS, MIX_WEIGHTS, MIX_PERCENT)
