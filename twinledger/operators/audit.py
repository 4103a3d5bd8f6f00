"""Failure and usage accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from twinledger import constants as K


def failure_summary(log: DataFrame, top: int = 10, samples: int = 5, order: str = "ts") -> DataFrame:
    """(kind, rank, label, n): total, counts by scope, the top (source, step) pairs and the first samples.

    Ties in the counts are broken by label so that the report is repeatable.
    """
    total = log.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("total").alias("kind"), F.lit(1).alias("rank"), F.lit("").alias("label"), "n")
    by_scope = log.groupBy(F.coalesce("scope", F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    pair = F.concat(F.coalesce(F.col("source").cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.col("step").cast("string"), F.lit("")))
    by_pair = log.groupBy(pair.alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(top)
    first = log.orderBy(order, "event_id").limit(samples).select(
        F.concat(F.lit("#"), F.col("event_id").cast("string")).alias("label"), F.lit(1).cast("long").alias("n"), "event_id")

    def ranked(df: DataFrame, kind: str, w) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.row_number().over(w).alias("rank"), "label", "n")

    # each ranked input is a handful of rows: scopes, top pairs, samples
    down = W.orderBy(F.desc("n"), "label")
    return total.unionByName(ranked(by_scope, "scope", down)).unionByName(ranked(by_pair, "source_step", down)).unionByName(
        ranked(first, "sample", W.orderBy("event_id")))


def usage_by_phase(log: DataFrame) -> DataFrame:
    """Calls and tokens per (phase, model); a missing prompt count is cache hits plus misses; models without calls drop."""
    prompt = F.coalesce("prompt_tokens", F.coalesce("cache_hit", F.lit(0)) + F.coalesce("cache_miss", F.lit(0)))
    out = F.coalesce("completion_tokens", F.lit(0))
    counted = (prompt > 0) | (out > 0)
    g = log.groupBy("phase", "model").agg(
        F.count_if(counted).alias("calls"), F.sum(F.when(counted, prompt).otherwise(0)).cast("long").alias("input"),
        F.sum(F.when(counted, out).otherwise(0)).cast("long").alias("output"),
        F.sum("cache_hit").cast("long").alias("hit"), F.sum(F.col("cache_hit") + F.col("cache_miss")).cast("long").alias("looked"))
    rate = F.when(F.coalesce("looked", F.lit(0)) > 0, F.col("hit") / F.col("looked")).otherwise(0.0)
    return g.filter("calls > 0").select("phase", "model", "calls", "input", "output", rate.alias("hit_rate"))


def usage_totals(by_phase: DataFrame) -> DataFrame:
    """Totals per model over all phases."""
    return by_phase.groupBy("model").agg(*[F.sum(c).cast("long").alias(c) for c in ("calls", "input", "output")])


def snapshots(by_phase: DataFrame) -> DataFrame:
    """Cumulative usage per model after each phase (a run has a handful of phases)."""
    w = W.partitionBy("model").orderBy("phase").rowsBetween(W.unboundedPreceding, W.currentRow)
    return by_phase.select("model", "phase", *[F.sum(c).over(w).cast("long").alias(c) for c in ("calls", "input", "output")])


def error_class(error: Column) -> Column:
    """success, blocked, parse_error, schema_error or api_error."""
    low = F.lower(error)
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return (
        F.when(error.isNull() | (error == ""), "success").when(has(K.BLOCKED_MARKERS), "blocked")
        .when(has(["cannot parse json"]), "parse_error").when(has(K.SCHEMA_MARKERS), "schema_error").otherwise("api_error")
    )


def outcome_matrix(results: DataFrame, steps: list, order: str = "ts") -> DataFrame:
    """Per model: outcome counts over the last result of each step, and the status of every step."""
    last = results.groupBy("model", "step").agg(F.max_by("status", order).alias("status"))
    return last.groupBy("model").agg(
        F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") == "blocked").alias("blocked"),
        F.count_if(~F.col("status").isin("success", "blocked")).alias("other_failures"),
        *[F.max(F.when(F.col("step") == s, F.col("status"))).alias(f"step_{s}") for s in steps])
