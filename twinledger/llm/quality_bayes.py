"""Quality by hierarchical empirical Bayes.

A naive Bayes classifier over binned surface features gives each document its evidence.  Sites are then judged from
all their documents: a host's mean evidence is shrunk toward the mean of all hosts and a path's toward its host's, the
more so the fewer documents it has; how much follows from how much sites differ (moments).  A document's quality is its
own evidence, shifted by what its path says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import WORD, cut, join_heavy

FEATURES = ("length", "punct", "upper", "digit", "repeat", "word")
BINS = 12
NONE = "(none)"


def features(text: Column) -> list[Column]:
    """One bin, 0 to BINS - 1, for each feature: size, shares of punctuation, capitals and digits, distinct words, word length."""
    words, chars = F.regexp_count(text, F.lit(WORD)), F.length(text)
    share = lambda n, of, step: F.when(of > 0, F.least(F.floor(n * 100 / of / step), F.lit(BINS - 1))).otherwise(0).cast("int")
    distinct = F.size(F.array_distinct(F.split(text, " ")))
    return [
        F.least(F.length(F.bin(words)), F.lit(BINS - 1)).cast("int").alias("length"),
        share(F.regexp_count(text, F.lit(r"[!-/:-@\[-`{-~]")), chars, 2).alias("punct"),
        share(F.regexp_count(text, F.lit("[A-Z]")), chars, 3).alias("upper"),
        share(F.regexp_count(text, F.lit("[0-9]")), chars, 2).alias("digit"),
        share(distinct, words, 8).alias("repeat"),
        F.when(words > 0, F.least(F.floor(chars / words), F.lit(BINS - 1))).otherwise(0).cast("int").alias("word"),
    ]


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def evidence(slim: DataFrame, labels: DataFrame) -> DataFrame:
    """slim with p, the probability of quality 1 by the document's own features, from counts over all labelled rows."""
    y = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("id"), F.col("quality").alias("y"))
    marked = slim.join(y, "id").select("y", F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).alias("b")) for i, c in enumerate(FEATURES)])).alias("x"))
    counts = marked.groupBy("x.f", "x.b").agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"))
    totals = counts.where("f = 0").agg(F.coalesce(F.sum("n1"), F.lit(0)).alias("t1"), F.coalesce(F.sum("n0"), F.lit(0)).alias("t0"))
    # at most features x bins rows, so this goes into one cell
    ratio = F.log((F.col("n1") + 1) / (F.col("t1") + BINS)) - F.log((F.col("n0") + 1) / (F.col("t0") + BINS))
    table = totals.join(counts, how="left").agg(
        F.first("t1").alias("t1"), F.first("t0").alias("t0"),
        F.map_from_entries(F.collect_list(F.when(F.col("f").isNotNull(), F.struct((F.col("f") * BINS + F.col("b")).alias("k"), ratio.alias("r"))))).alias("r"))
    prior = F.log((F.col("t1") + 1) / (F.col("t0") + 1))
    absent = F.log((F.col("t0") + BINS) / (F.col("t1") + BINS))
    z = prior
    for i, c in enumerate(FEATURES):
        z = z + F.coalesce(F.try_element_at("r", F.lit(i * BINS) + F.col(c)), absent)
    clipped = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return slim.join(F.broadcast(table)).withColumn("p", sigmoid(clipped)).drop("t1", "t0", "r")


def strength(sites: DataFrame, mean: str) -> Column:
    """Prior observations from moments: sites with n, s (sum of p) and the mean they are shrunk to."""
    m = F.col("s") / F.col("n")
    spread = F.sum(F.col("n") * (m - F.col(mean)) * (m - F.col(mean))) / F.sum("n")
    noise = F.sum(F.col(mean) * (1 - F.col(mean))) / F.sum("n")
    excess = F.greatest(spread - noise, F.lit(1e-6))
    own = F.sum(F.col("n") * F.col(mean) * (1 - F.col(mean))) / F.sum("n")
    return F.greatest(F.lit(1.0), F.least(own / excess - 1, F.lit(1e5)))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", keep_at: float = 0.5) -> DataFrame:
    """Per row: id, evidence, host_posterior, path_posterior, quality (all 0 to 1), keep (quality >= keep_at).

    labels: doc_id, quality (0, 1; other values and null are left out; each row counts).  Without labels, evidence is
    one half everywhere.  A null text counts as empty; a null host or path is a site of its own.  Repeated rows count
    and stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    site = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE))
    slim = cut(docs.select(F.col(id_col).alias("id"), site(host_col).alias("host"), site(path_col).alias("path"), *features(text)))
    scored = cut(evidence(slim, labels).select("id", "host", "path", "p"))

    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    grand = hosts.agg(F.sum("n").alias("total"), (F.sum("s") / F.sum("n")).alias("mu"))
    hosts = hosts.join(F.broadcast(grand))
    hosts = hosts.join(F.broadcast(hosts.agg(strength(hosts, "mu").alias("k"))))
    hosts = hosts.select("host", "mu", ((F.col("s") + F.col("k") * F.col("mu")) / (F.col("n") + F.col("k"))).alias("host_posterior"))
    paths = paths.join(hosts, "host")
    paths = paths.join(F.broadcast(paths.agg(strength(paths, "host_posterior").alias("k"))))
    paths = cut(paths.select("host", "path", "n", "mu", "host_posterior", ((F.col("s") + F.col("k") * F.col("host_posterior")) / (F.col("n") + F.col("k"))).alias("path_posterior")))

    out = join_heavy(scored, paths, ["host", "path"], "n", scored.count())
    z = logit(F.col("p")) + logit(F.col("path_posterior")) - logit(F.col("mu"))
    out = out.withColumn("quality", sigmoid(z))
    return out.select(F.col("id").alias(id_col), F.col("p").alias("evidence"), "host_posterior", "path_posterior", "quality", (F.col("quality") >= keep_at).alias("keep"))
