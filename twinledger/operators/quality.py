"""Matching against gold and accuracy reports.  Counts stay integers; ratios are formed last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K
from twinledger.functions import dates as D, text as T


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def step1_scores(gold: DataFrame, pred: DataFrame, matched: DataFrame, fields: list[str] = ("unit", "position", "start", "end")) -> DataFrame:
    """Per person: gold, predicted and matched counts, recall, precision, F1 and correct counts per field."""
    eq = [F.count_if(T.eval_norm(F.col(f"gold.{f}")) == F.when(F.col("pred").isNull(), "").otherwise(T.eval_norm(F.col(f"pred.{f}")))).alias(f"{f}_ok") for f in fields]
    m = matched.groupBy("name").agg(F.count(F.lit(1)).alias("n_gold"), F.count("pred").alias("matched"), *eq)
    n = pred.groupBy("name").agg(F.count(F.lit(1)).alias("n_pred"))
    j = m.join(n, "name", "left").na.fill(0, ["n_pred"])
    recall, precision = _ratio(F.col("matched"), F.col("n_gold")), _ratio(F.col("matched"), F.col("n_pred"))
    f1 = F.when(recall + precision > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return j.select("name", "n_gold", "n_pred", "matched", recall.alias("recall"), precision.alias("precision"), f1.alias("f1"),
                    *[f"{f}_ok" for f in fields])


def score_indexed(gold: DataFrame, pred: DataFrame, fields: list[str], keys: list[str] = ("name", "episode_idx"), pos: str = "pos") -> DataFrame:
    """One row per gold record: the gold and predicted value of each field and whether all agree.

    The last prediction of an index counts; a missing one is empty values.
    """
    keys = list(keys)
    p = pred.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.col(pos)).alias("p"))
    g = gold.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.col(pos)).alias("g"))
    j = g.join(p, keys, "left")
    for f in fields:
        j = j.withColumns({f"g_{f}": T.eval_norm(F.col(f"g.{f}")), f"p_{f}": T.eval_norm(F.col(f"p.{f}"))})
    same = F.lit(True)
    for f in fields:
        same = same & (F.col(f"g_{f}") == F.col(f"p_{f}"))
    return j.withColumn("all_ok", same).drop("g", "p")


def accuracy(scored: DataFrame, fields: list[str], by: list[str]) -> DataFrame:
    """(by, field, correct, total); field ``all_fields`` counts records where every field agrees."""
    g = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if("all_ok").alias("n_all"),
                                *[F.count_if(F.col(f"g_{f}") == F.col(f"p_{f}")).alias(f"n_{f}") for f in fields])
    rows = [F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("correct")) for f in fields]
    rows.append(F.struct(F.lit("all_fields").alias("field"), F.col("n_all").alias("correct")))
    return g.select(*by, F.inline(F.array(*rows)), F.col("n").alias("total"))


def errors(scored: DataFrame, fields: list[str], keys: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"g_{f}").alias("gold"), F.col(f"p_{f}").alias("pred")) for f in fields])
    return scored.select(*keys, F.inline(F.filter(rows, lambda r: r["gold"] != r["pred"])))


def label_accuracy(gold: DataFrame, pred: DataFrame, fields: list[str] = K.LABEL_FIELDS, keep: list[str] = ()) -> DataFrame:
    """Per person: correct and total labels.  Blank or non-numeric gold is skipped, unreadable predictions are wrong."""
    number = lambda c: D.strip(c).try_cast("double").cast("int")
    j = gold.join(pred.select("name", *[F.col(f).alias(f"_p_{f}") for f in fields]), "name", "left")
    total, correct = F.lit(0), F.lit(0)
    for f in fields:
        g, p = number(F.col(f)), number(F.col(f"_p_{f}"))
        total = total + g.isNotNull().cast("int")
        correct = correct + F.coalesce((g == p).cast("int"), F.lit(0))
    return j.select("name", *keep, correct.alias("correct"), total.alias("total"))


def micro(per_person: DataFrame, by: list[str]) -> DataFrame:
    """Sums of correct and total over people, with the ratio."""
    g = per_person.groupBy(*by).agg(F.sum("correct").cast("long").alias("correct"), F.sum("total").cast("long").alias("total"))
    return g.withColumn("accuracy", _ratio(F.col("correct"), F.col("total")))


def leaderboard_classes(acc: DataFrame, class_fields: list[str] = K.CLASS_FIELDS, rank_field: str = "rank") -> DataFrame:
    """One row per model from (model, field, correct, total): field accuracies, all-correct share, their mean.

    Models whose class accuracies are all zero are left out; best mean first.
    """
    fields = [*class_fields, rank_field]
    g = acc.groupBy("model").agg(*[
        F.coalesce(F.max(F.when(F.col("field") == f, _ratio(F.col("correct"), F.col("total")))), F.lit(0.0)).alias(f) for f in [*fields, "all_fields"]])
    nonzero = F.lit(False)
    mean = F.lit(0.0)
    for f in class_fields:
        nonzero = nonzero | (F.col(f) != 0)
    for f in fields:
        mean = mean + F.col(f)
    return g.filter(nonzero).withColumn("mean_acc", mean / len(fields)).orderBy(F.desc("mean_acc"), "model")


def leaderboard_extraction(step1: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per model: label accuracy, mean F1 and recall over people; best mean of accuracy and F1 first."""
    m = step1.groupBy("model").agg(F.avg("f1").alias("f1"), F.avg("recall").alias("recall"))
    a = micro(labels, ["model"]).select("model", F.col("accuracy").alias("label_acc"))
    return a.join(m, "model", "left").na.fill(0.0).withColumn("score", (F.col("label_acc") + F.col("f1")) / 2).orderBy(F.desc("score"), "model")


def top_errors(errs: DataFrame, n: int = 5) -> DataFrame:
    return errs.groupBy("field", "gold", "pred").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field", "gold", "pred").limit(n)


def error_direction(errs: DataFrame) -> DataFrame:
    """Rank errors by direction: over (predicted higher), under, other."""
    g, p = T.rank_ord(F.col("gold")), T.rank_ord(F.col("pred"))
    kind = F.when(p < g, "over").when(p > g, "under").otherwise("other")
    return errs.groupBy(kind.alias("direction")).agg(F.count(F.lit(1)).alias("n"))


def locate_errors(rows: DataFrame, errs: DataFrame, columns: list[str]) -> DataFrame:
    """Errors (name, seq, column) joined to the cell they mean; ``found`` is false for a missing row or column."""
    cells = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])
    j = errs.join(rows.select("name", "seq", cells.alias("_c")), ["name", "seq"], "left")
    known = F.col("_c").isNotNull() & F.col("column").isin(columns)
    return j.select("name", "seq", "column", F.try_element_at("_c", F.col("column")).alias("value"), F.coalesce(known, F.lit(False)).alias("found"))


def column_error_rate(located: DataFrame, n_rows: DataFrame) -> DataFrame:
    """Errors and cells per column and, if there are any, a row TOTAL; ``n_rows`` is one row with the row count ``n``."""
    found = located.filter("found").groupBy("column").agg(F.count(F.lit(1)).alias("errors"))
    r = found.crossJoin(F.broadcast(n_rows)).select("column", "errors", F.col("n").alias("cells"))
    total = r.agg(F.lit("TOTAL").alias("column"), F.sum("errors").alias("errors"), F.sum("cells").alias("cells")).filter("errors is not null")
    return r.unionByName(total).withColumn("rate", _ratio(F.col("errors"), F.col("cells")))


def compare_legacy(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Differences of weighted-matched records: record counts, start dates, organisation tags, unmatched rows."""
    gap = F.abs(F.col("n_a") - F.col("n_b"))
    by_count = counts.filter(gap > 2).select(
        "name", F.lit("count").alias("field"), F.col("n_a").cast("string").alias("value_a"), F.col("n_b").cast("string").alias("value_b"),
        F.when(gap > 4, "HIGH").otherwise("MEDIUM").alias("level"))
    both = F.col("gold").isNotNull() & F.col("pred").isNotNull()
    fa, fb = F.col("_fa"), F.col("_fb")
    # as columns of their own, so that each is computed once per pair
    dated = pairs.withColumns({"_fa": D.frac_year_legacy(F.col("gold.start")), "_fb": D.frac_year_legacy(F.col("pred.start"))})
    dated = dated.withColumn("_years", F.when((fa < 0) | (fb < 0), 0.0).otherwise(F.abs(fa - fb)))
    row = lambda field, a, b, level, wanted: F.when(wanted, F.struct(F.lit(field).alias("field"), a.alias("value_a"), b.alias("value_b"), level.cast("string").alias("level")))
    tag_a, tag_b = F.col("gold.org_tag"), F.col("pred.org_tag")
    rows = F.array(
        row("start", F.col("gold.start"), F.col("pred.start"), F.when(F.col("_years") > 2, "HIGH").otherwise("MEDIUM"), both & (F.col("_years") > 1)),
        row("org_tag", tag_a, tag_b, F.lit("MEDIUM"), both & (tag_a != tag_b)),
        row("unmatched", F.col("gold.unit"), F.col("pred.unit"), F.lit(None), ~both))
    return by_count.unionByName(dated.select("name", F.inline(F.array_compact(rows))))
