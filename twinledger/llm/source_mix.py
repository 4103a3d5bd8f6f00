"""Mixing sources to target weights over a tree of any depth, e.g. domain, language, source.

A node's budget is dealt to its children by weight.  A child that lacks the tokens takes what it has, and the shortage
goes to its siblings; only when these are used up does it reach the siblings of their parent.  A leaf then takes its
documents in seeded order, whole epochs first and then a prefix of the next epoch, the last document in part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import WORD, cut

NONE = "(none)"
BIG = "decimal(38,0)"


def weight(levels: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    """Weight of the node at the last of these levels; 1 where none is given."""
    own = {k: v for k, v in weights.items() if len(k) == len(levels)}
    out = F.lit(1)
    for path, value in own.items():
        here = F.lit(True)
        for level, name in zip(levels, path):
            if name is not None:
                here = here & (F.col(level) == name)
        out = F.when(here, F.lit(value)).otherwise(out)
    return out.cast("long")


def deal(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """children: parent columns, name, weight, capacity, budget of the parent (no more than its children's capacity).

    Children fill up in the order of capacity by weight; whoever is full at the level that the rest would reach takes
    its capacity.  The others share what is left by weight, rounded down, and single tokens go to the first of them.
    """
    group = Window.partitionBy(*parent)
    order = group.orderBy(F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf"))), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = F.col("capacity").cast(BIG) * F.col("onward") <= (F.col("budget") - F.col("before")).cast(BIG) * F.col("weight")
    share = F.floor((F.col("rest").cast(BIG) * F.col("weight")) / F.col("sharing")).cast("long")
    return (children.withColumn("before", before).withColumn("onward", onward).withColumn("full", full)
            .withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(group))
            .withColumn("sharing", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group))
            .withColumn("share", F.when(F.col("full"), F.col("capacity")).when(F.col("sharing") > 0, share).otherwise(0))
            .withColumn("odd", F.col("budget") - F.sum("share").over(group))
            .withColumn("turn", F.sum(F.when(~F.col("full") & (F.col("weight") > 0), 1).otherwise(0)).over(order))
            .withColumn("taken", F.col("share") + F.when(~F.col("full") & (F.col("weight") > 0) & (F.col("turn") <= F.col("odd")), 1).otherwise(0))
            .select(*parent, name, F.col("taken").alias("budget")))


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int], percent: int, max_epochs: int) -> DataFrame:
    """leaves: levels, tokens (not null).  Adds budget, in tokens."""
    usable = F.lit(True)
    for k in range(len(levels)):
        usable = usable & (weight(levels[: k + 1], weights) > 0)
    leaves = leaves.withColumn("capacity", F.when(usable, F.col("tokens") * max_epochs).otherwise(0))
    budgets = leaves.agg(F.sum("tokens").alias("t"), F.sum("capacity").alias("c")).select(
        F.lit(0).alias("root"), F.least(F.floor(F.col("t") * percent / 100).cast("long"), F.col("c")).alias("budget"))
    for k, name in enumerate(levels):
        parent = ["root", *levels[:k]]
        nodes = leaves.groupBy(F.lit(0).alias("root"), *levels[: k + 1]).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weight(levels[: k + 1], weights))
        budgets = deal(nodes.join(budgets, parent), parent, name)
    return leaves.join(budgets.drop("root"), list(levels)).select(*levels, "tokens", "budget")


def place(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Where a document stands in an epoch of its leaf: a hexadecimal digest."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple[str, ...], int], percent: int, max_epochs: int = 2,
        seed: int = 0, id_col: str = "doc_id", text_col: str = "text", digits: int = 3) -> DataFrame:
    """Rows that are taken: id, the levels, n_tokens, epochs (whole ones), prefix_tokens (of the next one), tokens_taken.

    levels: name to column, from the root down; a null value is a node of its own, `(none)`.  weights: path to integer
    weight, None in a path for any name; 0 leaves a node out.  Tokens are words.  percent: tokens wanted, in hundredths
    of what there is.  A null or empty text has no tokens and is never taken.  Rows are taken one by one, so repeated
    rows stand side by side; which of two equal rows a prefix ends in makes no difference.

    Order inside a leaf goes by digest; its first `digits` digits cut a leaf into 16**digits parts, whose sums say in
    which one the prefix ends, and only that part is put in order.
    """
    names = list(levels)
    cols = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in levels.items()]
    slim = cut(docs.select(F.col(id_col).alias("id"), *cols, F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens")).where("n_tokens > 0"))
    leaves = slim.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, names, weights, percent, max_epochs).select(
        *names, F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("epochs"), (F.col("budget") % F.col("tokens")).alias("over"))
    # a leaf may hold a third of all rows, so rows meet the plan by leaf and part of its order: max_epochs + 1 orders
    parts = [F.struct(F.lit(e).alias("epochs"), F.substring(place(seed, F.lit(e), F.col("id")), 1, digits).alias("part")) for e in range(max_epochs + 1)]
    sums = slim.select(*names, "n_tokens", F.explode(F.array(*parts)).alias("p")).groupBy(*names, "p.epochs", "p.part").agg(F.sum("n_tokens").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy(*names, "epochs").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cut(sums.join(plan, [*names, "epochs"]).select(*names, "epochs", "over", "part", ahead.alias("ahead"), "n"))
    rows = slim.withColumn("p", F.explode(F.array(*parts))).select("id", *names, "n_tokens", "p.epochs", "p.part")
    placed = rows.join(cells, [*names, "epochs", "part"])
    whole = placed.where("ahead + n <= over").select("id", *names, "n_tokens", "epochs", F.col("n_tokens").alias("prefix_tokens"))
    after = placed.where("ahead >= over").select("id", *names, "n_tokens", "epochs", F.lit(0).cast("long").alias("prefix_tokens"))
    inside = placed.where("ahead < over and ahead + n > over")
    order = Window.partitionBy(*names, "part").orderBy(place(seed, F.col("epochs"), F.col("id")), "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("over") - F.col("ahead") - F.coalesce(F.sum("n_tokens").over(order), F.lit(0))
    inside = inside.select("id", *names, "n_tokens", "epochs", F.least(F.greatest(room, F.lit(0)), F.col("n_tokens")).alias("prefix_tokens"))
    out = whole.unionByName(after).unionByName(inside).withColumn("tokens_taken", F.col("epochs") * F.col("n_tokens") + F.col("prefix_tokens"))
    return out.where("tokens_taken > 0").withColumnRenamed("id", id_col)
