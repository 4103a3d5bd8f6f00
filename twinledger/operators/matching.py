"""Greedy matching of a person's records with another version of them, for people of any size.

Each record of the first version, in order, takes the free record of the second with the best score (the earliest among
equals).  What a record gets depends on all before it, so this cannot be cut into independent parts: the matching wanted
is the lexicographically first one, for which no fast parallel algorithm is known.

A person with few pairs of records (`PAIRS`) is one row of two arrays, matched inside the row.  The records of larger
people go in blocks: all their k-th blocks are matched together, then what they took is struck out and the next blocks
follow, as many rounds as the largest person has blocks.  There, scores come from a similarity join over distinct texts:
texts that are alike enough share one of their rarer characters, so pairs meet by person and character.  A block of n
records can take at most n of a candidate list, so no list is longer; a task holds one person's block and lists at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from twinledger.functions import text as T
from twinledger.functions.ordered import CHUNK_ROWS, cut, ordinal

BLOCK = 2048
PAIRS = 4096
TEXTS = ["unit", "position"]


def _chars(text: Column) -> Column:
    """The characters of a text that names a set; an empty one has one of its own, which another empty one shares."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(F.split(text, ""))


def _name_of_set(text: Column) -> Column:
    return F.when(text == "", "").otherwise(F.array_join(F.sort_array(F.array_distinct(F.split(text, ""))), ""))


def _missing(a: Column, b: Column) -> Column:
    """How many characters of the set named ``b`` the one named ``a`` has not: ``translate`` deletes the common ones."""
    return F.length(F.call_function("translate", b, a, F.lit("")))


def _alike(n_a: Column, n_b: Column, missing: Column, empty: float) -> Column:
    """Jaccard of two sets of these sizes; ``empty`` if both are."""
    return F.when(n_a + n_b == 0, F.lit(empty)).otherwise((n_b - missing) / (n_a + missing))


def _rarest(sides: list[DataFrame], column: str, keep) -> DataFrame:
    """(column, ch): the rarest characters of every distinct text, keep(n) of its n."""
    texts = sides[0].select(column).unionByName(sides[1].select(column)).distinct().withColumn("all", _chars(F.col(column)))
    each = texts.select(column, F.explode("all").alias("ch"))
    # at most one row for each code point there is
    common = each.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
    ranked = each.join(common, "ch").groupBy(column).agg(F.sort_array(F.collect_list(F.struct("n", "ch"))).alias("all"))
    return ranked.select(column, F.explode(F.slice("all", F.lit(1), keep(F.size("all")))).alias("c")).select(column, F.col("c.ch").alias("ch"))


def _meeting(gold: DataFrame, pred: DataFrame, column: str, keep) -> DataFrame:
    """Pairs (name, texts of gold, p_ texts of pred) that share a character among the `keep` rarest of a text."""
    rare = _rarest([gold, pred], column, keep)
    left, right = gold.join(rare, column), pred.join(rare, column)
    right = right.withColumnsRenamed({t: f"p_{t}" for t in TEXTS})
    return left.join(right, ["name", "ch"]).select("name", *TEXTS, *[f"p_{t}" for t in TEXTS])


def _scored(gold: DataFrame, pred: DataFrame, weighted: bool) -> DataFrame:
    """(name, texts, p_texts, score) for the accepted pairs of distinct texts of a person."""
    sets = {c: _chars(F.col(c)) for c in [*TEXTS, *[f"p_{t}" for t in TEXTS]]}
    if not weighted:
        # a similarity of 0.3 needs 0.3 of a set's characters in common
        met = _meeting(gold, pred, "unit", lambda n: n - F.expr("(3 * size(all) + 9) div 10").cast("int") + 1).distinct()
        return met.withColumn("score", T.set_jaccard(sets["unit"], sets["p_unit"])).filter("score >= 0.3")
    # above 0.3 in all needs a character of the unit, or more than 0.75 of the position
    met = _meeting(gold, pred, "unit", lambda n: n).unionByName(
        _meeting(gold, pred, "position", lambda n: n - F.expr("(3 * size(all)) div 4").cast("int"))).distinct()
    some = lambda t: F.when((F.col(t) == "") | (F.col(f"p_{t}") == ""), 0.0).otherwise(T.set_jaccard(sets[t], sets[f"p_{t}"]))
    return met.withColumn("score", some("unit") * 0.6 + some("position") * 0.4).filter("score > 0.3")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, golds, preds) come sorted by name; each gold in order takes the first free one of its row's preds."""
    def taken(rows: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
        used, at, out = set(), [0] * len(rows), []
        for g, r in sorted((g, r) for r, (golds, _) in enumerate(rows) for g in golds):
            preds, k = rows[r][1], at[r]
            while k < len(preds) and preds[k] in used:
                k += 1
            at[r] = k
            if k < len(preds):
                used.add(preds[k])
                out.append((g, preds[k]))
        return out

    def sent(names: list, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array([g for g, _ in pairs], pa.int64()), pa.array([p for _, p in pairs], pa.int64())],
                                          names=["name", "g_no", "p_no"])

    kind, person, rows, names, pairs = None, None, [], [], []
    for batch in batches:
        kind = batch.schema.field("name").type
        for name, golds, preds in zip(*(batch.column(c).to_pylist() for c in ("name", "golds", "preds"))):
            if name != person:
                found = taken(rows)
                names += [person] * len(found)
                pairs += found
                person, rows = name, []
                if len(pairs) > 50_000:
                    yield sent(names, pairs)
                    names, pairs = [], []
            rows.append((golds, preds))
    if kind is not None:
        found = taken(rows)
        yield sent(names + [person] * len(found), pairs + found)


def _match_block(gold: DataFrame, pred: DataFrame, weighted: bool, block: int) -> DataFrame:
    """(name, g_no, p_no) of one block of each person's gold and all its free preds."""
    key = ["name", *TEXTS]
    golds = gold.groupBy(*key).agg(F.sort_array(F.collect_list("no")).alias("golds"))
    pairs = _scored(gold.select(*key).distinct(), pred.select(*key).distinct(), weighted)
    first = W.partitionBy(*key).orderBy("no")
    few = pred.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= block).drop("r")
    met = pairs.join(few.withColumnsRenamed({t: f"p_{t}" for t in TEXTS}), ["name", *[f"p_{t}" for t in TEXTS]])
    best = W.partitionBy(*key).orderBy(F.desc("score"), "no")
    lists = met.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= block).groupBy(*key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("r", "no"))), lambda x: x["no"]).alias("preds"))
    rows = golds.join(lists, key).select("name", "golds", "preds").repartition("name").sortWithinPartitions("name")
    return rows.mapInArrow(_walk, f"name {gold.schema['name'].dataType.simpleString()}, g_no long, p_no long")


def _match_rows(gold: DataFrame, pred: DataFrame, weighted: bool) -> DataFrame:
    """(name, g_no, gold, pred) of people whose records fit one row each."""
    def grouped(df: DataFrame, out: str) -> DataFrame:
        # the order of a struct is that of its fields, and e comes first
        return df.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("e", *TEXTS))).alias(out))

    j = grouped(gold, "g").join(grouped(pred, "p"), "name", "full_outer" if weighted else "left")
    j = j.select("name", *[F.coalesce(F.col(c), F.array()).alias(c) for c in "gp"])
    used = TEXTS if weighted else TEXTS[:1]

    def score(g: Column, x: Column) -> Column:
        alike = {t: _alike(F.length(g[t]), F.length(x["p"][t]), x[t], 0.0 if weighted else 1.0) for t in used}
        return alike["unit"] * 0.6 + alike["position"] * 0.4 if weighted else alike["unit"]

    met = lambda g: F.transform("p", lambda p, i: F.struct(i.alias("i"), p.alias("p"), *[_missing(g[t], p[t]).alias(t) for t in used]))
    scored = lambda g: F.transform(met(g), lambda x: F.struct((-score(g, x)).alias("s"), x["i"].alias("i")))
    liked = lambda g: F.transform(F.sort_array(F.filter(scored(g), lambda x: x["s"] < -0.3 if weighted else x["s"] <= -0.3)), lambda x: x["i"])
    # generators keep what is made once from being made again for each use
    j = j.select("name", F.inline(F.array(F.struct("g", "p", F.transform("g", liked).alias("likes")))))
    none = F.array().cast("array<int>")
    taken = F.aggregate("likes", none, lambda out, like: F.array_append(out, F.try_element_at(F.filter(like, lambda i: ~F.coalesce(F.array_contains(out, i), F.lit(False))), F.lit(1))))
    j = j.select("name", F.inline(F.array(F.struct("g", "p", taken.alias("m")))))
    row = lambda no, g, p: F.struct(no.cast("int").alias("g_no"), g.alias("gold"), p.alias("pred"))
    rows = F.transform("g", lambda g, i: row(i + 1, g["e"], F.try_element_at("p", F.try_element_at("m", i + 1) + 1)["e"]))
    if weighted:  # hits and what is left over come from one row, so it is matched once
        nothing = F.lit(None).cast(j.schema["g"].dataType.elementType["e"].dataType)
        free = F.filter("p", lambda p, i: ~F.coalesce(F.array_contains("m", i), F.lit(False)))
        rows = F.concat(rows, F.transform(free, lambda p: row(F.lit(None), nothing, p["e"])))
    return j.select("name", F.inline(rows))


def _match_blocks(gold: DataFrame, pred: DataFrame, weighted: bool, block: int, most: int) -> DataFrame:
    """(name, g_no, gold, pred) of people of any size, `most` rows at most."""
    number = lambda df: cut(ordinal(df, ["name"], ["e"], "no", large=most > CHUNK_ROWS))
    g, p, found = number(gold), number(pred), None
    for start in range(0, most, block):
        part = g.filter((F.col("no") > start) & (F.col("no") <= start + block))
        left = p
        if found is not None:  # people of earlier blocks alone are done
            left = p.join(found.select("name", F.col("p_no").alias("no")), ["name", "no"], "left_anti").join(part.select("name").distinct(), "name", "left_semi")
        now = cut(_match_block(part, left, weighted, block))
        found = now if found is None else found.unionByName(now)
    all_gold = g.select("name", F.col("no").alias("g_no"), F.col("e").alias("gold"))
    all_pred = p.select("name", F.col("no").alias("p_no"), F.col("e").alias("pred"))
    hits = all_gold.join(found, ["name", "g_no"], "left").join(all_pred, ["name", "p_no"], "left").select("name", F.col("g_no").cast("int").alias("g_no"), "gold", "pred")
    if not weighted:
        return hits
    left = all_pred.join(found, ["name", "p_no"], "left_anti")
    return hits.unionByName(left.select("name", F.lit(None).cast("int").alias("g_no"), F.lit(None).cast(hits.schema["gold"].dataType).alias("gold"), "pred"))


def match_episodes(gold: DataFrame, pred: DataFrame, fields: list[str], weighted: bool = False, pairs: int = PAIRS, block: int = BLOCK) -> DataFrame:
    """(name, g_no, gold, pred): greedy matching on the characters of the unit, per person in ``pos`` order.

    Default: unit similarity of at least 0.3; two empty units are alike.  ``weighted``: 0.6 unit + 0.4 position,
    strictly above 0.3, and the pred rows left over come out with a null gold.  A null name is matched with nothing.
    """
    norm = (lambda c: F.coalesce(c, F.lit(""))) if weighted else T.eval_norm

    def prepared(df: DataFrame) -> DataFrame:
        e = F.struct("pos", *fields)
        return df.select("name", e.alias("e"), _name_of_set(norm(F.col("unit"))).alias("unit"), (_name_of_set(norm(F.col("position"))) if weighted else F.lit("")).alias("position"))

    g, p = prepared(gold), prepared(pred)
    sides = gold.select("name", F.lit(1).alias("g")).unionByName(pred.select("name", F.lit(0).alias("g")))
    sizes = sides.groupBy("name").agg(F.sum("g").alias("n"), F.count(F.lit(1)).alias("all"))
    big = (F.col("n") > block) | (F.col("n") * (F.col("all") - F.col("n")) > pairs)
    most = sizes.filter(big & F.col("name").isNotNull()).agg(F.max("all")).first()[0]
    if most is None:
        return _match_rows(g, p, weighted)
    large = cut(sizes.filter(big & F.col("name").isNotNull()).select("name"))
    apart = lambda how: [df.join(large, "name", how) for df in (g, p)]
    return _match_rows(*apart("left_anti"), weighted).unionByName(_match_blocks(*apart("left_semi"), weighted, block, most))
