"""Merging verdicts into one version of the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from twinledger import constants as K
from twinledger.functions.dates import int_or_text
from twinledger.functions.ordered import CHUNK_ROWS, attach, has_large_key, ordinal
from twinledger.operators.reconcile import by_index

LINE = ["name", "line_zero"]


def _order_type(*sources: DataFrame) -> str:
    """The type of positions, which only have to sort: plain numbers where all are, else wide ones, for sources without
    dense positions."""
    return "bigint" if all(s.schema["pos"].dataType.simpleString() == "bigint" for s in sources) else "decimal(38,0)"


def _tagged(a: DataFrame, b: DataFrame, groups: DataFrame, large: bool, by_name: bool = False) -> DataFrame:
    """Rows of a and b and the decided lines as one union, by ``tag`` a, b and g, partitioned once by person.

    If one person is so large that ordered work is cut up, the union is not partitioned by person; nor if all lie so.
    """
    order = _order_type(a, b)

    def rows(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.col("name").alias("name"), "line_zero", F.col("pos").cast(order).alias("pos"), *K.EPISODE_FIELDS, F.lit(tag).alias("tag"))

    decided = groups.select("name", F.col("source_line").cast("long").alias("line_zero"), F.lit("g").alias("tag"),
                            F.coalesce("adopt", F.lit("LLM1")).alias("adopt"), "episodes")
    u = rows(a, "a").unionByName(rows(b, "b")).unionByName(decided, allowMissingColumns=True)
    return u if large or by_name else u.repartition("name")


def _with_fates(u: DataFrame, keep_all: bool, large: bool) -> DataFrame:
    """Add ``first_pos``, ``decided`` (the person has a decision) and ``kind``, what happens to the row's line: judge, b,
    first (only the first A row) or all (A kept), none; null where nothing was decided."""
    line, person, tag = W.partitionBy(*LINE), W.partitionBy("name"), F.col("tag")
    is_a, is_g = tag == "a", tag == "g"
    u = u.withColumns({
        "first_pos": F.min(F.when(is_a, F.col("pos"))).over(line), "in_b": F.max(tag == "b").over(line),
        "line_decided": F.max(is_g).over(line), "line_adopt": F.max("adopt").over(line),
        "judged": F.coalesce(F.max(F.size("episodes") > 0).over(line), F.lit(False))})
    if large:
        u = u.join(u.groupBy("name").agg(F.max(is_g).alias("decided"), F.max(is_a).alias("has_a")), "name")
    else:
        u = u.withColumns({"decided": F.max(is_g).over(person), "has_a": F.max(is_a).over(person)})
    kind = (
        F.when(F.col("judged"), "judge")
        .when(F.col("line_adopt").isin(K.GROUP_ADOPT_B) & F.col("in_b"), "b")
        .when(F.col("first_pos").isNotNull(), F.lit("all" if keep_all else "first"))
        .otherwise("none")
    )
    return u.filter("has_a").withColumn("kind", F.when(F.col("line_decided"), kind))


def _placed(u: DataFrame, chunk_rows: int, large: bool) -> DataFrame:
    """Rows that stay, with ``seq``, from the rows of ``_with_fates``."""
    tag, kind = F.col("tag"), F.col("kind")
    order = _order_type(u)
    zero = F.lit(0).cast(order)
    unseen = F.col("first_pos").isNull()
    anchor = F.coalesce("first_pos", F.col("line_zero").cast(order))

    def piece(line: Column, of, sorted_: Column, unseen_: Column, anchor_: Column, idx: Column) -> Column:
        return F.struct(line.alias("line"), *[of(f).alias(f) for f in K.EPISODE_FIELDS], sorted_.alias("sorted"),
                        unseen_.alias("unseen"), anchor_.alias("anchor"), idx.alias("idx"))

    from_a = piece(F.col("line_zero"), F.col, F.col("decided"), F.lit(False), F.col("pos"), zero)
    from_b = piece(F.col("line_zero"), F.col, F.lit(True), unseen, anchor, F.col("pos"))
    judged = F.transform("episodes", lambda e, i: piece(
        F.coalesce(e["source_line"].try_cast("long"), F.col("line_zero")), lambda f: e[f], F.lit(True), unseen, anchor, i.cast(order)))
    stays = kind.isNull() | (kind == "all") | ((kind == "first") & (F.col("pos") == F.col("first_pos")))
    pieces = (
        F.when((tag == "a") & stays, F.array(from_a)).when((tag == "b") & (kind == "b"), F.array(from_b))
        .when((tag == "g") & (kind == "judge"), judged)
    )
    rows = u.select("name", F.inline(pieces)).withColumn("_line", F.when(F.col("sorted"), F.col("line")).otherwise(F.lit(0)))
    out = ordinal(rows, ["name"], ["_line", "unseen", "anchor", "idx"], "seq", chunk_rows, large)
    return out.select("name", "seq", F.col("line").alias("source_line"), *K.EPISODE_FIELDS)


def merge_groups(a: DataFrame, b: DataFrame, decisions: DataFrame, keep_all: bool = False,
                 large: bool | None = None, chunk_rows: int = CHUNK_ROWS, by_name: bool = False) -> DataFrame:
    """Apply line-level decisions to source A and renumber.

    ``decisions`` has one row per (name, source_line) with ``adopt`` and replacement ``episodes`` (may be null).
    Adopting A keeps only the first A row of the line, unless ``keep_all``.  People with a decision are sorted by
    line, arrival order breaking ties; others keep their order.

    Both sources and the decisions travel as one union; what happens to a line, and the numbering, are windows on its
    partitioning by person, which they may have already (``by_name``).
    """
    if large is None:
        large = has_large_key(a.select("name").unionByName(b.select("name")), ["name"], chunk_rows)
    return _placed(_with_fates(_tagged(a, b, decisions, large, by_name), keep_all, large), chunk_rows, large)


def merge_fields(eps: DataFrame, b: DataFrame, decisions: DataFrame, skip_lines: DataFrame,
                 pairing: str = "exact", by_name: bool = False) -> DataFrame:
    """Apply field-level decisions keyed (name, source_line, unit, position, start, field) to merged rows.

    Lines in ``skip_lines`` were handled as groups.  ``pairing='exact'`` takes B's value from the last B row with the
    same unit and position, so adopting B on those two fields changes nothing; ``'zip'`` takes the value B had at the
    same place of the line, which a ``value_b`` column of the decision must carry.

    Merged rows, B's rows, decisions and skipped lines travel as one union, partitioned once by line, unless all lie
    partitioned ``by_name``.
    """
    line, order = ["name", "source_line"], _order_type(b, decisions)
    extra = ["value_b"] if pairing == "zip" else []
    rows = eps.select(F.col("name").alias("name"), "source_line", "seq", *K.EPISODE_FIELDS, F.lit("e").alias("tag"))
    for part in (
        b.select("name", F.col("line_zero").alias("source_line"), *K.EPISODE_FIELDS, F.col("pos").cast(order).alias("pos"), F.lit("b").alias("tag")),
        decisions.select(*line, "unit", "position", "start", F.col("pos").cast(order).alias("pos"), "field", "verdict", "correct_value", *extra,
                         F.lit("f").alias("tag")),
        skip_lines.select("name", F.col("source_line").cast("long").alias("source_line"), F.lit("g").alias("tag")),
    ):
        rows = rows.unionByName(part, allowMissingColumns=True)
    post = [*line, "unit", "position"]
    is_b, tag = F.col("tag") == "b", F.col("tag")
    v = F.struct("verdict", "correct_value", *extra)
    own = {f: (tag == "f") & (F.col("field") == f) for f in K.EPISODE_FIELDS}
    # the widest key first: its sort serves the other two
    j = (rows if by_name else rows.repartition(*line)).withColumns({
        f"d_{f}": F.max_by(F.when(c, v), F.when(c, F.col("pos"))).over(W.partitionBy(*post, "start")) for f, c in own.items()})
    j = j.withColumn("b", F.max_by(F.when(is_b, F.struct("start", "end")), F.when(is_b, F.col("pos"))).over(W.partitionBy(*post)))
    j = j.withColumn("_skip", F.max(tag == "g").over(W.partitionBy(*line))).filter(tag == "e")
    # null keys match nothing
    keyed = F.col("source_line").isNotNull()
    at_post = keyed & F.col("unit").isNotNull() & F.col("position").isNotNull()
    out = {}
    for f in K.EPISODE_FIELDS:
        d = F.when(at_post & F.col("start").isNotNull(), F.col(f"d_{f}"))
        if pairing == "zip":
            b_val = d["value_b"]
        else:
            b_val = F.when(at_post, F.col(f"b.{f}")) if f in ("start", "end") else F.col(f)
        corrected = F.nullif(d["correct_value"], F.lit(""))
        new = F.when(d["verdict"].isin(K.ADOPT_B), b_val).when(d["verdict"].isin(K.CORRECTED), corrected)
        out[f] = F.coalesce(F.when(~(F.col("_skip") & keyed), new), F.col(f), F.lit(""))
    return j.select("name", "seq", F.coalesce("source_line", F.lit(0)).alias("source_line"),
                    *[e.alias(f) for f, e in out.items()])


def merge_step1(a: DataFrame, b: DataFrame, group_decisions: DataFrame, field_decisions: DataFrame, **options):
    pairing, by_name = options.pop("pairing", "exact"), options.get("by_name", False)
    return merge_fields(merge_groups(a, b, group_decisions, **options), b, field_decisions, group_decisions, pairing, by_name)


def merge_classes(eps: DataFrame, a: DataFrame, b: DataFrame, decisions: DataFrame,
                  fields: list[str] = K.CLASS_FIELDS, by_name: bool = False) -> DataFrame:
    """Layer classifications on merged episodes: A, else B when A is empty, then the decisions per (index, field)."""
    key = ["name", "seq"]
    both = by_index(a, b, fields).select("name", F.col("episode_idx").alias("seq"), "a", "b")
    v = F.struct("verdict", "correct_value")
    d = decisions.groupBy("name", F.col("episode_idx").alias("seq")).agg(*[
        F.max_by(F.when(F.col("field") == f, v), F.when(F.col("field") == f, F.col("pos"))).alias(f"d_{f}")
        for f in fields])
    j = attach(eps, key, {"_c": both, "_d": d}, by_name)

    def value(f: str) -> Column:
        va, vb, dec = F.col(f"_c.a.{f}"), F.col(f"_c.b.{f}"), F.col(f"_d.d_{f}")
        filled = lambda c: F.nullif(c, F.lit(""))
        override = F.when(dec["verdict"].isin(K.ADOPT_B), filled(vb)).when(
            dec["verdict"].isin(K.CORRECTED), filled(dec["correct_value"]))
        return F.coalesce(override, filled(va), vb, F.lit(""))

    return j.select(*eps.columns, *[value(f).alias(f) for f in fields])


def resolve_ranks(a: DataFrame, b: DataFrame, decisions: DataFrame) -> DataFrame:
    """(name, episode_idx, rank): A's ranks with the decisions applied; a decision may add an index."""
    key = ["name", "episode_idx"]
    both = by_index(a, b, ["rank"]).select(
        *key, "in_a", "in_b", F.when(F.col("in_a"), F.coalesce("a.rank", F.lit(""))).alias("ra"), F.col("b.rank").alias("rb"))
    d = decisions.groupBy(*key).agg(F.max_by(F.struct("verdict", "correct_value"), F.col("pos")).alias("d"))
    rows = both.withColumn("name", F.col("name")).unionByName(d, allowMissingColumns=True)
    j = rows.groupBy(*key).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"), F.max("ra").alias("ra"), F.max("rb").alias("rb"), F.max("d").alias("d"))
    adopt_b = F.col("d.verdict").isin(K.ADOPT_B)
    fixed = F.when(F.col("d.verdict").isin(K.CORRECTED), F.nullif(F.col("d.correct_value"), F.lit("")))
    rank = F.when(adopt_b, F.when(F.col("in_b"), F.coalesce("rb", F.lit(""))).otherwise(F.coalesce("ra", F.lit("")))).otherwise(
        F.coalesce(fixed, F.col("ra")))
    return j.filter(F.col("in_a") | adopt_b | fixed.isNotNull()).select(*key, rank.alias("rank"))


def resolve_labels(a: DataFrame, b: DataFrame, decisions: DataFrame, fields: list[str] = K.LABEL_FIELDS,
                   honour_all: bool = False) -> DataFrame:
    """Person labels with the decisions applied.  Only the four label fields are honoured; ``honour_all`` also lets
    verdicts on the other ``fields`` through."""
    v = F.struct("verdict", "correct_value")
    used = fields if honour_all else [f for f in fields if f in K.LABEL_FIELDS]
    d = decisions.groupBy("name").agg(*[
        F.max_by(F.when(F.col("field") == f, v), F.when(F.col("field") == f, F.col("pos"))).alias(f"d_{f}") for f in used])
    lb = b.select("name", F.struct(*fields).alias("b"))
    j = a.join(lb, "name", "left").join(d, "name", "left")

    def value(f: str) -> Column:
        own = F.coalesce(F.col(f), F.lit("-1"))
        if f not in used:
            return own
        dec = F.col(f"d_{f}")
        fixed = F.nullif(dec["correct_value"], F.lit(""))
        return (
            F.when(dec["verdict"].isin(K.ADOPT_B), F.coalesce(F.col(f"b.{f}"), F.lit("-1")))
            .when(dec["verdict"].isin(K.CORRECTED) & fixed.isNotNull(), int_or_text(fixed)).otherwise(own)
        )

    return j.select(*[c for c in a.columns if c not in fields], *[value(f).alias(f) for f in fields])
