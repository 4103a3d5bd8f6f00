"""Unit-year panels from tenures.

Both rules and the fallback are written as aggregates with map-side combining, so no unit's tenures are ever sorted
or collected in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K

KEY = ["unit", "role", "year"]


def active_years(tenures: DataFrame, first: int = K.PANEL_FIRST_YEAR, last: int = K.PANEL_LAST_YEAR) -> DataFrame:
    """One row per tenure and calendar year it touches, clipped to the panel years before expanding.

    ``tenures``: unit, role, holder, ord, sy, sm, ey, em; month 0 is unknown, an open end is (9999, 12).
    """
    lo, hi = F.greatest("sy", F.lit(first)), F.least("ey", F.lit(last))
    return tenures.filter(lo <= hi).withColumn("year", F.explode(F.sequence(lo.cast("int"), hi.cast("int"))))


def months_in_year() -> Column:
    """Months in office in ``year``; null when a month that is needed is unknown."""
    starts, ends = F.col("sy") == F.col("year"), F.col("ey") == F.col("year")
    return (
        F.when(~starts & ~ends, 12)
        .when(starts & ~ends, F.when(F.col("sm") > 0, 13 - F.col("sm")))
        .when(~starts & ends, F.when(F.col("em") > 0, F.col("em")))
        .otherwise(F.when((F.col("sm") > 0) & (F.col("em") > 0), F.greatest(F.col("em") - F.col("sm") + 1, F.lit(1))))
        .cast("int")
    )


def in_office_midyear() -> Column:
    """True, false, or null when the month that decides is unknown or July itself."""
    started = (
        F.when(F.col("sy") < F.col("year"), True).when(F.col("sm").isin(0, 7), None).otherwise(F.col("sm") <= 6)
    )
    still = F.when(F.col("ey") > F.col("year"), True).when(F.col("em").isin(0, 7), None).otherwise(F.col("em") >= 8)
    return started & still


def _latest() -> Column:
    """Order of the fallback: latest start, an unknown month counting as 13, then file order."""
    return F.struct("sy", F.when(F.col("sm") > 0, F.col("sm")).otherwise(13).alias("m"), "ord")


def pick_longest(active: DataFrame) -> DataFrame:
    """Holder per (unit, role, year): the only one, else the unique longest if all months are known, else the latest."""
    by_months = active.withColumn("months", months_in_year()).groupBy(*KEY, "months").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct(_latest().alias("k"), F.col("holder"))).alias("last"))
    # at most 13 rows per key from here on: 12 month counts and the unknown
    known = F.when(F.col("months").isNotNull(), F.struct("months", "n", F.col("last.holder").alias("holder")))
    g = by_months.groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.max(known).alias("top"), F.max("last").alias("last"),
        F.max(F.col("months").isNull().cast("int")).alias("unknown"))
    unique = (F.col("top.n") == 1) & (F.col("unknown") == 0)
    return g.select(*KEY, F.when((F.col("n") > 1) & unique, F.col("top.holder")).otherwise(F.col("last.holder")).alias("holder"))


def pick_midyear(active: DataFrame) -> DataFrame:
    """Holder per (unit, role, year): the only one, else the only one surely in office on 1 July, else the latest."""
    on = in_office_midyear()
    g = active.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(on).alias("n_on"), F.max(F.when(on, F.col("holder"))).alias("on"),
        F.max(F.struct(_latest().alias("k"), F.col("holder"))).alias("last"))
    return g.select(*KEY, F.when((F.col("n") > 1) & (F.col("n_on") == 1), F.col("on")).otherwise(F.col("last.holder")).alias("holder"))


def pick_latest(active: DataFrame) -> DataFrame:
    return active.groupBy(*KEY).agg(F.max(F.struct(_latest().alias("k"), F.col("holder"))).alias("last")).select(
        *KEY, F.col("last.holder").alias("holder"))


def panel(tenures: DataFrame, units: DataFrame | None = None, first: int = K.PANEL_FIRST_YEAR,
          last: int = K.PANEL_LAST_YEAR) -> DataFrame:
    """(unit, year, rule, governor, secretary) for every unit and year under both rules; empty where nobody held."""
    active = active_years(tenures, first, last)
    picked = pick_longest(active).withColumn("rule", F.lit("longest")).unionByName(
        pick_midyear(active).withColumn("rule", F.lit("midyear")))
    wide = picked.groupBy("unit", "year", "rule").agg(
        F.max(F.when(F.col("role") == "governor", F.col("holder").cast("string"))).alias("governor"),
        F.max(F.when(F.col("role") == "secretary", F.col("holder").cast("string"))).alias("secretary"))
    grid = (units if units is not None else tenures.select("unit")).select("unit").distinct().select(
        "unit", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"),
    ).withColumn("rule", F.explode(F.array(F.lit("longest"), F.lit("midyear"))))
    return grid.join(wide, ["unit", "year", "rule"], "left").select(
        "unit", "year", "rule", F.coalesce("governor", F.lit("")).alias("governor"), F.coalesce("secretary", F.lit("")).alias("secretary"))
