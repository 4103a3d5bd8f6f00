"""Rules of the earlier row format: level and role flags, person flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K
from twinledger.functions import dates as D
from twinledger.functions.dates import strip
from twinledger.functions.text import any_word


def bureau_or_below(position: Column, unit: Column, org_tag: Column) -> Column:
    """1 at bureau level or below, 0 above; the first rule that speaks decides, silence means 1."""
    return (
        F.when(any_word(position, K.LEGACY_STUDY_WORDS), 1).when(any_word(position, K.VICE_PROVINCIAL_WORDS), 0)
        .when(any_word(unit, K.VICE_PROVINCIAL_CITIES) & any_word(position, ["市长", "书记", "常委"]), 0)
        .otherwise(1)
    )


def mayor_row(position: Column, unit: Column, city: str) -> Column:
    hit = F.contains(position, F.lit("市长")) & ~any_word(position, ["副市长", "常务副", "第一副"])
    return (hit & any_word(unit, [city, "市政府", "市人民政府"])).cast("int")


def secretary_row(position: Column, unit: Column, city: str) -> Column:
    named = F.contains(position, F.lit("委书记")) & any_word(unit, [city, "市委"])
    plain = (strip(position) == "书记") & F.contains(unit, F.lit("市委")) & F.contains(unit, F.lit(city))
    return (named | plain).cast("int")


def person_flags(eps: DataFrame, city: str) -> DataFrame:
    """(name, ever_mayor, ever_secretary, focal_start): maxima over rows and the first year of a focal row."""
    mayor, sec = mayor_row(F.col("position"), F.col("unit"), city), secretary_row(F.col("position"), F.col("unit"), city)
    focal = F.contains(F.col("unit"), F.lit(city)) & any_word(F.col("position"), ["市长", "代市长", "书记"])
    year = D.to_int(F.element_at(F.split(F.col("start"), r"\."), 1))
    return eps.groupBy("name").agg(F.max(mayor).alias("ever_mayor"), F.max(sec).alias("ever_secretary"),
                                   F.min(F.when(focal & (year != 0), year)).alias("focal_start"))


def verification_notes(summary: DataFrame) -> DataFrame:
    """(name, note) for people whose comparison did not pass."""
    n = (F.col("high_count") + F.col("medium_count")).cast("string")
    return summary.filter("verdict <> 'PASS'").select(
        "name", F.concat(F.lit("[需人工核查:DeepSeek/Qwen差异"), n, F.lit("处,"), F.col("verdict"), F.lit("]")).alias("note"))


def with_person_flags(eps: DataFrame, summary: DataFrame, city: str) -> DataFrame:
    """Rows with their own flags, the person's flags, and the note on the person's first row."""
    flags = person_flags(eps, city)
    first = eps.groupBy("name").agg(F.min("seq").alias("_first"))
    j = eps.join(flags, "name").join(first, "name").join(verification_notes(summary), "name", "left")
    return j.withColumns({
        "is_mayor": mayor_row(F.col("position"), F.col("unit"), city), "is_secretary": secretary_row(F.col("position"), F.col("unit"), city),
        "note": F.when(F.col("seq") == F.col("_first"), F.coalesce("note", F.lit(""))).otherwise("")}).drop("_first")
