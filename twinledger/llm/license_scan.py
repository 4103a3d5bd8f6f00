"""Licence scan by canonical digest: a text and each of its lines are brought to one form and looked up as a whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm.common import lower_ascii

#: Spellings that count as equal.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("organisation", "organization"), ("favour", "favor"),
    ("acknowledgement", "acknowledgment"), ("whilst", "while"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("copyright holder", "copyright owner"),
)

#: Short notices and whole texts of public licences.
NOTICES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "BSD-2-Clause": ("SPDX-License-Identifier: BSD-2-Clause",),
    "BSD-3-Clause": ("SPDX-License-Identifier: BSD-3-Clause",),
    "ISC": ("SPDX-License-Identifier: ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
}
MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
KNOWN = {k: list(v) for k, v in NOTICES.items()}
KNOWN["MIT"] += [MIT_BODY, "MIT License\n" + MIT_BODY]

#: Lines that only say whose work it is, with or without comment marks in front; and what counts as punctuation.
COPYRIGHT = r"(?m)^[ \t#*/;-]*(?:[Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt][ \t]*(?:[(][Cc][)]|\x{A9}|[0-9]|:)|[(][Cc][)][ \t]|\x{A9}|[Aa][Ll][Ll] [Rr][Ii][Gg][Hh][Tt][Ss] [Rr][Ee][Ss][Ee][Rr][Vv][Ee][Dd])[^\n]*$"
PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{A0}\x{A9}\x{2010}-\x{2015}\x{2018}-\x{201F}\x{2022}]+"


def canonical(text: Column, spellings: Sequence[tuple[str, str]] = SPELLINGS) -> Column:
    """Without copyright lines, case and punctuation, words joined by one space, spellings made equal."""
    out = lower_ascii(F.regexp_replace(text, COPYRIGHT, " "))
    out = F.trim(F.regexp_replace(out, PUNCTUATION, " "))
    for a, b in spellings:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def known_digests(spark: SparkSession, known: Mapping[str, Sequence[str]], spellings: Sequence[tuple[str, str]] = SPELLINGS) -> DataFrame:
    """digest, license: one row for each canonical form; of several licences with one form, the first by name."""
    values = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, texts in known.items() for t in texts)
    forms = spark.sql(f"select * from values {values} as t(license, form)")
    return forms.select("license", F.sha2(canonical(F.col("form"), spellings), 256).alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def scan(docs: DataFrame, known: Mapping[str, Sequence[str]] = KNOWN, spellings: Sequence[tuple[str, str]] = SPELLINGS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, license (of the whole text, or null), notices (licences of single lines, sorted), n_notice_lines, canonical_sha256.

    Null counts as empty; an empty form has no licence.  Repeated rows each get the same answer.
    """
    table = known_digests(docs.sparkSession, known, spellings)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    lines = rows.select("id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select(
        "id", "t", "line_no", F.sha2(canonical(F.col("line"), spellings), 256).alias("digest"))
    found = lines.join(table, "digest").groupBy("id", "t").agg(F.collect_set(F.struct("line_no", "license")).alias("f"))
    found = found.select(F.col("id").alias("fid"), "t", F.array_sort(F.array_distinct(F.col("f.license"))).alias("notices"), F.size("f").cast("long").alias("n_notice_lines"))
    whole = rows.select("id", F.xxhash64("text").alias("t"), F.sha2(canonical(F.col("text"), spellings), 256).alias("digest")).join(table, "digest", "left")
    both = whole.join(found, whole.id.eqNullSafe(found.fid) & (whole.t == found.t), "left")
    return both.select(F.col("id").alias(id_col), "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"),
                       F.coalesce("n_notice_lines", F.lit(0)).cast("long").alias("n_notice_lines"), F.col("digest").alias("canonical_sha256"))
