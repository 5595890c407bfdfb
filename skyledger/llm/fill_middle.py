"""Fill-in-middle: a text's units are counted by one expression, cut by one match of a pattern made for the row, and written
in another order."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import named

#: A line with its line feed, or a last line without one.
LINE = r"[^\n]*\n|[^\n]+"
#: What stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")


def _draws(doc_id: Column, seed: int) -> Column:
    """Four numbers below 2**32 that the id and the seed decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def _parts(output: Column, marks: tuple[str, str, str]) -> Column:
    """What stands behind each mark. Marks neither occur in the text nor overlap what they are put between."""
    return F.split(output, "|".join(map(re.escape, marks)), -1)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from ``output`` and ``form`` alone."""
    part = _parts(output, marks)
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1]))


def fill_in_middle(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50, unit: str = LINE, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars (code points; null if plain), output, which replace columns of
    these names; all other columns stay.

    ``unit`` is a pattern without groups whose matches tile every text; a text that they do not tile is an error. Where
    the two cuts fall, and whether the suffix comes first (spm) or second (psm), follows from ``seed`` and doc_id, so equal
    ids are cut alike as far as their units go, and a null id counts as an empty one. Plain, their output the text itself,
    are empty texts, texts that hold a mark, and all but ``percent`` of 100; null text is empty. ``marks`` must be such that
    no end of one is a beginning of any. An empty table gives an empty one.

    Counted groups are possessive: they are matched in a loop, however many units there are, and each cut has one place.
    """
    if len({*marks}) < 3 or any(b.startswith(a[i:]) for a in marks for b in marks for i in range(1, len(a))) or any(a in b for a in marks for b in marks if a != b):
        raise ValueError(f"marks overlap: {marks}")
    own = [c for c in docs.columns if c not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    rows = docs.select(F.struct(*map(named, own)).alias("whole"), F.coalesce("text", F.lit("")).alias("text"), _draws(F.col("doc_id"), seed).alias("h"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long"))
    cut = lambda i: F.col("h")[i] % (F.col("n") + 1)
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.contains("text", F.lit(m))
    form = F.when((F.col("text") == "") | marked | (F.col("h")[2] % 100 >= percent), "plain").when(F.col("h")[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumns({"form": form, "a": F.least(cut(0), cut(1)), "b": F.greatest(cut(0), cut(1))})
    counted = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"\A"), counted(F.col("a")), counted(F.col("b") - F.col("a")), F.lit(r"((?s:.*+))\z"))
    p, s, m = (re.sub(r"([\\$])", r"\\\1", x) for x in marks)
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    rows = rows.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order)))
    part = _parts(F.col("output"), marks)
    prefix = F.when(F.col("form") == "psm", part[1]).otherwise(part[2])
    chars = F.struct(F.char_length(prefix).cast("long").alias("prefix"), F.char_length(part[3]).cast("long").alias("middle"))
    tiled = F.when(F.size(part) == 4, chars).otherwise(F.raise_error(F.lit("the units do not tile a text")))
    rows = rows.withColumn("chars", F.when(F.col("form") != "plain", tiled))
    return rows.select(*[F.col("whole")[c].alias(c) for c in own], "n", "form", F.col("chars.prefix").alias("prefix_chars"), F.col("chars.middle").alias("middle_chars"), "output")
