"""Removal of lines that many documents share, by hash and exact document counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import BLANKS, LOWER, UPPER, materialize, maybe_in, named

#: The repeated lines that most documents hold: so many are told in each task, by their keys. Only the others need joins with texts.
OFTEN = 1000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _stripped(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def _key(stripped: Column) -> Column:
    return F.md5(F.translate(stripped, UPPER, LOWER).cast("binary"))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """hash, n, keep: keys that at least ``min_docs`` documents hold, their number, and the largest id among them."""
    # Two steps, both with partial aggregation: a line that a third of all documents hold is one row a task.
    per_doc = lines.groupBy("hash", "doc_id").agg(F.lit(1).alias("one"))
    per_line = per_doc.groupBy("hash").agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("keep"))
    return per_line.filter(F.col("n") >= min_docs)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with its text less repeated lines, and n_lines (before), n_dropped, which replace columns of these names; all
    other columns stay.

    A line's key is the line stripped of blanks with A-Z lower-cased. A key of at least ``min_chars`` code points in at
    least ``min_docs`` distinct ids stays only in the largest id. Null text is one empty line and stays null; a text that
    loses all lines becomes empty. Rows with a null id count as no document and never hold the copy that stays; repeated
    rows are one document and are treated alike. An empty table gives an empty result.
    """
    ids = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    lines = ids.select("doc_id", "text_hash", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    lines = lines.filter(F.char_length("line") >= min_chars).withColumn("line", _stripped(F.col("line"))).filter(F.char_length("line") >= min_chars)
    lines = lines.select("doc_id", "text_hash", "pos", F.unhex(_key(F.col("line"))).alias("hash"))
    # Written first, so that the join can split a line that a third of all documents hold.
    repeated = materialize(repeated_lines(lines, min_docs), "line-repeated")
    often = repeated.orderBy(F.desc("n"), "hash").limit(OFTEN).select(F.lower(F.hex("hash")), F.col("keep").cast("string")).collect()
    keys, keepers = [key for key, _ in often], [f"{key}:{keep}" for key, keep in often]
    hits = maybe_in(lines, repeated, "hash").filter("_maybe").join(repeated, "hash").filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
    # The positions of one document at most, those of lines held often left out; equal rows give equal positions. They grow with the corpus.
    hits = hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.when(~F.lower(F.hex("hash")).isin(keys), F.col("pos"))).alias("drop"))
    hits = materialize(hits, "line-hits")
    # Own columns stay in one struct meanwhile, so that their names meet no others.
    whole = docs.select(F.struct(*[named(c) for c in docs.columns if c != "text"]).alias("whole"), "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("hit.doc_id")) & (F.col("doc.text_hash") == F.col("hit.text_hash"))
    rare = hits.filter(F.size("drop") > 0)
    loses = maybe_in(maybe_in(whole, hits, "doc_id", "text_hash").withColumnRenamed("_maybe", "_hit"), rare, "doc_id", "text_hash")
    # Only texts that may lose a line not held often are dealt out to meet their positions; the others stay where they are.
    met = loses.filter("_maybe").alias("doc").join(rare.alias("hit"), same, "left").select("whole", "doc.doc_id", "text", "_hit", "drop")
    out = met.unionByName(loses.filter("not _maybe").select("whole", "doc_id", "text", "_hit", F.lit(None).cast("array<int>").alias("drop")))

    def stays(line: Column) -> Column:
        key = _key(_stripped(line))
        is_keeper = F.concat(key, F.lit(":"), F.col("doc_id").cast("string")).isin(keepers)
        return (F.char_length(line) < min_chars) | ~key.isin(keys) | F.coalesce(is_keeper, F.lit(False))

    out = out.withColumn("lines", _lines(F.col("text")))
    rest = F.expr("array_except(sequence(0, size(lines) - 1), coalesce(drop, array()))")
    out = out.withColumn("kept", F.when(F.col("_hit"), F.filter(rest, lambda i: stays(F.col("lines")[i]))))
    out = out.withColumn("dropped", F.coalesce(F.size("lines") - F.when(F.col("kept").isNotNull(), F.size("kept")), F.lit(0)))
    text = F.when(F.col("dropped") == 0, F.col("text")).otherwise(F.expr("array_join(transform(kept, i -> lines[i]), '\\n')"))
    columns = [text.alias("text") if c == "text" else F.col("whole")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*columns, F.size("lines").cast("long").alias("n_lines"), F.col("dropped").cast("long").alias("n_dropped"))
