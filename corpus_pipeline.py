"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import decontaminate, line_dedup, ngram_join, packing, quality
from skyledger.llm.common import materialize, named, table


def _whole(docs: DataFrame) -> DataFrame:
    """doc_id, text, whole (all columns of the row): operators see no other names, and rows come back as they were."""
    return docs.select("doc_id", "text", F.struct(*map(named, docs.columns)).alias("whole"))


def _rows(wholes: DataFrame, docs: DataFrame) -> DataFrame:
    return wholes.select(*[F.col("whole")[c].alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, and those too short for the base rule alone that the posterior keeps.

    Null and empty texts go. Repeated rows and null ids are rows like any other; an empty table gives an empty one.
    """
    short = (F.col("n_words") > 0) & (F.col("n_words") < quality.MIN_WORDS) & (100 * F.col("n_repeat_words") <= quality.MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = quality.score_quality(_whole(docs), keep_text=False)
    return _rows(scored.filter(F.col("kept") | (short & (F.col("quality") >= 0.5))), docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the lines that other documents repeat; a text that loses all stays, empty.

    Null texts stay null; rows with a null id lose their repeated lines and hold none for others; repeated rows are treated
    alike; an empty table gives an empty one.
    """
    out = line_dedup.dedup_lines(_whole(docs))
    return out.select(*[F.col("text") if c == "text" else F.col("whole")[c].alias(c) for c in docs.columns])


def _keyed(docs: DataFrame) -> DataFrame:
    """``_whole`` with key, a 64-bit hash of id and text, which tells rows apart where ids are null or repeated."""
    return _whole(docs).withColumn("key", F.xxhash64("doc_id", "text"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates (five words, 0.8).

    Rows are told apart by id and text: rows that share an id, or have none, are documents of their own, and of rows that
    are equal in both one stays. A null id comes after all others. Null and empty texts are near to nothing; an empty table
    gives an empty one.
    """
    keyed = _keyed(docs)
    groups = ngram_join.jaccard_components(keyed.select(F.col("key").alias("doc_id"), "text"), n=5, percent=80)
    groups = materialize(groups.select(F.col("doc_id").alias("key"), "component_id").distinct(), "pipeline-groups")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = keyed.select("key", row.alias("row")).join(groups, "key").groupBy("component_id").agg(F.min("row").alias("row"))
    first = materialize(first.select("row.key"), "pipeline-first")
    return _rows(keyed.join(first, "key", "left_semi").dropDuplicates(["key"]), docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Rows are told apart by id and text. Null and empty texts hold none and stay, as do repeated rows and null ids; an empty
    table or an empty benchmark changes nothing.
    """
    keyed = _keyed(docs)
    leaks = decontaminate.find_leaks(keyed.select(F.col("key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = materialize(leaks.select(F.col("doc_id").alias("key")).distinct(), "pipeline-leaks")
    return _rows(keyed.join(leaks, "key", "left_anti"), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences.

    Null texts are empty: each has the end id alone. Repeated rows and null ids are documents of their own; an empty table
    gives no piece; other columns are left out.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_stage),
    ("benchmark decontamination", leak_stage),
    ("packing", packing_stage),
]
#: No SQL expresses the model fit of the first stage or the tokenizer of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
