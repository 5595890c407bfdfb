"""Repeated passages by a sparse suffix array over the words of all texts.

Kept are the suffixes at minimiser positions: the first word k-gram of least hash among the first WINDOW of any passage of
MIN_WORDS words. Two equal passages pick the same position, so only suffixes that start alike in two documents can lie in
a repeated passage. These are sorted by their words, neighbours of different documents are compared, and their match is
extended word by word to the right and to the left, up to REACH words, which is as far as a passage around the suffix goes.
Suffixes of one start with the same surroundings throughout match in full wherever they are sorted, and are not. What no
neighbour shares in full is compared passage by passage with all that starts alike, since a suffix that lies further away
may share more to the left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, maybe_in, ship
from skyledger.llm.words import end, folded, runs, step, with_words

#: Words of a k-gram, k-grams of a window, words of the shortest passage.
K, WINDOW, MIN_WORDS = 6, 16, 50
#: A passage of MIN_WORDS words has a kept suffix with at least so many of its words, and at most REACH words on either side.
SUFFIX, REACH = MIN_WORDS - WINDOW + 1, WINDOW - 1


def picks(h: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all passages of MIN_WORDS words, and the kept suffix of each; ``stop`` is the end of each word's document."""
    m = len(h) - MIN_WORDS + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    g = end(folded(h, np.arange(m + WINDOW - 1), K))
    least, first = g[:m].copy(), np.arange(m)
    for j in range(1, WINDOW):
        less = np.flatnonzero(g[j : j + m] < least)
        least[less], first[less] = g[j + less], j + less
    starts = np.flatnonzero(np.arange(m) + MIN_WORDS <= stop[:m])
    return starts, first[starts]


def _contexts(h: np.ndarray, start: np.ndarray, stop: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words before and after each suffix in its document, REACH at most, and their hashes outwards from it; 0 where there is none."""
    before, after = np.minimum(at - start, REACH), np.minimum(stop - at - SUFFIX, REACH)
    side = lambda first, way, n: [np.where(j < n, h[np.clip(first + way * j, 0, len(h) - 1)], np.uint64(0)) for j in range(REACH)]
    return before, after, side(at - 1, -1, before), side(at + SUFFIX, 1, after)


def suffixes(texts: DataFrame) -> DataFrame:
    """Kept suffixes: hash of the first SUFFIX words, hash of these with up to REACH words before and after them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, which = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "_text"))
            for a, ends, h in runs(batch):
                row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                at = np.unique(picks(h, ends[row + 1])[1])
                start = ends[row[at]]
                before, after, left, right = _contexts(h, start, ends[row[at] + 1], at)
                x = folded(h, at, SUFFIX)
                prefix = end(x)
                x = step(x, (before * WINDOW + after).astype(np.uint64))
                for words in (*right, *left):
                    x = step(x, words)
                cols = (ids[a + row[at]], which[a + row[at]], at - start, before.astype(np.int8), after.astype(np.int8), prefix.view(np.int64), end(x).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["doc_id", "_text", "at", "before", "after", "prefix", "around"])

    return with_words(texts, "doc_id", "_text").mapInArrow(rows, "doc_id long, _text long, at long, before byte, after byte, prefix long, around long")


def surrounded(texts: DataFrame, mixed: DataFrame) -> DataFrame:
    """The suffixes of ``mixed`` with the hashes of the words before (``left``) and after (``right``) them, outwards."""
    names = ("at", "before", "after", "prefix", "around")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, col = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("_at")
            cuts, fields = col.offsets.to_numpy().astype(np.int64), [col.values.field(n).to_numpy(zero_copy_only=False) for n in names]
            for a, ends, h in runs(batch):
                b = a + len(ends) - 1
                own = slice(cuts[a], cuts[b])
                row = np.repeat(np.arange(b - a), np.diff(cuts[a : b + 1]))
                _, _, *sides = _contexts(h, ends[row], ends[row + 1], ends[row] + fields[0][own])
                packed = [np.ascontiguousarray(np.stack(x, axis=1)) for x in sides]
                offsets = pa.py_buffer((np.arange(len(row) + 1) * 8 * REACH).astype(np.int32))
                binary = [pa.Array.from_buffers(pa.binary(), len(row), [None, offsets, pa.py_buffer(x)]) for x in packed]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a + row]), *(pa.array(f[own]) for f in fields), *binary], names=["doc_id", *names, "left", "right"])

    at = mixed.groupBy("doc_id", "_text").agg(F.collect_set(F.struct(*names)).alias("_at"))  # of one text at most
    some = maybe_in(texts, at, "doc_id", "_text").filter("_maybe").drop("_maybe")
    return with_words(some.distinct().join(at, ["doc_id", "_text"]), "doc_id", "_text", "_at").mapInArrow(rows, f"{_SUFFIX}, left binary, right binary")


_SUFFIX = "doc_id long, at long, before byte, after byte, prefix long, around long"


def _words(col: pa.Array) -> np.ndarray:
    """Word hashes of a binary column, REACH a row."""
    first = 8 * REACH * col.offset
    return np.frombuffer(col.buffers()[2], np.uint8)[first : first + 8 * REACH * len(col)].view(np.uint64).reshape(-1, REACH)


def _shared(words: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Words that each row shares with the next one from the first on."""
    alike = np.logical_and.accumulate(words[:-1] == words[1:], axis=1).sum(axis=1)
    return np.minimum(alike, np.minimum(room[:-1], room[1:]))


def compared(found: DataFrame) -> DataFrame:
    """``found`` sorted by words, each suffix with what it shares with the one before (_l1, _r1) and the one after (_l2, _r2) in
    that order: words to the left and to the right, -1 where that is of the same document or starts otherwise. The first and
    last of a task have no neighbour beyond it."""
    order = ["prefix", "right", "left", "doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in (*batches, None):  # the last two rows wait for their neighbours
            parts = [x for x in (held, batch) if x is not None and x.num_rows]
            if not parts or (batch is not None and not batch.num_rows):
                continue
            x = pa.concat_batches(parts)
            ids, prefix, before, after = (x.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "prefix", "before", "after"))
            meet = (ids[:-1] != ids[1:]) & (prefix[:-1] == prefix[1:])
            pairs = [np.where(meet, _shared(_words(x.column(c)), n), -1).astype(np.int8) for c, n in (("left", before), ("right", after))]
            ahead, behind = [np.concatenate(([-1], p)).astype(np.int8) for p in pairs], [np.concatenate((p, [-1])).astype(np.int8) for p in pairs]
            out = pa.RecordBatch.from_arrays([*x.columns, *map(pa.array, (*ahead, *behind))], names=[*x.schema.names, "_l1", "_r1", "_l2", "_r2"])
            a, b = int(held is not None and held.num_rows > 1), x.num_rows if batch is None else x.num_rows - 1
            yield out.slice(a, b - a)
            held = x.slice(max(0, x.num_rows - 2))

    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(rows, f"{_SUFFIX}, left binary, right binary, _l1 byte, _r1 byte, _l2 byte, _r2 byte")


def passages(of: DataFrame) -> DataFrame:
    """doc_id, start, hash of every passage of MIN_WORDS words with up to REACH words before the suffix."""
    cut = of.withColumn("_n", F.explode(F.sequence(F.greatest(F.lit(0), F.lit(REACH) - F.col("after")).cast("int"), F.col("before").cast("int"))))
    words = F.xxhash64("prefix", "_n", F.expr("substring(left, 1, 8 * _n)"), F.expr(f"substring(right, 1, 8 * ({REACH} - _n))"))
    return cut.select("doc_id", (F.col("at") - F.col("_n")).alias("start"), words.alias("passage"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start, end (words, end exclusive) of passages of at least MIN_WORDS words found in another document too.

    Words are blank-separated with A-Z lower-cased. Passages of a document that touch are one row. Every passage of
    MIN_WORDS words is compared with those of all other documents by 64-bit hashes, however often its own document holds
    it. Null, empty and short texts have none; null ids are left out; repeated rows are one document; an empty table gives
    an empty result; other columns are ignored.
    """
    ship(docs.sparkSession)
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_text"))
    kept = materialize(suffixes(texts), "suffix-kept")
    starts = kept.groupBy("prefix").agg(*(f(c).alias(f"_{n}{c}") for c in ("doc_id", "around") for n, f in (("min_", F.min), ("max_", F.max))))
    # Written first, so that the join can split a start that a third of all documents hold.
    shared = materialize(starts.filter("_min_doc_id < _max_doc_id").select("prefix", (F.col("_min_around") < F.col("_max_around")).alias("mixed")), "suffix-shared")
    found = materialize(kept.join(shared, "prefix"), "suffix-found")
    span = lambda left, right: [(F.col("at") - left).alias("start"), (F.col("at") + SUFFIX + right).alias("end")]
    same = found.filter("not mixed").select("doc_id", *span(F.col("before"), F.col("after")))
    near = materialize(compared(materialize(surrounded(texts, found.filter("mixed")), "suffix-mixed")), "suffix-compared")
    pairs = [near.filter(f"_l{k} + _r{k} >= {REACH}").select("doc_id", *span(F.col(f"_l{k}"), F.col(f"_r{k}"))) for k in (1, 2)]
    near = near.withColumn("whole", F.expr("(_l1 = before and _r1 = after) or (_l2 = before and _r2 = after)"))
    # Suffixes that no neighbour shares in full meet all others that start alike: of those that one does, two documents
    # (least and greatest id) stand for all with the same surroundings.
    part = near.filter("not whole")
    row = F.struct("doc_id", "at", "before", "after", "prefix", "left", "right")
    ends = near.filter("whole").groupBy("prefix", "around").agg(F.min(row).alias("_a"), F.max(row).alias("_b"))
    ends = ends.join(part.select("prefix").distinct(), "prefix", "left_semi").select(F.inline(F.array("_a", "_b")))
    cut = materialize(passages(part.select(ends.columns).unionByName(ends)), "suffix-passages")
    repeated = materialize(cut.groupBy("passage").agg(F.min("doc_id").alias("_l"), F.max("doc_id").alias("_h")).filter("_l < _h").select("passage"), "suffix-repeated")
    spans = cut.join(repeated, "passage", "left_semi").select("doc_id", "start", (F.col("start") + MIN_WORDS).alias("end"))
    return merged(same.unionByName(pairs[0]).unionByName(pairs[1]).unionByName(spans).distinct())


def merged(spans: DataFrame) -> DataFrame:
    """Spans of a document that overlap or touch, as one."""
    w = Window.partitionBy("doc_id").orderBy("start", "end")
    x = spans.withColumn("_reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    x = x.withColumn("_run", F.sum(F.coalesce((F.col("start") > F.col("_reach")).cast("int"), F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy("doc_id", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")
