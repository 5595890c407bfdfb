"""Language identification by rank-order profiles of frequent letter n-grams and out-of-place distance.

N-grams are of one to three letters of a word that is padded by a space at both ends. Each is one 63-bit number, its code
points at 21 bits each, whose order is that of the letters; so texts are counted, ranked and compared in numpy.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, ship

#: N-grams of a profile.
PROFILE = 400
#: Letters that are counted at once, and rows of counts that a worker holds, which bounds its memory.
CHUNK, HELD = 1 << 20, 1 << 21
#: Languages whose profiles are broadcast at once; more are compared in turn.
LANGS = 2000

_NO_LETTERS = "und"
_SPACE = 32


@lru_cache(1)
def _letters() -> np.ndarray:
    """Of each code point, whether it is a letter (Unicode category L)."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def _merged(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    return grams[first], np.add.reduceat(counts, first)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a text in ascending order, and how often each occurs."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    letter = _letters()[points]
    points[~letter] = _SPACE
    found = []
    at = np.flatnonzero(letter)
    for a in range(0, len(at), CHUNK):
        i = at[a : a + CHUNK]
        before, own, after = points[i - 1] << 42, points[i], points[i + 1]
        last = own[~letter[i + 1]] << 42 | _SPACE << 21
        found.append(np.unique(np.concatenate([own << 42, before | own << 21, last, before | own << 21 | after]), return_counts=True))
    if len(found) == 1:
        return found[0]
    return _merged(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else (np.empty(0, np.int64),) * 2


def in_training(doc_id: Column) -> Column:
    """Not held out: crc32 of the id as text, modulo 4, is not 2. A null id trains nothing and is not held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def profiles(docs: DataFrame) -> DataFrame:
    """lang, gram, rank (from 0) of the PROFILE most frequent n-grams of each language, over all texts with one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, counts = _merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                counted = gram_counts(text.as_py() or "")
                if len(counted[0]):
                    held.setdefault(lang, []).append(counted)
                    rows += len(counted[0])
                if rows > HELD:
                    yield from flush()
                    rows = 0
        yield from flush()

    grams = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("gram")]
    # First within 64 parts of a language, then over what is left: no task holds all n-grams of one language.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(64))).orderBy(*order)
    few = grams.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= PROFILE)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1).filter(F.col("rank") < PROFILE).select("lang", "gram", "rank")


class Profiles:
    """Profiles of languages: of each n-gram the languages that have it, with its rank there."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        self.langs = sorted({r[0] for r in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        rows = sorted((gram, number[lang], rank) for lang, gram, rank in rows)
        grams = np.array([r[0] for r in rows], dtype=np.int64)
        self.lang, self.rank = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        self.grams, self.first = np.unique(grams, return_index=True)
        self.first = np.append(self.first, len(rows))

    def nearest(self, own: np.ndarray) -> tuple[str, float]:
        """The language of the smallest distance (ties: the first by name) for n-grams in the order of their rank, and its score.

        An n-gram is as many places out as its ranks differ, PROFILE where the language does not have it.
        """
        place = np.searchsorted(self.grams, own)
        place[place == len(self.grams)] = 0
        rank = np.flatnonzero(self.grams[place] == own)
        start, n = self.first[place[rank]], self.first[place[rank] + 1] - self.first[place[rank]]
        each = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
        near = PROFILE - np.abs(np.repeat(rank, n) - self.rank[each])
        total = np.bincount(self.lang[each], weights=near, minlength=len(self.langs))
        best = int(total.argmax())
        return self.langs[best], float(total[best]) / (PROFILE * len(own))


def identify(docs: DataFrame, model: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with lang_pred and score (0 to 1, one less the share of the largest distance).

    The document's own PROFILE most frequent n-grams are compared with those of each language; ties go to the first
    language by name. Null texts, texts without a letter and an empty model give "und" and 0. Repeated rows and null ids
    are rows like any other.
    """
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext

    def compared(df: DataFrame, rows: list, last: bool) -> DataFrame:
        shared = context.broadcast(rows)

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = Profiles(shared.value)
            for batch in batches:
                best, scores = batch.column("lang_pred").to_pylist(), batch.column("score").to_pylist()
                for i, text in enumerate(batch.column("text")):
                    grams, counts = gram_counts(text.as_py() or "")
                    if len(grams) and table.langs:
                        lang, score = table.nearest(grams[np.argsort(-counts, kind="stable")[:PROFILE]])
                        if best[i] == _NO_LETTERS or score > scores[i]:
                            best[i], scores[i] = lang, score
                out = [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(out + [batch.column("text")] * (not last), names=["doc_id", "lang_pred", "score"] + ["text"] * (not last))

        return df.mapInArrow(predict, "doc_id long, lang_pred string, score double" + ", text string" * (not last))

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(_NO_LETTERS).alias("lang_pred"), F.lit(0.0).alias("score"))
    after, done = F.lit(True), False
    while not done:
        langs = [r["lang"] for r in model.filter(after).select("lang").distinct().orderBy("lang").limit(LANGS + 1).collect()]
        done = len(langs) <= LANGS
        part = model.filter(after & (F.col("lang") <= langs[:LANGS][-1])).collect() if langs else []  # at most LANGS * PROFILE rows
        out = compared(out, [tuple(r) for r in part], done)
        after = F.col("lang") > langs[LANGS - 1] if not done else after
    return out


def train_and_identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``; learnt from rows that ``in_training`` picks with a lang."""
    train = docs.filter(in_training(F.col("doc_id")) & F.col("lang").isNotNull())
    model = materialize(profiles(train), "langid-profiles")
    held = F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out")
    return identify(docs, model).select("doc_id", held, "lang_pred", "score")
