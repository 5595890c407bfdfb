"""Benchmark decontamination: BM25 over an inverted index of test passages, block-max WAND, overlap check.

The index is of the benchmark, cut into shards of at most SHARD_PASSAGES test passages; each shard is broadcast, so what is
broadcast has a fixed bound, and the corpus is read once for each shard. Every passage of every document is a query.
Impacts are divided by the score of a test passage with itself, so one threshold serves all lengths. Which queries can reach
a threshold at all is summed up in numpy for a whole text, from the terms of most weight; only these open cursors.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, ship

K1, B = 1.2, 0.75
#: Words of a test passage at most, and of half a query passage: any run of STEP words lies whole in one query, so a test
#: passage does with as many words put in as it allows.
SPAN, STEP = 96, 120
SHARD_PASSAGES = 20_000
#: Test passages of a block of the index: their largest impacts bound what a query can score in the block.
BLOCK = 16
#: Share of a test passage's own score from which it is retrieved; less where the words that may be edited weigh more.
MIN_SCORE = 0.5
#: Word n-grams of the overlap check, and the share of those of the question and of the answer that must be in the query.
GRAM, MIN_OVERLAP = 5, 0.8
#: Or else their words must stand there in order but for edits: so great a share of the passage's words in all, and of each
#: half. Edits that fall at random do not fall evenly, so a half may have more than its part.
EDITS, HALF_EDITS = 0.25, 0.4
#: Test passages of fewer words are held by texts that have these words and no others: any text may hold so few.
MIN_WORDS = 8

#: Share of the threshold that a passage's least terms may reach together without opening it.
REST = 0.5
#: Letters of a text that are searched at once.
SLICE = 1 << 20
#: Chunks of texts that are searched together, and that a worker remembers.
TOGETHER, CHUNKS = 100_000, 600_000

_WORD, _BREAK = re.compile(r"[^\W_]+"), re.compile(r"\s")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def allowed(n: int, share: float = HALF_EDITS) -> int:
    """Words of n that may be changed, put in or left out; of a half, if not told otherwise."""
    return int(share * n + 1e-9)


class Half:
    """Question or answer of a test passage: its n-grams, and its words as bits for the alignment."""

    def __init__(self, words: list[str]) -> None:
        self.size, self.grams, self.edits = len(words), _grams(words), allowed(len(words))
        self.bits: dict[str, int] = {}
        for j, w in enumerate(words):
            self.bits[w] = self.bits.get(w, 0) | 1 << j

    def distance(self, words: list[str]) -> int:
        """Least number of words changed, put in or left out between the half and any run of ``words`` (Myers' bit vectors)."""
        every, high, get = (1 << self.size) - 1, 1 << (self.size - 1), self.bits.get
        plus, minus, at, best = every, 0, self.size, self.size
        for w in words:
            eq = get(w, 0)
            across = (((eq & plus) + plus) ^ plus) | eq
            up, down = minus | (every & ~(across | plus)), plus & across
            at += bool(up & high) - bool(down & high)
            best = min(best, at)
            up, down, eq = up << 1 & every, down << 1 & every, eq | minus
            plus, minus = down | (every & ~(eq | up)), up & eq
        return best

    def held(self, words: list[str], present: set[str], grams: set) -> tuple[float, int] | None:
        """Share of the half that a query holds, and its edits, none where its n-grams suffice; None where it is not held."""
        share = len(self.grams & grams) / len(self.grams)
        if share >= MIN_OVERLAP:
            return share, 0
        # A word that is nowhere in the query is an edit for certain.
        if sum(w not in present for w in self.bits) <= self.edits and (d := self.distance(words)) <= self.edits:
            return 1 - d / self.size, d
        return None


def _cut(x: list) -> tuple[list, list]:
    """First and second half."""
    cut = (len(x) + 1) // 2
    return x[:cut], x[cut:]


class Index:
    """Inverted index of test passages (item, words): postings by term in passage order with BM25 impacts, block maxima.

    ``df``: passages of the whole benchmark that hold a word; ``count`` and ``mean``: its passages, and their mean length.
    Impacts are shares of the passage's own score.
    """

    def __init__(self, passages: list[tuple[int, list[str]]], df: dict[str, int] | None = None, count: int = 0, mean: float = 0.0) -> None:
        self.items, self.texts = [i for i, _ in passages], [w for _, w in passages]
        if df is None:
            df, count = Counter(t for w in self.texts for t in set(w)), len(passages)
            mean = sum(map(len, self.texts)) / max(1, count)
        #: Items of fewer than MIN_WORDS words, by their words; they have no postings.
        self.whole: dict[tuple[str, ...], list[int]] = {}
        for i, w in passages:
            if len(w) < MIN_WORDS:
                self.whole.setdefault(tuple(w), []).append(i)
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(t for w in self.texts if len(w) >= MIN_WORDS for t in w))}
        idf = {t: math.log(1 + (count - df[t] + 0.5) / (df[t] + 0.5)) for t in self.terms}
        #: Of each passage the impact of each of its terms, and the score from which it is retrieved.
        self.impacts: list[dict[int, float]] = []
        self.need: list[float] = []
        postings: list[tuple[int, int, float]] = []
        entry: list[tuple[int, int, float]] = []
        rest = []
        for p, w in enumerate(self.texts):
            if len(w) < MIN_WORDS:
                self.impacts.append({})
                self.need.append(math.inf)
                rest.append(0.0)
                continue
            words = Counter(w)
            weight = {t: idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / mean)) for t, c in words.items()}
            own = sum(weight.values())
            share = {t: x / own for t, x in weight.items()}
            self.impacts.append({self.terms[t]: x for t, x in share.items()})
            # A passage with all the edits that it allows still scores so much.
            lost = [x for h in _cut(w) for x in sorted((share[t] / words[t] for t in h), reverse=True)[: allowed(len(h))]]
            self.need.append(min(MIN_SCORE, 1 - sum(sorted(lost, reverse=True)[: allowed(len(w), EDITS)])))
            # The least terms, which together stay under a part of the threshold, open no passage.
            left = 0.0
            for t, x in sorted(share.items(), key=lambda x: (x[1], x[0])):
                k = self.terms[t]
                postings.append((k, p, x))
                if entry and entry[-1][1] == p or left + x >= REST * self.need[p]:
                    entry.append((k, p, x))
                else:
                    left += x
            rest.append(left)
        self.rest, self.floor = np.array(rest), np.array(self.need) - 1e-6
        first, passage, impact = _csr(postings, len(self.terms))
        self.lists = [passage[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
        self.entry = _csr(entry, len(self.terms))
        #: The largest impact of each list, and of each of its blocks of BLOCK passages; the least score needed in a block.
        self.most = [float(impact[a:b].max()) for a, b in zip(first[:-1], first[1:], strict=True)]
        self.block: list[dict[int, float]] = [{} for _ in self.terms]
        for k, p, x in postings:
            self.block[k][p // BLOCK] = max(self.block[k].get(p // BLOCK, 0.0), x)
        self.block_need = [min(self.need[b : b + BLOCK]) - 1e-6 for b in range(0, len(self.need), BLOCK)]
        self.halves: dict[int, list[Half]] = {}
        self.chunks = _Chunks(self.terms)

    def _gathered(self, place: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all passages that the terms open: place * passages + passage, and the summed impacts."""
        first, passage, impact = self.entry
        n = first[term + 1] - first[term]
        each = np.repeat(first[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        keys, at = np.unique(np.repeat(place, n) * len(self.items) + passage[each], return_inverse=True)
        return keys, np.bincount(at, weights=impact[each], minlength=len(keys))

    def queries(self, codes: list[np.ndarray]) -> list[tuple[int, int]]:
        """(text, start in steps) of the queries in which some passage may score what it needs; ``codes``: of its words.

        The impacts of the terms that open a passage are summed for each step and the next; with all its other terms they
        must reach its threshold. Where they do, they are summed again with each term once in the whole query.
        """
        sizes = np.array([len(c) for c in codes])
        steps = np.maximum(1, -(-sizes // STEP))
        base = np.cumsum(steps + 1) - steps - 1  # an empty step after each text
        last = base + np.maximum(0, steps - 2)
        code = np.concatenate(codes)
        step = np.repeat(base, sizes) + (np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // STEP
        several = np.flatnonzero(code >= len(self.terms))
        more = [(step[i], t) for i in several.tolist() for t in self.chunks.several[code[i] - len(self.terms)]]
        code[several] = -1
        known = np.flatnonzero(code >= 0)
        pairs = np.append(step[known] * len(self.terms) + code[known], np.array([s * len(self.terms) + t for s, t in more], dtype=np.int64))
        pairs = np.unique(pairs)  # each term once a step
        if not len(pairs):
            return []
        at, term = np.divmod(pairs, len(self.terms))
        keys, sums = self._gathered(at, term)
        if not len(keys):
            return []
        after = np.searchsorted(keys, keys + len(self.items))
        sums = np.append(sums, 0.0)
        after[np.append(keys, -1)[after] != keys + len(self.items)] = len(keys)
        place, p = np.divmod(keys, len(self.items))
        live = place[sums[:-1] + sums[after] + self.rest[p] >= self.floor[p]]
        own = np.searchsorted(base, live, "right") - 1
        live = np.unique(np.minimum(live, last[own]))
        # Again, over the query as a whole.
        ends = np.searchsorted(at, np.stack([live, live + 2]))
        n = ends[1] - ends[0]
        each = np.repeat(ends[0] - np.cumsum(n) + n, n) + np.arange(n.sum())
        whole = np.unique(np.repeat(np.arange(len(live)), n) * len(self.terms) + term[each])
        keys, sums = self._gathered(*np.divmod(whole, len(self.terms)))
        place, p = np.divmod(keys, len(self.items))
        live = live[np.unique(place[sums + self.rest[p] >= self.floor[p]])]
        own = np.searchsorted(base, live, "right") - 1
        return list(zip(own.tolist(), (live - base[own]).tolist(), strict=True))

    def retrieve(self, terms: list[int]) -> list[int]:
        """Passages that score what they need or more against a query of these distinct terms, by block-max WAND.

        Each list has a cursor. In order of their passages, the first place where the maxima of the lists so far reach the
        threshold is the pivot; no passage before it can. If the maxima of its block do not reach what the block needs,
        all cursors up to the pivot skip the block; else they move to the pivot, which is scored when all stand there.
        """
        lists, block = self.lists, self.block
        least, end = min(self.block_need, default=0.0), len(self.items)
        #: Passage, largest impact of the list, term, place in the list.
        cursors = sorted([lists[k][0], self.most[k], k, 0] for k in terms)
        out = []

        def forward(cursor: list, to: int) -> None:
            own = lists[cursor[2]]
            at = cursor[3] = bisect_left(own, to, cursor[3])
            cursor[0] = own[at] if at < len(own) else end

        while cursors:
            reach, i = 0.0, -1
            for i, cursor in enumerate(cursors):
                reach += cursor[1]
                if reach >= least:
                    break
            if reach < least or cursors[i][0] >= end:
                return out
            pivot = cursors[i][0]
            while i + 1 < len(cursors) and cursors[i + 1][0] == pivot:
                i += 1
            b = pivot // BLOCK
            if sum(block[c[2]].get(b, 0.0) for c in cursors[: i + 1]) < self.block_need[b]:
                after = min((b + 1) * BLOCK, cursors[i + 1][0] if i + 1 < len(cursors) else end)
                for c in cursors[: i + 1]:
                    forward(c, after)
            elif cursors[0][0] == pivot:
                if sum(self.impacts[pivot][c[2]] for c in cursors[: i + 1]) >= self.need[pivot] - 1e-9:
                    out.append(pivot)
                for c in cursors[: i + 1]:
                    forward(c, pivot + 1)
            else:
                for c in cursors[: i + 1]:
                    if c[0] < pivot:
                        forward(c, pivot)
            cursors = sorted(c for c in cursors if c[0] < end)
        return out

    def verified(self, p: int, words: list[str], present: set[str], grams: set) -> float:
        """The smaller of the shares of the question and of the answer that the query holds; 0 where it holds too little."""
        if p not in self.halves:
            #: An item is one text, so question and answer of a test passage are its first and second half.
            self.halves[p] = [Half(h) for h in _cut(self.texts[p])]
        least, left = 1.0, allowed(len(self.texts[p]), EDITS)
        for h in self.halves[p]:
            found = h.held(words, present, grams)
            if not found or found[1] > left:
                return 0.0
            least, left = min(least, found[0]), left - found[1]
        return least

    def search(self, texts: list[str | None]) -> list[dict[int, float]]:
        """Of each text: item -> overlap of every item that a passage of it holds."""
        out: list[dict[int, float]] = [{} for _ in texts]
        if not self.items:
            return out
        if self.whole:
            for i, text in enumerate(texts):
                for item in self.whole.get(tuple(m[0] for m in islice(_WORD.finditer((text or "").lower()), MIN_WORDS)), ()):
                    out[i][item] = 1.0
        for run in _bounded((i, words) for i, text in enumerate(texts) for words in self.chunks.runs(text)):
            for i, q in self.queries([codes for _, _, codes in run]):
                doc, chunks, _ = run[i]
                query = _WORD.findall(" ".join(chunks[q * STEP : (q + 2) * STEP]))
                if found := self.retrieve(sorted({self.terms[w] for w in query if w in self.terms})):
                    present, grams = set(query), _grams(query)
                    for p in found:
                        if share := self.verified(p, query, present, grams):
                            out[doc][self.items[p]] = max(out[doc].get(self.items[p], 0.0), share)
        return out


class _Chunks(dict):
    """Code of each blank-separated chunk: its term, -1 for words that are none, -2 for no words, and from the number of
    terms on a place in ``several`` for several words. Found on look-up."""

    def __init__(self, terms: dict[str, int]) -> None:
        super().__init__()
        self.terms, self.several = terms, []

    def __missing__(self, chunk: str) -> int:
        words = _WORD.findall(chunk)
        known = tuple(self.terms[w] for w in words if w in self.terms)
        if not words:
            code = -2
        elif len(known) == 1:
            code = known[0]
        elif known:
            code = len(self.terms) + len(self.several)
            self.several.append(known)
        else:
            code = -1
        self[chunk] = code
        return code

    def runs(self, text: str | None) -> Iterator[tuple[list[str], np.ndarray]]:
        """Chunks with words and their codes, SLICE letters of a text at once; a run begins with the last STEP chunks of the
        one before, so that no passage is cut."""
        text, at, before = (text or "").lower(), 0, []
        while at < len(text):
            end = _BREAK.search(text, at + SLICE)
            end = end.start() if end else len(text)
            if len(self) > CHUNKS:
                self.clear()
                self.several.clear()
            chunks = before + text[at:end].split()
            codes = np.fromiter(map(self.__getitem__, chunks), dtype=np.int64, count=len(chunks))
            if len(none := np.flatnonzero(codes == -2)):
                gone = set(none.tolist())
                chunks, codes = [c for i, c in enumerate(chunks) if i not in gone], np.delete(codes, none)
            if chunks:
                yield chunks, codes
            before, at = chunks[-STEP:], end


def _bounded(runs: Iterator[tuple[int, tuple[list[str], np.ndarray]]]) -> Iterator[list[tuple[int, list[str], np.ndarray]]]:
    """Runs of chunks, about TOGETHER chunks at once."""
    held, size = [], 0
    for i, (chunks, codes) in runs:
        held.append((i, chunks, codes))
        size += len(chunks)
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _csr(postings: list[tuple[int, int, float]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each term's postings, their passages in ascending order, their impacts."""
    postings = sorted(postings)
    first = np.searchsorted(np.array([k for k, _, _ in postings], dtype=np.int64), np.arange(n + 1))
    return first, np.array([p for _, p, _ in postings], dtype=np.int64), np.array([x for _, _, x in postings])


def _grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(words))
    return set(zip(*(words[j:] for j in range(n)), strict=False)) if n else set()


def test_passages(rows: Iterator[tuple[int, str | None]]) -> Iterator[tuple[int, list[str]]]:
    """Items of more than SPAN words are cut evenly, so that each passage fits a query; items without words are none."""
    for item, text in rows:
        words = words_of(text)
        cuts = -(-len(words) // SPAN)
        for c in range(cuts):
            yield item, words[c * len(words) // cuts : (c + 1) * len(words) // cuts]


def _shards(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Test passages (item, words, shard) and the shards, each of at most SHARD_PASSAGES."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(test_passages(zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([w for _, w in rows], pa.list_(pa.string()))], names=["item", "words"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    passages = materialize(items.mapInArrow(cut, "item long, words array<string>").distinct(), "leak-passages")
    n = max(1, -(-passages.count() // SHARD_PASSAGES))
    while True:
        dealt = passages.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(n)).cast("int"))
        sizes = {r["shard"]: r["count"] for r in dealt.groupBy("shard").count().collect()}
        if max(sizes.values(), default=0) <= SHARD_PASSAGES:
            return dealt, sorted(sizes)
        n *= 2


_indexes: dict[str, Index] = {}


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, overlap of every test item that a row of ``docs`` holds; one row for each pair.

    A document holds an item if one of its passages retrieves a test passage of it by BM25 and holds its question and its
    answer: MIN_OVERLAP of the n-grams of each, or its words in order but for edits, HALF_EDITS of the words of each at most
    and EDITS of those of both. An item of fewer than MIN_WORDS words is held by documents that have its words and no
    others, in their order. Null and empty texts and items hold
    nothing and are nowhere; null ids are ids like any other; repeated rows give one row; equal items are each reported.
    Empty tables give an empty result; other columns are ignored. The index is broadcast shard by shard, each searched and
    its result written before the next; the frequencies that it uses are of the whole benchmark.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    passages, shards = _shards(benchmark)
    total = passages.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean")).first()
    df = passages.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    df = materialize(df, "leak-words")
    out = spark.createDataFrame([], _LEAKS)
    for shard in shards:
        own = passages.filter(F.col("shard") == shard)
        used = df.join(own.select(F.explode("words").alias("word")).distinct(), "word", "left_semi")
        rows = sorted((r["item"], r["words"]) for r in own.collect())  # at most SHARD_PASSAGES
        shared = spark.sparkContext.broadcast((rows, {r["word"]: r["df"] for r in used.collect()}, total["n"], total["mean"]))
        name = uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], shared: object = shared, name: str = name) -> Iterator[pa.RecordBatch]:
            if name not in _indexes:  # one index a worker
                _indexes.clear()
                _indexes[name] = Index(*shared.value)
            index = _indexes[name]
            for batch in batches:
                held = index.search(batch.column("text").to_pylist())
                rows = [(d, i, x) for d, items in zip(batch.column("doc_id").to_pylist(), held, strict=True) for i, x in items.items()]
                cols = list(zip(*rows, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["doc_id", "item_id", "overlap"])

        found = texts.mapInArrow(search, _LEAKS)
        out = out.unionByName(materialize(found, "leaks") if len(shards) > 1 else found)
        if len(shards) > 1:
            shared.unpersist()
    return out.groupBy("doc_id", "item_id").agg(F.max("overlap").alias("overlap"))


_LEAKS = "doc_id long, item_id long, overlap double"
