"""Cases of the review: what the operators once left out."""

from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from skyledger.llm import decontaminate, packing, quality, suffix_dedup


def _repeated(texts: dict[int, list[str]], n: int = 50) -> set[tuple[int, int]]:
    holders = defaultdict(set)
    for i, w in texts.items():
        for p in range(len(w) - n + 1):
            holders[tuple(w[p : p + n])].add(i)
    return {(i, q) for i, w in texts.items() for p in range(len(w) - n + 1) if len(holders[tuple(w[p : p + n])]) > 1 for q in range(p, p + n)}


@pytest.mark.parametrize("length", [50, 58, 120])
def test_passage_held_many_times_by_one_document(spark, length):
    rng = np.random.default_rng(length)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 10**6, k)]
    passage, texts = word(length), {}
    texts[1] = [w for _ in range(10) for w in [*word(40), *passage]] + word(30)
    texts[2] = [*word(70), *passage, *word(20)]
    # Copies with words changed here and there: what matches longest on one side is no long match on both.
    base = word(400)
    for i in range(3, 40):
        texts[i] = [w if rng.random() > 0.03 else f"x{i}y{j}" for j, w in enumerate(base)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {(r.doc_id, q) for r in suffix_dedup.repeated_passages(df).collect() for q in range(r.start, r.end)}
    assert got == _repeated(texts)
    assert sum(i == 1 for i, _ in got) >= 10 * length


def test_neighbours_are_extended_to_both_sides(spark):
    """What sorted neighbours share, by plain comparison of the words around the suffixes."""
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 300)]
    texts = {i: [w if rng.random() > 0.02 else f"x{i}y{j}" for j, w in enumerate(base)] for i in range(30)}
    rows = [(i, " ".join(w), i) for i, w in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, _text long")
    kept = suffix_dedup.suffixes(df)
    near = suffix_dedup.compared(suffix_dedup.surrounded(df, kept)).collect()
    assert sorted((r.doc_id, r.at) for r in near) == sorted((r.doc_id, r.at) for r in kept.collect())
    met = 0
    for r in near:
        for left, right in ((r._l1, r._r1), (r._l2, r._r2)):
            if left < 0:
                continue
            met += 1
            w, n = texts[r.doc_id], suffix_dedup.SUFFIX
            passage = tuple(w[r.at - left : r.at + n + right])
            assert len(passage) == left + n + right
            others = (v for i, v in texts.items() if i != r.doc_id)
            assert any(tuple(v[p : p + len(passage)]) == passage for v in others for p in range(len(v) - len(passage) + 1))
    assert met > len(near) / 4


@pytest.mark.parametrize("seed", range(2))
def test_passages_of_many_edited_copies(spark, seed):
    """Copies that differ in few places, cut anywhere, some more than once in a document."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 500)]
    texts = {}
    for i in range(120):
        words = []
        for _ in range(int(rng.integers(1, 3))):
            a, n = int(rng.integers(0, 450)), int(rng.integers(30, 300))
            words += [w if rng.random() > 0.015 else f"x{rng.integers(5)}" for w in base[a : a + n]]
        texts[i] = words
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(7)
    got = {(r.doc_id, q) for r in suffix_dedup.repeated_passages(df).collect() for q in range(r.start, r.end)}
    assert got == _repeated(texts)


def _edited(words: list[str], how: str, at: list[int]) -> list[str]:
    out = list(words)
    for j in sorted(at, reverse=True):
        out[j : j + (how != "insert")] = [] if how == "delete" else [f"edit{j}"]
    return out


def test_edited_leaks_are_held(spark):
    rng = np.random.default_rng(8)
    items = {r.item_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()}
    docs, expected = [], set()
    for item, text in items.items():
        words = decontaminate.words_of(text)
        cut = (len(words) + 1) // 2
        halves = [range(cut), range(cut, len(words))]
        for how in ("change", "insert", "delete"):
            places = [[j] for j in range(len(words))] + [rng.choice(len(words), 2, replace=False).tolist() for _ in range(10)]
            places += [[j for h in halves for j in rng.choice(h, 2, replace=False).tolist()] for _ in range(5)]
            for at in places:
                expected.add((len(docs), item))
                docs.append((len(docs), " ".join([*(f"a{j}" for j in range(rng.integers(200))), *_edited(words, how, at), "the", "end"])))
        # The question alone, the answer alone, and the words of both in another order are no leak.
        for other in (words[:cut], words[cut:], rng.permutation(words).tolist()):
            docs.append((len(docs), " ".join(other)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert len(got & expected) == len(expected)
    assert got == expected


def test_word_distance_by_plain_computation():
    rng = np.random.default_rng(9)
    for _ in range(300):
        half, text = (rng.choice(list("abcde"), n).tolist() for n in rng.integers(1, 30, 2))
        row = [0] * (len(text) + 1)
        for j, w in enumerate(half, 1):
            last, row = row, [j]
            for k, t in enumerate(text, 1):
                row.append(min(last[k - 1] + (w != t), last[k] + 1, row[-1] + 1))
        assert decontaminate.Half(half).distance(text) == min(row)


def test_stages_tell_rows_of_one_id_apart(spark):
    sf = "/root/testdata/sf0.001"
    leak = next(r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if r.text)
    clean = [" ".join(f"{c}{j}" for j in range(80)) for c in "abcdef"]
    rows = [(None, leak), (None, clean[0]), (None, clean[1]), (7, leak), (7, clean[2]), (8, clean[3]), (8, ""), (9, clean[4]), (9, clean[4]), (3, clean[0]), (1, clean[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in corpus_pipeline.leak_stage(spark, df, sf).collect())))
    assert got == sorted(str(r) for r in rows if r[1] != leak)
    got = sorted(map(str, (tuple(r) for r in corpus_pipeline.near_stage(spark, df, sf).collect())))
    assert got == sorted(map(str, [(7, leak), (None, clean[1]), (7, clean[2]), (8, clean[3]), (8, ""), (9, clean[4]), (3, clean[0]), (1, clean[5])]))


def test_quality_stage_decides_short_texts_by_the_posterior(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = quality.score_quality(docs).collect()
    short = {r.doc_id for r in scored if 0 < r.n_words < 50 and 2 * r.n_repeat_words <= r.n_words}
    good = {r.doc_id for r in scored if r.quality >= 0.5}
    got = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, sf).collect()}
    assert short & good
    assert got == {r.doc_id for r in scored if r.kept} | (short & good)


def test_full_pieces_go_through_no_batch(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 1000, n))) for i, n in enumerate((9000, 20, 4000, 300))], "doc_id long, text string")
    rows = packing.pack_documents(df, 2048).collect()
    windows, pieces = defaultdict(int), defaultdict(list)
    for r in rows:
        assert (r.length == 2048) == (r.sequence_id >= packing.FULL)
        windows[r.sequence_id] += r.length
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert any(r.length == 2048 for r in rows) and max(windows.values()) <= 2048
    assert all(r.offset == 0 for r in rows if r.length == 2048)
    for found in pieces.values():
        ends = [0, *np.cumsum([n for _, n, _ in sorted(found)]).tolist()]
        assert [s for s, _, _ in sorted(found)] == ends[:-1] and ends[-1] == found[0][2]
    assert len(pieces) == 4
