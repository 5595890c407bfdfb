"""The stages over a whole table against plain Python, and the quality verdict against labels."""

import math
import unicodedata
from collections import Counter

import brute
from tokenizers import Tokenizer

import corpus_pipeline
from skyledger.llm import decontaminate, quality
from skyledger.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"


def _votes(text):
    """The nine rules' votes by their definitions."""
    text = text or ""
    n, chars, symbols, dups, repeats, failed = brute.quality_base(text)
    words = brute.WORD.findall(text)
    category = Counter(unicodedata.category(c) for c in text)
    letters = sum(v for k, v in category.items() if k[0] == "L")
    lines = sum(bool(brute.WORD.search(x)) for x in text.split("\n"))
    stops, marks, w, one = len(set(words) & set(quality.STOP_WORDS)), text.count("!"), max(n, 1), max(letters, 1)
    vote = lambda good, bad: -1 if bad else int(good)
    mean = chars / w
    return failed, n, repeats, (
        vote(n >= 100, n < 5), vote(symbols <= 0.02 * w, symbols > 0.1 * w), vote(3 <= mean <= 9, mean < 2 or mean > 15), vote(repeats <= 0.1 * w, repeats > 0.3 * w),
        vote(dups == 0, dups > 0.3 * lines), vote(category["Lu"] <= 0.15 * one, category["Lu"] > 0.4 * one), vote(stops >= 3, stops == 0 and n >= 30),
        vote(letters >= 0.92 * chars, letters < 0.8 * chars), vote(marks <= 0.05 * w, marks > 0.25 * w),
    )


def _posteriors(votes):
    """Expectation-maximisation over single documents."""
    p = [0.1 if -1 in v else 0.95 for v in votes]
    for _ in range(12):
        weight, given = 10 + quality.PRIOR * len(votes), ([], [])
        for j in range(9):
            for c in (0, 1):
                n = [sum((x if c else 1 - x) * (v[j] == k) for x, v in zip(p, votes, strict=True)) + weight * quality.VOTES[c][k + 1] for k in (-1, 0, 1)]
                given[c].append([x / sum(n) for x in n])
        good = (sum(p) + 9) / (len(votes) + 10)
        odds = [math.log(good / (1 - good)) + sum(math.log(given[1][j][x + 1] / given[0][j][x + 1]) for j, x in enumerate(v)) for v in votes]
        p = [1 / (1 + math.exp(-o)) for o in odds]
    return p


def test_stages_by_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = {r.item_id: decontaminate._grams(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    voted = [_votes(t) for _, t in rows]
    p = _posteriors([v[3] for v in voted])
    scored = {r.doc_id: r for r in quality.score_quality(docs).collect()}
    for (d, _), (failed, _, _, _), x in zip(rows, voted, p, strict=True):
        assert abs(scored[d].quality - x) < 1e-6 and scored[d].kept == (not failed and x >= 0.5)
    kept = [row for row, (failed, n, repeats, _), x in zip(rows, voted, p, strict=True) if x >= 0.5 and (not failed or 0 < n < 50 and 2 * repeats <= n)]
    expected = [kept, brute.without_repeated_lines(kept)]
    first = {c: d for d, _, c in sorted(brute.jaccard_components(expected[1], 5, 80), reverse=True)}
    expected.append([r for r in expected[1] if r[0] in set(first.values())])
    held = lambda t: any(len(g & own) / len(g) > 0.9 for g in items.values()) if (own := decontaminate._grams(decontaminate.words_of(t))) else False
    expected.append([r for r in expected[2] if not held(r[1])])
    for (name, stage), rows in zip(corpus_pipeline.STAGES, expected, strict=False):
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(rows), name
    assert len(expected[0]) < len(scored) and expected[3]
    tok = Tokenizer.from_file(tokenizer_path())
    sizes = {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in expected[3]}
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    assert {r.doc_id: r.doc_tokens for r in pieces} == sizes and sum(r.length for r in pieces) == sum(sizes.values())


def test_verdict_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in quality.score_quality(spark.read.parquet(f"{sf}/documents.parquet"), keep_text=False).collect() if r.doc_id in labels]
    good = [r for r in rows if labels[r.doc_id].quality == 1 and not r.base_failed]
    bad = [r for r in rows if labels[r.doc_id].quality == 0]
    assert len(good) > 100 and len(bad) > 20
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in bad) <= 0.02 * len(bad)
