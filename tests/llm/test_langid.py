import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import langid

SF = "/root/testdata/sf0.001"
ODD = ["", None, "²½Ⅷ① 12 _!", "a", "É", "straße STRASSE", "中文 字", "a1b2 c_d", "x퟿́y", "ab " * 3000, "ﬁnal İstanbul ʼn"]


def _grams(text):
    """{n-gram: count} by the definition."""
    out = Counter()
    words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower()).split()
    for w in words:
        w = f" {w} "
        out.update(g for n in (1, 2, 3) for i in range(len(w) - n + 1) if (g := w[i : i + n]) != " ")
    return out


def _ranked(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: langid.PROFILE]]


def _code(gram):
    return sum(ord(c) << s for c, s in zip(gram, (42, 21, 0), strict=False))


@pytest.mark.parametrize("chunk", [1 << 20, 3])
def test_grams_by_definition(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    for text in ODD:
        grams, counts = langid.gram_counts(text or "")
        assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == {_code(g): n for g, n in _grams(text).items()}
        assert (np.diff(grams) > 0).all()


@pytest.mark.parametrize("at_once", [langid.LANGS, 1])
def test_predictions_by_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(langid, "LANGS", at_once)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(ODD)] + [(None, "no id", "en")], docs.schema))
    rows = docs.withColumn("train", langid.in_training(F.col("doc_id"))).collect()
    counts = defaultdict(Counter)
    for r in rows:
        if r.train and r.lang:
            counts[r.lang].update(_grams(r.text))
    model = {lang: {g: i for i, g in enumerate(_ranked(c))} for lang, c in sorted(counts.items())}
    expected = {}
    for r in rows:
        own = _ranked(_grams(r.text))
        if not own:
            expected[r.doc_id] = ("und", 0.0)
            continue
        far = {x: sum(abs(i - m[g]) if g in m else langid.PROFILE for i, g in enumerate(own)) for x, m in model.items()}
        best = min(far, key=far.get)
        expected[r.doc_id] = (best, 1 - far[best] / (langid.PROFILE * len(own)))
    got = langid.train_and_identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.lang_pred == expected[r.doc_id][0] and abs(r.score - expected[r.doc_id][1]) < 1e-9
        assert r.held_out == (not next(x.train for x in rows if x.doc_id == r.doc_id) if r.doc_id is not None else False)
    held = [(r.doc_id, r.lang_pred) for r in got if r.held_out]
    true = {r.doc_id: r.lang for r in rows if r.lang}
    assert np.mean([true[d] == p for d, p in held if d in true]) > 0.95


def test_empty_model(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {tuple(r) for r in langid.train_and_identify(docs).select("doc_id", "lang_pred", "score").collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
