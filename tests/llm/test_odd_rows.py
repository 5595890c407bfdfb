"""Null, empty, long, repeated rows, empty tables and clashing column names, with the results that the docstrings state."""

import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from skyledger.llm import decontaminate, langid, line_dedup, ngram_join, packing, quality, secrets, sharding, suffix_dedup, token_files, tokens
from skyledger.llm.common import scratch_path

SF = "/root/testdata/sf0.001"
PROSE = "the river and the old town lie in a wide valley that is quiet at noon and loud when the market opens with bread fish and cloth "
PASSAGE = " ".join(f"p{i}" for i in range(60))
OTHER = " ".join(f"o{i}" for i in range(40))
LINE = "All rights reserved by the keeper of lines."
SECRET = "é token = abcdef123 " + "ab01" * 7
TEXTS = [
    (1, None), (2, ""), (3, "one"), (3, "one"), (None, PROSE * 3), (4, PROSE * 3), (5, "word " * 20_000), (6, "a\n\n \nb é"), (7, f"x {PASSAGE} {OTHER}"), (8, f"{PASSAGE} z"),
    (9, f"{LINE}\nq1"), (10, f"  {LINE.upper()} \nq2"), (11, f"q3\n{LINE}"), (None, f"{LINE}\nq4"), (12, SECRET), (12, "another text of the same id"), (None, None), (None, None),
]
#: Names that operators use inside.
CLASH = ["_h", "_w", "_x", "_y", "_split", "_words", "_upper", "_letters", "_lines", "_stops", "_marks", "_grams", "__words", "__id", "__th", "__drop", "__split", "_first", "_nth", "_leak", "_key", "key", "whole",
         "row", "hash", "hit", "drop", "lines", "keep", "node", "label", "gram", "entries", "votes", "pos", "text_hash", "shard", "batch", "part", "seq", "size", "spans", "a.b", "c`d", "Label"]


def _docs(spark, rows=TEXTS):
    names = [c for c in CLASH if c != "Label"]
    return spark.createDataFrame([(*r, "en", *[f"{c}-{r[0]}" for c in names]) for r in rows], "doc_id long, text string, lang string, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in names))


def _pairs(rows):
    return sorted(map(str, rows))


def test_line_dedup(spark):
    out = line_dedup.dedup_lines(_docs(spark)).collect()
    # The rows without an id hold no copy and keep none.
    expected = [(d, t, h) for (d, t), (_, _, _, h) in zip(TEXTS, brute.dedup_lines(TEXTS), strict=True)]
    assert _pairs((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out) == _pairs((d, h) for d, _, h in expected)
    assert all(r[c] == f"{c}-{r.doc_id}" for r in out for c in CLASH if c not in ("Label",))
    assert sum(r.text is None for r in out) == sum(t is None for _, t in TEXTS)
    assert line_dedup.dedup_lines(_docs(spark, [])).count() == 0


def test_quality(spark):
    out = quality.score_quality(_docs(spark)).collect()
    got = _pairs((r.doc_id, r.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == _pairs((d, t, *brute.quality_base(t)) for d, t in TEXTS)
    assert all(r[c] == f"{c}-{r.doc_id}" for r in out for c in CLASH if c not in ("Label",))
    assert quality.score_quality(_docs(spark, [])).count() == 0


def test_components(spark):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(_docs(spark), 3, 90).collect())
    sets = [(d, brute.shingle_set(t, 3)) for d, t in TEXTS]
    assert got == Counter((d, len(s), d) for d, s in sets)
    assert ngram_join.jaccard_components(_docs(spark, [])).count() == 0


def test_components_of_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(5, a), (5, b), (5, c), (3, b), (9, a), (7, c), (None, a), (8, None), (8, "")]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(_docs(spark, rows)).collect())
    assert got == Counter([(5, 96, 3)] * 3 + [(3, 96, 3), (9, 96, 3), (7, 96, 3), (None, 96, None), (8, 0, 8), (8, 0, 8)])


def test_passages(spark):
    got = sorted((r.doc_id, r.start, r.end) for r in suffix_dedup.repeated_passages(_docs(spark)).collect())
    assert got == [(7, 1, 61), (8, 0, 60)]
    assert suffix_dedup.repeated_passages(_docs(spark, [])).count() == 0


def test_secrets(spark):
    got = _pairs((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in secrets.scan_secrets(_docs(spark)).collect())
    assert got == _pairs((d, [("assign", 2, 19), ("hex", 20, 48)] if t == SECRET else []) for d, t in TEXTS)
    assert secrets.scan_secrets(_docs(spark, [])).count() == 0


def test_languages(spark):
    got = langid.train_and_identify(_docs(spark)).collect()
    assert _pairs((r.doc_id, r.lang_pred) for r in got) == _pairs((d, "en" if t and any(map(str.isalpha, t)) else "und") for d, t in TEXTS)
    assert langid.train_and_identify(_docs(spark, [])).count() == 0


def test_shards(spark):
    got = sharding.shard_documents(_docs(spark), 4).collect()
    assert _pairs((r.doc_id, r.size, r.text_crc32) for r in got) == _pairs((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in TEXTS)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert len({r.shard for r in got if r.text_crc32 == 0}) == 1
    assert sharding.shard_documents(_docs(spark, []), 4).count() == 0


def test_leaks(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, PASSAGE), (4, PASSAGE)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(_docs(spark), bench).collect())
    assert got == [(7, 3), (7, 4), (8, 3), (8, 4)]
    assert decontaminate.find_leaks(_docs(spark, []), bench).count() == 0


@pytest.fixture(scope="module")
def ids():
    tok = Tokenizer.from_file(tokens.tokenizer_path())
    return [(d, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in TEXTS]


def test_packing(spark, ids):
    rows = packing.pack_documents(_docs(spark)).collect()
    whole, windows = Counter((d, len(x)) for d, x in ids), defaultdict(list)
    covered = Counter()
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        # Rows that share an id, or have none, are told apart by their lengths here; each piece is one of such a text.
        own = [x for d, x in ids if (d, len(x)) == (r.doc_id, r.doc_tokens)]
        assert r.ids_crc32 in {brute.crc_ids(x[r.start : r.start + r.length]) for x in own}
        covered.update((r.doc_id, r.doc_tokens, at) for at in range(r.start, r.start + r.length))
    assert covered == Counter((d, len(x), at) for d, x in ids for at in range(len(x)))
    assert Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == whole
    assert sum(r.length for r in rows) == sum(len(x) for _, x in ids)
    for found in windows.values():
        at = 0
        for start, n in sorted(found):
            assert start == at
            at += n
        assert at <= 2048
    assert packing.pack_documents(_docs(spark, [])).count() == 0


def test_token_files(spark, ids):
    out = scratch_path(spark, "odd-token-files")
    token_files.write_token_files(_docs(spark), out)
    rows = token_files.read_token_files(spark, out).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((d for d, _ in TEXTS), key=lambda d: (d is not None, d or 0))
    assert _pairs((r.doc_id, list(r.ids)) for r in rows) == _pairs(ids)
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), brute.crc_ids(r.ids))
        at += r.n_tokens
    empty = scratch_path(spark, "odd-token-files")
    token_files.write_token_files(_docs(spark, []), empty)
    assert token_files.read_token_files(spark, empty).count() == 0


def _plain(rows):
    return _pairs((r.doc_id, r.text) for r in rows)


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_and_take_empty_tables(spark, stage):
    run = corpus_pipeline.STAGES[stage][1]
    docs = _docs(spark)
    out = run(spark, docs, SF)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASH if c not in ("Label",))
    empty = run(spark, _docs(spark, []), SF)
    assert empty.columns == docs.columns and empty.count() == 0
    if stage == 0:
        assert not {r.text for r in rows} & {None, "", "word " * 20_000}
    if stage == 1:
        expected = [(d, h) for (d, _), (_, _, _, h) in zip(TEXTS, brute.dedup_lines(TEXTS), strict=True)]
        assert _pairs((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows) == _pairs(expected)
    if stage == 2:  # the prose without an id is a copy of document 4, equal rows are one
        assert _plain(rows) == _pairs({*TEXTS} - {(None, PROSE * 3)})
    if stage == 3:
        assert _plain(rows) == _pairs(TEXTS)


def test_packing_stage(spark):
    assert corpus_pipeline.packing_stage(spark, _docs(spark), SF).filter("start = 0").count() == len(TEXTS)
    assert corpus_pipeline.packing_stage(spark, _docs(spark, []), SF).count() == 0
