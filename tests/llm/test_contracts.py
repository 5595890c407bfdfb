"""op1, op2, op5 and op7 against their contracts, over whole tables."""

import zlib
from collections import Counter, defaultdict

import brute
import pytest
from tokenizers import Tokenizer

from skyledger.llm import queries
from skyledger.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    tok = Tokenizer.from_file(tokenizer_path())
    return {d: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()}


def test_sharding(spark, texts):
    rows = queries.op1_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots, load, home = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        home[raw].add(r.shard)
    assert set(slots) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in home.values())
    groups = Counter()
    for r in rows:
        groups[(texts[r.doc_id] or "").encode()] += r.size
    # No cut can do better than the fair share or the largest group; a run of groups more is the search's resolution.
    assert max(load.values()) <= sum(load.values()) / 40 + max(groups.values())


def test_packing(spark, texts, ids):
    rows = queries.op2_packing(spark, SF).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id]
        assert (r.doc_tokens, r.ids_crc32) == (len(own), brute.crc_ids(own[r.start : r.start + r.length]))
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for found, whole in [*((p, len(ids[d])) for d, p in pieces.items()), *((w, None) for w in windows.values())]:
        at = 0
        for start, length in sorted(found):
            assert start == at and length > 0
            at += length
        assert at == whole if whole else at <= 2048
    assert len(windows) <= 1.05 * sum(map(len, ids.values())) / 2048 + 1


def test_quality(spark, texts):
    rows = queries.op5_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality_base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_token_files(spark, ids):
    rows = sorted(queries.op7_token_files(spark, SF).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == sorted(ids)
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]), brute.crc_ids(ids[r.doc_id]))
        at += r.n_tokens
