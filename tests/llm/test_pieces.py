"""op12: ids, spans and text against the sentencepiece library, character maps against its normaliser, odd rows."""

import hashlib
import random

import pytest
from sentencepiece import SentencePieceNormalizer, SentencePieceProcessor, sentencepiece_model_pb2

from skyledger.llm import pieces, queries

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "   ", "a", "  two  blanks ", "tab\tand\nline\r\n", "ﬁ é é ①", "日本語 😀 👩‍👩", "​﻿", "▁ ▁▁", "<s></s><unk><0x0A>", "x" * 50_000, "a\0b", "　wide ｆｕｌｌ", "¨ ¨ ¨", "각각"]


def strings(n, seed=3):
    rng = random.Random(seed)
    letters = "ab  \t\n ẹ́̀ﬁﬃ①½ÅÅ¨　​­日バﾊﾞ각각😀▁"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(n)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf", "identity"])
def test_normaliser_equals_the_library(rule):
    library = SentencePieceNormalizer(rule_name=rule)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    for squeeze in (True, False):
        for dummy in (True, False):
            spec = proto.normalizer_spec
            spec.remove_extra_whitespaces, spec.add_dummy_prefix, spec.escape_whitespaces = squeeze, dummy, True
            theirs = SentencePieceNormalizer(model_proto=proto.SerializeToString(), add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
            ours = pieces.Normalizer(spec)
            for text in (*ODD, *strings(1500)):
                norm, align = ours(text.encode())
                expected, at = theirs.normalize(text, with_offsets=True)
                assert norm.decode() == expected, (rule, text)
                # Theirs are by character, ours by byte.
                firsts = [*(i for i, b in enumerate(norm) if b & 0xC0 != 0x80), len(norm)]
                assert [len(text.encode()[: align[i]].decode()) for i in firsts] == list(at), (rule, text)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=pieces.model_path())


def test_ids_and_spans_equal_the_library(library):
    enc = pieces.Encoder(pieces._read(None))
    words = [" ".join(w) for w in zip(strings(3000, 7), strings(3000, 8), strings(3000, 9), strict=True)]
    for text in (*ODD, *strings(3000), *words):
        ids, begins, ends = (x.tolist() for x in enc(text.encode()))
        assert ids == library.encode(text, add_eos=True)
        expected = library.encode(text, return_type="proto").pieces
        assert [(b, e) for b, e in zip(begins, ends, strict=True)][:-1] == [(p.begin, p.end) for p in expected]
        assert b"".join(text.encode()[b:e] for b, e in zip(begins, ends, strict=True)) == text.encode()


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op12_pieces(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_eos=True)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_odd_rows(spark, library):
    texts = [*enumerate(ODD), (None, None), (None, "one"), (3, None), (3, "a"), (3, "a"), (99, "word " * 20_000)]
    names = ["ids", "begins", "ends", "n", "a.b"]
    frame = lambda r: spark.createDataFrame([(*x, *names) for x in r], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = pieces.encode_pieces(frame(texts))
    assert out.columns == ["doc_id", "ids", "begins", "ends"]
    got = sorted(str((r.doc_id, r.ids, r.text)) for r in pieces.decode_pieces(out).collect())
    ids = [(d, library.encode(t or "", add_eos=True)) for d, t in texts]
    assert got == sorted(str((d, i, library.decode(i))) for d, i in ids)
    assert pieces.decode_pieces(pieces.encode_pieces(frame([]))).count() == 0


def test_batches_are_cut_by_ids(spark, monkeypatch):
    monkeypatch.setattr(pieces, "EMIT_IDS", 5)
    docs = spark.createDataFrame([(i, "a b c d" * (i % 3)) for i in range(20)], "doc_id long, text string")
    assert {r.doc_id: len(r.ids) > 1 for r in pieces.encode_pieces(docs).collect()} == {i: i % 3 > 0 for i in range(20)}
