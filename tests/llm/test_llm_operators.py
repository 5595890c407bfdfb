import re
from collections import defaultdict

import pytest

from skyledger.llm import decontaminate, ngram_join, queries, suffix_dedup

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def _sets(rows, n):
    out = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        out[i] = set(zip(*(w[j:] for j in range(n)), strict=False)) if len(w) >= n else ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize(("n", "percent", "common"), [(3, 90, 50), (5, 80, 2)])
def test_components_by_brute_force(spark, docs, monkeypatch, n, percent, common):
    # With a low bound most linked documents take the way of those made of common n-grams.
    monkeypatch.setattr(ngram_join, "COMMON", common)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # One group whose members link only in a chain, and one whose members are all just too far apart.
    base = [f"w{k}" for k in range(200)]
    rows += [(10_000 + k, " ".join([*base[4 * k :], *(f"c{j}" for j in range(4 * k))])) for k in range(8)]
    rows += [(20_000 + k, " ".join(f"v{j}" if j % 12 else f"u{k}x{j}" for j in range(200))) for k in range(12)]
    sets = _sets(rows, n)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for p, a in enumerate(ids):
        for b in ids[p + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_repeated_passages_by_brute_force(docs):
    texts = {r.doc_id: WORD.findall((r.text or "").translate(FOLD)) for r in docs.collect()}
    holders = defaultdict(set)
    for i, w in texts.items():
        for p in range(len(w) - 49):
            holders[tuple(w[p : p + 50])].add(i)
    expected = {(i, q) for i, w in texts.items() for p in range(len(w) - 49) if len(holders[tuple(w[p : p + 50])]) > 1 for q in range(p, p + 50)}
    got = {(r.doc_id, q) for r in suffix_dedup.repeated_passages(docs).collect() for q in range(r.start, r.end)}
    assert got == expected


def test_leaks_by_containment(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    grams = {r.item_id: decontaminate._grams(decontaminate.words_of(r.text)) for r in bench.collect()}
    own = {r.doc_id: decontaminate._grams(decontaminate.words_of(r.text)) for r in docs.collect()}
    expected = {(d, i) for d, a in own.items() for i, b in grams.items() if len(a & b) / len(b) > 0.9}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()} == expected


def test_line_dedup_matches_sql(spark):
    import oracle

    assert oracle.compare(queries.op9_line_dedup(spark, SF), queries.OP9_SQL, SF) is None
