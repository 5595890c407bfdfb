"""Lines that many documents hold are dropped without their texts being moved."""

import hashlib
import random
from collections import Counter

import brute
import pytest

from skyledger.llm import line_dedup


def _moved(spark):
    """Bytes of shuffle written so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def _prose(rng, n):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))


def test_texts_that_lose_lines_held_often_are_not_shuffled(spark):
    rng = random.Random(1)
    rows = [(i, f"{_prose(rng, 8000)}\nAll rights reserved by the owner.\nSubscribe to our news letter") for i in range(400)]
    before, old = _moved(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r.doc_id: (r.text, r.n_dropped) for r in out} == {i: (t, 0) if i == 399 else (t.split("\n")[0], 2) for i, t in rows}
    assert _moved(spark) - before < 0.2 * sum(len(t) for _, t in rows)


@pytest.mark.parametrize("often", [0, 1, 12, 1000])
def test_lines_held_often_and_others_in_one_text(spark, monkeypatch, often):
    monkeypatch.setattr(line_dedup, "OFTEN", often)
    rng = random.Random(2)
    held = [f"a line that some texts hold {k}" + " \u00c4\u00e4" * (k % 2) for k in range(30)]
    lines = [*held, "short", "", "one of a kind, nearly"]
    pick = [min(len(held) - 1, int(rng.expovariate(0.2))) for _ in range(600)]
    texts = ["\n".join(rng.choice(["{}", " {}\t", "{}\r"]).format(x.upper() if x.isascii() and rng.random() < 0.3 else x) for x in rng.sample(lines, 3) + [lines[pick.pop()] for _ in range(rng.randrange(4))]) for _ in range(150)]
    rows = [(None if i % 40 == 7 else i % 140, t) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (500, None), (501, ""), (502, lines[0]), (503, f"{lines[0]}\n{lines[0]}")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out)
    assert got == Counter((d, *x[1:]) for (d, _), x in zip(rows, brute.dedup_lines(rows), strict=True))
    assert sum(r.text is None for r in out) == 1
    assert len({r.n_dropped for r in out}) > 3
