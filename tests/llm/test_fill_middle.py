"""op13: SQL, plain Python over odd rows, other units and marks, many units."""

import hashlib
import re

import oracle
import pytest
from pyspark.sql import functions as F

from skyledger.llm import fill_middle, queries

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "one line"), (4, "\n"), (5, "\n\n\n"), (6, "a\nb\nc\nd\n"), (7, "a\r\nb c\x85d\ne"), (8, "keeps <P> out"), (9, "<M>"), (10, "<S\n>"), (11, "$1\\2\n$\n{3}\n\\E\n"), (12, "😀\n日本\né"),
       (13, "x" * 300_000), (14, "y\n" * 200_000), (15, "<\nP>\n<\nS>"), (16, "<P\n<S\n<M"), (6, "a\nb\nc\nd\n"), (None, "p\nq\nr"), (None, None), (6, "other\ntext")]


def plain(doc_id, text, percent=100, spm=50, seed=7, unit=fill_middle.LINE, marks=fill_middle.MARKS):
    text = text or ""
    units = re.findall(unit, text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in marks) or h[2] % 100 >= percent:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"{marks[1]}{s}{marks[0]}{p}{marks[2]}{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"{marks[0]}{p}{marks[1]}{s}{marks[2]}{m}"


NAMES = ["whole", "h", "a", "b", "chars", "n", "form", "output", "cuts", "x.y"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[f"{c}-{r[0]}" for c in NAMES]) for r in rows], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in NAMES))


def check(spark, rows, **options):
    marks = {k: v for k, v in options.items() if k == "marks"}
    out = fill_middle.fill_in_middle(frame(spark, rows), **options)
    out = out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"), **marks)).collect()
    names = {"spm_percent": "spm"}
    expected = [plain(*r, **{names.get(k, k): v for k, v in options.items()}) for r in rows]
    assert sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in out) == sorted(map(str, expected))
    assert sorted(str((r.doc_id, r.back)) for r in out) == sorted(str((d, t or "")) for d, t in rows)
    assert all(r[c] == f"{c}-{r.doc_id}" for r in out for c in ("whole", "h", "a", "b", "chars", "cuts", "x.y"))


def test_query(spark):
    assert oracle.compare(queries.op13_fill_middle(spark, SF), queries.ORACLE_SQL["op13_fill_middle"], SF) is None


def test_odd_rows(spark):
    check(spark, ODD)
    assert fill_middle.fill_in_middle(frame(spark, [])).count() == 0


@pytest.mark.parametrize("options", [{"percent": 40}, {"spm_percent": 0}, {"spm_percent": 100, "seed": 11}, {"unit": r"(?s:.)"}, {"unit": r"[^ ]* +|[^ ]+"}, {"marks": ("$1\\z", "[x]", "\\E(")}])
def test_options(spark, options):
    check(spark, [r for r in ODD if r[0] not in (13, 14)] + [(100 + i, f"w{i} v\nu " * (i % 7)) for i in range(60)], **options)


def test_marks_that_overlap_and_units_that_do_not_tile(spark):
    for marks in (("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("a", "xab", "y"), ("aba", "x", "y")):
        with pytest.raises(ValueError, match="overlap"):
            fill_middle.fill_in_middle(frame(spark, []), marks=marks)
    with pytest.raises(Exception, match="tile"):
        fill_middle.fill_in_middle(frame(spark, [(i, "a b a b") for i in range(9)]), unit="a").collect()
