"""Quality rules as weak supervision: rules vote or abstain, EM estimates how they err, the posterior decides.

Everything is DataFrame expressions. The rules' votes of all documents are counted by pattern (at most 3 ** len(RULES)
rows at any corpus size), and EM runs over those counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import BLANKS, materialize, named

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Prior of the votes -1, 0, 1 for bad and good documents, and its weight in documents a document.
VOTES = ((0.3, 0.4, 0.3), (0.003, 0.3, 0.697))
PRIOR = 0.05
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to a in is that for it as was with be by on not he his but at are this have from or had an they which "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son "
    "el los y del las por con no una su para es al lo como más o pero sus ya"
).split()

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """Votes 1 (good), -1 (bad) or 0 (abstains) from the features of ``with_features``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("_letters"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "length": _vote(F.col("n_words") >= 100, F.col("n_words") < 5),
        "symbols": _vote(F.col("n_symbols") <= 0.02 * words, F.col("n_symbols") > 0.1 * words),
        "word_length": _vote(mean.between(3, 9), (mean < 2) | (mean > 15)),
        "repetition": _vote(F.col("n_repeat_words") <= 0.1 * words, F.col("n_repeat_words") > 0.3 * words),
        "lines": _vote(F.col("n_dup_lines") == 0, F.col("n_dup_lines") > 0.3 * F.col("_lines")),
        "case": _vote(F.col("_upper") <= 0.15 * letters, F.col("_upper") > 0.4 * letters),
        "function_words": _vote(F.col("_stops") >= 3, (F.col("_stops") == 0) & (F.col("n_words") >= 30)),
        "letters": _vote(F.col("_letters") >= 0.92 * F.col("word_chars"), F.col("_letters") < 0.8 * F.col("word_chars")),
        "exclamation": _vote(F.col("_marks") <= 0.05 * words, F.col("_marks") > 0.25 * words),
    }


def with_features(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` (whole, text) less text, the five base features, base_failed and votes. Null text has no words;
    a line counts if it has a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    gone = lambda chars: (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")
    upper = F.regexp_replace(text, r"[^\p{Lu}]+", "")
    letters = F.regexp_replace(text, r"[^\p{L}]+", "")
    out = rows.select("whole", *[c.alias(n) for n, c in {
        "_words": F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), ""),
        "_split": F.filter(F.split(text, "\n"), lambda x: F.char_length(F.trim(x, F.lit(BLANKS))) > 0),
        "word_chars": F.char_length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": gone(SYMBOLS),
        "_upper": F.char_length(upper).cast("long"),
        "_letters": F.char_length(letters).cast("long"),
        "_marks": gone("!"),
    }.items()])
    out = out.withColumn("_grams", F.expr("if(size(_words) < 3, cast(array() as array<bigint>), transform(sequence(0, size(_words) - 3), i -> xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2))))"))
    # Most texts repeat no window; only the others pay for the sort of (window, position).
    out = out.withColumn("_twice", F.size(F.array_distinct("_grams")) < F.size("_grams"))
    out = out.withColumn("_order", F.expr("if(_twice, sort_array(transform(_grams, (g, i) -> struct(g, i))), null)"))
    out = out.withColumn("_at", F.expr("if(_twice, sort_array(transform(filter(transform(_order, (x, i) -> struct(x.i as p, x.g = get(_order, i - 1).g or x.g = get(_order, i + 1).g as again)), y -> coalesce(y.again, false)), y -> y.p)), null)"))
    # Windows cover three words each; neighbours that overlap share some.
    covered = F.expr("if(_twice, aggregate(_at, named_struct('n', 0L, 'end', 0), (a, p) -> named_struct('n', a.n + (p + 3 - greatest(a.end, p)), 'end', p + 3)).n, 0L)")
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_dup_lines": (F.size("_split") - F.size(F.array_distinct("_split"))).cast("long"),
        "n_repeat_words": covered,
        "_lines": F.size("_split").cast("long"),
        "_stops": F.size(F.array_intersect("_words", F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)]))),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return out.select("whole", *FEATURES, "base_failed", F.array(*rules().values()).alias("votes"))


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and for each rule and class the chance of the votes -1, 0 and 1."""

    good: float
    given_bad: list[list[float]]
    given_good: list[list[float]]

    def posterior(self, votes: str = "votes") -> Column:
        """Probability that a document is good."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for j, (b, g) in enumerate(zip(self.given_bad, self.given_good, strict=True)):
            vote = F.get(F.col(votes), F.lit(j))
            ratio = [math.log(y / x) for x, y in zip(b, g, strict=True)]
            odds = odds + F.when(vote < 0, ratio[0]).when(vote > 0, ratio[2]).otherwise(ratio[1])
        return 1 / (1 + F.exp(-odds))


def fit_label_model(patterns: DataFrame, n_rules: int, rounds: int = 12) -> LabelModel:
    """EM over vote patterns (votes, n). It starts from "any bad vote means bad". The prior, with PRIOR of the weight of the
    documents, says that rules rarely vote bad on good documents; on an empty table it is all there is."""
    model = None
    for _ in range(rounds):
        p = model.posterior() if model else F.when(F.array_contains("votes", -1), 0.1).otherwise(0.95)
        vote = [F.get(F.col("votes"), F.lit(j)) for j in range(n_rules)]
        sums = [F.sum(w * F.col("n") * (v == x).cast("int")) for v in vote for w in (1 - F.col("p"), F.col("p")) for x in (-1, 0, 1)]
        row = patterns.withColumn("p", p).agg(F.sum(F.col("n") * F.col("p")), F.sum("n"), *sums).first()
        total = float(row[1] or 0)
        weight = 10 + PRIOR * total
        given: tuple[list, list] = ([], [])
        for j in range(n_rules):
            for c in (0, 1):
                n = [float(row[2 + 6 * j + 3 * c + x] or 0) + weight * VOTES[c][x] for x in range(3)]
                given[c].append([x / sum(n) for x in n])
        model = LabelModel((float(row[0] or 0) + 9) / (total + 10), *given)
    return model


def score_quality(docs: DataFrame, keep_text: bool = True, threshold: float = 0.5) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality (posterior), kept.

    The base rule fails texts under MIN_WORDS words or with over half of their words in repeated three-word windows; of the
    rest those with a posterior of ``threshold`` or more are kept. Null and empty texts fail. Repeated rows and null ids are
    rows like any other; columns of ``docs`` with one of the new names are replaced, all others stay. An empty table gives an
    empty result. The features are computed once.
    """
    new = {*FEATURES, "base_failed", "quality", "kept"}
    own = [c for c in docs.columns if c not in new and (keep_text or c != "text")]
    # Own columns stay in one struct meanwhile, so that their names meet no others.
    scored = with_features(docs.select(F.struct(*[named(c) for c in own]).alias("whole"), "text"))
    scored = materialize(scored, "quality-features")
    patterns = materialize(scored.groupBy("votes").agg(F.count("*").alias("n")), "quality-patterns")
    quality = fit_label_model(patterns, len(rules())).posterior()
    columns = [F.col("whole")[c].alias(c) for c in own]
    return scored.select(*columns, *FEATURES, "base_failed", quality.alias("quality"), (~F.col("base_failed") & (quality >= threshold)).alias("kept"))
