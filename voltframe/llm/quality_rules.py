"""Quality rules that vote, weighed by weak supervision.

Each rule looks at whole-text statistics and votes good (1), bad (0) or abstains
(null).  Expectation-maximisation over the counts of vote patterns (at most
3 ** rules rows, whatever the corpus) estimates how often each rule gives each
vote on good and on bad documents.  The posterior probability of being good is a
sum of the rules' log odds, written as one Spark expression; it decides instead
of an all-rules-must-pass filter.  A base of two hard limits still applies.

Everything on the data path is a DataFrame expression; a document never leaves
its partition except as its vote pattern's count.

Defined results: null text has no words and fails the base, as does empty text;
rows that repeat a doc_id are judged each; an empty table gives an empty result;
only doc_id and text are read.  Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import SPACES, WORD_PATTERN, staged, text_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_AT = 0.5
EM_ROUNDS = 100
#: A rule is taken to be right more often than not, and no vote to be impossible.
LEAST, MOST = 0.02, 0.98
#: Frequent short words of English, French, German and Spanish.
COMMON_WORDS = (
    "the of and to in a is that for it was with on as be by this are from at "
    "de la le les des et en un une du que pour dans est sur par au avec il "
    "der die und den von zu das mit sich auf ist im dem nicht ein eine als "
    "el los las del y por con para una no su se al es").split()

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_common",
              "n_letters", "n_distinct")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a 3-word window found twice or more, from ``words``.

    Windows are hashed and, only where some hash repeats, sorted with their
    positions; equal neighbours are the repeated windows.  Each step is a column of
    its own so that no step is evaluated again for every element of the next.
    """
    next_word = lambda i, k: F.get(F.col("words"), i + k)
    df = df.withColumn("windows", F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, next_word(i, 1), next_word(i, 2))))
    df = df.withColumn("ordered", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(F.get(F.col("ordered"), k)["h"] == x["h"], F.lit(False))
    df = df.withColumn("starts", F.sort_array(F.transform(
        F.filter("ordered", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])))
    covered = F.transform("starts", lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("starts"), k + 1) - p,
                                                                              F.lit(3))))
    return df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)).cast("bigint"))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics that the rules read, one row a document."""
    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    df = (df.withColumn("words", F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)))
          .withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != "")))
    df = _repeat_words(df)
    common = lambda w: F.lower(w).isin(COMMON_WORDS)
    values = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.translate("text", SPACES, "")),
        "n_symbols": F.length("text") - F.length(F.translate("text", SYMBOLS, "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_lines": F.size("lines"),
        "n_common": F.size(F.filter("words", common)),
        "n_letters": F.length("text") - F.length(F.regexp_replace("text", r"\p{L}+", "")),
        "n_distinct": F.size(F.array_distinct("words")),
    }
    return df.select("doc_id", *[values[k].cast("bigint").alias(k) for k in STATISTICS])


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1).cast("int")


def votes() -> dict[str, Column]:
    """The rules: 1 good, 0 bad, null abstains."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    mean = F.col("word_chars") / n
    symbols, dups = F.col("n_symbols") / chars, F.col("n_dup_lines") / lines
    repeats, common = F.col("n_repeat_words") / n, F.col("n_common") / n
    letters, distinct = F.col("n_letters") / chars, F.col("n_distinct") / n
    return {
        "v_length": _vote(F.col("n_words") >= 100, F.col("n_words") < MIN_WORDS),
        "v_word_length": _vote(mean.between(3.5, 8.0), (mean < 2.5) | (mean > 12.0)),
        "v_symbols": _vote(symbols < 0.01, symbols > 0.1),
        "v_dup_lines": _vote(dups < 0.1, dups > 0.3),
        "v_repeats": _vote(repeats < 0.1, repeats > 0.3),
        "v_common": _vote(common > 0.08, common < 0.03),
        "v_letters": _vote(letters > 0.9, letters < 0.7),
        "v_distinct": _vote(distinct > 0.3, distinct < 0.15),
    }


def fit(patterns: list[tuple[tuple[int | None, ...], int]]) -> tuple[float, list[tuple[float, float]]]:
    """Share of good documents and, for each rule, how often it is right on (good, bad) when it votes.

    ``patterns``: vote patterns with their counts.  Abstentions say nothing.
    """
    rules = len(patterns[0][0]) if patterns else len(votes())
    share, right = 0.8, [(0.8, 0.8)] * rules
    for _ in range(EM_ROUNDS if patterns else 0):
        good_sum = total = 0.0
        seen = [[2.0, 2.5, 2.0, 2.5] for _ in range(rules)]  # right and all on good, right and all on bad
        for pattern, count in patterns:
            p = count * posterior(pattern, share, right)
            good_sum, total = good_sum + p, total + count
            for s, v in zip(seen, pattern):
                if v is not None:
                    s[0] += p * v
                    s[1] += p
                    s[2] += (count - p) * (1 - v)
                    s[3] += count - p
        new_share = min(MOST, max(LEAST, good_sum / total))
        new = [(min(MOST, max(0.5, a / b)), min(MOST, max(0.5, c / d))) for a, b, c, d in seen]
        moved = max(abs(new_share - share), *(abs(x - y) for p, q in zip(new, right) for x, y in zip(p, q)))
        share, right = new_share, new
        if moved < 1e-9:
            break
    return share, right


def _odds(share: float, right: list[tuple[float, float]]) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of being good: before any vote, and what a vote of (1, 0) of each rule adds."""
    return (math.log(share / (1 - share)),
            [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in right])


def posterior(pattern: tuple[int | None, ...], share: float, right: list[tuple[float, float]]) -> float:
    start, added = _odds(share, right)
    z = start + sum(up if v else down for v, (up, down) in zip(pattern, added) if v is not None)
    return 1 / (1 + math.exp(-z))


def probability(names: list[str], share: float, right: list[tuple[float, float]]) -> Column:
    """The posterior as an expression over the vote columns."""
    start, added = _odds(share, right)
    z = F.lit(start)
    for name, (up, down) in zip(names, added):
        z = z + F.when(F.col(name) == 1, up).when(F.col(name) == 0, down).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the statistics, ``base_failed``, ``good_probability`` and ``kept``."""
    rules = votes()
    # Written once: the text is read a single time for the counts and the verdicts.
    voted = staged(statistics(docs).withColumns(rules), "quality-votes")
    counts = voted.groupBy(*rules).count().collect()  # at most 3 ** len(rules) rows
    share, right = fit(sorted((((tuple(r)[:-1]), r["count"]) for r in counts), key=str))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (voted.withColumn("base_failed", base)
            .withColumn("good_probability", probability(list(rules), share, right))
            .withColumn("kept", ~F.col("base_failed") & (F.col("good_probability") >= KEEP_AT))
            .select("doc_id", *STATISTICS, "base_failed", "good_probability", "kept"))
