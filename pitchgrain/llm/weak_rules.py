"""Quality rules that vote: accuracies by expectation-maximisation, a probability instead of all-must-pass.

Each rule looks at one measure of form and votes for a good text, for a bad one, or abstains. A text
kept by every rule or failed by one is no verdict: rules differ in how often a good or a bad text gets
which vote. Two classes with a share of each, and for each rule the chance of a vote for good in either
class, are estimated without labels by expectation-maximisation over all texts. A text's verdict is its
probability of being good under that model.

Texts with equal votes are alike for the model, so the steps run over a table of vote patterns, of
which there are at most 3 ** len(``RULES``) however many texts there are; of a step only a sum for each
rule and class reaches the driver. Measures are taken in one pass, each text in its own row, by built-in functions.

Cases: null and empty texts have no words; all their measures are 0, every rule abstains, and the base
conditions fail. Texts of fewer than ``SPOKEN`` words get no votes. Three-word windows of a text are told
apart by 64-bit hashes. Repeated rows count each. Columns beside those named are not read, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import materialise, text_or_empty

BLANKS = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MARKS = BLANKS + "[|*-]" + BLANKS
#: Fewest words of a text on which rules vote.
SPOKEN = 20
#: A text of fewer words, or with more than half its words in repeated windows, fails whatever the votes.
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
STEPS = 20
#: Before the first step: the share of good texts, and the chance of a vote for good in a good and in a bad text.
PRIOR, IN_GOOD, IN_BAD = 0.9, 0.98, 0.7
#: Votes that stand for these first values in each step.
WEIGHT = 10

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_capitals", "n_shouts", "n_stops", "n_marks")

#: Each rule's condition for a vote for good and for bad, in SQL over the measures.
RULES = {
    "symbols": ("50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "capitals": ("100 * n_capitals <= 8 * word_chars", "100 * n_capitals > 20 * word_chars"),
    "repeats": ("100 * n_repeat_words <= 12 * n_words", "100 * n_repeat_words > 30 * n_words"),
    "lines": ("n_lines > 2 AND 100 * n_dup_lines <= 10 * n_lines", "n_lines > 2 AND 100 * n_dup_lines > 40 * n_lines"),
    "lengths": ("10 * word_chars BETWEEN 35 * n_words AND 65 * n_words", "10 * word_chars NOT BETWEEN 30 * n_words AND 75 * n_words"),
    "shouts": ("100 * n_shouts <= 10 * n_words", "100 * n_shouts > 30 * n_words"),
    "variety": ("n_words <= 3000 AND 100 * n_distinct >= 45 * n_words", "n_words <= 3000 AND 100 * n_distinct < 25 * n_words"),
    "marks": ("100 * n_marks <= 2 * n_words", "100 * n_marks > 10 * n_words"),
    "sentences": ("100 * n_stops BETWEEN 2 * n_words AND 25 * n_words", "100 * n_stops NOT BETWEEN n_words AND 40 * n_words"),
}


def repeated_words(words: Column) -> Column:
    """Words of the list that lie in a three-word window found twice or more in it."""
    none = F.expr("cast(array() as array<int>)")
    begins = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(none)
    window = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(3)))
    sorted_ = F.sort_array(F.transform(begins, lambda i: F.struct(window(i).alias("hash"), i.alias("at"))))

    def met_again(all_: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(all_, k)["hash"] == x["hash"], F.lit(False))
        return F.filter(all_, lambda x, k: same(x, k - 1) | same(x, k + 1))

    # A variable of ``transform``, so that the list is sorted once and not for each window.
    found = F.transform(F.array(sorted_), met_again)[0]
    return F.size(F.array_distinct(F.flatten(F.transform(found, lambda x: F.array(*(x["at"] + k for k in range(3)))))))


def measures(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``MEASURES`` of each text, all BIGINT, and ``keep`` as the struct doc."""
    text = F.col("text")

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"),
            F.char_length(F.array_join(words, "")).alias("word_chars"),
            F.size(F.array_distinct(words)).alias("n_distinct"),
            repeated_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"))

    words = F.filter(F.split(text, BLANKS + "+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, " \t\x0b\x0c\r", "") != "")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    read = docs.select(F.struct(*keep).alias("doc"), text_or_empty().alias("text")).select(
        "doc",
        F.transform(F.array(words), of_words)[0].alias("w"),
        F.transform(F.array(lines), of_lines)[0].alias("l"),
        count(SYMBOLS).alias("n_symbols"),
        count("[A-Z]").alias("n_capitals"),
        count("!").alias("n_shouts"),
        count("[.!?]" + BLANKS).alias("n_stops"),
        count(MARKS).alias("n_marks"),
    )
    return read.select("doc", "w.*", "l.*", "n_symbols", "n_capitals", "n_shouts", "n_stops", "n_marks").select("doc", *(F.col(m).cast("long").alias(m) for m in MEASURES))


def vote(rule: str) -> Column:
    """1 for good, -1 for bad, 0 for no vote."""
    good, bad = RULES[rule]
    return F.expr(f"CASE WHEN n_words < {SPOKEN} THEN 0 WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END")


class Model:
    """The share of good texts, and for each rule the chance of a vote for good in good and in bad ones."""

    def __init__(self, prior: float = PRIOR, good: list[float] | None = None, bad: list[float] | None = None):
        self.prior, self.good, self.bad = prior, good or [IN_GOOD] * len(RULES), bad or [IN_BAD] * len(RULES)

    def probability(self) -> Column:
        """Of a text being good, over the columns of votes."""
        # The numbers stand in lists, not in the expression, so that each step runs the code compiled for the first;
        # the share of good texts is a last vote that all texts have.
        ahead = [math.log(g / b) for g, b in zip(self.good, self.bad, strict=True)] + [math.log(self.prior / (1 - self.prior))]
        behind = [math.log((1 - g) / (1 - b)) for g, b in zip(self.good, self.bad, strict=True)] + [0.0]
        votes = F.array(*RULES, F.lit(1))
        weights = F.transform(votes, lambda v, i: F.when(v > 0, F.get(F.lit(ahead), i)).when(v < 0, F.get(F.lit(behind), i)).otherwise(0.0))
        odds = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
        return 1 / (1 + F.exp(-odds))


def estimate(measured: DataFrame, steps: int = STEPS) -> Model:
    """The model after ``steps`` of expectation-maximisation over all texts that ``BASE`` lets through."""
    patterns = materialise(measured.where(f"NOT ({BASE})").select(*(vote(r).alias(r) for r in RULES)).groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")), "patterns")
    model = Model()
    for _ in range(steps):
        # A row for each rule and vote; the last rule is the share of good texts.
        each = patterns.select("n", model.probability().alias("p"), F.posexplode(F.array(*RULES, F.lit(1))).alias("rule", "vote"))
        sums = each.groupBy("rule", "vote").agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p"))))
        got = {(rule, vote): found for rule, vote, *found in sums.collect()}
        if not got:
            break  # nothing to learn from

        def chance(rule: int, kind: int, first: float, got: dict = got) -> float:
            up, down = (got.get((rule, vote), (0.0, 0.0))[kind] for vote in (1, -1))
            return (up + WEIGHT * first) / (up + down + WEIGHT)

        good, bad = got[len(RULES), 1]
        prior = (good + WEIGHT * PRIOR) / (good + bad + WEIGHT)
        model = Model(prior, *([chance(r, kind, first) for r in range(len(RULES))] for kind, first in ((0, IN_GOOD), (1, IN_BAD))))
    return model


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), steps: int = STEPS) -> DataFrame:
    """``keep``, ``MEASURES``, the votes as ``votes`` (a struct), probability, base_failed and kept of each row of ``docs``."""
    measured = materialise(measures(docs, keep), "measures")
    model = estimate(measured, steps)
    voted = measured.select("*", *(vote(r).alias(r) for r in RULES)).withColumn("probability", model.probability())
    out = voted.select("doc", *MEASURES, F.struct(*RULES).alias("votes"), "probability", F.expr(BASE).alias("base_failed"))
    return out.select("doc.*", *out.columns[1:], (~F.col("base_failed") & (F.col("probability") >= 0.5)).alias("kept"))


def _votes() -> str:
    return ", ".join(f"CASE WHEN n_words < {SPOKEN} THEN 0 WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END" for good, bad in RULES.values())


def _posterior(state: str) -> str:
    m = len(RULES)
    term = f"CASE v[r] WHEN 1 THEN ln({state}[1 + r] / {state}[{1 + m} + r]) WHEN -1 THEN ln((1 - {state}[1 + r]) / (1 - {state}[{1 + m} + r])) ELSE 0 END"
    return f"1 / (1 + exp(-(ln({state}[1] / (1 - {state}[1])) + list_sum(list_transform(range(1, {m + 1}), lambda r: ({term})::DOUBLE)))))"


def _step() -> str:
    parts = [f"(sum(n * g) + {WEIGHT} * {PRIOR}::DOUBLE) / (sum(n) + {WEIGHT})"]
    for weight, first in (("g", IN_GOOD), ("(1 - g)", IN_BAD)):
        for r in range(1, len(RULES) + 1):
            parts.append(
                f"(sum(CASE WHEN v[{r}] = 1 THEN n * {weight} ELSE 0 END) + {WEIGHT} * {first}::DOUBLE) / (sum(CASE WHEN v[{r}] <> 0 THEN n * {weight} ELSE 0 END) + {WEIGHT})"
            )
    return f"[{', '.join(parts)}]"


#: In DuckDB's SQL: the model's numbers as a list that each step of a recursion makes anew.
ORACLE = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, {{'a': w[i], 'b': w[i + 1], 'c': w[i + 2]}} AS s FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g),
c AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM h, unnest([i, i + 1, i + 2]) AS u(k) WHERE c > 1 GROUP BY 1),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(x, '{SYMBOLS}'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines, len(list_distinct(w)) AS n_distinct,
    len(regexp_extract_all(x, '[A-Z]')) AS n_capitals, len(regexp_extract_all(x, '!')) AS n_shouts, len(regexp_extract_all(x, '[.!?]{BLANKS}')) AS n_stops,
    len(regexp_extract_all(x, '{MARKS}')) AS n_marks
  FROM d LEFT JOIN c USING (doc_id)),
b AS (SELECT *, [{_votes()}] AS v FROM m),
pat AS (SELECT v, count(*) AS n FROM b WHERE NOT ({BASE}) GROUP BY 1),
em(k, p) AS (
  SELECT 0, [{', '.join([str(PRIOR), *[str(IN_GOOD)] * len(RULES), *[str(IN_BAD)] * len(RULES)])}]::DOUBLE[]
  UNION ALL
  SELECT k + 1, {_step()}::DOUBLE[] FROM (SELECT k, v, n, {_posterior("p")} AS g FROM em, pat WHERE k < {STEPS}) GROUP BY k),
f AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE} AS base_failed, {_posterior("p")} AS probability FROM b, em WHERE k = {STEPS})
SELECT * EXCLUDE (probability), NOT base_failed AND probability >= 0.5 AS kept FROM f
"""
