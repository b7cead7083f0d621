"""Quality rules by weak supervision.

Every rule votes for or against a text or abstains. How far each rule can be trusted is estimated by
expectation-maximisation over the votes alone, and the posterior probability of good quality decides.

Votes take one of ``3 ** rules`` patterns, so the corpus is summed up by one count per pattern: all
texts are in the estimate, and what reaches the driver has a fixed bound. A posterior belongs to a
pattern and goes back to the texts by a join with that same bounded table.

Defined cases: a null or empty text has no words and fails the base rules (a text that does, and
has votes that no judged text has, gets a null probability); repeated rows are judged
each on its own and alike; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.textstats import COUNTS, with_counts
from tallyloom.session import as_table


# Counts carry this prefix until the end, so that no column of the input can clash with them.
OWN = "_quality_"


def count(name: str) -> Column:
    return F.col(OWN + name)


@dataclass(frozen=True)
class Rule:
    """Votes for a text if the value is within ``good``, against it if outside ``fair``."""

    name: str
    value: Column
    good: tuple[float, float]
    fair: tuple[float, float]

    def vote(self) -> Column:
        inside = self.value.between(*self.good)
        outside = ~self.value.between(*self.fair)
        return F.when(inside, F.lit("+")).when(outside, F.lit("-")).otherwise(F.lit("0"))


def _share(part: str, whole: str) -> Column:
    return count(part) / F.greatest(count(whole), F.lit(1))


def default_rules() -> list[Rule]:
    letters = F.greatest(count("n_upper") + count("n_lower"), F.lit(1))
    return [
        Rule("length", count("n_words").cast("double"), (50, 1e6), (20, math.inf)),
        Rule("word_length", _share("word_chars", "n_words"), (3, 9), (2, 15)),
        Rule("symbols", _share("n_symbols", "n_words"), (0, 0.03), (0, 0.1)),
        Rule("letters", 1 - _share("n_odd", "word_chars"), (0.9, 1), (0.8, 1)),
        Rule("repeated_lines", _share("n_dup_lines", "n_lines"), (0, 0.1), (0, 0.3)),
        Rule("repeated_words", _share("n_repeat_words", "n_words"), (0, 0.1), (0, 0.25)),
        Rule("stutter", _share("n_same", "n_words"), (0, 0.05), (0, 0.25)),
        Rule("capitals", count("n_upper") / letters, (0, 0.2), (0, 0.4)),
        Rule("shouting", _share("n_shouts", "n_words"), (0, 0.05), (0, 0.2)),
        Rule("bare_words", _share("n_bare", "n_words"), (0, 0.05), (0, 0.2)),
        Rule("sentences", _share("n_ends", "n_words"), (0.02, 0.34), (0.004, 0.5)),
    ]


def base_failed() -> Column:
    return (count("n_words") < 20) | (100 * count("n_repeat_words") > 30 * count("n_words"))


# Where the estimate starts, and with how many imagined votes the start counts. A fault shows in a few
# rules only, so a rule has two accuracies: how often it is for a good text (nearly always), and how
# often against a bad one. Bounds keep each rule better than chance and never without doubt.
START_FOR_GOOD, FOR_GOOD = 0.995, (0.7, 0.9995)
START_AGAINST_BAD, AGAINST_BAD = 0.15, (0.02, 0.95)
START_PRIOR, PRIOR = 0.8, (0.3, 0.99)
IMAGINED = 10


def _within(value: float, bounds: tuple[float, float]) -> float:
    return min(max(value, bounds[0]), bounds[1])


@dataclass(frozen=True)
class LabelModel:
    for_good: tuple[float, ...]
    against_bad: tuple[float, ...]
    prior: float

    def posterior(self, pattern: str) -> float:
        """Probability of good quality given the votes of a pattern; an abstention says nothing."""
        log_odds = math.log(self.prior / (1 - self.prior))
        for mark, good, bad in zip(pattern, self.for_good, self.against_bad, strict=True):
            if mark == "+":
                log_odds += math.log(good / (1 - bad))
            elif mark == "-":
                log_odds += math.log((1 - good) / bad)
        return 1 / (1 + math.exp(-log_odds))


def fit(patterns: dict[str, int], rules: int, rounds: int = 200, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over counted vote patterns; no votes at all leave the start values."""
    model = LabelModel((START_FOR_GOOD,) * rules, (START_AGAINST_BAD,) * rules, START_PRIOR)
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        good = {p: model.posterior(p) for p in patterns}

        def share(j: int, mark: str, of, start: float) -> float:
            cast = sum(n * of(p) for p, n in patterns.items() if p[j] != "0")
            hits = sum(n * of(p) for p, n in patterns.items() if p[j] == mark)
            return (hits + start * IMAGINED) / (cast + IMAGINED)

        after = LabelModel(
            tuple(_within(share(j, "+", good.get, START_FOR_GOOD), FOR_GOOD) for j in range(rules)),
            tuple(_within(share(j, "-", lambda p: 1 - good[p], START_AGAINST_BAD), AGAINST_BAD)
                  for j in range(rules)),
            _within(sum(n * good[p] for p, n in patterns.items()) / total, PRIOR))
        moved = max(abs(a - b) for a, b in zip(
            (*after.for_good, *after.against_bad, after.prior),
            (*model.for_good, *model.against_bad, model.prior)))
        model = after
        if moved < tolerance:
            break
    return model


def label_model(voted: DataFrame, rules: int) -> tuple[LabelModel, dict[str, int]]:
    """Fits on the vote patterns of all texts that pass the base rules, as only those are judged.

    At most ``3 ** rules`` counts come to the driver.
    """
    counted = voted.where(~base_failed()).groupBy(count("votes").alias("votes")).agg(F.count("*").alias("n")).collect()
    patterns = {r["votes"]: r["n"] for r in counted}
    return fit(patterns, rules), patterns


def judge(docs: DataFrame, keep: list[str], rules: list[Rule] | None = None,
          least: float = 0.5) -> DataFrame:
    """The columns ``keep`` of every row, and with the prefix OWN its counts, votes, base_failed,
    p_good and kept.

    The texts are read once: the counts, with the columns to keep, are a table in the shared folder
    that both the fit and the verdicts read.
    """
    rules = rules or default_rules()
    counted = with_counts(docs, keep, OWN)
    voted = as_table(counted.withColumn(OWN + "votes", F.concat(*[r.vote() for r in rules])),
                     "quality-votes")
    model, patterns = label_model(voted, len(rules))
    known = docs.sparkSession.createDataFrame(
        [(p, model.posterior(p)) for p in patterns], f"_pattern string, {OWN}p_good double")
    return (voted.join(F.broadcast(known), count("votes") == F.col("_pattern"), "left")
            .drop("_pattern")
            .withColumn(OWN + "base_failed", base_failed())
            .withColumn(OWN + "kept", ~base_failed() & F.coalesce(count("p_good") >= least, F.lit(False))))


def filter_documents(docs: DataFrame, rules: list[Rule] | None = None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    judged = judge(docs, docs.columns, rules, least)
    return judged.where(count("kept")).select(*docs.columns)
