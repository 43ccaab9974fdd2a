"""Weak supervision of quality: rules vote or abstain, and an expectation-maximisation weighs them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import written
from tradeloom.llm.textstats import text_counts


@dataclass(frozen=True)
class Rule:
    """Votes good where `good` holds, bad where `bad` holds, and abstains otherwise."""

    name: str
    good: str
    bad: str


def _share(a: str, b: str, below: float, above: float, name: str, given: str = "true") -> Rule:
    return Rule(name, f"{given} and {a} <= {below} * {b}", f"{given} and {a} > {above} * {b}")


#: The rules in use. None of them decides alone. Between their bounds they abstain.
RULES = (
    _share("n_symbols", "n_words", 0.1, 0.4, "symbols"),
    _share("n_symbols", "word_chars", 0.02, 0.08, "symbol_chars"),
    _share("n_tails", "n_words", 0.05, 0.25, "symbol_tails"),
    _share("n_repeat_words", "n_words", 0.1, 0.3, "repeats"),
    _share("n_dup_lines", "n_lines", 0.1, 0.3, "lines", "n_lines >= 4"),
    _share("n_upper", "n_letters", 0.2, 0.5, "capitals"),
    _share("n_runs", "n_words", 0.03, 0.15, "runs", "n_words >= 5"),
    _share("n_marks", "n_words", 0.6, 1.0, "marks"),
    Rule("distinct", "n_words >= 20 and n_distinct * 3 >= least(n_words, 600)", "n_words >= 20 and n_distinct * 6 < least(n_words, 600)"),
    Rule("length", "word_chars between 3 * n_words and 12 * n_words", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 25 * n_words)"),
)


def votes(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> Column:
    """The votes as one text: `+`, `-` or `.` for each rule, in order."""
    return F.concat(*[F.expr(f"CASE WHEN {r.bad} THEN '-' WHEN {r.good} THEN '+' ELSE '.' END") for r in rules])


def fit(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray, float]:
    """Posterior probability of good for each vote pattern, accuracies (rule, class bad/good) and prior.

    `patterns` counts how often each pattern occurs, so all documents take part, in a size that
    depends on the number of rules only. A rule's accuracy on a class is the chance that it votes
    for that class, given that it votes. Abstaining says nothing. Starts from the majority, which
    also settles which class is called good; counts are smoothed by one vote.
    """
    names = sorted(patterns)
    if not names:
        return {}, np.zeros((0, 2)), 0.5
    n = np.array([patterns[p] for p in names], float)
    up = np.array([[c == "+" for c in p] for p in names], float)
    down = np.array([[c == "-" for c in p] for p in names], float)
    q = (up.sum(1) + 1) / (up.sum(1) + down.sum(1) + 2)
    # A vote against counts for more at the start: most documents break no rule at all.
    q = np.where(down.sum(1) > 0, np.minimum(q, 0.2), q)
    for _ in range(rounds):
        good, bad = n * q, n * (1 - q)
        prior = (good.sum() + 1) / (n.sum() + 2)
        right_good = (good @ up + 1) / (good @ (up + down) + 2)
        right_bad = (bad @ down + 1) / (bad @ (up + down) + 2)
        odds = np.log(prior / (1 - prior)) + up @ np.log(right_good / (1 - right_bad)) + down @ np.log((1 - right_good) / right_bad)
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done, q = np.abs(new - q).max() < 1e-9, new
        if done:
            break
    return dict(zip(names, q.tolist())), np.stack([right_bad, right_good], 1), float(prior)


def weak_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, at: float = 0.5) -> DataFrame:
    """Counts of each document with `votes`, `posterior`, `base_failed` and `kept`.

    kept: not base_failed, and a posterior of `at` or more. Texts that are null or hold no word
    fail the base. One row comes out per row that goes in, repeated rows and null ids included;
    columns other than doc_id and text are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = text_counts(docs)
    rows = written(rows.withColumn("votes", votes(rows, rules)), "votes")
    # At most 3 ** len(rules) patterns, whatever the number of documents.
    patterns = {r["votes"]: r["n"] for r in rows.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _, _ = fit(patterns)
    learned = spark.createDataFrame(list(posterior.items()), "votes string, posterior double")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.join(F.broadcast(learned), "votes").withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("posterior") >= at))
