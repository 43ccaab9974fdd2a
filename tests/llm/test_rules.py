import re

import numpy as np
import pytest

from edges import EDGES, SCHEMA
from tradeloom.llm import rules
from tradeloom.llm.textstats import COUNTS, counts, repeat_words


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)]


TEXTS = [
    None, "", " \n\n ", "a\na\nb\n\n\na", "x " * 40, " ".join(map(str, range(30))) + " " + " ".join(map(str, range(30))),
    "a # b * c $ <d> |e| % &", "ein\x0bzwei\x0cdrei\x1cvier fünf sechs", "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8 9",
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert counts(text)[:5] == plain(text)


def test_repeat_words_random():
    rng = np.random.default_rng(1)
    for _ in range(200):
        words = [b"abc"[i:i + 1] for i in rng.integers(0, 3, rng.integers(0, 60))]
        assert repeat_words(words) == plain(b" ".join(words).decode())[4]


def test_em_finds_rules_that_fail_together():
    post, right, prior = rules.fit({"+++": 900, "--+": 60, "-++": 10, "+-+": 10, "++-": 5, "...": 5})
    assert post["+++"] > 0.9 > 0.5 > post["--+"]
    assert 0.8 < prior < 1 and right.shape == (3, 2)
    assert rules.fit({}) == ({}, pytest.approx(np.zeros((0, 2))), 0.5) or rules.fit({})[0] == {}


def plain_em(votes, rounds):
    """One document after the other, with plain sums and no patterns."""
    q = []
    for v in votes:
        up, down = v.count("+"), v.count("-")
        start = (up + 1) / (up + down + 2)
        q.append(min(start, 0.2) if down else start)
    for _ in range(rounds):
        prior = (sum(q) + 1) / (len(q) + 2)
        right = []
        for r in range(len(votes[0])):
            cast = [(v[r], p) for v, p in zip(votes, q) if v[r] != "."]
            good = (sum(p for c, p in cast if c == "+") + 1) / (sum(p for _, p in cast) + 2)
            bad = (sum(1 - p for c, p in cast if c == "-") + 1) / (sum(1 - p for _, p in cast) + 2)
            right.append((bad, good))
        new = []
        for v in votes:
            a, b = prior, 1 - prior
            for c, (bad, good) in zip(v, right):
                a *= {"+": good, "-": 1 - good, ".": 1}[c]
                b *= {"+": 1 - bad, "-": bad, ".": 1}[c]
            new.append(a / (a + b))
        q = new
    return q, right, prior


@pytest.mark.parametrize("seed, rounds", [(0, 1), (1, 7), (2, 60)])
def test_em_equals_plain_em(seed, rounds):
    rng = np.random.default_rng(seed)
    truth = rng.random(400) < 0.8
    votes = ["".join(rng.choice(list("+-."), p=[.6, .1, .3] if t else [.2, .6, .2]) for _ in range(5)) for t in truth]
    post, right, prior = rules.fit(dict(zip(*np.unique(votes, return_counts=True))), rounds)
    want, want_right, want_prior = plain_em(votes, rounds)
    assert np.allclose([post[v] for v in votes], want, atol=1e-6)
    assert np.allclose(right, want_right, atol=1e-6) and prior == pytest.approx(want_prior, abs=1e-6)


def test_accuracies_of_noisy_rules_are_found():
    rng = np.random.default_rng(5)
    truth, right = rng.random(20000) < 0.7, [0.95, 0.8, 0.7, 0.9]
    votes = ["".join("." if rng.random() < 0.2 else "+" if (rng.random() < a) == t else "-" for a in right) for t in truth]
    post, found, prior = rules.fit(dict(zip(*np.unique(votes, return_counts=True))), 500)
    assert np.allclose(found, np.array(right)[:, None], atol=0.05) and abs(prior - 0.7) < 0.05
    # Better than passing all rules, and than the majority of their votes.
    judged = np.array([post[v] >= 0.5 for v in votes])
    every, most = np.array(["-" not in v for v in votes]), np.array([v.count("+") > v.count("-") for v in votes])
    assert (judged == truth).mean() > max((every == truth).mean(), (most == truth).mean())


def test_edges(spark, make):
    got = rules.weak_quality(make(EDGES)).collect()
    assert len(got) == len(EDGES)
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 20)
    assert sorted(r["n_words"] for r in got) == sorted(plain(t[1])[0] for t in EDGES)
    assert rules.weak_quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_junk_fails_and_prose_stays(make):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdeilmnorstu"), rng.integers(2, 9)))
    prose = lambda k=60: " ".join(word() + ("." if i % 9 == 0 else "") for i in range(k))
    rows = [(i, prose()) for i in range(300)] + [(1000 + i, " ".join(w + "***" for w in prose().split())) for i in range(20)]
    kept = {r["doc_id"]: r["kept"] for r in rules.weak_quality(make(rows)).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(20))


def test_columns():
    assert COUNTS[:5] == ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
