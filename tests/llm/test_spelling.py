"""Spelling variants against plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from edges import EDGES, SCHEMA
from tradeloom.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(docs, length=6, least=5, every=199):
    out = Counter()
    for d, t in docs:
        for w in RUN.findall(t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= length and n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(words, times=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def vocabulary(seed, n=250):
    rnd = random.Random(seed)
    words = {}
    while len(words) < n:
        w = "".join(rnd.choice("abcdeéñüß") for _ in range(rnd.randrange(1, 9))) if not words or rnd.random() < 0.3 else rnd.choice(list(words))
        i, c = rnd.randrange(len(w) + 1), rnd.choice("abcdeéñü")
        w = rnd.choice([w, w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]])
        if w:
            words[w] = 5 ** rnd.randrange(1, 6) * rnd.choice([1, 1, 2])
    return words


@pytest.mark.parametrize("seed,symbols", [(1, None), (2, 1), (3, 2), (4, 5), (5, 32)])
def test_all_pairs(spark, seed, symbols):
    words = vocabulary(seed)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    want = plain(words)
    assert found(spelling.variants(df, symbols=symbols)) == want
    assert len({r[2] for r in want}) < len(want) and any(r[1] and r[2] != r[1] for r in want)


def test_chain_to_the_last(spark):
    words = {"a" * 10 + "b" * i: 5 ** (i + 1) for i in range(9)} | {"zzzzzzz": 7}
    got = found(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain(words) and {r[2] for r in got} == {"a" * 10 + "b" * 8, "zzzzzzz"}


def test_nothing_is_broadcast(spark, monkeypatch):
    """Spark takes a neighbourhood, many rows a word, for no larger than its words; each join is merged."""
    plans, write = [], spelling.written
    noted = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(spelling, "written", lambda df, *a: noted(df) or write(df, *a))
    words = {"a" * 10 + "b" * i: 5 ** (i + 1) for i in range(9)}
    df = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    noted(df)
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans) and found(df) == plain(words)


def test_neighbours_are_all():
    rnd = random.Random(1)
    for size in (1, 2, 6, 20):
        r = np.array([[rnd.randrange(1, 4) for _ in range(size)] for _ in range(5)], np.uint64)
        made = spelling.neighbours(r, 3)
        for row, keys in zip(r.tolist(), made):
            edits = {tuple(row)} | {tuple(row[:i] + [a] + row[j:]) for i in range(size + 1) for j in (i, i + 1) for a in (1, 2, 3)} | {
                tuple(row[:i] + row[i + 1:]) for i in range(size)}
            assert set(keys.tolist()) == {int(spelling.codes(np.array([e], np.uint64).reshape(1, -1))[0]) for e in edits if len(e) <= size + 1}


def test_vocabulary(spark, make, monkeypatch):
    rnd = random.Random(3)
    some = ["Language", "languages", "ÀÉÎõü÷×", "étranger", "ÉTRANGER", "short", "sixsix", "sevenss", "x" * 300]
    docs = [(rnd.choice([None, *range(-40, 400)]), " ".join(rnd.choice(some) + rnd.choice(["", ".", "9", "_", "日"]) for _ in range(rnd.randrange(40)))) for _ in range(300)]
    docs += docs[:9] + [(r[0], r[1]) for r in EDGES]
    monkeypatch.setattr(spelling, "HELD", 3)
    got = {r["word"]: r["n"] for r in spelling.vocabulary(make(docs), every=7).collect()}
    assert got == plain_words(docs, every=7) and any(len(w) == 299 for w in got)
    assert found(spelling.variants(spelling.vocabulary(make(docs), every=7))) == plain(plain_words(docs, every=7))


def test_edges(spark, make):
    assert found(spelling.variants(spelling.vocabulary(spark.createDataFrame([], SCHEMA)))) == []
    rows = [(r[0], r[1]) for r in EDGES]
    assert found(spelling.variants(spelling.vocabulary(make(EDGES), length=3, least=1))) == plain(plain_words(rows, 3, 1))
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), times=1)
